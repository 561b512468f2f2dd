"""Feature selection by presence (more in the modules beside this one)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame


def select_features(df: DataFrame, numeric: Iterable[str], categorical: Iterable[str]) -> tuple[list[str], list[str]]:
    return [c for c in numeric if c in df.columns], [c for c in categorical if c in df.columns]
