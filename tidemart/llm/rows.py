"""Small helpers for frames: columns that may clash, text keys, and files in the shared folder."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_results(df: DataFrame, results: dict[str, Column]) -> DataFrame:
    """`df` with new columns; input columns of the same names (in any case) give way to them."""
    taken = {name.lower() for name in results}
    kept = [F.col(quoted(name)) for name in df.columns if name.lower() not in taken]
    return df.select(*kept, *(column.alias(name) for name, column in results.items()))


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def free_name(df_columns: Sequence[str], wanted: str) -> str:
    """`wanted`, or with underscores before it until no column is called so."""
    names = {name.lower() for name in df_columns}
    while wanted.lower() in names:
        wanted = "_" + wanted
    return wanted


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(quoted(name)).cast("string"), F.lit(""))
