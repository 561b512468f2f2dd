"""Registry of the named queries: the Spark function, the inventory rows it covers, and its SQL twin."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@dataclass(frozen=True)
class Query:
    name: str
    rows: tuple[str, ...]
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    note: str = ""


REGISTRY: dict[str, Query] = {}


def query(rows: str, sql: str | None = None, note: str = ""):
    """Register a query under its function name; `rows` are the inventory ids it covers."""

    def add(fn):
        REGISTRY[fn.__name__] = Query(fn.__name__, tuple(rows.split()), fn, sql, note)
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
