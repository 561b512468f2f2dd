"""Data-quality checks: a check passes when nothing fails."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidemart.session import materialize


@dataclass(frozen=True)
class Check:
    """`kind` is unique, not_null, relationship or condition.

    relationship needs `parent` and `parent_column`; condition needs `failing`, true on a bad row.
    """

    kind: str
    model: str
    column: str
    parent: str | None = None
    parent_column: str | None = None
    failing: Column | None = None
    name: str | None = None


def duplicate_keys(df: DataFrame, column: str) -> DataFrame:
    """Non-null keys held by more than one row."""
    return df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def null_rows(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def orphan_keys(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Non-null child keys without a parent, with their row counts; one row per key reaches the join."""
    keys = child.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("key")).agg(F.count(F.lit(1)).alias("n"))
    return keys.join(parent.select(F.col(parent_column).alias("key")).distinct(), "key", "left_anti")


def future_messages(messages: DataFrame, dates: DataFrame, as_of) -> DataFrame:
    """Messages dated after `as_of`; no rows when no date is on or before it."""
    latest = dates.filter(F.col("full_date") <= F.lit(as_of).cast("date")).agg(F.max("date_key")).scalar()
    return messages.filter(F.col("date_key") > latest)


def negative_views(messages: DataFrame) -> DataFrame:
    return messages.filter(F.col("view_count") < 0)


COLUMNS = ["check", "model", "column", "failures"]


def _flat(checks: Sequence[Check], model: str) -> list[Check]:
    """The checks of a model that a count over its rows decides."""
    return [c for c in checks if c.model == model and c.kind in ("not_null", "condition")]


def _counts(flat: Sequence[Check]) -> list[Column]:
    bad = [F.col(c.column).isNull() if c.kind == "not_null" else c.failing for c in flat]
    return [F.count_if(b).alias(f"f{i}") for i, b in enumerate(bad)]


def _row(check: Check, failures: Column) -> Column:
    cells = (F.lit(check.name or check.kind), F.lit(check.model), F.lit(check.column), failures.cast("bigint"))
    return F.struct(*[cell.alias(name) for cell, name in zip(cells, COLUMNS, strict=True)])


def _keyed_rows(models: dict[str, DataFrame], checks: Sequence[Check], model: str) -> DataFrame | None:
    """All unique and relationship checks of a model: one scan gives every check's keys and how many rows have each."""
    keyed = [c for c in checks if c.model == model and c.kind in ("unique", "relationship")]
    if not keyed:
        return None
    cells = F.array(*[F.struct(F.lit(i).alias("i"), F.col(c.column).cast("string").alias("key")) for i, c in enumerate(keyed)])
    keys = models[model].select(F.inline(cells)).filter("key is not null").groupBy("i", "key").agg(F.count(F.lit(1)).alias("n"))
    parents = [models[c.parent].select(F.lit(i).alias("i"), F.col(c.parent_column).cast("string").alias("key")) for i, c in enumerate(keyed) if c.kind == "relationship"]
    if parents:
        known = reduce(DataFrame.unionByName, parents).distinct().withColumn("known", F.lit(True))
        keys = keys.join(known, ["i", "key"], "left")
    else:
        keys = keys.withColumn("known", F.lit(None).cast("boolean"))
    sums = []
    for i, c in enumerate(keyed):
        here = F.col("i") == i
        failures = F.count_if(here & (F.col("n") > 1)) if c.kind == "unique" else F.sum(F.when(here & F.col("known").isNull(), F.col("n")))
        sums.append(F.coalesce(failures, F.lit(0)).alias(f"f{i}"))
    return keys.agg(*sums).select(F.inline(F.array(*[_row(c, F.col(f"f{i}")) for i, c in enumerate(keyed)])))


def _results(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts).select(COLUMNS).withColumn("passed", F.col("failures") == 0)


def run_checks(models: dict[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """One row per check: check, model, column, failures, passed.

    All null and condition checks of a model are counted in one scan of it, all checks of its keys in another.
    """
    parts: list[DataFrame] = []
    for model in dict.fromkeys(c.model for c in checks):
        flat = _flat(checks, model)
        if flat:
            parts.append(models[model].agg(*_counts(flat)).select(F.inline(F.array(*[_row(c, F.col(f"f{i}")) for i, c in enumerate(flat)]))))
        keyed = _keyed_rows(models, checks, model)
        if keyed is not None:
            parts.append(keyed)
    return _results(parts)


class CheckedWriter:
    """Writes models one after the other and counts their null and condition checks as they are written.

    What is written is read for the checks of keys only, once per model. `sink` writes a frame and returns it as it is read back.
    """

    def __init__(self, checks: Sequence[Check], sink: Callable[[str, DataFrame], DataFrame] = lambda model, df: materialize(df, model)):
        self.checks, self.sink = list(checks), sink
        self.models: dict[str, DataFrame] = {}
        self.counted: list[tuple[Check, int]] = []

    def write(self, model: str, df: DataFrame) -> DataFrame:
        flat = _flat(self.checks, model)
        if flat:
            seen = Observation()
            self.models[model] = self.sink(model, df.observe(seen, *_counts(flat)))
            self.counted += [(c, seen.get[f"f{i}"]) for i, c in enumerate(flat)]
        else:
            self.models[model] = self.sink(model, df)
        return self.models[model]

    def results(self) -> DataFrame:
        """As `run_checks`, for the models written."""
        keyed = [_keyed_rows(self.models, self.checks, model) for model in self.models]
        parts = [one for one in keyed if one is not None]
        if self.counted:
            spark = next(iter(self.models.values())).sparkSession
            rows = [(c.name or c.kind, c.model, c.column, n) for c, n in self.counted]
            parts.append(spark.createDataFrame(rows, "check string, model string, column string, failures long"))
        return _results(parts)


STAR_CHECKS = (
    Check("unique", "stg_messages", "message_id"),
    Check("not_null", "stg_messages", "message_id"),
    Check("not_null", "stg_messages", "channel_name"),
    Check("not_null", "stg_messages", "message_text"),
    Check("not_null", "stg_messages", "post_date"),
    Check("unique", "dim_channels", "channel_key"),
    Check("not_null", "dim_channels", "channel_key"),
    Check("not_null", "dim_channels", "channel_name"),
    Check("unique", "dim_dates", "date_key"),
    Check("not_null", "dim_dates", "date_key"),
    Check("not_null", "dim_dates", "full_date"),
    Check("unique", "fct_messages", "message_id"),
    Check("not_null", "fct_messages", "message_id"),
    Check("not_null", "fct_messages", "channel_key"),
    Check("not_null", "fct_messages", "date_key"),
    Check("not_null", "fct_messages", "message_text"),
    Check("relationship", "fct_messages", "channel_key", "dim_channels", "channel_key"),
    Check("relationship", "fct_messages", "date_key", "dim_dates", "date_key"),
)


def star_checks(has_detections: bool = True) -> list[Check]:
    """The model checks plus non-negative views; F.col needs a session, hence a function."""
    checks = [*STAR_CHECKS, Check("condition", "fct_messages", "view_count", failing=F.col("view_count") < 0, name="non_negative_views")]
    if has_detections:
        checks += [
            Check("not_null", "fct_image_detections", "message_id"),
            Check("relationship", "fct_image_detections", "channel_key", "dim_channels", "channel_key"),
            Check("relationship", "fct_image_detections", "date_key", "dim_dates", "date_key"),
        ]
    return checks
