"""Profiling: missingness, frequencies, cardinality, class balance, description."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.functions.numeric import present as without_nan
from tidemart.operators.order import null_safe_join, quantiles

ORDERED = (T.NumericType, T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)


def known(df: DataFrame, column: str) -> Column:
    """The column with NaN as null, where it can hold NaN."""
    cell = F.col(f"`{column}`")
    return F.when(~F.isnan(cell), cell) if isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType)) else cell


def _comparable(df: DataFrame, column: str) -> Column:
    """A form of the column that min and max can compare: nested and binary values as text, maps by sorted entries."""
    kind = df.schema[column].dataType
    if isinstance(kind, ORDERED):
        return known(df, column)
    if isinstance(kind, T.BinaryType):
        return F.hex(f"`{column}`")
    if isinstance(kind, (T.ArrayType, T.StructType, T.MapType)):
        cell = F.col(f"`{column}`")
        entries = F.array_sort(F.map_entries(cell)) if isinstance(kind, T.MapType) else cell
        return F.when(cell.isNotNull(), F.to_json(F.struct(entries.alias("v"))))
    return F.col(f"`{column}`").cast("string")


def _as_rows(one_row: DataFrame, cells: Sequence[Column]) -> DataFrame:
    return one_row.select(F.inline(F.array(*cells)))


def missingness(df: DataFrame) -> DataFrame:
    """column, dtype, missing_pct (2 decimals), non_null; one scan."""
    kinds = dict(df.dtypes)
    counted = df.agg(F.count(F.lit(1)).alias("__n"), *[F.count(known(df, c)).alias(c) for c in df.columns])
    cells = [
        F.struct(
            F.lit(c).alias("column"),
            F.lit(kinds[c]).alias("dtype"),
            F.round(F.try_divide((F.col("__n") - F.col(f"`{c}`")) * 100.0, F.col("__n")), 2).alias("missing_pct"),
            F.col(f"`{c}`").alias("non_null"),
        )
        for c in df.columns
    ]
    return _as_rows(counted, cells).orderBy(F.desc_nulls_last("missing_pct"), "column")


def coverage(df: DataFrame, column: str) -> DataFrame:
    """Share of rows with a value; 0.0 for a missing column or no rows."""
    if column not in df.columns:
        return df.sparkSession.range(1).select(F.lit(0.0).alias("coverage"))
    share = F.try_divide(F.count(known(df, column)).cast("double"), F.count(F.lit(1)))
    return df.agg(F.coalesce(share, F.lit(0.0)).alias("coverage"))


def counts_by_group(df: DataFrame, group: str, value: str) -> DataFrame:
    """Rows per group and value; list cells count each item; nulls are dropped."""
    if group not in df.columns or value not in df.columns:
        return df.sparkSession.createDataFrame([], f"`{group}` string, `{value}` string, count bigint")
    rows = df.select(group, value)
    if isinstance(df.schema[value].dataType, T.ArrayType):
        rows = rows.select(group, F.explode(value).alias(value))
    present = rows.filter(F.col(group).isNotNull() & F.col(value).isNotNull())
    return present.groupBy(group, value).agg(F.count(F.lit(1)).alias("count"))


def frequencies(df: DataFrame, column: str) -> DataFrame:
    """Every value (null included) with its count and share of all rows."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    total = counts.agg(F.sum("count")).scalar()
    return counts.withColumn("share", F.col("count") / total)


def top_frequencies(df: DataFrame, column: str, n: int = 10) -> DataFrame:
    return frequencies(df, column).orderBy(F.desc("count"), F.asc_nulls_last(column)).limit(n)


def first_present(df: DataFrame, candidates: Sequence[str]) -> str | None:
    return next((c for c in candidates if c in df.columns), None)


def class_balance(df: DataFrame, candidates: Sequence[str]) -> DataFrame | None:
    """Count and share per class of the first candidate column that exists."""
    column = first_present(df, candidates)
    return None if column is None else frequencies(df, column).orderBy(F.desc("count"), F.asc_nulls_last(column))


def class_distribution(df: DataFrame, column: str) -> DataFrame:
    """Count and percent (3 decimals) per class."""
    return frequencies(df, column).select(column, "count", F.round(F.col("share") * 100, 3).alias("pct"))


def constant_columns(df: DataFrame) -> DataFrame:
    """Columns of any type with at most one distinct value, null (and NaN) being a value; min, max and counts suffice."""
    checked = df.columns
    cells = {c: _comparable(df, c) for c in checked}
    counted = df.agg(
        F.count(F.lit(1)).alias("__n"),
        *[F.count(cells[c]).alias(f"n_{c}") for c in checked],
        *[F.min(cells[c]).eqNullSafe(F.max(cells[c])).alias(f"s_{c}") for c in checked],
    )
    cells = [
        F.struct(
            F.lit(c).alias("column"),
            ((F.col(f"`n_{c}`") == 0) | ((F.col(f"`n_{c}`") == F.col("__n")) & F.col(f"`s_{c}`"))).alias("constant"),
        )
        for c in checked
    ]
    return _as_rows(counted, cells).filter("constant").select("column")


def cardinality(df: DataFrame, columns: Sequence[str], max_rows: int = 12, approximate: bool = False) -> DataFrame:
    """Distinct values (null counted) and their share of rows, most varied first."""
    present = [c for c in columns if c in df.columns]
    count = F.approx_count_distinct if approximate else F.count_distinct
    counted = df.agg(
        F.count(F.lit(1)).alias("__n"),
        *[(count(F.col(c)) + F.coalesce(F.max(F.col(c).isNull().cast("int")), F.lit(0))).alias(c) for c in present],
    )
    cells = [
        F.struct(
            F.lit(c).alias("column"), F.col(c).alias("unique"),
            F.coalesce(F.try_divide(F.col(c).cast("double"), F.col("__n")), F.lit(0.0)).alias("unique_pct"),
        )
        for c in present
    ]
    return _as_rows(counted, cells).orderBy(F.desc("unique_pct"), "column").limit(max_rows)


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each set of equal rows (nulls equal)."""
    counts = df.groupBy(*[f"`{c}`" for c in df.columns]).agg(F.count(F.lit(1)).alias("__c"))
    return counts.agg(F.coalesce(F.sum(F.col("__c") - 1), F.lit(0)).alias("duplicates"))


def dtypes(df: DataFrame, max_rows: int | None = None) -> DataFrame:
    listed = df.dtypes if max_rows is None else df.dtypes[:max_rows]
    return df.sparkSession.createDataFrame(listed, "column string, dtype string")


def describe_by_class(
    df: DataFrame, class_col: str, columns: Sequence[str], percentiles: Sequence[float] = (0.5, 0.9, 0.99), approximate: bool = False
) -> DataFrame:
    """One row per class and column: count, mean, std, min, percentiles (median always), max."""
    present = [c for c in columns if c in df.columns]
    long = (
        df.filter(F.col(class_col).isNotNull())
        .select(class_col, *[without_nan(F.col(c)).alias(c) for c in present])
        .unpivot([class_col], present, "column", "value")
    )
    keys = [class_col, "column"]
    basic = long.groupBy(*keys).agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"),
    )
    probs = {f"p{round(p * 100, 6):g}".replace(".", "_"): p for p in sorted({*percentiles, 0.5})}
    return null_safe_join(basic, quantiles(long, keys, "value", probs, approximate), keys)
