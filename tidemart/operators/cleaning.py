"""Cleaning steps: lenient parsing, missing values, duplicates, and the six-step review cleaning."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.functions.dates import TIMESTAMP_FORMATS, parse_timestamp
from tidemart.functions.numeric import log1p_number
from tidemart.functions.text import collapse_whitespace
from tidemart.operators.order import first_per_key, quantiles, running, sort_columns
from tidemart.session import spread


def nan_to_null(df: DataFrame) -> DataFrame:
    """One kind of missing value: NaN in any floating column becomes null."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.when(~F.isnan(f"`{c}`"), F.col(f"`{c}`")) for c in floats}) if floats else df


def convert_to_datetime(df: DataFrame, column: str, formats: Sequence[str] = TIMESTAMP_FORMATS) -> DataFrame:
    return df.withColumn(column, parse_timestamp(F.col(column), formats))


def handle_missing(
    df: DataFrame,
    strategy: str = "drop",
    columns: Sequence[str] | None = None,
    keys: Sequence[str] = (),
    order: Sequence[str] = (),
) -> DataFrame:
    """drop, ffill, bfill or fill_mean; any other strategy leaves the frame as it is.

    ffill / bfill fill every column along `order` inside `keys` (order must be given: rows have none
    of their own), in segments, so one long series is not one task. NaN is missing.
    """
    df = nan_to_null(df)
    if strategy == "drop":
        return df.dropna(subset=list(columns) if columns else None)
    if strategy in ("ffill", "bfill"):
        filled = [c for c in df.columns if c not in keys and c not in {o.lstrip("-") for o in order}]
        return running(df, keys, order, {c: ("last", F.col(c)) for c in filled}, backwards=strategy == "bfill").select(df.columns)
    if strategy == "fill_mean":
        numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
        targets = [c for c in columns] if columns else numeric
        means = df.agg(*[F.avg(c).alias(c) for c in targets])
        packed = means.select(F.struct(*targets)).scalar()
        return df.withColumns({c: F.coalesce(F.col(c).cast("double"), packed[c]) for c in targets})
    return df


def drop_duplicates(df: DataFrame, subset: Sequence[str] | None = None, order: Sequence[str] | None = None) -> DataFrame:
    """Distinct rows, or the first row by `order` of each `subset` key."""
    if not subset:
        return df.distinct()
    return first_per_key(df, subset, order or [c for c in df.columns if c not in subset])


def add_log1p(df: DataFrame, column: str, new_name: str | None = None) -> DataFrame:
    if column not in df.columns:
        return df
    return df.withColumn(new_name or f"{column}_log1p", log1p_number(F.col(column)))


def flag_outliers(df: DataFrame, column: str, multiplier: float = 1.5, out: str = "is_outlier", approximate: bool = False) -> DataFrame:
    """True outside the quartiles by more than `multiplier` IQR; null is never an outlier."""
    box = quantiles(df, [], column, {"q1": 0.25, "q3": 0.75}, approximate).select(F.struct("q1", "q3")).scalar()
    spread = (box["q3"] - box["q1"]) * multiplier
    value = F.col(column)
    outside = (value < box["q1"] - spread) | (value > box["q3"] + spread)
    return df.withColumn(out, F.coalesce(outside, F.lit(False)))


@dataclass(frozen=True)
class ReviewColumns:
    """Column names of a review-like table; an empty name switches the column off."""

    id: str = "review_id"
    text: str = "review_text"
    rating: str = "rating"
    date: str = "review_date"
    year: str = "review_year"
    month: str = "review_month"
    group_code: str = "bank_code"
    group_name: str = "bank_name"
    user: str = "user_name"
    thumbs_up: str = "thumbs_up"
    reply: str = "reply_content"
    text_length: str = "text_length"
    source: str = "source"

    def output_columns(self) -> list[str]:
        return [getattr(self, f.name) for f in fields(self) if f.name != "reply" and getattr(self, f.name)]

    def critical(self) -> list[str]:
        return [c for c in (self.text, self.rating, self.group_name) if c]


def _in(df: DataFrame, name: str) -> bool:
    return bool(name) and name in df.columns


def drop_missing_critical(df: DataFrame, critical: Sequence[str]) -> DataFrame:
    present = [c for c in critical if c in df.columns]
    return df.dropna(subset=present) if present else df


def fill_review_defaults(df: DataFrame, cols: ReviewColumns) -> DataFrame:
    defaults = {cols.user: "Anonymous", cols.thumbs_up: 0, cols.reply: ""}
    return df.fillna({c: v for c, v in defaults.items() if _in(df, c)})


def normalise_review_dates(df: DataFrame, cols: ReviewColumns) -> DataFrame:
    """Date, year and month; a date that cannot be read is null (and counted in the statistics)."""
    if not _in(df, cols.date):
        return df
    day = F.to_date(parse_timestamp(F.col(cols.date)))
    return df.withColumn(cols.date, day).withColumns({cols.year: F.year(cols.date), cols.month: F.month(cols.date)})


def clean_review_text(df: DataFrame, cols: ReviewColumns) -> DataFrame:
    if not _in(df, cols.text):
        return df
    clean = df.withColumn(cols.text, collapse_whitespace(F.col(cols.text))).filter(F.col(cols.text) != "")
    return clean.withColumn(cols.text_length, F.length(cols.text))


def keep_valid_ratings(df: DataFrame, cols: ReviewColumns, keep_null: bool = False) -> DataFrame:
    if not _in(df, cols.rating):
        return df
    valid = F.col(cols.rating).between(1, 5)
    return df.filter(valid | F.col(cols.rating).isNull() if keep_null else valid)


def output_order(df: DataFrame, sort: Sequence[str | tuple[str, bool]]) -> list[Column]:
    """Sort columns that exist, each ascending or descending, nulls last."""
    pairs = [s if isinstance(s, tuple) else (s, True) for s in sort]
    return sort_columns([c if up else f"-{c}" for c, up in pairs if c in df.columns])


def review_statistics(df: DataFrame, cols: ReviewColumns, critical: Sequence[str] | None = None) -> DataFrame:
    """What each cleaning step removes, from one pass over the raw rows."""
    needed = [c for c in (critical or cols.critical()) if c in df.columns]
    missing = F.lit(False)
    for c in needed:
        missing = missing | F.col(c).isNull()
    blank = collapse_whitespace(F.col(cols.text)) == "" if _in(df, cols.text) else F.lit(False)
    rating_bad = F.coalesce((F.col(cols.rating) < 1) | (F.col(cols.rating) > 5), F.lit(True)) if _in(df, cols.rating) else F.lit(False)
    date_bad = (parse_timestamp(F.col(cols.date)).isNull() & F.col(cols.date).isNotNull()) if _in(df, cols.date) else F.lit(False)
    return df.agg(
        F.count(F.lit(1)).alias("original_count"),
        F.count_if(missing).alias("rows_removed_missing"),
        F.count_if(~missing & blank).alias("empty_reviews_removed"),
        F.count_if(~missing & ~blank & rating_bad).alias("invalid_ratings_removed"),
        F.count_if(~missing & ~blank & ~rating_bad).alias("final_count"),
        F.count_if(date_bad).alias("bad_dates"),
    )


def clean_reviews(
    df: DataFrame,
    cols: ReviewColumns = ReviewColumns(),
    critical: Sequence[str] | None = None,
    sort: Sequence[str | tuple[str, bool]] = (("bank_code", True), ("review_date", False)),
) -> DataFrame:
    """Missing values, dates, text, ratings, then the output columns that exist, sorted."""
    clean = (
        spread(df)
        .transform(drop_missing_critical, critical or cols.critical())
        .transform(fill_review_defaults, cols)
        .transform(normalise_review_dates, cols)
        .transform(clean_review_text, cols)
        .transform(keep_valid_ratings, cols)
    )
    out = clean.select([c for c in cols.output_columns() if c in clean.columns])
    by = output_order(out, sort)
    return out.orderBy(*by) if by else out


def quality_report(clean: DataFrame, statistics: DataFrame, cols: ReviewColumns = ReviewColumns()) -> dict[str, DataFrame]:
    """summary (one row), per-group counts and the rating distribution of a cleaning run."""
    retention = F.try_divide(F.col("final_count") * 100.0, F.col("original_count"))
    tier = F.when(100 - retention < 5, "EXCELLENT").when(100 - retention < 10, "GOOD").otherwise("NEEDS ATTENTION")
    length = F.col(cols.text_length)
    spans = clean.agg(
        F.min(cols.date).alias("first_date"), F.max(cols.date).alias("last_date"),
        F.avg(length).alias("mean_length"), F.min(length).alias("min_length"), F.max(length).alias("max_length"),
    )
    span = spans.select(F.struct("*")).scalar()
    median = quantiles(clean, [], cols.text_length, {"median": 0.5}).scalar()
    summary = statistics.withColumns(
        {
            "retention_rate": retention,
            "error_rate": 100 - retention,
            "tier": F.when(retention.isNotNull(), tier),
            **{c: span[c] for c in ("first_date", "last_date", "mean_length", "min_length", "max_length")},
            "median_length": median,
        }
    )
    total = F.sum("count").over(_everything())
    ratings = clean.groupBy(cols.rating).agg(F.count(F.lit(1)).alias("count")).withColumn("pct", F.col("count") * 100.0 / total)
    groups = clean.groupBy(cols.group_name).agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), cols.group_name)
    return {"summary": summary, "groups": groups, "ratings": ratings.orderBy(F.desc(cols.rating))}


def _everything():
    """Window over a handful of aggregated rows (at most five ratings)."""
    from pyspark.sql import Window

    return Window.partitionBy()
