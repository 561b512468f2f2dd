"""Star schema: channel and date dimensions, message and image-detection facts."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemart.functions.dates import calendar_parts
from tidemart.operators.order import null_safe_join, running_index

PRODUCT_CLASSES = ("bottle", "container")
PERSON_CLASS = "person"


def channel_stats(stg: DataFrame) -> DataFrame:
    return stg.groupBy("channel_name", "channel_type").agg(
        F.min("post_date").alias("first_post_date"),
        F.max("post_date").alias("last_post_date"),
        F.count(F.lit(1)).alias("total_posts"),
        F.avg("view_count").alias("avg_views"),
    )


def dim_channels(stg: DataFrame) -> DataFrame:
    """Surrogate key by channel name, ties by type, nulls last; channels may be many, so no global window."""
    keyed = running_index(channel_stats(stg), [], ["channel_name", "channel_type"], "channel_key")
    return keyed.select(
        "channel_key", "channel_name", "channel_type", "first_post_date", "last_post_date", "total_posts", "avg_views"
    )


def dim_dates(stg: DataFrame, pad_names: bool = False) -> DataFrame:
    """One row per calendar day. A day is one row, so the un-partitioned window sees thousands of rows at most."""
    days = stg.select(F.to_date("post_date").alias("full_date")).distinct()
    key = F.row_number().over(W.orderBy(F.asc_nulls_last("full_date"))).cast("bigint")
    return days.select(key.alias("date_key"), "full_date", *[
        c.alias(name) for name, c in calendar_parts(F.col("full_date"), pad_names).items()
    ])


def fct_messages(stg: DataFrame, channels: DataFrame, dates: DataFrame) -> DataFrame:
    """Message grain. Joined on the channel name alone: a channel with two types gives two rows, and the
    uniqueness check reports it. No broadcast hint: the planner broadcasts a dimension while it is small."""
    return (
        stg.withColumn("full_date", F.to_date("post_date"))
        .join(channels.select("channel_name", "channel_key"), "channel_name", "left")
        .join(dates.select("full_date", "date_key"), "full_date", "left")
        .select(
            "message_id", "channel_key", "date_key", "message_text", "message_length", "view_count", "forward_count", "has_image"
        )
    )


def star(stg: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    channels, dates = dim_channels(stg), dim_dates(stg)
    return channels, dates, fct_messages(stg, channels, dates)


def image_categories(
    detections: DataFrame,
    keys: Iterable[str] = ("channel_name", "message_id"),
    products: Iterable[str] = PRODUCT_CLASSES,
    person: str = PERSON_CLASS,
) -> DataFrame:
    """One category per image from the set of classes found in it (combined map-side)."""
    name = F.col("detected_class")
    found = detections.groupBy(*keys).agg(
        F.coalesce(F.bool_or(name == person), F.lit(False)).alias("has_person"),
        F.coalesce(F.bool_or(name.isin(*products)), F.lit(False)).alias("has_product"),
    )
    category = (
        F.when(F.col("has_person") & F.col("has_product"), "promotional")
        .when(F.col("has_product"), "product_display")
        .when(F.col("has_person"), "lifestyle")
        .otherwise("other")
    )
    return found.select(*keys, category.alias("image_category"))


def classify_detections(detections: DataFrame, **options) -> DataFrame:
    """Every detection with its image's category."""
    keys = ["channel_name", "message_id"]
    return null_safe_join(detections, image_categories(detections, keys, **options), keys)


def fct_image_detections(detections: DataFrame, messages: DataFrame) -> DataFrame:
    """Detections with the message keys; an id that is not a number, or not loaded, keeps null keys.

    Ids that are not numbers would be one key of the join and so one task; they are spread over keys that no message has.
    """
    d = detections.withColumn("__id", F.col("message_id").try_cast("bigint")).drop("message_id")
    apart = F.col("__id").isNull()
    d = d.withColumns({"__apart": apart, "__key": F.when(apart, F.xxhash64(F.monotonically_increasing_id())).otherwise(F.col("__id"))})
    m = messages.select("message_id", "channel_key", "date_key", F.lit(False).alias("__apart"), F.col("message_id").alias("__key"))
    kept = ["message_id", "channel_key", "date_key", "detected_class", "confidence_score", "image_category"]
    return d.join(m, ["__apart", "__key"], "left").select(*kept)
