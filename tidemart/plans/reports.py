"""Report queries over the star schema and the review store."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

IMAGE_CATEGORIES = ("promotional", "product_display", "lifestyle", "other")


def top_terms(messages: DataFrame, limit: int = 10) -> DataFrame:
    """Most frequent lower-cased, space-separated words that start with a Latin letter; ties by word."""
    words = messages.select(F.explode_outer(F.split(F.lower("message_text"), " ")).alias("product"))
    return (
        words.filter(F.col("product").rlike("^[a-zA-Z]+"))
        .groupBy("product")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), F.asc("product"))
        .limit(limit)
    )


def channel_activity(channels: DataFrame, channel_name: str) -> DataFrame:
    """Activity of one channel; no row means not found."""
    return channels.filter(F.col("channel_name") == channel_name).select(
        "channel_name", "total_posts", "avg_views", "first_post_date", "last_post_date"
    )


def search_messages(messages: DataFrame, channels: DataFrame, dates: DataFrame, query: str, limit: int = 20) -> DataFrame:
    """Case-insensitive substring search (`%` and `_` act as wildcards), lowest message ids first.

    The search and the limit run on the fact before the dimensions are joined.
    """
    hits = messages.filter(F.col("message_text").ilike(f"%{query}%"))
    top = hits.orderBy(F.asc_nulls_last("message_id"), F.asc_nulls_last("channel_key")).limit(limit)
    return (
        top.join(channels.select("channel_key", "channel_name"), "channel_key", "left")
        .join(dates.select("date_key", F.col("full_date").alias("post_date")), "date_key", "left")
        .select("message_id", "channel_name", "message_text", "post_date", "view_count", "forward_count", "has_image")
    )


def visual_content(detections: DataFrame) -> DataFrame:
    """Detections per channel and category (per detection, as stored)."""
    return detections.groupBy("channel_name").agg(
        *[F.sum(F.when(F.col("image_category") == c, 1).otherwise(0)).alias(f"{c}_count") for c in IMAGE_CATEGORIES]
    )


def visual_content_by_image(image_categories: DataFrame) -> DataFrame:
    """The same counts per image; takes one row per image."""
    return visual_content(image_categories)


def posting_volume(stg: DataFrame, grain: str = "day") -> DataFrame:
    """Posts per channel and day / week (weeks start on Monday)."""
    return stg.groupBy("channel_name", F.to_date(F.date_trunc(grain, "post_date")).alias("period")).agg(
        F.count(F.lit(1)).alias("posts")
    )


def visual_share(stg: DataFrame) -> DataFrame:
    share = F.avg(F.col("has_image").cast("double"))
    return stg.groupBy("channel_name").agg(F.count(F.lit(1)).alias("posts"), share.alias("image_share"))


def views_by_category(image_facts: DataFrame, messages: DataFrame) -> DataFrame:
    """Mean views of messages by the category of their image (each message and category once)."""
    pairs = image_facts.filter(F.col("message_id").isNotNull()).select("message_id", "image_category").distinct()
    return (
        pairs.join(messages.select("message_id", "view_count"), "message_id")
        .groupBy("image_category")
        .agg(F.count(F.lit(1)).alias("messages"), F.avg("view_count").alias("avg_views"))
    )


def _per_parent(parents: DataFrame, children: DataFrame, key: str, name: str, aggs: dict[str, Column]) -> DataFrame:
    """Children summed per key before the join, so a hot parent costs one row per map task."""
    summed = children.filter(F.col(key).isNotNull()).groupBy(key).agg(*[c.alias(n) for n, c in aggs.items()])
    joined = parents.select(key, name).join(summed, key, "left")
    return joined.groupBy(name).agg(*[F.sum(n).alias(n) for n in aggs])


def child_count(parents: DataFrame, children: DataFrame, key: str, name: str, child_id: str) -> DataFrame:
    counts = _per_parent(parents, children, key, name, {"n": F.count(child_id)})
    return counts.select(name, F.coalesce("n", F.lit(0)).alias("count")).orderBy(F.desc("count"), name)


def child_average(parents: DataFrame, children: DataFrame, key: str, name: str, value: str) -> DataFrame:
    """Average per parent, null for a parent without values, nulls last."""
    sums = _per_parent(parents, children, key, name, {"s": F.sum(F.col(value).cast("double")), "n": F.count(value)})
    mean = F.try_divide("s", "n")
    return sums.select(name, mean.alias("average")).orderBy(F.desc_nulls_last("average"), name)


def child_label_counts(parents: DataFrame, children: DataFrame, key: str, name: str, label: str, child_id: str) -> DataFrame:
    """Rows per parent and label; a null label, and a parent without children, shows as 'unknown'."""
    per_label = children.filter(F.col(key).isNotNull()).groupBy(key, label).agg(F.count(child_id).alias("n"))
    joined = parents.select(key, name).join(per_label, key, "left")
    return joined.groupBy(name, F.coalesce(label, F.lit("unknown")).alias("label")).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("count")
    )


def label_count_maps(counts: DataFrame, name: str) -> DataFrame:
    """Long label counts as one map per parent (labels are few by nature)."""
    entries = F.array_sort(F.collect_list(F.struct("label", "count")))
    return counts.groupBy(name).agg(F.map_from_entries(entries).alias("counts"))


def label_totals(children: DataFrame, label: str) -> DataFrame:
    """Global label counts; nulls appear as 'unknown' and once more as 'nulls' (0 when there is none)."""
    counts = children.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("count"))
    nulls = children.agg(F.lit("nulls").alias("label"), F.count_if(F.col(label).isNull()).alias("count"))
    return counts.select(F.coalesce("label", F.lit("unknown")).alias("label"), "count").unionByName(nulls)


def source_counts(sources: DataFrame, rows: DataFrame, key: str, name: str) -> DataFrame:
    """Collected rows per configured source, 0 for an empty one."""
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return sources.select(key, name).join(counts, key, "left").select(key, name, F.coalesce("n", F.lit(0)).alias("count"))
