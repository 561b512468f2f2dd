"""Raw channel messages to the staging model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.session import spread

# Target column -> spellings accepted, first present non-null value wins.
MESSAGE_FIELDS = {
    "message_id": ("bigint", ("message_id",)),
    "channel_name": ("string", ("channel_name", "channel_url")),
    "channel_type": ("string", ("channel_type",)),
    "message_text": ("string", ("message_text",)),
    "post_date": ("timestamp", ("post_date", "message_date")),
    "view_count": ("int", ("view_count", "views")),
    "forward_count": ("int", ("forward_count", "forwards")),
    "image_url": ("string", ("image_url", "image_path")),
}


def normalise_messages(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Scraped records to the raw table's columns; either naming of the scraper and the loader is read.

    `keep` passes further columns through, such as the record's file and place.
    """
    columns = []
    for target, (kind, spellings) in MESSAGE_FIELDS.items():
        present = [F.col(c) for c in spellings if c in raw.columns]
        value = F.coalesce(*present) if present else F.lit(None)
        if target == "channel_name":
            value = F.element_at(F.split(value.cast("string"), "/"), -1)
        columns.append(value.cast(kind).alias(target))
    return raw.select(*columns, *keep)


def staging_messages(messages: DataFrame) -> DataFrame:
    """Typed rows with non-empty text; casts are strict, so a bad date fails the load."""
    return (
        spread(messages).select(
            "message_id",
            "channel_name",
            "channel_type",
            "message_text",
            F.col("post_date").cast("timestamp").alias("post_date"),
            F.col("view_count").cast("int").alias("view_count"),
            F.col("forward_count").cast("int").alias("forward_count"),
            "image_url",
        )
        .filter(F.col("message_text").isNotNull() & (F.col("message_text") != ""))
        .withColumns(
            {
                "message_length": F.length("message_text"),
                "has_image": F.coalesce("image_url", F.lit("")) != "",
            }
        )
    )
