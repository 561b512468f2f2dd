"""Incremental load of the landing folder: only new files, first row of a key wins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.plans.staging import normalise_messages
from tidemart.sources.readers import LANDING_SCHEMA
from tidemart.sources.writers import TableFolder, insert_if_absent

ORIGIN = ["origin_file", "origin_place"]


def landing_stream(spark: SparkSession, folder: str, max_files: int = 1000) -> DataFrame:
    options = {"multiLine": True, "recursiveFileLookup": True, "pathGlobFilter": "*.json", "maxFilesPerTrigger": max_files}
    files = spark.readStream.schema(LANDING_SCHEMA).options(**options).json(folder)
    return files.select("*", F.col("_metadata.file_path").alias("origin_file"))


def load_new_files(
    spark: SparkSession,
    folder: str,
    target: TableFolder,
    checkpoint: str,
    key: Sequence[str] = ("message_id",),
    max_files: int = 1000,
) -> None:
    """Drain the files not seen yet, then stop. Keys already stored are the state, so no watermark is
    needed, and a batch that is replayed after a failure inserts nothing twice."""

    def merge(batch: DataFrame, _: int) -> None:
        placed = batch.withColumn("origin_place", F.monotonically_increasing_id())
        insert_if_absent(target, normalise_messages(placed, ORIGIN), key, ORIGIN)

    query = (
        landing_stream(spark, folder, max_files)
        .writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
