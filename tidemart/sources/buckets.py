"""Keyed merges into plain Parquet that is partitioned by a hash of the key: only buckets that change are written.

A merge finds the incoming rows that are new or differ from what is stored, reads the buckets that these fall into, and replaces
exactly those partitions (dynamic partition overwrite). All other files stay as they are, and a batch that comes again writes
nothing. The number of buckets is chosen once per table, so that a bucket is what one task can rewrite.

One writer at a time; a reader that listed a bucket's files before it was replaced has to list them again. Rows without a key
never meet a stored one: they are all added, as a unique column in a database allows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.operators.order import first_per_key
from tidemart.session import materialize
from tidemart.sources.readers import path_exists
from tidemart.sources.writers import check_key

BUCKET = "__bucket"


@dataclass(frozen=True)
class BucketTable:
    """A folder, the columns and the key of its rows, and how many buckets it has."""

    spark: SparkSession
    path: str
    schema: T.StructType
    key: tuple[str, ...]
    buckets: int = 64

    def read(self) -> DataFrame:
        return self._stored().drop(BUCKET)

    def _stored(self) -> DataFrame:
        schema = T.StructType([*self.schema.fields, T.StructField(BUCKET, T.IntegerType())])
        if not path_exists(self.spark, self.path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.path)

    def files(self) -> DataFrame:
        """(bucket, file, size, modified) of the stored files, one row each."""
        if not path_exists(self.spark, self.path):
            return self.spark.createDataFrame([], "bucket int, file string, size long, modified timestamp")
        stored = self._stored().select(F.col(BUCKET).alias("bucket"), "_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time")
        return stored.distinct().toDF("bucket", "file", "size", "modified")

    def _placed(self, rows: DataFrame) -> DataFrame:
        """Rows in the table's columns with their bucket; those without a key are spread by all their columns."""
        shaped = rows.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields])
        keyless = self._keyless()
        seed = F.when(keyless, F.xxhash64(*shaped.columns)).otherwise(F.xxhash64(*self.key))
        return shaped.withColumn(BUCKET, F.pmod(seed, F.lit(self.buckets)).cast("int"))

    def _keyless(self) -> Column:
        out = F.lit(False)
        for name in self.key:
            out = out | F.col(name).isNull()
        return out

    def _replace(self, changed: DataFrame, stay: DataFrame) -> int:
        """Write the rows of the changed buckets: the stored ones that stay and the changed ones. Returns the number of buckets."""
        touched = [row[BUCKET] for row in changed.select(BUCKET).distinct().collect()]  # at most as many as there are buckets
        if touched:
            kept = stay.filter(F.col(BUCKET).isin(touched))
            whole = materialize(kept.unionByName(changed), "buckets")
            # as many tasks as buckets, each bucket in one file
            whole.repartition(len(touched), BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(self.path)
        return len(touched)

    def upsert(self, incoming: DataFrame, order: Sequence[str]) -> int:
        """Update or insert all columns by key, the last incoming row by `order` wins. Returns the number of buckets written."""
        keys = list(self.key)
        flipped = [name[1:] if name.startswith("-") else f"-{name}" for name in order]
        last = first_per_key(incoming.filter(~self._keyless()), keys, flipped)
        batch = materialize(self._placed(last.unionByName(incoming.filter(self._keyless()))), "batch")
        stored = self._stored()
        # rows that are stored as they come change nothing; a set operation takes nulls as equal
        keyed = batch.filter(~self._keyless())
        same = keyed.join(stored.select(*keys, F.struct(*self.schema.names).alias("__old")), keys).filter(F.struct(*self.schema.names).eqNullSafe(F.col("__old")))
        fresh = keyed.join(same.select(*keys), keys, "left_anti").unionByName(batch.filter(self._keyless()))
        changed = materialize(fresh.select(batch.columns), "changed")
        return self._replace(changed, stored.join(changed.select(*keys), keys, "left_anti"))

    def insert_if_absent(self, incoming: DataFrame, order: Sequence[str]) -> int:
        """Insert rows whose key is not stored, the first incoming row by `order` wins; null keys are an error. Returns the buckets written."""
        keys = list(self.key)
        batch = materialize(self._placed(first_per_key(check_key(incoming, keys), keys, order)), "batch")
        stored = self._stored()
        changed = materialize(batch.join(stored.select(*keys), keys, "left_anti").select(batch.columns), "changed")
        return self._replace(changed, stored)
