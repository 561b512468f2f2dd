"""Sinks: files, keyed merges into a versioned table folder, views and exports."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.functions.dates import parse_timestamp
from tidemart.operators.order import first_per_key, running_index
from tidemart.session import materialize
from tidemart.sources.readers import path_exists


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Header CSV, quotes doubled; parent folders are made by the file system."""
    df.write.mode(mode).options(header=True, escape='"').csv(path)


def write_metrics(spark: SparkSession, metrics: dict, path: str) -> None:
    """A small metrics mapping as one JSON line."""
    spark.createDataFrame([(json.dumps(metrics),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def parts_of(df: DataFrame, key: str) -> Column:
    """A hash of the key that cuts a hot partition of files into as many tasks as the session shuffles to."""
    return F.pmod(F.xxhash64(key), F.lit(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))


def write_landing(df: DataFrame, folder: str, dry_run: bool = False) -> DataFrame:
    """JSON partitioned by scrape_date and channel_name; a dry run returns the plan without writing."""
    if not dry_run:
        df.repartition("scrape_date", "channel_name", parts_of(df, "message_id")).write.mode("append").partitionBy(
            "scrape_date", "channel_name"
        ).json(folder)
    return df


class TableFolder:
    """A parquet table whose versions are sibling folders; a pointer file names the current one.

    A rewrite never touches the folder being read, and readers keep the version they opened.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str | T.StructType):
        self.spark, self.path = spark, path.rstrip("/")
        self.schema = T._parse_datatype_string(schema) if isinstance(schema, str) else schema

    def _fs(self):
        jvm = self.spark._jvm
        return jvm.org.apache.hadoop.fs.Path(self.path).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _hpath(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    def version(self) -> int:
        """The highest complete version; each holds Spark's own _SUCCESS marker."""
        if not path_exists(self.spark, self.path):
            return 0
        names = [s.getPath().getName() for s in self._fs().listStatus(self.spark._jvm.org.apache.hadoop.fs.Path(self.path))]
        done = [int(n[1:]) for n in names if n[:1] == "v" and n[1:].isdigit() and self._fs().exists(self._hpath(f"{n}/_SUCCESS"))]
        return max(done, default=0)

    def read(self) -> DataFrame:
        current = self.version()
        if not current:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/v{current}")

    def _shape(self, rows: DataFrame) -> DataFrame:
        return rows.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields])

    def replace(self, rows: DataFrame) -> None:
        self._shape(rows).write.mode("overwrite").parquet(f"{self.path}/v{self.version() + 1}")

    def append(self, rows: DataFrame) -> None:
        """Plain append into the current version (no key, re-runs add the rows again)."""
        self._shape(rows).write.mode("append").parquet(f"{self.path}/v{max(self.version(), 1)}")


def check_key(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """Raise at run time for a null key column, as a primary key does."""
    bad = F.lit(False)
    for k in key:
        bad = bad | F.col(k).isNull()
    message = F.lit(f"null in key ({', '.join(key)})")
    return rows.withColumn(key[0], F.when(bad, F.raise_error(message).cast(rows.schema[key[0]].dataType)).otherwise(F.col(key[0])))


def new_rows(existing: DataFrame, incoming: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Incoming rows whose key is not stored yet, the first by `order` where a key repeats."""
    # The stored keys are only scanned when the batch is small enough to broadcast: they are cut to the
    # batch's keys first, and the anti join is between two batch-sized sides.
    keys = list(key)
    stored = existing.select(*keys).join(incoming.select(*keys).distinct(), keys, "left_semi").distinct()
    return first_per_key(incoming.join(stored, keys, "left_anti"), keys, order)


def insert_if_absent(target: TableFolder, incoming: DataFrame, key: Sequence[str] = ("message_id",), order: Sequence[str] = ()) -> None:
    """Keyed insert, stored rows win, first incoming row wins; re-runs change nothing. Null keys are rejected."""
    batch = materialize(check_key(incoming, key), "batch")
    target.append(new_rows(target.read(), batch, key, list(order) or [c for c in incoming.columns if c not in key]))


def last_by_key(rows: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The last row of each non-null key; rows without a key all stay."""
    flipped = [o[1:] if o.startswith("-") else f"-{o}" for o in order]
    return first_per_key(rows.filter(F.col(key).isNotNull()), [key], flipped).unionByName(rows.filter(F.col(key).isNull()))


def merged(existing: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """Stored rows without a newer version, plus all incoming ones; a null key never matches."""
    return existing.join(incoming.select(key), key, "left_anti").unionByName(incoming)


def upsert(target: TableFolder, incoming: DataFrame, key: str, order: Sequence[str]) -> int:
    """Update or insert all columns by key, the last incoming row by `order` wins; returns rows attempted."""
    batch = materialize(incoming, "batch")
    target.replace(merged(target.read(), target._shape(last_by_key(batch, key, order)), key))
    return batch.count()


def shape_reviews(df: DataFrame, banks: DataFrame) -> DataFrame:
    """Reviews with the parent's id: own id preferred over the CSV's, bad dates null, unknown bank null."""
    present = {c: F.col(c) if c in df.columns else F.lit(None) for c in (
        "orig_review_id", "review_id", "bank_name", "review_text", "rating", "review_date", "sentiment_label", "sentiment_score", "source",
    )}
    kinds = {"rating": "int", "sentiment_score": "double"}
    shaped = df.select(
        F.coalesce(present["orig_review_id"].cast("string"), present["review_id"].cast("string")).alias("orig_review_id"),
        present["bank_name"].cast("string").alias("bank_name"),
        F.to_date(parse_timestamp(present["review_date"])).alias("review_date"),
        *[present[c].cast(kinds.get(c, "string")).alias(c) for c in ("review_text", "rating", "sentiment_label", "sentiment_score", "source")],
    )
    return shaped.join(banks.select("bank_name", "bank_id"), "bank_name", "left").drop("bank_name")


def with_new_ids(existing: DataFrame, incoming: DataFrame, id_col: str, order: Sequence[str]) -> DataFrame:
    """Serial ids after the largest stored one, dense and in `order`."""
    start = existing.agg(F.coalesce(F.max(id_col), F.lit(0))).scalar()
    numbered = running_index(incoming, [], order, id_col)
    return numbered.withColumn(id_col, F.col(id_col) + start)


def register_banks(target: TableFolder, names: DataFrame) -> DataFrame:
    """Distinct non-empty names get an id unless stored; returns the whole (bank_id, bank_name) table."""
    distinct = names.filter(F.col("bank_name").isNotNull() & (F.col("bank_name") != "")).select("bank_name").distinct()
    stored = target.read()
    target.append(with_new_ids(stored, distinct.join(stored, "bank_name", "left_anti"), "bank_id", ["bank_name"]))
    return target.read()


def create_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def create_table(df: DataFrame, name: str) -> None:
    df.write.mode("overwrite").saveAsTable(name)


def insert_statements(df: DataFrame, name: str) -> DataFrame:
    """One INSERT statement per row: null as NULL, numbers bare, everything else quoted with ' doubled."""
    cells = []
    for f in df.schema.fields:
        value = F.col(f"`{f.name}`").cast("string")
        if not isinstance(f.dataType, T.NumericType):
            value = F.concat(F.lit("'"), F.replace(value, F.lit("'"), F.lit("''")), F.lit("'"))
        cells.append(F.coalesce(value, F.lit("NULL")))
    return df.select(F.concat(F.lit(f"INSERT INTO {name} VALUES ("), F.concat_ws(", ", *cells), F.lit(");")).alias("statement"))


def export_statements(tables: dict[str, DataFrame], folder: str) -> None:
    for name, df in tables.items():
        insert_statements(df, name).write.mode("overwrite").text(f"{folder}/{name}.sql", lineSep="\n")


def write_collection(chunks: DataFrame, path: str, mode: str = "append", rows_per_file: int = 1_000_000) -> None:
    """Chunk id, vector, metadata and text, partitioned by product; a hot product is spread over many files."""
    spread = chunks.repartition("product", parts_of(chunks, "chunk_id"))
    spread.write.mode(mode).option("maxRecordsPerFile", rows_per_file).partitionBy("product").parquet(path)
