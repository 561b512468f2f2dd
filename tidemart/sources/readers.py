"""Typed readers."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.functions import text
from tidemart.operators.cleaning import nan_to_null

# Both namings of the landing files: the scraper's and the loader's.
LANDING_SCHEMA = (
    "message_id bigint, channel_name string, channel_type string, message_text string, post_date string, message_date string, "
    "view_count int, views int, forward_count int, forwards int, has_media boolean, image_url string, image_path string"
)
DETECTION_SCHEMA = "channel_name string, message_id string, detected_class string, confidence_score double, image_category string"
REVIEW_SCHEMA = (
    "review_id string, review_text string, rating int, review_date string, user_name string, thumbs_up int, "
    "reply_content string, bank_code string, bank_name string, app_id string, source string"
)
TRANSACTION_SCHEMA = (
    "TransactionId string, BatchId string, AccountId string, SubscriptionId string, CustomerId string, CurrencyCode string, "
    "CountryCode int, ProviderId string, ProductId string, ProductCategory string, ChannelId string, Amount double, "
    "Value int, TransactionStartTime string, PricingStrategy int"
)
IMAGE_PATTERN = r"(?i)\.(jpg|jpeg|png)$"


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def read_landing(spark: SparkSession, folder: str, scrape_date: str | None = None, with_origin: bool = False) -> DataFrame:
    """All `.json` array files below `folder`; keys a file lacks are null.

    `scrape_date` reads only that date's subfolder. `with_origin` adds file path and place in the
    file, the explicit order behind "the first record of a key wins".
    """
    root = f"{folder}/{scrape_date}" if scrape_date else folder
    options = {"multiLine": True, "recursiveFileLookup": True, "pathGlobFilter": "*.json"}
    df = spark.read.schema(LANDING_SCHEMA).options(**options).json(root)
    if not with_origin:
        return df
    return df.select("*", F.col("_metadata.file_path").alias("origin_file"), F.monotonically_increasing_id().alias("origin_place"))


def read_csv(spark: SparkSession, path: str, schema: str | T.StructType | None = None, multi_line: bool = False) -> DataFrame | None:
    """CSV with a header, NaN read as null. None when the path does not exist.

    A file is split into many partitions; `multi_line` allows quoted cells that span lines and reads each file in one task.
    """
    if not path_exists(spark, path):
        return None
    reader = spark.read.options(header=True, multiLine=multi_line, escape='"')
    return nan_to_null((reader.schema(schema) if schema else reader.option("inferSchema", True)).csv(path))


def read_embeddings(spark: SparkSession, path: str, id_col: str, vector_col: str = "embeddings", columns: Sequence[str] = ()) -> DataFrame:
    """Vector table, only the columns asked for; vectors as array<float>."""
    return nan_to_null(spark.read.parquet(path).select(id_col, *columns, F.col(vector_col).cast("array<float>").alias(vector_col)))


def list_images(spark: SparkSession, folder: str) -> DataFrame:
    """channel_name (folder), message_id (file stem) and path of every jpg / jpeg / png; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path")
    path = F.col("path")
    return files.filter(path.rlike(IMAGE_PATTERN)).select(
        text.parent_path_part(path).alias("channel_name"), text.file_stem(path).alias("message_id"), "path"
    )


def read_table(spark: SparkSession, name: str, jdbc_options: dict[str, str] | None = None) -> DataFrame:
    """A catalog table, a parquet folder, or a JDBC table (pass partitionColumn / bounds to read it in parallel)."""
    if jdbc_options:
        return nan_to_null(spark.read.format("jdbc").options(dbtable=name, **jdbc_options).load())
    return nan_to_null(spark.read.parquet(name) if "/" in name else spark.table(name))


def normalise_reviews(raw: DataFrame, sources: DataFrame, code_col: str = "bank_code") -> DataFrame:
    """Store records to the review table's columns, defaults for absent fields, the name from `sources`.

    `sources` is the configured (code, name) list, which every task gets, so records are not shuffled by their few codes. Columns the record lacks count as null.
    """
    def field(name: str, default=None, kind: str = "string"):
        value = F.col(name) if name in raw.columns else F.lit(None)
        value = value.cast(kind)
        return value if default is None else F.coalesce(value, default if not isinstance(default, (str, int)) else F.lit(default))

    shaped = raw.select(
        field("reviewId", "").alias("review_id"),
        field("content", "").alias("review_text"),
        field("score", 0, "int").alias("rating"),
        field("at", F.current_timestamp(), "timestamp").alias("review_date"),
        field("userName", "Anonymous").alias("user_name"),
        field("thumbsUpCount", 0, "int").alias("thumbs_up"),
        field("replyContent").alias("reply_content"),
        F.col(code_col).alias("bank_code"),
        field("reviewCreatedVersion", "N/A").alias("app_id"),
        F.lit("Google Play").alias("source"),
    )
    names = sources.select("bank_code", "bank_name")
    return shaped.join(F.broadcast(names), "bank_code", "left").select(
        "review_id", "review_text", "rating", "review_date", "user_name", "thumbs_up", "reply_content",
        "bank_code", "bank_name", "app_id", "source",
    )


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    """Union by name of batches that may lack some columns."""
    frames = list(frames)
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def read_preferred(spark: SparkSession, processed: str, raw: str, prepare, side: str | None = None, schema=None, multi_line: bool = True) -> DataFrame | None:
    """The processed CSV if it exists, else `prepare(raw frame, side frame or None)`.

    Cells of these files may span lines (this library's own writer keeps them); without such cells `multi_line=False` reads in parallel.
    """
    if path_exists(spark, processed):
        return read_csv(spark, processed, multi_line=multi_line)
    df = read_csv(spark, raw, schema, multi_line)
    if df is None:
        return None
    return prepare(df, read_csv(spark, side, multi_line=multi_line) if side else None)


def table_exists(spark: SparkSession, name: str) -> bool:
    try:
        return path_exists(spark, name) if "/" in name else spark.catalog.tableExists(name)
    except AnalysisException:
        return False
