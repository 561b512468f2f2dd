"""Session defaults and the shared folder for cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
}

SPREAD_BYTES = 1 << 30
#: Rows of a task of a model fit, which keeps them in memory in every round.
FIT_ROWS = 250_000

#: Deletes the shuffle files of a query when it ends.
SHUFFLES_END = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_local_dirs: dict[str, str] = {}
#: Folders of the frames that `materialize`, `written` and `dealt_on_disk` returned.
_folders: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def build_session(app: str = "tidemart", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: `spark.checkpoint.dir`, or a temp folder in local mode only."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the whole cluster")
    app = context.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="tidemart-")
    return _local_dirs[app]


def new_shared_path(spark: SparkSession, tag: str) -> str:
    return f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{tag}-{uuid.uuid4().hex}"


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def drop_materialized(spark: SparkSession) -> None:
    """Delete what this application has written to the shared folder; call it when its frames are done with."""
    _delete(spark, f"{shared_dir(spark)}/{spark.sparkContext.applicationId}")


def drop_cut(df: DataFrame) -> None:
    """Delete the folder of a frame that `materialize`, `written` or `dealt_on_disk` returned; nothing may read it any more."""
    folder = _folders.pop(df, None)
    if folder:
        _delete(df.sparkSession, folder)


@contextmanager
def settings(spark: SparkSession, **conf: object) -> Iterator[None]:
    """Session settings (`__` stands for a point) for the queries run inside."""
    names = {key.replace("__", "."): str(value) for key, value in conf.items()}
    before = {key: spark.conf.get(key, None) for key in names}
    try:
        for key, value in names.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def short_lived_shuffles(spark: SparkSession):
    """Inside, a query's shuffle files go when it ends, not when the driver next collects garbage: for steps that write what they make."""
    return settings(spark, **{SHUFFLES_END: "true"})


def materialize(df: DataFrame, tag: str = "cut") -> DataFrame:
    """Write `df` once to the shared folder and read it back.

    Survives lost executors (unlike a local checkpoint), is computed once however often the
    result is used, and stays a columnar scan with pruning and pushdown (unlike an RDD checkpoint).
    """
    spark = df.sparkSession
    path = new_shared_path(spark, tag)
    df.write.parquet(path)
    return _kept(spark.read.schema(df.schema).parquet(path), path)


def _kept(df: DataFrame, folder: str) -> DataFrame:
    _folders[df] = folder
    return df


def written(parts: Iterable[DataFrame], tag: str = "cut") -> DataFrame:
    """The parts of one frame, written one after the other: what a part shuffles is gone before the next. Smaller files than `materialize` makes, for more work."""
    path, df = None, None
    for df in parts:
        path = path or new_shared_path(df.sparkSession, tag)
        with short_lived_shuffles(df.sparkSession):
            df.write.mode("append").option("compression", "zstd").parquet(path)
    return _kept(df.sparkSession.read.schema(df.schema).parquet(path), path)


def dealt_on_disk(parts: Iterable[DataFrame], by: Sequence[str], tasks: int, tag: str = "cut") -> DataFrame:
    """The same, dealt by the columns `by` into as many buckets as `tasks`: queries that want them dealt so read the files as they are, without a shuffle."""
    name, path, df = f"tidemart_{uuid.uuid4().hex}", None, None
    for df in parts:
        path = path or new_shared_path(df.sparkSession, tag)
        with short_lived_shuffles(df.sparkSession):
            df.write.mode("append").format("parquet").option("compression", "zstd").option("path", path).bucketBy(tasks, *by).saveAsTable(name)
    out = df.sparkSession.table(name)
    df.sparkSession.sql(f"DROP TABLE {name}")  # the name: `out` has found the files, which stay
    return _kept(out, path)


def spread(df: DataFrame) -> DataFrame:
    """Use every core on a small input that arrives in few files.

    Only when the optimizer's size estimate says that most cores would get no scan partition, and
    never above 1 GiB: a large input already has many partitions and is left alone.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    per_task = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return df.repartition(cores) if int(str(size)) < min(cores * per_task // 4, SPREAD_BYTES) else df


def dealt_for_fit(df: DataFrame, rows: int | None = None) -> DataFrame:
    """`df` in partitions of at most about `FIT_ROWS` rows: a fit keeps its input by partition, and one file split may hold many millions of narrow rows."""
    per_task = rows or FIT_ROWS
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // per_task)))
