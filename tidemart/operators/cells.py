"""Nearest-neighbour search over an inverted-list index: k-means cells, the corpus written by cell, queries joined to cells.

Building: centres are fitted on a bounded sample, every corpus row is assigned to its nearest centre, and each cell's rows are
written to its own partition in blocks of at most `BLOCK_ROWS` vectors. A large cell is dealt over several tasks. With the
centres the index keeps every cell's size and radius.

Searching: queries stay a DataFrame. They are packed into large groups by their nearest cell; a group knows which cells any of its queries
has to visit, and the blocks of those cells stream past it (`vectors.stream_past`), where each query meets its own cells and keeps the k
best. So a vector of the corpus is sent once per group of queries, and a query never once per cell. Only the centres are shared with
tasks; their size is checked. An approximate search ends with each query's nearest cells. An exact one knows an upper bound from the
k-th distance found there and meets every cell whose centre is nearer than that bound plus the cell's radius: by the triangle
inequality no other cell can hold a nearer vector.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.operators.order import hash_order, head_per_group, sample_rows
from tidemart.operators.vectors import GROUP_ROWS, _id, group_rows, packed_rows, stream_past
from tidemart.session import materialize, new_shared_path

#: Vectors of a block of the corpus, and queries of a group at most.
BLOCK_ROWS, QUERY_ROWS = 1024, GROUP_ROWS
#: Rows of one cell that a writing task gets.
TASK_ROWS = 64 * BLOCK_ROWS
#: Sampled rows per centre; with the number of cells this bounds what the centres are fitted on.
SAMPLE_PER_CELL = 128
#: The centres are shared with every task, so they may take so many bytes.
CENTRE_BYTES = 256 << 20
#: Distances of queries to all centres that a task holds, in bytes.
VISIT_BYTES = 16 << 20


@dataclass(frozen=True)
class CellIndex:
    """Where an index is, its centres and radii, and the type of its ids."""

    spark: SparkSession
    folder: str
    centres: np.ndarray
    radii: np.ndarray
    id_type: T.DataType

    def blocks(self) -> DataFrame:
        schema = T.StructType([T.StructField("ids", T.ArrayType(self.id_type)), T.StructField("vectors", T.BinaryType()), T.StructField("cell", T.IntegerType())])
        return self.spark.read.schema(schema).parquet(f"{self.folder}/blocks")


def _distances(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Distances of points to centres, from one matrix product."""
    squares = (points * points).sum(1)[:, None] + (centres * centres).sum(1)[None, :] - 2.0 * (points @ centres.T)
    return np.sqrt(np.maximum(squares, 0.0))


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten(), np.float64).reshape(len(column), -1)


def _centres(points: DataFrame, cells: int, seed: int) -> np.ndarray:
    sample = points.withColumn("place", hash_order("id", seed)).orderBy("place").limit(cells * SAMPLE_PER_CELL)
    fitted = KMeans(k=cells, seed=seed, maxIter=10, initMode="random", featuresCol="point").fit(sample.select(array_to_vector("vector").alias("point")))
    return np.array(fitted.clusterCenters(), np.float64)


def build_index(corpus: DataFrame, folder: str | None = None, corpus_id: str = "vec_id", vector: str = "embedding", cells: int | None = None, seed: int = 42) -> CellIndex:
    """Write the index of all rows that have a vector; the number of cells is the square root of theirs unless given."""
    spark = corpus.sparkSession
    folder = folder or new_shared_path(spark, "cells")
    points = corpus.filter(F.col(vector).isNotNull()).select(_id(corpus, corpus_id).alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    facts = points.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("d")).first()
    cells = min(cells or max(1, round(facts["n"] ** 0.5)), max(facts["n"], 1))
    if cells * (facts["d"] or 1) * 8 > CENTRE_BYTES:
        raise ValueError(f"{cells} centres of {facts['d']} numbers are more than {CENTRE_BYTES} bytes; ask for fewer cells")
    centres = _centres(points, cells, seed) if facts["n"] else np.zeros((0, 0))
    shared = spark.sparkContext.broadcast(centres)

    def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                away = _distances(_matrix(batch.column(1)), shared.value)
                cell = away.argmin(1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(cell.astype(np.int32)), pa.array(away[np.arange(len(cell)), cell])], ["id", "vector", "cell", "away"]
                )

    kind = points.schema["id"].dataType.simpleString()
    rows = points.mapInArrow(assigned, f"id {kind}, vector array<double>, cell int, away double")
    rows = materialize(rows, "assigned")
    shared.unpersist()
    sizes = materialize(rows.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("away").alias("radius")), "cell_sizes")
    # one row per cell, as many as there are centres
    dealt = rows.join(F.broadcast(sizes.select("cell", "n")), "cell")
    salt = F.pmod(F.xxhash64("id"), F.ceil(F.col("n") / TASK_ROWS))
    dealt = dealt.withColumn("salt", salt).repartition("cell", "salt").sortWithinPartitions("cell", "salt").select("id", "vector", "cell")
    blocks = dealt.mapInArrow(_packed(BLOCK_ROWS), f"ids array<{kind}>, vectors binary, cell int")
    blocks.write.partitionBy("cell").parquet(f"{folder}/blocks")
    found = {row["cell"]: row["radius"] for row in sizes.collect()}
    radii = np.array([found.get(cell, -1.0) for cell in range(len(centres))])
    table = [(cell, centre.tolist(), float(radius)) for cell, (centre, radius) in enumerate(zip(centres, radii, strict=True))]
    spark.createDataFrame(table, "cell int, centre array<double>, radius double").coalesce(1).write.parquet(f"{folder}/cells")
    return CellIndex(spark, folder, centres, radii, points.schema["id"].dataType)


def open_index(spark: SparkSession, folder: str) -> CellIndex:
    """An index that was written before."""
    rows = spark.read.parquet(f"{folder}/cells").orderBy("cell").collect()
    ids = spark.read.parquet(f"{folder}/blocks").schema["ids"].dataType.elementType if rows else T.LongType()
    return CellIndex(spark, folder, np.array([row["centre"] for row in rows], np.float64), np.array([row["radius"] for row in rows]), ids)


def _packed(size: int):
    """Blocks of the ids and vectors of rows (id, vector, cell) that arrive cell by cell."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[pa.Array, np.ndarray]] = []
        cell, count = None, 0

        def block() -> pa.RecordBatch:
            ids = pa.concat_arrays([one for one, _ in held])
            vectors = np.concatenate([points for _, points in held])
            return pa.RecordBatch.from_arrays(
                [pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids), pa.array([vectors.tobytes()], pa.binary()), pa.array([cell], pa.int32())], ["ids", "vectors", "cell"]
            )

        for batch in batches:
            cells = np.asarray(batch.column(2))
            edges = np.flatnonzero(np.diff(cells, prepend=cells[:1] - 1)).tolist() + [len(cells)]
            for start, end in zip(edges[:-1], edges[1:], strict=True):
                while start < end:
                    if held and (cells[start] != cell or count == size):
                        yield block()
                        held, count = [], 0
                    cell = int(cells[start])
                    take = min(end - start, size - count)
                    held.append((batch.column(0).slice(start, take), _matrix(batch.column(1).slice(start, take))))
                    count += take
                    start += take
        if held:
            yield block()

    return pack


def _homes(index: CellIndex, queries: DataFrame) -> DataFrame:
    """(id, vector, home): each query with its nearest cell, which queries are grouped by."""
    shared = index.spark.sparkContext.broadcast((index.centres, index.radii))
    kind = queries.schema["id"].dataType.simpleString()

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres, radii = shared.value
        for batch in batches:
            if batch.num_rows and len(centres):
                away = _distances(_matrix(batch.column(1)), centres)
                away[:, radii < 0] = np.inf  # empty cells
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(away.argmin(1).astype(np.int32))], ["id", "vector", "home"])

    return queries.mapInArrow(placed, f"id {kind}, vector array<double>, home int")


def _meet(index: CellIndex, queries: DataFrame, k: int, nearest: int | None = None) -> DataFrame:
    """(q, c, distance) of the k best of every query (id, vector, home) in its `nearest` cells, or in all that its column `bound` (a distance) reaches."""
    kind = queries.schema["id"].dataType.simpleString()
    shared = index.spark.sparkContext.broadcast((index.centres, index.radii))
    far = lambda distance: distance * (1 + 1e-9) + 1e-9

    def with_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres, radii = shared.value
        rows = max(1, VISIT_BYTES // (8 * max(1, len(centres))))
        for batch in batches:
            for i in range(batch.num_rows):
                points = np.frombuffer(batch.column(1)[i].as_py()).reshape(len(batch.column(0)[i]), -1)
                bounds = np.frombuffer(batch.column(2)[i].as_py())
                cells, reach = np.zeros(len(centres), bool), []
                for start in range(0, len(points), rows):
                    away = _distances(points[start : start + rows], centres)
                    away[:, radii < 0] = np.inf  # empty cells
                    if nearest is None:
                        near = away - radii[None, :] <= far(bounds[start : start + rows, None])
                    else:
                        reach.append(np.partition(away, min(nearest, len(centres)) - 1, axis=1)[:, min(nearest, len(centres)) - 1])
                        near = away <= far(reach[-1][:, None])
                    cells |= (near & np.isfinite(away)).any(0)
                reach = pa.array([np.concatenate(reach).tobytes() if reach else b""], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [*batch.slice(i, 1).columns, reach, pa.array([np.flatnonzero(cells).tolist()], pa.list_(pa.int32()))], ["ids", "vectors", "bounds", "reach", "cells"]
                )

    def helped(points: np.ndarray, limits: np.ndarray, reach: np.ndarray, cell: int) -> np.ndarray:
        centres, radii = shared.value
        away = _distances(points, centres[[cell]])[:, 0]
        return away <= far(reach) if len(reach) else away - radii[cell] <= far(np.sqrt(limits))

    size = min(QUERY_ROWS, group_rows(index.centres.shape[1]))
    groups = queries.repartitionByRange(max(1, -(-queries.count() // size)), "home", "id").select("id", "vector", *([] if nearest else ["bound"]))
    packed = groups.mapInArrow(packed_rows(size), f"ids array<{kind}>, vectors binary, bounds binary")
    packed = packed.mapInArrow(with_cells, f"ids array<{kind}>, vectors binary, bounds binary, reach binary, cells array<int>")
    packed = materialize(packed.withColumn("grp", F.monotonically_increasing_id()), "groups")
    blocks = packed.select("grp", F.explode("cells").alias("cell")).join(index.blocks(), "cell")
    return stream_past(packed, blocks, k, helped)


def search(
    index: CellIndex, queries: DataFrame, k: int = 5, query_id: str = "query_id", corpus_id: str = "vec_id", vector: str = "embedding",
    cells: int = 8, exact: bool = False, exclude_self: bool = False,
) -> DataFrame:
    """(query_id, corpus_id, distance, rank) of the k nearest (squared L2, ties by id) among each query's `cells` nearest cells,
    or with `exact` among all rows. Query ids are unique; queries without a vector have no rows. `exclude_self` leaves out the row with the query's own id."""
    asked = queries.filter(F.col(vector).isNotNull()).select(_id(queries, query_id).alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    asked = materialize(_homes(index, asked), "queries")
    want = k + 1 if exclude_self else k
    found = head_per_group(_meet(index, asked, want, cells), ["q"], ["distance", "c"], want)
    if exact and len(index.centres) > cells:
        last = found.groupBy("q").agg(F.when(F.count(F.lit(1)) >= want, F.sqrt(F.max("distance"))).alias("bound"))
        bounded = asked.join(last.withColumnRenamed("q", "id"), "id", "left").withColumn("bound", F.coalesce("bound", F.lit(float("inf"))))
        found = _meet(index, materialize(bounded, "bounded"), want)
    if exclude_self:
        found = found.filter(F.col("q") != F.col("c"))
    top = head_per_group(found, ["q"], ["distance", "c"], k, "rank")
    return top.select(F.col("q").alias(query_id), F.col("c").alias(corpus_id), "distance", "rank")


def recall(found: DataFrame, exact: DataFrame, query_id: str = "query_id", corpus_id: str = "vec_id") -> DataFrame:
    """(wanted, hit, recall) of a search against the exact neighbours."""
    hits = exact.select(query_id, corpus_id).join(found.select(query_id, corpus_id, F.lit(1).alias("hit")), [query_id, corpus_id], "left")
    counts = hits.agg(F.count(F.lit(1)).alias("wanted"), F.count("hit").alias("hit"))
    return counts.withColumn("recall", F.try_divide("hit", "wanted"))


def cells_for_recall(index: CellIndex, queries: DataFrame, k: int = 5, target: float = 0.95, query_id: str = "query_id", vector: str = "embedding", sample: int = 256, start: int = 4) -> int:
    """The first of `start`, twice that and so on cells a query with which `sample` of the queries reach the recall asked for.

    The sample is taken by hash and answered exactly through the index itself.
    """
    some = sample_rows(queries.filter(F.col(vector).isNotNull()).select(query_id, vector), query_id, sample)
    some = materialize(some, "calibration")
    wanted = materialize(search(index, some, k, query_id, "c", vector, exact=True), "calibration")
    cells = start
    while cells < len(index.centres):
        reached = recall(search(index, some, k, query_id, "c", vector, cells=cells), wanted, query_id, "c").first()["recall"]
        if reached is None or reached >= target:
            break
        cells *= 2
    return min(cells, max(len(index.centres), 1))
