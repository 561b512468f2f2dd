"""Exact nearest neighbours (squared L2) and what is made of them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.functions.text import shorten
from tidemart.operators.order import head_per_group
from tidemart.session import materialize

BLOCK_BYTES = 64 * 1024 * 1024
BATCH_BYTES = 32 * 1024 * 1024
#: Queries of a group, which a task holds while vectors stream past it (of at most `BLOCK_BYTES`), vectors of a block of that stream, and queries that meet a block at a time.
GROUP_ROWS, STREAM_ROWS, MEET_ROWS = 8192, 1024, 1024

PROMPT_HEAD = (
    "Answer the question about the messages below.\n"
    "Rely on the context alone, and say so when it does not hold the answer.\n\n"
    "Context:\n"
)


def _nearest(queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int, best: list, limit: np.ndarray | None = None) -> None:
    """Merge the k nearest of one batch into `best`, per query a (distances, ids) pair.

    With `limit`, a distance per query beyond which nothing is wanted, queries that find nothing within it are passed over; it follows the k-th distance.
    """
    squares = (queries * queries).sum(1)
    rough = (vectors * vectors).sum(1)[None, :] - 2.0 * (queries @ vectors.T)
    slack = 1e-9 * (1.0 + np.abs(rough).max(1) + squares)
    bound = np.full(len(queries), np.inf) if limit is None else limit - squares + slack
    for q in np.flatnonzero(rough.min(1) <= bound).tolist():
        row = rough[q]
        near = np.flatnonzero(row <= bound[q])
        if len(near) > k:
            near = near[row[near] <= np.partition(row[near], k - 1)[k - 1] + slack[q]]
        gap = vectors[near] - queries[q]
        found = np.concatenate([best[q][0], (gap * gap).sum(1)]), np.concatenate([best[q][1], ids[near]])
        first = np.lexsort((found[1], found[0]))[:k]
        best[q] = found[0][first], found[1][first]
        if limit is not None and len(first) == k:
            limit[q] = min(limit[q], found[0][first[-1]])


def _found(names: pa.Array, best: list, kind: str) -> pa.RecordBatch:
    """(q, c, distance) of what `best` holds; `kind` is the numpy type of the ids c."""
    counts = [len(one) for one, _ in best]
    return pa.RecordBatch.from_arrays(
        [names.take(pa.array(np.repeat(np.arange(len(best)), counts))), pa.array(np.concatenate([one for _, one in best]), pa.int64() if kind == "int64" else pa.string()), pa.array(np.concatenate([one for one, _ in best]))],
        ["q", "c", "distance"],
    )


def group_rows(width: int) -> int:
    """Queries of `width` numbers that one group holds."""
    return max(1, min(GROUP_ROWS, BLOCK_BYTES // (8 * max(1, width))))


def packed_rows(size: int):
    """One row (ids, vectors, bounds) for `size` rows (id, vector) or (id, vector, bound)."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def row() -> pa.RecordBatch:
            ids = pa.concat_arrays([part.column(0) for part in held])
            points, bounds = [b"".join(np.asarray(pick(part), np.float64).tobytes() for part in held) for pick in (lambda x: x.column(1).flatten(), lambda x: x.column(2) if x.num_columns > 2 else [])]
            return pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids), pa.array([points], pa.binary()), pa.array([bounds], pa.binary())], ["ids", "vectors", "bounds"])

        count = 0
        for batch in batches:
            start = 0
            while start < batch.num_rows:
                take = min(batch.num_rows - start, size - count)
                held.append(batch.slice(start, take))
                count, start = count + take, start + take
                if count == size:
                    yield row()
                    held, count = [], 0
        if held:
            yield row()

    return pack


def stream_past(asked: DataFrame, blocks: DataFrame, k: int, prune=None) -> DataFrame:
    """(q, c, distance): the k best of every query among the blocks that are sent to its group.

    `asked` has a row per group (grp, ids, vectors, bounds, reach), `blocks` a row per block and group it is meant for (grp, ids, vectors, cell). Rows are dealt by group and
    a salt and sorted so that a group's queries come first; a task holds one group and one batch of blocks, however many there are. `bounds` may be empty, or
    has a distance per query beyond which nothing is wanted. `prune`, a function of queries, their squared limits, their `reach` and a cell, says which of them meet a block of that cell.
    """
    spark = asked.sparkSession
    salts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) // max(1, asked.count()))
    q_type, c_type = asked.schema["ids"].dataType.elementType, blocks.schema["ids"].dataType.elementType
    c_kind = "int64" if isinstance(c_type, T.LongType) else "<U1"
    first = asked.select("grp", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"), F.lit(0).alias("kind"), F.col("ids").alias("asked"), "bounds", "reach", F.lit(None).cast(T.ArrayType(c_type)).alias("ids"), "vectors", F.lit(-1).alias("cell"))
    salt = F.pmod(F.xxhash64("ids"), F.lit(salts)).cast("int")
    then = blocks.select("grp", salt.alias("salt"), F.lit(1).alias("kind"), F.lit(None).cast(T.ArrayType(q_type)).alias("asked"), F.lit(None).cast("binary").alias("bounds"), F.lit(None).cast("binary").alias("reach"), "ids", "vectors", "cell")
    dealt = first.unionByName(then).repartition("grp", "salt").sortWithinPartitions("grp", "salt", "kind")

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = None
        for batch in batches:
            columns = {name: batch.column(place) for place, name in enumerate(batch.schema.names)}
            for i, kind in enumerate(columns["kind"].to_pylist()):
                points = np.frombuffer(columns["vectors"][i].as_py())
                if kind == 0:
                    if names is not None:
                        yield _found(names, best, c_kind)
                    names = columns["asked"][i].values
                    own = points.reshape(len(names), -1)
                    bounds = np.frombuffer(columns["bounds"][i].as_py())
                    reach = np.frombuffer(columns["reach"][i].as_py())
                    limit = np.square(bounds * (1 + 1e-9) + 1e-9) if len(bounds) else np.full(len(own), np.inf)
                    best = [(np.empty(0), np.empty(0, dtype=c_kind))] * len(own)
                    continue
                ids = np.array(columns["ids"][i].as_py())
                others = points.reshape(len(ids), -1)
                chosen = np.arange(len(own)) if prune is None else np.flatnonzero(prune(own, limit, reach, columns["cell"][i].as_py()))
                for start in range(0, len(chosen), MEET_ROWS):
                    some = chosen[start : start + MEET_ROWS]
                    mine, within = [best[q] for q in some], limit[some]
                    _nearest(own[some], ids, others, k, mine, within)
                    limit[some] = within
                    for q, one in zip(some.tolist(), mine, strict=True):
                        best[q] = one
        if names is not None:
            yield _found(names, best, c_kind)

    schema = T.StructType([T.StructField("q", q_type), T.StructField("c", c_type), T.StructField("distance", T.DoubleType())])
    return dealt.mapInArrow(met, schema)


def _id(df: DataFrame, column: str) -> Column:
    """Integer ids as long, all others as text."""
    return F.col(column).cast("bigint" if isinstance(df.schema[column].dataType, T.IntegralType) else "string")


def knn_join(queries: DataFrame, corpus: DataFrame, k: int = 5, query_id: str = "query_id", corpus_id: str = "vec_id", vector: str = "embedding", exclude_self: bool = False) -> DataFrame:
    """(query_id, corpus_id, distance, rank) of the k nearest corpus vectors of every query, ties by id.

    Up to a group of queries (see `group_rows`) travels to the tasks, which stream the unshuffled corpus past it. More of them are dealt into groups of that size, and
    the corpus, packed into blocks, is sent past every group (see `stream_past`): the work is queries times vectors, the memory of a task
    one group and one batch. Ids are integers or text and keep their type. `exclude_self` leaves out the corpus row with the query's own id.
    """
    spark = queries.sparkSession
    kept = queries.filter(F.col(vector).isNotNull()).select(_id(queries, query_id).alias("q"), F.col(vector).cast("array<double>").alias("v"))
    kept = materialize(kept, "queries")
    points = corpus.filter(F.col(vector).isNotNull()).select(_id(corpus, corpus_id).alias("c"), F.col(vector).cast("array<double>").alias("v"))
    id_type = points.schema["c"].dataType
    id_kind = "int64" if isinstance(id_type, T.LongType) else "<U1"
    schema = T.StructType([T.StructField("q", kept.schema["q"].dataType), T.StructField("c", id_type), T.StructField("distance", T.DoubleType())])
    facts = kept.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("d")).first()
    n, size = facts["n"], group_rows(facts["d"] or 1)
    want = k + 1 if exclude_self else k
    if not n:
        found = spark.createDataFrame([], schema)
    elif n <= size:
        rows = kept.toPandas()
        shared = spark.sparkContext.broadcast((rows["q"].to_numpy(), np.stack(rows["v"].to_numpy()).astype("float64")))
        batch_rows = max(1, BATCH_BYTES // (8 * n))

        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            names, matrix = shared.value
            best, limit = [(np.empty(0), np.empty(0, dtype=id_kind)) for _ in names], np.full(len(names), np.inf)
            for batch in batches:
                for start in range(0, batch.num_rows, batch_rows):
                    part = batch.slice(start, batch_rows)
                    _nearest(matrix, np.array(part.column(0).to_pylist()), np.asarray(part.column(1).flatten(), np.float64).reshape(part.num_rows, -1), want, best, limit)
            yield _found(pa.array(names), best, id_kind)

        found = points.mapInArrow(search, schema)
    else:
        pieces = lambda kind: f"ids array<{kind.simpleString()}>, vectors binary, bounds binary"
        asked = kept.repartition(-(-n // size)).mapInArrow(packed_rows(size), pieces(kept.schema["q"].dataType))
        asked = materialize(asked.withColumns({"grp": F.monotonically_increasing_id(), "reach": F.lit(b"")}), "groups")
        blocks = points.mapInArrow(packed_rows(STREAM_ROWS), pieces(id_type)).select("ids", "vectors", F.lit(-1).alias("cell"))
        found = stream_past(asked, blocks.crossJoin(F.broadcast(asked.select("grp"))), want)  # a row per group
    if exclude_self:
        found = found.filter("q <> c")
    top = head_per_group(found, ["q"], ["distance", "c"], k, "rank")
    return top.select(F.col("q").alias(query_id), F.col("c").alias(corpus_id), "distance", "rank")


def with_texts(neighbours: DataFrame, corpus: DataFrame, corpus_id: str, text_col: str) -> DataFrame:
    return neighbours.join(corpus.select(corpus_id, F.col(text_col).alias("text")), corpus_id)


def _by_rank() -> Column:
    return F.transform(F.array_sort(F.collect_list(F.struct("rank", "text"))), lambda x: x["text"])


def contexts(neighbours: DataFrame, questions: DataFrame, query_id: str = "query_id", question: str = "question", sources: int = 2, head: str = PROMPT_HEAD) -> DataFrame:
    """(query_id, question, prompt, sources): the k texts of a question as numbered excerpts in one prompt.

    A group here is the k neighbours of one question.
    """
    per = neighbours.groupBy(query_id).agg(_by_rank().alias("texts"))
    numbered = F.transform("texts", lambda t, i: F.concat(F.lit("Excerpt "), (i + 1).cast("string"), F.lit(": "), t))
    rows = questions.select(query_id, question).join(per, query_id, "left").withColumn("texts", F.coalesce("texts", F.array().cast("array<string>")))
    prompt = F.concat(F.lit(head), F.concat_ws("\n\n", numbered), F.lit("\n\nQuestion: "), F.col(question), F.lit("\n\nAnswer:"))
    return rows.select(query_id, question, prompt.alias("prompt"), F.slice("texts", 1, sources).alias("sources"))


def evaluation_table(asked: DataFrame, question: str = "question") -> DataFrame:
    """One row per question for human scoring: its sources, whole and shortened for display."""
    shown = F.transform("sources", lambda t, i: F.concat(F.lit("["), (i + 1).cast("string"), F.lit("] "), shorten(t)))
    return asked.select(
        F.col(question).alias("Question"),
        F.concat_ws(" || ", "sources").alias("Retrieved Sources"),
        F.when(F.size("sources") == 0, "None").otherwise(F.concat_ws(" | ", shown)).alias("Sources Shown"),
        F.lit("").alias("Quality Score"),
        F.lit("").alias("Comments/Analysis"),
    )
