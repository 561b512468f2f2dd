"""Token ids in flat unsigned integer files with 64-bit document offsets.

Documents are dealt out by ranges of their key, and each task writes its range's ids as they come: one flat
file of unsigned integers (16 bits where the vocabulary fits, else 32), and one with the keys and lengths. What comes
back to the driver is a line per task; prefix sums over those lines are the tasks' bases, and a second pass
writes each task's offsets (64 bits, counted over all files, one more than there are documents). A file's name
holds a random part, so an attempt that is lost or runs twice leaves a file that no manifest names.

The order is the key ascending, null keys first, then a hash of the text and the text; equal rows follow each
other. Null texts are empty and have the end id only. An empty table has a manifest without parts.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm import files, vocab
from tidemart.llm.rows import quoted

MANIFEST = "manifest.json"


@dataclass(frozen=True)
class Part:
    number: int
    stem: str
    n_docs: int
    n_tokens: int
    base: int = 0


def number_kind(largest: int) -> np.dtype:
    return np.dtype("<u2" if largest < 1 << 16 else "<u4")


def write_token_files(docs: DataFrame, folder: str, key: str = "doc_id", text: str = "text", vocabulary: str | None = None, end_id: int = 2) -> str:
    """Encode whole texts, end each document with `end_id`, write the files below `folder`; returns the manifest's place."""
    spark = docs.sparkSession
    path = vocabulary or vocab.vocabulary_path(vocab.BYTE_BPE)
    kind = number_kind(max(vocab.byte_encoder(path).library.get_vocab_size(), end_id))
    rows = docs.select(F.col(quoted(key)).alias("key"), F.coalesce(F.col(quoted(text)).cast("string"), F.lit("")).alias("text"))
    hashed = F.xxhash64("text")
    ordered = rows.repartitionByRange(F.asc_nulls_first("key"), hashed).sortWithinPartitions(F.asc_nulls_first("key"), hashed, "text")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = vocab.byte_encoder(path)
        end = np.array([end_id], kind).tobytes()
        stem = f"{folder}/part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}"
        keys: list[pa.Array] = []
        lengths: list[np.ndarray] = []
        stream = None
        for batch in batches:
            if not batch.num_rows:
                continue
            stream = stream or files.open_new(f"{stem}.tokens")
            sizes = np.zeros(batch.num_rows, np.int64)
            for place, one in enumerate(batch.column(1)):
                ids = encoder.ids(one.as_py())
                stream.write(ids.astype(kind).tobytes())
                stream.write(end)
                sizes[place] = len(ids) + 1
            keys.append(batch.column(0))
            lengths.append(sizes)
        if stream is None:
            return
        stream.close()
        sizes = np.concatenate(lengths)
        lines = pa.table({"key": pa.chunked_array(keys), "n_tokens": sizes})
        with files.open_new(f"{stem}.keys") as out, pa.ipc.new_file(out, lines.schema) as writer:
            writer.write_table(lines)
        yield pa.RecordBatch.from_pydict(
            {"number": pa.array([TaskContext.get().partitionId()], pa.int32()), "stem": [stem], "n_docs": pa.array([len(sizes)], pa.int64()), "n_tokens": pa.array([int(sizes.sum())], pa.int64())}
        )

    # one line per task comes back
    lines = ordered.mapInArrow(encode, "number int, stem string, n_docs long, n_tokens long").collect()
    base, parts = 0, []
    for line in sorted(lines, key=lambda line: line["number"]):
        parts.append(Part(line["number"], line["stem"], line["n_docs"], line["n_tokens"], base))
        base += line["n_tokens"]
    _write_offsets(spark, parts)
    place = f"{folder}/{MANIFEST}"
    key_type = rows.schema["key"].dataType.simpleString()
    with files.open_new(place) as out:
        out.write(json.dumps({"kind": kind.str, "key": key_type, "n_tokens": base, "parts": [vars(part) for part in parts]}).encode())
    return place


def _part_rows(spark: SparkSession, parts: list[Part]) -> DataFrame:
    """The parts as rows, each in a partition of its own as far as the hash allows."""
    rows = spark.createDataFrame([(p.number, p.stem, p.base) for p in parts], "number int, stem string, base long")
    return rows.repartition(max(1, len(parts)), "number")


def _write_offsets(spark: SparkSession, parts: list[Part]) -> None:
    def offsets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                sizes = _lines(row["stem"]).column("n_tokens").to_numpy()
                starts = np.concatenate([[0], np.cumsum(sizes)]) + row["base"]
                with files.open_new(f"{row['stem']}.offsets") as out:  # the same bytes whichever attempt writes them
                    out.write(starts.astype("<i8").tobytes())
            yield pa.RecordBatch.from_pydict({"n": pa.array([batch.num_rows], pa.int64())})

    if parts:
        _part_rows(spark, parts).mapInArrow(offsets, "n long").agg(F.sum("n")).collect()


def _lines(stem: str) -> pa.Table:
    return pa.ipc.open_file(pa.py_buffer(files.read(f"{stem}.keys"))).read_all()


def read_token_files(spark: SparkSession, manifest: str, key: str = "doc_id", ids: bool = True) -> DataFrame:
    """The documents of the files: key, start, n_tokens, ids_crc32 (over 32-bit ids) and, unless `ids` is False, the ids."""
    found = json.loads(files.read(manifest))
    kind = np.dtype(found["kind"])
    parts = [Part(**part) for part in found["parts"]]
    schema = f"{quoted(key)} {found['key']}, start long, n_tokens long, ids_crc32 long" + (", ids array<long>" if ids else "")
    if not parts:
        return spark.createDataFrame([], schema)

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                tokens = files.mapped(f"{row['stem']}.tokens", kind)
                starts = files.mapped(f"{row['stem']}.offsets", np.dtype("<i8"))
                keys = _lines(row["stem"]).column("key").combine_chunks()
                for first in range(0, len(keys), 1000):
                    bounds = np.asarray(starts[first : first + 1001])
                    own = [tokens[a - row["base"] : b - row["base"]] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                    out = {
                        key: keys.slice(first, 1000),
                        "start": pa.array(bounds[:-1]),
                        "n_tokens": pa.array(np.diff(bounds)),
                        "ids_crc32": pa.array([zlib.crc32(one.astype("<u4").tobytes()) for one in own], pa.int64()),
                    }
                    if ids:
                        out["ids"] = pa.array([one.astype(np.int64) for one in own], pa.list_(pa.int64()))
                    yield pa.RecordBatch.from_pydict(out)

    return _part_rows(spark, parts).mapInArrow(documents, schema)
