"""Overlapping text chunks, cut at the coarsest separator that fits."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.session import spread

#: Texts that are cut at a time; a batch that arrives holds many more.
TEXTS = 64
SEPARATORS = ("\n\n", "\n", ". ", " ", "")


def _pieces(text: str, separator: str) -> list[str]:
    """Parts of the text; each part after the first keeps the separator at its start."""
    if not separator:
        return list(text)
    first, *rest = text.split(separator)
    return [p for p in [first, *[separator + r for r in rest]] if p]


def _packed(parts: list[str], size: int, overlap: int) -> Iterator[str]:
    """Parts joined up to `size`; the next chunk starts with at most `overlap` characters of the last."""
    held: deque[str] = deque()
    length = 0
    for part in parts:
        if held and length + len(part) > size:
            yield "".join(held)
            while held and (length > overlap or length + len(part) > size):
                length -= len(held.popleft())
        held.append(part)
        length += len(part)
    if held:
        yield "".join(held)


def split_text(text: str, size: int = 500, overlap: int = 50, separators: Sequence[str] = SEPARATORS) -> list[str]:
    """Chunks of one text, ends stripped, empty chunks left out."""

    def cut(part: str, level: int) -> Iterator[str]:
        while separators[level] and separators[level] not in part and level < len(separators) - 1:
            level += 1
        run: list[str] = []
        for piece in _pieces(part, separators[level]):
            if len(piece) < size:
                run.append(piece)
                continue
            yield from _packed(run, size, overlap)
            run = []
            if level == len(separators) - 1:
                yield piece
            else:
                yield from cut(piece, level + 1)
        yield from _packed(run, size, overlap)

    return [c for c in (chunk.strip() for chunk in cut(text, 0)) if c]


def create_chunks(
    df: DataFrame, id_col: str, text_col: str = "cleaned_narrative", product_col: str = "Product", size: int = 500, overlap: int = 50,
    index_col: str | None = None,
) -> DataFrame:
    """(chunk_id, complaint_id, product, text, chunk_index); blank texts give none.

    The chunk id is a hash of document and position, so a re-run names the same chunks. Rows have no number of their own;
    with `index_col`, the column that numbers them, it comes along as `original_index`.
    """

    rows = df.filter(F.col(text_col).isNotNull() & F.col(text_col).rlike(r"(?U)\S"))
    numbered = {"original_index": F.col(index_col)} if index_col else {}
    named = spread(rows.select(id_col, text_col, product_col, *[column.alias(name) for name, column in numbered.items()])).select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("unknown")).alias("complaint_id"), F.col(product_col).alias("product"), *numbered, F.col(text_col).alias("text"),
    )
    kept = named.columns[:-1]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, TEXTS):
                part = batch.slice(start, TEXTS)
                pieces = [split_text(text, size, overlap) for text in part.column(len(kept)).to_pylist()]
                take = pa.array(np.repeat(np.arange(len(pieces)), [len(one) for one in pieces]))
                places = pa.array([place for one in pieces for place in range(len(one))], pa.int32())
                texts = pa.array([chunk for one in pieces for chunk in one], pa.string())
                yield pa.RecordBatch.from_arrays([*[part.column(i).take(take) for i in range(len(kept))], texts, places], [*kept, "text", "chunk_index"])

    schema = T.StructType([*[named.schema[name] for name in kept], T.StructField("text", T.StringType()), T.StructField("chunk_index", T.IntegerType())])
    chunk_id = F.sha2(F.concat_ws(":", "complaint_id", F.col("chunk_index").cast("string")), 256)
    return named.mapInArrow(cut, schema).select(chunk_id.alias("chunk_id"), "complaint_id", "product", "text", "chunk_index", *numbered)
