"""Alignment of two tokenizers over the same bytes: groups of tokens between common ends, and which tokens overlap.

A text's tokens are taken as their end places in its bytes, one array for each tokenizer. At the current shift between the two
arrays' indexes the aligner probes stretches of doubling length: as long as both slices are equal, tokens stand one to
one and the whole stretch is jumped; at a difference the probe halves until the stretch's end is found. There an
irregular group is resolved token by token until both ends meet again, which gives the next shift.

The corpus-wide count of an id pair (links that join the two ids) needs all documents, so documents are aligned in
chunks of about `CHUNK_BYTES` of text: a chunk keeps its distinct pairs once, and each document its pairs as places in that
list. Chunks' pair counts are summed by pair, the sums come back to the chunks that hold the pair, and each chunk's
documents look them up. What is shuffled are distinct pairs per chunk, never links; no table of pairs is broadcast.

A text that is null, empty, or whose bytes are not those of both token sequences has no tokens: zeros and an empty digest.
Repeated rows and ids are aligned row by row; a null id stays null; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm import vocab
from tidemart.llm.rows import quoted, text_or_empty
from tidemart.session import materialize

#: A chunk closes when it holds so many bytes of text; a longer text is a chunk of its own.
CHUNK_BYTES = 8 << 20
#: Rows handed on at a time.
ROWS = 2_000
#: So many tokens are compared one by one before probes double.
NEAR = 8
NO_IDS = np.zeros(0, np.uint32)

@dataclass(frozen=True)
class Alignment:
    """Rows of places: stretches (first of a, first of b, length), irregular groups (first of a, first of b), and in these the pairs
    of tokens whose bytes overlap (a, b)."""

    stretches: np.ndarray
    groups: np.ndarray
    crossed: np.ndarray

    def starts(self) -> tuple[np.ndarray, np.ndarray]:
        """Where the groups begin in a and in b, in order; each pair of tokens of a stretch is a group."""
        first, second = self._one_to_one()
        # both ascend from group to group, so each is in order by itself
        return np.sort(np.concatenate([first, self.groups[:, 0]])), np.sort(np.concatenate([second, self.groups[:, 1]]))

    def overlaps(self) -> tuple[np.ndarray, np.ndarray]:
        """Places of the tokens of a and b whose bytes overlap, one entry for each pair of occurrences."""
        first, second = self._one_to_one()
        return np.concatenate([first, self.crossed[:, 0]]), np.concatenate([second, self.crossed[:, 1]])

    def _one_to_one(self) -> tuple[np.ndarray, np.ndarray]:
        lengths = self.stretches[:, 2]
        within = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        return np.repeat(self.stretches[:, 0], lengths) + within, np.repeat(self.stretches[:, 1], lengths) + within


def align(ends_a: list[int], ends_b: list[int]) -> Alignment:
    """Groups between common ends; both lists ascend strictly and end with the same number."""
    stretches: list[int] = []
    groups: list[int] = []
    crossed: list[int] = []
    i = j = 0
    size_a = len(ends_a)
    while i < size_a:
        x, y = ends_a[i], ends_b[j]
        if x == y:
            at, shift = i + 1, j - i
            near = min(i + NEAR, size_a)
            while at < near and ends_a[at] == ends_b[at + shift]:
                at += 1
            if at == i + NEAR:
                probe = NEAR
                while (ahead := ends_a[at : at + probe]) and ahead == ends_b[at + shift : at + shift + probe]:
                    at += len(ahead)  # the stretch doubles while both slices are equal
                    probe *= 2
                while probe > 1:  # and halves down to the first difference
                    probe //= 2
                    ahead = ends_a[at : at + probe]
                    if ahead and ahead == ends_b[at + shift : at + shift + probe]:
                        at += len(ahead)
            stretches += (i, j, at - i)
            i, j = at, at + shift
            continue
        groups += (i, j)
        crossed += (i, j)
        while x != y:  # whichever token ends first is passed
            if x < y:
                i += 1
                x = ends_a[i]
            else:
                j += 1
                y = ends_b[j]
            crossed += (i, j)
        i += 1
        j += 1
    return Alignment(*(np.array(one, np.int64).reshape(-1, width) for one, width in ((stretches, 3), (groups, 2), (crossed, 2))))


def number_table(size: int) -> np.ndarray:
    """The decimal digits of the numbers below `size` (ten million at most), right in the first seven of eight bytes."""
    digits = np.array([f"{number:>7}\0" for number in range(size)], "S8").view(np.uint8).reshape(size, -1) if size else np.zeros((0, 8), np.uint8)
    padded = np.zeros((size, 8), np.uint8)
    padded[:, : digits.shape[1]] = np.where(digits == ord(" "), 0, digits)
    return padded.view("<u8").ravel()


def spelt_groups(a: np.ndarray, b: np.ndarray, from_a: np.ndarray, from_b: np.ndarray, numbers: np.ndarray) -> bytes:
    """The groups that begin at these places in order as `a1,a2|b1;a3|b2,b3`; `numbers` is a `number_table` that both ids are in.

    A token's place in the output follows from the tokens of both sides before it; the mark behind it is the eighth byte.
    """
    sizes_a, sizes_b = np.diff(from_a, append=len(a)), np.diff(from_b, append=len(b))
    place_a = np.arange(len(a)) + np.repeat(from_b, sizes_a)
    place_b = np.arange(len(b)) + np.repeat(from_a + sizes_a, sizes_b)
    marks_a, marks_b = np.full(len(a), ord(","), "<u8"), np.full(len(b), ord(","), "<u8")
    marks_a[from_a + sizes_a - 1] = ord("|")
    marks_b[from_b + sizes_b - 1] = ord(";")
    out = np.empty(len(a) + len(b), "<u8")
    out[place_a] = numbers[a] | (marks_a << np.uint64(56))
    out[place_b] = numbers[b] | (marks_b << np.uint64(56))
    spelt = out.view(np.uint8)
    return spelt[spelt != 0].tobytes()[:-1]


class Pair:
    """Two tokenizers in a task: ids and spellings of byte-level tokens (a) and of pieces (b) of the same text."""

    def __init__(self, byte_vocabulary: str, pieces: str):
        self.bytes = vocab.byte_encoder(byte_vocabulary, plain=True)
        self.pieces = vocab.piece_encoder(pieces)
        bytes_of = {character: byte for byte, character in vocab.byte_characters().items()}
        by_id = sorted((number, token) for token, number in self.bytes.library.get_vocab().items())
        self.bytes_a = [b""] * (by_id[-1][0] + 1)
        for number, token in by_id:
            known = all(character in bytes_of for character in token)
            self.bytes_a[number] = bytes(bytes_of[character] for character in token) if known else token.encode()
        self.bytes_b = [
            bytes([int(piece[1:-1], 16)]) if self.pieces.is_byte(number) else piece.replace("▁", " ").encode()
            for number, piece in enumerate(map(self.pieces.id_to_piece, range(self.pieces.get_piece_size())))
        ]
        self.sizes_a = np.array([len(one) for one in self.bytes_a], np.int64)
        self.sizes_b = np.array([len(one) for one in self.bytes_b], np.int64)
        self.numbers = number_table(max(len(self.bytes_a), len(self.bytes_b)))

    def ids(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of both for the text with a space before it, or none where one's tokens do not spell it."""
        raw = (" " + text).encode()
        b = self.pieces.encode(text) if text else []
        if b"".join(map(self.bytes_b.__getitem__, b)) != raw:
            return NO_IDS, NO_IDS
        a = self.bytes.ids(" " + text)
        if int(self.sizes_a[a].sum()) != len(raw):  # byte-level tokens spell any text, so their length tells
            return NO_IDS, NO_IDS
        return a, np.array(b, np.uint32)


@lru_cache(maxsize=1)
def tokenizer_pair(byte_vocabulary: str, pieces: str) -> Pair:
    return Pair(byte_vocabulary, pieces)


def packed(*numbers: np.ndarray) -> bytes:
    return zstandard.compress(np.concatenate([one.astype("<u4") for one in numbers]).tobytes(), 3)


def unpacked(data: bytes, parts: int) -> list[np.ndarray]:
    return np.split(np.frombuffer(zstandard.decompress(data), "<u4"), parts)


class Chunk:
    """Documents in the making: their rows, and all distinct pairs that they hold."""

    def __init__(self) -> None:
        self.rows: list[tuple] = []
        self.pairs: list[np.ndarray] = []
        self.links: list[np.ndarray] = []
        self.bytes = 0

    def add(self, key, text: str, pair: Pair, spelt: bool) -> None:
        a, b = pair.ids(text)
        self.bytes += len(text)
        if not len(a):
            self.rows.append((key, 0, 0, 0, 0, "", ""))
            self.pairs.append(np.zeros(0, np.int64))
            self.links.append(np.zeros(0, np.int64))
            return
        ends_a, ends_b = np.cumsum(pair.sizes_a[a]).tolist(), np.cumsum(pair.sizes_b[b]).tolist()
        aligned = align(ends_a, ends_b)
        first, second = aligned.overlaps()
        starts = aligned.starts()
        written = spelt_groups(a, b, *starts, pair.numbers)
        digest = hashlib.sha256(written).hexdigest()
        self.rows.append((key, len(a), len(b), len(starts[0]), len(first), digest, written.decode() if spelt else ""))
        held, counts = np.unique((a[first].astype(np.int64) << 32) | b[second], return_counts=True)
        self.pairs.append(held)
        self.links.append(counts)

    def batches(self, number: int, key_type: pa.DataType) -> Iterator[pa.RecordBatch]:
        """The documents, each with its pairs as ascending places in the chunk's list, and then the list itself in a row without a document."""
        every = np.concatenate(self.pairs)
        held, place = np.unique(every, return_inverse=True)
        totals = np.bincount(place, np.concatenate(self.links), len(held)).astype(np.int64)
        bounds = np.cumsum([0, *map(len, self.pairs)])
        keys, n_a, n_b, n_groups, n_links, digests, spelt = (list(column) for column in zip(*self.rows, strict=True))
        for first in range(0, len(keys), ROWS):
            part = slice(first, first + ROWS)
            some = range(first, min(first + ROWS, len(keys)))
            data = [packed(np.diff(place[bounds[k] : bounds[k + 1]], prepend=0), self.links[k]) for k in some]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(some), number)), pa.array(np.ones(len(some), bool)), pa.array(keys[part], key_type), pa.array(n_a[part], pa.int64()),
                    pa.array(n_b[part], pa.int64()), pa.array(n_groups[part], pa.int64()), pa.array(n_links[part], pa.int64()),
                    pa.array(digests[part]), pa.array(spelt[part]), pa.array(data, pa.binary()),
                ],
                NAMES,
            )
        zeros = pa.array([0], pa.int64())
        last = packed(held >> 32, held & 0xFFFFFFFF, totals)
        yield pa.RecordBatch.from_arrays(
            [pa.array([number]), pa.array([False]), pa.nulls(1, key_type), zeros, zeros, zeros, zeros, pa.array([""]), pa.array([""]), pa.array([last], pa.binary())], NAMES
        )


NAMES = ["chunk", "is_document", "key", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "groups", "data"]
COUNTED = "chunk long, place int, a int, b int, n long"


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs of chunks' lists as rows."""
    for batch in batches:
        for chunk, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b, n = unpacked(data, 3)
            if len(a):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(a), chunk)), pa.array(np.arange(len(a), dtype=np.int32)), pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32)), pa.array(n.astype(np.int64))],
                    ["chunk", "place", "a", "b", "n"],
                )


def aligned_chunks(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    byte_vocabulary: str | None = None,
    pieces: str | None = None,
    groups: bool = False,
) -> DataFrame:
    """Rows of documents and of chunks' pair lists, written to the shared folder: chunk numbers hold for what is read back."""
    names = (byte_vocabulary or vocab.vocabulary_path(vocab.BYTE_BPE), pieces or vocab.vocabulary_path(vocab.PIECE_BPE))
    rows = docs.select(F.col(quoted(key)).alias("key"), text_or_empty(text).alias("text"))

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = tokenizer_pair(*names)
        number = TaskContext.get().partitionId() << 32
        chunk, key_type = Chunk(), None
        for batch in batches:
            key_type = batch.schema.field(0).type
            for one, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                chunk.add(one, content.as_py(), pair, groups)
                if chunk.bytes >= CHUNK_BYTES:
                    yield from chunk.batches(number, key_type)
                    number, chunk = number + 1, Chunk()
        if chunk.rows:
            yield from chunk.batches(number, key_type)

    kind = rows.schema["key"].dataType.simpleString()
    schema = f"chunk long, is_document boolean, key {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, groups string, data binary"
    return materialize(rows.mapInArrow(chunks, schema), "aligned")


def chunk_pairs(chunks: DataFrame) -> DataFrame:
    """(chunk, place, a, b, n) of every distinct pair of every chunk."""
    return chunks.filter("not is_document").select("chunk", "data").mapInArrow(_listed, COUNTED)


def pair_counts(chunks: DataFrame) -> DataFrame:
    """(a, b, count, best): links that join the two ids in all documents, and whether no other pair of the same b has more."""
    counted = materialize(chunk_pairs(chunks).groupBy("a", "b").agg(F.sum("n").alias("count")), "pair_counts")
    highest = counted.groupBy("b").agg(F.max("count").alias("highest"))
    return counted.join(highest, "b").select("a", "b", "count", (F.col("count") == F.col("highest")).alias("best"))


def align_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", groups: bool = False, **vocabularies: str | None) -> DataFrame:
    """One row per document: key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, and the groups themselves if asked for."""
    chunks = aligned_chunks(docs, key, text, groups=groups, **vocabularies)
    known = chunk_pairs(chunks).drop("n").join(pair_counts(chunks), ["a", "b"]).select("chunk", "place", "count", "best")
    documents = chunks.filter("is_document").drop("is_document")
    kind = documents.schema["key"].dataType.simpleString()

    def looked_up(left: pa.Table, right: pa.Table) -> pa.Table:
        place = right.column("place").to_numpy()
        counts, best = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
        counts[place] = right.column("count").to_numpy()
        best[place] = right.column("best").to_numpy(zero_copy_only=False)
        sums, bests = np.zeros(len(left), np.int64), np.zeros(len(left), np.int64)
        for row, data in enumerate(left.column("data")):
            steps, links = unpacked(data.as_py(), 2)
            held = np.cumsum(steps, dtype=np.int64)
            sums[row], bests[row] = int((counts[held] * links).sum()), int((best[held] * links).sum())
        out = left.drop_columns(["chunk", "data"])
        return out.append_column("n_best", pa.array(bests)).append_column("count_sum", pa.array(sums))

    schema = f"key {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, groups string, n_best long, count_sum long"
    found = documents.groupBy("chunk").cogroup(known.groupBy("chunk")).applyInArrow(looked_up, schema)
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", *(["groups"] if groups else [])]
    return found.select(F.col("key").alias(key), *names)
