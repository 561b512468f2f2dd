"""Groups of spelling variants: words one edit apart, found with PartEnum signatures of their letter multisets.

A word is read as a binary vector with one dimension for every letter and occurrence of it ("hello" has h1, e1, l1,
l2, o1). One replaced letter changes two of these bits, one inserted or deleted letter changes one, so near words have
vectors with a Hamming distance of at most two. Dimensions are dealt onto `PARTS` parts by hash. For words of equal
length, two changed bits touch at most two parts, so one of the subsets of `PARTS - 2` parts is equal in both; for
lengths that differ by one, one changed bit leaves one of two parts equal. Each subset's bits and its number are a
signature. Anagrams share all of them, so a signature also names one half of the word: an edit leaves either
the first letters or the last ones as they are. No near pair is without a common signature; pairs that meet at one are
verified by their edit distance, which is exact.

Words are counted before anything is compared, so frequent words cost one row. Null texts have no words; a null
id is spelt as an empty text; an empty table gives no rows; repeated rows count as often as they stand there.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm.rows import quoted, text_or_empty
from tidemart.session import materialize

#: Words are maximal runs of a-z (A-Z become these) and of the characters from U+00C0 to U+00FF.
LOWER = bytes(range(256)).lower()
#: A task holds the counts of so many words before it hands them on.
HELD_WORDS = 200_000
#: Parts of the dimensions for words of equal length, and for words whose lengths differ by one.
PARTS, PARTS_OF_UNEQUAL = 4, 2
#: What a signature's row is: of equal lengths, of the shorter word of a pair, of the longer one.
EQUAL, SHORTER, LONGER = 0, 1, 2
#: Words are signed so many at a time.
BLOCK = 20_000

#: Seeds of the hashes of dimensions, of first letters and of last letters.
DIMENSION, FIRST, LAST = (np.uint64(seed) for seed in (0x9E3779B97F4A7C15, 0x3C6EF372FE94F82A, 0xDAA66D2C7DDF743F))


def word_counts(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shortest: int = 5,
    least: int = 3,
    altered: Callable[[str, str], str] | None = None,
) -> DataFrame:
    """(word, n) of the words with at least `shortest` letters and `least` occurrences; A-Z become lower case.

    `altered(key, word)` may give a document's occurrences another spelling; what becomes shorter than `shortest` is not counted.
    Tasks count what they meet, in at most `HELD_WORDS` words at a time, before the shuffle.
    """
    find = re.compile(b"[a-z\xc0-\xff]{%d,}" % shortest).findall

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, int] = {}

        def counted() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(totals.keys(), pa.string()), pa.array(totals.values(), pa.int64())], ["word", "n"])

        for batch in batches:
            for one, content in zip(batch.column(0), batch.column(1), strict=True):
                name = one.as_py()
                # one byte a letter: what is no letter of Latin-1 becomes a question mark
                for run, n in Counter(find(content.as_py().encode("latin-1", "replace").translate(LOWER))).items():
                    word = run.decode("latin-1")
                    if altered:
                        word = altered(name, word)
                        if len(word) < shortest:
                            continue
                    totals[word] = totals.get(word, 0) + n
                if len(totals) >= HELD_WORDS:
                    yield counted()
                    totals.clear()
        if totals:
            yield counted()

    rows = docs.select(F.coalesce(F.col(quoted(key)).cast("string"), F.lit("")).alias("key"), text_or_empty(text).alias("text"))
    found = rows.mapInArrow(count, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


def _mix(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


class Letters:
    """The letters of many words in one array, with sums over words and over parts of them."""

    def __init__(self, words: list[str]):
        self.lengths = np.fromiter(map(len, words), np.int64, len(words))
        self.codes = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.uint64)
        self.ends = np.cumsum(self.lengths)
        self.starts = self.ends - self.lengths
        self.word = np.repeat(np.arange(len(words)), self.lengths)

    def sums(self, values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Sums, modulo 2 to the 64th, of what stands between two places."""
        upto = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
        return upto[ends] - upto[starts]

    def dimensions(self) -> np.ndarray:
        """A number for each letter's dimension: the letter and which of the word's equal letters it is."""
        order = np.lexsort((self.codes, self.word))
        codes, word = self.codes[order], self.word[order]
        places = np.arange(len(codes))
        first = np.ones(len(codes), bool)
        first[1:] = (codes[1:] != codes[:-1]) | (word[1:] != word[:-1])
        occurrence = places - np.maximum.accumulate(np.where(first, places, 0))
        return _mix((codes << np.uint64(32)) + occurrence.astype(np.uint64) + DIMENSION)

    def parts(self, dimensions: np.ndarray, count: int) -> list[np.ndarray]:
        """For each part, every word's bits in it as a sum of their hashes."""
        part = (dimensions >> np.uint64(40)) % np.uint64(count)
        hashed = _mix(dimensions + np.uint64(count))
        return [self.sums(np.where(part == p, hashed, np.uint64(0)), self.starts, self.ends) for p in range(count)]

    def halves(self, lengths: np.ndarray) -> list[np.ndarray]:
        """Hashes of the first half of `lengths` letters and of as many last letters as make the rest."""
        from_start = np.arange(len(self.codes)) - np.repeat(self.starts, self.lengths)
        from_end = np.repeat(self.lengths, self.lengths) - from_start
        first = _mix((self.codes << np.uint64(32)) + from_start.astype(np.uint64) + FIRST)
        last = _mix((self.codes << np.uint64(32)) + from_end.astype(np.uint64) + LAST)
        half = lengths // 2
        return [self.sums(first, self.starts, self.starts + half), self.sums(last, self.ends - (lengths - half), self.ends)]


def signatures(words: list[str]) -> list[tuple[int, np.ndarray]]:
    """(kind, the signatures of all words) for every subset of parts and every half."""
    letters = Letters(words)
    dimensions = letters.dimensions()
    out = []

    def sign(kinds: list[tuple[int, np.ndarray]], count: int, left_out: int, family: int) -> None:
        parts = letters.parts(dimensions, count)
        for kind, lengths in kinds:
            sized = _mix(lengths.astype(np.uint64) * np.uint64(2) + np.uint64(family))
            for half, same in enumerate(letters.halves(lengths)):
                for number, subset in enumerate(combinations(range(count), count - left_out)):
                    chosen = sum((parts[p] for p in subset), np.zeros(len(words), np.uint64))
                    out.append((kind, _mix(chosen + _mix(same + np.uint64(2 * number + half)) + sized).view(np.int64)))

    sign([(EQUAL, letters.lengths)], PARTS, 2, 0)
    sign([(SHORTER, letters.lengths), (LONGER, letters.lengths - 1)], PARTS_OF_UNEQUAL, 1, 1)
    return out


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first in range(0, batch.num_rows, BLOCK):
            block = batch.slice(first, BLOCK)
            for kind, signature in signatures(block.column(0).to_pylist()):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signature), pa.array(np.full(block.num_rows, kind, np.int8)), *block.columns], ["signature", "kind", "word", "n"]
                )


def near_words(words: DataFrame) -> DataFrame:
    """(word, n, other, other_n): every pair of words that one inserted, deleted or replaced letter tells apart, both ways."""
    spark = words.sparkSession
    dealt = words.select("word", F.col("n").cast("long").alias("n")).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "word")
    signed = materialize(dealt.mapInArrow(_signed, "signature long, kind byte, word string, n long"), "signed")
    left, right = signed.alias("l"), signed.alias("r")
    kinds = F.expr(f"(l.kind = {EQUAL} and r.kind = {EQUAL} and l.word < r.word) or (l.kind = {SHORTER} and r.kind = {LONGER})")
    met = left.join(right, (F.col("l.signature") == F.col("r.signature")) & kinds)
    pairs = met.filter(F.levenshtein("l.word", "r.word", 1) == 1).select(
        F.col("l.word").alias("word"), F.col("l.n").alias("n"), F.col("r.word").alias("other"), F.col("r.n").alias("other_n")
    )
    pairs = materialize(pairs.groupBy("word", "other").agg(F.first("n").alias("n"), F.first("other_n").alias("other_n")), "near")
    turned = pairs.select(F.col("other").alias("word"), F.col("word").alias("other"), F.col("other_n").alias("n"), F.col("n").alias("other_n"))
    return pairs.unionByName(turned).select("word", "n", "other", "other_n")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of rows (word, form): the last word that following forms comes to; paths halve in every round.

    A form is more frequent than its word, so there are no circles.
    """
    ahead = materialize(forms.filter("form is not null").select("word", F.col("form").alias("root")), "ahead")
    while True:
        further = ahead.alias("a").join(ahead.select(F.col("word").alias("root"), F.col("root").alias("next")).alias("b"), "root", "left")
        further = materialize(further.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "ahead")
        ahead = further.select("word", "root")
        if not further.filter("moved").limit(1).count():
            return ahead


def variants(words: DataFrame, times: int = 2) -> DataFrame:
    """For each word of `words` (word, n): its form, the root of its forms, its count, how many words are near, the form's count.

    The form is the most frequent near word (ties: the first in code-point order) if it is at least `times` as frequent.
    """
    words = materialize(words.select("word", "n"), "words")
    best = F.min(F.struct((-F.col("other_n")).alias("minus"), F.col("other").alias("form")))
    grouped = near_words(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    enough = -F.col("best.minus") >= times * F.col("n")
    named = words.join(grouped, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(enough, F.col("best.form")).alias("form"), F.when(enough, -F.col("best.minus")).alias("form_n")
    )
    named = materialize(named, "named")
    return named.join(roots(named), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
