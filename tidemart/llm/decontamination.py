"""Benchmark decontamination: a BM25 index of test items, searched with every training passage by block-max WAND.

The items are the index and the training text asks. A document is cut into passages of two strides, one stride
apart, so that every item up to a stride long lies whole in some passage. A passage's score for an item is
BM25 over its distinct words, divided by the score of the item's own words: 1 means every word of the item is
there. All items at or above `threshold` are retrieved, as in block-max WAND: a passage's words are sorted by the largest
weight they have anywhere; the cheap ones that together stay below the threshold cannot lift an item over it
alone, so only blocks of items that hold one of the others (from the pivot on) are opened; a block is scored
only if the pivot words' block maxima plus the cheap words, first at their largest and then at their block
maxima, reach the threshold. Nothing at or above it is missed.

A retrieved item counts when the document holds its question and its answer: of the `gram`-word sequences of
each part, at least `overlap` are found in the text. One changed word breaks up to `gram` sequences, so a part of
fewer than `SHORT` words is also held, at (n - 1) / n, if the best passage has its n words in order but for one edit,
and an item counts as well if the best passage has all its words in order but for one edit (from five words on); an
item whose answer is one word is then found by its question alone. Parts are the columns `question` and `answer` if the
items have them; else the answer is the last line, or the last sentence of a single line, and the question
what comes before (a single sentence is both).

Items are indexed by length class (powers of two from `STRIDE` words on), each with a stride of its own. The index
goes to every task; its size is measured first, and a benchmark beyond `SHARD_BYTES` of text is searched in several
passes, each over a shard. Null texts are empty; items without words match nothing; repeated items and rows give a
result each; empty tables give none.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.llm.rows import quoted, text_or_empty
from tidemart.llm.vocab import WordCache
from tidemart.session import materialize

K1, B = 1.2, 0.75
STRIDE = 64
BLOCK_ITEMS = 4
TABLE_CELLS = 1 << 22
SHARD_BYTES = 32 << 20
THRESHOLD, GRAM, OVERLAP = 0.6, 5, 0.6
SHORT, WHOLE = 20, 0.8
MATCH = "item_id long, score double, question_overlap double, answer_overlap double, first_word long"

#: A word is what stands between blanks without these marks at its ends; a text's mere marks are no words.
MARKS = "".join(chr(code) for code in range(33, 127) if not chr(code).isalnum()) + "«»“”‘’„¿¡…–—"
NO_WORD = -2
BATCH_CHARS = 1 << 18


def words_of(text: str) -> list[str]:
    return [word for word in (one.strip(MARKS) for one in text.lower().split()) if word]


def parts_of(text: str) -> tuple[str, str]:
    """Question and answer of an item that is one text."""
    lines = [line for line in text.split("\n") if line.strip()]
    if len(lines) < 2:
        lines = [part for part in re.split(r"(?<=[.?!])\s+", text) if part.strip()]
    return ("\n".join(lines[:-1]), lines[-1]) if len(lines) > 1 else (text, text)


def grams(words: list[str], n: int) -> list[tuple[str, ...]]:
    n = min(n, len(words))
    return [tuple(words[i : i + n]) for i in range(len(words) - n + 1)] if n else []


def edits(part: list[str], words: list[str]) -> int:
    """Least number of words changed, put in or left out between `part` and any run of `words` (bit-parallel, linear in `words`)."""
    places: dict[str, int] = {}
    for place, word in enumerate(part):
        places[word] = places.get(word, 0) | 1 << place
    full, top = (1 << len(part)) - 1, 1 << len(part) >> 1
    more, less, cost = full, 0, len(part)
    least = cost
    for word in words:
        equal = places.get(word, 0)
        down = equal | less
        across = (((equal & more) + more) ^ more) | equal
        up, low = less | full & ~(across | more), more & across
        cost += bool(up & top) - bool(low & top)
        least = min(least, cost)
        up, low = up << 1 & full, low << 1 & full
        more, less = low | full & ~(down | up), up & down
    return least


@dataclass
class Index:
    """Postings of one length class: items in blocks, weights divided by the items' own scores."""

    stride: int
    items: list[tuple[int, list, list, list, list]]  # id, grams of the question, grams of the answer, words of both
    number: dict[str, int] = field(default_factory=dict)
    best: np.ndarray = None  # largest weight of a word anywhere
    block_from: np.ndarray = None  # a word's first entry in block_of and block_best
    block_of: np.ndarray = None
    block_best: np.ndarray = None
    cells: np.ndarray = None  # word and block of each entry as one number, ascending
    table: np.ndarray = None  # block_best by cell, where that is small; the same numbers without a search
    weights: list[dict[int, float]] = field(default_factory=list)  # by item
    n_blocks: int = 0

    @cached_property
    def spelt(self) -> WordCache:
        """A word's number as it is written in a text: -1 if no item has it, `NO_WORD` for mere marks."""

        def number(written: str) -> int:
            word = written.strip(MARKS)
            return self.number.get(word, -1) if word else NO_WORD

        return WordCache(number)

    def worth(self, word: np.ndarray, block: np.ndarray) -> np.ndarray:
        """Block maxima, 0 where a block has no item with the word."""
        cell = word * self.n_blocks + block
        if self.table is not None:
            return self.table[cell]
        place = np.minimum(np.searchsorted(self.cells, cell), len(self.cells) - 1)
        return np.where(self.cells[place] == cell, self.block_best[place], 0.0)


def build_indexes(items: list[tuple[int, str, str, str]], gram: int = GRAM) -> list[Index]:
    """One index per length class of items (id, text, question, answer); document frequencies are of all items."""
    split = [(key, words_of(text), question, answer) for key, text, question, answer in items]
    split = [one for one in split if one[1]]
    if not split:
        return []
    frequency = Counter(word for _, words, _, _ in split for word in set(words))
    mean = sum(len(words) for _, words, _, _ in split) / len(split)
    rarity = {word: math.log(1 + (len(split) - n + 0.5) / (n + 0.5)) for word, n in frequency.items()}
    classes: dict[int, list] = {}
    for one in split:
        classes.setdefault(max(STRIDE, 1 << (len(one[1]) - 1).bit_length()), []).append(one)
    return [_index(stride, members, rarity, mean, gram) for stride, members in sorted(classes.items())]


def _index(stride: int, members: list, rarity: dict[str, float], mean: float, gram: int) -> Index:
    # items that share rare words come to share blocks, which keeps block maxima apart
    members = sorted(members, key=lambda one: (max(set(one[1]), key=lambda word: (rarity[word], word)), one[0] is None, one[0] or 0))
    index = Index(stride, [])
    entries: dict[tuple[int, int], float] = {}
    for place, (key, words, question, answer) in enumerate(members):
        counts = Counter(words)
        raw = {w: rarity[w] * n * (K1 + 1) / (n + K1 * (1 - B + B * len(words) / mean)) for w, n in counts.items()}
        own = sum(raw.values())
        weights = {index.number.setdefault(word, len(index.number)): value / own for word, value in raw.items()}
        index.weights.append(weights)
        parts = words_of(question), words_of(answer)
        index.items.append((key, *(grams(part, gram) for part in parts), *parts))
        for word, value in weights.items():
            cell = (word, place // BLOCK_ITEMS)
            entries[cell] = max(entries.get(cell, 0.0), value)
    index.n_blocks = -(-len(index.items) // BLOCK_ITEMS)
    order = sorted(entries)
    word = np.array([cell[0] for cell in order])
    index.block_of = np.array([cell[1] for cell in order])
    index.block_best = np.array([entries[cell] for cell in order])
    index.block_from = np.searchsorted(word, np.arange(len(index.number) + 1))
    index.cells = word * index.n_blocks + index.block_of
    if len(index.number) * index.n_blocks <= TABLE_CELLS:
        index.table = np.zeros(len(index.number) * index.n_blocks)
        index.table[index.cells] = index.block_best
    index.best = np.maximum.reduceat(index.block_best, index.block_from[:-1])
    return index


def retrieve(index: Index, known: list[np.ndarray], threshold: float, passages: int = 2048) -> dict[tuple[int, int], tuple[float, int]]:
    """For texts given as word numbers (negative: not in the index): (text, item's place) to the best score and its passage's first word,
    for the items that some passage scores at or above the threshold."""
    stride = index.stride
    counts = np.array([max(0, -(-len(one) // stride) - 2) + 1 for one in known])
    # the texts one after the other, two strides of nothing between them, so that no passage meets two
    bases = (np.cumsum(counts + 3) - (counts + 3)) * stride
    at = np.concatenate([np.flatnonzero(one >= 0) + base for one, base in zip(known, bases.tolist(), strict=True)])
    ids = np.concatenate([one[one >= 0] for one in known])
    if not len(at):
        return {}
    text_of = np.repeat(np.arange(len(known)), counts)
    local = (np.arange(len(text_of)) - np.repeat(np.cumsum(counts) - counts, counts)) * stride
    all_starts = bases[text_of] + local
    # the place of the same word before, to count a word once in a passage
    order = np.lexsort((at, ids))
    same = ids[order[1:]] == ids[order[:-1]]
    before = np.full(len(at), -1)
    before[order[1:][same]] = at[order[:-1][same]]
    found: dict[tuple[int, int], tuple[float, int]] = {}
    for first in range(0, len(all_starts), passages):
        starts = all_starts[first : first + passages]
        low = np.searchsorted(at, starts)
        high = np.searchsorted(at, starts + 2 * stride)
        lengths = high - low
        passage = np.repeat(np.arange(len(starts)), lengths)
        place = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths) + np.repeat(low, lengths)
        once = before[place] < starts[passage]
        passage, word = passage[once], ids[place[once]]
        bound = np.bincount(passage, index.best[word], len(starts))
        open_ = bound[passage] >= threshold
        passage, word = passage[open_], word[open_]
        if not len(word):
            continue
        # the pivot: cheap words first, as long as they stay below the threshold together
        order = np.lexsort((index.best[word], passage))
        passage, word = passage[order], word[order]
        cost = index.best[word]
        total = np.cumsum(cost)
        heads = np.flatnonzero(np.concatenate([[True], passage[1:] != passage[:-1]]))
        prior = np.repeat(total[heads] - cost[heads], np.diff(np.append(heads, len(passage))))
        cheap = total - prior < threshold - 1e-9
        rest = np.bincount(passage[cheap], cost[cheap], len(starts))
        owner, pivot = passage[~cheap], word[~cheap]
        counts = index.block_from[pivot + 1] - index.block_from[pivot]
        entry = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(index.block_from[pivot], counts)
        cell = np.repeat(owner, counts) * index.n_blocks + index.block_of[entry]
        cells, inverse = np.unique(cell, return_inverse=True)
        sure = np.bincount(inverse, index.block_best[entry], len(cells))
        able = sure + rest[cells // index.n_blocks] >= threshold - 1e-9
        cells, sure = cells[able], sure[able]
        # the blocks still open: the cheap words by what they are worth in that block
        owners, low_word = passage[cheap], word[cheap]
        edges = np.searchsorted(owners, np.arange(len(starts) + 1))
        asked = cells // index.n_blocks
        counts = edges[asked + 1] - edges[asked]
        pair = np.repeat(np.arange(len(cells)), counts)
        entry = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + edges[asked][pair]
        worth = index.worth(low_word[entry], (cells % index.n_blocks)[pair])
        reach = sure + np.bincount(pair, worth, len(cells))
        bounds = np.searchsorted(passage, np.arange(len(starts) + 1))
        for one in cells[reach >= threshold - 1e-9].tolist():
            asked, block = divmod(one, index.n_blocks)
            present = set(word[bounds[asked] : bounds[asked + 1]].tolist())
            for item in range(block * BLOCK_ITEMS, min((block + 1) * BLOCK_ITEMS, len(index.items))):
                score = sum(value for key, value in index.weights[item].items() if key in present)
                text = int(text_of[first + asked])
                if score >= threshold and score > found.get((text, item), (0.0, 0))[0]:
                    found[text, item] = (score, int(local[first + asked]))
    return found


def matches(indexes: list[Index], texts: list[str], threshold: float, gram: int, overlap: float) -> list[list[tuple]]:
    """Verified items of each text, by item id."""
    raw = [text.lower().split() for text in texts]
    hits: dict[int, list[tuple]] = {}
    for index in indexes:
        known = [np.fromiter(map(index.spelt.__getitem__, one), np.int64, len(one)) for one in raw]
        for (text, item), best in retrieve(index, [one[one != NO_WORD] for one in known], threshold).items():
            hits.setdefault(text, []).append((*index.items[item], 2 * index.stride, *best))
    out: list[list[tuple]] = [[] for _ in texts]
    for text, found in hits.items():
        words = [word for word in (one.strip(MARKS) for one in raw[text]) if word]
        there: set = set()
        for n in {len(one) for _, question, answer, *_ in found for one in (*question[:1], *answer[:1])}:
            there.update(zip(*(words[i:] for i in range(n)), strict=False))
        for key, question, answer, *parts, reach, score, first in found:
            shares = [sum(one in there for one in part) / len(part) if part else 1.0 for part in (question, answer)]
            if min(shares) < overlap:
                near = words[first : first + reach]
                for place, part in enumerate(parts):
                    if shares[place] < overlap and len(part) < SHORT and edits(part, near) <= 1:
                        shares[place] = max(shares[place], 1 - 1 / len(part))
            held = min(shares) >= overlap
            if not held:
                whole = parts[0] if parts[0] == parts[1] else parts[0] + parts[1]
                held = 1 - 1 / len(whole) >= max(overlap, WHOLE) and edits(whole, near) <= 1
            if held:
                out[text].append((key, score, *shares, first))
        out[text].sort(key=lambda row: (row[0] is None, row[0] or 0, row))
    return out


def text_batches(texts: pd.Series, chars: int = BATCH_CHARS) -> Iterator[list[str]]:
    """The texts in order, so many at a time that they have about `chars` characters."""
    held: list[str] = []
    size = 0
    for text in texts:
        held.append(text)
        size += len(text)
        if size >= chars:
            yield held
            held, size = [], 0
    if held:
        yield held


def shards(benchmark: DataFrame, item: str = "item_id", text: str = "text", shard_bytes: int = SHARD_BYTES) -> Iterator[list[tuple]]:
    """The items (id, text, question, answer) in shards whose text is about `shard_bytes`, dealt by hash."""
    size = benchmark.agg(F.coalesce(F.sum(F.octet_length(text_or_empty(text))), F.lit(0))).first()[0]
    number = max(1, -(-size // shard_bytes))
    own = {"question", "answer"} <= set(benchmark.columns)
    columns = [F.col(quoted(item)).cast("long"), text_or_empty(text), *([text_or_empty("question"), text_or_empty("answer")] if own else [])]
    for shard in range(number):
        part = benchmark.filter(F.pmod(F.xxhash64(quoted(item), quoted(text)), F.lit(number)) == shard)
        rows = part.select(*columns).collect()  # `shard_bytes` bounds it
        yield [tuple(row) if own else (*row, *parts_of(row[1])) for row in rows]


def matched(docs: DataFrame, text: str, items: list[tuple], threshold: float, gram: int, overlap: float) -> Column:
    """Array of the verified matches of one shard."""
    held = docs.sparkSession.sparkContext.broadcast(build_indexes(items, gram))

    @F.pandas_udf(f"array<struct<{', '.join(part.replace(' ', ':', 1) for part in MATCH.split(', '))}>>")
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        names = [part.split()[0] for part in MATCH.split(", ")]
        for texts in batches:
            rows = [found for some in text_batches(texts) for found in matches(held.value, some, threshold, gram, overlap)]
            yield pd.Series([[dict(zip(names, row, strict=True)) for row in found] for found in rows])

    return found(text_or_empty(text))


def contaminated(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
    threshold: float = THRESHOLD, gram: int = GRAM, overlap: float = OVERLAP, shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """One row per document and item it holds: key, item_id, score, question_overlap, answer_overlap, first_word of the best passage."""
    out = None
    for items in shards(benchmark, item, text, shard_bytes):
        found = docs.select(F.col(quoted(key)).alias("__key"), matched(docs, text, items, threshold, gram, overlap).alias("__match"))
        rows = found.filter(F.size("__match") > 0).select(F.col("__key").alias(key), F.inline("__match"))
        out = rows if out is None else materialize(out.unionByName(rows), "matches")
    return out


def without_benchmark(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id",
    threshold: float = THRESHOLD, gram: int = GRAM, overlap: float = OVERLAP, shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """The rows of `docs` that hold no item, with their own columns."""
    spare = "match" + "_" * max(map(len, docs.columns))
    kept = docs
    for number, items in enumerate(shards(benchmark, item, text, shard_bytes)):
        kept = materialize(kept, "clean") if number else kept
        kept = kept.withColumn(spare, matched(docs, text, items, threshold, gram, overlap)).filter(F.size(spare) == 0).drop(spare)
    return kept
