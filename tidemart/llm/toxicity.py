"""Toxicity by compression distance: what a dictionary of toxic text saves over one of ordinary text, window by window.

Two zstandard dictionaries are trained on labelled text, each from its own kind. Both hold the words that ordinary text
uses most. The one for toxic text also holds the passages of words that toxic text has and ordinary text
hardly ever has: runs of `GRAM`-letter sequences counted over distinct contexts (a word and the one before it), so
that copies of one document are not evidence, kept where they are `RATIO` times as frequent in toxic text. In the
other the same room is empty, so that distances and everything else compress alike.

A text is cut into windows of `WORDS` words, and a window of more than `WINDOW_BYTES` bytes (long runs without blanks) into cuts
of that size, which overlap by the longest passage's length so that none is split; the compressor refers to its
dictionary only near the beginning of what it gets. Each is compressed with both dictionaries (after a head that both
know, without which a short window would be stored as it is). The difference in length is the window's gain. The
largest gain, the sum of gains from `least_gain` on and the number of windows are put through a logistic
function; its weights and `least_gain` are calibrated on labelled texts that the dictionaries have not seen.

The classifier is fitted on a bounded sample of labelled rows: at most `max_toxic` and `max_ordinary` rows with the
smallest hashes of their keys, and of these whole texts up to `max_bytes` of text. Scoring has no bound: every
window of every text counts. Without both kinds in the sample all scores are 0.
Null texts are empty, rows are scored one by one, repeated rows get equal scores.
"""

from __future__ import annotations

import random
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import zstandard as zstd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.llm.rows import quoted, text_or_empty, with_results

WORDS = 8
WINDOW_BYTES = 256
GRAM = 6
RATIO = 20.0
BASE_BYTES, TOXIC_BYTES = 24_000, 6_000
LEVEL = 3
#: Known to both dictionaries; long enough that compressing a window always pays.
HEAD = b"|0123456789abcdefghij9876543210|"
#: Between words, so that the beginning of a word fills a match with few letters of its own.
GAP = "  "
MARKS = ".,!?;:\"'()[]{}#*$%&|<>"


def cuts_of(window: bytes, overlap: int) -> Iterator[bytes]:
    """`window` in cuts of about `WINDOW_BYTES` bytes (two overlaps at least), between code points."""
    size = max(WINDOW_BYTES, 2 * overlap)
    start = 0
    while len(window) - start > size:
        end = start + size
        while window[end] & 0xC0 == 0x80:
            end -= 1
        yield window[start:end]
        start = end - overlap
        while window[start] & 0xC0 == 0x80:
            start -= 1
    yield window[start:]


def windows_of(text: str, overlap: int = 0) -> list[bytes]:
    words = text.lower().split()
    whole = ((GAP + GAP.join(words[i : i + WORDS]) + GAP).encode() for i in range(0, len(words), WORDS))
    return [HEAD + cut for window in whole for cut in ((window,) if len(window) <= WINDOW_BYTES else cuts_of(window, overlap))]


def contexts(texts: list[str]) -> set[tuple[str, str]]:
    """Distinct pairs of a word and the one before it."""
    pairs: set[tuple[str, str]] = set()
    for text in texts:
        words = [word for word in (one.strip(MARKS) for one in text.lower().split()) if word]
        pairs.update(zip(["", *words], words, strict=False))
    return pairs


def gram_counts(words: Counter) -> Counter:
    counts: Counter = Counter()
    for word, n in words.items():
        spelt = GAP + word + GAP
        for gram in {spelt[i : i + GRAM] for i in range(max(1, len(spelt) - GRAM + 1))}:
            counts[gram] += n
    return counts


def toxic_passages(toxic: list[str], ordinary: list[str], ratio: float = RATIO, room: int = TOXIC_BYTES) -> bytes:
    """Passages of words that set toxic text apart, the most frequent last, apart from each other by zero bytes."""
    own = Counter(word for _, word in contexts(toxic))
    other = Counter(word for _, word in contexts(ordinary))
    have, lack = gram_counts(own), gram_counts(other)
    all_own, all_other = max(1, own.total()), max(1, other.total())
    least = max(4, len(toxic) // 100)
    telling = {gram for gram, n in have.items() if n >= least and n / all_own >= ratio * (lack[gram] + 0.5) / all_other}
    runs: Counter = Counter()
    for word, n in own.items():
        spelt = GAP + word + GAP
        start = None
        places = max(1, len(spelt) - GRAM + 1)
        for i in range(places + 1):
            if i < places and spelt[i : i + GRAM] in telling:
                start = i if start is None else start
            elif start is not None:
                runs[spelt[start : i - 1 + GRAM]] += n
                start = None
    chosen: list[bytes] = []
    size = 0
    for run, _ in sorted(runs.items(), key=lambda item: (-item[1], item[0])):
        size += len(run.encode()) + 1
        if size > room:
            break
        chosen.append(run.encode())
    return b"\0".join(reversed(chosen))


@dataclass(frozen=True)
class Classifier:
    base: bytes
    toxic: bytes
    least_gain: int = 2
    weights: tuple[float, ...] = (0.0, 0.0, 0.0, 0.0)  # of 1, the largest gain, the sum of gains, the number of windows
    fitted: bool = False

    def compressor(self, rest: bytes) -> zstd.ZstdCompressor:
        content = self.base + HEAD + rest
        parameters = zstd.ZstdCompressionParameters.from_level(
            LEVEL, source_size=128, dict_size=len(content), min_match=GRAM, write_content_size=False, write_checksum=False, write_dict_id=False
        )
        dictionary = zstd.ZstdCompressionDict(content, dict_type=zstd.DICT_TYPE_RAWCONTENT)
        dictionary.precompute_compress(compression_params=parameters)
        return zstd.ZstdCompressor(dict_data=dictionary, compression_params=parameters)

    @cached_property
    def compressors(self) -> tuple[zstd.ZstdCompressor, zstd.ZstdCompressor]:
        return self.compressor(bytes(len(self.toxic))), self.compressor(self.toxic)

    @cached_property
    def longest(self) -> int:
        """Bytes of the longest passage."""
        return max(map(len, self.toxic.split(b"\0")))

    def gains(self, text: str) -> list[int]:
        plain, toxic = (one.compress for one in self.compressors)
        return [len(plain(window)) - len(toxic(window)) for window in windows_of(text, self.longest)]

    def features(self, gains: list[int], least: int) -> tuple[float, float, float, float]:
        return 1.0, float(max(gains, default=0)), float(np.log1p(sum(gain for gain in gains if gain >= least))), float(np.log1p(len(gains)))

    def score(self, gains: list[int]) -> float:
        if not self.fitted:
            return 0.0
        return float(1 / (1 + np.exp(-np.clip(np.dot(self.weights, self.features(gains, self.least_gain)), -40, 40))))

    def __getstate__(self):  # compressors stay where they are made
        return {name: self.__dict__[name] for name in ("base", "toxic", "least_gain", "weights", "fitted")}


def logistic_weights(features: np.ndarray, labels: np.ndarray, ridge: float = 0.1) -> tuple[np.ndarray, float]:
    """Weights by Newton steps, and the mean loss."""
    weights = np.zeros(features.shape[1])
    penalty = ridge * np.diag([0.0, *[1.0] * (features.shape[1] - 1)])
    for _ in range(100):
        chance = 1 / (1 + np.exp(-np.clip(features @ weights, -40, 40)))
        slope = features.T @ (chance - labels) + penalty @ weights
        step = np.linalg.solve((features * (chance * (1 - chance))[:, None]).T @ features + penalty + 1e-9 * np.eye(len(weights)), slope)
        weights = weights - step
        if np.abs(step).max() < 1e-8:
            break
    chance = np.clip(1 / (1 + np.exp(-np.clip(features @ weights, -40, 40))), 1e-12, 1 - 1e-12)
    return weights, float(-(labels * np.log(chance) + (1 - labels) * np.log(1 - chance)).mean())


def fit(toxic: list[str], ordinary: list[str]) -> Classifier:
    """Dictionaries from two thirds of the texts of each kind, calibration on the last third."""
    if not toxic or not ordinary:
        return Classifier(b"", b"")
    learn = [[text for place, text in enumerate(texts) if place % 3 or len(texts) < 3] for texts in (toxic, ordinary)]
    check = [[text for place, text in enumerate(texts) if not place % 3 or len(texts) < 3] for texts in (toxic, ordinary)]
    common = Counter(word for text in learn[1] for word in set(text.lower().split()))
    words = [word for word, _ in sorted(common.items(), key=lambda item: (-item[1], item[0]))[:6000]]
    random.Random(3).shuffle(words)
    classifier = Classifier(GAP.join(words).encode()[:BASE_BYTES], toxic_passages(*learn))
    gains = [classifier.gains(text) for texts in check for text in texts]
    labels = np.concatenate([np.ones(len(check[0])), np.zeros(len(check[1]))])
    trials = []
    for least in (1, 2, 3, 4):
        weights, loss = logistic_weights(np.array([classifier.features(one, least) for one in gains]), labels)
        trials.append((loss, least, tuple(weights.tolist())))
    _, least, weights = min(trials)
    return Classifier(classifier.base, classifier.toxic, least, weights, True)


def labelled_sample(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
    max_toxic: int = 2000, max_ordinary: int = 4000, max_bytes: int = 24 << 20,
) -> tuple[list[str], list[str]]:
    """Whole toxic and ordinary texts, in order of the hash of their key, within the bounds."""
    order = F.md5(F.col(quoted(key)).cast("string"))
    picked = []
    for value, bound in ((1, max_toxic), (0, max_ordinary)):
        some = labels.filter((F.col(label) == value) & F.col(quoted(key)).isNotNull()).select(F.col(quoted(key)).alias("key"), F.lit(value).alias("label"), order.alias("place"))
        picked.append(some.orderBy("place", "key").limit(bound))
    ids = F.broadcast(picked[0].unionByName(picked[1]))  # `max_toxic` + `max_ordinary` rows at most
    found = docs.select(F.col(quoted(key)).alias("key"), text_or_empty(text).alias("text")).join(ids, "key")
    sizes = sorted((r["place"], r["key"], r["label"], r["n"]) for r in found.select("place", "key", "label", F.octet_length("text").alias("n")).collect())
    room = {0: max_bytes * 2 // 3, 1: max_bytes // 3}
    kept = []
    for _, one, value, n in sizes:
        if n <= room[value]:
            room[value] -= n
            kept.append(one)
    spark = docs.sparkSession
    chosen = spark.createDataFrame([(one,) for one in kept], f"key {labels.schema[key].dataType.simpleString()}")
    rows = found.join(F.broadcast(chosen), "key", "left_semi").select("place", "label", "text").collect()
    texts = sorted((r["place"], r["text"], r["label"]) for r in rows)
    return [text for _, text, value in texts if value == 1], [text for _, text, value in texts if value == 0]


def scores(text: Column, classifier: Classifier, spark) -> Column:
    held = spark.sparkContext.broadcast(classifier)  # some ten kilobytes

    @F.pandas_udf("struct<score:double,max_gain:int,n_windows:long>")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = held.value
        for texts in batches:
            rows = [(own.score(gains), max(gains, default=0), len(gains)) for gains in map(own.gains, texts)]
            yield pd.DataFrame(rows, columns=["score", "max_gain", "n_windows"])

    return scored(text)


def score_documents(docs: DataFrame, classifier: Classifier, text: str = "text", cut: float = 0.3) -> DataFrame:
    """`docs` with score, predicted, max_gain (bytes saved in one window) and n_windows; input columns of these names give way."""
    spare = "scored" + "_" * max(map(len, docs.columns))
    found = docs.withColumn(spare, scores(text_or_empty(text), classifier, docs.sparkSession))
    one = F.col(spare)
    results = {"score": one["score"], "predicted": (one["score"] >= cut).cast("int"), "max_gain": one["max_gain"], "n_windows": one["n_windows"]}
    return with_results(found, results).drop(spare)
