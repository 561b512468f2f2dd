"""Quality rules from tokeniser fertility, with rejection bands per language or script.

Public vocabularies say how well a text fits what they were made from. Three measures are taken over the
words of a whole text (each with the blank before it): characters per token of a byte-level vocabulary, the
share of characters that a piece vocabulary can only spell as bytes, and the entropy of the token distribution over
the entropy it could have at that length (`SPREAD_TOKENS` tokens at most, as prose stops spreading there). A text outside the band of its language is rejected; a language
without a band falls to the band of its script, then to the common one.

Null texts are empty. Texts under `min_words` words fail the base rules and are not held against a band.
Rows are judged one by one, so repeated rows get equal results, and null languages use the script.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import asdict, dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.llm import vocab
from tidemart.llm.rows import quoted, text_or_empty, with_results

SYMBOLS = "#*$%&|<>"
WINDOW = 8
MARKS = b".,!?;:"
SPREAD_TOKENS = 1024
MEASURES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
    "script string, chars_per_token double, byte_share double, token_entropy double, kept boolean"
)


@dataclass(frozen=True)
class Band:
    """What passes: characters per token from `low` to `high`, byte share and relative entropy up to a bound and from one on."""

    low: float = 0.8
    high: float = 8.0
    byte_share: float = 0.5
    entropy: float = 0.3


@dataclass(frozen=True)
class Bands:
    """Bands by language (`lang` column) and by script, and the one for all others."""

    languages: dict[str, Band] = field(default_factory=dict)
    scripts: dict[str, Band] = field(
        default_factory=lambda: {
            "latin": Band(1.3, 8.0, 0.2, 0.605),
            "cyrillic": Band(0.5, 4.0, 0.3, 0.3),
            "greek": Band(0.4, 4.0, 0.5, 0.3),
            "cjk": Band(0.2, 3.0, 0.8, 0.2),
            "none": Band(0.5, 8.0, 0.6, 0.2),
        }
    )
    other: Band = Band(0.2, 8.0, 0.9, 0.2)

    def of(self, lang: str | None, script: str) -> Band:
        return self.languages.get(lang or "") or self.scripts.get(script, self.other)


#: Wide enough for prose; symbol lists and shouted or repeated filler fall out.
DEFAULT_BANDS = Bands()


def script_of(letters: dict[str, int]) -> str:
    """The script that most letters are of; ties go to the first name."""
    return min(letters, key=lambda name: (-letters[name], name)) if letters else "none"


def scripts_in(text: str) -> dict[str, int]:
    """Letters of each script; plain ASCII can only be Latin and is not counted."""
    if text.isascii():
        return {"latin": 1} if re.search("[A-Za-z]", text) else {}
    counts: dict[str, int] = {}
    for character in set(text):
        if character.isalpha():
            name = unicodedata.name(character, "OTHER").split()[0].lower()
            name = "cjk" if name in ("cjk", "hiragana", "katakana", "hangul") else name
            counts[name] = counts.get(name, 0) + text.count(character)
    return counts


def repeated_words(words: list[bytes]) -> int:
    """Words inside windows of eight words that the text holds at least twice; the first occurrence counts."""
    if len(words) <= WINDOW:
        return 0
    hashed = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    n = len(words) - WINDOW + 1
    rolled = hashed[:n].copy()
    for step in range(1, WINDOW):
        rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + hashed[step : n + step]
    if len(np.unique(rolled)) == n:
        return 0
    # exact: number the words, then the pairs, the fours and the eights
    codes = pd.factorize(np.array(words, dtype=object))[0].astype(np.int64)
    for step in (1, 2, 4):
        codes = pd.factorize(codes[:-step] * (codes.max() + 1) + codes[step:])[0].astype(np.int64)
    twice = np.bincount(codes)[codes] > 1
    edges = np.zeros(len(words) + 1, np.int64)
    starts = np.flatnonzero(twice)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + WINDOW, -1)
    return int((np.cumsum(edges)[:-1] > 0).sum())


def entropy(ids: np.ndarray) -> float:
    """Entropy of the ids over the logarithm of their number, of `SPREAD_TOKENS` at most; 1 for a single id."""
    if len(ids) < 2:
        return 1.0
    counts = np.bincount(ids) if len(ids) > SPREAD_TOKENS else np.unique(ids, return_counts=True)[1]
    shares = counts[counts > 0] / len(ids)
    return float(-(shares * np.log2(shares)).sum() / np.log2(min(len(ids), SPREAD_TOKENS)))


class Judge:
    """Measures and verdict of one text; vocabularies are opened once in a worker."""

    def __init__(self, bands: Bands, byte_vocabulary: str, piece_vocabulary: str, min_words: int, repeat_percent: int):
        self.bands, self.min_words, self.repeat_percent = bands, min_words, repeat_percent
        self.encoder = vocab.rank_encoder(byte_vocabulary)
        self.spelt = vocab.spelt_characters(piece_vocabulary)

    def ids(self, words: list[bytes], text: str) -> np.ndarray:
        """Ids of the words, each with a blank before it. A token never goes on with a blank behind a character that is no white
        space, so words without other white space in them may be encoded together."""
        if not words:
            return np.zeros(0, np.uint32)
        if vocab.OTHER_BLANK(text) and any(vocab.OTHER_BLANK(word.decode()) for word in words):
            return np.array([one for word in words for one in self.encoder.encode_ordinary(" " + word.decode())], np.uint32)
        return self.encoder.encode_to_numpy((b" " + b" ".join(words)).decode(), disallowed_special=())

    def __call__(self, text: str, lang: str | None) -> tuple:
        raw = text.encode()
        words = raw.split()
        blanks = len(raw) - sum(map(len, words))
        lines = [line for line in raw.split(b"\n") if line.strip()]
        repeated = repeated_words(words)
        failed = len(words) < self.min_words or 100 * repeated > self.repeat_percent * len(words)
        word_chars = len(text) - blanks
        script = script_of(scripts_in(text))
        ids = self.ids(words, text)
        per_token = word_chars / len(ids) if len(ids) else 0.0
        strange = sum(map(text.count, set(text) - self.spelt))
        share = strange / word_chars if word_chars else 0.0
        spread = entropy(ids)
        band = self.bands.of(lang, script)
        fits = band.low <= per_token <= band.high and share <= band.byte_share and spread >= band.entropy
        return (
            len(words), word_chars, sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeated, failed,
            script, per_token, share, spread, not failed and fits,
        )


def measures(
    text: Column,
    lang: Column,
    bands: Bands = DEFAULT_BANDS,
    byte_vocabulary: str | None = None,
    piece_vocabulary: str | None = None,
    min_words: int = 20,
    repeat_percent: int = 30,
) -> Column:
    """Struct of the base counts, the three measures and the verdict, in Arrow batches."""
    ranks = byte_vocabulary or vocab.vocabulary_path(vocab.BYTE_BPE_RANKS)
    pieces = piece_vocabulary or vocab.vocabulary_path(vocab.PIECE_BPE)
    names = [part.split()[0] for part in MEASURES.split(", ")]

    @F.pandas_udf(MEASURES)
    def judged(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        judge = Judge(bands, ranks, pieces, min_words, repeat_percent)
        for texts, langs in batches:
            rows = [judge(one, other) for one, other in zip(texts, langs, strict=True)]
            yield pd.DataFrame(rows, columns=names)

    return judged(text, lang)


def judge_documents(docs: DataFrame, text: str = "text", lang: str | None = "lang", **options) -> DataFrame:
    """`docs` with the measures and `kept`; input columns of these names give way."""
    by = F.col(quoted(lang)).cast("string") if lang else F.lit(None).cast("string")
    names = [part.split()[0] for part in MEASURES.split(", ")]
    spare = "measured" + "_" * max(map(len, docs.columns))
    measured = docs.withColumn(spare, measures(text_or_empty(text), by, **options))
    return with_results(measured, {name: F.col(spare)[name] for name in names}).drop(spare)


def keep_fitting(docs: DataFrame, text: str = "text", lang: str | None = "lang", **options) -> DataFrame:
    """The rows of `docs` that pass, with their own columns."""
    by = F.col(quoted(lang)).cast("string") if lang else F.lit(None).cast("string")
    spare = "measured" + "_" * max(map(len, docs.columns))
    return docs.withColumn(spare, measures(text_or_empty(text), by, **options)["kept"]).filter(F.col(spare)).drop(spare)


def bands_as_rows(bands: Bands = DEFAULT_BANDS) -> list[dict]:
    """The bands in use, for a report."""
    kinds = (("language", bands.languages), ("script", bands.scripts), ("other", {"": bands.other}))
    return [{"by": kind, "name": name, **asdict(band)} for kind, group in kinds for name, band in group.items()]
