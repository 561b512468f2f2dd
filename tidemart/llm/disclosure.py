"""Information-theoretic sanitisation: personal data, and the terms that give it away.

E-mail addresses, network addresses, payment cards and phone numbers are found by pattern in whole texts; each value
is a protected entity. How much a term tells about an entity is its pointwise mutual information with
it over the entity's own information, log2(p(t, e) / (p(t) p(e))) / -log2 p(e): 1 if the term occurs with
that entity only, 0 if it is independent of it. Probabilities are shares of documents: with the entity, with the term
anywhere, with the term among the `WINDOW` words on either side of the entity. A pair counts from `support`
different surroundings of the entity on, so that copies of one document are no evidence. Near an entity that it discloses by
`remove` or more a term is removed, from `generalise` on it is put in general terms; the entities become their kind.

Counts cover all documents: pairs are summed in each task before they are shuffled, and so are term counts; disclosing pairs
meet their occurrences under salts. Null texts are empty. Rows with equal key and text are one document to
the join that brings terms back, and get equal spans. Positions count code points, ends are exclusive.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.llm.rows import quoted, text_or_empty
from tidemart.session import materialize

KINDS = ("email", "ip", "card", "phone")
WINDOW, REACH = 8, 200
SUPPORT, GENERALISE, REMOVE = 3, 0.7, 0.9
SALTS = 16
GENERALISED, REMOVED = "term_generalised", "term_removed"

_domain = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_name_end = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_numbers = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
_card = re.compile(r"[0-9](?:[ -]?[0-9])+")
_phone = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_word = regex.compile(r"[\p{L}\p{M}\p{N}_]+")
_name_letters = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """From each @: the name before it back to the last match at most, the domain after it. Linear in the text."""
    free = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _name_letters:
            start -= 1
        domain = _domain.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            free = domain.end()
        else:
            free = max(free, at + 1)
        at = text.find("@", free)


def addresses(text: str) -> Iterator[tuple[int, int]]:
    """Every four numbers in a row of numbers and dots, those with a part over 255 left out."""
    for chain in _numbers.finditer(text):
        start, parts = chain.start(), chain.group().split(".")
        for first in range(0, len(parts) - 3, 4):
            four = parts[first : first + 4]
            end = start + sum(map(len, four)) + 3
            if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or "0") <= 255 for part in four):
                yield start, end
            start = end + 1


def luhn(digits: str) -> bool:
    total = sum(int(digit) for digit in digits[::-2]) + sum((0, 2, 4, 6, 8, 1, 3, 5, 7, 9)[int(digit)] for digit in digits[-2::-2])
    return total % 10 == 0


def cards(text: str) -> Iterator[tuple[int, int]]:
    for found in _card.finditer(text):
        if 16 <= found.end() - found.start() <= 37:
            digits = found.group().replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                yield found.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    for found in _phone.finditer(text):
        if 8 <= sum(character.isdigit() for character in found.group()) <= 15:
            yield found.span()


FINDERS = {"email": emails, "ip": addresses, "card": cards, "phone": phones}


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans by kind as listed, then by start."""
    return [(kind, start, end) for kind in KINDS for start, end in FINDERS[kind](text)]


def entity_of(kind: str, value: str) -> str:
    """What makes two spellings one entity."""
    return f"{kind}:{value.lower() if kind in ('email', 'ip') else re.sub('[^0-9]', '', value)}"


def surroundings(text: str, start: int, end: int) -> list[tuple[str, int, int]]:
    """The words on either side of a span, lower case, with their places; whole words only, as `words_of` has them."""
    low, high = max(0, start - REACH), min(len(text), end + REACH)
    before = [(m.group().lower(), m.start(), m.end()) for m in _word.finditer(text, low, start) if m.start() > low or not low]
    after = [(m.group().lower(), m.start(), m.end()) for m in _word.finditer(text, end, high) if m.end() < high or high == len(text)]
    if before and before[-1][2] == start and _word.match(text, start):
        before.pop()
    if after and after[0][1] == end and _word.match(text, end - 1):
        after.pop(0)
    return before[-WINDOW:] + after[:WINDOW]


def words_of(text: str) -> set[str]:
    """Distinct lower-case words of a text."""
    return {word.lower() for word in set(_word.findall(text))}


def scanned(text: Column) -> Column:
    """Struct of the base spans, and of each entity's surrounding words outside all base spans."""

    @F.pandas_udf("struct<spans:array<struct<kind:string,start:int,end:int>>,near:array<struct<entity:string,around:long,term:string,start:int,end:int>>>")
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            spans, near = [], []
            for one in texts:
                own = base_spans(one)
                spans.append([{"kind": kind, "start": start, "end": end} for kind, start, end in own])
                close = []
                for kind, start, end in own:
                    words = [word for word in surroundings(one, start, end) if all(word[2] <= s or word[1] >= e for _, s, e in own)]
                    around = int(pd.util.hash_array(np.array([" ".join(word for word, _, _ in words)], dtype=object))[0] >> np.uint64(1))
                    entity = entity_of(kind, one[start:end])
                    close += [{"entity": entity, "around": around, "term": term, "start": s, "end": e} for term, s, e in words]
                near.append(close)
            yield pd.DataFrame({"spans": spans, "near": near})

    return found(text)


def term_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(term, n): how many texts hold a term, summed by Arrow batch."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = Counter(term for one in batch.column(0) for term in words_of(one.as_py()))
            yield pa.RecordBatch.from_pydict({"term": pa.array(list(counts), pa.string()), "n": pa.array(list(counts.values()), pa.int64())})

    return docs.select(text_or_empty(text).alias("text")).mapInArrow(counted, "term string, n long")


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Each row's key, the hash of its text, its base spans and the words near them; written once."""
    rows = docs.select(F.col(quoted(key)).alias("key"), text_or_empty(text).alias("text"))
    found = rows.select("key", F.xxhash64("text").alias("hash"), scanned(F.col("text")).alias("found"))
    return materialize(found.select("key", "hash", "found.spans", "found.near"), "spans")


def disclosures(docs: DataFrame, found: DataFrame, text: str = "text", support: int = SUPPORT, generalise: float = GENERALISE) -> DataFrame:
    """(entity, term, disclosure) of the pairs that reach `generalise`, from counts over all of `docs`."""
    near = found.filter(F.size("near") > 0).select(F.array_distinct(F.transform("near", lambda n: F.struct(n["entity"], n["around"], n["term"]))).alias("near"))
    entities = found.filter(F.size("near") > 0).select(F.explode(F.array_distinct(F.transform("near", lambda n: n["entity"]))).alias("entity"))
    with_entity = entities.groupBy("entity").agg(F.count(F.lit(1)).alias("n_entity"))
    rows = near.withColumn("here", F.monotonically_increasing_id()).select("here", F.inline("near"))
    once = rows.groupBy("here", "entity", "term").agg(F.min("around").alias("around"))  # a document counts once for a pair
    surrounded = once.groupBy("entity", "term", "around").agg(F.count(F.lit(1)).alias("n"))
    pairs = surrounded.groupBy("entity", "term").agg(F.sum("n").alias("n_pair"), F.count(F.lit(1)).alias("n_around")).filter(F.col("n_around") >= support)
    pairs = materialize(pairs.join(with_entity, "entity"), "pairs")
    terms = term_counts(docs, text).groupBy("term").agg(F.sum("n").alias("n_term"))
    counted = pairs.join(terms, "term")  # a word near an entity is one of its text's words
    total = F.lit(float(max(1, found.count())))
    log2 = F.log2
    information = log2(total / F.col("n_entity"))
    mutual = log2(F.col("n_pair") * total / (F.col("n_term") * F.col("n_entity")))
    share = F.when(information > 0, mutual / information).otherwise(F.lit(0.0))
    return counted.select("entity", "term", share.alias("disclosure")).filter(F.col("disclosure") >= generalise)


def term_spans(found: DataFrame, telling: DataFrame, remove: float = REMOVE) -> DataFrame:
    """(key, hash, terms): the spans of disclosing terms of each document that has some."""
    salted = F.pmod(F.xxhash64("hash"), F.lit(SALTS)).cast("int")
    near = found.filter(F.size("near") > 0).select("key", "hash", F.inline("near")).withColumn("salt", salted)
    spread = telling.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    hits = near.join(spread, ["entity", "term", "salt"]).groupBy("key", "hash", "start", "end").agg(F.max("disclosure").alias("disclosure"))
    kind = F.when(F.col("disclosure") >= remove, F.lit(REMOVED)).otherwise(F.lit(GENERALISED))
    spans = hits.select("key", "hash", F.struct(kind.alias("kind"), "start", "end").alias("span"))
    return spans.groupBy("key", "hash").agg(F.sort_array(F.collect_list("span")).alias("terms"))  # within one text's windows


def find_spans(
    docs: DataFrame, key: str = "doc_id", text: str = "text", support: int = SUPPORT, generalise: float = GENERALISE, remove: float = REMOVE
) -> DataFrame:
    """Per document: key, hash of its text, base `spans`, and `terms`, the spans the method adds (empty if none)."""
    found = scan(docs, key, text)
    terms = term_spans(found, disclosures(docs, found, text, support, generalise), remove)
    joined = found.select("key", "hash", "spans").alias("f").join(
        terms.alias("t"), F.col("f.key").eqNullSafe(F.col("t.key")) & (F.col("f.hash") == F.col("t.hash")), "left"
    )
    none = F.expr("cast(array() as array<struct<kind:string,start:int,end:int>>)")
    return joined.select(F.col("f.key").alias(key), F.col("f.hash").alias("text_hash"), F.col("f.spans").alias("spans"), F.coalesce("t.terms", none).alias("terms"))


def joined_spans(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def span_report(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Counts by kind, the digest of the base spans, and all spans as text."""
    spans = find_spans(docs, key, text, **options)

    def of_kind(kind: str) -> Column:
        return F.size(F.filter("spans", lambda span: span["kind"] == kind)).cast("long")

    counts = {f"n_{kind}": of_kind(kind) for kind in KINDS}
    return spans.select(
        F.col(quoted(key)), *[count.alias(name) for name, count in counts.items()], F.size("terms").cast("long").alias("n_terms"),
        F.sha2(joined_spans(F.col("spans")), 256).alias("base_sha256"), joined_spans(F.concat("spans", "terms")).alias("spans"),
    )


def rewritten(text: str, spans: list[tuple[str, int, int]]) -> str:
    """`text` with spans replaced: entities by their kind, general terms for terms, nothing for removed ones; of overlapping spans the first counts."""
    out, at = [], 0
    for start, end, kind in sorted((start, end, kind) for kind, start, end in spans):
        if start < at:
            continue
        word = text[start:end]
        general = "<number>" if word.isdigit() else "<name>" if word[:1].isupper() else "<term>"
        out += [text[at:start], "" if kind == REMOVED else general if kind == GENERALISED else f"<{kind}>"]
        at = end
    return "".join(out) + text[at:]


def sanitise(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """`docs` with their texts rewritten; null texts become empty."""
    spans = find_spans(docs, key, text, **options)
    spans = spans.select(F.col(quoted(key)).alias("k"), F.col("text_hash").alias("h"), F.concat("spans", "terms").alias("all")).filter(F.size("all") > 0).distinct()

    @F.pandas_udf("string")
    def cleaned(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, found in batches:
            pairs = zip(texts, found, strict=True)
            yield pd.Series([rewritten(one, [(s["kind"], s["start"], s["end"]) for s in some] if some is not None else []) for one, some in pairs], dtype=object)

    rows = docs.alias("d").join(
        spans.alias("s"), F.col(f"d.{quoted(key)}").eqNullSafe(F.col("s.k")) & (F.xxhash64(F.coalesce(F.col(f"d.{quoted(text)}").cast("string"), F.lit(""))) == F.col("s.h")), "left"
    )
    whole = F.coalesce(F.col(f"d.{quoted(text)}").cast("string"), F.lit(""))
    return rows.select(*[cleaned(whole, F.col("s.all")).alias(text) if name == text else F.col(f"d.{quoted(name)}") for name in docs.columns])
