"""Spelling variants against brute force."""

import random
import re
from collections import Counter

import pytest

from tidemart.llm import spelling
from tidemart.llm.queries import planted_typo

DOCS = "doc_id long, text string"


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(a == b[:i] + b[i + 1 :] for i in range(len(b)))


def brute_counts(docs, altered=None):
    counts = Counter()
    for key, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if c.isascii() else c for c in run)
            word = altered("" if key is None else str(key), word) if altered else word
            counts[word] += 1
    return {word: n for word, n in counts.items() if len(word) >= 5 and n >= 3}


def brute_variants(counts, times=2):
    near = {word: [other for other in counts if one_edit(word, other)] for word in counts}
    form = {}
    for word, others in near.items():
        best = min(others, key=lambda other: (-counts[other], other.encode()), default=None)
        form[word] = best if best and counts[best] >= times * counts[word] else None
    rows = []
    for word in counts:
        root = word
        while form[root]:
            root = form[root]
        rows.append((word, form[word], root, counts[word], len(near[word]), counts.get(form[word])))
    return sorted(rows)


@pytest.mark.parametrize("letters", ["ab", "abcdeé", "thoneria"])
def test_variants_are_those_of_brute_force(spark, letters):
    draw = random.Random(letters)
    words = {"".join(draw.choice(letters) for _ in range(draw.randint(5, 9))) for _ in range(400)}
    counts = {word: draw.choice([3, 4, 6, 8, 16, 40]) for word in words}
    got = spelling.variants(spark.createDataFrame(list(counts.items()), "word string, n long")).collect()
    assert sorted(map(tuple, got)) == brute_variants(counts)


def test_every_near_pair_shares_a_signature():
    draw = random.Random(5)
    for _ in range(300):
        word = "".join(draw.choice("abcé") for _ in range(draw.randint(1, 12)))
        at = draw.randrange(len(word))
        others = [word[:at] + "z" + word[at + 1 :], word[:at] + word[at + 1 :], word[:at] + draw.choice("abcz") + word[at:]]
        signed = spelling.signatures([word, *others])
        for k in range(1, 4):
            equal = any(kind == spelling.EQUAL and values[0] == values[k] for kind, values in signed)
            short = [values for kind, values in signed if kind == spelling.SHORTER]
            long = [values for kind, values in signed if kind == spelling.LONGER]
            either = any(s[0] == o[k] or s[k] == o[0] for s, o in zip(short, long, strict=True))
            assert equal if len(others[k - 1]) == len(word) else either, (word, others[k - 1])


def test_words_of_odd_texts(spark):
    docs = [
        (1, "Größe GRÖSSE größe, größe; größe"), (1, "Größe GRÖSSE größe, größe; größe"), (None, "naïve naïve naïve naive naive naive nave"), (2, None), (3, ""),
        (4, "naive-naïve 漢字漢字漢字 ab́cdef ÀÈÌÒÙ ÀÈÌÒÙ ÀÈÌÒÙ àèìòù ×÷×÷×÷ ×÷×÷×÷ ×÷×÷×÷"), (5, "x" * 70_000 + " " + "x" * 70_000 + " y" + "x" * 69_999 + "1" + "x" * 70_000),
        (6, "Straße strasse STRASSE strasse"), (6, "kelvinK kelvinK kelvinK İstanbul istanbul"),
    ]
    frame = spark.createDataFrame([(key, text, "clash", 0) for key, text in docs], "doc_id long, text string, word string, n int")
    got = dict(map(tuple, spelling.word_counts(frame).collect()))
    assert got == brute_counts(docs)
    assert got["x" * 70_000] == 3 and got["ÀÈÌÒÙ"] == 3
    many = [(key, " ".join(["tidemark", "embankments"] * 40)) for key in range(600)]
    typos = dict(map(tuple, spelling.word_counts(spark.createDataFrame(many, DOCS), altered=planted_typo, least=1).collect()))
    assert len(typos) > 2 and {word: n for word, n in typos.items() if n >= 3} == brute_counts(many, planted_typo)
    assert sum(typos.values()) == 600 * 80


def test_long_words_ties_and_empty_tables(spark):
    long = "ab" * 400
    counts = {long: 9, long + "a": 3, "tower": 6, "tower" + "s": 6, "towes": 3, "zzzzz": 3, "towed": 6}
    got = spelling.variants(spark.createDataFrame(list(counts.items()), "word string, n long")).collect()
    assert sorted(map(tuple, got)) == brute_variants(counts)
    assert {row.word: row.form for row in got}["towes"] == "towed"
    assert spelling.variants(spelling.word_counts(spark.createDataFrame([], DOCS))).collect() == []


def test_chains_of_forms_end_at_the_last(spark):
    words = ["aaaaa" + "b" * k for k in range(12)]
    counts = {word: 3 * 2**k for k, word in enumerate(words)}
    got = spelling.variants(spark.createDataFrame(list(counts.items()), "word string, n long")).collect()
    assert {row.root for row in got} == {words[-1]} and sorted(map(tuple, got)) == brute_variants(counts)
