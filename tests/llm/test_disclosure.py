import hashlib
import random
import re

from pyspark.sql import functions as F

from tidemart.llm import disclosure as dc

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(part) <= 255 for part in value.split("."))
    if kind == "card":
        doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
        return 16 <= len(digits) <= 19 and sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0
    return kind == "email" or 8 <= len(digits) <= 15


def by_pattern(text):
    return [(kind, m.start(), m.end()) for kind, pattern in PATTERNS.items() for m in re.finditer(pattern, text) if passes(kind, m.group())]


def test_spans_equal_the_patterns():
    rng = random.Random(1)
    parts = ["a@b.co", "x.y%z@q-1.example.org", "@", "a@b", "1.2.3.4", "256.1.1.1", "1.2.3.4.5.6.7.8.9", "4111 1111 1111 1111", "4111-1111-1111-1112",
             "+1 (234) 567-8901", "+12", " ", ".", "-", "é", "12345678901234567", "b.c@d.e@f.g", "+", "4316522678525456", "00000000000000000", "x"]
    for _ in range(3000):
        text = "".join(rng.choices(parts, k=rng.randint(0, 9)))
        assert dc.base_spans(text) == by_pattern(text), text


def test_long_runs_take_linear_time():
    for text in ("9" * 300_000, "a" * 300_000, "a@" * 100_000, "1." * 100_000, "+1" + "(" * 300_000, "4 " * 200_000):
        dc.base_spans(text)


def corpus():
    rows = [(i, f"plain text number{i} about nothing much") for i in range(60)]
    rows += [(100 + i, f"start{i} please call zorba or write zorba at z@corp.example now end{i}") for i in range(6)]
    rows += [(200, "copies of qwerty with c@corp.example here")] + [(200 + i, "copies of qwerty with c@corp.example here") for i in range(1, 9)]
    return rows


def brute_force(rows, support=dc.SUPPORT):
    """{(entity, term): share} over documents."""
    from math import log2

    texts = [text or "" for _, text in rows]
    near, around, holders = {}, {}, {}
    for place, text in enumerate(texts):
        own = dc.base_spans(text)
        for kind, start, end in own:
            entity = dc.entity_of(kind, text[start:end])
            holders.setdefault(entity, set()).add(place)
            words = [w for w in dc.surroundings(text, start, end) if all(w[2] <= s or w[1] >= e for _, s, e in own)]
            for word, _, _ in words:
                near.setdefault((entity, word), set()).add(place)
                around.setdefault((entity, word), set()).add(" ".join(w for w, _, _ in words))
    out = {}
    for (entity, word), places in near.items():
        if len(around[entity, word]) >= support:
            n_term = sum(word in set(re.findall(r"\w+", text.lower())) for text in texts)
            n, e = len(texts), len(holders[entity])
            share = log2(len(places) * n / (n_term * e)) / log2(n / e) if e < n else 0.0
            if share >= dc.GENERALISE:
                out[entity, word] = round(share, 9)
    return out


def test_disclosing_terms_equal_brute_force(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r["entity"], r["term"]): round(r["disclosure"], 9) for r in dc.disclosures(docs, dc.scan(docs)).collect()}
    assert got == brute_force(rows)
    assert ("email:z@corp.example", "zorba") in got and not any(term == "qwerty" for _, term in got)


def test_words_with_combining_marks_are_counted_whole(spark):
    common, telling = "हिन्दी", "cafe\u0301"
    rows = [(i, f"{common} शब्द{i} ΑΣ'Α ΟΔΟΣ number{i}") for i in range(60)]
    rows += [(100 + i, f"x{i} {common} {telling} ΑΣ'Α y{i} w@corp.example ΟΔΟΣ end{i}") for i in range(6)]
    rows += [(200 + i, f"x{i} {common}v@corp.example z{i}") for i in range(6)]  # the word runs into the entity
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r["entity"], r["term"]): r["disclosure"] for r in dc.disclosures(docs, dc.scan(docs)).collect()}
    assert got == {("email:w@corp.example", telling): 1.0}
    for _, text in rows:
        near = {word for _, start, end in dc.base_spans(text) for word, _, _ in dc.surroundings(text, start, end)}
        assert near <= dc.words_of(text)
    kept = {r["doc_id"]: r["text"] for r in dc.sanitise(docs).collect()}
    assert all(common in text for text in kept.values()) and telling not in kept[100]


def test_texts_are_rewritten(spark):
    docs = spark.createDataFrame(corpus(), "doc_id long, text string").withColumn("terms", F.lit("own"))
    rows = {r["doc_id"]: r["text"] for r in dc.sanitise(docs).collect()}
    assert "zorba" not in rows[100] and "z@corp" not in rows[100] and "<email>" in rows[100] and rows[100].startswith("start0 ")
    assert rows[205] == "copies of qwerty with <email> here"
    assert rows[5] == "plain text number5 about nothing much"


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = dc.span_report(docs).collect()
    assert len(rows) == len(texts)
    for r in rows:
        spans = by_pattern(texts[r["doc_id"]])
        base = ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)
        assert r["base_sha256"] == hashlib.sha256(base.encode()).hexdigest() and r["spans"].startswith(base)
        assert [r[f"n_{kind}"] for kind in dc.KINDS] == [sum(s[0] == kind for s in spans) for kind in dc.KINDS]
    telling = dc.disclosures(docs, dc.scan(docs)).collect()
    assert {(r["entity"], r["term"]) for r in telling} == brute_force(list(texts.items())).keys()


def test_odd_rows(spark):
    docs = spark.createDataFrame([(None, None), (1, ""), (1, "é +1 234 567 890"), (1, "é +1 234 567 890")], "doc_id long, text string")
    rows = sorted((r["doc_id"] or 0, r["n_phone"], r["spans"]) for r in dc.span_report(docs.withColumn("key", F.lit("own"))).collect())
    assert rows == [(0, 0, ""), (1, 0, ""), (1, 1, "phone:2:16"), (1, 1, "phone:2:16")]
    assert dc.span_report(docs.limit(0)).collect() == [] and dc.sanitise(docs.limit(0)).collect() == []
