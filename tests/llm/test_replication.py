import hashlib
import math

from pyspark.sql import functions as F

from tidemart.llm import replication as rp


def drawn(rate, seed, key):
    """Copies of one document, plainly."""
    parts = max(1, math.ceil(rate / rp.PART_RATE))
    total = 0
    for part in range(1, parts + 1):
        digest = hashlib.md5(f"{seed}:{'' if key is None else key}:{part}".encode()).hexdigest()
        u = (int(digest[:13], 16) + 0.5) / (1 << 52)
        p = below = math.exp(-rate / parts)
        k = 0
        while below < u:
            k += 1
            p *= rate / parts / k
            below += p
        total += k
    return total


def counts(df):
    return {(r["doc_id"], r["source"]): r["n"] for r in df.groupBy("doc_id", "source").agg(F.count(F.lit(1)).alias("n")).collect()}


def test_copies_equal_the_inverse_distribution(spark):
    rows = [(i, "x" * (i % 50), "abc"[i % 3]) for i in range(600)] + [(None, "yy", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    weights = {"a": 1.0, "b": 90.0, "c": 3.0, "": 1.0}
    rates = {r["source"]: r["rate"] for r in rp.source_rates(docs, weights, total=40_000.0).collect()}
    assert max(rates.values()) > rp.PART_RATE
    got = counts(rp.mix(docs, weights, seed=5, total=40_000.0))
    assert got == {(key, source): n for key, _, source in rows if (n := drawn(rates[source], 5, key))}


def test_shares_come_near_the_weights(spark):
    docs = spark.createDataFrame([(i, "word " * 20, "big" if i % 10 else "small") for i in range(4000)], "doc_id long, text string, source string")
    mixed = rp.mix(docs, {"big": 1.0, "small": 1.0}, seed=1)
    mass = {r["source"]: r["n"] for r in mixed.groupBy("source").agg(F.sum(F.length("text")).alias("n")).collect()}
    assert abs(mass["small"] / (mass["small"] + mass["big"]) - 0.5) < 0.03
    assert abs((mass["small"] + mass["big"]) / (4000 * 100) - 1) < 0.05


def test_salted_join_gives_the_same(spark, monkeypatch):
    docs = spark.createDataFrame([(i, "xy", "abcd"[i % 4]) for i in range(200)], "doc_id long, text string, source string").union(
        spark.createDataFrame([(900, "xy", None)], "doc_id long, text string, source string")
    )
    whole = sorted(map(tuple, rp.mix(docs, seed=2).collect()), key=repr)
    monkeypatch.setattr(rp, "BROADCAST_SOURCES", 0)
    assert sorted(map(tuple, rp.mix(docs, seed=2).collect()), key=repr) == whole


def test_rows_are_shuffled_over_sources(spark):
    docs = spark.createDataFrame([(i, "x", "a" if i < 500 else "b") for i in range(1000)], "doc_id long, text string, source string")
    sources = [r["source"] for r in rp.mix(docs, seed=3).collect()]
    runs = 1 + sum(a != b for a, b in zip(sources, sources[1:], strict=False))
    assert runs > 300


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, "a"), (2, "", "a"), (3, "x", "b"), (3, "x", "b")], "doc_id long, text string, source string").withColumn("copy", F.lit("own"))
    mixed = rp.mix(docs, seed=4)
    assert mixed.columns == ["doc_id", "text", "source", "copy"]
    assert {r["source"] for r in mixed.collect()} <= {"b"} and {r["source"]: r["rate"] for r in rp.source_rates(docs).collect()}["a"] == 0.0
    assert rp.mix(docs.limit(0)).collect() == []
    plan = mixed._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
