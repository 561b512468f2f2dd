import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemart.llm import toxicity as tx


@pytest.fixture(scope="module")
def labelled(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    return docs, labels.filter(F.crc32(F.col("doc_id").cast("string")) % 4 != 2), labels


@pytest.fixture(scope="module")
def classifier(labelled):
    docs, learn, _ = labelled
    return tx.fit(*tx.labelled_sample(docs, learn))


def test_held_out_accuracy(labelled, classifier):
    docs, _, labels = labelled
    rows = tx.score_documents(docs.join(labels, "doc_id"), classifier).select("doc_id", "toxic", "score", "predicted").collect()
    held = [r for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    toxic = np.array([r["score"] for r in held if r["toxic"]])
    ordinary = np.array([r["score"] for r in held if not r["toxic"]])
    area = np.mean([(score > ordinary).mean() + (score == ordinary).mean() / 2 for score in toxic])
    assert area > 0.85  # the labels of some languages in these rows mark words that ordinary texts have too
    assert (toxic >= 0.3).mean() > 0.7 and (ordinary >= 0.3).mean() < 0.05


def test_sample_is_bounded_and_whole(spark):
    docs = spark.createDataFrame([(i, "word " * i) for i in range(1, 60)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 60)], "doc_id long, toxic int")
    toxic, ordinary = tx.labelled_sample(docs, labels, max_toxic=10, max_ordinary=7, max_bytes=1500)
    assert len(toxic) <= 10 and len(ordinary) <= 7
    assert sum(map(len, toxic)) <= 500 and sum(map(len, ordinary)) <= 1000
    assert all(set(text.split()) == {"word"} for text in toxic + ordinary)


def test_passages_need_different_contexts():
    rest = [f"w{i} x{i % 7} y{i % 11} z{i}" for i in range(400)]
    copies = ["the same zork passage again"] * 50
    spread = [f"w{i} grumble x{i}" for i in range(50)]
    passages = tx.toxic_passages(copies + spread, rest)
    assert b"grumble" in passages and b"zork" not in passages


def test_cuts_cover_long_windows_and_split_no_passage():
    text = "".join(chr(0x4E00 + i) + "é🙂a" for i in range(500))
    for overlap in (0, 7, 90, 300):
        cuts = [window[len(tx.HEAD) :].decode() for window in tx.windows_of(text, overlap)]  # no code point is split
        whole = tx.GAP + text + tx.GAP
        at = 0
        for place, cut in enumerate(cuts):
            start = whole.index(cut, max(0, at - overlap - 4)) if place else 0
            assert start <= at and whole.startswith(cut, start) and len(cut.encode()) <= max(256, 2 * overlap)
            assert not place or len(whole[start:at].encode()) >= overlap
            at = start + len(cut)
        assert at == len(whole)


def test_toxic_passages_count_behind_long_runs(classifier):
    toxic = "you stupid idiot, you moron"
    alone = classifier.gains(toxic)
    for run in ("漢字" * 17_000, "Zm9vYmFyMTIz" * 9_000):
        assert max(classifier.gains(f"{run} {toxic}")) >= max(alone) > max(classifier.gains(run), default=0)
    held = max(classifier.toxic.split(b"\0"), key=len).decode().strip()
    assert all(max(classifier.gains("0" * n + held + "0" * 300)) > 2 for n in (0, 250, 10_000, 33_000, 100_000))


def test_odd_rows(spark, classifier):
    docs = spark.createDataFrame([(1, None), (None, ""), (3, "you stupid idiot, you moron"), (3, "you stupid idiot, you moron")], "doc_id long, text string")
    rows = tx.score_documents(docs.withColumn("score", F.lit("own")), classifier).collect()
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert [r["predicted"] for r in sorted(rows, key=lambda r: (r["doc_id"] or 0))] == [0, 0, 1, 1]
    unfitted = tx.fit([], ["x"])
    assert [r["score"] for r in tx.score_documents(docs, unfitted).collect()] == [0.0] * 4
    assert tx.score_documents(docs.limit(0), classifier).collect() == []
