import random

import numpy as np
from pyspark.sql import functions as F

from tidemart.llm import decontamination as dc


def all_scores(index, words):
    """Every item's best score over the passages, without any bound."""
    best = {}
    n = max(0, -(-len(words) // index.stride) - 2)
    for first in range(n + 1):
        start = first * index.stride
        present = {index.number.get(word) for word in words[start : start + 2 * index.stride]}
        for item, weights in enumerate(index.weights):
            score = sum(value for key, value in weights.items() if key in present)
            best[item] = max(best.get(item, 0.0), score)
    return best


def test_search_finds_all_and_only_items_above_the_threshold():
    rng = random.Random(3)
    vocabulary = [f"w{int(rng.paretovariate(0.6)) % 900}" for _ in range(3000)]
    items = []
    for i in range(90):
        text = " ".join(rng.choices(vocabulary, k=rng.randint(3, 150)))
        items.append((i, text, *dc.parts_of(text)))
    indexes = dc.build_indexes(items)
    assert [index.stride for index in indexes] == [64, 128, 256]
    for _ in range(60):
        words = rng.choices(vocabulary, k=rng.randint(0, 900))
        if rng.random() < 0.5:
            place = rng.randrange(len(words) + 1)
            words[place:place] = rng.choice(items)[1].split()
        for index in indexes:
            for threshold in (0.3, 0.45, 0.6):
                known = np.array([index.spelt[word] for word in words], np.int64)
                found = {item: score for (text, item), (score, _) in dc.retrieve(index, [known[:0], known, known], threshold, 3).items() if text == 2}
                expected = {item: score for item, score in all_scores(index, words).items() if score >= threshold}
                assert found.keys() == expected.keys()
                assert all(abs(found[item] - expected[item]) < 1e-9 for item in found)


def test_whole_items_are_found_and_fragments_are_not(spark):
    benchmark = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    items = [(r["item_id"], dc.words_of(r["text"])) for r in benchmark.collect()]
    texts = [(r["doc_id"], dc.words_of(r["text"] or "")) for r in docs.collect()]
    expected = set()
    for key, words in texts:
        line = " " + " ".join(words) + " "
        expected |= {(key, item) for item, own in items if f" {' '.join(own)} " in line}
    got = {(r["doc_id"], r["item_id"]) for r in dc.contaminated(docs, benchmark).collect()}
    assert expected and got == expected
    clean = {r["doc_id"] for r in dc.without_benchmark(docs, benchmark).select("doc_id").collect()}
    assert clean == {key for key, _ in texts} - {key for key, _ in got}


def test_edits_equal_the_table_of_distances():
    rng = random.Random(5)
    for _ in range(300):
        part, words = rng.choices("abcd", k=rng.randint(1, 9)), rng.choices("abcd", k=rng.randint(0, 20))
        row = list(range(len(part) + 1))
        least = row[-1]
        for word in words:
            new = [0]
            for i, own in enumerate(part):
                new.append(min(row[i] + (own != word), row[i + 1] + 1, new[i] + 1))
            row = new
            least = min(least, row[-1])
        assert dc.edits(part, words) == least


def test_one_changed_word_hides_no_item(spark):
    texts = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.1/benchmark.parquet").collect()]
    items = [(i, text, *dc.parts_of(text)) for i, text in enumerate(texts)]
    indexes = dc.build_indexes(items)
    changed, own = [], []
    for i, text in enumerate(texts):
        words = dc.words_of(text)
        for place in range(len(words)):
            changed.append(" ".join(["before", *words[:place], "changed", *words[place + 1 :], "after"]))
            own.append(i)
    retrieved = [{row[0] for row in found} for found in dc.matches(indexes, changed, dc.THRESHOLD, dc.GRAM, 0.0)]
    verified = [{row[0] for row in found} for found in dc.matches(indexes, changed, dc.THRESHOLD, dc.GRAM, dc.OVERLAP)]
    assert all(i in found for i, found in zip(own, retrieved, strict=True))
    assert all(i in found for i, found in zip(own, verified, strict=True))


def test_shards_give_the_same(spark):
    benchmark = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    whole = {(r["doc_id"], r["item_id"]) for r in dc.contaminated(docs, benchmark).collect()}
    parts = {(r["doc_id"], r["item_id"]) for r in dc.contaminated(docs, benchmark, shard_bytes=2000).collect()}
    assert whole == parts
    assert dc.without_benchmark(docs, benchmark, shard_bytes=2000).count() == dc.without_benchmark(docs, benchmark).count()


def test_odd_rows(spark):
    item = "What is the colour of the sky above the old mill?\nBlue on clear days."
    docs = spark.createDataFrame([(1, f"So it goes. {item} Yes."), (2, None), (None, item.upper()), (4, ""), (1, "x")], "doc_id long, text string")
    docs = docs.withColumn("score", F.lit("own"))
    benchmark = spark.createDataFrame([(7, item), (7, item), (8, None), (9, "")], "item_id long, text string")
    found = sorted((r["doc_id"] or 0, r["item_id"], round(r["score"], 6)) for r in dc.contaminated(docs, benchmark).collect())
    assert found == [(0, 7, 1.0), (0, 7, 1.0), (1, 7, 1.0), (1, 7, 1.0)]
    kept = dc.without_benchmark(docs, benchmark)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 4]
    assert dc.contaminated(docs, benchmark.limit(0)).collect() == []
    assert dc.without_benchmark(docs.limit(0), benchmark).collect() == []
    question_only = spark.createDataFrame([(1, item.split("\n")[0])], "doc_id long, text string")
    assert dc.contaminated(question_only, benchmark).collect() == []
