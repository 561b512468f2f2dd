import random

import numpy as np
from pyspark.sql import functions as F

from tidemart.llm import forest
from tidemart.llm.links import components


def shingle_set(text):
    words = text.lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))} if words else set()


def brute_force(texts):
    """{key: (class, links)} over distinct keys."""
    sets = {key: shingle_set(text or "") for key, text in texts}
    parent = {key: key for key in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    by_set = {}
    for key, one in sorted(sets.items()):
        if one:
            by_set.setdefault(frozenset(one), []).append(key)
    links = dict.fromkeys(sets, 0)
    for keys in by_set.values():
        for key in keys:
            parent[find(key)] = find(keys[0])
    distinct = list(by_set.items())
    for i, (a, a_keys) in enumerate(distinct):
        for b, b_keys in distinct[:i]:
            if 5 * len(a & b) >= 4 * len(a | b):
                for key in a_keys + b_keys:
                    links[key] += 1
                low, high = sorted((find(a_keys[0]), find(b_keys[0])))
                parent[high] = low
    roots = {}
    for key in sets:
        roots.setdefault(find(key), []).append(key)
    return {key: (min(keys), links[key]) for keys in roots.values() for key in keys}


def near_copies(rng, words, n, edits):
    out = []
    for _ in range(n):
        copy = list(words)
        for _ in range(rng.randint(0, edits)):
            copy[rng.randrange(len(copy))] = f"edit{rng.randrange(10_000)}"
        out.append(" ".join(copy))
    return out


def fixture_texts():
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = [" ".join(rng.choices(vocabulary, k=rng.randint(1, 120))) for _ in range(60)]
    passage = rng.choices(vocabulary, k=40)
    texts += [" ".join(rng.choices(vocabulary, k=30) + passage) for _ in range(20)]
    base = rng.choices(vocabulary, k=150)
    texts += near_copies(rng, base, 60, 3)
    for _ in range(8):
        texts += near_copies(rng, rng.choices(vocabulary, k=80), 4, 2)
    texts += ["", None, "", "one two", "one two", "One Two", "a b c d e"]
    rng.shuffle(texts)
    return [(1000 - i, text) for i, text in enumerate(texts)]


def result(spark, rows, block):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return {r["doc_id"]: (r["class_id"], r["n_links"]) for r in forest.classes(docs, block=block).collect()}


def test_classes_and_links_equal_brute_force(spark):
    rows = fixture_texts()
    assert result(spark, rows, forest.BLOCK) == brute_force(rows)


def test_small_blocks_give_the_same(spark):
    rows = fixture_texts()
    assert result(spark, rows, 7) == brute_force(rows)


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in forest.classes(docs).collect()}
    assert got == brute_force(rows)


def test_odd_rows(spark):
    rows = [(None, "a b c d e f"), (None, "x"), (3, "a b c d e f"), (3, "a b c d e f"), (4, ""), (5, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("class_id", F.lit("own"))
    kept = forest.one_of_each_class(docs)
    assert kept.columns == docs.columns
    assert sorted(((r["doc_id"] or 0), r["text"]) for r in kept.na.fill("-", ["text"]).collect()) == [(0, "x"), (3, "a b c d e f"), (4, ""), (5, "-")]
    assert forest.classes(docs.limit(0)).collect() == []


def test_no_copy_stays_under_null_or_repeated_keys(spark):
    one, other = "a b c d e f", "one text that is not the same"
    rows = [(3, one), (3, one), (None, one), (4, one), (4, other), (2, other), (None, None), (None, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("_row", F.lit("own"))
    kept = [(r["doc_id"], r["text"], r["_row"]) for r in forest.one_of_each_class(docs).collect()]
    assert sorted(kept, key=str) == sorted([(3, one, "own"), (2, other, "own"), (None, None, "own"), (None, "", "own")], key=str)


def test_prefix_is_shortened_until_the_recall():
    assert forest.shared_prefix() == 4
    assert forest.shared_prefix(target=0.9) > 4
    assert 1 - (1 - 0.8**4) ** forest.TREES >= forest.TARGET_RECALL


def test_common_counts():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 50)).astype(np.uint64)) for _ in range(9)]
    expected = [[len(set(a.tolist()) & set(b.tolist())) for b in sets] for a in sets]
    counts = forest.common_counts(sets)
    off = ~np.eye(9, dtype=bool)
    assert (counts[off] == np.array(expected)[off]).all()


def test_components_of_a_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)]
    rows = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r["node"]: r["component"] for r in rows} == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}}
