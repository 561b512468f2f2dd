import random

import pytest
from pyspark.sql import functions as F

from tidemart.llm import rollups, vocab

SCHEMA = "change string, source string, lang string, tokenizer string, n_tokens long, n_chars long, old_tokens long, old_chars long"


def totals(store):
    return {(r["source"], r["lang"], r["tokenizer"]): (r["n_docs"], r["n_tokens"], r["n_chars"]) for r in store.totals().collect()}


def test_batches_equal_a_recount(spark, folder):
    rng = random.Random(1)
    store = rollups.Rollup(spark, folder)
    alive, number = {}, 0
    for batch in range(5):
        rows = []
        for _ in range(60):
            kind = rng.choice(["insert", "insert", "delete", "revise"])
            if kind == "insert":
                number += 1
                alive[number] = [rng.choice(["a", "b", None]), rng.choice(["en", None]), "v1", rng.randrange(50), rng.randrange(90)]
                rows.append((kind, *alive[number], None, None))
            elif alive:
                key = rng.choice(sorted(alive))
                if kind == "delete":
                    rows.append((kind, *alive.pop(key), None, None))
                else:
                    old = alive[key][3:]
                    alive[key][3:] = [rng.randrange(50), rng.randrange(90)]
                    rows.append((kind, *alive[key], *old))
        changes = spark.createDataFrame(rows, SCHEMA)
        assert store.apply(f"batch {batch}", changes)
        assert not store.apply(f"batch {batch}", changes.unionAll(changes))  # a replay changes nothing
        expected = {}
        for source, lang, tokenizer, tokens, chars in alive.values():
            n = expected.setdefault((source, lang, tokenizer), [0, 0, 0])
            n[0] += 1
            n[1] += tokens
            n[2] += chars
        got = {key: value for key, value in totals(store).items() if value != (0, 0, 0)}
        assert got == {key: tuple(value) for key, value in expected.items()}
        if batch == 2:
            before = totals(store)
            assert store.compact("first three") and totals(store) == before
            assert not store.apply("batch 1", changes)
    assert len(store.committed()) == 6


def test_odd_batches(spark, folder):
    store = rollups.Rollup(spark, folder)
    empty = spark.createDataFrame([], SCHEMA)
    assert store.totals().collect() == [] and store.apply("none", empty) and store.totals().collect() == []
    row = ("insert", None, None, None, None, None, None, None)
    assert store.apply("nulls", spark.createDataFrame([row, row], SCHEMA).withColumn("n_docs", F.lit("own")))
    assert totals(store) == {(None, None, None): (2, 0, 0)}
    with pytest.raises(Exception, match="unknown change"):
        store.apply("bad", spark.createDataFrame([("drop", *row[1:])], SCHEMA))
    assert store.committed() == ["none", "nulls"]


def test_second_writer_of_a_batch_changes_nothing(spark, folder):
    store = rollups.Rollup(spark, folder)
    sums = rollups.summed(spark.createDataFrame([("insert", "a", "en", "v1", 3, 9, None, None)], SCHEMA))
    place = store._batch("one")
    assert store._commit(place, sums) and not store._commit(place, sums)
    assert totals(store) == {("a", "en", "v1"): (1, 3, 9)}


def one_more(spark, n=1):
    return spark.createDataFrame([("insert", "a", "en", "v1", 3, 9, None, None)] * n, SCHEMA)


def test_a_writer_that_dies_loses_nothing(spark, folder):
    store = rollups.Rollup(spark, folder)
    rename = store._names

    class Dying:
        def rename(self, *_):
            raise OSError("lost")

    store._names = Dying()
    with pytest.raises(OSError):
        store.apply("one", one_more(spark))
    assert store.committed() == [] and totals(store) == {}
    store._names = rename
    assert store.apply("one", one_more(spark)) and not store.apply("one", one_more(spark))
    assert totals(store) == {("a", "en", "v1"): (1, 3, 9)}


def test_compactions_that_race(spark, folder):
    store, other = rollups.Rollup(spark, folder), rollups.Rollup(spark, folder)
    assert store.apply("one", one_more(spark)) and store.apply("", one_more(spark))
    seen = other._counting()
    assert store.compact("first")
    other._counting = lambda: seen  # it looked before the first one was committed
    assert not other.compact("second") and totals(store) == {("a", "en", "v1"): (2, 6, 18)}
    seen = store._counting()
    assert store.apply("while it runs", one_more(spark, 3))
    other._counting = lambda: seen
    assert other.compact("third")
    assert totals(store) == {("a", "en", "v1"): (5, 15, 45)}
    assert store.compact("fourth") and not store.compact("fourth") and not store.compact("one")
    assert totals(store) == {("a", "en", "v1"): (5, 15, 45)}
    assert not store.apply("one", one_more(spark)) and not store.apply("third", one_more(spark))
    assert store.committed() == ["", "first", "fourth", "one", "third", "while it runs"]


def test_token_count_is_the_vocabulary_s(spark):
    texts = ["", None, "a b  c\n\nd", "é" * 40, "<|endoftext|>"]
    rows = spark.createDataFrame([(text,) for text in texts], "text string").select(rollups.token_count(F.col("text")).alias("n")).collect()
    encoder = vocab.byte_encoder(vocab.vocabulary_path(vocab.BYTE_BPE))
    assert [r["n"] for r in rows] == [len(encoder.ids(text or "")) for text in texts]
