"""Keyed merges by bucket against a dictionary."""

import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import types as T

from tidemart.sources.buckets import BucketTable

SCHEMA = "k long, part string, v string, seq int"


def made(spark, folder, name, key=("k",), buckets=8):
    return BucketTable(spark, f"{folder}/{name}", T._parse_datatype_string(SCHEMA), key, buckets)


def rows(table):
    return sorted(map(tuple, table.read().collect()), key=repr)


@pytest.mark.parametrize("key", [("k",), ("k", "part")])
def test_upserts_are_those_of_a_dictionary(spark, folder, key):
    draw = random.Random(str(key))
    table, told = made(spark, folder, "t", key), {}
    for _ in range(3):
        batch = [(draw.randint(0, 40), draw.choice("ab"), draw.choice(["x", "y", None]), place) for place in range(30)]
        table.upsert(spark.createDataFrame(batch, SCHEMA).repartition(3), ["seq"])
        for row in batch:
            told[tuple(row[:1] if len(key) == 1 else row[:2])] = row
        assert rows(table) == sorted(told.values(), key=repr)
    stored = {row["file"]: row["modified"] for row in table.files().collect()}
    assert table.upsert(spark.createDataFrame(list(told.values()), SCHEMA), ["seq"]) == 0
    assert {row["file"]: row["modified"] for row in table.files().collect()} == stored


def test_only_touched_buckets_are_written(spark, folder):
    table = made(spark, folder, "t")
    table.upsert(spark.createDataFrame([(k, "a", "old", 0) for k in range(200)], SCHEMA), ["seq"])
    before = {row["bucket"]: row["file"] for row in table.files().collect()}
    assert len(before) == 8
    assert table.upsert(spark.createDataFrame([(7, "a", "new", 1), (8, "a", "old", 0)], SCHEMA), ["seq"]) == 1
    after = {row["bucket"]: row["file"] for row in table.files().collect()}
    assert sum(before[b] != after[b] for b in before) == 1
    assert rows(table) == sorted([(k, "a", "new" if k == 7 else "old", int(k == 7)) for k in range(200)], key=repr)


def test_insert_if_absent_and_rows_without_a_key(spark, folder):
    table = made(spark, folder, "t")
    batch = spark.createDataFrame([(1, "a", "second", 2), (1, "a", "first", 1), (2, "a", None, 1)], SCHEMA)
    assert table.insert_if_absent(batch, ["seq"]) > 0 and table.insert_if_absent(batch, ["-seq"]) == 0
    assert rows(table) == [(1, "a", "first", 1), (2, "a", None, 1)]
    with pytest.raises(PySparkException, match="null in key"):
        table.insert_if_absent(spark.createDataFrame([(None, "a", "x", 1)], SCHEMA), ["seq"])
    keyless = spark.createDataFrame([(None, "a", "x", 1), (None, "a", "x", 1), (None, "b", "y", 1)], SCHEMA)
    table.upsert(keyless, ["seq"])
    assert len(rows(table)) == 5
    assert table.upsert(keyless.limit(0), ["seq"]) == 0 and len(rows(table)) == 5


def test_empty_table_and_extra_columns(spark, folder):
    table = made(spark, folder, "t")
    assert rows(table) == [] and table.files().collect() == []
    wide = spark.createDataFrame([(1, "a", "x", 1, "more")], SCHEMA + ", __old string")
    table.upsert(wide, ["seq"])
    assert rows(table) == [(1, "a", "x", 1)]
