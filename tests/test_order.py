"""Segmented order operators against plain windows, with a hot key and nulls."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemart.operators import order, series


@pytest.fixture(scope="module")
def skewed(spark):
    rng = np.random.default_rng(7)
    n = 3000
    keys = np.where(rng.random(n) < 0.6, "hot", rng.choice(["a", "b", "c"], n)).astype(object)
    keys[:20] = None
    value = np.round(rng.normal(0, 1, n), 2)
    pdf = pd.DataFrame({"id": np.arange(n), "k": keys, "t": rng.integers(0, 200, n), "v": value})
    df = spark.createDataFrame(pdf).withColumn("v", F.when(F.col("id") % 5 != 0, F.col("v")))
    return df.cache()


@pytest.mark.parametrize("keys", [["k"], []])
def test_running_equals_window(skewed, keys):
    w = W.partitionBy(*keys).orderBy(F.desc_nulls_last("t"), F.asc_nulls_last("id")).rowsBetween(W.unboundedPreceding, 0)
    got = order.running(skewed, keys, ["-t", "id"], {"s": ("sum", F.col("v")), "n": ("sum", F.lit(1)), "l": ("last", F.col("v")), "p": ("product", 1 + F.col("v") / 100)})
    want = skewed.select("id", F.sum("v").over(w).alias("ws"), F.count(F.lit(1)).over(w).alias("wn"), F.last("v", True).over(w).alias("wl"), F.product(1 + F.col("v") / 100).over(w).alias("wp"))
    pdf = got.join(want, "id").toPandas()
    assert len(pdf) == 3000
    assert np.allclose(pdf["s"], pdf["ws"].fillna(0)) and (pdf["n"] == pdf["wn"]).all()
    assert pdf["l"].equals(pdf["wl"]) and np.allclose(pdf["p"], pdf["wp"].fillna(1))


def test_backwards_fill(skewed):
    w = W.partitionBy("k").orderBy("t", "id").rowsBetween(0, W.unboundedFollowing)
    got = order.running(skewed, ["k"], ["t", "id"], {"f": ("last", F.col("v"))}, backwards=True)
    pdf = got.join(skewed.select("id", F.first("v", True).over(w).alias("w")), "id").toPandas()
    assert pdf["f"].equals(pdf["w"])


@pytest.mark.parametrize("n", [3, 1100])
def test_head_per_group(skewed, n):
    w = W.partitionBy("k").orderBy(F.desc_nulls_last("v"), F.asc_nulls_last("id"))
    want = {r["id"] for r in skewed.withColumn("r", F.row_number().over(w)).filter(F.col("r") <= n).collect()}
    assert {r["id"] for r in order.head_per_group(skewed, ["k"], ["-v", "id"], n).collect()} == want


def test_quantiles_equal_percentile(skewed):
    got = {r["k"]: r for r in order.quantiles(skewed, ["k"], "v", {"a": 0.1, "m": 0.5, "z": 1.0}).collect()}
    for r in skewed.groupBy("k").agg(F.percentile("v", F.array(F.lit(0.1), F.lit(0.5), F.lit(1.0))).alias("p")).collect():
        assert np.allclose([got[r["k"]]["a"], got[r["k"]]["m"], got[r["k"]]["z"]], r["p"])
    assert order.quantiles(skewed.filter("false"), [], "v", {"m": 0.5}).collect()[0]["m"] is None


def test_value_ranks(skewed):
    want = pd.Series([r["v"] for r in skewed.filter("v is not null").collect()])
    ranks = dict(zip(want, want.rank()))
    got = {r["value"]: r["avg_rank"] for r in order.value_ranks(skewed, "v").collect()}
    assert got == ranks


def test_samples(skewed):
    a = {r["id"] for r in order.sample_rows(skewed, "id", 100).collect()}
    assert len(a) == 100 and a == {r["id"] for r in order.sample_rows(skewed.repartition(5), "id", 100).collect()}
    assert a != {r["id"] for r in order.sample_rows(skewed, "id", 100, seed=1).collect()}
    assert order.sample_rows(skewed, "id", 5000).count() == 3000
    got = {r["k"]: r["count"] for r in order.sample_share_per_group(skewed, "k", "id", 900).groupBy("k").count().collect()}
    sizes = {r["k"]: r["count"] for r in skewed.filter("k is not null").groupBy("k").count().collect()}
    assert got == {k: round(0.3 * n) for k, n in sizes.items()}


@pytest.mark.parametrize("before,after", [(4, 0), (0, 3), (2, 2)])
def test_blocks_hold_whole_frames(skewed, before, after):
    frame = lambda w: w.rowsBetween(-before, after)
    got = series.in_blocks(skewed, ["k"], ["t", "id"], before, after, lambda w: {"s": F.sum("v").over(frame(w)), "n": F.count("v").over(frame(w))}, block_rows=7)
    w = frame(W.partitionBy("k").orderBy("t", "id"))
    pdf = got.join(skewed.select("id", F.sum("v").over(w).alias("ws"), F.count("v").over(w).alias("wn")), "id").toPandas()
    assert len(pdf) == 3000 and (pdf["n"] == pdf["wn"]).all() and np.allclose(pdf["s"].fillna(9), pdf["ws"].fillna(9))


def test_returns_against_pandas(spark):
    values = ["10", None, "x", "12", "9", "9", "0", "5"]
    df = spark.createDataFrame([("s", i, v) for i, v in enumerate(values)], "k string, t int, Close string")
    got = [r["daily_return"] for r in series.daily_returns(df, ["k"], ["t"]).orderBy("t").collect()]
    assert got == [None, 0.0, 0.0, pytest.approx(0.2), pytest.approx(-0.25), 0.0, -1.0, None]
    r = spark.createDataFrame([("s", i, v) for i, v in enumerate([0.1, None, -1.0, 0.5, -2.0])], "k string, t int, r double")
    total = [x["cumulative_return"] for x in series.cumulative_returns(r, ["k"], ["t"], "r").orderBy("t").collect()]
    assert total[0] == pytest.approx(0.1) and total[1] is None and total[2:] == [-1.0, -1.0, -1.0]
    vol = [x["volatility"] for x in series.volatility(r, ["k"], ["t"], "r", 3).orderBy("t").collect()]
    assert vol[:4] == [None] * 4 and vol[4] == pytest.approx(np.std([-1.0, 0.5, -2.0], ddof=1))
    flat = spark.createDataFrame([("s", i, 0.1) for i in range(4)], "k string, t int, r double")
    assert series.sharpe_ratio(flat, ["k"], "r").first()["sharpe_ratio"] is None


@pytest.mark.parametrize("size,slack,rows", [(16, 0.05, 10**9), (16, 0.0, 10**9), (16, 0.02, 0), (1 << 14, 0.0025, 10**9)])
def test_bracketed_quantiles(spark, monkeypatch, size, slack, rows):
    """Brackets that hold few values, brackets that miss, values summed by segments, groups that are kept whole."""
    monkeypatch.setattr(order, "SKETCH_SIZE", size)
    monkeypatch.setattr(order, "SKETCH_SLACK", slack)
    monkeypatch.setattr(order, "INSIDE_ROWS", rows)
    draw = np.random.default_rng(9)
    values = {"ties": draw.integers(0, 4, 900), "wide": draw.normal(0, 1e6, 900), "one": [7.0], "two": [1.0, 2.0], "same": [3.0] * 500, "inf": [-np.inf, 0.0, np.inf] * 60, None: draw.random(40)}
    data = [(k, float(v)) for k, own in values.items() for v in own] + [("ties", None), ("wide", float("nan")), ("empty", None)]
    df = spark.createDataFrame(data, "k string, v double").repartition(7)
    probs = {"zero": 0.0, "low": 0.01, "q1": 0.25, "near": 0.251, "m": 0.5, "high": 0.987, "top": 1.0}
    got = {row["k"]: row for row in order.quantiles(df, ["k"], "v", probs).collect()}
    assert set(got) == set(values)
    for k, own in values.items():
        for name, p in probs.items():
            place = (len(own) - 1) * p
            low, high = np.sort(own)[[int(np.floor(place)), int(np.ceil(place))]]
            want = low if low == high else low + (high - low) * (place - np.floor(place))
            assert np.isclose(got[k][name], want, rtol=1e-12, equal_nan=True), (k, name)
    every = np.sort(values["wide"])
    row = order.quantiles(df.filter("k = 'wide'"), [], "v", probs).first()
    assert row["m"] == pytest.approx((every[449] + every[450]) / 2) and row["zero"] == every[0] and row["top"] == every[-1]


@pytest.mark.parametrize("rows", [1_000_000, 0])
def test_first_rows_by_hash(spark, monkeypatch, rows):
    """Against a rank over all rows, with cuts found in one histogram and with further digits."""
    monkeypatch.setattr(order, "CUT_ROWS", rows)
    df = spark.range(3000).select("id", F.when(F.col("id") % 3 > 0, F.lit("big")).when(F.col("id") % 30 == 0, F.lit("small")).alias("k")).repartition(5)
    wants = spark.createDataFrame([("big", 700), (None, 5000), ("small", 0), ("absent", 3)], "k string, __want long")
    full = W.partitionBy("k").orderBy(order.hash_order("id", 5), "id")
    placed = df.withColumn("place", F.row_number().over(full))
    want = {r["id"] for r in placed.filter("(k = 'big' and place <= 700) or k is null").collect()}
    flagged = order.first_by_hash(df, ["k"], "id", wants, 5)
    assert flagged.count() == 3000 and {r["id"] for r in flagged.filter("__first").collect()} == want
    assert {(r["id"], r["i"]) for r in order.hash_index(df, ["k"], "id", 5, "i").collect()} == {(r["id"], r["place"]) for r in placed.collect()}
    for n in (0, 1, 1234, 3000, 4000):
        alone = order.first_by_hash(df, [], "id", spark.createDataFrame([(n,)], "__want long"), 5)
        ranked = df.withColumn("place", F.row_number().over(W.partitionBy().orderBy(order.hash_order("id", 5), "id"))).filter(F.col("place") <= n)
        assert {r["id"] for r in alone.filter("__first").collect()} == {r["id"] for r in ranked.collect()}


def test_repeated_and_null_keys_do_not_change_the_number_of_rows(spark):
    df = spark.createDataFrame([(1,)] * 10 + [(None,)] * 10 + [(k,) for k in range(2, 30)], "id long")
    for n in range(0, 49, 6):
        assert order.first_by_hash(df, [], "id", spark.createDataFrame([(n,)], "__want long")).filter("__first").count() == n
    assert order.first_by_hash(df.limit(0), [], "id", spark.createDataFrame([(3,)], "__want long")).count() == 0
    assert sorted(r["i"] for r in order.hash_index(df, [], "id", 1, "i").collect()) == list(range(1, 49))
