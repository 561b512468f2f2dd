import math

import pytest
from pyspark.sql import functions as F

from tidemart.functions.tails import beta_regularized, chi_square_tail, correlation_p
from tidemart.operators import charts, stats


def test_tails_against_known_values():
    assert 1 - chi_square_tail(7.81, 3) == pytest.approx(0.949893, abs=1e-6)
    for x in (0.1, 1.0, 5.0, 40.0):
        assert chi_square_tail(x, 2) == pytest.approx(math.exp(-x / 2), rel=1e-12)
        assert chi_square_tail(x, 1) == pytest.approx(math.erfc(math.sqrt(x / 2)), rel=1e-10)
        assert chi_square_tail(x, 4) == pytest.approx(math.exp(-x / 2) * (1 + x / 2), rel=1e-10)
    assert beta_regularized(2, 3, 0.4) == pytest.approx(0.5248, abs=1e-12)
    assert beta_regularized(0.5, 0.5, 0.25) == pytest.approx(2 / math.pi * math.asin(0.5), rel=1e-12)
    assert correlation_p(0.0, 10) == 1.0 and correlation_p(1.0, 10) == 0.0
    # t with 2 degrees of freedom: p = 1 - t / sqrt(2 + t^2), and t / sqrt(2 + t^2) = r
    assert correlation_p(0.3, 4) == pytest.approx(0.7, rel=1e-12)


def test_correlation_guards(spark):
    few = spark.createDataFrame([(1.0, 2.0), (2.0, None), (3.0, 4.0)], "x double, y double")
    row = stats.pearson(few, "x", "y").first()
    assert tuple(row) == (0.0, 1.0, False, 0)
    assert tuple(stats.spearman(few, "x", "y").first()) == (0.0, 1.0, False)
    flat = spark.createDataFrame([(1.0, float(i)) for i in range(5)], "x double, y double")
    row = stats.pearson(flat, "x", "y").first()
    assert row["correlation"] is None and row["p_value"] is None and row["significant"] is False and row["n_samples"] == 5
    line = spark.createDataFrame([(float(i), 2.0 * i) for i in range(5)], "x double, y double")
    row = stats.pearson(line, "x", "y").first()
    assert row["correlation"] == pytest.approx(1.0) and row["p_value"] == pytest.approx(0.0, abs=1e-12) and row["significant"]
    assert stats.target_correlations(flat, "absent").count() == 0


def test_spearman_with_ties(spark):
    x, y = [1, 2, 2, 3, 5, 5, 5], [2, 1, 3, 3, 8, 9, 4]
    import pandas as pd

    want = pd.Series(x).rank().corr(pd.Series(y).rank())
    df = spark.createDataFrame(list(zip(x, y)), "x int, y int")
    assert stats.spearman(df, "x", "y").first()["correlation"] == pytest.approx(want)


def test_chi_square(spark):
    def table(cells):
        return spark.createDataFrame([(g, f) for g, f, n in cells for _ in range(n)], "g string, claim_flag int")

    # 2 x 2 with Yates: n (|ad - bc| - n/2)^2 / (row and column products)
    row = stats.chi_square(table([("a", 1, 10), ("a", 0, 20), ("b", 1, 25), ("b", 0, 15)]), "g", min_obs=1).first()
    want = 70 * (abs(10 * 15 - 20 * 25) - 35) ** 2 / (30 * 40 * 35 * 35)
    assert row["stat"] == pytest.approx(want) and row["dof"] == 1 and row["p_value"] == pytest.approx(math.erfc(math.sqrt(want / 2)))
    # an empty cell
    row = stats.chi_square(table([("a", 1, 10), ("a", 0, 10), ("b", 0, 10), ("c", 1, 5), ("c", 0, 5)]), "g", min_obs=1).first()
    expected = {("a", 1): 7.5, ("a", 0): 12.5, ("b", 1): 3.75, ("b", 0): 6.25, ("c", 1): 3.75, ("c", 0): 6.25}
    seen = {("a", 1): 10, ("a", 0): 10, ("b", 0): 10, ("c", 1): 5, ("c", 0): 5}
    assert row["stat"] == pytest.approx(sum((seen.get(k, 0) - e) ** 2 / e for k, e in expected.items())) and row["dof"] == 2
    # one group only
    row = stats.chi_square(table([("a", 1, 10), ("a", 0, 10)]), "g", min_obs=1).first()
    assert row["dof"] == 0 and row["p_value"] == 1.0


def test_kruskal(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 2.0), ("b", 4.0), (None, 9.0), ("c", 5.0)], "g string, v double")
    row = stats.kruskal(df, "g", "v", min_obs=2).first()
    # ranks 1, 2.5 | 2.5, 4
    h = 12 / (4 * 5) * 2 * ((1.75 - 2.5) ** 2 + (3.25 - 2.5) ** 2) / (1 - (8 - 2) / (64 - 4))
    assert row["stat"] == pytest.approx(h) and row["groups"] == 2
    row = stats.kruskal(df, "g", "v", min_obs=3).first()
    assert row["stat"] is None and row["p_value"] is None and row["groups"] == 0
    same = spark.createDataFrame([("a", 1.0), ("b", 1.0)], "g string, v double")
    assert stats.kruskal(same, "g", "v", min_obs=1).first()["stat"] is None


def test_decision_row(spark):
    result = spark.createDataFrame([(3.0, 0.2, 2)], "stat double, p_value double, groups long")
    assert stats.test_row(result, "t").first()["decision"] == "Fail to reject H0"


def test_histogram_edges(spark):
    same = spark.createDataFrame([("7",), ("7",), ("x",)], "v string")
    rows = charts.histogram(same, "v", 4).orderBy("bin").collect()
    assert [r["count"] for r in rows] == [0, 0, 2, 0] and rows[0]["lower"] == 6.5
    assert charts.histogram(same.filter("v = 'x'"), "v", 4).count() == 0


def test_roc_of_one_class(spark):
    df = spark.createDataFrame([(1, 0.5), (1, 0.7)], "y int, s double")
    assert charts.roc_auc(df, "y", "s").first()["roc_auc"] is None


def test_confusion_lists_every_pair(spark):
    df = spark.createDataFrame([(0, 0), (1, 2)], "y int, p int")
    cells = {(r["label"], r["prediction"]): r["count"] for r in charts.confusion_matrix(df, "y", "p").collect()}
    assert len(cells) == 9 and cells[("0", "0")] == 1 and cells[("1", "2")] == 1 and cells[("2", "2")] == 0


def test_density_integrates_to_one(spark):
    df = spark.range(500).select((F.col("id") % 2).alias("c"), F.sqrt(F.col("id").cast("double")).alias("x"))
    for c in (0, 1):
        pts = charts.density_by_class(df, "x", "c").filter(F.col("c") == c).orderBy("point").collect()
        area = sum((b["x"] - a["x"]) * (a["density"] + b["density"]) / 2 for a, b in zip(pts, pts[1:]))
        assert len(pts) == 200 and area == pytest.approx(1.0, abs=0.01)
