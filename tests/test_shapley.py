"""Shapley values of trees against sums over all feature subsets."""

from itertools import combinations
from math import factorial

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, RandomForestRegressor
from pyspark.sql import functions as F

from tidemart import session
from tidemart.ml import boosting, explain, prep, shapley


@pytest.fixture(scope="module")
def rows(spark):
    draw = np.random.default_rng(3)
    a, b, c = draw.normal(size=300), draw.normal(size=300), draw.choice(["x", "y", "z"], 300)
    value = 3 * a + np.where(b > 0, a * b, -2) + np.where(c == "x", 4, 0) + draw.normal(size=300) / 5
    data = [(i, float(a[i]), float(b[i]), str(c[i]), float(value[i]), int(value[i] > 1)) for i in range(300)]
    return spark.createDataFrame(data, "id long, a double, b double, c string, v double, y int").cache()


def subset_value(nodes, number, x, known, classes):
    """Output of a subtree where only the features in `known` are known."""
    node = nodes[number]
    if node["leftChild"] < 0:
        stats = node["impurityStats"]
        return stats[1] / sum(stats) if classes else node["prediction"]
    split = node["split"]
    children = [node["leftChild"], node["rightChild"]]
    if split["featureIndex"] in known:
        cell = x[split["featureIndex"]]
        left = cell <= split["leftCategoriesOrThreshold"][0] if split["numCategories"] < 0 else cell in split["leftCategoriesOrThreshold"]
        return subset_value(nodes, children[0 if left else 1], x, known, classes)
    counts = [nodes[child]["rawCount"] for child in children]
    return sum(n * subset_value(nodes, child, x, known, classes) for n, child in zip(counts, children, strict=True)) / sum(counts)


MODELS = {
    "tree": (DecisionTreeRegressor, {"labelCol": "v", "maxDepth": 7}),
    "forest": (RandomForestRegressor, {"labelCol": "v", "numTrees": 4, "maxDepth": 4}),
    "boosted": (GBTRegressor, {"labelCol": "v", "maxIter": 4, "maxDepth": 3, "stepSize": 0.3}),
    "class tree": (DecisionTreeClassifier, {"labelCol": "y", "maxDepth": 5}),
    "class forest": (RandomForestClassifier, {"labelCol": "y", "numTrees": 4, "maxDepth": 4}),
    "class boosted": (GBTClassifier, {"labelCol": "y", "maxIter": 3, "maxDepth": 3}),
    "no split": (DecisionTreeRegressor, {"labelCol": "v", "maxDepth": 0}),
}


def made(name):
    kind, options = MODELS[name]
    return kind(seed=1, **options)


@pytest.mark.parametrize("name", MODELS)
def test_values_are_those_of_all_subsets(spark, rows, name):
    model = Pipeline(stages=[prep.build_preprocessor(["a", "b"], ["c"]), made(name)]).fit(rows)
    scored = model.transform(rows)
    classes, boosted_classes = name in ("class tree", "class forest"), name == "class boosted"
    output = vector_to_array("probability")[1] if classes else vector_to_array("rawPrediction")[1] if boosted_classes else F.col("prediction")
    told = {r["id"]: (np.array(r["x"]), r["o"]) for r in scored.select("id", vector_to_array("features").alias("x"), output.alias("o")).collect()}
    got = {r["id"]: r for r in shapley.shapley_values(model, rows, ["id"]).collect()}
    assert set(got) == set(told)
    for key, (_, whole) in told.items():
        assert sum(got[key]["shapley"]) + got[key]["mean"] == pytest.approx(whole, abs=1e-9)
    trees, weights = shapley._tree_rows(spark, model.stages[-1])
    for key in (0, 7, 123):
        x, _ = told[key]
        size = len(x)
        worth = {s: sum(weights[t] * subset_value(nodes, 0, x, s, classes) for t, nodes in trees.items()) for n in range(size + 1) for s in combinations(range(size), n)}
        for j in range(size):
            others = [s for s in worth if j not in s]
            value = sum(factorial(len(s)) * factorial(size - len(s) - 1) / factorial(size) * (worth[tuple(sorted((*s, j)))] - worth[s]) for s in others)
            assert got[key]["shapley"][j] == pytest.approx(value, abs=1e-9)


def test_mean_magnitudes(rows):
    model = Pipeline(stages=[prep.build_preprocessor(["a", "b"], ["c"]), made("forest")]).fit(rows)
    values = np.array([r["shapley"] for r in shapley.shapley_values(model, rows, ["id"]).collect()])
    names = explain.feature_names(model.transform(rows))
    want = sorted(zip(names, np.abs(values).mean(0), strict=True), key=lambda pair: (-pair[1], pair[0]))[:3]
    got = explain.attribution(model, rows, rows, 3).collect()
    assert [r["feature"] for r in got] == [n for n, _ in want] and [r["mean_abs_shap"] for r in got] == pytest.approx([v for _, v in want])
    assert explain.attribution(model, rows, rows.limit(0), 3).collect() == []


def test_large_models_are_refused(spark, rows, monkeypatch):
    model = Pipeline(stages=[prep.build_preprocessor(["a", "b"], []), made("tree")]).fit(rows)
    monkeypatch.setattr(shapley, "PATH_BYTES", 1000)
    with pytest.raises(ValueError, match="shallower"):
        shapley.tree_paths(spark, model.stages[-1])


def test_rows_that_meet_the_same_conditions_are_worked_out_once(spark, rows, monkeypatch):
    for name in ("forest", "class boosted", "no split"):
        model = Pipeline(stages=[prep.build_preprocessor(["a", "b"], ["c"]), made(name)]).fit(rows)
        x = np.array([r["x"] for r in model.transform(rows).select(vector_to_array("features").alias("x")).collect()])
        paths, _ = shapley.tree_paths(spark, model.stages[-1])
        want, worked = shapley.path_values(paths, x), []
        plain = shapley.path_values
        with monkeypatch.context() as patch:
            patch.setattr(shapley, "path_values", lambda p, part: worked.append(len(part)) or plain(p, part))
            known = shapley.KnownValues(paths)
            for _ in range(3):
                assert np.allclose(known.of(x), want, atol=1e-12)
            assert len(worked) == 1 and worked[0] <= len(x)
            patch.setattr(shapley, "KNOWN_ROWS", 5)
            assert np.allclose(np.concatenate([known.of(x[i : i + 7]) for i in range(0, len(x), 7)]), want, atol=1e-12)


def test_rows_of_a_fit_are_dealt_into_bounded_tasks(spark):
    dealt = session.dealt_for_fit(spark.range(0, 5000, 1, 1), 100)
    sizes = dealt.rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect()
    assert sum(sizes) == 5000 and max(sizes) <= 110


def lines(spark, n=4000):
    draw = np.random.default_rng(5)
    a, b, c = draw.integers(0, 20, n) / 4, draw.normal(size=n), draw.choice(["x", "y", "z"], n)
    v = 3 * a + np.where(b > 0.3, a * b, -2) + np.where(c == "x", 4, 0) + draw.normal(size=n)
    return spark.createDataFrame(pd.DataFrame({"id": range(n), "a": a, "b": b, "c": c, "v": v}))


def test_boosted_trees_of_cells_are_those_of_rows(spark):
    df = lines(spark).withColumn("b", F.round("b", 0))  # so few values that both fits have all of them for bins
    prepare, boosted = prep.build_preprocessor(["a", "b"], ["c"]), GBTRegressor(labelCol="v", maxIter=5, maxDepth=3, stepSize=0.3, seed=1)
    rows, cells = Pipeline(stages=[prepare, boosted]).fit(df), boosting.fit_boosted(prepare, boosted, df)
    trees = [shapley._tree_rows(spark, m.stages[-1])[0] for m in (rows, cells)]
    for nodes, same in zip(trees[0].values(), trees[1].values(), strict=True):
        assert set(nodes) == set(same)
        for number, node in nodes.items():
            assert node["split"] == same[number]["split"] and node["prediction"] == pytest.approx(same[number]["prediction"], abs=1e-9)
            assert node["rawCount"] == pytest.approx(shapley._weight(same[number], False))
    told = [{r["id"]: (*r["shapley"], r["mean"], r["prediction"]) for r in shapley.shapley_values(m, df, ["id", "prediction"]).collect()} for m in (rows, cells)]
    assert set(told[0]) == set(told[1]) and all(told[0][i] == pytest.approx(told[1][i], abs=1e-9) for i in told[0])


def test_cells_hold_every_row_and_do_not_grow_with_rows(spark, monkeypatch):
    monkeypatch.setattr(boosting, "COUNTED", 100)  # b has more
    df, fitted = lines(spark), []
    prepare, boosted = prep.build_preprocessor(["a", "b"], ["c"]), GBTRegressor(labelCol="v", maxIter=4, maxDepth=3, maxBins=8, seed=1)
    fit = GBTRegressor._fit
    monkeypatch.setattr(GBTRegressor, "_fit", lambda self, rows: fitted.append((rows.count(), rows.agg(F.sum("__n"), F.sum(F.col("__n") * F.col("v"))).first())) or fit(self, rows))
    model = boosting.fit_boosted(prepare, boosted, df)
    (found, (n, total)) = fitted[0]
    assert n == 4000 and total == pytest.approx(df.agg(F.sum("v")).first()[0]) and found <= 8 * 8 * 3
    scored = model.transform(df).select("v", "prediction").toPandas()
    plain = GBTRegressor(labelCol="v", maxIter=4, maxDepth=3, maxBins=8, seed=1)
    monkeypatch.setattr(GBTRegressor, "_fit", fit)
    other = Pipeline(stages=[prepare, plain]).fit(df).transform(df).select("v", "prediction").toPandas()
    errors = [((p["v"] - p["prediction"]) ** 2).mean() for p in (scored, other)]
    assert errors[0] < 1.1 * errors[1] < 0.5 * scored["v"].var()
    # a leaf predicts the mean of its rows: rows were split as their cells were
    tree = next(iter(shapley._tree_rows(spark, model.stages[-1])[0].values()))
    first = model.stages[-1].trees[0].transform(model.transform(df).drop("prediction")).groupBy("prediction").agg(F.avg("v").alias("m"), F.count(F.lit(1)).alias("n")).collect()
    assert len(first) == sum(node["leftChild"] < 0 for node in tree.values()) and all(r["m"] == pytest.approx(r["prediction"]) for r in first)


def test_fits_that_need_rows_run_over_rows(spark, monkeypatch):
    df = lines(spark, 300)
    monkeypatch.setattr(boosting, "summed_cells", None)
    for options in ({"subsamplingRate": 0.8}, {"minInstancesPerNode": 5}, {"lossType": "absolute"}):
        model = boosting.fit_boosted(prep.build_preprocessor(["a"], ["c"]), GBTRegressor(labelCol="v", maxIter=2, seed=1, **options), df)
        assert model.transform(df).filter("prediction is not null").count() == 300


def test_one_cell_and_null_labels(spark):
    same = spark.createDataFrame([(1.0, "x", float(i)) for i in range(6)], "a double, c string, v double")
    model = boosting.fit_boosted(prep.build_preprocessor(["a"], ["c"]), GBTRegressor(labelCol="v", maxIter=2, seed=1), same)
    assert [r["prediction"] for r in model.transform(same).collect()] == pytest.approx([2.5] * 6)
    with pytest.raises(Exception, match="null or NaN"):
        boosting.fit_boosted(prep.build_preprocessor(["a"], ["c"]), GBTRegressor(labelCol="v"), same.withColumn("v", F.when(F.col("v") > 1, F.col("v"))))
