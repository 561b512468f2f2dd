"""Preparation, resampling, choice, tracking and scoring."""

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from catalog import modelling
from tidemart.ml import evaluate, explain, models, prep, tracking
from tidemart.operators import features
from tidemart.plans import jobs
from tidemart.sources import readers, writers


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(11)
    y = (rng.random(400) < 0.2).astype(int)
    data = [(i, int(y[i]), float(rng.normal(3 * y[i], 1)), float(rng.normal(0, 1)), ["r", "g", None][i % 3]) for i in range(400)]
    return spark.createDataFrame(data, "id long, y int, a double, b double, colour string").cache()


def test_preprocessor(spark):
    train = spark.createDataFrame([(1.0, "x"), (None, "x"), (3.0, "y"), (8.0, None), (float("nan"), "x")], "n double, c string")
    model = prep.build_preprocessor(["n"], ["c"]).fit(train)
    new = spark.createDataFrame([(None, None), (3.0, "unseen")], "n double, c string")
    got = [r[0] for r in model.transform(new).select(vector_to_array("features")).collect()]
    filled = np.array([1, 3, 3, 8, 3.0])
    assert got[0] == pytest.approx([(3 - filled.mean()) / filled.std(ddof=1), 1.0, 0.0])
    assert got[1][1:] == [0.0, 0.0]
    assert explain.feature_names(model.transform(new)) == ["__scaled_0", "c__hot_x", "c__hot_y"]
    hashed = prep.build_preprocessor(["n"], [], ["c"]).fit(train).transform(new)
    assert hashed.schema["features"].metadata["ml_attr"]["num_attrs"] == 1 + (1 << 18)
    assert prep.split_by_levels(train, ["c"], ["c"]) == ([], ["c"]) and prep.split_by_levels(train, ["c"]) == (["c"], [])
    with pytest.raises(ValueError, match="hashed"):
        prep.split_by_levels(train, ["c"], max_levels=1)


def test_splits_and_folds(rows):
    train, test = prep.split_train_test(rows, "id", "y", ["b"], stratify=True)
    assert "b" not in train.columns and test.count() == 80 and train.count() == 320
    a, b = {r["id"] for r in train.collect()}, {r["id"] for r in test.collect()}
    assert not a & b and len(a | b) == 400
    positive = rows.filter("y = 1").count()
    assert abs(test.filter("y = 1").count() - 0.2 * positive) < 1
    again = {r["id"] for r in prep.split_train_test(rows.repartition(7), "id", "y", stratify=True)[1].collect()}
    assert again == b
    sizes = prep.with_folds(rows, "id", "y", 4).groupBy("y", "fold").count().collect()
    assert len(sizes) == 8 and all(max(r["count"] for r in sizes if r["y"] == c) - min(r["count"] for r in sizes if r["y"] == c) <= 1 for c in (0, 1))


def test_resampling(rows):
    small = prep.undersample(rows, "id", "y")
    counts = {r["y"]: r["count"] for r in small.groupBy("y").count().collect()}
    assert counts[0] == counts[1] == rows.filter("y = 1").count()
    made = prep.smote(rows, "id", "y", ["a", "b"], k=3).toPandas()
    assert (made["y"] == 1).sum() == (made["y"] == 0).sum() and (~made["synthetic"]).sum() == 400
    real = made[(made["y"] == 1) & ~made["synthetic"]][["a", "b"]].to_numpy()
    for p in made[made["synthetic"]][["a", "b"]].to_numpy()[:60]:
        v, w = real[:, None, :] - p, real[None, :, :] - p
        cross = np.abs(v[..., 0] * w[..., 1] - v[..., 1] * w[..., 0])
        between = (v * w).sum(-1) <= 1e-12
        assert (cross[between] < 1e-9).any()
    weights = {r["y"]: r["class_weight"] for r in prep.with_class_weights(rows, "y").collect()}
    assert weights[1] == pytest.approx(400 / (2 * rows.filter("y = 1").count()))


def test_metrics_edges(spark):
    none = spark.createDataFrame([(0, 0.0, 0.2), (0, 0.0, 0.4)], "y int, prediction double, s double")
    row = evaluate.classification_metrics(none, "y", score="s").first()
    assert (row["accuracy"], row["precision"], row["recall"], row["f1"], row["roc_auc"]) == (1.0, 0.0, 0.0, 0.0, None)
    flat = spark.createDataFrame([(1.0, 2.0), (1.0, 0.0)], "y double, prediction double")
    row = evaluate.regression_metrics(flat, "y").first()
    assert (row["mae"], row["rmse"], row["r2"]) == (1.0, 1.0, None)


def test_choice(spark):
    scores = spark.createDataFrame([("xgb_best", 0.90), ("log_reg__rus", 0.885), ("random_forest", 0.89), ("weak", None)], "model_name string, f1 double")
    row = evaluate.select_best_model(scores).first()
    assert row["model_name"] == "log_reg__rus"
    assert row["justification"] == (
        "Selected 'log_reg__rus' (interpretability score: 5) with f1=0.8850. Models ['xgb_best', 'random_forest'] had comparable performance "
        "(within 2.0% threshold), but 'log_reg__rus' offers better interpretability."
    )
    alone = evaluate.select_best_model(scores, threshold=0.001).first()
    assert alone["justification"] == "Selected 'xgb_best' as it has the best f1 score of 0.9000"
    assert evaluate.select_best_model(scores.filter("false")).count() == 0
    wide = spark.createDataFrame([("m2", 0.5, None), ("m1", 0.5, None), ("m3", 0.1, None)], "model string, f1 double, auc double")
    assert tuple(evaluate.choose_best(wide, ["auc", "f1"]).first()) == ("m1", "f1")
    assert tuple(evaluate.choose_best(wide, ["f1"], "min").first()) == ("m3", "f1")
    assert tuple(evaluate.choose_best(wide, ["auc"]).first()) == ("m1", None)
    assert evaluate.long_metrics(wide).count() == 3


def test_model_sets_have_the_stated_parameters(spark):
    p = prep.build_preprocessor(["a"], [])
    full, light = models.classification_models(p, "y"), models.light_classification_models(p, "y")
    assert list(full) == ["log_reg", "decision_tree", "random_forest_clf", "gradient_boosting_clf", "boosted_trees_clf"]
    assert full["random_forest_clf"].getStages()[-1].getNumTrees() == 150 and light["rf"].getStages()[-1].getNumTrees() == 120
    assert light["logreg"].getStages()[-1].getWeightCol() == "class_weight"
    reg = {**models.regression_models(p, "y"), **models.light_regression_models(p, "y")}
    assert len(reg) == 7 and reg["gbr"].getStages()[-1].getStepSize() == 0.05 and reg["boosted_trees_regressor"].getStages()[-1].getSubsamplingRate() == 0.8


def test_tuning_and_tracking(spark, rows, folder):
    model = Pipeline(stages=[prep.build_preprocessor(["a", "b"], []), LogisticRegression(labelCol="y")])
    train, test = [prep.materialize(d) for d in prep.split_train_test(rows, "id", "y", stratify=True)]
    with pytest.raises(ValueError):
        tracking.tune(model, {"regParam": [0.1]}, train, "y", "id", "other")
    assert len(tracking.combinations({"regParam": [0.1, 1.0, 2.0], "maxIter": [5, 6]}, "random", 4)) == 4
    assert list(tracking.parameter_map(model, {"C": 2.0}, 50).values()) == [0.01]
    tracker = tracking.Tracker(spark, f"{folder}/ml")
    assert tracker.register_best("exp").count() == 0
    _, metrics = tracker.run("exp", "plain", model, train, test, "y", "id", {"regParam": [0.0, 50.0]})
    assert metrics.first()["f1"] > 0.7
    weak = Pipeline(stages=[prep.build_preprocessor(["b"], []), LogisticRegression(labelCol="y")])
    tracker.run("exp", "weak", weak, train, test, "y", "id")
    runs = tracker.runs.read()
    assert runs.select("run_id").distinct().count() == 2 and "0.0" in runs.filter("model_name = 'plain'").first()["params"]
    tracker.register_best("exp")
    best = tracker.registry.read().first()
    assert best["name"] == "exp_best_model" and best["run_id"] == "exp-0001"
    scored = explain.score_transactions(tracker.load_best("exp"), test, "v7", "id").collect()
    assert all(r["is_fraud"] == (r["probability"] > 0.5) and r["model_version"] == "v7" for r in scored)
    folds = tracking.cross_validate(model, rows, "y", "id", 3)
    assert folds.count() == 15
    tracker.log_folds("exp", "plain", folds)
    compared = evaluate.compare_models(readers.union_all([tracking.as_results("cv", folds, True), tracking.as_results("one", metrics, False)]))
    got = {r["model_name"]: r for r in compared.collect()}
    f1 = [r["value"] for r in folds.filter("metric = 'f1'").collect()]
    assert got["cv"]["f1_std"] == pytest.approx(np.std(f1)) and got["cv"]["f1"] == got["cv"]["f1_mean"] and got["one"]["f1_mean"] is None


def test_modelling_job(spark, folder):
    rng = np.random.default_rng(2)
    y = (rng.random(240) < 0.3).astype(int)
    data = [(i, int(y[i]), f"d{i % 9}", float(1 + i % 7), "2024-01-01 00:00:00", f"2024-01-0{2 + int(y[i])} 0{i % 9}:00:00") for i in range(240)]
    df = spark.createDataFrame(data, "user_id long, class int, device_id string, ip_address double, signup_time string, purchase_time string")
    ranges = spark.createDataFrame([(0.0, 3.0, "X"), (4.0, 5.0, "Y")], "lower_bound_ip_address double, upper_bound_ip_address double, country string")
    ready = jobs.prepare_fraud_rows(df, ranges)
    assert {"time_since_signup", "country", "device_id_frequency"} <= set(ready.columns) and ready.count() == 240
    assert ready.filter("country is null").count() == df.filter("ip_address > 5").count()
    out = jobs.model_rows(spark, ready, "user_id", "class", "fraud", f"{folder}/f", names=["log_reg", "decision_tree"], tuned=False)
    assert out["comparison"].count() == 2 and out["choice"].first()["model_name"] == "log_reg__rus"
    smoted = jobs.model_rows(spark, ready.drop("country", "device_id"), "user_id", "class", "card", f"{folder}/g", "smote", names=["log_reg"], use_cv=True)
    assert smoted["comparison"].first()["f1_mean"] > 0.9


def test_attribution(spark, rows):
    model = Pipeline(stages=[prep.build_preprocessor(["a", "b"], []), LogisticRegression(labelCol="y")]).fit(rows)
    top = explain.linear_attribution(model, rows, rows, 1).first()
    assert top["feature"] == "__scaled_0"
    w = model.stages[-1].coefficients[0]
    x = np.array([r["a"] for r in rows.collect()])
    assert top["mean_abs_shap"] == pytest.approx(abs(w) * np.abs((x - x.mean()) / x.std(ddof=1)).mean())
    tree = Pipeline(stages=[prep.build_preprocessor(["a", "b"], []), models.DecisionTreeClassifier(labelCol="y", maxDepth=3)]).fit(rows)
    assert explain.tree_importance(tree, rows, 1).first()["feature"] == "__scaled_0"
    acts = explain.attach_actions(spark.createDataFrame([("p", 1.0), ("q", 2.0)], "feature string, mean_abs_shap double"), {"p": "act"}).collect()
    assert {r["feature"]: r["action"] for r in acts} == {"p": "act", "q": explain.DEFAULT_ACTION}


def test_customer_risk_and_feature_files(spark, folder):
    data = []
    for c in range(30):
        active = c % 3 != 0
        for i in range(12 if active else 1):
            day = 28 - i if active else 1
            data.append((f"T{c}-{i}", f"C{c}", 100.0 + c if active else 1.0, f"2024-01-{day:02d} 08:00:00", ["a", "b"][i % 2]))
    df = spark.createDataFrame(data, "TransactionId string, CustomerId string, Amount double, TransactionStartTime string, ProductCategory string")
    table = {r["CustomerId"]: r for r in features.rfm(df).collect()}
    assert (table["C0"]["Recency"], table["C0"]["Frequency"], table["C1"]["Recency"]) == (28, 1, 1)
    full = df
    for name in (f.strip().split(" ")[0] for f in readers.TRANSACTION_SCHEMA.split(",")):
        if name not in full.columns:
            full = full.withColumn(name, F.lit(1))
    names = [f.strip().split(" ")[0] for f in readers.TRANSACTION_SCHEMA.split(",")]
    writers.write_csv(full.select(names), f"{folder}/t")
    out = jobs.label_risk_file(spark, f"{folder}/t", f"{folder}/risk")
    assert out["means"].count() == 3
    labelled = readers.read_csv(spark, f"{folder}/risk")
    risky = {r["CustomerId"] for r in labelled.filter("is_high_risk = 1").collect()}
    assert risky == {f"C{c}" for c in range(0, 30, 3)}
    wide = jobs.build_features(spark, f"{folder}/t", f"{folder}/x", ["Amount"], ["ProductCategory"])
    assert wide.count() == len(data) and len(wide.columns) == 10
    with pytest.raises(FileNotFoundError):
        jobs.build_features(spark, f"{folder}/none", f"{folder}/x", [], [])


def test_rows_of_a_fit_are_dealt_to_every_core(spark):
    seen = []

    class Recorder:
        def fit(self, train):
            seen.append((train.rdd.getNumPartitions(), train.count(), train.select("doc_id").distinct().count()))

    modelling._fit_and_rank(spark, "/root/testdata/sf0.001", lambda *_: {"recorder": Recorder()}, "quality", lambda *_: None)
    parts, rows, ids = seen[0]
    assert parts >= spark.sparkContext.defaultParallelism and rows == ids > 0


def test_deep_trees_are_the_same_with_kept_nodes(spark):
    rng = np.random.default_rng(11)
    rows = spark.createDataFrame([(float(a), float(b), int(a * b > 0.2 or rng.random() < 0.1)) for a, b in rng.normal(size=(300, 2))], "a double, b double, y int")
    made = models.classification_models(prep.build_preprocessor(["a", "b"], []), "y")
    for name in ("decision_tree", "random_forest_clf"):
        ready, deep = made[name].getStages()
        assert deep.getCacheNodeIds()
        deep = deep.copy({deep.numTrees: 5}) if name == "random_forest_clf" else deep
        features = ready.fit(rows).transform(rows)
        strip = lambda model: model.toDebugString.split("\n", 1)[1]
        assert strip(deep.fit(features)) == strip(deep.copy({deep.cacheNodeIds: False}).fit(features))
    assert models.regression_models(prep.build_preprocessor(["a"], []), "y")["random_forest_regressor"].getStages()[1].getCacheNodeIds()
