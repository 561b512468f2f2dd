"""Tabular modelling: preparation, metrics, choice, and MLlib fits over documents, labels, orders and line items."""

from __future__ import annotations

from functools import reduce

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog.base import query, table
from tidemart.ml import boosting, evaluate, explain, models, prep, shapley, tracking
from tidemart.session import dealt_for_fit, spread

# Predictions made by length rules, as three "models"; their label is a document's quality.

RULES = (("log_reg", 1500), ("random_forest_clf", 900), ("mystery", 300))
PREDICTIONS_SQL = "base AS (SELECT d.doc_id, quality AS label, n_chars::DOUBLE AS score FROM labels l JOIN documents d USING (doc_id)),\npreds AS (" + " UNION ALL ".join(
    f"SELECT '{m}' AS model, doc_id, label, score, CAST(score > {t} AS INTEGER) AS prediction FROM base" for m, t in RULES) + ")"
METRICS_SQL = """met AS (SELECT model, avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END) AS accuracy,
  coalesce(count(*) FILTER (label = 1 AND prediction = 1)::DOUBLE / nullif(count(*) FILTER (prediction = 1), 0), 0) AS "precision",
  coalesce(count(*) FILTER (label = 1 AND prediction = 1)::DOUBLE / nullif(count(*) FILTER (label = 1), 0), 0) AS recall,
  coalesce(2.0 * count(*) FILTER (label = 1 AND prediction = 1) / nullif(count(*) FILTER (prediction = 1) + count(*) FILTER (label = 1), 0), 0) AS f1 FROM preds GROUP BY model)"""


def predictions(spark, sf) -> dict[str, DataFrame]:
    d = table(spark, sf, "documents").select("doc_id", F.col("n_chars").cast("double").alias("score"))
    base = table(spark, sf, "labels").join(d, "doc_id").select("doc_id", F.col("quality").alias("label"), "score")
    return {m: base.withColumn("prediction", (F.col("score") > t).cast("int")) for m, t in RULES}


@query("ML7", f"""WITH {PREDICTIONS_SQL}, {METRICS_SQL}, r AS (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS rk FROM base),
a AS (SELECT (sum(rk) FILTER (label = 1) - count(*) FILTER (label = 1) * (count(*) FILTER (label = 1) + 1) / 2.0) / (count(*) FILTER (label = 1) * count(*) FILTER (label = 0)) AS roc_auc FROM r)
SELECT model, round(accuracy, 6)::DOUBLE AS accuracy, round("precision", 6) AS "precision", round(recall, 6) AS recall, round(f1, 6)::DOUBLE AS f1, round(roc_auc, 6)::DOUBLE AS roc_auc FROM met, a""")
def classification_metrics(spark, sf):
    parts = [evaluate.classification_metrics(p, "label", score="score").select(F.lit(m).alias("model"), "*") for m, p in predictions(spark, sf).items()]
    return reduce(DataFrame.unionByName, parts).withColumns({c: F.round(c, 6) for c in evaluate.CLASS_METRICS})


@query("ML6", """WITH p AS (SELECT l_extendedprice AS y, l_quantity * 1500 AS f FROM lineitem)
SELECT round(avg(abs(y - f)), 4) AS mae, round(sqrt(avg((y - f) * (y - f))), 4) AS rmse, round(1 - avg((y - f) * (y - f)) / var_pop(y), 6) AS r2 FROM p""")
def regression_metrics(spark, sf):
    p = table(spark, sf, "lineitem").select(F.col("l_extendedprice").alias("y"), (F.col("l_quantity") * 1500).alias("prediction"))
    return evaluate.regression_metrics(p, "y").withColumns({"mae": F.round("mae", 4), "rmse": F.round("rmse", 4), "r2": F.round("r2", 6)})


# Fold metrics made from the predictions, by a document's fold.

FOLDS_SQL = f"""{PREDICTIONS_SQL}, fm AS (SELECT model AS model_name, doc_id % 5 AS fold, avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END) AS accuracy,
  2.0 * count(*) FILTER (label = 1 AND prediction = 1) / nullif(count(*) FILTER (prediction = 1) + count(*) FILTER (label = 1), 0) AS f1 FROM preds GROUP BY 1, 2)"""


def fold_metrics(spark, sf) -> DataFrame:
    parts = []
    for name, p in predictions(spark, sf).items():
        counts = evaluate.classification_counts(F.col("label"), F.col("prediction"))
        wide = p.groupBy((F.col("doc_id") % 5).cast("int").alias("fold")).agg(counts["accuracy"].alias("accuracy"), counts["f1"].alias("f1"))
        long = wide.unpivot(["fold"], ["accuracy", "f1"], "metric", "value")
        parts.append(tracking.as_results(name, long, name != "mystery"))
    return reduce(DataFrame.unionByName, parts)


@query("AGG30", f"""WITH {FOLDS_SQL}
SELECT model_name, 'f1' AS metric, round(avg(f1), 6)::DOUBLE AS mean, round(stddev_pop(f1), 6)::DOUBLE AS std FROM fm GROUP BY 1
UNION ALL SELECT model_name, 'accuracy', round(avg(accuracy), 6), round(stddev_pop(accuracy), 6) FROM fm GROUP BY 1""")
def fold_statistics(spark, sf):
    out = evaluate.aggregate_folds(fold_metrics(spark, sf), ["model_name"])
    return out.withColumns({"mean": F.round("mean", 6), "std": F.round("std", 6)})


@query("ML12", f"""WITH {FOLDS_SQL}
SELECT model_name, round(avg(accuracy), 6)::DOUBLE AS accuracy, round(avg(f1), 6)::DOUBLE AS f1,
  CASE WHEN model_name <> 'mystery' THEN round(avg(accuracy), 6)::DOUBLE END AS accuracy_mean, CASE WHEN model_name <> 'mystery' THEN round(stddev_pop(accuracy), 6)::DOUBLE END AS accuracy_std,
  CASE WHEN model_name <> 'mystery' THEN round(avg(f1), 6)::DOUBLE END AS f1_mean, CASE WHEN model_name <> 'mystery' THEN round(stddev_pop(f1), 6)::DOUBLE END AS f1_std FROM fm GROUP BY 1""")
def model_comparison(spark, sf):
    out = evaluate.compare_models(fold_metrics(spark, sf), ("accuracy", "f1"))
    return out.withColumns({c: F.round(c, 6) for c in out.columns if c != "model_name"})


@query("ML13", f"""WITH {FOLDS_SQL}, s AS (SELECT model_name, avg(f1) AS f1, CASE model_name WHEN 'log_reg' THEN 5 WHEN 'random_forest_clf' THEN 3 ELSE 0 END AS interp FROM fm GROUP BY 1),
n AS (SELECT *, (SELECT max(f1) FROM s) AS best FROM s), c AS (SELECT * FROM n WHERE best - f1 <= 0.3),
t AS (SELECT * FROM c ORDER BY interp DESC, f1 DESC, model_name LIMIT 1),
o AS (SELECT '[' || string_agg('''' || model_name || '''', ', ' ORDER BY f1 DESC, model_name) || ']' AS others FROM c WHERE model_name <> (SELECT model_name FROM t))
SELECT model_name, CASE WHEN (SELECT count(*) FROM c) = 1 THEN format('Selected ''{{}}'' as it has the best f1 score of {{:.4f}}', model_name, f1)
  ELSE format('Selected ''{{}}'' (interpretability score: {{}}) with f1={{:.4f}}. Models {{}} had comparable performance (within 30.0% threshold), but ''{{}}'' offers better interpretability.', model_name, interp, f1::DOUBLE, others, model_name) END AS justification
FROM t, o""")
def model_choice(spark, sf):
    return evaluate.select_best_model(evaluate.compare_models(fold_metrics(spark, sf), ("accuracy", "f1")), threshold=0.3)


@query("TOP6", f"""WITH {PREDICTIONS_SQL}, {METRICS_SQL}
SELECT (SELECT model FROM met ORDER BY recall DESC, model LIMIT 1) AS model, 'recall' AS metric UNION ALL SELECT (SELECT model FROM met ORDER BY accuracy, model LIMIT 1), 'accuracy'
UNION ALL SELECT (SELECT min(model) FROM met), NULL""")
def best_rows(spark, sf):
    scores = classification_metrics(spark, sf).withColumn("empty", F.lit(None).cast("double"))
    parts = [evaluate.choose_best(scores, ["absent", "empty", "recall"]), evaluate.choose_best(scores, ["accuracy"], "min"), evaluate.choose_best(scores, ["empty"])]
    return reduce(DataFrame.unionByName, parts)


@query("ML20", f"""WITH {PREDICTIONS_SQL}, {METRICS_SQL}, w AS (SELECT model, round(accuracy, 6)::DOUBLE AS accuracy, round(recall, 6) AS recall, CASE WHEN model <> 'mystery' THEN round(f1, 6)::DOUBLE END AS f1 FROM met)
UNPIVOT w ON accuracy, recall, f1 INTO NAME metric VALUE "value" """)
def metrics_long(spark, sf):
    wide = classification_metrics(spark, sf).select("model", "accuracy", "recall", F.when(F.col("model") != "mystery", F.col("f1")).alias("f1"))
    return evaluate.long_metrics(wide)


@query("ML19 JOIN5", """SELECT p_type AS feature, count(*) AS n, coalesce(CASE p_type WHEN 'PROMO' THEN 'cut price' WHEN 'LARGE' THEN 'add stock' END, 'watch') AS action FROM part GROUP BY 1""")
def driver_actions(spark, sf):
    kinds = table(spark, sf, "part").groupBy(F.col("p_type").alias("feature")).agg(F.count(F.lit(1)).alias("n"))
    return explain.attach_actions(kinds, {"PROMO": "cut price", "LARGE": "add stock", "NONE": "never"}, "watch")


# Splits and resampling: sizes, and the rows themselves by the same hash.

@query("ML2", """WITH c AS (SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1), t AS (SELECT ceil(0.2 * sum(n)) AS want, sum(n) AS total FROM c),
e AS (SELECT o_orderstatus, n, want, want * n / total AS x, floor(want * n / total) AS b FROM c, t),
f AS (SELECT *, row_number() OVER (ORDER BY round(x - b, 9) DESC, o_orderstatus) AS turn, want - sum(b) OVER () AS spare FROM e)
SELECT o_orderstatus, CAST(b + CASE WHEN turn <= spare THEN 1 ELSE 0 END AS BIGINT) AS test_rows, CAST(n - b - CASE WHEN turn <= spare THEN 1 ELSE 0 END AS BIGINT) AS train_rows FROM f""")
def stratified_split(spark, sf):
    train, test = prep.split_train_test(table(spark, sf, "orders"), "o_orderkey", "o_orderstatus", stratify=True)
    counted = [d.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias(n)) for d, n in ((train, "train_rows"), (test, "test_rows"))]
    return counted[0].join(counted[1], "o_orderstatus")


@query("ML2", """WITH c AS (SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1), t AS (SELECT ceil(0.2 * sum(n)) AS want, sum(n) AS total FROM c),
e AS (SELECT o_orderstatus, want, want * n / total AS x, floor(want * n / total) AS b FROM c, t),
f AS (SELECT *, row_number() OVER (ORDER BY round(x - b, 9) DESC, o_orderstatus) AS turn, want - sum(b) OVER () AS spare FROM e),
p AS (SELECT o_orderkey, o_orderstatus, row_number() OVER (PARTITION BY o_orderstatus ORDER BY md5(o_orderkey::VARCHAR || ':42'), o_orderkey) AS place FROM orders)
SELECT o_orderkey, place <= b + CASE WHEN turn <= spare THEN 1 ELSE 0 END AS is_test FROM p JOIN f USING (o_orderstatus)""")
def stratified_split_rows(spark, sf):
    train, test = prep.split_train_test(table(spark, sf, "orders"), "o_orderkey", "o_orderstatus", stratify=True)
    return train.select("o_orderkey", F.lit(False).alias("is_test")).unionByName(test.select("o_orderkey", F.lit(True).alias("is_test")))


@query("ML9", """SELECT o_orderkey, CAST((row_number() OVER (PARTITION BY o_orderstatus ORDER BY md5(o_orderkey::VARCHAR || ':42'), o_orderkey) - 1) % 5 AS INTEGER) AS fold FROM orders""")
def fold_rows(spark, sf):
    return prep.with_folds(table(spark, sf, "orders"), "o_orderkey", "o_orderstatus").select("o_orderkey", "fold")


@query("ML15", """WITH p AS (SELECT doc_id, toxic, row_number() OVER (PARTITION BY toxic ORDER BY md5(doc_id::VARCHAR || ':42'), doc_id) AS place FROM labels)
SELECT doc_id, toxic FROM p WHERE place <= (SELECT min(n) FROM (SELECT count(*) AS n FROM labels GROUP BY toxic))""")
def undersampled_rows(spark, sf):
    return prep.undersample(table(spark, sf, "labels"), "doc_id", "toxic").select("doc_id", "toxic")


@query("ML2", "SELECT CAST(ceil(0.2 * count(*)) AS BIGINT) AS test_rows, CAST(count(*) - ceil(0.2 * count(*)) AS BIGINT) AS train_rows FROM orders")
def plain_split(spark, sf):
    train, test = prep.split_train_test(table(spark, sf, "orders"), "o_orderkey", "o_orderstatus")
    return test.agg(F.count(F.lit(1)).alias("test_rows")).withColumn("train_rows", train.agg(F.count(F.lit(1))).scalar())


@query("ML9", """WITH n AS (SELECT o_orderstatus, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) - 1 AS r FROM orders)
SELECT o_orderstatus, CAST(r % 5 AS BIGINT) AS fold, count(*) AS n FROM n GROUP BY 1, 2""")
def fold_sizes(spark, sf):
    folds = prep.with_folds(table(spark, sf, "orders"), "o_orderkey", "o_orderstatus")
    return folds.groupBy("o_orderstatus", F.col("fold").cast("bigint").alias("fold")).agg(F.count(F.lit(1)).alias("n"))


@query("ML15", """SELECT toxic, (SELECT min(n) FROM (SELECT count(*) AS n FROM labels GROUP BY toxic)) AS n FROM labels GROUP BY toxic""")
def undersampled_classes(spark, sf):
    return prep.undersample(table(spark, sf, "labels"), "doc_id", "toxic").groupBy("toxic").agg(F.count(F.lit(1)).alias("n"))


@query("ML5", "SELECT doc_id, round((SELECT count(*) FROM labels) / (2.0 * count(*) OVER (PARTITION BY toxic)), 9)::DOUBLE AS class_weight FROM labels")
def balanced_weights(spark, sf):
    return prep.with_class_weights(table(spark, sf, "labels"), "toxic").select("doc_id", F.round("class_weight", 9).alias("class_weight"))


@query("ML14", note="random interpolation; balance and segment membership are tested")
def synthetic_minority(spark, sf):
    rows = labelled_documents(spark, sf).select("doc_id", "toxic", "n_chars", "n_words")
    return prep.smote(rows, "doc_id", "toxic", ["n_chars", "n_words"])


@query("ML1", """WITH t AS (SELECT p_partkey, CASE WHEN p_partkey % 9 <> 0 THEN p_size END AS size, CASE WHEN p_partkey % 10 <> 0 THEN p_type END AS kind FROM part),
m AS (SELECT median(size) AS med, (SELECT kind FROM t WHERE kind IS NOT NULL GROUP BY kind ORDER BY count(*) DESC, kind LIMIT 1) AS top FROM t),
f AS (SELECT p_partkey, coalesce(size, med) AS size, coalesce(kind, top) AS kind FROM t, m)
SELECT p_partkey, round((size - (SELECT avg(size) FROM f)) / (SELECT stddev_samp(size) FROM f), 6) + 0.0 AS size_scaled, 1.0::DOUBLE AS hot_sum,
  row_number() OVER (ORDER BY kc DESC, kind) IS NOT NULL AS has_kind, kind FROM (SELECT f.*, count(*) OVER (PARTITION BY kind) AS kc FROM f)""")
def preprocessed_parts(spark, sf):
    p = table(spark, sf, "part").select(
        "p_partkey", F.when(F.col("p_partkey") % 9 != 0, F.col("p_size")).alias("size"), F.when(F.col("p_partkey") % 10 != 0, F.col("p_type")).alias("kind")
    )
    out = prep.build_preprocessor(["size"], ["kind"]).fit(p).transform(p)
    values = vector_to_array("features")
    hot = F.aggregate(F.slice(values, 2, 100), F.lit(0.0), lambda a, x: a + x)
    return out.select("p_partkey", (F.round(values[0], 6) + 0.0).alias("size_scaled"), hot.alias("hot_sum"), F.col("kind__filled").isNotNull().alias("has_kind"), F.col("kind__filled").alias("kind"))


def document_features(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", "n_chars", F.size(F.split("text", " ")).alias("n_words"), F.contains("text", F.lit("!!")).cast("int").alias("shouts"), "lang", "source")


def labelled_documents(spark, sf):
    return document_features(spark, sf).join(table(spark, sf, "labels"), "doc_id")


def line_regression(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_quantity", "l_extendedprice")
    prepare = prep.build_preprocessor(["l_quantity"], [])
    model = Pipeline(stages=[prepare, LinearRegression(labelCol="l_extendedprice", solver="normal")]).fit(lines)
    return lines, model


@query("ML3", """WITH c AS (SELECT regr_slope(l_extendedprice, l_quantity) AS b, regr_intercept(l_extendedprice, l_quantity) AS a FROM lineitem)
SELECT l_quantity, round(a + b * l_quantity, 3) AS prediction, count(*) AS n FROM lineitem, c GROUP BY 1, 2""")
def linear_price_model(spark, sf):
    lines, model = line_regression(spark, sf)
    return model.transform(lines).groupBy("l_quantity", F.round("prediction", 3).alias("prediction")).agg(F.count(F.lit(1)).alias("n"))


@query("ML18", """SELECT '__scaled_0' AS feature, round(abs(regr_slope(l_extendedprice, l_quantity)) * (SELECT avg(abs(l_quantity - (SELECT avg(l_quantity) FROM lineitem))) FROM lineitem), 3) AS mean_abs_shap FROM lineitem""")
def linear_drivers(spark, sf):
    lines, model = line_regression(spark, sf)
    return explain.linear_attribution(model, lines, lines).withColumn("mean_abs_shap", F.round("mean_abs_shap", 3))


ADDS_UP_SQL = "SELECT l_orderkey, l_linenumber, TRUE AS adds_up FROM lineitem"


def _adds_up(spark, sf, estimator):
    """Whether the Shapley values of a tree model of the lines' prices and its mean sum to the prediction."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_extendedprice")
    prepare = prep.build_preprocessor(["l_quantity", "l_discount", "l_tax"], ["l_returnflag"])
    boosted = isinstance(estimator, GBTRegressor)
    model = boosting.fit_boosted(prepare, estimator, spread(lines)) if boosted else Pipeline(stages=[prepare, estimator]).fit(dealt_for_fit(lines))
    values = shapley.shapley_values(model, spread(lines), ["l_orderkey", "l_linenumber", "prediction"])
    told = F.aggregate("shapley", F.col("mean"), lambda a, v: a + v)
    return values.select("l_orderkey", "l_linenumber", (F.abs(told - F.col("prediction")) <= 1e-7 * (1 + F.abs("prediction"))).alias("adds_up"))


@query("ML18", ADDS_UP_SQL)
def forest_attribution_adds_up(spark, sf):
    """Of every line: the Shapley values of a random forest and its mean sum to the forest's prediction."""
    forest = RandomForestRegressor(labelCol="l_extendedprice", numTrees=12, maxDepth=6, featureSubsetStrategy="all", seed=42)
    return _adds_up(spark, sf, forest)


@query("ML18", ADDS_UP_SQL)
def boosted_attribution_adds_up(spark, sf):
    """The same for boosted trees."""
    boosted = GBTRegressor(labelCol="l_extendedprice", maxIter=8, stepSize=0.1, maxDepth=4, seed=42)
    return _adds_up(spark, sf, boosted)


@query("ML18", """WITH v AS (SELECT avg(l_extendedprice) FILTER (l_quantity <= 25) AS low, avg(l_extendedprice) FILTER (l_quantity > 25) AS high,
count(*) FILTER (l_quantity <= 25)::DOUBLE / count(*) AS share FROM lineitem)
SELECT 'is_large' AS feature, round(2 * share * (1 - share) * (high - low), 3) AS mean_abs_shap FROM v""")
def stump_drivers(spark, sf):
    """One split has a closed form: the values are the distances of the two leaves from the mean."""
    lines = table(spark, sf, "lineitem").select((F.col("l_quantity") > 25).cast("double").alias("is_large"), "l_extendedprice")
    tree = DecisionTreeRegressor(labelCol="l_extendedprice", maxDepth=1, seed=42)
    model = Pipeline(stages=[VectorAssembler(inputCols=["is_large"], outputCol="features"), tree]).fit(lines)
    return explain.attribution(model, lines, lines).withColumn("mean_abs_shap", F.round("mean_abs_shap", 3))


NUMERIC, CATEGORICAL = ["n_chars", "n_words", "shouts"], ["lang", "source"]


def _written_for_fit(rows):
    """Written twice, as the rows are counted and dealt after the texts are read: narrow rows of many documents come in one file, which is one task of every round."""
    return prep.materialize(dealt_for_fit(prep.materialize(rows, "train")), "train")


def _fit_and_rank(spark, sf, sets, label, evaluator):
    rows = labelled_documents(spark, sf)
    train, test = prep.split_train_test(rows, "doc_id", "quality", stratify=True)
    train, test = _written_for_fit(prep.with_class_weights(train, "quality")), prep.materialize(test, "test")
    fitted = {n: m.fit(train) for n, m in sets(prep.build_preprocessor(NUMERIC, CATEGORICAL), label).items()}
    return evaluator(fitted, test, label)


@query("ML4 ML7", note="MLlib fits, run without an equal in SQL")
def quality_classifiers(spark, sf):
    return _fit_and_rank(spark, sf, models.classification_models, "quality", evaluate.evaluate_classification)


@query("ML5 ML7", note="MLlib fits of the light set")
def light_classifiers(spark, sf):
    return _fit_and_rank(spark, sf, models.light_classification_models, "quality", evaluate.evaluate_classification)


@query("ML3 ML6", note="MLlib fits")
def length_regressors(spark, sf):
    rows = labelled_documents(spark, sf)
    train, test = prep.split_train_test(rows, "doc_id", "quality")
    train, test = _written_for_fit(train), prep.materialize(test, "test")
    made = models.light_regression_models(prep.build_preprocessor(["n_words", "shouts"], CATEGORICAL), "n_chars")
    return evaluate.evaluate_regression({n: made[n].fit(train) for n in made}, test, "n_chars")


@query("ML9 AGG30", note="MLlib fits per fold")
def cross_validated_quality(spark, sf):
    model = models.classification_models(prep.build_preprocessor(NUMERIC, CATEGORICAL), "quality")["log_reg"]
    return evaluate.aggregate_folds(tracking.cross_validate(model, labelled_documents(spark, sf), "quality", "doc_id"))


@query("ML8", note="MLlib grid search on the training rows; the best parameters scored on the test rows")
def tuned_quality(spark, sf):
    train, test = [prep.materialize(part, "part") for part in prep.split_train_test(labelled_documents(spark, sf), "doc_id", "quality", stratify=True)]
    model = models.classification_models(prep.build_preprocessor(NUMERIC, CATEGORICAL), "quality")["log_reg"]
    best, params = tracking.tune(model, {"C": [0.1, 1.0, 3.0]}, train, "quality", "doc_id")
    scored = evaluate.classification_metrics(evaluate.with_score(best.transform(test)), "quality", score="score")
    return scored.withColumn("params", F.lit(repr(params)))


@query("ML17", note="MLlib batch scoring of every document by a model of the labelled ones")
def scored_documents(spark, sf):
    rows = labelled_documents(spark, sf)
    model = models.classification_models(prep.build_preprocessor(NUMERIC, ["lang"]), "toxic")["log_reg"].fit(rows)
    return explain.score_transactions(model, document_features(spark, sf), "v1", "doc_id")


@query("ML16 AGG25 PIPE5", note="k-means clusters of customers")
def customer_clusters(spark, sf):
    return explain.cluster_means(explain.rfm_clusters(table(spark, sf, "orders"), "o_custkey", "o_orderdate", "o_totalprice"))


@query("ML16 AGG25", "SELECT o_custkey, TRUE AS nearest_is_own FROM orders GROUP BY o_custkey")
def clusters_are_nearest(spark, sf):
    """The condition of the optimum: each customer is nearest to the centre of its own cluster, up to the fit's tolerance."""
    rows = prep.materialize(explain.rfm_clusters(table(spark, sf, "orders"), "o_custkey", "o_orderdate", "o_totalprice"), "clusters")
    names = ["Recency", "Frequency", "Monetary"]
    scale = rows.agg(*[F.stddev_samp(c).alias(c) for c in names]).first()
    centres = rows.groupBy("Cluster").agg(*[F.avg(c).alias(c) for c in names]).collect()  # as many rows as clusters

    def distance(centre):
        return sum((((F.col(c) - F.lit(float(centre[c]))) / F.lit(float(scale[c]))) ** 2 for c in names), F.lit(0.0))

    own = F.coalesce(*[F.when(F.col("Cluster") == centre["Cluster"], distance(centre)) for centre in centres])
    nearest = F.least(*[distance(centre) for centre in centres]) if len(centres) > 1 else own
    return rows.select("o_custkey", (F.sqrt(own) <= F.sqrt(nearest) + 0.05).alias("nearest_is_own"))


@query("ML16 AGG25 PIPE5", note="orders by the engagement label of their customer")
def high_risk_orders(spark, sf):
    orders = table(spark, sf, "orders")
    clusters = prep.materialize(explain.rfm_clusters(orders, "o_custkey", "o_orderdate", "o_totalprice"), "clusters")
    labelled = explain.label_customers(orders, clusters, "o_custkey")
    return labelled.groupBy("is_high_risk").agg(F.count(F.lit(1)).alias("orders"), F.round(F.avg("o_totalprice"), 2).alias("avg_price"))
