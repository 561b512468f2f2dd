"""Scoring, attribution and the customer engagement label."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.ml.evaluate import with_score
from tidemart.ml.shapley import mean_magnitudes
from tidemart.operators.features import rfm
from tidemart.operators.order import null_safe_join

DEFAULT_ACTION = "Review this driver with the business and track it over time."


def score_transactions(model: PipelineModel, df: DataFrame, version: str, key: str = "TransactionId") -> DataFrame:
    """(key, is_fraud, probability, model_version); probability is 0.0 for a model that gives none."""
    scored = model.transform(df)
    scored = with_score(scored) if "probability" in scored.columns else scored.withColumn("score", F.lit(0.0))
    return scored.select(key, (F.col("prediction") == 1).alias("is_fraud"), F.col("score").alias("probability"), F.lit(version).alias("model_version"))


def feature_names(df: DataFrame, features: str = "features") -> list[str]:
    """Names of the assembled features, by position."""
    groups = df.schema[features].metadata.get("ml_attr", {}).get("attrs", {})
    named = {a["idx"]: a.get("name", f"f{a['idx']}") for attrs in groups.values() for a in attrs}
    size = df.schema[features].metadata.get("ml_attr", {}).get("num_attrs", len(named))
    return [named.get(i, f"f{i}") for i in range(size)]


def linear_attribution(model: PipelineModel, train: DataFrame, rows: DataFrame, top_n: int = 10) -> DataFrame:
    """(feature, mean_abs_shap) of a pipeline that ends in a linear model, largest first.

    For a linear model the Shapley value of feature j is w_j (x_j - mean_j); its mean absolute value
    over all rows is |w_j| mean|x_j - mean_j|.
    """
    estimator, prepare = model.stages[-1], PipelineModel(model.stages[:-1])
    encoded = prepare.transform(rows)
    centred = StandardScaler(inputCol="features", outputCol="__centred", withMean=True, withStd=False).fit(prepare.transform(train)).transform(encoded)
    facts = centred.agg(vector_to_array(Summarizer.normL1(F.col("__centred"))).alias("sums"), F.count(F.lit(1)).alias("n"))
    named = [F.struct(F.lit(n).alias("feature"), F.lit(abs(float(w))).alias("w")) for n, w in zip(feature_names(encoded), estimator.coefficients.toArray())]
    values = facts.select("n", F.inline(F.arrays_zip(F.array(*named).alias("fact"), F.col("sums"))).alias("fact", "sum"))
    per = values.select("fact.feature", (F.col("fact.w") * F.col("sum") / F.col("n")).alias("mean_abs_shap"))
    return per.orderBy(F.desc("mean_abs_shap"), "feature").limit(top_n)


def tree_attribution(model: PipelineModel, rows: DataFrame, top_n: int = 10) -> DataFrame:
    """(feature, mean_abs_shap) of a pipeline that ends in a tree, a forest or boosted trees, largest first."""
    names = feature_names(PipelineModel(model.stages[:-1]).transform(rows.limit(0)))
    return mean_magnitudes(model, rows, names).orderBy(F.desc("mean_abs_shap"), "feature").limit(top_n)


def attribution(model: PipelineModel, train: DataFrame, rows: DataFrame, top_n: int = 10) -> DataFrame:
    """(feature, mean_abs_shap) of a linear or a tree model."""
    linear = hasattr(model.stages[-1], "coefficients")
    return linear_attribution(model, train, rows, top_n) if linear else tree_attribution(model, rows, top_n)


def tree_importance(model: PipelineModel, rows: DataFrame, top_n: int = 10) -> DataFrame:
    """(feature, importance) of a pipeline that ends in a tree model (impurity based)."""
    estimator, prepare = model.stages[-1], PipelineModel(model.stages[:-1])
    names = feature_names(prepare.transform(rows.limit(0)))
    pairs = list(zip(names, (float(v) for v in estimator.featureImportances.toArray())))
    out = rows.sparkSession.createDataFrame(pairs, "feature string, importance double")
    return out.orderBy(F.desc("importance"), "feature").limit(top_n)


def attach_actions(top: DataFrame, actions: Mapping[str, str] | DataFrame, fallback: str = DEFAULT_ACTION) -> DataFrame:
    """An action per driver, from a mapping or a (feature, action) table; the fallback text otherwise."""
    table = actions if isinstance(actions, DataFrame) else top.sparkSession.createDataFrame(list(actions.items()), "feature string, action string")
    joined = top.join(table.select("feature", F.col("action").alias("__a")), "feature", "left")
    return joined.withColumn("action", F.coalesce("__a", F.lit(fallback))).drop("__a")


def rfm_clusters(df: DataFrame, customer: str = "CustomerId", time: str = "TransactionStartTime", amount: str = "Amount", clusters: int = 3, seed: int = 42) -> DataFrame:
    """(customer, Recency, Frequency, Monetary, Cluster) from k-means on the standardised values."""
    table = rfm(df, customer, time, amount)
    columns = ["Recency", "Frequency", "Monetary"]
    pipe = Pipeline(stages=[
        VectorAssembler(inputCols=columns, outputCol="__raw"),
        StandardScaler(inputCol="__raw", outputCol="__z", withMean=True, withStd=True),
        KMeans(featuresCol="__z", predictionCol="Cluster", k=clusters, seed=seed),
    ])
    return pipe.fit(table).transform(table).select(customer, *columns, "Cluster")


def cluster_means(clusters: DataFrame) -> DataFrame:
    return clusters.groupBy("Cluster").agg(*[F.avg(c).alias(c) for c in ("Recency", "Frequency", "Monetary")], F.count(F.lit(1)).alias("customers"))


def high_risk_cluster(clusters: DataFrame) -> DataFrame:
    """One row, the least engaged cluster: lowest standardised frequency + monetary - recency."""
    spread = clusters.agg(*[F.nullif(F.stddev_pop(c), F.lit(0.0)).alias(c) for c in ("Recency", "Frequency", "Monetary")]).select(F.struct("*")).scalar()
    z = lambda c: F.coalesce(F.col(c) / spread[c], F.lit(0.0))
    engaged = cluster_means(clusters).select("Cluster", (z("Frequency") + z("Monetary") - z("Recency")).alias("engagement"))
    return engaged.agg(F.min_by("Cluster", F.struct("engagement", "Cluster")).alias("Cluster"))


def label_customers(df: DataFrame, clusters: DataFrame, customer: str = "CustomerId") -> DataFrame:
    """Every row with is_high_risk of its customer."""
    risky = high_risk_cluster(clusters).scalar()
    flags = clusters.select(customer, (F.col("Cluster") == risky).cast("int").alias("is_high_risk"))
    return null_safe_join(df, flags, [customer])
