"""Metrics, comparison and choice of models, as DataFrames."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.operators.charts import roc_auc

CLASS_METRICS = ("accuracy", "precision", "recall", "f1", "roc_auc")

# How interpretable a model is by its name, first match wins.
INTERPRETABILITY = {
    "log_reg": 5,
    "logistic": 5,
    "decision_tree": 4,
    "random_forest": 3,
    "gradient_boosting": 2,
    "xgb": 1,
    "xgboost": 1,
}


def regression_metrics(predictions: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """One row: mae, rmse, r2; r2 is null for a constant label."""
    y, gap = F.col(label).cast("double"), F.col(label) - F.col(prediction)
    mse = F.avg(gap * gap)
    return predictions.agg(
        F.avg(F.abs(gap)).alias("mae"), F.sqrt(mse).alias("rmse"), (1 - F.try_divide(mse, F.nullif(F.var_pop(y), F.lit(0.0)))).alias("r2")
    )


def classification_counts(label: Column, prediction: Column) -> dict[str, Column]:
    """accuracy, precision, recall, f1 of class 1; 0 where a ratio has no denominator."""
    hit = F.count_if((label == 1) & (prediction == 1))
    said, real = F.count_if(prediction == 1), F.count_if(label == 1)
    ratio = lambda a, b: F.coalesce(F.try_divide(a.cast("double"), b), F.lit(0.0))
    return {
        "accuracy": ratio(F.count_if(label == prediction), F.count(label)),
        "precision": ratio(hit, said),
        "recall": ratio(hit, real),
        "f1": ratio(2 * hit, said + real),
    }


def classification_metrics(predictions: DataFrame, label: str, prediction: str = "prediction", score: str | None = None) -> DataFrame:
    """One row of metrics; roc_auc is exact, null without a score or with one class only."""
    plain = predictions.agg(*[c.alias(n) for n, c in classification_counts(F.col(label), F.col(prediction)).items()])
    auc = roc_auc(predictions, label, score).scalar() if score else F.lit(None).cast("double")
    return plain.withColumn("roc_auc", auc)


def with_score(predictions: DataFrame, out: str = "score") -> DataFrame:
    """Probability of class 1 as a column, from the probability or the raw prediction; null without either."""
    for name in ("probability", "rawPrediction"):
        if name in predictions.columns:
            return predictions.withColumn(out, vector_to_array(name)[1])
    return predictions.withColumn(out, F.lit(None).cast("double"))


def _per_model(rows: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [df.select(F.lit(name).alias("model"), "*") for name, df in rows.items()])


def evaluate_regression(models: dict, test: DataFrame, label: str) -> DataFrame:
    """Fitted models against a test frame, best RMSE first."""
    return _per_model({n: regression_metrics(m.transform(test), label) for n, m in models.items()}).orderBy("rmse", "model")


def evaluate_classification(models: dict, test: DataFrame, label: str) -> DataFrame:
    """Fitted models against a test frame, best F1 first."""
    rows = {n: classification_metrics(with_score(m.transform(test)), label, score="score") for n, m in models.items()}
    return _per_model(rows).orderBy(F.desc_nulls_last("f1"), "model")


def long_metrics(wide: DataFrame, ids: Sequence[str] = ("model",)) -> DataFrame:
    """(ids, metric, value) of the numeric columns, nulls left out."""
    numeric = [n for n, kind in wide.dtypes if n not in ids and kind in ("double", "float", "int", "bigint", "smallint", "tinyint")]
    doubles = wide.select(*ids, *[F.col(c).cast("double").alias(c) for c in numeric])
    return doubles.unpivot(list(ids), numeric, "metric", "value").filter(F.col("value").isNotNull())


def aggregate_folds(folds: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Mean and population deviation of every metric over the folds."""
    return folds.groupBy(*keys, "metric").agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"))


def compare_models(results: DataFrame, metrics: Sequence[str] = CLASS_METRICS) -> DataFrame:
    """One row per model from (model_name, is_cv, fold, metric, value), best F1 first.

    A cross-validated model has the mean and deviation columns filled, and the mean as the metric.
    """
    per = results.groupBy("model_name").agg(
        *[F.avg(F.when(F.col("metric") == m, F.col("value"))).alias(m) for m in metrics],
        *[F.avg(F.when((F.col("metric") == m) & F.col("is_cv"), F.col("value"))).alias(f"{m}_mean") for m in metrics],
        *[F.stddev_pop(F.when((F.col("metric") == m) & F.col("is_cv"), F.col("value"))).alias(f"{m}_std") for m in metrics],
    )
    return per.orderBy(F.desc_nulls_last("f1"), "model_name") if "f1" in metrics else per


def interpretability(name: Column, scores: dict[str, int] = INTERPRETABILITY) -> Column:
    out = F.lit(0)
    for pattern, score in reversed(scores.items()):
        out = F.when(F.contains(F.lower(name), F.lit(pattern.lower())), score).otherwise(out)
    return out


def select_best_model(compared: DataFrame, metric: str = "f1", threshold: float = 0.02, scores: dict[str, int] | None = None) -> DataFrame:
    """(model_name, justification): among the models within `threshold` of the best, the most interpretable.

    A model without the metric counts as 0; ties go to the better score, then the name. One row per
    model reaches the aggregate.
    """
    rows = compared.select(
        "model_name", F.coalesce(metric, F.lit(0.0)).alias("score"), interpretability(F.col("model_name"), scores or INTERPRETABILITY).alias("interp")
    )
    best = rows.agg(F.max("score")).scalar()
    near = rows.filter(best - F.col("score") <= threshold)
    listed = F.array_sort(F.collect_list(F.struct((-F.col("interp")).alias("i"), (-F.col("score")).alias("s"), "model_name")))
    others = F.array_sort(F.transform(F.slice("listed", 2, F.greatest(F.size("listed") - 1, F.lit(0))), lambda x: F.struct(x["s"], x["model_name"])))
    top = F.col("listed")[0]
    name = top["model_name"]
    alone = F.format_string(f"Selected '%s' as it has the best {metric} score of %.4f", name, -top["s"])
    quoted = F.concat(F.lit("["), F.array_join(F.transform("others", lambda x: F.concat(F.lit("'"), x["model_name"], F.lit("'"))), ", "), F.lit("]"))
    shared = F.format_string(
        f"Selected '%s' (interpretability score: %d) with {metric}=%.4f. Models %s had comparable performance "
        f"(within {threshold * 100:.1f}%% threshold), but '%s' offers better interpretability.",
        name, -top["i"], -top["s"], quoted, name,
    )
    picked = near.agg(listed.alias("listed")).filter(F.size("listed") > 0).withColumn("others", others)
    return picked.select(name.alias("model_name"), F.when(F.size("listed") == 1, alone).otherwise(shared).alias("justification"))


def choose_best(scores: DataFrame, prefer: Sequence[str], direction: str = "max", name: str = "model") -> DataFrame:
    """(model, metric): best by the first preferred column that has a value, ties by name; without any, the first name."""
    present = [c for c in prefer if c in scores.columns]
    sign = -1 if direction == "max" else 1
    picks = [F.min(F.when(F.col(c).isNotNull(), F.struct((F.col(c) * sign).alias("v"), F.col(name).alias("m"), F.lit(c).alias("c")))) for c in present]
    fallback = F.min(F.struct(F.lit(0.0).alias("v"), F.col(name).alias("m"), F.lit(None).cast("string").alias("c")))
    aggs = [p.alias(f"p{i}") for i, p in enumerate([*picks, fallback])]
    named = lambda p: F.when(p.isNotNull(), F.struct(p["m"].alias("m"), p["c"].alias("c")))
    first = F.coalesce(*[named(F.col(f"p{i}")) for i in range(len(aggs))])
    return scores.agg(*aggs).select(first["m"].alias(name), first["c"].alias("metric"))
