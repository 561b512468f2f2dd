"""Tuning, cross-validation and the runs / registry tables."""

from __future__ import annotations

import itertools
import random
from collections.abc import Sequence
from multiprocessing.pool import ThreadPool

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import Evaluator, MulticlassClassificationEvaluator
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.ml.evaluate import CLASS_METRICS, aggregate_folds, classification_metrics, with_score
from tidemart.ml.prep import with_folds
from tidemart.session import materialize
from tidemart.sources.writers import TableFolder

RUNS_SCHEMA = "experiment string, run_id string, model_name string, search string, params string, metric string, value double, model_path string"
REGISTRY_SCHEMA = "name string, run_id string, metric string, value double, model_path string"


def f1_evaluator(label: str) -> Evaluator:
    return MulticlassClassificationEvaluator(labelCol=label, metricName="fMeasureByLabel", metricLabel=1.0)


def combinations(grid: dict[str, Sequence], search: str = "grid", draws: int = 10, seed: int = 42) -> list[dict]:
    """All combinations of the grid, or `draws` different ones of them."""
    names = list(grid)
    combos = [dict(zip(names, values)) for values in itertools.product(*[grid[n] for n in names])]
    if search == "random":
        combos = random.Random(seed).sample(combos, min(draws, len(combos)))
    elif search != "grid":
        raise ValueError("search must be 'grid' or 'random'")
    return combos


def parameter_map(model: Pipeline, combo: dict, rows: int) -> dict:
    """A combination as parameters of the last stage. C weighs a sum of losses and `regParam` stands against their mean
    over `rows` rows, so C becomes regParam = 1 / (C rows)."""
    estimator = model.getStages()[-1]
    named = {("regParam" if n == "C" else n): (1.0 / (v * max(1, rows)) if n == "C" else v) for n, v in combo.items()}
    return {estimator.getParam(n): v for n, v in named.items()}


def tune(
    model: Pipeline, grid: dict[str, Sequence], train: DataFrame, label: str, key: str, search: str = "grid", cv: int = 3,
    evaluator: Evaluator | None = None, parallelism: int = 2, seed: int = 42,
) -> tuple[PipelineModel, dict]:
    """Best pipeline refitted on all of `train`, and its parameters; stratified folds.

    Everything before the last stage is fitted once per fold and its output written, whatever the size of the grid.
    """
    combos = combinations(grid, search, seed=seed)
    judge = evaluator or f1_evaluator(label)
    folds = materialize(with_folds(train, key, label, cv, seed, "fold"), "folds")
    *before, last = model.getStages()
    totals = [0.0] * len(combos)
    for fold in range(cv):
        part = folds.filter(F.col("fold") != fold)
        ready = Pipeline(stages=before).fit(part)
        learn = materialize(ready.transform(part), "learn")
        check = materialize(ready.transform(folds.filter(F.col("fold") == fold)), "check")
        rows = learn.count()

        def score(combo: dict, learn=learn, check=check, rows=rows) -> float:
            return judge.evaluate(last.fit(learn, parameter_map(model, combo, rows)).transform(check))

        with ThreadPool(parallelism) as pool:
            totals = [total + value for total, value in zip(totals, pool.map(score, combos))]
    best = max(range(len(combos)), key=lambda i: totals[i] * (1 if judge.isLargerBetter() else -1))
    return model.fit(train, parameter_map(model, combos[best], train.count())), combos[best]


def cross_validate(model: Pipeline, df: DataFrame, label: str, key: str, cv: int = 5, seed: int = 42) -> DataFrame:
    """(fold, metric, value) of a fit per fold; a metric that cannot be computed is left out."""
    folds = materialize(with_folds(df, key, label, cv, seed), "folds")
    out = None
    for fold in range(cv):
        fitted = model.fit(folds.filter(F.col("fold") != fold))
        scored = with_score(fitted.transform(folds.filter(F.col("fold") == fold)))
        wide = classification_metrics(scored, label, score="score")
        long = wide.unpivot([], list(CLASS_METRICS), "metric", "value").filter(F.col("value").isNotNull())
        long = long.select(F.lit(fold).alias("fold"), "metric", "value")
        out = long if out is None else out.unionByName(long)
    return materialize(out, "cv")


def as_results(name: str, metrics: DataFrame, is_cv: bool) -> DataFrame:
    """Rows for `compare_models` from (fold, metric, value), or from one wide row of metrics."""
    long = metrics if "metric" in metrics.columns else metrics.unpivot([], list(CLASS_METRICS), "metric", "value").select(F.lit(None).cast("int").alias("fold"), "metric", "value")
    return long.select(F.lit(name).alias("model_name"), F.lit(is_cv).alias("is_cv"), F.col("fold").cast("int").alias("fold"), "metric", "value")


class Tracker:
    """Runs and registered models as tables, saved models as folders, below one root."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.runs = TableFolder(spark, f"{self.root}/runs", RUNS_SCHEMA)
        self.registry = TableFolder(spark, f"{self.root}/registry", REGISTRY_SCHEMA)

    def run(
        self, experiment: str, name: str, model: Pipeline, train: DataFrame, test: DataFrame, label: str, key: str,
        grid: dict[str, Sequence] | None = None, search: str = "grid",
    ) -> tuple[PipelineModel, DataFrame]:
        """Tune or fit, predict, score, save the model, record the run; returns model and metrics row."""
        fitted, params = tune(model, grid, train, label, key, search) if grid else (model.fit(train), {})
        metrics = materialize(classification_metrics(with_score(fitted.transform(test)), label, score="score"), "metrics")
        taken = self.runs.read().select("run_id").distinct().count()
        run_id = f"{experiment}-{taken + 1:04d}"
        path = f"{self.root}/models/{run_id}"
        fitted.write().overwrite().save(path)
        self.log(experiment, run_id, name, search if grid else None, params, metrics, path)
        return fitted, metrics

    def log(self, experiment: str, run_id: str, name: str, search: str | None, params: dict, metrics: DataFrame, path: str | None) -> None:
        long = metrics.unpivot([], list(CLASS_METRICS), "metric", "value").filter(F.col("value").isNotNull())
        self.runs.append(
            long.select(
                F.lit(experiment).alias("experiment"), F.lit(run_id).alias("run_id"), F.lit(name).alias("model_name"), F.lit(search).alias("search"),
                F.lit(repr(params) if params else None).alias("params"), "metric", "value", F.lit(path).alias("model_path"),
            )
        )

    def log_folds(self, experiment: str, name: str, folds: DataFrame, resampling: str | None = None) -> None:
        """Mean and deviation of a cross-validation as one run."""
        stats = aggregate_folds(folds).unpivot(["metric"], ["mean", "std"], "part", "value")
        run_id = f"{experiment}-{name}-cv"
        self.runs.append(
            stats.select(
                F.lit(experiment).alias("experiment"), F.lit(run_id).alias("run_id"), F.lit(name).alias("model_name"), F.lit("cv").alias("search"),
                F.lit(resampling).alias("params"), F.concat_ws("_", "metric", "part").alias("metric"), "value", F.lit(None).cast("string").alias("model_path"),
            )
        )

    def best_run(self, experiment: str, metric: str = "f1", higher_is_better: bool = True) -> DataFrame:
        """The one best run (ties by run id), no row when the experiment has none."""
        runs = self.runs.read().filter((F.col("experiment") == experiment) & (F.col("metric") == metric))
        value = F.desc_nulls_last("value") if higher_is_better else F.asc_nulls_last("value")
        return runs.orderBy(value, "run_id").limit(1)

    def register_best(self, experiment: str, metric: str = "f1", higher_is_better: bool = True) -> DataFrame:
        """Append the best run to the registry as <experiment>_best_model."""
        best = self.best_run(experiment, metric, higher_is_better).select(
            F.lit(f"{experiment}_best_model").alias("name"), "run_id", "metric", "value", "model_path"
        )
        self.registry.append(best)
        return best

    def load_best(self, experiment: str) -> PipelineModel:
        row = self.registry.read().filter(F.col("name") == f"{experiment}_best_model").orderBy(F.desc("value")).first()
        return PipelineModel.load(row["model_path"])
