"""Model sets: named pipelines that share one preprocessor."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor

UNLIMITED_DEPTH = 30  # the deepest tree Spark grows
#: Tasks keep the node that each row has reached; else every round sends them the whole trees, which grow with the rows.
DEEP = {"maxDepth": UNLIMITED_DEPTH, "cacheNodeIds": True}


def _with(preprocessor: Pipeline, models: dict) -> dict[str, Pipeline]:
    return {name: Pipeline(stages=[preprocessor, model]) for name, model in models.items()}


def regression_models(preprocessor: Pipeline, label: str, seed: int = 42) -> dict[str, Pipeline]:
    common = {"featuresCol": "features", "labelCol": label}
    return _with(preprocessor, {
        "linear_regression": LinearRegression(**common),
        "random_forest_regressor": RandomForestRegressor(**common, numTrees=150, **DEEP, featureSubsetStrategy="all", seed=seed),
        "gradient_boosting_regressor": GBTRegressor(**common, maxIter=100, stepSize=0.1, maxDepth=3, seed=seed),
        "boosted_trees_regressor": GBTRegressor(**common, maxIter=200, stepSize=0.05, subsamplingRate=0.8, featureSubsetStrategy="0.8", maxDepth=6, seed=seed),
    })


def classification_models(preprocessor: Pipeline, label: str, seed: int = 42, rows: int | None = None) -> dict[str, Pipeline]:
    """With `rows`, the number of training rows, the logistic model has the penalty of C = 1, which is 1 / rows here; without, none."""
    common = {"featuresCol": "features", "labelCol": label}
    return _with(preprocessor, {
        "log_reg": LogisticRegression(**common, maxIter=1000, regParam=1.0 / rows if rows else 0.0),
        "decision_tree": DecisionTreeClassifier(**common, **DEEP, seed=seed),
        "random_forest_clf": RandomForestClassifier(**common, numTrees=150, **DEEP, seed=seed),
        "gradient_boosting_clf": GBTClassifier(**common, maxIter=100, stepSize=0.1, maxDepth=3, seed=seed),
        "boosted_trees_clf": GBTClassifier(**common, maxIter=200, stepSize=0.05, subsamplingRate=0.8, featureSubsetStrategy="0.8", maxDepth=6, seed=seed),
    })


def light_regression_models(preprocessor: Pipeline, label: str, seed: int = 42) -> dict[str, Pipeline]:
    common = {"featuresCol": "features", "labelCol": label}
    return _with(preprocessor, {
        "linear": LinearRegression(**common),
        "rf": RandomForestRegressor(**common, numTrees=80, maxDepth=12, minInstancesPerNode=2, featureSubsetStrategy="all", seed=seed),
        "gbr": GBTRegressor(**common, maxIter=200, stepSize=0.05, maxDepth=3, seed=seed),
    })


def light_classification_models(preprocessor: Pipeline, label: str, seed: int = 42, weight: str | None = "class_weight") -> dict[str, Pipeline]:
    """The logistic model is balanced by the weights of `prep.with_class_weights`."""
    common = {"featuresCol": "features", "labelCol": label}
    balanced = {"weightCol": weight} if weight else {}
    return _with(preprocessor, {
        "logreg": LogisticRegression(**common, maxIter=200, **balanced),
        "rf": RandomForestClassifier(**common, numTrees=120, maxDepth=12, minInstancesPerNode=2, seed=seed),
        "gbr": GBTClassifier(**common, maxIter=200, stepSize=0.05, maxDepth=3, seed=seed),
    })
