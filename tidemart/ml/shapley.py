"""Shapley values of tree models, from the paths to their leaves.

A leaf's path says for each feature on it which values lead on (an interval or a set of categories) and which share of the training
rows went on at its splits. With a set S of known features the leaf weighs: 1 or 0 for a known feature, by whether the row's
value leads on, and the share for an unknown one. The Shapley value of feature j in one leaf of value v is then

    v (o_j - z_j) * integral over y from 0 to 1 of the product over the other features k of (z_k (1 - y) + o_k y)

where o is what a known feature weighs and z the share: y^s (1 - y)^(d-1-s) integrates to the weight of a subset of s of the other d - 1 features.
The product is a polynomial in y, so a Gauss-Legendre rule of half its degree is exact. Sums over leaves, weighted by
tree, are the model's values; they add up to its output minus its mean over the training rows.

The output is the prediction of a regression model, the probability of class 1 of a tree or a forest, and the margin of boosted classes.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.session import new_shared_path

#: Every task holds all paths, so these may take so many bytes.
PATH_BYTES = 512 << 20
#: Rows that are worked on at a time.
ROWS = 8192
#: Rows that differ in some condition, whose values a task keeps.
KNOWN_ROWS = 1 << 16


@dataclass(frozen=True)
class Path:
    """One leaf: its value times the weight of its tree, and for each feature on the way the share and the values that lead on."""

    value: float
    features: np.ndarray
    shares: np.ndarray
    lower: np.ndarray
    upper: np.ndarray
    allowed: tuple[np.ndarray | None, ...]

    def known(self, x: np.ndarray) -> np.ndarray:
        """For each row and feature on the path, whether the value leads on."""
        values = x[:, self.features]
        out = (values > self.lower) & (values <= self.upper)
        for place, categories in enumerate(self.allowed):
            if categories is not None:
                out[:, place] = categories[np.clip(values[:, place].astype(np.int64), 0, len(categories) - 1)]
        return out

    def size(self) -> int:
        return 200 + 32 * len(self.features) + sum(100 + len(one) for one in self.allowed if one is not None)


def _tree_rows(spark: SparkSession, estimator) -> tuple[dict[int, dict[int, object]], list[float]]:
    """Nodes by tree and id as the saved model has them, and the trees' weights."""
    folder = new_shared_path(spark, "trees")
    estimator.save(folder)
    saved = spark.read.parquet(f"{folder}/data")
    single = "treeID" not in saved.columns
    nodes = saved.select(F.lit(0).alias("tree"), F.struct("*").alias("node")) if single else saved.select(F.col("treeID").alias("tree"), F.col("nodeData").alias("node"))
    trees: dict[int, dict[int, object]] = {}
    for row in nodes.toLocalIterator():  # the model, which the driver holds anyway
        trees.setdefault(row["tree"], {})[row["node"]["id"]] = row["node"]
    if single:
        return trees, [1.0]
    weights = list(estimator.treeWeights)
    boosted = type(estimator).__name__.startswith("GBT")
    return trees, weights if boosted else [1.0 / len(weights)] * len(weights)


def _weight(node, classes: bool) -> float:
    """Training rows that reached a node, by their weights: one line of a weighted fit may stand for many rows."""
    return float(sum(node["impurityStats"]) if classes else node["impurityStats"][0])


def tree_paths(spark: SparkSession, estimator) -> tuple[list[Path], float]:
    """Paths of a fitted tree, forest or boosted model of MLlib, and its mean output over the training rows."""
    trees, weights = _tree_rows(spark, estimator)
    classes = "Classification" in type(estimator).__name__ and not type(estimator).__name__.startswith("GBT")
    paths: list[Path] = []
    mean = 0.0
    for tree, nodes in trees.items():
        stack = [(0, 1.0, {})]
        while stack:
            number, reach, way = stack.pop()
            node = nodes[number]
            if node["leftChild"] < 0:
                stats = node["impurityStats"]
                value = weights[tree] * ((stats[1] / (sum(stats) or 1.0) if len(stats) > 1 else 0.0) if classes else node["prediction"])
                mean += value * reach
                order = sorted(way)
                sides = [way[feature] for feature in order]
                paths.append(
                    Path(value, np.array(order, np.int64), np.array([s[0] for s in sides]), np.array([s[1] for s in sides]), np.array([s[2] for s in sides]), tuple(s[3] for s in sides))
                )
                continue
            split, children = node["split"], (node["leftChild"], node["rightChild"])
            counts = [max(_weight(nodes[child], classes), 1e-9) for child in children]
            for side, child in enumerate(children):
                share, lower, upper, allowed = way.get(split["featureIndex"], (1.0, -np.inf, np.inf, None))
                part = counts[side] / sum(counts)
                if split["numCategories"] < 0:
                    threshold = split["leftCategoriesOrThreshold"][0]
                    lower, upper = (lower, min(upper, threshold)) if side == 0 else (max(lower, threshold), upper)
                else:
                    left = np.zeros(split["numCategories"], bool)
                    left[np.array(split["leftCategoriesOrThreshold"], np.int64)] = True
                    here = left if side == 0 else ~left
                    allowed = here if allowed is None else allowed & here
                stack.append((child, reach * part, {**way, split["featureIndex"]: (share * part, lower, upper, allowed)}))
    if sum(path.size() for path in paths) > PATH_BYTES:
        raise ValueError(f"the paths of this model are more than {PATH_BYTES} bytes; explain a model with fewer or shallower trees")
    return paths, mean


def path_values(paths: list[Path], x: np.ndarray) -> np.ndarray:
    """Shapley values of the rows of `x`, one column per feature."""
    out = np.zeros(x.shape)
    rules: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for path in paths:
        d = len(path.features)
        if not d or not path.value:
            continue
        if d not in rules:
            places, weights = np.polynomial.legendre.leggauss((d + 1) // 2)
            rules[d] = (places + 1) / 2, weights / 2
        y, w = rules[d]
        # rows that meet the same conditions have the same values; a path has at most 30 features, one bit each
        codes, place = np.unique(path.known(x) @ (1 << np.arange(d)), return_inverse=True)
        known = (codes[:, None] >> np.arange(d)) & 1
        weighed = (path.shares[:, None] * (1 - y))[None, :, :] + known[:, :, None] * y
        others = weighed.prod(1)[:, None, :] / weighed
        out[:, path.features] += (path.value * (known - path.shares) * (others @ w))[place]
    return out


class KnownValues:
    """`path_values`, worked out once for rows that are on the same side of every threshold of the model.

    Rows are numbered by the intervals (or categories) that their values lie in. The values of up to `KNOWN_ROWS` numbers are kept. Models with too many
    intervals to number, and rows with NaN, are worked out row by row.
    """

    def __init__(self, paths: list[Path]):
        self.paths = paths
        edges: dict[int, set[float]] = {}
        self.levels: dict[int, int] = {}
        for path in paths:
            for feature, lower, upper, allowed in zip(path.features.tolist(), path.lower.tolist(), path.upper.tolist(), path.allowed, strict=True):
                edges.setdefault(feature, set()).update(v for v in (lower, upper) if np.isfinite(v))
                if allowed is not None:
                    self.levels[feature] = len(allowed)
        self.edges = {feature: np.array(sorted(edges[feature])) for feature in sorted(edges)}
        sizes = [(len(e) + 1) * self.levels.get(f, 1) for f, e in self.edges.items()]
        self.numbered = float(np.prod([float(s) for s in sizes])) < 2.0**62
        self.codes, self.values = np.empty(0, np.int64), None

    def of(self, x: np.ndarray) -> np.ndarray:
        if not self.numbered or np.isnan(x).any():
            return path_values(self.paths, x)
        code = np.zeros(len(x), np.int64)
        for feature, edges in self.edges.items():
            code = code * (len(edges) + 1) + np.searchsorted(edges, x[:, feature])
            if feature in self.levels:
                code = code * self.levels[feature] + np.clip(x[:, feature].astype(np.int64), 0, self.levels[feature] - 1)
        found, first, place = np.unique(code, return_index=True, return_inverse=True)
        new = ~np.isin(found, self.codes, assume_unique=True)
        if new.any():
            made = path_values(self.paths, x[first[new]])
            if self.values is None or len(self.codes) + len(made) > KNOWN_ROWS:
                keep = np.isin(self.codes, found, assume_unique=True)
                self.codes, self.values = self.codes[keep], np.zeros((0, x.shape[1])) if self.values is None else self.values[keep]
            codes, values = np.concatenate([self.codes, found[new]]), np.concatenate([self.values, made])
            order = codes.argsort()
            self.codes, self.values = codes[order], values[order]
        return self.values[np.searchsorted(self.codes, found)[place]]


def shapley_values(model: PipelineModel, rows: DataFrame, keep: Sequence[str]) -> DataFrame:
    """The columns `keep` of each row or of the model's output, `shapley` (the values by position) and `mean`, for a pipeline that ends in a tree model."""
    spark = rows.sparkSession
    encoded = model.transform(rows).select(*keep, vector_to_array("features").alias("__x"))
    paths, mean = tree_paths(spark, model.stages[-1])
    shared = spark.sparkContext.broadcast(paths)

    def explained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = KnownValues(shared.value)
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS):
                part = batch.slice(first, ROWS)
                x = part.column(len(keep))
                values = known.of(np.asarray(x.flatten(), np.float64).reshape(len(x), -1))
                offsets = pa.array(np.arange(len(x) + 1, dtype=np.int32) * values.shape[1], pa.int32())
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.ListArray.from_arrays(offsets, pa.array(values.ravel()))], [*keep, "shapley"])

    schema = T.StructType([*[encoded.schema[name] for name in keep], T.StructField("shapley", T.ArrayType(T.DoubleType()))])
    return encoded.mapInArrow(explained, schema).withColumn("mean", F.lit(mean))


def mean_magnitudes(model: PipelineModel, rows: DataFrame, names: list[str]) -> DataFrame:
    """(feature, mean_abs_shap) over all rows; tasks sum what they meet, so a line per feature and task is shuffled."""
    spark = rows.sparkSession
    encoded = PipelineModel(model.stages[:-1]).transform(rows).select(vector_to_array("features").alias("x"))
    paths, _ = tree_paths(spark, model.stages[-1])
    shared = spark.sparkContext.broadcast(paths)

    def summed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, total, n = KnownValues(shared.value), np.zeros(len(names)), 0
        for batch in batches:
            for first in range(0, len(batch), ROWS):
                part = np.stack(batch["x"].iloc[first : first + ROWS].to_numpy())
                total += np.abs(known.of(part)).sum(0)
                n += len(part)
        if n:
            yield pd.DataFrame({"feature": names, "total": total, "n": n})

    parts = encoded.mapInPandas(summed, "feature string, total double, n long")
    return parts.groupBy("feature").agg((F.sum("total") / F.sum("n")).alias("mean_abs_shap"))
