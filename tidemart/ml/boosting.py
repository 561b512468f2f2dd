"""Boosted regression trees from sums over cells of rows.

A tree sees of a value only the bin that it lies in, and for squared errors a round needs of the rows of one cell (the same bins in every feature)
only their number and the sum of their labels: residuals of a cell differ from its labels by one number, and what labels vary within a cell is the
same on both sides of every split. So one pass over the rows adds up the cells, and all rounds run over cells, of which there are at most
bins^features, however many rows there are. The trees are those of a fit of the rows with these bins, up to the rounding of sums.

The bins of a feature lie around `maxBins` of its values, all of them if it has no more, else quantiles over all rows; a value belongs to the nearest,
up to the middle between two. That is where the library's own fit puts thresholds, so the model splits rows as it split the cells.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, isqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.ml.shapley import ROWS
from tidemart.session import dealt_for_fit, materialize

#: Features of a vector that is binned here, and values of a feature that are counted one by one.
FEATURES, COUNTED = 64, 10_000
#: Cells that a task adds up at a time.
TASK_CELLS = 1 << 18


def fit_boosted(prepare: Pipeline, estimator: GBTRegressor, rows: DataFrame) -> PipelineModel:
    """`prepare` and `estimator` fitted to `rows`. Fits that need more of a row than its cell (samples, weights, least rows of a node, other losses) run over the rows."""
    prepared = prepare.fit(rows)
    encoded = prepared.transform(rows)
    meta = encoded.schema[estimator.getFeaturesCol()].metadata
    size = meta.get("ml_attr", {}).get("num_attrs", FEATURES + 1)
    plain = (
        estimator.getLossType() == "squared" and estimator.getSubsamplingRate() == 1.0 and estimator.getMinInstancesPerNode() == 1
        and estimator.getMinWeightFractionPerNode() == 0.0 and not estimator.isSet("weightCol") and not estimator.isSet("validationIndicatorCol")
    )
    if not plain or size > FEATURES:
        return PipelineModel([*prepared.stages, estimator.fit(prepared.transform(dealt_for_fit(rows)))])
    points = encoded.select((vector_to_array(estimator.getFeaturesCol())).alias("x"), F.col(estimator.getLabelCol()).cast("double").alias("label"))
    values = bin_values(points, size, estimator.getMaxBins())
    cells = materialize(summed_cells(points, values).select(array_to_vector("x").alias(estimator.getFeaturesCol(), metadata=meta), (F.col("total") / F.col("n")).alias(estimator.getLabelCol()), F.col("n").alias("__n")), "cells")
    found, bins = cells.count(), estimator.getMaxBins()
    copies = ceil(bins / max(found, 1))  # the library wants as many rows as a feature has categories
    spread = cells.withColumn("__n", F.col("__n") / copies).withColumn("__copy", F.explode(F.sequence(F.lit(1), F.lit(copies)))).drop("__copy")
    every = max(bins, isqrt(found) + 1)  # from the square of which on the library looks for values in a sample
    return PipelineModel([*prepared.stages, estimator.copy({estimator.weightCol: "__n", estimator.maxBins: every}).fit(spread)])


def bin_values(points: DataFrame, size: int, bins: int) -> list[np.ndarray]:
    """For each position of `x` the values that its bins lie around, ascending."""
    counts = materialize(value_counts(points, size), "values")
    kinds = counts.groupBy("i").agg(F.count("v").alias("n"), F.count_if(F.col("v").isNull()).alias("uncounted")).collect()
    many = sorted(r["i"] for r in kinds if r["uncounted"] or r["n"] > COUNTED)
    places = (np.arange(bins) + 0.5) / bins
    out: dict[int, np.ndarray] = {i: np.zeros(1) for i in range(size)}
    for i, part in counts.filter(~F.col("i").isin(many)).toPandas().groupby("i"):  # at most `COUNTED` values of a feature
        part = part.sort_values("v")
        v, reached = part["v"].to_numpy(), part["n"].cumsum().to_numpy()
        out[int(i)] = v if len(v) <= bins else np.unique(v[np.searchsorted(reached, places * reached[-1])])
    if many:
        told = points.agg(*[F.percentile_approx(F.col("x")[i], [float(p) for p in places]).alias(f"f{i}") for i in many]).first()
        out |= {i: np.unique(np.array(told[f"f{i}"], np.float64)) for i in many}
    return [out[i] for i in range(size)]


def value_counts(points: DataFrame, size: int) -> DataFrame:
    """(i, v, n): how often each value stands at each position of `x`, in one pass; a null value for a position where a task met more than `COUNTED`."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pd.Series | None] = [pd.Series(dtype=np.int64)] * size
        for batch in batches:
            x = np.asarray(batch.column(0).flatten(), np.float64).reshape(batch.num_rows, -1) + 0.0
            for i, before in enumerate(held):
                if before is not None:
                    v, n = np.unique(x[:, i], return_counts=True)
                    now = before.add(pd.Series(n, index=v), fill_value=0) if len(before) else pd.Series(n, index=v)
                    held[i] = now if len(now) <= COUNTED else None
        for i, found in enumerate(held):
            v = [None] if found is None else found.index.to_numpy(np.float64)
            n = [0] if found is None else found.to_numpy(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([i] * len(n), pa.int32()), pa.array(v, pa.float64()), pa.array(n, pa.int64())], ["i", "v", "n"])

    return points.select("x").mapInArrow(counted, "i int, v double, n long").groupBy("i", "v").agg(F.sum("n").alias("n"))


def summed_cells(points: DataFrame, values: list[np.ndarray]) -> DataFrame:
    """(x, n, total): the nearest of `values` in each feature, the number of rows and the sum of their labels. Tasks add up what they meet."""
    edges = [(v[1:] + v[:-1]) / 2 for v in values]
    groups = _digits([len(v) for v in values])
    codes = [f"c{j}" for j in range(len(groups))]

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        kept, held = [], 0
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS):
                part = batch.slice(first, ROWS)
                label = part.column(1).to_numpy(zero_copy_only=False)
                if part.column(1).null_count or np.isnan(label).any():
                    raise ValueError("labels must not be null or NaN")
                x = np.asarray(part.column(0).flatten(), np.float64).reshape(len(label), -1)
                bins = [np.searchsorted(e, x[:, i]) for i, e in enumerate(edges)]
                kept.append(_added(pd.DataFrame({**{c: _number(bins, values, group) for c, group in zip(codes, groups, strict=True)}, "n": 1, "total": label}), codes))
                held += len(kept[-1])
            if held > TASK_CELLS:
                kept = [_added(pd.concat(kept), codes)]
                held = len(kept[0])
                if held > TASK_CELLS // 2:
                    yield kept[0]
                    kept, held = [], 0
        if kept:
            yield _added(pd.concat(kept), codes)

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cells in met(batches):
            yield pa.RecordBatch.from_pandas(cells, preserve_index=False)

    schema = ", ".join([f"{c} long" for c in codes]) + ", n long, total double"
    summed = points.mapInArrow(sent, schema).groupBy(*codes).agg(F.sum("n").alias("n"), F.sum("total").alias("total"))

    def spelled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for cells in batches:
            x = np.zeros((len(cells), len(values)))
            for c, group in zip(codes, groups, strict=True):
                left = cells[c].to_numpy()
                for i in reversed(group):
                    x[:, i] = values[i][left % len(values[i])]
                    left = left // len(values[i])
            yield pd.DataFrame({"x": list(x), "n": cells["n"], "total": cells["total"]})

    return summed.mapInPandas(spelled, "x array<double>, n long, total double")


def _digits(sizes: list[int]) -> list[list[int]]:
    """Features in groups whose bins are numbered by one long."""
    groups, room = [[]], 1
    for i, size in enumerate(sizes):
        if room * size >= 1 << 62:
            groups.append([])
            room = 1
        groups[-1].append(i)
        room *= size
    return groups


def _number(bins: list[np.ndarray], values: list[np.ndarray], group: list[int]) -> np.ndarray:
    code = np.zeros(len(bins[0]), np.int64)
    for i in group:
        code = code * len(values[i]) + bins[i]
    return code


def _added(cells: pd.DataFrame, codes: list[str]) -> pd.DataFrame:
    return cells.groupby(codes, as_index=False, sort=False).sum()
