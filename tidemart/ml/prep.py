"""Preprocessing, splits, folds and resampling."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.ml import Estimator, Pipeline
from pyspark.ml.feature import FeatureHasher, OneHotEncoder, SQLTransformer, StandardScaler, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemart.operators import cells
from tidemart.operators.order import first_by_hash, hash_index, head_per_group, quantiles
from tidemart.operators.tabular import select_features  # noqa: F401
from tidemart.session import materialize


class FillMissing(Estimator):
    """Numeric nulls become the column's median, categorical ones its most frequent value (ties by value).

    Medians and modes come from counts of distinct values; the fitted model is a plain SQL
    transformer, so it runs in the JVM and is saved with the pipeline.
    """

    def __init__(self, numeric: Iterable[str], categorical: Iterable[str], suffix: str = "__filled", approximate: bool = False):
        super().__init__()
        self.numeric, self.categorical, self.suffix, self.approximate = list(numeric), list(categorical), suffix, approximate

    def _fit(self, df: DataFrame) -> SQLTransformer:
        cells = []
        if self.numeric:
            long = df.select(*[F.expr(f"nanvl(try_cast(`{c}` as double), null)").alias(c) for c in self.numeric]).unpivot([], self.numeric, "name", "value")
            medians = {r["name"]: r["m"] for r in quantiles(long, ["name"], "value", {"m": 0.5}, self.approximate).collect()}
            for c in self.numeric:
                cells.append(f"coalesce(nanvl(try_cast(`{c}` as double), null), {float(medians.get(c) or 0.0)!r}D) AS `{c}{self.suffix}`")
        if self.categorical:
            long = df.select(*[F.col(c).cast("string").alias(c) for c in self.categorical]).unpivot([], self.categorical, "name", "value")
            counts = long.filter("value is not null").groupBy("name", "value").agg(F.count(F.lit(1)).alias("n"))
            modes = {r["name"]: r["value"] for r in head_per_group(counts, ["name"], ["-n", "value"], 1).collect()}
            for c in self.categorical:
                text = modes.get(c, "missing").replace("\\", "\\\\").replace("'", "\\'")
                cells.append(f"coalesce(cast(`{c}` as string), '{text}') AS `{c}{self.suffix}`")
        return SQLTransformer(statement=f"SELECT *, {', '.join(cells)} FROM __THIS__")


def build_preprocessor(numeric: Iterable[str], categorical: Iterable[str], hashed: Iterable[str] = (), approximate: bool = False, output: str = "features") -> Pipeline:
    """Median fill and standardising for numbers; mode fill and one-hot for categories.

    A category not seen in training gets all zeros. `hashed` columns (see `split_by_levels`) are
    hashed into a fixed number of slots instead, so their level list is never held in one place.
    """
    numeric, categorical, hashed = list(numeric), list(categorical), list(hashed)
    fill = FillMissing(numeric, categorical + hashed, approximate=approximate)
    stages: list = [fill]
    parts: list[str] = []
    filled = lambda c: f"{c}{fill.suffix}"
    if numeric:
        stages.append(VectorAssembler(inputCols=[filled(c) for c in numeric], outputCol="__numbers"))
        stages.append(StandardScaler(inputCol="__numbers", outputCol="__scaled", withMean=True, withStd=True))
        parts.append("__scaled")
    if categorical:
        index, hot = [f"{c}__index" for c in categorical], [f"{c}__hot" for c in categorical]
        stages.append(StringIndexer(inputCols=[filled(c) for c in categorical], outputCols=index, handleInvalid="keep"))
        stages.append(OneHotEncoder(inputCols=index, outputCols=hot, dropLast=True))
        parts += hot
    if hashed:
        stages.append(FeatureHasher(inputCols=[filled(c) for c in hashed], outputCol="__hashed", numFeatures=1 << 18))
        parts.append("__hashed")
    stages.append(VectorAssembler(inputCols=parts, outputCol=output))
    return Pipeline(stages=stages)


def split_by_levels(df: DataFrame, categorical: Sequence[str], hashed: Iterable[str] = (), max_levels: int = 10_000) -> tuple[list[str], list[str]]:
    """Categories to encode one-hot, and those of them that the caller names to be hashed.

    Levels of one-hot columns are held on the driver: a column with more than `max_levels` that is not named is an error.
    """
    many = [c for c in categorical if c in set(hashed)]
    few = [c for c in categorical if c not in many]
    if few:
        levels = df.agg(*[F.approx_count_distinct(c).alias(c) for c in few]).first()
        large = [c for c in few if levels[c] > max_levels]
        if large:
            raise ValueError(f"more than {max_levels} levels for one-hot columns; name them in `hashed`: {', '.join(large)}")
    return few, many


def test_sizes(df: DataFrame, target: str, test_size: float = 0.2) -> DataFrame:
    """Test rows per class: ceil(test_size x n) in all, shared in proportion, largest remainders first.

    The window runs over one row per class.
    """
    counts = df.groupBy(target).agg(F.count(F.lit(1)).alias("n"))
    every = W.partitionBy()
    total = F.sum("n").over(every)
    want = F.ceil(F.round(total * test_size, 9))
    shared = counts.withColumn("want", want).withColumn("exact", F.col("want") * F.col("n") / total)
    floored = shared.withColumn("base", F.floor("exact"))
    left = F.col("want") - F.sum("base").over(every)
    turn = F.row_number().over(W.partitionBy().orderBy(F.desc(F.round(F.col("exact") - F.col("base"), 9)), F.asc_nulls_last(target)))
    return floored.select(target, "n", (F.col("base") + F.when(turn <= left, 1).otherwise(0)).alias("test_rows"))


def split_train_test(
    df: DataFrame, key: str, target: str, drop: Iterable[str] = (), test_size: float = 0.2, seed: int = 42, stratify: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Exact, repeatable split by a hash of the row key; features and target stay in one frame."""
    rows, test = df.drop(*drop), "__test"
    if stratify:
        wants = test_sizes(df, target, test_size).select(target, F.col("test_rows").alias("__want"))
    else:
        wants = df.agg(F.ceil(F.round(F.count(F.lit(1)) * test_size, 9)).alias("__want"))
    flagged = first_by_hash(rows, [target] if stratify else [], key, wants, seed, test)
    return flagged.filter(~F.col(test)).drop(test), flagged.filter(test).drop(test)


def with_folds(df: DataFrame, key: str, target: str, k: int = 5, seed: int = 42, out: str = "fold") -> DataFrame:
    """Stratified folds 0..k-1: each class dealt out in hash order."""
    placed = hash_index(df, [target], key, seed, "__place")
    return placed.withColumn(out, F.pmod(F.col("__place") - 1, F.lit(k)).cast("int")).drop("__place")


def with_class_weights(df: DataFrame, target: str, out: str = "class_weight") -> DataFrame:
    """Balanced weights n / (classes x class rows)."""
    counts = df.groupBy(target).agg(F.count(F.lit(1)).alias("__c"))
    facts = counts.agg(F.sum("__c").alias("n"), F.count(F.lit(1)).alias("k")).select(F.struct("*")).scalar()
    weights = counts.select(target, (facts["n"] / (facts["k"] * F.col("__c"))).alias(out))
    return df.join(weights, target)


def undersample(df: DataFrame, key: str, target: str, seed: int = 42) -> DataFrame:
    """Every class cut to the smallest class, at random but repeatably."""
    counts = df.groupBy(target).agg(F.count(F.lit(1)).alias("n"))
    wants = counts.select(target, counts.agg(F.min("n")).scalar().alias("__want"))
    return first_by_hash(df, [target], key, wants, seed).filter("__first").drop("__first")


def _unit(*parts) -> Column:
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 30)) / float(1 << 30)


def smote(df: DataFrame, key: str, target: str, features: Sequence[str], k: int = 5, seed: int = 42) -> DataFrame:
    """(target, features, synthetic): all rows, plus synthetic rows until every class equals the largest.

    A synthetic row lies between a row and one of its k nearest rows of the same class. Every base
    row gives the same number of them, give or take one. Neighbours are exact; the work is the
    square of a minority class.
    """
    point = F.array(*[F.col(c).cast("double") for c in features])
    rows = materialize(df.select(F.col(key).alias("id"), target, point.alias("point")), "points")
    sizes = {r[target]: r["n"] for r in rows.groupBy(target).agg(F.count(F.lit(1)).alias("n")).collect()}
    largest = max(sizes.values(), default=0)
    out = rows.select(target, "point", F.lit(False).alias("synthetic"))
    for label, n in sizes.items():
        need = largest - n
        if not need or n < 2:
            continue
        own = rows.filter(F.col(target).eqNullSafe(F.lit(label)))
        near = _own_neighbours(own, min(k, n - 1))
        placed = hash_index(own, [], "id", seed, "__place")
        each, extra = divmod(need, n)
        copies = F.lit(each) + F.when(F.col("__place") <= extra, 1).otherwise(0)
        bases = placed.withColumn("__copies", copies).filter("__copies > 0")
        drawn = bases.join(near, "id").select(F.col("id"), F.col("point"), "near", F.explode(F.sequence(F.lit(1), F.col("__copies"))).alias("i"))
        pick = F.pmod(F.xxhash64("id", "i", F.lit(seed)), F.size("near")) + 1
        mate = F.element_at("near", pick.cast("int"))
        u = _unit(F.col("id"), F.col("i"), F.lit(seed + 1))
        made = drawn.withColumn("__u", u).withColumn("__mate", mate).select(
            F.lit(label).cast(df.schema[target].dataType).alias(target),
            F.zip_with("point", "__mate", lambda a, b: a + F.col("__u") * (b - a)).alias("point"),
            F.lit(True).alias("synthetic"),
        )
        out = out.unionByName(made)
    return out.select(target, *[F.col("point")[i].alias(c) for i, c in enumerate(features)], "synthetic")


def _own_neighbours(own: DataFrame, k: int) -> DataFrame:
    """(id, near): the k nearest points of each point."""
    index = cells.build_index(own, corpus_id="id", vector="point")
    pairs = cells.search(index, own.select(F.col("id").alias("q"), "point"), k, "q", "id", "point", exact=True, exclude_self=True)
    with_points = pairs.join(own.select("id", "point"), "id")
    ordered = F.array_sort(F.collect_list(F.struct("rank", "point")))
    return with_points.groupBy(F.col("q").alias("id")).agg(F.transform(ordered, lambda x: x["point"]).alias("near"))
