"""The data behind the charts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.functions.numeric import number
from tidemart.operators.order import null_safe_join, quantiles, running
from tidemart.operators.profile import frequencies


def histogram(df: DataFrame, column: str, bins: int = 20) -> DataFrame:
    """Equal-width bins over the numeric values, empty bins included; no rows when there is no number."""
    values = df.select(number(F.col(column)).alias("v")).filter("v is not null")
    low, high = F.min("v"), F.max("v")
    edges = values.agg(
        F.when(low == high, low - 0.5).otherwise(low).alias("low"),
        F.when(low == high, high + 0.5).otherwise(high).alias("high"),
    ).select(F.struct("low", "high"))
    edge = edges.scalar()
    place = F.floor((F.col("v") - edge["low"]) / ((edge["high"] - edge["low"]) / bins))
    counts = values.groupBy(F.least(place, F.lit(bins - 1)).alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    width = (edge["high"] - edge["low"]) / bins
    all_bins = df.sparkSession.range(bins).withColumnRenamed("id", "bin")
    return (
        all_bins.join(counts, "bin", "left")
        .select("bin", (edge["low"] + width * F.col("bin")).alias("lower"), (edge["low"] + width * (F.col("bin") + 1)).alias("upper"), F.coalesce("count", F.lit(0)).alias("count"))
        .filter(F.col("lower").isNotNull())
    )


def mean_by(df: DataFrame, x: str, y: str) -> DataFrame:
    """Bar / line heights: mean of y per x, in x order."""
    return df.filter(F.col(x).isNotNull()).groupBy(x).agg(F.avg(y).alias("mean")).orderBy(x)


def shares(df: DataFrame, column: str) -> DataFrame:
    return frequencies(df, column)


def box_statistics(df: DataFrame, y: str, x: str | None = None, whisker: float = 1.5) -> DataFrame:
    """Quartiles, whiskers (the extreme values inside the fences) and outlier count, per x if given."""
    keys = [x] if x else []
    rows = df.filter(F.col(x).isNotNull()) if x else df
    box = quantiles(rows, keys, y, {"q1": 0.25, "median": 0.5, "q3": 0.75})
    values = rows.select(*keys, F.col(y).cast("double").alias("v")).filter("v is not null")
    if keys:
        joined = null_safe_join(values, box, keys, "inner")
    else:
        one = box.select(F.struct("q1", "median", "q3")).scalar()
        joined = values.withColumns({c: one[c] for c in ("q1", "median", "q3")})
    reach = (F.col("q3") - F.col("q1")) * whisker
    inside = F.col("v").between(F.col("q1") - reach, F.col("q3") + reach)
    return joined.groupBy(*keys).agg(
        F.first("q1").alias("q1"), F.first("median").alias("median"), F.first("q3").alias("q3"),
        F.min(F.when(inside, F.col("v"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("v"))).alias("whisker_high"),
        F.count_if(~inside).alias("outliers"),
    )


def density_by_class(df: DataFrame, x: str, class_col: str, bw_adjust: float = 1.0, grid: int = 200, cut: float = 3.0, bins: int = 2048) -> DataFrame:
    """Gaussian kernel density of x per class on `grid` points.

    Scott's bandwidth. Values are counted in `bins` narrow bins per class first, so the kernel work is
    bins x grid per class whatever the number of rows.
    """
    rows = df.select(F.col(class_col).alias("cls"), number(F.col(x)).alias("v")).filter("cls is not null and v is not null")
    stats = rows.groupBy("cls").agg(
        F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"), F.stddev_samp("v").alias("sd")
    )
    stats = stats.filter("sd > 0").withColumn("bw", F.col("sd") * F.pow(F.col("n").cast("double"), F.lit(-0.2)) * bw_adjust)
    step = (F.col("hi") - F.col("lo")) / bins
    binned = (
        rows.join(stats.select("cls", "lo", "hi"), "cls")
        .groupBy("cls", F.least(F.floor((F.col("v") - F.col("lo")) / step), F.lit(bins - 1)).alias("bin"))
        .agg(F.count(F.lit(1)).alias("c"))
    )
    points = binned.join(stats, "cls").withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(grid - 1))))
    start = F.col("lo") - F.col("bw") * cut
    position = start + (F.col("hi") - F.col("lo") + F.col("bw") * 2 * cut) * F.col("point") / (grid - 1)
    z = (position - (F.col("lo") + (F.col("bin") + 0.5) * step)) / F.col("bw")
    kernel = F.exp(-z * z / 2) / F.sqrt(F.lit(2.0) * F.pi())
    return (
        points.select("cls", "point", position.alias("x"), (F.col("c") * kernel / (F.col("n") * F.col("bw"))).alias("d"))
        .groupBy(F.col("cls").alias(class_col), "point")
        .agg(F.max("x").alias("x"), F.sum("d").alias("density"))
    )


def score_counts(df: DataFrame, label: str, score: str) -> DataFrame:
    """Positives and negatives per distinct score; labels are 0 / 1."""
    rows = df.filter(F.col(label).isNotNull() & F.col(score).isNotNull())
    return rows.groupBy(F.col(score).cast("double").alias("threshold")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg")
    )


def roc_points(df: DataFrame, label: str, score: str) -> DataFrame:
    """threshold, fpr, tpr at every distinct score from the highest down, plus the (0, 0) start (null threshold)."""
    counts = score_counts(df, label, score)
    cum = running(counts, [], ["-threshold"], {"tp": ("sum", F.col("pos")), "fp": ("sum", F.col("neg"))})
    total = cum.agg(F.max("tp").alias("p"), F.max("fp").alias("n")).select(F.struct("p", "n")).scalar()
    points = cum.select("threshold", F.try_divide(F.col("fp").cast("double"), total["n"]).alias("fpr"), F.try_divide(F.col("tp").cast("double"), total["p"]).alias("tpr"))
    start = df.sparkSession.range(1).select(F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return start.unionByName(points)


def roc_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """One row, `roc_auc`: exact area with ties counted half; null with one class only."""
    counts = score_counts(df, label, score)
    cum = running(counts, [], ["-threshold"], {"tp": ("sum", F.col("pos"))})
    area = F.sum(F.col("neg") * (F.col("tp") - F.col("pos") / 2.0))
    return cum.agg(F.try_divide(area, (F.sum("pos") * F.sum("neg")).cast("double")).alias("roc_auc"))


def confusion_matrix(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Count of every (label, prediction) pair of the classes seen, zeros included."""
    counts = df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(F.count(F.lit(1)).alias("n"))
    seen = counts.filter("label is not null and prediction is not null").select(
        F.explode(F.array(F.col("label").cast("string"), F.col("prediction").cast("string"))).alias("c")
    )
    classes = seen.agg(F.array_sort(F.collect_set("c"))).scalar()
    grid = df.sparkSession.range(1).select(F.explode(classes).alias("label")).select("label", F.explode(classes).alias("prediction"))
    cells = counts.select(F.col("label").cast("string").alias("label"), F.col("prediction").cast("string").alias("prediction"), "n")
    return grid.join(cells, ["label", "prediction"], "left").select("label", "prediction", F.coalesce("n", F.lit(0)).alias("count"))
