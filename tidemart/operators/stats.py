"""Correlation and hypothesis tests. Each reduces to a tiny aggregate on Spark; the p-value is a
function of that aggregate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import WindowSpec

from tidemart.functions.numeric import clamp, guarded_corr, present, safe_ratio
from tidemart.functions.tails import chi_square_p_value, correlation_p_value
from tidemart.operators.order import value_ranks
from tidemart.session import materialize


def windowed_corr(x: Column, y: Column, frame: WindowSpec) -> tuple[Column, Column]:
    """(r, pairs) over a window frame, null instead of an error for a constant side."""
    both = present(x).isNotNull() & present(y).isNotNull()
    a, b = F.when(both, x.cast("double")), F.when(both, y.cast("double"))
    spread = F.sqrt(F.var_pop(a).over(frame)) * F.sqrt(F.var_pop(b).over(frame))
    return F.try_divide(F.covar_pop(a, b).over(frame), F.nullif(spread, F.lit(0.0))), F.count(F.when(both, 1)).over(frame)


def _judged(df: DataFrame, alpha: float, with_n: bool = True) -> DataFrame:
    """(r, n) rows to correlation, p_value, significant, n_samples; below 3 pairs (0, 1, false, 0)."""
    enough = F.col("n") >= 3
    p = correlation_p_value(F.col("r"), F.col("n"))
    judged = df.withColumn("p_value", F.when(enough, p).otherwise(1.0)).withColumns(
        {
            "correlation": F.when(enough, F.col("r")).otherwise(0.0),
            "significant": F.coalesce(F.col("p_value") < alpha, F.lit(False)),
            "n_samples": F.when(enough, F.col("n")).otherwise(F.lit(0)),
        }
    )
    kept = [c for c in df.columns if c not in ("r", "n")] + ["correlation", "p_value", "significant"]
    return judged.select(*kept, *(["n_samples"] if with_n else []))


def pearson(df: DataFrame, x: str, y: str, alpha: float = 0.05, keys: Sequence[str] = ()) -> DataFrame:
    r, n = guarded_corr(F.col(x), F.col(y))
    return _judged(df.groupBy(*keys).agg(r.alias("r"), n.alias("n")), alpha)


def spearman(df: DataFrame, x: str, y: str, alpha: float = 0.05) -> DataFrame:
    """Pearson on average ranks. Equal pairs are counted first; ranks come from the value counts."""
    pairs = (
        df.filter(present(F.col(x)).isNotNull() & present(F.col(y)).isNotNull())
        .groupBy(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
        .agg(F.count(F.lit(1)).alias("w"))
    )
    ranked = pairs = materialize(pairs, "pairs")
    for side in ("x", "y"):
        ranks = value_ranks(pairs, side, "w").select(F.col("value").alias(side), F.col("avg_rank").alias(f"rank_{side}"))
        ranked = ranked.join(ranks, side)
    # Ranks are centred before squaring: their mean is (n + 1) / 2.
    n = pairs.agg(F.coalesce(F.sum("w"), F.lit(0))).scalar()
    a, b, w = F.col("rank_x") - (n + 1) / 2.0, F.col("rank_y") - (n + 1) / 2.0, F.col("w")
    sums = ranked.agg(F.sum(w * a * b).alias("ab"), F.sum(w * a * a).alias("aa"), F.sum(w * b * b).alias("bb"), F.coalesce(F.sum(w), F.lit(0)).alias("n"))
    spread = F.sqrt(F.col("aa")) * F.sqrt(F.col("bb"))
    r = clamp(F.try_divide(F.col("ab"), F.nullif(spread, F.lit(0.0))))
    return _judged(sums.select(r.alias("r"), "n"), alpha, with_n=False)


def lagged(leads: DataFrame, x: str, max_lag: int = 5, alpha: float = 0.05) -> DataFrame:
    """x against y_0 ... y_max (see `series.with_leads`): one row per lag from one aggregate."""
    aggs = []
    for k in range(max_lag + 1):
        r, n = guarded_corr(F.col(x), F.col(f"y_{k}"))
        aggs += [r.alias(f"r_{k}"), n.alias(f"n_{k}")]
    one = leads.agg(*aggs)
    cells = [F.struct(F.lit(k).alias("lag"), F.col(f"r_{k}").alias("r"), F.col(f"n_{k}").alias("n")) for k in range(max_lag + 1)]
    return _judged(one.select(F.inline(F.array(*cells))), alpha)


def is_significant(r: Column, n: Column, alpha: float = 0.05) -> Column:
    """|t| beyond the two-sided critical value, which is p < alpha; false below 3 pairs."""
    return F.coalesce((n >= 3) & (correlation_p_value(r, n) < alpha), F.lit(False))


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def target_correlations(df: DataFrame, target: str, exclude: Sequence[str] = ()) -> DataFrame:
    """Every numeric column against the target, by |r|, from one aggregate; constant columns last (null)."""
    features = [c for c in numeric_columns(df) if c != target and c not in exclude] if target in df.columns else []
    if not features:
        return df.sparkSession.createDataFrame([], "feature string, corr double, abs_corr double")
    one = df.agg(*[guarded_corr(F.col(c), F.col(target))[0].alias(c) for c in features])
    cells = [F.struct(F.lit(c).alias("feature"), F.col(c).alias("corr"), F.abs(c).alias("abs_corr")) for c in features]
    return one.select(F.inline(F.array(*cells))).orderBy(F.desc_nulls_last("abs_corr"), "feature")


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pairwise-complete correlations, one row per column, from one aggregate."""
    present = [c for c in columns if c in numeric_columns(df)]
    pairs = [(i, j) for i in range(len(present)) for j in range(i, len(present))]
    one = df.agg(*[guarded_corr(F.col(present[i]), F.col(present[j]))[0].alias(f"r_{i}_{j}") for i, j in pairs])
    rows = [
        F.struct(F.lit(c).alias("column"), *[F.col(f"r_{min(i, j)}_{max(i, j)}").alias(present[j]) for j in range(len(present))])
        for i, c in enumerate(present)
    ]
    return one.select(F.inline(F.array(*rows)))


def frequent_groups(df: DataFrame, group: str, min_obs: int) -> DataFrame:
    """Rows of the groups (null excluded) that have at least `min_obs` rows."""
    keep = df.filter(F.col(group).isNotNull()).groupBy(group).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_obs)
    return df.join(keep.select(group), group, "left_semi")


def segment_kpis(
    df: DataFrame, group: str, min_obs: int = 500, policy: str = "PolicyID", month: str = "TransactionMonth",
    premium: str = "TotalPremium", claims: str = "TotalClaims", flag: str = "claim_flag", margin: str = "margin",
) -> DataFrame:
    """Risk and profit metrics per segment, sparse segments left out, worst loss ratio first.

    Policies are counted after one row per (segment, policy) is summed, so a hot segment spreads over
    its policies.
    """
    per_policy = df.filter(F.col(group).isNotNull()).groupBy(group, policy).agg(
        F.count(F.lit(1)).alias("rows"), F.count(month).alias("months"), F.sum(premium).alias("premium"), F.sum(claims).alias("claims"),
        F.sum(F.col(flag).cast("double")).alias("flags"), F.count(flag).alias("flag_n"), F.sum(margin).alias("margin"), F.count(margin).alias("margin_n"),
    )
    zero = lambda c: F.coalesce(F.sum(c), F.lit(0.0))
    out = per_policy.groupBy(group).agg(
        F.sum("rows").alias("rows"), F.count(policy).alias("policies"), F.sum("months").alias("exposure_months"), zero("premium").alias("premium_sum"),
        zero("claims").alias("claims_sum"), zero("flags").alias("claimants"),
        F.try_divide(F.sum("flags"), F.sum("flag_n")).alias("claim_rate"), F.try_divide(F.sum("margin"), F.sum("margin_n")).alias("margin_mean"),
    )
    out = out.filter(F.col("rows") >= min_obs).drop("rows").withColumns(
        {
            "severity": safe_ratio(F.col("claims_sum"), F.col("claimants")),
            "loss_ratio": safe_ratio(F.col("claims_sum"), F.col("premium_sum")),
        }
    )
    return out.orderBy(F.desc_nulls_last("loss_ratio"), group)


def chi_square(df: DataFrame, group: str, flag: str = "claim_flag", min_obs: int = 500) -> DataFrame:
    """Chi-square of the flag's frequency across groups, as stat, p_value, dof, groups.

    Only filled cells are stored. A cell without rows adds its expected count, and the expected counts
    of all cells add up to n. With one degree of freedom (2 x 2) the Yates correction applies: every
    cell then has the same |o - e|, so the statistic follows from one cell and the margins.
    """
    counted = df.filter(F.col(group).isNotNull() & F.col(flag).isNotNull()).groupBy(F.col(group).alias("k"), F.col(flag).alias("f")).agg(F.count(F.lit(1)).alias("o"))
    cells = materialize(counted, "cells")
    groups = cells.groupBy("k").agg(F.sum("o").alias("g")).filter(F.col("g") >= min_obs)
    kept = cells.join(groups, "k")
    flags = kept.groupBy("f").agg(F.sum("o").alias("m"))
    n = groups.agg(F.sum("g")).scalar()
    side = lambda frame, margin: frame.agg(F.count(F.lit(1)).alias("levels"), F.sum(1 / F.col(margin)).alias("inverse")).select(F.struct("*")).scalar()
    rows, columns = side(groups, "g"), side(flags, "m")
    e = F.col("g") * F.col("m") / n
    sums = kept.join(flags, "f").agg(
        F.coalesce(F.sum((F.col("o") - e) * (F.col("o") - e) / e), F.lit(0.0)).alias("filled"),
        F.coalesce(F.sum(e), F.lit(0.0)).alias("expected"),
        F.count(F.lit(1)).alias("cells"),
        F.max(F.abs(F.col("o") - e)).alias("gap"),
    )
    sums = sums.withColumns({"n": n, "groups": rows["levels"], "columns": columns["levels"], "inverse": rows["inverse"] * columns["inverse"]})
    dof = (F.col("groups") - 1) * (F.col("columns") - 1)
    near = F.greatest(F.col("gap") - 0.5, F.lit(0.0))
    empty = F.when(F.col("cells") < F.col("groups") * F.col("columns"), F.col("n") - F.col("expected")).otherwise(0.0)
    stat = F.when(dof == 1, near * near * F.col("n") * F.col("inverse")).otherwise(F.col("filled") + empty)
    out = sums.select(stat.alias("stat"), dof.alias("dof"), "groups")
    return out.select("stat", F.when(F.col("dof") == 0, 1.0).otherwise(chi_square_p_value("stat", "dof")).alias("p_value"), "dof", "groups")


def kruskal(df: DataFrame, group: str, value: str, min_obs: int = 500) -> DataFrame:
    """Kruskal-Wallis H with tie correction, as stat, p_value, groups; null with fewer than two groups."""
    counted = df.filter(F.col(group).isNotNull() & F.col(value).isNotNull()).groupBy(F.col(group).alias("k"), F.col(value).cast("double").alias("v")).agg(F.count(F.lit(1)).alias("c"))
    cells = materialize(counted, "cells")
    sizes = cells.groupBy("k").agg(F.sum("c").alias("g")).filter(F.col("g") >= min_obs)
    kept = cells.join(sizes, "k")
    ranks = value_ranks(kept, "v", "c")
    n = sizes.agg(F.sum("g")).scalar().cast("double")
    per_group = kept.join(ranks, kept["v"] == ranks["value"]).groupBy("k", "g").agg((F.sum(F.col("c") * F.col("avg_rank")) / F.col("g")).alias("mean_rank"))
    ties = ranks.agg(F.sum(F.pow(F.col("n").cast("double"), 3) - F.col("n"))).scalar()
    off = F.col("mean_rank") - (n + 1) / 2
    raw = per_group.agg(F.sum(F.col("g") * off * off).alias("between"), F.count(F.lit(1)).alias("groups"))
    h = F.col("between") * 12 / (n * (n + 1))
    stat = F.when(F.col("groups") >= 2, F.try_divide(h, F.nullif(1 - ties / (n * n * n - n), F.lit(0.0))))
    out = raw.select(stat.alias("stat"), "groups")
    return out.select("stat", chi_square_p_value(F.col("stat"), F.col("groups") - 1).alias("p_value"), "groups")


def test_row(result: DataFrame, name: str, alpha: float = 0.05) -> DataFrame:
    """One tidy decision row of a test result."""
    decision = F.when(F.col("p_value") < alpha, "Reject H0").otherwise("Fail to reject H0")
    return result.select(
        F.lit(name).alias("test"), F.col("stat").alias("statistic"), "p_value", F.col("groups").alias("groups_tested"),
        F.lit(alpha).alias("alpha"), decision.alias("decision"),
    )
