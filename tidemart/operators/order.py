"""Global and per-key order without a single-task sort.

A window over one key (or no key) puts that key's rows in one task. Everything here splits the
order into range partitions ("segments"), works inside each segment, and adds what the earlier
segments of the same key carry in. The segment id is written with the rows, so a re-run task
cannot see other boundaries than the ones the carries were computed for. The carry table has at
most one row per segment, whatever the data size.

Order keys are column names, ascending with nulls last; a leading "-" means descending, nulls last.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemart.session import materialize

SEGMENT = "__segment"
SALTS = 32
SMALL_HEAD = 1000
#: Hex digits of a hash that rows are counted by, and rows with one prefix that are ranked without counting further digits.
PREFIX_DIGITS, CUT_ROWS = 3, 1_000_000
#: Items per level of a quantile sketch; its rank error (99 %) is about a quarter of the slack on each side of a place.
SKETCH_SIZE, SKETCH_SLACK = 4096, 0.0025
#: So many values inside brackets are summed in one window per key, more of them by segments.
INSIDE_ROWS = 2_000_000


def sort_columns(order: Sequence[str]) -> list[Column]:
    return [F.desc_nulls_last(o[1:]) if o.startswith("-") else F.asc_nulls_last(o) for o in order]


def reversed_order(order: Sequence[str]) -> list[Column]:
    return [F.asc_nulls_first(o[1:]) if o.startswith("-") else F.desc_nulls_first(o) for o in order]


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Equi join where a null key matches a null key; the right side's keys are dropped."""
    renamed = right.select([F.col(c).alias(f"__r_{c}") if c in keys else F.col(c) for c in right.columns])
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in keys])
    return left.join(renamed, on, how).drop(*[f"__r_{k}" for k in keys])


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    specs: dict[str, tuple[str, Column]],
    backwards: bool = False,
) -> DataFrame:
    """Running totals per key over the rows up to and including the current one.

    `specs` maps an output column to (kind, input); kind is "sum", "product" or "last" (the last
    non-null value). `order` must be total inside a key. `backwards` runs from the end.
    """
    keys = list(keys)
    sorts = reversed_order(order) if backwards else sort_columns(order)
    inputs = df.withColumns({f"__in_{name}": col for name, (_, col) in specs.items()})
    ranged = inputs.repartitionByRange(*[F.asc_nulls_last(k) for k in keys], *sorts)
    rows = materialize(ranged.withColumn(SEGMENT, F.spark_partition_id()), "segments")

    local = W.partitionBy(*keys, SEGMENT).orderBy(*sorts).rowsBetween(W.unboundedPreceding, 0)
    before = W.partitionBy(*keys).orderBy(SEGMENT).rowsBetween(W.unboundedPreceding, -1)
    totals, locals_, carries, combined = [], {}, {}, {}
    for name, (kind, _) in specs.items():
        value, loc, car = F.col(f"__in_{name}"), F.col(f"__loc_{name}"), F.col(f"__car_{name}")
        if kind == "sum":
            totals.append(F.sum(value).alias(f"__tot_{name}"))
            locals_[f"__loc_{name}"] = F.sum(value).over(local)
            carries[f"__car_{name}"] = F.sum(f"__tot_{name}").over(before)
            combined[name] = F.coalesce(loc, F.lit(0)) + F.coalesce(car, F.lit(0))
        elif kind == "product":
            totals.append(F.product(value).alias(f"__tot_{name}"))
            locals_[f"__loc_{name}"] = F.product(value).over(local)
            carries[f"__car_{name}"] = F.product(f"__tot_{name}").over(before)
            combined[name] = F.coalesce(loc, F.lit(1.0)) * F.coalesce(car, F.lit(1.0))
        elif kind == "last":
            locals_["__place"] = F.row_number().over(local)
            totals.append(F.max_by(f"__loc_{name}", "__place").alias(f"__tot_{name}"))
            locals_[f"__loc_{name}"] = F.last(value, ignorenulls=True).over(local)
            carries[f"__car_{name}"] = F.last(f"__tot_{name}", ignorenulls=True).over(before)
            combined[name] = F.coalesce(loc, car)
        else:
            raise ValueError(f"unknown running kind: {kind}")

    placed = rows.withColumns(locals_)
    summed = placed if "__place" in locals_ else rows
    carry = summed.groupBy(*keys, SEGMENT).agg(*totals).withColumns({**carries, "__prior": F.count(F.lit(1)).over(before)})
    # Segments follow the keys, so only the first key of a segment can continue an earlier one: at most
    # one row per segment is left here, which is what makes the broadcast safe at any data size.
    carry = carry.filter(F.col("__prior") > 0).select(*keys, SEGMENT, *carries)
    out = null_safe_join(placed, F.broadcast(carry), [*keys, SEGMENT]).withColumns(combined)
    return out.select(*[c for c in df.columns if c not in specs], *specs)


def running_index(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str = "idx") -> DataFrame:
    """1-based row number inside each key, as `row_number`, without one task per key."""
    return running(df, keys, order, {out: ("sum", F.lit(1).cast("bigint"))})


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    return head_per_group(df, keys, order, 1)


def head_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int, rank: str | None = None) -> DataFrame:
    """First `n` rows of each group.

    Small `n`: each map task keeps at most n rows per (group, salt) before the shuffle, then n per
    salt, then n per group, so a hot group never reaches one task whole. Large `n`: the exact index.
    """
    number = rank or "__rn"
    if n > SMALL_HEAD:
        out = running_index(df, keys, order, number).filter(F.col(number) <= n)
        return out if rank else out.drop(number)
    sorts = sort_columns(order)
    salt = F.pmod(F.xxhash64(*[F.col(o.lstrip("-")) for o in order]), F.lit(SALTS))
    salted = df.withColumn("__salt", salt)
    near = W.partitionBy(*keys, "__salt").orderBy(*sorts)
    far = W.partitionBy(*keys).orderBy(*sorts)
    out = (
        salted.withColumn("__rn", F.row_number().over(near)).filter(F.col("__rn") <= n).drop("__rn", "__salt")
        .withColumn("__rn", F.row_number().over(far)).filter(F.col("__rn") <= n)
    )
    return out.withColumnRenamed("__rn", rank) if rank else out.drop("__rn")


def hash_order(key: str, seed: int) -> Column:
    """Repeatable random place of a row: the MD5 of its key and a seed, which other engines compute as well."""
    return F.md5(F.concat_ws(":", F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(seed)))


def sample_rows(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """Exactly min(n, rows) rows, the same ones on every run (each task keeps its own top n first)."""
    return df.withColumn("__h", hash_order(key, seed)).orderBy("__h", key).limit(n).drop("__h")


def sample_if_larger(df: DataFrame, key: str, max_rows: int = 8000, seed: int = 42) -> DataFrame:
    return sample_rows(df, key, max_rows, seed)


def _prefix(hashed: str, level: int) -> Column:
    return F.substring(hashed, 1 + level * PREFIX_DIGITS, PREFIX_DIGITS)


def _prefix_counts(hashed: DataFrame, keys: list[str], level: int = 0) -> DataFrame:
    """(keys, __b, __c, __upto): rows of each prefix of the hash and of all up to it, at most 16 ** PREFIX_DIGITS rows per key."""
    counts = hashed.groupBy(*keys, _prefix("__h", level).alias("__b")).agg(F.count(F.lit(1)).alias("__c"))
    return counts.withColumn("__upto", F.sum("__c").over(W.partitionBy(*keys).orderBy("__b").rowsBetween(W.unboundedPreceding, 0)))


def hash_cuts(df: DataFrame, keys: Sequence[str], key: str, wants: DataFrame, seed: int = 42) -> DataFrame:
    """(keys, __want, __cut, __tied): the last (hash, key) of the first `__want` rows of every group in hash order.

    `wants` has the keys and `__want`. A histogram of the first digits of the hash finds the prefix that the cut lies in; while that holds many rows
    the next digits are counted inside it; then only its rows are ranked. The cut is null where all rows (or none) are wanted; `__tied`
    says that further rows equal it, which takes a repeated key.
    """
    keys = list(keys)
    hashed = df.select(*keys, F.col(key).alias("__k"), hash_order(key, seed).alias("__h"))
    wanted, level = wants.select(*keys, "__want", F.col("__want").alias("__left")), 0
    while True:
        counts = _prefix_counts(hashed, keys, level)
        met = null_safe_join(counts, wanted, keys, "inner") if keys else counts.crossJoin(F.broadcast(wanted))
        before = F.col("__upto") - F.col("__c")
        here = met.filter((before < F.col("__left")) & (F.col("__left") <= F.col("__upto")))
        here = materialize(here.select(*keys, "__want", "__b", "__c", (F.col("__left") - before).alias("__left")), "prefixes")
        # the rows whose prefix is the one that the cut lies in
        renamed = hashed.withColumn("__b", _prefix("__h", level))
        hashed = null_safe_join(renamed, here.select(*keys, "__b"), [*keys, "__b"], "inner").drop("__b")
        wanted, level = here.select(*keys, "__want", "__left"), level + 1
        if level * PREFIX_DIGITS >= 30 or not here.filter(F.col("__c") > CUT_ROWS).limit(1).count():
            break
    order = W.partitionBy(*keys).orderBy("__h", F.asc_nulls_last("__k"))
    ranked = hashed.withColumns({"__place": F.row_number().over(order), "__next": F.lead(F.struct("__h", "__k")).over(order)})
    met = null_safe_join(ranked, wanted, keys, "inner") if keys else ranked.crossJoin(F.broadcast(wanted))
    cut = F.struct("__h", "__k")
    found = met.filter(F.col("__place") == F.col("__left")).select(*keys, cut.alias("__cut"), F.coalesce(F.col("__next") == cut, F.lit(False)).alias("__tied"))
    if keys:
        return materialize(null_safe_join(wants.select(*keys, "__want"), found, keys), "cuts")
    return materialize(wants.select("__want").join(F.broadcast(found), F.lit(True), "left"), "cuts")


def first_by_hash(df: DataFrame, keys: Sequence[str], key: str, wants: DataFrame, seed: int = 42, out: str = "__first") -> DataFrame:
    """`df` with a flag on the first `__want` rows of every group in the order of `hash_order(key, seed)`, which a filter on the hash decides.

    Groups that `wants` does not name have no such rows. `key` is unique; where it is not and equal rows stand on both sides of a cut, all rows are ranked.
    """
    keys = list(keys)
    cuts = hash_cuts(df, keys, key, wants, seed)
    if cuts.filter("__tied").limit(1).count():
        placed = hash_index(df, keys, key, seed, "__place")
        named = cuts.select(*keys, "__want")
        met = null_safe_join(placed, named, keys) if keys else placed.crossJoin(F.broadcast(named))
        return met.withColumn(out, F.coalesce(F.col("__place") <= F.col("__want"), F.lit(False))).drop("__place", "__want")
    sizes = cuts.drop("__tied")
    met = null_safe_join(df, sizes, keys) if keys else df.crossJoin(F.broadcast(sizes))
    kept = F.struct(hash_order(key, seed), F.col(key)) <= F.col("__cut")
    flag = F.when(F.coalesce(F.col("__want"), F.lit(0)) <= 0, False).when(F.col("__cut").isNull(), True).otherwise(kept)
    return met.withColumn(out, flag).drop("__want", "__cut")


def hash_index(df: DataFrame, keys: Sequence[str], key: str, seed: int = 42, out: str = "idx") -> DataFrame:
    """1-based place of each row of a group in the order of `hash_order(key, seed)`.

    Rows are ranked inside a prefix of the hash and the rows of earlier prefixes are added, so no task holds a group and nothing is sampled or copied.
    """
    keys = list(keys)
    hashed = df.withColumn("__h", hash_order(key, seed))
    before = _prefix_counts(hashed.select(*keys, "__h"), keys).select(*keys, "__b", (F.col("__upto") - F.col("__c")).alias("__before"))
    own = F.row_number().over(W.partitionBy(*keys, "__b").orderBy("__h", F.asc_nulls_last(key)))
    placed = hashed.withColumn("__b", _prefix("__h", 0)).withColumn("__own", own)
    met = null_safe_join(placed, before, [*keys, "__b"], "inner")
    return met.withColumn(out, F.col("__before") + F.col("__own")).drop("__h", "__b", "__own", "__before")


def sample_share_per_group(df: DataFrame, group: str, key: str, sample_size: int = 10000, seed: int = 42) -> DataFrame:
    """Stratified sample: round(min(sample_size / all rows, 1) * group rows) rows of each group.

    Rounds half to even; null groups are dropped from the result but count as rows.
    """
    total = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    named = df.filter(F.col(group).isNotNull())
    share = F.least(F.try_divide(F.lit(float(sample_size)), total), F.lit(1.0))
    wants = named.groupBy(group).agg(F.bround(share * F.count(F.lit(1))).cast("bigint").alias("__want"))
    return first_by_hash(named, [group], key, wants, seed).filter("__first").drop("__first")


def quantiles(df: DataFrame, keys: Sequence[str], value: str, probs: dict[str, float], approximate: bool = False) -> DataFrame:
    """Linear-interpolated quantiles per key: one row per key, one column per entry of `probs`.

    The exact form brackets each place with a mergeable sketch and ranks only the values inside the brackets, so rows are neither
    sorted nor shuffled (the built-in `percentile` keeps every distinct value of a group in one buffer).
    """
    keys = list(keys)
    number = F.col(value).cast("double")  # NaN is missing
    present = df.select(*keys, F.when(~F.isnan(number), number).alias("__v")).filter(F.col("__v").isNotNull())
    if approximate:
        return present.groupBy(*keys).agg(*[F.percentile_approx("__v", p, 10000).alias(name) for name, p in probs.items()])
    picked = _picked(_bracketed(present, keys, list(probs.values())), keys, probs, "__n")
    if keys:
        # A bracket that missed its place is found in a count of all values of that key.
        picked = materialize(picked, "quantiles")
        missed = picked.filter("__missed").select(*keys)
        if missed.limit(1).count():
            again = _picked(_counted(null_safe_join(present, missed, keys, "inner"), keys), keys, probs, "__n")
            picked = picked.filter("not __missed").unionByName(again)
    elif picked.filter("__missed").count():
        picked = _picked(_counted(present, keys), keys, probs, "__n")
    return picked.drop("__missed")


def _bracketed(present: DataFrame, keys: list[str], probs: list[float]) -> DataFrame:
    """Counts in order of value, where only values near a wanted place stand by themselves and what lies between them is one row.

    A sketch brackets each place in one pass without a shuffle of rows. In a second pass a row outside all brackets is known by
    the number of brackets below it; rows with the same number that are inside one come after those that are not.
    """
    sketch = F.kll_sketch_agg_double("__v", F.lit(SKETCH_SIZE))
    facts = present.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), sketch.alias("__sketch"))
    # the sketch of a small group holds all of it, and there all values stand by themselves
    whole = F.col("__n") <= SKETCH_SIZE
    sides = []
    for name, sign in (("__lo", -1), ("__hi", 1)):
        ranks = F.array(*[F.lit(min(max(p + sign * SKETCH_SLACK, 0.0), 1.0)) for p in probs])
        end = F.array(*[F.lit(sign * float("inf")) for _ in probs])
        sides.append(F.when(whole, end).otherwise(F.kll_sketch_get_quantile_double("__sketch", ranks)).alias(name))
    brackets = materialize(facts.filter("__n > 0").select(*keys, "__n", *sides), "brackets")
    if keys:
        placed = null_safe_join(present, brackets, keys, "inner")
    else:
        placed = present.withColumns({name: brackets.select(name).scalar() for name in ("__n", "__lo", "__hi")})
    lower, inside = F.lit(0), F.lit(False)
    for k in range(len(probs)):
        lower = lower + (F.col("__hi")[k] < F.col("__v")).cast("int")
        inside = inside | ((F.col("__lo")[k] <= F.col("__v")) & (F.col("__v") <= F.col("__hi")[k]))
    counts = placed.groupBy(*keys, lower.alias("__below"), F.when(inside, F.col("__v")).alias("__v")).agg(F.count(F.lit(1)).alias("__c"), F.first("__n").alias("__n"))
    counts = materialize(counts, "counts")
    place = F.struct("__below", F.col("__v").isNotNull().alias("known"), "__v")
    if counts.count() > INSIDE_ROWS:
        return running(counts.withColumn("__place", place), keys, ["__place"], {"__cum": ("sum", F.col("__c"))})
    upto = W.partitionBy(*keys).orderBy(place).rowsBetween(W.unboundedPreceding, 0)
    return counts.withColumn("__cum", F.sum("__c").over(upto))


def _counted(present: DataFrame, keys: list[str]) -> DataFrame:
    """Counts of all distinct values in order."""
    counts = present.groupBy(*keys, "__v").agg(F.count(F.lit(1)).alias("__c"))
    cum = running(counts, keys, ["__v"], {"__cum": ("sum", F.col("__c"))})
    size = cum.groupBy(*keys).agg(F.max("__cum").alias("__n"))
    return null_safe_join(cum, size, keys, "inner") if keys else cum.withColumn("__n", size.scalar())


def _picked(cum: DataFrame, keys: list[str], probs: dict[str, float], size: str) -> DataFrame:
    """One row per key: the quantiles, and whether one of them lies where values are not known one by one."""
    picks, missed = [], F.lit(False)
    for name, p in probs.items():
        place = (F.col(size) - 1) * F.lit(float(p))
        for side, index in (("lo", F.floor(place)), ("hi", F.ceil(place))):
            here = (F.col("__cum") - F.col("__c") <= index) & (index < F.col("__cum"))
            picks.append(F.max(F.when(here, F.col("__v"))).alias(f"__{side}_{name}"))
            missed = missed | (here & F.col("__v").isNull())
        picks.append(F.max(place - F.floor(place)).alias(f"__w_{name}"))
    between = lambda low, high, weight: F.when(low == high, low).otherwise(low + (high - low) * weight)
    picked = cum.groupBy(*keys).agg(*picks, F.coalesce(F.bool_or(missed), F.lit(False)).alias("__missed"))
    return picked.select(
        *keys,
        *[between(F.col(f"__lo_{n}"), F.col(f"__hi_{n}"), F.col(f"__w_{n}")).alias(n) for n in probs],
        "__missed",
    )


def value_ranks(df: DataFrame, value: str, weight: str | None = None) -> DataFrame:
    """One row per distinct value: `value`, `n` (ties) and `avg_rank` among all rows that have one (NaN is missing).

    `weight` is a column of row counts when the rows are already grouped.
    """
    size = F.sum(weight) if weight else F.count(F.lit(1))
    missing = F.coalesce(F.isnan(F.col(value).try_cast("double")), F.lit(False)) | F.col(value).isNull()
    counts = df.filter(~missing).groupBy(F.col(value).alias("value")).agg(size.alias("n"))
    cum = running(counts, [], ["value"], {"cum": ("sum", F.col("n"))})
    return cum.select("value", "n", (F.col("cum") - (F.col("n") - 1) / 2.0).alias("avg_rank"))
