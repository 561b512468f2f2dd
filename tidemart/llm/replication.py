"""Mixing sources to target weights by Poisson replication, in DataFrame functions only.

A source with mass m and target share w of a total T gets the mean repetition rate w T / m. Each document's
number of copies is Poisson with that mean: a uniform number hashed from the seed and the document's key is
put through the inverse of the distribution, so a re-run or a lost executor draws the same counts. A rate above
`PART_RATE` is the sum of equal parts, each with its own hash, which keeps exp(-rate) far from zero and the
table of the distribution short. Each copy is a row; rows are dealt out and sorted by a hash of seed, key and
copy number, which is a shuffle over all sources that no source can crowd.

Null sources are a source of their own, null keys draw as the empty key, rows with equal keys draw equal
counts, null texts have mass 0. A source whose texts have no mass gets the rate 0, as no number of copies
adds to its share, unless `weights` is None and everything is empty. Empty tables stay empty.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.llm.rows import free_name, quoted
from tidemart.session import materialize

#: Largest mean of one Poisson part, and the longest table of it: beyond 96 the chance is under 1e-30.
PART_RATE = 16.0
TABLE_LENGTH = 96
#: A rate row is about a kilobyte; up to this many are counted and then sent to every executor.
BROADCAST_SOURCES = 10_000
SALTS = 32


def hashed_uniform(*parts: Column) -> Column:
    """A number in (0, 1) from 52 bits of an MD5."""
    digest = F.md5(F.concat_ws(":", *[F.coalesce(part.cast("string"), F.lit("")) for part in parts]))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(1 << 52))


def source_rates(
    docs: DataFrame, weights: Mapping[str, float] | None = None, temperature: float = 2.0, total: float | None = None,
    source: str = "source", size: Column | None = None,
) -> DataFrame:
    """One row per source: `source`, n_docs, mass, weight and rate.

    `weights` are the wanted shares (made to sum to 1; a source that is not named gets 0). Without them a
    source's share goes as its mass to the power 1 / `temperature`. `total` is the wanted mass, by default
    the mass there is; `size` measures a document, by default in characters.
    """
    mass = size if size is not None else F.length("text")
    sums = docs.groupBy(F.col(quoted(source)).alias("source")).agg(
        F.count(F.lit(1)).alias("n_docs"), F.coalesce(F.sum(mass.cast("long")), F.lit(0)).alias("mass")
    )
    if weights is None:
        raw = F.pow(F.col("mass").cast("double"), F.lit(1.0 / temperature))
    else:
        pairs = [part for name, weight in weights.items() for part in (F.lit(name), F.lit(float(weight)))]
        named = F.create_map(*pairs) if pairs else F.create_map().cast("map<string,double>")
        raw = F.coalesce(F.try_element_at(named, F.coalesce(F.col("source").cast("string"), F.lit(""))), F.lit(0.0))
    shares = sums.withColumn("raw", raw)
    whole = shares.agg(F.sum("raw").alias("raw_sum"), F.sum("mass").alias("mass_sum"))
    target = F.lit(float(total)) if total is not None else F.col("mass_sum").cast("double")
    rate = F.when(F.col("mass") > 0, F.col("weight") * target / F.col("mass")).otherwise(F.lit(0.0))
    return (
        shares.join(F.broadcast(whole))  # one row
        .withColumn("weight", F.when(F.col("raw_sum") > 0, F.col("raw") / F.col("raw_sum")).otherwise(F.lit(0.0)))
        .select("source", "n_docs", "mass", "weight", rate.alias("rate"))
    )


def poisson_table(rate: Column) -> Column:
    """Struct of the number of parts and the distribution function of one part at 0, 1, 2, ..."""
    parts = F.greatest(F.ceil(rate / F.lit(PART_RATE)), F.lit(1)).cast("int")
    mean = rate / parts
    first = F.exp(-mean)
    steps = F.aggregate(
        F.sequence(F.lit(1), F.lit(TABLE_LENGTH)),
        F.struct(first.alias("p"), F.array(first).alias("below")),
        lambda acc, k: F.struct(
            (acc["p"] * mean / k).alias("p"),
            F.concat(acc["below"], F.array(F.element_at(acc["below"], -1) + acc["p"] * mean / k)).alias("below"),
        ),
        lambda acc: acc["below"],
    )
    return F.struct(parts.alias("parts"), steps.alias("below"))


def copies(table: Column, seed: int, key: Column) -> Column:
    """Number of copies of one document: the inverse of the distribution at its hashed numbers, summed over the parts."""
    draws = F.transform(F.sequence(F.lit(1), table["parts"]), lambda part: hashed_uniform(F.lit(seed), key, part))
    return F.aggregate(draws, F.lit(0), lambda acc, draw: acc + F.size(F.filter(table["below"], lambda p: p < draw)))


def replicate(docs: DataFrame, rates: DataFrame, seed: int = 0, key: str = "doc_id", source: str = "source", copy: str = "copy") -> DataFrame:
    """Every document as often as drawn, numbered from 1 in `copy` (an input column of that name gives way), in shuffled order."""
    spark = docs.sparkSession
    docs = docs.drop(copy)
    own, drawn, name = free_name(docs.columns, "_table"), free_name(docs.columns, "_drawn"), free_name(docs.columns, "_source")
    salt, place = free_name(docs.columns, "_salt"), free_name(docs.columns, "_place")
    tables = materialize(rates.select(F.col("source").alias(name), poisson_table(F.col("rate")).alias(own)), "rates")
    if tables.count() <= BROADCAST_SOURCES:
        joined = docs.join(F.broadcast(tables), F.col(quoted(source)).eqNullSafe(F.col(name)), "inner")
    else:  # as many rates as a broadcast should not hold: no task gets more than a salt's share of a source
        spread = tables.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        salted = docs.withColumn(salt, F.pmod(F.xxhash64(quoted(key)), F.lit(SALTS)).cast("int"))
        on = F.col(f"l.{quoted(source)}").eqNullSafe(F.col(f"r.{name}")) & (F.col(f"l.{salt}") == F.col(f"r.{salt}"))
        joined = salted.alias("l").join(spread.alias("r"), on, "inner").select(*[F.col(f"l.{quoted(c)}") for c in docs.columns], own)
    counted = joined.withColumn(drawn, copies(F.col(own), seed, F.col(quoted(key)))).filter(F.col(drawn) > 0)
    rows = counted.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(drawn))))
    order = F.md5(F.concat_ws(":", F.lit(seed), F.lit("order"), F.coalesce(F.col(quoted(key)).cast("string"), F.lit("")), F.col(copy)))
    dealt = rows.withColumn(place, order).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), place)
    return dealt.sortWithinPartitions(place, copy).select(*[F.col(quoted(c)) for c in docs.columns], copy)


def mix(docs: DataFrame, weights: Mapping[str, float] | None = None, seed: int = 0, temperature: float = 2.0, total: float | None = None) -> DataFrame:
    """`docs` mixed to the weights: rates over all rows, then the replication."""
    return replicate(docs, source_rates(docs, weights, temperature, total), seed)
