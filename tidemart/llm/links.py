"""Connected groups of links by star contraction, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.session import materialize


def _same(left: DataFrame, right: DataFrame) -> bool:
    """Equal sets of rows, by count and sum of hashes."""
    seen = [df.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))).first() for df in (left, right)]
    return seen[0] == seen[1]


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node that `links` (a, b) names; a component is called by its smallest node.

    Every round first hangs a node's larger neighbours to its smallest one, then its smaller ones, so paths
    halve; the rounds end when nothing changes. What a round computes is written, and minima are written
    before they are joined, so that the planner can split a node with very many links.
    """
    edges = materialize(
        links.filter(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"
    )
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = materialize(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low")), "low")
        large = both.filter(F.col("b") > F.col("a")).join(lowest, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = materialize(large.filter(F.col("a") != F.col("b")).distinct(), "large")
        lowest = materialize(large.groupBy("a").agg(F.min("b").alias("low")), "low")
        moved = large.join(lowest, "a").filter(F.col("b") != F.col("low")).select(F.col("b").alias("a"), F.col("low").alias("b"))
        after = materialize(moved.unionByName(lowest.select("a", F.col("low").alias("b"))).distinct(), "links")
        if _same(after, edges):
            roots = after.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            return after.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
        edges = after
