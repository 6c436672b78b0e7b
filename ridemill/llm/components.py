"""Connected components by alternating stars, for links that are never gathered in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import written


def _mark(edges: DataFrame) -> tuple:
    """A count and an order-free sum that stay the same only if the edges do."""
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """node and root of every node of `links` (a, b: longs); root is the least node of the component.

    Each round hangs a node's larger neighbours, then its smaller ones, under the least
    it knows.  Only minima for each node are computed, so a node with very many links
    is combined before the shuffle, and the joins split it.  Null ends and links of a
    node with itself say nothing and are left out; no links give an empty result.
    """
    edges = links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = written(edges, "links")
    before = None
    while (mark := _mark(edges)) != before:
        before = mark
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("low"))
        large = both.where("b > a").join(least, "a").where("b != low").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        own = large.groupBy("a").agg(F.min("b").alias("low"))
        under = large.join(own, "a").where("b != low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        small = own.select("a", F.col("low").alias("b")).unionByName(under)
        edges = written(small.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    roots = edges.groupBy("a").agg(F.min("b").alias("root")).withColumnRenamed("a", "node")
    return roots.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
