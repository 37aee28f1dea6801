"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of edges (a, b) but the roots; a root is the
    least node of its component.

    Each round is two aggregations and joins over the edges, written to the
    shared folder; a node with very many edges is reduced map-side.  Rounds go on
    until the edges no longer change, a number that grows with the logarithm of
    the longest path."""
    now = written(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                  .distinct(), "edges")
    state = _state(now)
    while True:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # Large star: a node's greater neighbours move to its least one.
        large = (both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        large = written(large, "edges")
        # Small star: a node's lesser neighbours move to the least of them.
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(small, "u")
        now = written(moved.select("u", F.col("m").alias("v")).union(moved.select(F.col("v").alias("u"), F.col("m").alias("v")))
                      .where("u <> v").distinct(), "edges")
        before, state = state, _state(now)
        if state == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _state(edges: DataFrame) -> tuple:
    """Row count and an order-free sum of row hashes."""
    h = F.xxhash64("u", "v").cast("decimal(38,0)")
    return tuple(edges.agg(F.count("*"), F.sum(h)).first())
