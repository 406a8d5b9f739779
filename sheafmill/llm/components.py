"""Connected components of a large edge table by alternating star joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheafmill.session import materialise


def _both(edges: DataFrame) -> DataFrame:
    swapped = edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
    return edges.unionByName(swapped).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the least of the node and its neighbours."""
    every = _both(edges)
    least = every.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
    return every.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    least = down.groupBy("a").agg(F.min("b").alias("low"))
    linked = down.join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return linked.unionByName(least.select("a", F.col("low").alias("b"))).filter("a <> b")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node that has an edge to another; the root is its least reachable node.

    `edges` has columns a and b of one type, in any direction, repeats and loops allowed. Every round
    is a written table; a round has no group that has to fit a task, and rounds grow with the
    logarithm of the longest chain.
    """
    now, seen = edges.select("a", "b").filter("a <> b").distinct(), None
    while True:
        now = materialise(_small_star(_large_star(now)).distinct(), "components")
        state = now.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")),
            F.sum(F.xxhash64("b", "a").cast("decimal(20,0)")),
        ).first()
        if tuple(state) == seen:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = tuple(state)
