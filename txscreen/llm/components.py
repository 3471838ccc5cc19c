"""Connected components of a distributed graph by alternating large-star and small-star steps.

Each round is a minimum for each node and a join on the node; both shuffle on node ids and the
minima are combined before the shuffle. The rounds end when the edges have become stars around the
smallest node of each component, which takes a number of rounds about logarithmic in the size of the
largest component. Every round is written to the shared checkpoint folder, so a lost executor costs
one round at most; nothing but two sums leaves the executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settle


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """edges: a > b."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where(F.col("b") > F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def _mark(edges: DataFrame) -> tuple:
    hashed = F.xxhash64("a", "b")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(hashed.bitwiseAND(F.lit((1 << 30) - 1))), F.sum(F.shiftright(hashed, 34).cast("long"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for each node that has an edge to another; component is the smallest node reachable.

    edges: (a, b), long; directions, repeats and loops don't matter, null ends are no edges.
    """
    e = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
    e = settle(e.distinct())
    mark = _mark(e)
    while mark[0]:
        e = settle(_small_star(_large_star(e)))
        mark, last = _mark(e), mark
        if mark == last:
            break
    # stars: each a has one b, the centre
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).union(e.select("b", "b").distinct())
