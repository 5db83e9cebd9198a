"""Connected components of a large graph by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.session import at_rest


def components(edges: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """node, component (the smallest node reachable) for every node of an edge.

    Each step is written to the shared folder, so that a lost executor costs one step at most. A node's smallest
    neighbour is found by an aggregate that merges before the shuffle.
    """
    pairs = edges.select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v")).where("u <> v").distinct()
    pairs = at_rest(pairs, "star")
    state = None
    while True:
        pairs = at_rest(_small_star(at_rest(_large_star(pairs), "large-star")), "star")
        now = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).union(pairs.select("v", "v")).groupBy("node").agg(F.min("component").alias("component"))
        state = now


def _least(ways: DataFrame) -> DataFrame:
    return ways.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))


def _large_star(pairs: DataFrame) -> DataFrame:
    both = pairs.union(pairs.select(F.col("v"), F.col("u")))
    linked = both.join(_least(both), "u").where("v > u")
    return linked.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(pairs: DataFrame) -> DataFrame:
    linked = pairs.join(_least(pairs), "u")
    moved = linked.select(F.col("v").alias("u"), F.col("m").alias("v")).union(linked.select("u", F.col("m").alias("v")))
    return moved.where("u <> v").distinct()
