"""Connected components by alternating large and small stars, on tables only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common


def components(edges: DataFrame) -> DataFrame:
    """(node, comp) for each node of ``edges`` (a, b): comp is the smallest node that it reaches.

    In a large star every node sends its larger neighbours to the least of its neighbours and itself; in a small star
    its smaller ones. Both keep connectivity; their number of rounds grows with the logarithm of the nodes. A hub's
    neighbours are never gathered: its least neighbour is an aggregate, joined back to its edges.
    """
    now = common.materialise(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct(), "star")
    while True:
        both = now.union(now.select("b", "a")).toDF("u", "v")
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("m").alias("a"), F.col("v").alias("b"))
        old, large = now, common.materialise(large.where("a < b").distinct(), "star")
        common.discard(old)
        # every edge now points from a smaller a to a larger b
        first = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(first, "b").select(F.col("m").alias("x"), F.explode(F.array("a", "b")).alias("y")).where("x < y")
        now = common.materialise(small.select(F.col("x").alias("a"), F.col("y").alias("b")).distinct(), "star")
        common.discard(large)
        # done when only stars are left: no node has two smaller neighbours, or a smaller and a larger one
        ends = now.select(F.col("a").alias("node"), F.lit(0).alias("below")).unionByName(now.select(F.col("b").alias("node"), F.lit(1).alias("below")))
        if ends.groupBy("node").agg(F.sum("below").alias("n"), F.min("below").alias("least")).where("n > 1 OR n = 1 AND least = 0").isEmpty():
            break
    return now.select(F.col("b").alias("node"), F.col("a").alias("comp")).unionByName(now.select(F.col("a").alias("node"), F.col("a").alias("comp")).distinct())
