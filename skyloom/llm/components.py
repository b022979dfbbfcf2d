"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom.llm.common import cut, parts_for


#: Edges that a file of a checkpoint is meant to hold.
EDGES = 200_000


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """edges of ids -> node, component (the least id that links reach). Nodes without an edge are not listed.

    Each step is a minimum over neighbours, which is combined before the shuffle, and a join; a node's neighbours are
    never gathered. The edges shrink to stars in a number of rounds that grows as the logarithm of the longest path.
    """
    now = cut(edges.select(F.least(a, b).alias("low"), F.greatest(a, b).alias("high")).filter("low < high").distinct())
    parts = parts_for(now.count(), EDGES, 8)  # no step makes more edges
    while True:
        both = now.select(F.col("low").alias("u"), F.col("high").alias("v")).unionByName(now.select(F.col("high").alias("u"), F.col("low").alias("v")))
        # large star: neighbours above u go to the least of u and its neighbours
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = now.join(least, now["low"] == least["u"]).select(F.col("m").alias("low"), "high").filter("low < high").distinct()
        # small star: u and its neighbours below go to the least of them
        least = large.groupBy("high").agg(F.min("low").alias("m"))
        small = large.join(least, "high").select(F.col("m"), "low", "high")
        small = small.select("m", F.col("low").alias("x")).unionByName(small.select("m", F.col("high").alias("x"))).filter("m < x").distinct().select(F.col("m").alias("low"), F.col("x").alias("high"))
        small = cut(small, parts)
        # done when every node hangs on one root and no root hangs on another
        roots = small.groupBy("high").agg(F.countDistinct("low").alias("n"))
        open_ = roots.filter("n > 1").limit(1).count() or small.join(small.select(F.col("high").alias("low")).distinct(), "low", "left_semi").limit(1).count()
        now = small
        if not open_:
            break
    return now.select(F.col("high").alias("node"), F.col("low").alias("component")).unionByName(now.select(F.col("low").alias("node"), F.col("low").alias("component")).distinct())
