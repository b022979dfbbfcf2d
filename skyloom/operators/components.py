"""Connected components of an edge table within groups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom.plans.state import cut


def components(edges: DataFrame, group: str = "image") -> DataFrame:
    """edges(group, a, b) -> group, node, root: the least node that edges reach. Nodes without an edge are not listed.

    Each round takes the least root among a node and its neighbours, combined before the shuffle, and then the root of
    that root, so that chains shorten by halves; it ends when no root changes. Neighbours are never gathered.
    """
    pairs = edges.filter("a <> b").select(group, "a", "b")
    both = cut(pairs.unionByName(pairs.select(group, F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    roots = cut(both.groupBy(group, F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("root")))
    while True:
        theirs = both.join(roots.withColumnRenamed("node", "b"), [group, "b"]).groupBy(group, F.col("a").alias("node")).agg(F.min("root").alias("theirs"))
        near = roots.join(theirs, [group, "node"]).select(group, "node", "root", F.least("root", "theirs").alias("next"))
        jump = roots.select(group, F.col("node").alias("next"), F.col("root").alias("beyond"))
        after = cut(near.join(jump, [group, "next"], "left").select(group, "node", "root", F.least("next", "beyond").alias("next")))
        if after.filter("root <> next").isEmpty():
            return after.select(group, "node", F.col("next").alias("root"))
        roots = after.select(group, "node", F.col("next").alias("root"))
