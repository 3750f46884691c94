"""Connected components of a graph of long node ids, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carestrata.runtime import materialise


def component_roots(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each node of ``edges`` (a, b) reaches.

    Each round lets every node hand its larger neighbours to the smallest node it
    knows, then its smaller ones. Nodes move towards their root in a number of rounds
    that grows with the logarithm of the longest path, and edges never become more.
    A node's smallest neighbour is an aggregate that combines before it shuffles, and
    the join with it has one row per node on one side, so a node with a third of all
    edges can be split. Every round is written to the shared folder.
    """

    def state(e: DataFrame) -> tuple:
        row = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        return tuple(row)

    pairs = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct()
    pairs = materialise(pairs, "component-edges")
    before = state(pairs)
    while True:
        both = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("m", "a"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a > b").distinct()
        large = materialise(large, "component-edges")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        hung = large.join(low, "a")
        small = hung.select(F.col("b").alias("a"), F.col("m").alias("b")).union(hung.select("a", F.col("m").alias("b")))
        pairs = materialise(small.where("a > b").distinct(), "component-edges")
        after = state(pairs)
        if after == before:
            break
        before = after
    roots = pairs.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(pairs.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
