"""Structural checks of a directed graph given as nodes and edges.

Nodes: ``name``. Edges: ``src, dst`` and, for weighted nodes, ``weight``.
Several graphs can be checked at once when both carry the ``keys`` columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The one node that needs no inbound edge; tolerance of a weight sum.
ROOT = "Initial"
WEIGHT_TOLERANCE = 1e-6


def missing_targets(nodes: DataFrame, edges: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Edges to a node that does not exist."""
    known = nodes.select(*keys, F.col("name").alias("dst")).distinct()
    return edges.select(*keys, "src", "dst").distinct().join(known, [*keys, "dst"], "left_anti").select(*keys, "src", "dst")


def without_inbound(nodes: DataFrame, edges: DataFrame, keys: tuple[str, ...] = (), root: object = ROOT) -> DataFrame:
    """Nodes no edge leads to, the root exempt. Tests the in-degree, not reachability."""
    reached = edges.select(*keys, F.col("dst").alias("name")).distinct()
    return nodes.select(*keys, "name").filter(F.col("name") != root).join(reached, [*keys, "name"], "left_anti")


def unbalanced_weights(edges: DataFrame, keys: tuple[str, ...] = (), tolerance: float = WEIGHT_TOLERANCE) -> DataFrame:
    """Weighted nodes whose outgoing weights do not sum to 1.

    A node with any edge of no weight is not a weighted one. Weights are added as
    decimals, so a sum near the tolerance does not depend on the order of addition.
    """
    sums = edges.groupBy(*keys, "src").agg(
        F.sum(F.col("weight").try_cast("decimal(38,15)")).cast("double").alias("weight_sum"),
        F.count(F.when(F.col("weight").isNull(), 1)).alias("_open"),
    )
    return sums.filter((F.col("_open") == 0) & (F.abs(F.col("weight_sum") - 1) > tolerance)).select(
        *keys, "src", "weight_sum"
    )


def graph_problems(nodes: DataFrame, edges: DataFrame, keys: tuple[str, ...] = (), root: object = ROOT) -> DataFrame:
    """All three checks as rows ``(keys, problem, node)``; none when it is sound."""
    return (
        missing_targets(nodes, edges, keys)
        .select(*keys, F.lit("missing target").alias("problem"), F.col("dst").cast("string").alias("node"))
        .unionByName(
            without_inbound(nodes, edges, keys, root).select(
                *keys, F.lit("no inbound edge").alias("problem"), F.col("name").cast("string").alias("node")
            )
        )
        .unionByName(
            unbalanced_weights(edges, keys).select(
                *keys, F.lit("weights do not sum to 1").alias("problem"), F.col("src").cast("string").alias("node")
            )
        )
    )


def membership_difference(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Members on one side only, tagged with the side that lacks them."""
    ours, theirs = left.select(keys).distinct(), right.select(keys).distinct()
    return (
        ours.join(theirs, keys, "left_anti")
        .withColumn("missing_from", F.lit("right"))
        .unionByName(theirs.join(ours, keys, "left_anti").withColumn("missing_from", F.lit("left")))
    )
