"""Connected components by alternating neighbour minima, over staged edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfscan.sources.staging import stage


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b); the root is the component's smallest node.

    Every round hangs the larger neighbours of a node onto the smallest one, then the
    smaller ones onto it, until each node hangs on its root. Edges with a null end or
    equal ends say nothing and are left out; an empty table gives an empty result. A
    round is two aggregations and two joins and never holds the neighbours of a node
    together, so nodes with very many neighbours need no special care.
    """
    edges = stage(
        edges.where("a is not null and b is not null and a != b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "edges",
    )
    while True:
        around = _both_ways(edges)
        lowest = around.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("n"), F.least("a", "low").alias("low"))
        large = around.where("b > a").join(lowest, F.col("a") == F.col("n")).select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = stage(large.distinct(), "large")
        lowest = large.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("n"), "low")
        small = large.join(lowest, F.col("a") == F.col("n"))
        small = small.select("a", F.col("low").alias("b")).unionByName(
            small.where("b != low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        )
        after = stage(small.distinct(), "small")
        if _is_done(after):
            break
        edges = after
    roots = after.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return after.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def _is_done(edges: DataFrame) -> bool:
    """Every node has one edge, and it leads to a node that has none."""
    several = edges.groupBy("a").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("a")
    chained = edges.join(edges.select(F.col("b").alias("r")).distinct(), F.col("a") == F.col("r"), "left_semi").select("a")
    return several.unionByName(chained).isEmpty()
