"""Connected components of a graph given as edges, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subtide.session import materialized


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of a node are linked to its smallest neighbour (or itself)."""
    near = _both_ways(edges)
    least = near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("low"))
    return near.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("low"))
    linked = edges.join(least, "u").where("v <> low").select(F.col("v").alias("u"), F.col("low").alias("v"))
    return linked.unionByName(least.select("u", F.col("low").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``u, v``: each linked node but the smallest of its component, and that smallest node.

    Rows of ``edges`` (``u, v``) may be repeated and go either way. Each round is
    written to the shared folder, so lineage stays short and lost executors cost
    one round. The number of rounds grows with the logarithm of the longest path.
    """
    ordered = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    current, before = materialized(ordered, "edges"), None
    while True:
        state = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(state) == before or not state[0]:
            return current
        before = tuple(state)
        current = materialized(_small_star(_large_star(current)), "edges")
