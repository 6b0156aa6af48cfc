"""Connected components by alternating stars, as rounds of Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import Scratch


def _minimum(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node now points to the node's smallest neighbour."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = _minimum(both).select("u", F.least("u", "m").alias("m"))
    return (
        both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours now point to the smallest of them."""
    low = _minimum(edges)
    moved = edges.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(low.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame, scratch: Scratch, max_rounds: int = 60) -> DataFrame:
    """(u, component) for every node of (u, v) edges; the component is its smallest node.

    Nodes of any ordered type. Self loops and repeated edges are harmless, null ends are
    ignored. Each round is a large-star and a small-star step; both aggregate a minimum per
    node and join it back, so a node with very many edges is split like any skewed join. The
    number of rounds grows with the logarithm of the number of nodes; edges are written to
    the shared folder after each. Raises if ``max_rounds`` do not suffice.
    """
    ends = edges.select("u", "v").where("u is not null and v is not null and u <> v")
    now = scratch.write(
        ends.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    )
    for _ in range(max_rounds):
        after = scratch.write(_small_star(_large_star(now).distinct()))
        same = after.exceptAll(now).isEmpty() and now.exceptAll(after).isEmpty()
        scratch.drop(now)
        now = after
        if same:
            roots = now.select(F.col("v").alias("u"), F.col("v").alias("component")).distinct()
            return now.select("u", F.col("v").alias("component")).union(roots)
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
