"""Connected components by alternating large-star and small-star steps.

Each step hangs neighbours on the least neighbour, so the edges become one star per component. A node's least
neighbour is found by a combined aggregate and joined back, so that a node with very many neighbours
is summed up before it is shuffled and can be split by the adaptive join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterhawk.llm.common import Scratch


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("least")).select("u", F.least("least", "u").alias("least"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("least").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("least"))
    moved = edges.join(least, "u").where("v != least").select(F.col("v").alias("u"), F.col("least").alias("v"))
    return moved.unionByName(least.select("u", F.col("least").alias("v"))).distinct()


def _is_settled(edges: DataFrame) -> bool:
    """Whether every node either is a centre or hangs on exactly one centre."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("hangs"), F.lit(0).alias("holds")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("hangs"), F.lit(1).alias("holds"))
    )
    counted = ends.groupBy("node").agg(F.sum("hangs").alias("hangs"), F.max("holds").alias("holds"))
    return counted.where("hangs > 1 or (hangs > 0 and holds > 0)").isEmpty()


def star_labels(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, label) for every node of ``links`` (a, b) but the least of each component, which is the label."""
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v")
    kept = None
    while True:
        stepped = scratch.put(_small_star(_large_star(edges)), "stars")
        if kept is not None:
            scratch.drop(kept)
        edges = kept = stepped
        if _is_settled(edges):
            return scratch.same(edges, edges.select(F.col("u").alias("node"), F.col("v").alias("label")))
