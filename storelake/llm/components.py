"""Connected components of an edge list, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelake.session import written


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Link the larger neighbours of every node to its smallest neighbour."""
    near = _both_ways(edges)
    least = near.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("root"))
    return near.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("root").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Link the smaller neighbours of every node, and the node, to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("root"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("root").alias("b"))
    return moved.unionByName(least.select("a", F.col("root").alias("b")))


def _distinct(edges: DataFrame) -> DataFrame:
    return edges.where("a != b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b), root being the smallest node it reaches.

    Each round is a written table; rounds grow with the logarithm of the longest path.
    """
    links = written(_distinct(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))), "links")
    seen = None
    while True:
        state = links.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if state == seen or state["n"] == 0:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        seen = state
        links = written(_distinct(_small_star(_distinct(_large_star(links)))), "links")
