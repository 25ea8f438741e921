"""Connected components by alternating large-star and small-star steps, all as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tonegrain.llm.common import cut_lineage


def _digest(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def _large_star(edges: DataFrame) -> DataFrame:
    """Link each larger neighbour of a node to the smallest node around."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Link each smaller neighbour of a node, and the node itself, to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b")))


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); the component is its smallest node.

    Edges may repeat, point either way or join a node with itself.  A node of many edges is
    pre-aggregated before each shuffle, and its join is one that Spark splits when skewed.
    Every round is cut off at the shared checkpoint folder; their number grows with the
    logarithm of the longest chain.
    """
    edges = cut_lineage(edges.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a <> b").distinct())
    seen = _digest(edges)
    while seen[0]:
        edges = cut_lineage(_small_star(_large_star(edges).distinct()).where("a <> b").distinct())
        now = _digest(edges)
        if now == seen:
            break
        seen = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
