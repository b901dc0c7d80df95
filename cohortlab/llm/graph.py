"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def _checksum(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"),
                    F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
    return row["n"], row["x"]


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the least of its neighbourhood."""
    both = edges.union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return (both.where("b > a").join(least, "a")
            .select(F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b")).where("a <> b").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, is tied to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    ties = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return ties.union(least.select("a", F.col("m").alias("b"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root): every node of an edge with the smallest node it reaches.

    `edges` has two columns a, b without nulls. The rounds stop when the edge
    set no longer changes, after which each node has one edge, to its root.
    Each round is written with checkpoint(), so lineage stays short and a lost
    executor costs a re-read. No edges: no rows.
    """
    edges = edges.where("a <> b").checkpoint()
    seen = _checksum(edges)
    while seen[0]:
        edges = _small_star(_large_star(edges)).checkpoint()
        now = _checksum(edges)
        if now == seen:
            break
        seen = now
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
