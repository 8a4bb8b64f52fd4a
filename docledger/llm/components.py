"""Connected components of a graph in DataFrames, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docledger.lineage import cut, written


def _large(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest node around it."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    # written before it is joined, so that both sides are shuffled as they are and the rows of a node with many neighbours can be split
    least = written(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")))
    return both.where("b > a").join(least, "a").select(F.col("m").alias("a"), "b")


def _small(edges: DataFrame) -> DataFrame:
    """Every node is linked to its smallest smaller neighbour, and so are its other smaller ones."""
    down = edges.select(F.greatest("a", "b").alias("n"), F.least("a", "b").alias("v"))
    least = written(down.groupBy("n").agg(F.min("v").alias("m")))
    others = down.join(least, "n").select("v", "m").where("v != m")
    return least.select(F.col("m").alias("a"), F.col("n").alias("b")).unionByName(others.select(F.col("m").alias("a"), F.col("v").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """node, component for each node of edges (a, b: values of one orderable type); the component is its smallest node.

    Pairs may repeat in either direction, pairs of a node with itself and nulls are ignored. A node without pairs is
    not in the result. A star is split over its members, so a node of any degree is no hot key for long: each round
    keeps at most one pair for each node and neighbour, and the number of rounds grows as the logarithm of the longest path.
    Each round is written to the shared folder.
    """
    edges = cut(edges.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    before = None
    while True:
        after = cut(_small(_large(edges).distinct()).distinct())
        now = after.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        edges = after
        if now == before:
            return edges.select(F.col("b").alias("node"), F.col("a").alias("component")).unionByName(edges.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())
        before = now
