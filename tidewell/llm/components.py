"""Connected components of a graph given as edges, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import stored


def _nearest(edges: DataFrame) -> DataFrame:
    """The smallest neighbour of each node; combines before it travels, so a hub costs one row per task."""
    return edges.groupBy("a").agg(F.min("b").alias("low"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Join every larger neighbour of a node to the smallest node around it."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return both.join(_nearest(both), "a").filter(F.col("b") > F.col("a")).select(
        F.col("b").alias("a"), F.least("a", "low").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Join a node and its smaller neighbours to the smallest of them; edges point from larger to smaller."""
    joined = edges.join(_nearest(edges), "a")
    return joined.select(F.explode(F.array(
        F.struct(F.col("b").alias("a"), F.col("low").alias("b")), F.struct(F.col("a"), F.col("low").alias("b"))
    )).alias("e")).select("e.*").filter(F.col("a") != F.col("b"))


def connected_components(edges: DataFrame) -> DataFrame:
    """node and root, the smallest node it is connected with, for every node that is not a root itself.

    ``edges`` has long columns a and b. Each round is stored, so lineage stays short; one row per round (the number
    of edges and a checksum) reaches the driver. Rounds grow with the logarithm of the longest path.
    """
    def canonical(df: DataFrame) -> DataFrame:
        larger, smaller = F.greatest("a", "b"), F.least("a", "b")
        return df.filter(F.col("a") != F.col("b")).select(larger.alias("a"), smaller.alias("b")).distinct()

    def mark(df: DataFrame):
        return df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    current = stored(canonical(edges), "edges")
    before = mark(current)
    while before[0]:
        current = stored(canonical(_small_star(canonical(_large_star(current)))), "edges")
        now = mark(current)
        if now == before:
            break
        before = now
    return current.select(F.col("a").alias("node"), F.col("b").alias("root"))
