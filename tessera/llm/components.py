"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import stage


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One contraction. Large: every larger neighbour of a node moves to the
    node's least neighbour. Small: every neighbour below a node does."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        both = both.unionByName(both.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    moved = both.join(least, "u")
    if large:
        out = moved.filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = moved.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(
            least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return out.filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b of type long): root is the
    least node that it reaches. Runs to the fixpoint, where each component is a
    star about its root; the rounds grow with the logarithm of its size."""
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    edges = stage(edges, "star")
    state = None
    while True:
        now = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if (now.n, now.s) == state or not now.n:
            break
        state = (now.n, now.s)
        edges = stage(_star(_star(edges, True), False), "star")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
