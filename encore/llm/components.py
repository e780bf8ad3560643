"""Connected components of a large graph by alternating stars over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import drop, stage_path, staged


def _state(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
    return r.n, r.x


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of an edge, root being its component's smallest node.

    ``edges``: columns a and b of one orderable type, each edge in either
    direction, repeats and loops allowed.  Each round hooks the larger
    neighbours of a node to its smallest one, then the smaller ones, and
    writes the edges out; no node's neighbours are ever gathered (minima and
    joins only).  Rounds grow with the logarithm of a component's diameter.
    """
    spark = edges.sparkSession
    path = stage_path(spark, "edges")
    now = staged(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
                 "edges", path)
    state = _state(now)
    while True:
        least = now.select(F.col("b").alias("u"), F.col("b").alias("v")).union(  # b < a, so b itself or a neighbour
            now.select(F.col("a").alias("u"), F.col("b").alias("v"))).union(
            now.select(F.col("b").alias("u"), F.col("a").alias("v"))).groupBy("u").agg(F.min("v").alias("m"))
        large = now.join(least, F.col("b") == F.col("u")).select("a", F.col("m").alias("b")).distinct()
        small_path, next_path = stage_path(spark, "edges"), stage_path(spark, "edges")
        large = staged(large, "edges", small_path)
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where(F.col("b") != F.col("m")).select(
            F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b"))).distinct()
        after = staged(small, "edges", next_path)
        drop(spark, path), drop(spark, small_path)
        now, path, before, state = after, next_path, state, _state(after)
        if state == before:
            roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
            return roots.union(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
