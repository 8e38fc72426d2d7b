"""Connected components of an edge table by alternating large and small stars, with one written table a round."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .scratch import Scratch


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Links every larger (large star) or smaller (small star) neighbour, and the node itself, to the smallest node around."""
    if large:
        around = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        around = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = around.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = around.join(least, "u")
    if large:
        out = joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
    return out.filter("u <> v").distinct()


def components(edges: DataFrame, scratch: Scratch, name: str = "components") -> DataFrame:
    """(node, component) of every node of ``edges`` (u, v: long); the component is its smallest node.

    A node of any number of edges is handled by reductions and equi-joins only; the number of rounds grows with the logarithm of the size.
    """
    now = scratch.table(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), f"{name}-0")
    turn = 0
    # Done once all edges go from nodes of one edge to nodes that have no smaller neighbour.
    ends = lambda t: t.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(t.select("v", F.lit(0), F.lit(1)))
    while ends(now).groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).filter("up > 1 or (up > 0 and down > 0)").limit(1).count():
        now = scratch.table(_star(_star(now, True), False), f"{name}-{turn + 1}")
        scratch.drop(f"{name}-{turn}")
        turn += 1
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(now.select("v", "v").distinct())
