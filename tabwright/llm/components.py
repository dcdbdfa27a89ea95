"""Connected components of an edge table by alternating star contractions; no node's edges meet in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.session import materialize


def _star(edges: DataFrame, smaller: bool) -> DataFrame:
    """Hang each node's neighbours (the larger ones, or the smaller ones and itself) on its smallest neighbour."""
    if smaller:
        near = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    else:
        near = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
    low = near.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    joined = near.join(low, "u")
    kept = joined if smaller else joined.filter("v > u")
    out = kept.select(F.col("v").alias("a"), F.col("m").alias("b"))
    if smaller:
        out = out.union(low.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return out.filter("a <> b")


def components(edges: DataFrame, rounds: int = 50) -> DataFrame:
    """(node, component) for every node with an edge in (a, b); the component is its smallest node.

    Edges are written to the shared folder after each round; the rounds needed grow with the logarithm of
    the longest chain. The end is reached when every node hangs on one root and no root hangs on another.
    An empty edge table gives an empty result.
    """
    now = materialize(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), "edges")
    for _ in range(rounds):
        up, down = now.select(F.col("a").alias("x"), F.lit(1).alias("ups"), F.lit(0).alias("roots")), now.select(F.col("b"), F.lit(0), F.lit(1))
        sides = up.union(down).groupBy("x").agg(F.sum("ups").alias("ups"), F.max("roots").alias("roots"))
        if sides.filter("ups > 1 or ups = 1 and roots = 1").isEmpty():
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(now.select("b", "b").distinct())
        now = materialize(_star(_star(now, False), True).distinct(), "edges")
    raise RuntimeError("components did not settle")
