"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import narrow_table


def _star(both: DataFrame) -> DataFrame:
    """Each edge (u, v) of ``both`` with m, the smallest of u and its neighbours there. Summed up before the shuffle."""
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    return both.join(least, "u").withColumn("m", F.least("u", "m"))


def components(edges: DataFrame) -> DataFrame:
    """node and component (its smallest node) of every node with an edge. ``edges`` has longs a and b.

    Each round is two aggregations and joins over the edges, written to the shared folder; joins are on a node, which
    adaptive execution can split. No node's neighbours are ever gathered in one task. Rounds go on until the edges, told by
    their number and a hash, are those of the round before; that takes about as many rounds as the logarithm of the longest path.
    """
    now = narrow_table(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "cc-edges")
    seen = None
    while True:
        large = _star(now.union(now.select("v", "u"))).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        small = _star(large)
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(small.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
        now = narrow_table(small, "cc-edges")
        mark = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if mark == seen:
            break
        seen = mark
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
