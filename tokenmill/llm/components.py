"""Connected components of an edge table by alternating star contractions."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges`` (u, v; longs) that isn't the smallest
    of its component; ``root`` is that smallest node.

    Each round points a node's larger neighbours, then its smaller ones, at the
    smallest neighbour, until the edges are stars. Joins are on a node and its
    minimum, so a node with very many neighbours is a skewed join side that can be
    split, never a group in one task. Each round is a table written to the shared
    folder.
    """
    def canonical(df: DataFrame) -> DataFrame:
        return df.filter("hi <> lo").distinct()

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first())

    now = materialise(canonical(edges.select(F.greatest("u", "v").alias("hi"), F.least("u", "v").alias("lo"))), "cc-0")
    seen, turn = state(now), 0
    while seen[0]:
        turn += 1
        # Large star: the larger neighbours of n go to the smallest of n and its neighbours.
        both = now.select(F.col("hi").alias("n"), F.col("lo").alias("m")).union(now.select("lo", "hi"))
        least = both.groupBy("n").agg(F.min("m").alias("low")).select("n", F.least("n", "low").alias("r"))
        large = both.filter("m > n").join(least, "n").select(F.col("m").alias("hi"), F.col("r").alias("lo"))
        large = materialise(canonical(large), f"cc-{turn}-large")
        # Small star: n and its smaller neighbours go to the smallest of them.
        low = large.groupBy("hi").agg(F.min("lo").alias("r"))
        met = large.join(low, "hi")
        now = materialise(canonical(met.select(F.col("lo").alias("hi"), F.col("r").alias("lo"))
                                    .union(low.select("hi", F.col("r").alias("lo")))), f"cc-{turn}")
        last, seen = seen, state(now)
        if last == seen:
            break
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
