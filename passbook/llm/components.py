"""Connected components of a graph that no single task can hold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from passbook.workspace import stored

MAX_ROUNDS = 64


def _flipped(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("b").alias("a"), F.col("a").alias("b"))


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (columns ``a, b``); root is the least node reachable.

    Alternates two star operations (Kiveris et al., "Connected components in MapReduce and beyond",
    2014): each node's greater neighbours, then its smaller ones, are linked to its least neighbour.
    A node's neighbours are only aggregated by minimum and joined, never gathered. Every round is
    written to the shared folder; the rounds grow with the logarithm of the longest chain.
    """
    current = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    for _ in range(MAX_ROUNDS):
        if current.isEmpty():
            break
        both = current.unionByName(_flipped(current))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stored(large.filter("a <> b").distinct(), "edges")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b"))
        small = small.unionByName(least.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()
        current = stored(small, "edges")
        # stars only: as many edges as nodes that have one, and no root below another
        state = current.agg(
            F.count("*"), F.count_distinct("a"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    roots = current.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("root"))
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
