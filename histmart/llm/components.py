"""Connected components of a link table by alternating large-star and small-star rounds.

Every round is a grouped minimum and a join on the same key; edges shrink to
stars around the smallest node of each component in a number of rounds that
grows with the logarithm of the component's size. Hubs are joined by broadcast
of the few hot keys (``common.attach``), so no task gets a hub's edges alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import attach, cut


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` for every node with an edge; component is the smallest node reachable.

    Loops, repeated and reversed edges count once; an empty table gives no rows.
    """
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    e, before = cut(e), None
    while (now := signature(e)) != before:
        before = now
        e = cut(small_star(large_star(e)))
    return e.select(F.col("u").alias("node"), F.col("v").alias("component"))


def signature(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def large_star(e: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour (or the node itself)."""
    both = e.select(F.col("u").alias("x"), F.col("v").alias("y")).unionByName(e.select(F.col("v").alias("x"), F.col("u").alias("y")))
    least = cut(both.groupBy("x").agg(F.min("y").alias("m"), F.count("*").alias("n")))
    star = attach(both, least, "x", "n").where("y > x")
    return cut(star.select(F.col("y").alias("u"), F.least("m", "x").alias("v")).distinct())


def small_star(e: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, is linked to its smallest neighbour."""
    least = cut(e.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")))
    smaller = attach(e, least, "u", "n").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return smaller.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
