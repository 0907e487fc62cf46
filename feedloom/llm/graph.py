"""Connected components of an edge list, as Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.functions.frames import written


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the node's smallest neighbour."""
    around = _both_ways(edges)
    least = around.groupBy("u").agg(F.min("v").alias("m"))
    # written, so that the join can split a hot node
    least = written(least.select("u", F.least("u", "m").alias("m")))
    tied = around.filter("v > u").join(least, "u")
    return tied.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them. Edges have u > v."""
    least = written(edges.groupBy("u").agg(F.min("v").alias("m")))
    tied = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return tied.filter("u <> v").union(least.select("u", F.col("m").alias("v"))).distinct()


def _state(edges: DataFrame) -> tuple:
    # xor of 64-bit row hashes: order does not matter, edges are distinct
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of an edge list (u, v); root is the smallest node it reaches.

    Alternating large and small stars: each round is two aggregates and two joins on edges, and the
    number of rounds grows with the logarithm of the longest chain. Every round is
    written to the shared folder, so a lost executor costs one round at most.
    Self-loops, repeated edges and nulls are dropped; an empty list gives no rows.
    """
    now = written(
        edges.filter("u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )
    state = _state(now)
    while state[0]:
        now = written(_small_star(written(_large_star(now))))
        before, state = state, _state(now)
        if before == state:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
