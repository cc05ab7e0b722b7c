"""Connected components of a large graph by joins alone."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rankloom.session import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = stored(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "least")
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node's smaller neighbours and the node itself to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = stored(down.groupBy("a").agg(F.min("b").alias("m")), "least")
    linked = down.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return linked.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def _state(edges: DataFrame):
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
    return row["n"], row["x"]


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, component`` for edges ``a, b``: the smallest node each node is linked with.

    Alternates large-star and small-star steps until every edge points from a node to
    its component. Minima are taken before they are joined, so no list of neighbours
    ever meets in one place. Nodes without an edge to another node have no row.
    """
    current = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state = _state(current)
    while state[0]:
        current = stored(_small_star(_large_star(current)), "edges")
        before, state = state, _state(current)
        if state == before:
            break
    members = current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return members.unionByName(current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
