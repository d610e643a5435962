"""Connected components of a graph given as edges, by alternating large-star and small-star rounds."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _star(pairs: DataFrame) -> DataFrame:
    """``node, other, low``: each node's neighbours with the smallest of them and itself.

    The minimum is a partial aggregate joined back, so that a node with very many neighbours never meets in one task;
    adaptive execution may split its rows in the join.
    """
    lows = pairs.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("low"))
    return pairs.join(lows, "node")


def connected_components(edges: DataFrame, left: str, right: str, rounds: int = 60) -> DataFrame:
    """``node, component``: every node that has an edge, with the smallest node that it reaches.

    Equal ends, repeated edges and NULL ends (dropped: they link nothing) are allowed. A large-star round links each
    node's larger neighbours to the smallest node known there, a small-star round its smaller ones; when neither
    changes an edge, every node points at its component's smallest node. The rounds needed grow with the logarithm of
    the longest chain. Each round is written to the shared folder, so a lost executor costs one round.
    """
    pairs = edges.select(F.col(left).alias("a"), F.col(right).alias("b")).filter("a is not null and b is not null")
    pairs = stored(pairs, "pairs")  # read twice, and what finds the edges may be the greater part of the work
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    current = stored(
        pairs.filter("a <> b").select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("other")).distinct(), "edges"
    )
    mark = _mark(current)
    for _ in range(rounds):
        both = current.unionByName(current.select(F.col("other").alias("node"), F.col("node").alias("other")))
        large = _star(both).filter("other > node").select(F.col("other").alias("node"), F.col("low").alias("other"))
        large = stored(large.filter("node <> other").distinct(), "large")
        small = _star(large)
        small = small.select(F.explode(F.array("node", "other")).alias("node"), F.col("low").alias("other"))
        current = stored(small.filter("node <> other").distinct(), "small")
        before, mark = mark, _mark(current)
        if before == mark:
            linked = current.select("node", F.col("other").alias("component"))
            return nodes.join(linked, "node", "left").select("node", F.coalesce("component", "node").alias("component"))
    raise RuntimeError(f"components did not settle in {rounds} rounds")


def _mark(pairs: DataFrame) -> tuple:
    """Equal for equal sets of edges, and (but for a chance of 2^-64) only for those."""
    return tuple(pairs.agg(F.count("*"), F.bit_xor(F.xxhash64("node", "other")), F.sum(F.hash("node", "other"))).first())
