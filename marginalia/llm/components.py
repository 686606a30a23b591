"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import release, stored

MAX_ROUNDS = 60


def _large(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the smallest node around it."""
    both = edges.select("a", "b").union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b")
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    tied = down.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return tied.union(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)`` that isn't its own root.

    The root is the smallest node of the component.  Each round is two
    map-side combined minima and two joins whose hot nodes AQE splits, and is
    written, so that a lost executor costs one round.  Rounds grow with the
    logarithm of the longest path.  No edge or label reaches the driver, only
    a count and a check sum per round.  Loops and repeated edges are ignored.
    """
    mark = lambda df: df.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 1_000_003)).first()
    edges = stored(edges.select("a", "b").filter("a <> b").distinct(), "edges")
    before = mark(edges)
    for _ in range(MAX_ROUNDS):
        if not before[0]:
            break
        after = stored(_small(_large(edges)), "edges")
        now = mark(after)
        release(edges)
        edges = after
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
