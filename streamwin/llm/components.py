"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import stored


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for each node of the links ``a, b``; the root is the least node it can reach.

    Each round hangs the larger neighbours of a node on its least one, then the
    smaller ones. Every step is a join on single nodes and keeps at most as many
    links as there were. Rounds are written to the shared folder; their number
    grows with the logarithm of the longest path.
    """
    edges = stored(_oriented(links.select("a", "b")), "links")
    state = _state(edges)
    while state[0]:
        edges = stored(_small_star(_large_star(edges)), "links")
        before, state = state, _state(edges)
        if state == before:
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _oriented(links: DataFrame) -> DataFrame:
    """Each link once, from the larger node ``a`` to the smaller ``b``."""
    links = links.where("a <> b")
    return links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _state(edges: DataFrame) -> tuple[int, int | None]:
    found = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return found[0], found[1]


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    return _oriented(both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    joined = edges.join(least, "a")
    moved = joined.select(F.col("b").alias("a"), F.col("least").alias("b"))
    return _oriented(moved.unionByName(least.select("a", F.col("least").alias("b"))))
