"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialize


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    out = down.join(least, "a")
    moved = out.where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def _state(edges: DataFrame) -> tuple:
    # the sum of hashes of 31 bits tells sets of edges apart and stays far from overflow
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.abs(F.hash("a", "b")).cast("long"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b); the root is the least node reachable.

    Each round is written to the shared folder, which keeps the lineage short, and the one before is
    deleted; the number of rounds grows with the logarithm of the longest path.  Hot nodes are pre-aggregated, never
    gathered.
    """
    now = materialize(_small_star(edges.where("a != b")), "edges")
    before = None
    while (state := _state(now)) != before:
        before = state
        last, now = now, materialize(_small_star(_large_star(now)), "edges")
        discard(last)
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
