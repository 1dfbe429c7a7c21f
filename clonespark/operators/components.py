"""Connected components of a distributed edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clonespark.scratch import Scratch


def _digest(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return r[0], r[1]


def _large(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours go to its smallest neighbour (or itself)."""
    both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
    return both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small(edges: DataFrame) -> DataFrame:
    """Each node's smaller neighbours, and itself, go to the smallest of them. Here a > b."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionAll(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """From links (a, b) to (node, root), root being the smallest node that node reaches; no row for a root itself.

    Nothing is collected but a count and a sum each round. Every round is a written table, so a lost
    executor costs no more than the round, and lineage stays short. Nodes may be of any type that has an order;
    self-links and repeated links change nothing; null nodes link nothing.
    """
    ordered = edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now = scratch.save(ordered)
    seen = _digest(now)
    while seen[0]:
        new = scratch.save(_small(_large(now)))
        scratch.drop(now)
        now, before = new, seen
        if (seen := _digest(now)) == before:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
