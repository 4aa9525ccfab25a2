"""Connected components of an edge table by alternating large and small stars.

Every round is joins and minimum aggregates over the edges, written to the shared folder; the driver
sees one count and one checksum a round. A hub is a join key with one row on its other side, which
Spark can split, and its minimum is summed up before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import written


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """Hangs each node's neighbours (larger ones, or else all smaller ones and itself) on the least of them."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if larger else edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    hung = both.join(least, "a")
    if larger:
        out = hung.where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        out = hung.select(F.col("b").alias("a"), F.col("least").alias("b")).union(least.select("a", F.col("least").alias("b")))
    return out.where("a <> b").distinct()


def connected_components(edges: DataFrame, label: str = "components") -> DataFrame:
    """``node`` and ``component`` (its least reachable node) of all nodes with an edge.

    ``edges`` has integer columns a and b. Loops and repeated edges change nothing; nulls are ignored;
    no edges give no rows.
    """
    now = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), label)
    state = None
    while True:
        found = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(found) == state or not found[0]:
            break
        state = tuple(found)
        now = written(_star(_star(now, True), False), label)
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
