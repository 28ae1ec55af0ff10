"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from addrweave.llm.store import written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Each node links its larger (large) or its not larger (small) neighbours to the smallest node it sees."""
    u, v = F.col("u"), F.col("v")
    both = edges.unionByName(edges.select(v.alias("u"), u.alias("v"))) if large else edges.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v"))
    low = both.groupBy("u").agg(F.least(F.min("v"), u).alias("m"))
    moved = both.join(low, "u")
    if large:
        out = moved.where(v > u).select(v.alias("u"), F.col("m").alias("v"))
    else:
        out = moved.select(v.alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
    return out.where(u != v).distinct()


def components(edges: DataFrame) -> DataFrame:
    """Smallest reachable node of every node of ``edges`` (``x``, ``y``: long) as ``node``, ``component``.

    Ends when every node has one link and no link leads to a node that has one itself; rounds grow with the logarithm of the longest
    chain. Loops, repeated and reversed edges are fine; no edges give no rows; edges with a null end are left out.
    """
    now = written(edges.select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v")).where("x is not null and y is not null and u != v").distinct(), "edges")
    while not _flat(now):
        now = written(_star(now, True), "edges")
        if _flat(now):
            break
        now = written(_star(now, False), "edges")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _flat(edges: DataFrame) -> bool:
    """Whether all links lead from a node with one link to a root: one pass over both ends."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("into")).union(edges.select("v", F.lit(0), F.lit(1)))
    return ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("into").alias("into")).where("out > 1 or (out = 1 and into = 1)").isEmpty()
