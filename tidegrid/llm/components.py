"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Links each node's larger (or not larger) neighbours to its least neighbour."""
    if large:
        about = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        about = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = about.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
    joined = about.join(least, about["a"] == least["u"])
    if large:
        return joined.where("b > u").select(F.col("b").alias("a"), F.col("m").alias("b"))
    linked = joined.select(F.col("b").alias("a"), F.col("m").alias("b"))
    return linked.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).where("a <> b")


def _checksum(edges: DataFrame) -> tuple:
    """Number of distinct edges and two sums of their hashes, in one scan; equal for equal sets of edges."""
    code = F.xxhash64("a", "b")
    return tuple(edges.agg(F.count("*"), F.bit_xor(code), F.sum(code.cast("decimal(20,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component``, the least node it can reach, for the ends of all edges.

    ``edges`` has long columns a and b.  Self-links count for nothing, repeats for one; no
    edges give no rows.
    """
    edges = saved(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = _checksum(edges)
    while before[0]:
        edges = saved(_star(_star(edges, True).distinct(), False).distinct(), "links")
        # done when every node hangs on its least and nothing moves
        after = _checksum(edges)
        if after == before:
            break
        before = after
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
