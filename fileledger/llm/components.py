"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.pmod(F.xxhash64("v", "u"), F.lit(1 << 30)))).first())


def connected_components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """``links (u long, v long)`` to ``(node, component)``: the smallest node reachable, for every node of a link.

    Each round is two aggregations with map-side combine and two equi-joins that can be split where a node
    has very many links; the number of rounds grows with the logarithm of the longest path. Links with a
    null end, and of a node with itself, say nothing.
    """
    edges = links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges = scratch.save(edges, "edges")
    seen = _mark(edges)
    while seen[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy(F.col("u").alias("w")).agg(F.least(F.min("v"), F.min("u")).alias("m"))
        large = both.where("v > u").join(least, F.col("u") == F.col("w")).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m"))
        moved = large.join(low, F.col("u") == F.col("w")).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        step = scratch.save(moved.unionByName(low.select(F.col("w").alias("u"), F.col("m").alias("v"))).distinct(), "edges")
        scratch.drop(edges)
        edges, before, seen = step, seen, _mark(step)
        if seen == before:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
