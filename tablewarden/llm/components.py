"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tablewarden.llm.common import cut_lineage, spread_join


def _stars(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step over edges (u, v) with u > v."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    large = spread_join(both, least, ["u"], ["v"], "inner").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    lowest = large.groupBy("u").agg(F.min("v").alias("m"))
    moved = spread_join(large, lowest, ["u"], ["v"], "inner").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(lowest.select("u", F.col("m").alias("v"))).distinct()


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b BIGINT); root is the smallest node reachable.

    Each step is two group minima and two joins; a node with very many neighbours is pre-aggregated for the minima
    and split for the joins. The driver sees a count and a hash a step. Loops, repeated edges and an empty table
    are allowed; rows with a null end are ignored.
    """
    now = cut_lineage(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    digest = _digest(now)
    while digest[0]:
        now = cut_lineage(_stars(now))
        before, digest = digest, _digest(now)
        if before == digest:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
