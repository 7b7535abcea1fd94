"""What lies downstream of changed tables over any number of hops (an extension: the risk rating counts direct readers)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tablewarden.operators.joins import spread_join
from tablewarden.operators.walks import Graph, walks
from tablewarden.state.store import cut_lineage

# Edges, as numbers, with the names of the tables are held by the driver and by every task up to this many bytes.
HELD_BYTES = 3 << 26
# Pairs that a task hands on at a time.
BATCH_ROWS = 1 << 16


def downstream_edges(lineage: DataFrame) -> DataFrame:
    """Distinct (fqn, asset) of the direct readers in a lineage relation (fqn, asset_kind, asset)."""
    return lineage.filter(F.col("asset_kind") == "DOWNSTREAM").select("fqn", "asset").distinct()


def downstream_hops(edges: DataFrame, roots: DataFrame, max_hops: int | None = None) -> DataFrame:
    """(fqn, asset, distance): every asset that is reached from a root along ``edges`` (fqn, asset), with the fewest hops.

    ``roots`` holds ``fqn``. A table is not downstream of itself; cycles end. The pairs may be many times the edges. Where the
    edges fit into ``HELD_BYTES``, every task walks from its share of the roots over all of them and hands the pairs on as it
    finds them: none is exchanged or stored. Larger graphs are walked in rounds of joins, which store every pair.
    """
    known = F.col("fqn").isNotNull() & F.col("asset").isNotNull()
    steps = cut_lineage(edges.select("fqn", "asset").filter(known & (F.col("fqn") != F.col("asset"))).distinct())
    start = roots.select("fqn").filter(F.col("fqn").isNotNull()).distinct()
    numbered = _numbered(steps)
    return _by_rounds(steps, start, max_hops) if numbered is None else _by_walks(steps, numbered, start, max_hops)


def _numbered(steps: DataFrame) -> DataFrame | None:
    """(name, node): every name of the stored ``steps`` with its place among them; None if names and edges exceed ``HELD_BYTES``."""
    edge_bytes = 8 * steps.count()
    if edge_bytes > HELD_BYTES:
        return None
    names = cut_lineage(steps.select(F.explode(F.array("fqn", "asset")).alias("name")).distinct())
    size = [F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(F.octet_length("name")), F.lit(0)).alias("bytes")]
    parts = names.groupBy(F.spark_partition_id().alias("part")).agg(*size).orderBy("part").collect()
    if edge_bytes + sum(8 * p.rows + p.bytes for p in parts) > HELD_BYTES:
        return None
    # A stored relation keeps its partitions and their order, so a row has one place.
    before = dict(zip([p.part for p in parts], np.cumsum([0, *[p.rows for p in parts]]).tolist()))
    starts = F.array(*[F.lit(before.get(i, 0)) for i in range(max(before, default=0) + 1)])
    row = F.monotonically_increasing_id()
    place = row.bitwiseAND(F.lit((1 << 33) - 1)) + F.get(starts, F.shiftright(row, 33).cast("int"))
    return names.select("name", place.cast("int").alias("node"))


def _held(steps: DataFrame, starts: DataFrame, ends: DataFrame, numbered: DataFrame) -> Graph:
    names = numbered.select("name").toArrow()["name"].combine_chunks()
    edges = steps.join(starts, "fqn").join(ends, "asset").select("start", "end").toArrow()
    return Graph.of(names, edges["start"].to_numpy(), edges["end"].to_numpy())


def _by_walks(steps: DataFrame, numbered: DataFrame, start: DataFrame, max_hops: int | None) -> DataFrame:
    """The driver gathers the edges as numbers, the tasks hold them."""
    spark = steps.sparkSession
    starts, ends = (numbered.select(F.col("name").alias(name), F.col("node").alias(node)) for name, node in (("fqn", "start"), ("asset", "end")))
    held = spark.sparkContext.broadcast(_held(steps, starts, ends, numbered))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = held.value.names
        for batch in batches:
            for found in walks(held.value, batch.column(0).to_numpy(), max_hops):
                for low in range(0, len(found[0]), BATCH_ROWS):
                    root, node, distance = (pa.array(x[low : low + BATCH_ROWS]) for x in found)
                    yield pa.RecordBatch.from_arrays([names.take(root), names.take(node), distance], ["fqn", "asset", "distance"])

    # Dealt to all tasks: few bytes of roots, much work.
    dealt = start.join(starts, "fqn").select("start").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "start")
    return dealt.mapInArrow(run, "fqn STRING NOT NULL, asset STRING NOT NULL, distance INT NOT NULL")


def _by_rounds(steps: DataFrame, start: DataFrame, max_hops: int | None) -> DataFrame:
    """Each round joins only the pairs found in the round before, and keeps those not found yet, so it ends on cycles, after as
    many rounds as the longest of the shortest paths or after ``max_hops``. A hub's edges are split by their target, and the
    pairs of the last round are copied for every part. The driver sees whether a round found anything.
    """
    last = cut_lineage(start.select("fqn", F.col("fqn").alias("asset"), F.lit(0).alias("distance")))
    found, distance = last, 0
    while max_hops is None or distance < max_hops:
        distance += 1
        here = last.select(F.col("fqn").alias("root"), F.col("asset").alias("fqn"))
        met = spread_join(steps, here, ["fqn"], ["asset"], "inner").select(F.col("root").alias("fqn"), "asset").distinct()
        last = cut_lineage(met.join(found, ["fqn", "asset"], "left_anti").withColumn("distance", F.lit(distance)))
        if last.isEmpty():
            break
        found = found.unionByName(last)
    return found.filter(F.col("distance") > 0)


def impact_depth(summary: DataFrame, hops: DataFrame) -> DataFrame:
    """Every changed table with its direct readers, all it reaches, and the greatest distance."""
    reach = hops.groupBy("fqn").agg(
        F.count_if(F.col("distance") == 1).alias("n_direct"), F.count(F.lit(1)).alias("n_reached"), F.max("distance").alias("deepest")
    )
    counts = [F.coalesce(c, F.lit(0)).alias(c) for c in ("n_direct", "n_reached", "deepest")]
    return summary.join(reach, "fqn", "left").select("fqn", "change_summary", "breaking", *counts)
