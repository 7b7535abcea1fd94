"""Joins of many rows with a lookup of unique keys, safe when one key holds much of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

SPREAD = 8
# A set of keys is broadcast up to this many rows and bytes of text.
BROADCAST_ROWS, BROADCAST_BYTES = 1 << 20, 64 << 20
# A larger one is hashed partition by partition up to this many bytes of text, all partitions together, and sorted beyond.
HASHED_BYTES = 1 << 30


def spread_join(rows: DataFrame, lookup: DataFrame, on: Sequence[str], spread_by: Sequence[str], how: str) -> DataFrame:
    """Join on ``on`` with every key split into ``SPREAD`` parts by the hash of ``spread_by``.

    ``lookup`` holds each key once and is copied for every part, so each row still meets its key exactly
    once; ``how`` may be any join that keeps or drops rows of the left side. As the parts belong to the join
    key, both sides are exchanged right below the join, which is also what lets AQE split a skewed partition
    further. A lookup that is already partitioned by its keys would be joined in place and never split.
    """
    part = F.pmod(F.xxhash64(*spread_by), F.lit(SPREAD)).cast("int")
    copies = F.explode(F.array(*[F.lit(i) for i in range(SPREAD)]))
    return (
        rows.withColumn("_part", part)
        .join(lookup.withColumn("_part", copies), [*on, "_part"], how)
        .drop("_part")
    )


def keep_keys(rows: DataFrame, keys: DataFrame, on: str, spread_by: Sequence[str] | None = None) -> DataFrame:
    """The rows whose string ``on`` is among the distinct ``keys`` (one column of that name).

    The keys are counted and measured first, so they should be stored. A set within the limits is broadcast: the rows are
    then filtered where they are scanned, and what is dropped is neither exchanged nor parsed. A larger set is joined by
    exchange: as it is, both sides exchanged right below the join, where AQE splits a skewed partition, or with ``spread_by``
    every key split into parts, for which all keys are copied. Only the keys are hashed, the rows are not sorted.
    """
    size = keys.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(F.octet_length(on)), F.lit(0)).alias("bytes")).first()
    if size.rows <= BROADCAST_ROWS and size.bytes <= BROADCAST_BYTES:
        return rows.join(F.broadcast(keys), on, "left_semi")
    if size.bytes <= HASHED_BYTES:
        keys = keys.hint("shuffle_hash")
    if spread_by is None:
        return rows.join(keys, on, "left_semi")
    return spread_join(rows, keys, [on], spread_by, "left_semi")
