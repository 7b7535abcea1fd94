"""Latest-N per key and top-N over a whole relation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """First ``n`` rows of every key in the given order, which must be total within a key.

    The ``row_number() <= n`` form lets Catalyst place a group limit on both sides of the exchange, so
    a hot key sends at most ``n`` rows per map task, however many rows it holds.
    """
    position = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_position", position).filter(F.col("_position") <= n).drop("_position")


def top_n(df: DataFrame, order: Sequence[Column], n: int | None = None) -> DataFrame:
    """Ordered rows, cut to ``n`` when given; the order must be total for a repeatable cut."""
    ordered = df.orderBy(*order)
    return ordered if n is None else ordered.limit(n)


def ranked_top_n(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """Top-N with a ``rank`` column; the window sees no more than ``n`` rows."""
    return top_n(df, order, n).withColumn("rank", F.row_number().over(Window.orderBy(*order)).cast("bigint"))
