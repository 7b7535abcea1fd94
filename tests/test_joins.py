from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tablewarden.operators import joins
from tablewarden.operators.joins import SPREAD, spread_join
from tablewarden.operators.topk import latest_per_key


@pytest.fixture
def edges(spark):
    """300 rows, a third of them on one key; keys 8 and 9 are in the lookup only or not at all."""
    hot = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 8)
    return spark.range(300).select(hot.cast("string").alias("key"), F.col("id").alias("value"))


@pytest.fixture
def lookup(spark):
    return spark.range(10).filter("id NOT IN (3, 9)").select(F.col("id").cast("string").alias("key"), (F.col("id") * 10).alias("label"))


def collected(df):
    return sorted(tuple(r) for r in df.select(sorted(df.columns)).collect())


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_same_rows_as_the_plain_join(edges, lookup, how):
    assert collected(spread_join(edges, lookup, ["key"], ["value"], how)) == collected(edges.join(lookup, "key", how))


def test_both_sides_are_exchanged_below_the_join(spark, edges, lookup):
    counted = lookup.groupBy("key").count()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spread_join(edges, counted, ["key"], ["value"], "left_semi")
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = [line.lstrip(" :+-") for line in plan.splitlines()]
    at = next(i for i, line in enumerate(lines) if line.startswith("SortMergeJoin"))
    below = [lines[i + 1] for i, line in enumerate(lines) if i > at and line.startswith("Sort ")]
    assert len(below) == 2 and all(b.startswith("Exchange hashpartitioning(key") and "_part" in b for b in below)


def test_a_hot_key_is_split(edges):
    part = F.pmod(F.xxhash64("value"), F.lit(SPREAD))
    sizes = [r["count"] for r in edges.filter("key = '0'").groupBy(part).count().collect()]
    assert len(sizes) == SPREAD and max(sizes) < 3 * sum(sizes) / SPREAD


def test_latest_per_key_of_a_hot_key(edges):
    found = collected(latest_per_key(edges, ["key"], [F.col("value").desc()], 5))
    rows = [tuple(r) for r in edges.collect()]
    expected = [pair for key in {k for k, _ in rows} for pair in sorted((r for r in rows if r[0] == key), reverse=True)[:5]]
    assert found == sorted(expected)


def test_keys_within_the_limits_are_broadcast_and_others_exchanged(rows, monkeypatch):
    given = rows("k STRING, v INT", ("a", 1), ("a", 2), ("b", 3), (None, 4))
    keys = rows("k STRING", ("a",), ("c",))
    for limit, broadcast in ((10, True), (1, False)):
        monkeypatch.setattr(joins, "BROADCAST_ROWS", limit)
        found = joins.keep_keys(given, keys, "k", ["v"])
        assert sorted(r.v for r in found.collect()) == [1, 2]
        assert ("strategy=broadcast" in found._jdf.queryExecution().optimizedPlan().toString()) == broadcast
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 10)
    assert joins.keep_keys(given, keys.limit(0), "k", ["v"]).count() == 0


def test_many_keys_are_exchanged_without_copies(spark, rows, monkeypatch):
    given = rows("k STRING, v INT", ("a", 1), ("a", 2), ("b", 3), (None, 4))
    keys = rows("k STRING", ("a",), ("c",), (None,))
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = joins.keep_keys(given, keys, "k")
        text = found._jdf.queryExecution().executedPlan().toString()
        assert sorted(r.v for r in found.collect()) == [1, 2]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Generate" not in text and text.count("Exchange hashpartitioning(k") == 2


def test_many_keys_are_hashed_and_rows_not_sorted(spark, rows, monkeypatch):
    given = rows("k STRING, v INT", ("a", 1), ("a", 2), ("b", 3), (None, 4))
    keys = rows("k STRING", ("a",), ("c",), (None,))
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 1)
    for limit, hashed in ((1 << 30, True), (1, False)):
        monkeypatch.setattr(joins, "HASHED_BYTES", limit)
        found = joins.keep_keys(given, keys, "k")
        assert sorted(r.v for r in found.collect()) == [1, 2]
        assert ("strategy=shuffle_hash" in found._jdf.queryExecution().optimizedPlan().toString()) == hashed
