"""Snapshots as validity intervals equal the full copies of every night."""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta

import pytest

from tablewarden import adapters as given
from tablewarden.config import WatchConfig
from tablewarden.operators import drift
from tablewarden.plans.metadata import run_metadata
from tablewarden.state import intervals as module
from tablewarden.state.intervals import OPEN, Intervals, digest_diff
from tablewarden.state.store import COLUMN_SNAPSHOT, TABLE_SNAPSHOT, snapshot_at

DDL = "table_schema STRING, table_name STRING, column_name STRING, full_data_type STRING, ordinal_position INT, is_nullable STRING, col_comment STRING"
TABLES = "table_schema STRING, table_name STRING, table_type STRING, data_source_format STRING, created TIMESTAMP_NTZ, last_altered TIMESTAMP_NTZ"


def day(n):
    return date(2024, 1, 1) + timedelta(days=n)


def column(name, kind="INT", comment=None, table="t"):
    return ("s", table, name, kind, 1, "YES", comment)


@pytest.fixture
def columns(store):
    made = Intervals.of_columns(store)
    made.ensure()
    return made


def read(kept, when):
    return sorted(map(tuple, kept.at(when).collect()), key=str)


def stored(kept):
    rows = kept.store.fresh(kept.history).collect()
    return sorted((r.column_name, r.full_data_type, r.valid_from, r.closed_on) for r in rows)


def test_rows_are_stored_while_they_stay_the_same(columns, rows):
    nights = [[column("a"), column("b")], [column("a", "BIGINT"), column("b")], [column("a", "BIGINT"), column("b")], [column("b"), column("c", comment="x")], [column("a"), column("b"), column("c")]]
    for n, night in enumerate(nights):
        columns.merge(rows(DDL, *night), day(n))
    assert stored(columns) == [
        ("a", "BIGINT", day(1), day(3)), ("a", "INT", day(0), day(1)), ("a", "INT", day(4), OPEN), ("b", "INT", day(0), OPEN), ("c", "INT", day(3), day(4)), ("c", "INT", day(4), OPEN),
    ]
    assert [read(columns, day(n)) for n in range(5)] == [sorted(night, key=str) for night in nights]
    assert columns.nights() == [day(n) for n in range(5)]


def test_random_nights_equal_copies_also_when_repeated(columns, rows):
    rng = random.Random(8)
    now: dict[tuple, tuple] = {}
    copies = {}
    for n in range(0, 12, 2):
        for _ in range(2 if n in (4, 8) else 1):
            for _ in range(6):
                key = (f"t{rng.randrange(5)}", f"c{rng.randrange(4)}")
                if rng.random() < 0.3:
                    now.pop(key, None)
                else:
                    now[key] = column(key[1], rng.choice(["INT", "STRING", None]), rng.choice([None, "x"]), key[0])
            # A night may be merged again with other rows: the last ones count.
            columns.merge(rows(DDL, *now.values()), day(n))
        copies[n] = sorted(now.values(), key=str)
    assert all(read(columns, day(n)) == copy for n, copy in copies.items())
    # A day without a night is as the night before it.
    assert read(columns, day(5)) == copies[4] and read(columns, day(0) - timedelta(days=1)) == []


def test_a_night_without_changes_writes_digests_only(columns, rows):
    night = [column(f"c{i}", table=f"t{i}") for i in range(20)]
    assert columns.merge(rows(DDL, *night), day(0))
    files = {r.f for r in columns.store.fresh(columns.history).selectExpr("_metadata.file_path AS f").collect()}
    assert columns.merge(rows(DDL, *reversed(night)), day(1)) == []
    # One table changes: the files of the other buckets stay.
    touched = columns.merge(rows(DDL, *night[1:], column("c0", "BIGINT", table="t0")), day(2))
    after = {r.f for r in columns.store.fresh(columns.history).selectExpr("_metadata.file_path AS f").collect()}
    assert len(touched) == 1 and len(files - after) == 1 and columns.nights() == [day(0), day(1), day(2)]


def test_a_night_that_failed_between_its_writes_is_merged_again(columns, rows, monkeypatch):
    columns.merge(rows(DDL, column("a"), column("b")), day(0))
    monkeypatch.setattr(columns.store, "save_snapshot", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError, match="lost"):
        columns.merge(rows(DDL, column("a", "BIGINT")), day(1))
    monkeypatch.undo()
    columns.merge(rows(DDL, column("a", "STRING"), column("b")), day(1))
    assert stored(columns) == [("a", "INT", day(0), day(1)), ("a", "STRING", day(1), OPEN), ("b", "INT", day(0), OPEN)]


def test_empty_nights_order_and_retention(columns, rows):
    columns.merge(rows(DDL), day(0))
    columns.merge(rows(DDL, column("a")), day(1))
    columns.merge(rows(DDL), day(2))
    columns.merge(rows(DDL, column("b")), day(100))
    with pytest.raises(ValueError, match="before the last"):
        columns.merge(rows(DDL), day(3))
    assert [read(columns, day(n)) for n in (0, 1, 2, 100)] == [[], [column("a")], [], [column("b")]]
    columns.apply_retention(day(100))
    assert stored(columns) == [("b", "INT", day(100), OPEN)] and columns.nights() == [day(100)]


def test_diff_by_digest_reads_differing_buckets_only(store, rows, columns, monkeypatch):
    tables = Intervals.of_tables(store)
    tables.ensure()
    table = lambda name, kind="MANAGED": ("s", name, kind, "DELTA", None, None)
    before_t, before_c = [table(f"t{i}") for i in range(8)], [column("a", table=f"t{i}") for i in range(8)]
    tables.merge(rows(TABLES, *before_t), day(0))
    columns.merge(rows(DDL, *before_c), day(0))
    after_t = [*before_t[1:], table("new")]
    after_c = [*before_c[2:], column("a", "BIGINT", table="t1"), column("b", table="t2"), column("a", table="new")]
    want = drift.schema_diff(rows(TABLES, *after_t), rows(TABLES, *before_t), rows(DDL, *after_c), rows(DDL, *before_c))
    got = digest_diff(tables, columns, rows(TABLES, *after_t), rows(DDL, *after_c), day(1))
    assert got.count() == want.count() == 4 and got.exceptAll(want).isEmpty()
    asked = []
    monkeypatch.setattr(Intervals, "valid_before", lambda self, d, buckets, real=Intervals.valid_before: asked.append(list(buckets)) or real(self, d, buckets))
    assert digest_diff(tables, columns, rows(TABLES, *before_t), rows(DDL, *before_c), day(1)).count() == 0
    assert asked == [[-1], [-1]] and module.BUCKETS > 8


def test_nightly_runs_keep_both_forms_alike(spark, store):
    for night, n in ((given.NIGHTS[0], 1), (given.NIGHTS[1], 2)):
        orders = given.orders_before(spark, "/root/testdata/sf0.001", night)
        inputs = {"tables": given.order_tables(orders), "columns": given.order_columns(orders)}
        run_metadata(inputs, WatchConfig(as_of=datetime(2024, 1, n), schemas=("r0", "r1")), store, lambda a: None, intervals=True)
    for kept, table in ((Intervals.of_columns(store), COLUMN_SNAPSHOT), (Intervals.of_tables(store), TABLE_SNAPSHOT)):
        for n in (1, 2):
            want = snapshot_at(store.fresh(table), date(2024, 1, n)).select(*kept.key, *kept.values)
            got = kept.at(date(2024, 1, n))
            assert got.count() == want.count() > 0 and got.exceptAll(want).isEmpty()
