from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tablewarden.operators import drift

TABLES = "table_schema STRING, table_name STRING, table_type STRING, data_source_format STRING"
COLUMNS = "table_schema STRING, table_name STRING, column_name STRING, full_data_type STRING, is_nullable STRING, col_comment STRING"


def collected(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture
def diff_of(rows):
    def diff(curr, prev):
        """Snapshots are lists of (table, column, type, nullable, comment)."""
        tables = [rows(TABLES, *sorted({("s", c[0], "MANAGED", "DELTA") for c in side})) for side in (curr, prev)]
        columns = [rows(COLUMNS, *[("s", *c) for c in side]) for side in (curr, prev)]
        return drift.schema_diff(*tables, *columns)

    return diff


def kinds(df):
    return sorted((r.change_type, r.table_name, r.column_name) for r in df.collect())


def test_kinds_of_change(diff_of):
    prev = [("t", "a", "INT", "YES", None), ("t", "b", "INT", "YES", None), ("t", "c", "INT", "YES", None), ("gone", "x", "INT", "YES", None)]
    curr = [("t", "a", "BIGINT", "YES", None), ("t", "b", "INT", "NO", None), ("t", "d", "INT", "YES", None), ("new", "x", "INT", "YES", None), ("new", "y", "INT", "YES", None)]
    assert sorted(kinds(diff_of(curr, prev)), key=str) == sorted(
        [
            ("NEW TABLE", "new", None),
            ("REMOVED", "gone", None),
            ("COL ADDED", "t", "d"),
            ("COL REMOVED", "t", "c"),
            ("TYPE CHANGE", "t", "a"),
            ("TYPE CHANGE", "t", "b"),
        ],
        key=str,
    )


def test_a_null_type_or_another_comment_is_not_a_change(diff_of):
    prev = [("t", "a", None, "YES", None), ("t", "b", "INT", "YES", "old")]
    curr = [("t", "a", "STRING", "YES", None), ("t", "b", "INT", "YES", "new")]
    assert kinds(diff_of(curr, prev)) == []
    # A column without a type is still present.
    assert kinds(diff_of(prev, curr)) == []


def test_null_type_with_other_nullability_is_a_change(diff_of):
    assert kinds(diff_of([("t", "a", None, "NO", None)], [("t", "a", "INT", "YES", None)])) == [("TYPE CHANGE", "t", "a")]


def snapshot(seed):
    picked = random.Random(seed)
    return [
        (f"t{t}", f"c{c}", picked.choice(["INT", "STRING", None]), picked.choice(["YES", "NO"]), None)
        for t in range(8)
        if picked.random() < 0.8
        for c in range(5)
        if picked.random() < 0.7
    ]


@pytest.mark.parametrize("seed", range(3))
def test_properties(rows, diff_of, seed):
    curr, prev = snapshot(seed), snapshot(seed + 100)
    assert diff_of(curr, curr).count() == 0
    mirrored = {"NEW TABLE": "REMOVED", "REMOVED": "NEW TABLE", "COL ADDED": "COL REMOVED", "COL REMOVED": "COL ADDED", "TYPE CHANGE": "TYPE CHANGE"}
    forward, backward = kinds(diff_of(curr, prev)), kinds(diff_of(prev, curr))
    assert sorted(((mirrored[k], t, c) for k, t, c in forward), key=str) == sorted(backward, key=str)

    curr_t, prev_t = (rows(TABLES, *sorted({("s", c[0], "MANAGED", "DELTA") for c in side})) for side in (curr, prev))
    curr_c, prev_c = (rows(COLUMNS, *[("s", *c) for c in side]) for side in (curr, prev))
    common = drift.common_tables(curr_t, prev_t)
    one_by_one = (
        [("NEW TABLE", r.table_name, None) for r in drift.new_tables(curr_t, prev_t).collect()]
        + [("REMOVED", r.table_name, None) for r in drift.removed_tables(curr_t, prev_t).collect()]
        + [("COL ADDED", r.table_name, r.column_name) for r in drift.added_columns(curr_c, prev_c, common).collect()]
        + [("COL REMOVED", r.table_name, r.column_name) for r in drift.removed_columns(curr_c, prev_c, common).collect()]
        + [("TYPE CHANGE", r.table_name, r.column_name) for r in drift.changed_columns(curr_c, prev_c, common).collect()]
    )
    assert sorted(one_by_one, key=str) == sorted(forward, key=str)

    # The diff applied to the previous snapshot gives the current one, for tables of both.
    shared = {c[0] for c in curr} & {c[0] for c in prev}
    keys = {(c[0], c[1]) for c in prev if c[0] in shared}
    keys |= {(t, c) for k, t, c in forward if k == "COL ADDED"}
    keys -= {(t, c) for k, t, c in forward if k == "COL REMOVED"}
    assert keys == {(c[0], c[1]) for c in curr if c[0] in shared}


def test_change_log_and_summary(rows, cfg, diff_of):
    diff = diff_of(
        [("t", "a", "BIGINT", "YES", None), ("t", "n", "INT", "NO", None), ("new", "x", "INT", "YES", None)],
        [("t", "a", "INT", "YES", None), ("t", "o", "DATE", "YES", None)],
    )
    issue = "table_schema STRING, table_name STRING, issue STRING"
    names = rows(issue, ("s", "t", "uppercase letters"))
    none = rows(issue)
    views = rows("table_schema STRING, table_name STRING, definition_preview STRING", ("s", "v", "SELECT 1"))
    log = drift.change_log(diff, names, none, views, cfg)
    assert collected(log) == [
        ("source_catalog.s.new", "NEW TABLE", "", "MANAGED | DELTA"),
        ("source_catalog.s.t", "COL ADDED", "n", "INT | nullable=NO"),
        ("source_catalog.s.t", "COL REMOVED", "o", "DATE"),
        ("source_catalog.s.t", "NAMING", "", "uppercase letters"),
        ("source_catalog.s.t", "TYPE CHANGE", "a", "INT → BIGINT | nullable: YES → YES"),
        ("source_catalog.s.v", "GOVERNANCE", "", "View does not reference publish_ or raw_schema"),
    ]
    assert collected(drift.change_summary(log)) == [
        ("source_catalog.s.new", "NEW TABLE", 1, False),
        ("source_catalog.s.t", "COL ADDED, COL REMOVED, NAMING, TYPE CHANGE", 4, True),
        ("source_catalog.s.v", "GOVERNANCE", 1, False),
    ]


def test_no_change_kind_is_unknown(rows, cfg, diff_of):
    from tablewarden.functions.labels import CHANGE_KINDS

    log = drift.change_log(
        diff_of([("t", "a", "INT", "YES", None)], [("u", "a", "INT", "YES", None)]),
        *[rows("table_schema STRING, table_name STRING, issue STRING")] * 2,
        rows("table_schema STRING, table_name STRING"),
        cfg,
    )
    assert log.filter(~F.col("change_type").isin(*CHANGE_KINDS)).count() == 0
