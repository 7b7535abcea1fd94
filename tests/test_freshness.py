from __future__ import annotations

from datetime import datetime, timedelta

import pytest

from tablewarden.operators.freshness import data_freshness, freshness_order
from tablewarden.operators.topk import top_n

HISTORY = (
    "table_schema STRING, table_name STRING, version BIGINT, timestamp TIMESTAMP_NTZ, operation STRING, "
    "operation_metrics MAP<STRING,STRING>"
)
AS_OF = datetime(2024, 1, 31)


def entry(version, age_days, operation="WRITE", metrics=None, table="t"):
    return ("s", table, version, AS_OF - timedelta(days=age_days), operation, metrics or {})


@pytest.fixture
def checked(rows, cfg):
    def check(*entries, tables=("t",)):
        base = rows("table_schema STRING, table_name STRING", *[("s", t) for t in tables])
        return top_n(data_freshness(rows(HISTORY, *entries), base, cfg), freshness_order()).collect()

    return check


@pytest.mark.parametrize(
    ("age", "severity"),
    [(7, None), (8, "LOW"), (14, "LOW"), (15, "MEDIUM"), (30, "MEDIUM"), (31, "HIGH"), (90, "HIGH"), (91, "CRITICAL")],
)
def test_age(checked, age, severity):
    found = checked(entry(1, age, metrics={"numOutputRows": "5"}))
    assert [(r.days_since, r.severity, r.rows_written) for r in found] == ([] if severity is None else [(age, severity, "5")])


def test_almost_eight_days_are_seven(checked):
    assert checked(entry(1, 8 - 1 / 1440)) == []


def test_no_write_in_the_log(checked):
    found = checked(*[entry(v, 1, "OPTIMIZE") for v in range(1, 32)])
    assert [(r.days_since, r.severity, r.last_write, r.last_op, r.rows_written) for r in found] == [
        (9999, "CRITICAL", "No writes found", "—", "—")
    ]


def test_write_at_entry_31_is_found(checked):
    history = [entry(1, 40)] + [entry(v, 1, "OPTIMIZE") for v in range(2, 32)]
    assert [(r.days_since, r.severity, r.last_op) for r in checked(*history)] == [(40, "HIGH", "WRITE")]


def test_write_at_entry_30_is_found(checked):
    history = [entry(1, 20, "merge")] + [entry(v, 1, "OPTIMIZE") for v in range(2, 31)]
    found = checked(*history)
    assert [(r.days_since, r.last_op, r.last_write) for r in found] == [(20, "merge", "2024-01-11 00:00 ET")]


def test_latest_write_wins_over_later_maintenance(checked):
    found = checked(entry(1, 90), entry(2, 40, "STREAMING UPDATE"), entry(3, 1, "VACUUM END"))
    assert [(r.days_since, r.last_op) for r in found] == [(40, "STREAMING UPDATE")]


def test_no_history_is_not_reported_and_unknown_tables_are_ignored(checked):
    assert checked(entry(1, 99, table="elsewhere"), tables=("t",)) == []


def test_oldest_first(checked):
    found = checked(entry(1, 20, table="a"), entry(1, 50, table="b"), entry(1, 3, "OPTIMIZE", table="c"), tables=("a", "b", "c"))
    assert [r.table_name for r in found] == ["c", "b", "a"]


def test_null_operation_is_no_write(checked):
    assert [r.days_since for r in checked(entry(1, 50), entry(2, 1, None))] == [50]
