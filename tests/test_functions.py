"""Boundary values of the column expressions."""

from __future__ import annotations

from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from tablewarden.functions import labels, schedule, storage, times


@pytest.mark.parametrize(
    ("files", "avg_mb", "severity", "gain"),
    [
        (50, 10.0, None, None),
        (51, 32.0, None, None),
        (51, 31.999, "MEDIUM", 75),
        (51, 0.999, "CRITICAL", 80),
        (51, 1.0, "MEDIUM", 80),
        (200, 500.0, None, None),
        (201, 500.0, "HIGH", 0),
        (201, 100.0, "HIGH", 22),
        (1000, 100.0, "HIGH", 22),
        (1001, 500.0, "CRITICAL", 0),
        (0, 0.0, None, None),
    ],
)
def test_small_files(rows, files, avg_mb, severity, gain):
    df = rows("files BIGINT, avg DOUBLE", (files, avg_mb))
    count, avg = F.col("files"), F.col("avg")
    found = df.filter(storage.is_small_file_table(count, avg)).select(
        storage.small_file_severity(count, avg), storage.scan_gain(avg)
    )
    assert [tuple(r) for r in found.collect()] == ([] if severity is None else [(severity, gain)])


@pytest.mark.parametrize(
    ("size", "files", "mb", "mean"),
    [(None, 0, 0.0, 0.0), (1048576, 1, 1.0, 1.0), (1048576 * 3, 7, 3.0, 0.429), (131072, 1, 0.12, 0.125), (393216, 1, 0.38, 0.375)],
)
def test_sizes_round_half_even(rows, size, files, mb, mean):
    df = rows("size BIGINT, files BIGINT", (size, files))
    got = df.select(storage.size_mb(F.col("size")), storage.avg_file_mb(F.col("size"), F.col("files"))).first()
    assert tuple(got) == (mb, mean)


@pytest.mark.parametrize(
    ("expression", "label"),
    [
        ("", "No schedule"),
        (None, "No schedule"),
        ("0 0 23 * * ?", "Daily at 11:00 PM"),
        ("0 30 9 ? * MON-FRI", "Mon-Fri at 9:30 AM"),
        ("0 0 2 ? * 1", "Sun at 2:00 AM"),
        ("0 5 12 ? * MON,3", "Mon, Tue at 12:05 PM"),
        ("0 0 0 15 * ?", "Day 15 of month at 12:00 AM"),
        ("0 0/15 * * * ?", "Daily at *:0/15"),
        ("0 0 5", "0 0 5"),
        ("0 0 5 ? * 1-3-5", "0 0 5 ? * 1-3-5"),
        ("  0 0  5 ? * tue ", "tue at 5:00 AM"),
        ("   ", "   "),
        ("0 007 08 * * ? 2030", "Daily at 8:07 AM"),
        ("0 0 99999999999999999999 * * ?", "Daily at 99999999999999999999:0"),
        ("0 0 5 ? * MON-", "Mon- at 5:00 AM"),
    ],
)
def test_schedule_label(rows, expression, label):
    df = rows("e STRING", (expression,))
    assert df.select(schedule.schedule_label(F.col("e"))).first()[0] == label


@pytest.mark.parametrize(
    ("days", "severity"),
    [(8, "LOW"), (14, "LOW"), (15, "MEDIUM"), (30, "MEDIUM"), (31, "HIGH"), (90, "HIGH"), (91, "CRITICAL")],
)
def test_freshness_severity(rows, days, severity):
    assert rows("d BIGINT", (days,)).select(labels.freshness_severity(F.col("d"))).first()[0] == severity


def test_freshness_severity_never_falls_with_age(rows):
    rank = {"LOW": 0, "MEDIUM": 1, "HIGH": 2, "CRITICAL": 3}
    found = rows("d BIGINT", *[(d,) for d in range(8, 200)]).orderBy("d").select(labels.freshness_severity(F.col("d")))
    ranks = [rank[r[0]] for r in found.collect()]
    assert ranks == sorted(ranks)


@pytest.mark.parametrize(
    ("breaking", "downstream", "risk"),
    [(True, 3, "CRITICAL"), (True, 2, "HIGH"), (True, 1, "HIGH"), (True, 0, "LOW"), (False, 5, "MEDIUM"), (False, 1, "MEDIUM"), (False, 0, "LOW")],
)
def test_risk_level(rows, breaking, downstream, risk):
    df = rows("b BOOLEAN, n BIGINT", (breaking, downstream))
    assert df.select(labels.risk_level(F.col("b"), F.col("n"))).first()[0] == risk


@pytest.mark.parametrize(
    ("metrics", "written"),
    [
        ({"numOutputRows": "5"}, "5"),
        ({"numTargetRowsInserted": "3"}, "3"),
        ({"numOutputRows": "", "numTargetRowsInserted": "4"}, "4"),
        ({"numOutputRows": ""}, None),
        ({}, None),
        (None, None),
        ({"numOutputRows": "0"}, "0"),
    ],
)
def test_rows_written(rows, metrics, written):
    df = rows("m MAP<STRING,STRING>", (metrics,))
    assert df.select(labels.rows_written(F.col("m"))).first()[0] == written


@pytest.mark.parametrize(
    ("path", "label"),
    [("/Repos/a/load", "load"), ("/Repos/a/load/", "load"), (None, "Notebook #7"), ("", "Notebook #7"), ("plain", "plain")],
)
def test_notebook_label(rows, path, label):
    df = rows("i STRING, p STRING", ("7", path))
    assert df.select(labels.notebook_label(F.col("i"), F.col("p"))).first()[0] == label


@pytest.mark.parametrize(
    ("start", "end", "minutes"), [(0, 60000, 1.0), (1000, 0, 1 / 60000), (1000, None, 1 / 60000), (1000, 31000, 0.5)]
)
def test_run_minutes(rows, start, end, minutes):
    df = rows("s BIGINT, e BIGINT", (start, end))
    assert df.select(times.run_minutes(F.col("s"), F.col("e"))).first()[0] == pytest.approx(minutes)


@pytest.mark.parametrize(
    ("utc", "label"),
    [
        (datetime(2024, 1, 31, 4, 59, 59, 999000), "2024-01-30 23:59 ET"),
        (datetime(2024, 7, 1, 4, 0), "2024-07-01 00:00 ET"),
        # The two hours around the end of daylight saving show the same wall clock.
        (datetime(2023, 11, 5, 5, 30), "2023-11-05 01:30 ET"),
        (datetime(2023, 11, 5, 6, 30), "2023-11-05 01:30 ET"),
    ],
)
@pytest.mark.parametrize("session_zone", ["UTC", "Europe/Berlin", "America/New_York"])
def test_local_label_ignores_the_session_zone(spark, rows, cfg, utc, label, session_zone):
    epoch_ms = int(utc.replace(tzinfo=timezone.utc).timestamp() * 1000)
    spark.conf.set("spark.sql.session.timeZone", session_zone)
    try:
        assert rows("t BIGINT", (epoch_ms,)).select(times.et_label(F.col("t"), cfg)).first()[0] == label
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize(
    ("written", "days"),
    [
        ("2024-01-31 00:00:00", 0),
        ("2024-01-24 00:00:00", 7),
        ("2024-01-23 00:01:00", 7),
        ("2024-01-23 00:00:00.000001", 7),
        ("2024-01-23 00:00:00", 8),
        ("2024-01-31 00:00:01", -1),
    ],
)
def test_age_is_floored(rows, cfg, written, days):
    df = rows("s STRING", (written,)).select(F.col("s").cast("timestamp_ntz").alias("t"))
    assert df.select(times.age_days(df, "t", cfg)).first()[0] == days


def test_age_of_an_instant_counts_from_local_midnight(rows, cfg):
    # as_of is 05:00 UTC.
    df = rows("s STRING", ("2024-01-24 05:00:00",), ("2024-01-24 05:00:01",)).select(F.col("s").cast("timestamp").alias("t"))
    assert sorted(r[0] for r in df.select(times.age_days(df, "t", cfg)).collect()) == [6, 7]


@pytest.mark.parametrize(
    ("name", "raw", "transform"),
    [
        ("Bad Name", "uppercase letters", "uppercase letters"),
        ("bad name", "contains spaces", "missing _view suffix"),
        ("x", None, "missing _view suffix"),
        ("X_view", "uppercase letters", "uppercase letters"),
        ("a b_view", "contains spaces", None),
        ("good_view", None, None),
    ],
)
def test_naming(rows, name, raw, transform):
    df = rows("n STRING", (name,))
    got = df.select(labels.raw_name_issue(F.col("n")), labels.transform_name_issue(F.col("n"))).first()
    assert tuple(got) == (raw, transform)


@pytest.mark.parametrize(
    ("definition", "flagged"),
    [
        ("SELECT * FROM publish_a.t", False),
        ("SELECT * FROM publishXa.t", True),
        ("SELECT * FROM PUBLISH_a.t", True),
        ("SELECT * FROM raw_schema.t", False),
        ("SELECT * FROM rawXschema.t", True),
        (None, None),
        ("x" * 5000 + "publish_a", False),
    ],
)
def test_governance_reads_the_whole_definition(rows, definition, flagged):
    df = rows("d STRING", (definition,))
    assert df.select(labels.breaks_governance(F.col("d"), "raw_schema")).first()[0] == flagged
