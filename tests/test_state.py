from __future__ import annotations

import json
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tablewarden.config import WatchConfig
from tablewarden.operators import rules
from tablewarden.plans.metadata import run_metadata
from tablewarden.plans.optimization import run_optimization
from tablewarden.plans.report import metadata_sections, optimization_sections
from tablewarden.sources.catalog import base_tables, current_column_snapshot, current_table_snapshot, table_inventory, view_inventory
from tablewarden.state.store import COLUMN_SNAPSHOT, TABLE_SNAPSHOT, TRACKER, lookback_start, previous_snapshot_date

COLUMNS = "table_schema STRING, table_name STRING, column_name STRING, full_data_type STRING, ordinal_position INT, is_nullable STRING, comment STRING"
TABLES = "table_schema STRING, table_name STRING, table_type STRING, data_source_format STRING, created TIMESTAMP_NTZ, last_altered TIMESTAMP_NTZ"
DAY = date(2024, 4, 1)


def columns_on(rows, day, *names):
    cfg = WatchConfig(as_of=datetime(day.year, day.month, day.day))
    return current_column_snapshot(rows(COLUMNS, *[("raw_schema", "t", n, "INT", i, "YES", f"about {n}") for i, n in enumerate(names)]), cfg)


def stored(store, table):
    return sorted(tuple(r) for r in store.table(table).select("snapshot_date", "column_name", "full_data_type", "col_comment").collect())


def test_snapshot_is_written_by_name(rows, store):
    store.save_snapshot(columns_on(rows, DAY, "a"), COLUMN_SNAPSHOT, DAY)
    assert stored(store, COLUMN_SNAPSHOT) == [(DAY, "a", "INT", "about a")]


def test_saving_again_replaces_only_the_same_date(rows, store):
    earlier = DAY - timedelta(days=1)
    store.save_snapshot(columns_on(rows, earlier, "a"), COLUMN_SNAPSHOT, earlier)
    for _ in range(2):
        store.save_snapshot(columns_on(rows, DAY, "a", "b"), COLUMN_SNAPSHOT, DAY)
    assert [(d, c) for d, c, *_ in stored(store, COLUMN_SNAPSHOT)] == [(earlier, "a"), (DAY, "a"), (DAY, "b")]
    store.save_snapshot(columns_on(rows, DAY, "c"), COLUMN_SNAPSHOT, DAY)
    assert [(d, c) for d, c, *_ in stored(store, COLUMN_SNAPSHOT)] == [(earlier, "a"), (DAY, "c")]


def test_an_empty_snapshot_clears_its_date(rows, store):
    store.save_snapshot(columns_on(rows, DAY, "a"), COLUMN_SNAPSHOT, DAY)
    store.save_snapshot(columns_on(rows, DAY), COLUMN_SNAPSHOT, DAY)
    assert store.table(COLUMN_SNAPSHOT).count() == 0 and store.snapshot_dates(COLUMN_SNAPSHOT) == []


def test_retention_and_compaction(spark, rows, store):
    days = [date(2024, 1, 1), date(2024, 1, 2), DAY]
    for day in days:
        store.save_snapshot(columns_on(rows, day, "a", "b"), COLUMN_SNAPSHOT, day)
    store.apply_retention(COLUMN_SNAPSHOT, DAY, 90)
    assert store.snapshot_dates(COLUMN_SNAPSHOT) == days[1:]

    # A second writer leaves several files on the date.
    extra = columns_on(rows, DAY, "c", "d", "e", "f").repartition(3).select(*store.table(COLUMN_SNAPSHOT).columns)
    extra.write.insertInto(f"{store.database}.{COLUMN_SNAPSHOT}")
    before = stored(store, COLUMN_SNAPSHOT)
    assert store.fragmented_dates(COLUMN_SNAPSHOT, days[1:]) == [DAY]
    store.compact_snapshot(COLUMN_SNAPSHOT, [DAY])
    spark.catalog.refreshTable(store.name(COLUMN_SNAPSHOT))
    assert stored(store, COLUMN_SNAPSHOT) == before
    assert store.fragmented_dates(COLUMN_SNAPSHOT, days[1:]) == []


@pytest.mark.parametrize(
    ("days", "previous"),
    [([28, 31], date(2024, 3, 31)), ([28], date(2024, 3, 28)), ([], None)],
)
def test_previous_date(rows, store, days, previous):
    march = [date(2024, 3, d) for d in days]
    dated = rows("snapshot_date DATE", *[(d,) for d in [*march, DAY, date(2024, 5, 1)]])
    assert previous_snapshot_date(dated, DAY).first()[0] == previous
    for day in [*march, DAY]:
        snapshot = rows(TABLES, ("raw_schema", "t", "MANAGED", "DELTA", None, None)).withColumn("snapshot_date", F.lit(day))
        store.save_snapshot(snapshot, TABLE_SNAPSHOT, day)
    assert store.previous_date(DAY) == previous


def test_look_back(rows):
    tracker = "run_date DATE, analysis_json STRING"
    assert lookback_start(rows(tracker), DAY).first()[0] == DAY
    seen = rows(tracker, (date(2024, 3, 28), ""), (date(2024, 3, 30), ""))
    assert lookback_start(seen, DAY).first()[0] == date(2024, 3, 30)


def test_repeated_columns_are_kept_once_with_the_lowest_ordinal(rows, cfg):
    columns = rows(COLUMNS, ("raw_schema", "t", "a", "INT", 2, "YES", None), ("raw_schema", "t", "a", "DATE", 1, "YES", None), ("other", "t", "a", "INT", 1, "YES", None))
    found = current_column_snapshot(columns, cfg).collect()
    assert [(r.full_data_type, r.ordinal_position, r.snapshot_date) for r in found] == [("DATE", 1, cfg.run_date)]


def test_inventories(rows, cfg):
    kinds = ["MANAGED", "EXTERNAL", "VIEW", "MATERIALIZED_VIEW", "STREAMING_TABLE"]
    listed = [("raw_schema", f"t_{k.lower()}", k, None, None, None) for k in kinds]
    listed += [("raw_schema", "event_log_1", "MANAGED", None, None, None), ("raw_schema", "__materialization_x", "VIEW", None, None, None), ("else", "t", "MANAGED", None, None, None)]
    tables = rows(TABLES, *listed)
    names = lambda df: sorted(r.table_name for r in df.collect())
    assert names(table_inventory(tables, cfg.schemas)) == ["t_external", "t_managed"]
    assert names(view_inventory(tables, cfg.schemas)) == ["t_materialized_view", "t_view"]
    assert current_table_snapshot(tables, cfg).count() == 7
    assert names(base_tables(tables)) == ["event_log_1", "t", "t_external", "t_managed", "t_streaming_table"]


def test_listing_limits_do_not_touch_totals(rows, cfg):
    columns = rows(COLUMNS, *[("raw_schema", f"t{i:03}", "Bad", "INT", 1, "YES", None) for i in range(60)])
    assert rules.raw_column_violations(columns, cfg).count() == 60


def optimization_inputs(rows):
    ms = 1_706_600_000_000
    return {
        "tables": rows(
            TABLES,
            ("raw_schema", "big", "MANAGED", "DELTA", None, datetime(2023, 1, 1)),
            ("raw_schema", "unknown", "MANAGED", "DELTA", None, None),
            ("raw_schema", "v", "VIEW", None, None, datetime(2023, 1, 1)),
        ),
        "columns": rows("table_schema STRING, table_name STRING, column_name STRING, ordinal_position INT", ("raw_schema", "big", "load_date", 1)),
        "files": rows("table_schema STRING, table_name STRING, size_bytes BIGINT", *[("raw_schema", "big", 3 << 20)] * 60),
        "table_props": rows("table_schema STRING, table_name STRING, format STRING, partition_columns ARRAY<STRING>, clustering_columns ARRAY<STRING>", ("raw_schema", "big", "delta", [], [])),
        "jobs": rows("job_id BIGINT, name STRING, schedule STRING", (1, "load", "0 0 23 * * ?"), (2, "idle", "")),
        "runs": rows(
            "job_id BIGINT, run_id BIGINT, start_time BIGINT, end_time BIGINT, result_state STRING, state_message STRING, run_page_url STRING",
            (1, 1, ms, ms + 1_200_000, "FAILED", "boom", "u"),
            (1, 2, ms + 1, ms + 1_200_001, "SUCCESS", None, "u"),
        ),
    }


def test_optimization_run_is_tracked_and_looked_back_to(rows, store, cfg):
    first = run_optimization(optimization_inputs(rows), cfg, store, lambda a: a.totals.collect())
    assert first.since == cfg.run_date
    document = json.loads(store.table(TRACKER).first().analysis_json)
    assert document == {
        "run_date": "2024-01-31", "tables_analyzed": 1, "views_analyzed": 1, "jobs_analyzed": 2, "small_file_tables": 1,
        "missing_cluster": 1, "long_running_jobs": 1, "failing_jobs": 1, "period_failures": 0, "stale_tables": 1,
        "stale_views": 1, "stale_jobs": 1, "est_monthly_cost": 0.7, "est_savings": 0.21,
    }
    second = run_optimization(optimization_inputs(rows), WatchConfig(as_of=datetime(2024, 2, 3)), store, lambda a: a.totals.collect())
    assert second.since == date(2024, 1, 31)
    # A repeated run looks back as far as the first and replaces its row.
    again = run_optimization(optimization_inputs(rows), WatchConfig(as_of=datetime(2024, 2, 3)), store, lambda a: None)
    assert again.since == date(2024, 1, 31)
    assert [r.run_date for r in store.tracker_history().orderBy("run_date").collect()] == ["2024-01-31", "2024-02-03"]

    earlier = WatchConfig(as_of=datetime(2024, 1, 30))
    from tablewarden.plans.optimization import OptimizationAnalysis

    sections = optimization_sections(OptimizationAnalysis(optimization_inputs(rows), cfg, earlier.run_date))
    found = {name: df.collect() for name, df in sections.items()}
    assert found["period_failures"][0].error == "boom" and found["period_failures"][0].rank == 1
    assert found["cluster_commands"][0].cmd == "ALTER TABLE source_catalog.raw_schema.big CLUSTER BY (load_date);\nOPTIMIZE source_catalog.raw_schema.big;"
    assert found["failing"][0].failed_of_total == "1/2"
    assert found["totals"][0].issues == 3
    assert [r.job_name for r in found["stale_jobs"]] == ["idle"]


def metadata_inputs(rows, *columns, tables=("t",)):
    return {
        "tables": rows(TABLES, *[("raw_schema", t, "MANAGED", "DELTA", None, None) for t in tables]),
        "columns": rows(COLUMNS, *[("raw_schema", "t", n, k, i, "YES", None) for i, (n, k) in enumerate(columns)]),
        "views": rows("table_schema STRING, table_name STRING, view_definition STRING", ("transform_schema", "v_view", "SELECT 1")),
        "history": rows("table_schema STRING, table_name STRING, version BIGINT, timestamp TIMESTAMP_NTZ, operation STRING, operation_metrics MAP<STRING,STRING>", ("raw_schema", "t", 1, datetime(2024, 1, 1), "WRITE", {"numOutputRows": "1"})),
        "access_lineage": rows("source_table_full_name STRING, entity_type STRING, entity_id STRING, event_date DATE", ("source_catalog.raw_schema.t", "NOTEBOOK", "7", date(2024, 4, 1))),
        "lineage_payload": rows("table_name STRING, payload STRING", ("source_catalog.raw_schema.t", json.dumps({"downstreams": [{"name": f"d{i}"} for i in range(3)]}))),
        "audit": rows("event_time TIMESTAMP_NTZ, action_name STRING, request_params MAP<STRING,STRING>"),
        "workspace_listing": rows("object_id STRING, object_type STRING, path STRING", ("7", "NOTEBOOK", "/Users/a/nb")),
        "jobs": rows("job_id BIGINT, name STRING, schedule STRING"),
    }


def test_state_loop_over_three_dates_with_a_gap(rows, store):
    def run(day, *columns, report=lambda a: a.diff.collect(), **more):
        return run_metadata(metadata_inputs(rows, *columns, **more), WatchConfig(as_of=datetime(2024, *day)), store, report)

    baseline = run((4, 1), ("a", "INT"))
    assert baseline.dashboard.first().compared_with is None
    assert baseline.diff.count() == 0
    assert tuple(baseline.totals.first()) == (0, 1)

    second = run((4, 2), ("a", "BIGINT"), ("b", "INT"))
    assert sorted((r.change_type, r.column_name) for r in second.diff.collect()) == [("COL ADDED", "b"), ("TYPE CHANGE", "a")]
    rated = {r.fqn: r for r in second.impact.collect()}["source_catalog.raw_schema.t"]
    assert (rated.risk, rated.n_downstream, rated.n_notebooks) == ("CRITICAL", 3, 1)
    assert [r.asset for r in second.lineage.filter("asset_kind = 'NOTEBOOK'").collect()] == ["nb"]
    assert tuple(second.dashboard.first()) == (0, 0, 1, 1, 1, 4, 1, 0, date(2024, 4, 1))

    # A day is missed; the comparison is with the greatest earlier date. Repeating the day changes nothing.
    for _ in range(2):
        third = run((4, 4), ("a", "BIGINT"), tables=("t", "extra"))
        assert sorted((r.change_type, r.column_name) for r in third.diff.collect()) == [("COL REMOVED", "b"), ("NEW TABLE", None)]
        assert store.snapshot_dates(COLUMN_SNAPSHOT) == [date(2024, 4, d) for d in (1, 2, 4)]
        assert store.table(COLUMN_SNAPSHOT).count() == 4

    # Long after: retention drops all earlier dates, yet the diff taken before it stays readable.
    late = run((12, 1), ("a", "BIGINT"), tables=("t",))
    assert store.snapshot_dates(TABLE_SNAPSHOT) == [date(2024, 12, 1)]
    assert [(r.change_type, r.table_name) for r in late.diff.collect()] == [("REMOVED", "extra")]
    sections = {name: df.collect() for name, df in metadata_sections(late).items()}
    assert [r.table_name for r in sections["removed_tables"]] == ["extra"]
    assert sections["stale_data"][0].severity == "CRITICAL" and sections["governance"][0].table_name == "v_view"


def test_a_failed_night_is_reported_by_the_next(rows, store):
    def run(day, *columns, report=lambda a: a.diff.collect()):
        return run_metadata(metadata_inputs(rows, *columns), WatchConfig(as_of=datetime(2024, 4, day)), store, report)

    def fail(analysis):
        raise OSError("no report")

    run(1, ("a", "INT"))
    with pytest.raises(OSError, match="no report"):
        run(2, ("a", "INT"), ("b", "INT"), report=fail)
    assert store.snapshot_dates(TABLE_SNAPSHOT) == [date(2024, 4, 1)]
    third = run(3, ("a", "INT"), ("b", "INT"))
    assert [(r.change_type, r.column_name) for r in third.diff.collect()] == [("COL ADDED", "b")]
    assert third.compared_with == date(2024, 4, 1)


def test_repeated_tables_are_kept_once(rows, cfg):
    tables = rows(TABLES, ("raw_schema", "t", "MANAGED", "DELTA", None, datetime(2024, 1, 1)), ("raw_schema", "t", "VIEW", None, None, datetime(2024, 1, 2)), ("raw_schema", "t", "VIEW", None, None, datetime(2024, 1, 2)))
    assert [(r.table_type, r.last_altered) for r in current_table_snapshot(tables, cfg).collect()] == [("VIEW", datetime(2024, 1, 2))]


def test_an_empty_snapshot_replaces_its_date(rows, store):
    day = rows(TABLES, ("raw_schema", "t", "MANAGED", "DELTA", None, None)).withColumn("snapshot_date", F.lit(DAY))
    store.save_snapshot(day, TABLE_SNAPSHOT, DAY)
    store.save_snapshot(day.limit(0), TABLE_SNAPSHOT, DAY)
    assert store.snapshot_dates(TABLE_SNAPSHOT) == []


def test_job_sections_are_ordered(rows, cfg):
    from tablewarden.plans.optimization import OptimizationAnalysis

    ms = 1_706_600_000_000
    spent = {1: (20, 1), 2: (40, 2), 3: (40, 0), 4: (15, 2)}
    inputs = optimization_inputs(rows) | {
        "jobs": rows("job_id BIGINT, name STRING, schedule STRING", *[(i, f"j{i}", "") for i in spent]),
        "runs": rows(
            "job_id BIGINT, run_id BIGINT, start_time BIGINT, end_time BIGINT, result_state STRING, state_message STRING, run_page_url STRING",
            *[(i, n, ms, ms + m * 60_000, "FAILED" if n < bad else "SUCCESS", "", "") for i, (m, bad) in spent.items() for n in range(2)],
        ),
    }
    sections = optimization_sections(OptimizationAnalysis(inputs, cfg, cfg.run_date), ["long_running", "failing"])
    assert [r.job_id for r in sections["long_running"].collect()] == [2, 3, 1, 4]
    assert [r.job_id for r in sections["failing"].collect()] == [2, 4, 1]
