"""Shape of the physical plans: what is shuffled, pushed down and kept off."""

from __future__ import annotations

import json
import re

import pytest

from tablewarden import adapters as given
from tablewarden.adapters import CONFIG
from tablewarden.operators import drift, jobs, lineage
from tablewarden.operators.joins import keep_keys
from tablewarden.plans.optimization import OptimizationAnalysis
from tablewarden.plans.report import optimization_sections
from tablewarden.registry import QUERIES
from tablewarden.sources import logs, payloads
from tablewarden.sources.files import storage_detail

SF = "/root/testdata/sf0.001"
# These act while they are built; their plans are plain table reads.
STATEFUL = {"snapshot_roundtrip", "tracker_roundtrip", "nightly_changes", "streamed_freshness", "streamed_period_failures", "interval_snapshots", "schema_diff_by_digest"}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - STATEFUL))
def test_no_python_workers_cartesian_products_or_hints(spark, name):
    text = plan(QUERIES[name](spark, SF))
    for banned in ("EvalPython", "PythonUDF", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin", "Scan json"):
        assert banned not in text, banned


@pytest.mark.parametrize(
    "build",
    [
        lambda s: jobs.latest_runs(given.runs(s, SF)),
        lambda s: logs.recent_history(given.history(s, SF)),
        lambda s: lineage.latest_audit(given.audit(s, SF)),
    ],
)
def test_latest_per_key_limits_before_the_exchange(spark, build):
    text = plan(build(spark))
    partial, exchange, final = text.index("Partial"), text.index("Exchange hashpartitioning"), text.index("Final")
    # Read from the top of the plan down: final limit, exchange, partial limit.
    assert final < exchange < partial
    assert text.count("Exchange ") == 1


def test_files_are_aggregated_before_they_meet_the_properties(spark):
    text = plan(storage_detail(given.files(spark, SF), given.table_props(spark, SF)))
    assert "partial_sum(size_bytes" in text and "partial_count" in text
    scan = next(line for line in text.splitlines() if "lineitem.parquet" in line)
    assert re.search(r"FileScan parquet \[l_orderkey#\d+L,l_suppkey#\d+L,l_quantity#\d+\]", scan)


def test_reads_of_other_tables_are_dropped_before_the_exchange(spark, rows):
    text = plan(logs.access_lineage(given.access_edges(spark, SF), rows("fqn STRING", ("x",)), CONFIG))
    # From the top of the plan down: the exchange of counted edges, their count, the semi join with the changed tables.
    assert text.index("Exchange hashpartitioning(fqn") < text.index("partial_count") < text.index("BroadcastHashJoin") and "LeftSemi" in text


def test_documents_of_other_tables_are_neither_exchanged_nor_parsed(spark, rows, tmp_path):
    """Landed pages as they are stored: the payload is read, filtered and parsed in one stage."""
    given.lineage_pages(spark, SF).write.parquet(str(tmp_path / "pages"))
    pages = keep_keys(spark.read.parquet(str(tmp_path / "pages")), rows("table_name STRING", ("x",)), "table_name", ["payload"])
    access = rows("fqn STRING, asset_kind STRING, asset STRING", ("x", "JOB", "j"))
    text = plan(lineage.merge_lineage(payloads.lineage_from_payload(pages, mark_rejected=True), access))
    assert text.count("from_json") == 1 and text.count("FileScan") == 1
    assert text.index("Exchange hashpartitioning(fqn") < text.index("partial_count") < text.index("from_json") < text.index("LeftSemi") < text.index("FileScan")
    assert all("payload" not in line for line in text.splitlines() if "Exchange hashpartitioning" in line)


def test_lineage_pages_are_made_in_buffers_of_fixed_size(spark):
    text = plan(given.lineage_pages(spark, SF))
    assert "ObjectHashAggregate" not in text and text.count("Exchange") == 1


def test_lineage_pages_list_every_asset_once(spark, tmp_path):
    """Suppliers below zero, at both ends of a page, of the largest keys and without a key."""
    suppliers = [None, 0, 1, 49, 50, 51, 99, -1, -2, -49, -50, -51, 2**63 - 1, -(2**63)]
    kinds = [("A", "F"), ("R", "F"), ("N", "F"), ("N", "O"), (None, None)]
    lines = [(order, part, s, flag, status) for order in (1, 2, 3, 3) for part in (7, None) for s in suppliers for flag, status in kinds[: 2 + order]]
    ddl = "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_returnflag STRING, l_linestatus STRING"
    spark.createDataFrame(lines, ddl).write.parquet(str(tmp_path / "lineitem.parquet"))
    expected = {}
    for order, part, s, flag, status in lines:
        part = 0 if order % 3 == 0 else part
        page = None if s is None else abs(s) // given.PAYLOAD_PAGE * (1 if s >= 0 else -1)
        expected.setdefault((part, order % 2, page), set()).add((s is not None, s or 0, {"A": 2, "R": 1}.get(flag, 3 if status == "F" else 4)))

    def document(entries):
        def named(*wanted):
            return [{"name": f"s_{s}"} if known else {} for known, s in sorted({(k, s) for k, s, kind in entries if kind in wanted})]

        readers = [(known, s, kind) for known, s, kind in sorted(entries) if kind <= 2]
        of_kind = {1: lambda s: {"name": f"Customer#{str(s)[:9].rjust(9, '0')}"}, 2: lambda s: {"path": f"/Users/u{s}/nb_u{s}"}}
        listed = [{"entity_type": "JOB" if kind == 1 else "NOTEBOOK", **(of_kind[kind](s) if known else {})} for known, s, kind in readers]
        return {"downstreams": named(3, 4), "upstreams": named(3), "entity_lineage": listed}

    found = [(r.table_name, json.loads(r.payload)) for r in given.lineage_pages(spark, str(tmp_path)).collect()]
    named = {key: None if key[0] is None else f"source_catalog.r{key[0] % 2}.tbl_{key[0]}_{key[1]}" for key in expected}
    wanted = [(named[key], document(entries)) for key, entries in expected.items()]
    assert sorted(found, key=repr) == sorted(wanted, key=repr)


def test_presence_of_tables_is_made_once(spark):
    text = plan(QUERIES["schema_diff"](spark, SF))
    # Both readings of the presence of tables are the same exchange, so it is made once.
    made = [line for line in text.splitlines() if "partial_max(CASE WHEN (side#" in line]
    numbers = re.compile(r"#\d+L?")
    assert len({numbers.sub("", line).strip(" +-:") for line in made}) == 1
    below = [text[at : text.index("Union", at)] for at in (m.start() for m in re.finditer(r"partial_max\(CASE WHEN \(side#", text))]
    assert all("isnotnull(table_name" not in part for part in below)


def test_filters_reach_the_scan(spark):
    scan = next(line for line in plan(given.workspace_listing(spark, SF)).splitlines() if "FileScan" in line)
    assert "PushedFilters: [IsNotNull(event_type), IsNotNull(value), EqualTo(event_type,click)" in scan


def test_stored_snapshot_is_read_by_partition(spark, store):
    from tablewarden.state.store import COLUMN_SNAPSHOT, snapshot_at

    store.save_snapshot(given.monthly_columns(spark, SF), COLUMN_SNAPSHOT)
    text = plan(snapshot_at(store.table(COLUMN_SNAPSHOT), given.STATE_AS_OF))
    assert re.search(r"PartitionFilters: \[isnotnull\(snapshot_date#\d+\), \(snapshot_date#\d+ = 1998-06-01\)\]", text)


def test_capped_sections_use_a_top_n(spark):
    assert "TakeOrderedAndProject" in plan(QUERIES["report_sections_metadata"](spark, SF))
    assert "TakeOrderedAndProject" not in plan(QUERIES["view_governance_violations"](spark, SF))


def test_schemas_are_filtered_before_files_are_aggregated(spark):
    text = plan(OptimizationAnalysis(given.optimization_inputs(spark, SF), CONFIG, given.SINCE).detail)
    lines = text.splitlines()
    counted = next(i for i, line in enumerate(lines) if "partial_sum(size_bytes" in line)
    assert any("Filter" in line and "raw_schema" in line for line in lines[counted:])


def test_only_columns_of_large_tables_are_ranked(spark):
    text = plan(QUERIES["recommend_clustering"](spark, SF))
    assert text.index("WindowGroupLimit") < text.index("LeftSemi")


def test_counting_findings_does_not_sort_them(spark):
    inputs = given.optimization_inputs(spark, SF)
    analysis = OptimizationAnalysis(inputs, CONFIG, given.SINCE)
    assert "rangepartitioning" in plan(analysis.small_files)
    assert "rangepartitioning" not in plan(analysis.small_files.groupBy().count())
    assert "rangepartitioning" not in plan(optimization_sections(analysis)["small_files"])


def test_a_landed_document_is_parsed_once(rows):
    landed = rows("table_name STRING, payload STRING", ("t", "{}"))
    assert plan(payloads.lineage_from_payload(landed)).count("from_json") == 1


def test_failures_meet_each_job_once(spark, rows):
    """A broadcast of copied jobs takes a task's memory several times over."""
    given_jobs = given.jobs(spark, SF)
    found = jobs.period_failures(given.runs(spark, SF), given_jobs, CONFIG, given.SINCE)
    assert "Generate" not in plan(found) and "_part" not in plan(found)
    held = rows("job_id BIGINT, name STRING", (1, "one"), (None, "none"))
    runs = rows(
        "job_id BIGINT, run_id BIGINT, start_time BIGINT, end_time BIGINT, result_state STRING, state_message STRING, run_page_url STRING",
        *[(job, run, CONFIG.as_of_ms, 0, "FAILED", "x", "") for job, run in ((1, 1), (1, 1), (1, None), (2, 2), (None, 3))],
    )
    kept = jobs.period_failures(runs, held, CONFIG, given.SINCE).collect()
    # Every run of a known job, one without an id too.
    assert sorted((r.job_name, r.run_id or 0) for r in kept) == [("one", 0), ("one", 1), ("one", 1)]


def test_each_column_snapshot_is_exchanged_once(spark, rows):
    tables = "table_schema STRING, table_name STRING, table_type STRING, data_source_format STRING"
    columns = "table_schema STRING, table_name STRING, column_name STRING, full_data_type STRING, is_nullable STRING"
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(drift.schema_diff(rows(tables), rows(tables), rows(columns), rows(columns)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    by_column = r"Exchange hashpartitioning\(table_schema#\d+, table_name#\d+, column_name#\d+, \d+\)"
    assert len(re.findall(by_column, text)) == 2
    # Both table snapshots go through one exchange; in the final plan its second use is a reuse.
    by_table = r"Exchange hashpartitioning\(table_schema#\d+, table_name#\d+, \d+\)"
    assert len(re.findall(by_table, text)) == 2
    # The diff meets the common tables after the full outer join, one part of a key at a time.
    assert text.index("LeftSemi") < text.index("column_name", text.index("FullOuter", text.index("LeftSemi")))
    assert "_part" in text


def test_lineage_pages_are_made_by_one_exchange(spark, tmp_path):
    assert plan(given.lineage_pages(spark, SF)).count("Exchange ") == 1
    # One supplier in every kind, twice in one of them; a line without a supplier is on a page of its own.
    lines = [(3, 5, 7, "A", "F"), (6, 9, 7, "R", "O"), (9, 9, 7, "N", "F"), (12, 9, 7, "N", "O"), (15, 9, 7, "N", "O"), (21, 9, None, "R", "O"), (1, 5, 60, "N", "O")]
    ddl = "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_returnflag STRING, l_linestatus STRING"
    spark.createDataFrame(lines, ddl).write.parquet(str(tmp_path / "lineitem.parquet"))
    found = payloads.lineage_from_payload(given.lineage_pages(spark, str(tmp_path)))
    assert sorted(tuple(r) for r in found.collect()) == [
        ("source_catalog.r0.tbl_0_0", "DOWNSTREAM", 1, "s_7"),
        ("source_catalog.r0.tbl_0_0", "JOB", 1, "Customer#000000007"),
        ("source_catalog.r0.tbl_0_1", "DOWNSTREAM", 1, "s_7"),
        ("source_catalog.r0.tbl_0_1", "JOB", 1, ""),
        ("source_catalog.r0.tbl_0_1", "NOTEBOOK", 1, "/Users/u7/nb_u7"),
        ("source_catalog.r0.tbl_0_1", "UPSTREAM", 1, "s_7"),
        ("source_catalog.r1.tbl_5_1", "DOWNSTREAM", 1, "s_60"),
    ]
