"""Registered queries: every operator over the given tables, with plain scalar output columns."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from datetime import datetime, time
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from tablewarden import adapters as given
from tablewarden.adapters import CONFIG, DRIFT_CONFIG, SINCE
from tablewarden.functions.schedule import schedule_label
from tablewarden.operators import drift, freshness, hops, jobs as job_ops, lineage, rules, storage
from tablewarden.plans.metadata import MetadataAnalysis, run_metadata
from tablewarden.plans.optimization import OptimizationAnalysis
from tablewarden.plans.report import metadata_sections, optimization_sections, report_sections
from tablewarden.plans.sharing import Share, as_is, materialise, materialise_only
from tablewarden.sources import catalog, logs, payloads
from tablewarden.sources.files import landed_inventory, storage_detail
from tablewarden.state.store import (
    COLUMN_SNAPSHOT,
    RUNS,
    TABLE_SNAPSHOT,
    WatchStore,
    cut_lineage,
    lookback_start,
    previous_snapshot_date,
    shared_folder,
    snapshot_at,
)
from tablewarden.state.intervals import Intervals, digest_diff
from tablewarden.streaming.freshness import follow_history, last_write_state
from tablewarden.streaming.runs import follow_runs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    """Register under the function's name, without the suffix that sets it apart from an imported operator."""
    QUERIES[function.__name__.removesuffix("_query")] = function
    return function


def _text_dates(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.col(name).cast("string") for name in names})


def _joined(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.array_join(name, ", ") for name in names})


# --- snapshots and drift -------------------------------------------------------------------------


def _snapshots(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    curr, prev = given.current_orders(spark, sf), given.previous_orders(spark, sf)
    return given.order_tables(curr), given.order_tables(prev), given.order_columns(curr), given.order_columns(prev)


@query
def schema_diff(spark, sf):
    return drift.schema_diff(*_snapshots(spark, sf))


@query
def new_tables(spark, sf):
    curr, prev, _, _ = _snapshots(spark, sf)
    return drift.new_tables(curr, prev)


@query
def removed_tables(spark, sf):
    curr, prev, _, _ = _snapshots(spark, sf)
    return drift.removed_tables(curr, prev)


@query
def common_tables(spark, sf):
    curr, prev, _, _ = _snapshots(spark, sf)
    return drift.common_tables(curr, prev)


@query
def added_columns(spark, sf):
    curr_t, prev_t, curr, prev = _snapshots(spark, sf)
    return drift.added_columns(curr, prev, drift.common_tables(curr_t, prev_t))


@query
def removed_columns(spark, sf):
    curr_t, prev_t, curr, prev = _snapshots(spark, sf)
    return drift.removed_columns(curr, prev, drift.common_tables(curr_t, prev_t))


@query
def changed_columns(spark, sf):
    curr_t, prev_t, curr, prev = _snapshots(spark, sf)
    return drift.changed_columns(curr, prev, drift.common_tables(curr_t, prev_t))


@query
def table_inventory(spark, sf):
    return _text_dates(catalog.table_inventory(given.platform_tables(spark, sf), CONFIG.schemas), "created", "last_altered")


@query
def view_inventory(spark, sf):
    return _text_dates(catalog.view_inventory(given.platform_tables(spark, sf), CONFIG.schemas), "created", "last_altered")


@query
def table_snapshot(spark, sf):
    rows = catalog.current_table_snapshot(given.metadata_inputs(spark, sf)["tables"], DRIFT_CONFIG)
    return _text_dates(rows, "snapshot_date", "created", "last_altered")


@query
def column_snapshot(spark, sf):
    rows = catalog.current_column_snapshot(given.metadata_inputs(spark, sf)["columns"], DRIFT_CONFIG)
    return _text_dates(rows, "snapshot_date").withColumn("ordinal_position", F.col("ordinal_position").cast("bigint"))


@query
def base_tables(spark, sf):
    return catalog.base_tables(given.metadata_inputs(spark, sf)["tables"])


@query
def previous_snapshot_date_query(spark, sf):
    found = previous_snapshot_date(given.monthly_columns(spark, sf), given.STATE_AS_OF)
    return _text_dates(found, "prev_date")


@query
def snapshot_at_query(spark, sf):
    rows = snapshot_at(given.monthly_columns(spark, sf), given.STATE_AS_OF)
    return _text_dates(rows, "snapshot_date").withColumn("ordinal_position", F.col("ordinal_position").cast("bigint"))


def _fresh_store(spark: SparkSession) -> WatchStore:
    """A store of its own for this call, in the folder that all executors share."""
    name = f"tablewarden_{uuid.uuid4().hex[:12]}"
    store = WatchStore(spark, name, f"{shared_folder(spark).rstrip('/')}/{name}")
    store.ensure_tables()
    return store


def _read_and_drop(store: WatchStore, result: DataFrame) -> DataFrame:
    """The result kept in the shared folder, where Spark cleans up after itself; the store's own files go."""
    kept = cut_lineage(result)
    store.drop()
    return kept


@query
def snapshot_roundtrip(spark, sf):
    """Save all dates, save them again, apply retention, compact, read back both tables."""
    store = _fresh_store(spark)
    as_of = given.RETENTION_AS_OF
    for table, rows in ((COLUMN_SNAPSHOT, given.monthly_columns), (TABLE_SNAPSHOT, given.monthly_tables)):
        store.save_snapshot(rows(spark, sf), table)
        store.save_snapshot(snapshot_at(rows(spark, sf), as_of), table, as_of)
        store.apply_retention(table, as_of, CONFIG.retention_days)
        store.compact_snapshot(table, store.snapshot_dates(table))
    kept = store.table(COLUMN_SNAPSHOT).join(store.table(TABLE_SNAPSHOT), ["snapshot_date", *catalog.TABLE_KEY], "left")
    read = _text_dates(kept, "snapshot_date", "created", "last_altered").select(
        "snapshot_date", *catalog.COLUMN_KEY, "table_type", "data_source_format", "created", "last_altered",
        "full_data_type", "is_nullable", "col_comment", F.col("ordinal_position").cast("bigint").alias("ordinal_position"),
    )
    return _read_and_drop(store, read)


@query
def nightly_changes(spark, sf):
    """Three nights of the metadata run over one store: what each night's report counts, and the date it compares with."""
    store = _fresh_store(spark)
    nights: list[DataFrame] = []
    for day in given.NIGHTS:
        orders = given.orders_before(spark, sf, day)
        inputs = {"tables": given.order_tables(orders), "columns": given.order_columns(orders)}

        def report(analysis: MetadataAnalysis) -> None:
            kinds = F.count_if(F.col("change_type").isin("NEW TABLE", "REMOVED")), F.count_if(F.col("column_name").isNotNull())
            counted = analysis.diff.agg(kinds[0].alias("table_changes"), kinds[1].alias("column_changes"))
            dates = (F.lit(analysis.cfg.run_date), F.lit(analysis.compared_with).cast("date"))
            nights.append(cut_lineage(counted.select(dates[0].alias("run_date"), dates[1].alias("compared_with"), "*")))

        run_metadata(inputs, replace(DRIFT_CONFIG, as_of=datetime.combine(day, time())), store, report)
    store.drop()
    return _text_dates(reduce(DataFrame.unionByName, nights), "run_date", "compared_with")


def _interval_nights(spark: SparkSession, sf: str, store: WatchStore, *nights: tuple) -> tuple[Intervals, Intervals]:
    """Both relations with the catalogue of each night (day, orders) merged."""
    tables, columns = Intervals.of_tables(store), Intervals.of_columns(store)
    for day, orders in nights:
        for kept, rows in ((tables, given.order_tables(orders)), (columns, given.order_columns(orders).withColumnRenamed("comment", "col_comment"))):
            kept.ensure()
            kept.merge(rows, day)
    return tables, columns


@query
def interval_snapshots(spark, sf):
    """Three nights read back from intervals: two that differ and one without changes."""
    store = _fresh_store(spark)
    prev, curr = given.previous_orders(spark, sf), given.current_orders(spark, sf)
    nights = ((given.PREVIOUS_DATE, prev), (given.AS_OF.date(), curr), (given.NEXT_DATE, curr))
    tables, columns = _interval_nights(spark, sf, store, *nights)
    days = [columns.at(day).join(tables.at(day).drop("created", "last_altered"), catalog.TABLE_KEY).withColumn("snapshot_date", F.lit(day)) for day, _ in nights]
    read = _text_dates(reduce(DataFrame.unionByName, days), "snapshot_date").withColumn("ordinal_position", F.col("ordinal_position").cast("bigint"))
    return _read_and_drop(store, read)


@query
def schema_diff_by_digest(spark, sf):
    """The diff of two nights from the buckets whose digests differ."""
    store = _fresh_store(spark)
    tables, columns = _interval_nights(spark, sf, store, (given.PREVIOUS_DATE, given.previous_orders(spark, sf)))
    curr = given.current_orders(spark, sf)
    found = digest_diff(tables, columns, given.order_tables(curr), given.order_columns(curr).withColumnRenamed("comment", "col_comment"), given.AS_OF.date())
    return _read_and_drop(store, found)


# --- storage -------------------------------------------------------------------------------------


def _storage(spark: SparkSession, sf: str) -> DataFrame:
    return storage_detail(given.files(spark, sf), given.table_props(spark, sf))


@query
def storage_detail_query(spark, sf):
    return _joined(_storage(spark, sf), "partition_columns", "clustering_columns")


@query
def file_inventory(spark, sf):
    return _text_dates(landed_inventory(given.listings(spark, sf), given.LAKE), "modified")


@query
def small_files(spark, sf):
    return storage.small_files(_storage(spark, sf), CONFIG)


@query
def unclustered(spark, sf):
    return _joined(storage.unclustered(_storage(spark, sf), CONFIG), "partition_columns")


@query
def recommend_clustering(spark, sf):
    found = storage.recommend_clustering(_storage(spark, sf), given.storage_columns(spark, sf), CONFIG)
    return _joined(found, "partition_columns", "rec_cols")


@query
def stale_tables(spark, sf):
    inventory = catalog.table_inventory(given.platform_tables(spark, sf), CONFIG.schemas)
    detail = storage.table_detail(inventory, _storage(spark, sf))
    found = storage.stale_tables(detail, CONFIG)
    return _text_dates(found.select(*catalog.TABLE_KEY, "size_mb", "last_altered", "has_detail"), "last_altered")


@query
def stale_views(spark, sf):
    found = storage.stale_views(catalog.view_inventory(given.platform_tables(spark, sf), CONFIG.schemas), CONFIG)
    return _text_dates(found.select(*catalog.TABLE_KEY, "table_type", "last_altered"), "last_altered")


# --- jobs ----------------------------------------------------------------------------------------


def _latest(spark: SparkSession, sf: str) -> DataFrame:
    return job_ops.latest_runs(given.runs(spark, sf), CONFIG.runs_per_job)


def _summary(spark: SparkSession, sf: str) -> DataFrame:
    return job_ops.job_summary(given.jobs(spark, sf), job_ops.run_stats(_latest(spark, sf)), CONFIG)


@query
def jobs_from_payload(spark, sf):
    return payloads.jobs_from_payload(given.job_pages(spark, sf), CONFIG.excluded_jobs)


@query
def runs_from_payload(spark, sf):
    return payloads.runs_from_payload(given.run_pages(spark, sf))


@query
def latest_runs(spark, sf):
    return _latest(spark, sf)


@query
def run_stats(spark, sf):
    return job_ops.run_stats(_latest(spark, sf))


@query
def job_summary(spark, sf):
    return _summary(spark, sf)


@query
def long_running_jobs(spark, sf):
    return job_ops.long_running_jobs(_summary(spark, sf), CONFIG)


@query
def failing_jobs(spark, sf):
    return job_ops.failing_jobs(_summary(spark, sf), CONFIG)


@query
def stale_jobs(spark, sf):
    return job_ops.stale_jobs(_summary(spark, sf), CONFIG)


@query
def period_failures(spark, sf):
    return job_ops.period_failures(given.runs(spark, sf), given.jobs(spark, sf), CONFIG, SINCE)


@query
def streamed_period_failures(spark, sf):
    """Failures from runs that landed in two nights, the first with open runs, the second with some delivered again."""
    store = _fresh_store(spark)
    landing, offsets = f"{store.location}/landing", f"{store.location}/offsets"
    for night in given.run_nights(spark, sf):
        night.write.mode("append").parquet(landing)
        # Twice: the second call starts from the checkpoint and finds nothing new.
        for _ in range(2):
            follow_runs(spark, landing, offsets, store.database, store.location)
    found = job_ops.period_failures(store.fresh(RUNS).drop("run_day"), given.jobs(spark, sf), CONFIG, SINCE)
    return _read_and_drop(store, found)


@query
def rejected_documents(spark, sf):
    return payloads.rejected_documents(given.damaged_run_pages(spark, sf), "runs").groupBy("source", "key", "reason").agg(F.count(F.lit(1)).alias("documents"))


@query
def landing_totals(spark, sf):
    return payloads.landing_totals(given.damaged_run_pages(spark, sf), "runs")


@query
def schedule_labels(spark, sf):
    return given.jobs(spark, sf).select("job_id", "schedule", schedule_label(F.col("schedule")).alias("label"))


@query
def cost_estimate(spark, sf):
    return job_ops.cost_estimate(_summary(spark, sf), CONFIG)


@query
def lookback_start_query(spark, sf):
    runs_on = given.runs(spark, sf).select(
        F.to_date(job_ops.et_label(F.col("start_time"), CONFIG).substr(1, 10)).alias("run_date")
    )
    return _text_dates(lookback_start(runs_on, CONFIG.run_date), "lookback_start")


# --- freshness -----------------------------------------------------------------------------------


@query
def recent_history(spark, sf):
    rows = logs.recent_history(given.history(spark, sf), CONFIG.history_depth)
    shown = rows.withColumn("rows_written", freshness.rows_written(F.col("operation_metrics")))
    return _text_dates(shown.drop("operation_metrics"), "timestamp")


@query
def data_freshness(spark, sf):
    base = catalog.base_tables(given.history_tables(spark, sf))
    return freshness.data_freshness(given.history(spark, sf), base, CONFIG)


@query
def streamed_freshness(spark, sf):
    """The same findings from state that took over the log in three landings, with late and repeated entries."""
    store = _fresh_store(spark)
    landing, offsets = f"{store.location}/landing", f"{store.location}/offsets"
    for night in given.history_nights(spark, sf):
        night.write.mode("append").parquet(landing)
        follow_history(spark, landing, offsets, store.database, store.location)
    base = catalog.base_tables(given.history_tables(spark, sf))
    return _read_and_drop(store, freshness.stale_writes(last_write_state(store), base, CONFIG))


# --- rules ---------------------------------------------------------------------------------------


@query
def raw_table_violations(spark, sf):
    return rules.raw_table_violations(given.part_tables(spark, sf), CONFIG)


@query
def raw_column_violations(spark, sf):
    return rules.raw_column_violations(given.part_columns(spark, sf), CONFIG)


@query
def transform_name_violations(spark, sf):
    return rules.transform_name_violations(given.part_tables(spark, sf), CONFIG)


@query
def view_governance_violations(spark, sf):
    return rules.view_governance_violations(given.views(spark, sf), CONFIG)


# Listings are cut in the report sections only: the rules have no limit, under either name.
for _name in ("raw_column_violations", "transform_name_violations", "view_governance_violations"):
    QUERIES[f"{_name}_all"] = QUERIES[_name]


# --- lineage -------------------------------------------------------------------------------------


@query
def lineage_from_payload(spark, sf):
    return payloads.lineage_from_payload(given.lineage_pages(spark, sf))


@query
def latest_audit(spark, sf):
    return _text_dates(lineage.latest_audit(given.audit(spark, sf)), "event_time")


@query
def workspace_paths(spark, sf):
    return logs.workspace_paths(given.workspace_listing(spark, sf))


@query
def resolve_notebooks(spark, sf):
    return lineage.resolve_notebooks(given.user_ids(spark, sf), given.audit(spark, sf), given.workspace_listing(spark, sf))


@query
def unresolved_notebooks(spark, sf):
    return lineage.unresolved_ids(given.user_ids(spark, sf), resolve_notebooks(spark, sf))


@query
def resolve_jobs(spark, sf):
    ids = given.access_edges(spark, sf).filter(F.col("entity_type") == "JOB")
    return lineage.resolve_jobs(ids, given.jobs(spark, sf))


# --- the two analyses ----------------------------------------------------------------------------


def _optimization(spark: SparkSession, sf: str, share: Share = as_is) -> OptimizationAnalysis:
    return OptimizationAnalysis(given.optimization_inputs(spark, sf), CONFIG, SINCE, share)


# What the queries below read more than once.
_ACCESS_READS = materialise_only("change_summary")
_LINEAGE_READS = materialise_only("change_summary", "access")
_DASHBOARD_READS = materialise_only("diff", "governance", "change_summary", "access")


def _metadata(spark: SparkSession, sf: str, share: Share = as_is) -> MetadataAnalysis:
    inputs = given.metadata_inputs(spark, sf)
    return MetadataAnalysis(
        inputs,
        catalog.current_table_snapshot(inputs["tables"], DRIFT_CONFIG),
        catalog.current_column_snapshot(inputs["columns"], DRIFT_CONFIG),
        inputs["prev_tables"],
        inputs["prev_columns"],
        DRIFT_CONFIG,
        share,
        given.PREVIOUS_DATE,
    )


@query
def platform_totals(spark, sf):
    return _optimization(spark, sf).totals


@query
def optimization_dashboard(spark, sf):
    return _optimization(spark, sf).dashboard


@query
def run_summary(spark, sf):
    return _optimization(spark, sf).run_summary


@query
def tracker_roundtrip(spark, sf):
    """Write the run summary to the tracker as JSON, twice for one date, and read it back."""
    store = _fresh_store(spark)
    for _ in range(2):
        store.save_tracker(_optimization(spark, sf).run_summary, CONFIG)
    return _read_and_drop(store, store.tracker_history().drop("created_at"))


@query
def change_log(spark, sf):
    return _metadata(spark, sf).changes


@query
def change_summary(spark, sf):
    return _metadata(spark, sf).change_summary


@query
def change_totals(spark, sf):
    return _metadata(spark, sf).totals


@query
def access_lineage(spark, sf):
    return _metadata(spark, sf, _ACCESS_READS).access


@query
def merge_lineage(spark, sf):
    return _metadata(spark, sf, _LINEAGE_READS).lineage


@query
def impact_risk(spark, sf):
    return _metadata(spark, sf, _LINEAGE_READS).impact


def _hops(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    summary = _metadata(spark, sf, _ACCESS_READS).change_summary
    edges = hops.downstream_edges(payloads.lineage_from_payload(given.table_pages(spark, sf)))
    return summary, hops.downstream_hops(edges, summary)


@query
def downstream_hops(spark, sf):
    return _hops(spark, sf)[1]


@query
def impact_depth(spark, sf):
    return hops.impact_depth(*_hops(spark, sf))


@query
def affected_assets(spark, sf):
    return _metadata(spark, sf, _LINEAGE_READS).affected_assets


@query
def affected_distinct(spark, sf):
    return _metadata(spark, sf, _LINEAGE_READS).affected_distinct


@query
def metadata_dashboard(spark, sf):
    return _text_dates(_metadata(spark, sf, _DASHBOARD_READS).dashboard, "compared_with")


@query
def report_sections_optimization(spark, sf):
    name = F.concat_ws(".", "table_schema", "table_name")
    items = {
        "small_files": name,
        "optimize_commands": F.col("cmd"),
        "unclustered": name,
        "cluster_commands": F.col("cmd"),
        "period_failures": F.col("job_name"),
        "stale_tables": name,
        "stale_views": name,
        "stale_jobs": F.col("job_name"),
    }
    notes = {
        "small_files": F.col("severity"),
        "optimize_commands": F.col("fqn"),
        "unclustered": F.col("rec_cols"),
        "cluster_commands": F.col("fqn"),
        "period_failures": F.concat_ws(" | ", "date", F.col("run_id").cast("string"), "error"),
        "stale_tables": F.col("last_altered"),
        "stale_views": F.col("last_altered"),
        "stale_jobs": F.concat_ws(" | ", "schedule_label", "last_run"),
    }
    analysis = _optimization(spark, sf, materialise)
    return report_sections(optimization_sections(analysis, items), items, notes)


@query
def report_sections_metadata(spark, sf):
    items = {
        "stale_data": F.concat_ws(".", "table_schema", "table_name"),
        "raw_columns": F.concat_ws(".", "table_name", "column_name"),
        "transform_names": F.col("table_name"),
        "governance": F.col("table_name"),
    }
    notes = {
        "stale_data": F.concat_ws(
            " | ", "last_write", "last_op", "rows_written", F.col("days_since").cast("string"), "severity"
        ),
        "raw_columns": F.col("issue"),
        "transform_names": F.concat_ws(" | ", "table_type", "issue"),
        "governance": F.col("definition_preview"),
    }
    return report_sections(metadata_sections(_metadata(spark, sf), items), items, notes)
