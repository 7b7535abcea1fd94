"""Metadata-change analysis: drift, rules, freshness, lineage and impact."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import date
from functools import cached_property

from pyspark.sql import DataFrame, functions as F

from tablewarden.config import WatchConfig
from tablewarden.operators import drift, freshness, lineage as lineage_ops, rules, summary as totals
from tablewarden.operators.joins import keep_keys
from tablewarden.operators.topk import top_n
from tablewarden.plans.sharing import Share, as_is, materialise
from tablewarden.sources import catalog
from tablewarden.sources.logs import access_lineage
from tablewarden.sources.payloads import lineage_from_payload
from tablewarden.state.intervals import Intervals
from tablewarden.state.store import COLUMN_SNAPSHOT, TABLE_SNAPSHOT, WatchStore, cut_lineage, snapshot_at


@dataclass(frozen=True)
class MetadataAnalysis:
    """The sections as DataFrames, each built when it is first asked for.

    ``inputs``: views, history, access_lineage, lineage_payload, audit, workspace_listing, jobs. Without a
    previous snapshot this is a baseline run, whose schema diff is empty. ``share`` materialises what
    several sections read; without it everything stays lazy.
    """

    inputs: Mapping[str, DataFrame]
    curr_tables: DataFrame
    curr_columns: DataFrame
    prev_tables: DataFrame | None
    prev_columns: DataFrame | None
    cfg: WatchConfig
    share: Share = as_is
    compared_with: date | None = None

    # --- changes ---

    @cached_property
    def diff(self) -> DataFrame:
        if self.prev_tables is None or self.prev_columns is None:
            same = drift.schema_diff(self.curr_tables, self.curr_tables, self.curr_columns, self.curr_columns)
            return same.filter(F.lit(False))
        diff = drift.schema_diff(self.curr_tables, self.prev_tables, self.curr_columns, self.prev_columns)
        return self.share("diff", diff)

    def of_kind(self, kind: str) -> DataFrame:
        return self.diff.filter(F.col("change_type") == kind)

    @cached_property
    def raw_tables(self) -> DataFrame:
        return rules.raw_table_violations(self.curr_tables, self.cfg)

    @cached_property
    def raw_columns(self) -> DataFrame:
        return rules.raw_column_violations(self.curr_columns, self.cfg)

    @cached_property
    def transform_names(self) -> DataFrame:
        return rules.transform_name_violations(self.curr_tables, self.cfg)

    @cached_property
    def governance(self) -> DataFrame:
        # The definitions are the widest text of all inputs: read once.
        found = rules.view_governance_violations(self.inputs["views"], self.cfg)
        return self.share("governance", found)

    @cached_property
    def changes(self) -> DataFrame:
        return drift.change_log(self.diff, self.raw_tables, self.transform_names, self.governance, self.cfg)

    @cached_property
    def change_summary(self) -> DataFrame:
        return self.share("change_summary", drift.change_summary(self.changes))

    # --- freshness ---

    @cached_property
    def stale_data(self) -> DataFrame:
        base = catalog.base_tables(self.curr_tables)
        found = freshness.data_freshness(self.inputs["history"], base, self.cfg)
        return top_n(found, freshness.freshness_order())

    # --- lineage of the changed tables ---

    @cached_property
    def access(self) -> DataFrame:
        return self.share("access", access_lineage(self.inputs["access_lineage"], self.change_summary, self.cfg))

    @cached_property
    def lineage(self) -> DataFrame:
        changed = self.change_summary.select(F.col("fqn").alias("table_name"))
        # A catalogue may have millions of changed tables: they are not copied for the join.
        payload = lineage_from_payload(keep_keys(self.inputs["lineage_payload"], changed, "table_name"), mark_rejected=True)
        notebook_ids = self.access.filter(F.col("entity_type") == "NOTEBOOK")
        notebooks = lineage_ops.resolve_notebooks(notebook_ids, self.inputs["audit"], self.inputs["workspace_listing"])
        jobs = lineage_ops.resolve_jobs(self.access.filter(F.col("entity_type") == "JOB"), self.inputs["jobs"])
        named = lineage_ops.name_access(self.access, notebooks, jobs)
        return self.share("lineage", lineage_ops.merge_lineage(payload, named))

    @cached_property
    def impact(self) -> DataFrame:
        return lineage_ops.rated_impact(self.change_summary, self.lineage)

    @cached_property
    def affected_assets(self) -> DataFrame:
        return lineage_ops.affected_assets(self.lineage)

    @cached_property
    def affected_distinct(self) -> DataFrame:
        return lineage_ops.affected_distinct(self.lineage)

    @cached_property
    def rejected_assets(self) -> DataFrame:
        return lineage_ops.rejected_assets(self.lineage)

    # --- totals ---

    @cached_property
    def counters(self) -> DataFrame:
        return totals.change_counters(
            self.diff, self.raw_tables, self.raw_columns, self.transform_names, self.governance
        )

    @cached_property
    def totals(self) -> DataFrame:
        return totals.change_totals(self.counters)

    @cached_property
    def dashboard(self) -> DataFrame:
        return totals.metadata_dashboard(self.counters, self.affected_assets, self.rejected_assets, self.stale_data, self.compared_with)


def run_metadata(
    inputs: Mapping[str, DataFrame],
    cfg: WatchConfig,
    store: WatchStore,
    report: Callable[[MetadataAnalysis], object],
    intervals: bool = False,
) -> MetadataAnalysis:
    """One nightly run: stage today's snapshot, compare it with the greatest earlier date, report, publish, retain.

    ``report`` reads the sections. Today's date is published only after it, so a night that fails leaves the earlier date
    to compare with, and its changes are reported the next time. The catalogue is read once: what is compared is the
    staged copy in the shared folder, and the same rows are saved. With ``intervals`` they are also merged into the validity
    intervals, which keep a row once for as long as it stays the same.
    """
    store.ensure_tables()
    today = cfg.run_date
    previous = store.previous_date(today)
    staged = {
        COLUMN_SNAPSHOT: cut_lineage(catalog.current_column_snapshot(inputs["columns"], cfg)),
        TABLE_SNAPSHOT: cut_lineage(catalog.current_table_snapshot(inputs["tables"], cfg)),
    }

    def stored(table: str) -> DataFrame | None:
        return None if previous is None else snapshot_at(store.table(table), previous)

    analysis = MetadataAnalysis(
        inputs,
        staged[TABLE_SNAPSHOT],
        staged[COLUMN_SNAPSHOT],
        stored(TABLE_SNAPSHOT),
        stored(COLUMN_SNAPSHOT),
        cfg,
        share=materialise,
        compared_with=previous,
    )
    # The diff is the only section that reads the earlier date: it is taken before that date may go.
    _ = analysis.diff
    report(analysis)
    # The table snapshot, whose dates tell the earlier runs, comes last.
    for table, rows in staged.items():
        store.save_snapshot(rows, table, today)
        store.compact_snapshot(table, store.fragmented_dates(table, [today]))
    for table in staged:
        store.apply_retention(table, today, cfg.retention_days)
    if intervals:
        for kept, table in ((Intervals.of_columns(store), COLUMN_SNAPSHOT), (Intervals.of_tables(store), TABLE_SNAPSHOT)):
            kept.ensure()
            kept.merge(staged[table], today)
            kept.apply_retention(today, cfg.retention_days)
    return analysis
