"""Optimisation analysis: storage, jobs, stale assets, cost."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import date
from functools import cached_property

from pyspark.sql import DataFrame, functions as F

from tablewarden.config import WatchConfig
from tablewarden.operators import jobs as job_ops, storage as storage_ops, summary as totals
from tablewarden.operators.topk import top_n
from tablewarden.plans.sharing import Share, as_is, materialise
from tablewarden.sources.catalog import table_inventory, view_inventory
from tablewarden.sources.files import storage_detail
from tablewarden.state.store import WatchStore


@dataclass(frozen=True)
class OptimizationAnalysis:
    """The sections as lazy DataFrames, each built when it is first asked for.

    ``inputs``: tables, columns, files, table_props, jobs, runs. ``share`` materialises what many sections
    read: the table detail and the latest runs, both reduced to a bounded number of rows per key. Findings
    are ordered here, not in the operators: a count or a top-n over them drops the sort.
    """

    inputs: Mapping[str, DataFrame]
    cfg: WatchConfig
    since: date
    share: Share = as_is

    @cached_property
    def views(self) -> DataFrame:
        return view_inventory(self.inputs["tables"], self.cfg.schemas)

    @cached_property
    def detail(self) -> DataFrame:
        inventory = table_inventory(self.inputs["tables"], self.cfg.schemas)
        # Filtered here, since a filter above the full outer join would not reach the file inventory.
        watched = F.col("table_schema").isin(*self.cfg.schemas)
        stored = storage_detail(self.inputs["files"].filter(watched), self.inputs["table_props"].filter(watched))
        return self.share("detail", storage_ops.table_detail(inventory, stored))

    @cached_property
    def latest_runs(self) -> DataFrame:
        return self.share("latest_runs", job_ops.latest_runs(self.inputs["runs"], self.cfg.runs_per_job))

    @cached_property
    def job_summary(self) -> DataFrame:
        return job_ops.job_summary(self.inputs["jobs"], job_ops.run_stats(self.latest_runs), self.cfg)

    @cached_property
    def small_files(self) -> DataFrame:
        return top_n(storage_ops.small_files(self.detail, self.cfg), storage_ops.small_file_order())

    @cached_property
    def unclustered(self) -> DataFrame:
        found = storage_ops.recommend_clustering(self.detail, self.inputs["columns"], self.cfg)
        return top_n(found, storage_ops.unclustered_order())

    @cached_property
    def long_running(self) -> DataFrame:
        return top_n(job_ops.long_running_jobs(self.job_summary, self.cfg), job_ops.long_running_order())

    @cached_property
    def failing(self) -> DataFrame:
        return top_n(job_ops.failing_jobs(self.job_summary, self.cfg), job_ops.failing_order())

    @cached_property
    def period_failures(self) -> DataFrame:
        return job_ops.period_failures(self.inputs["runs"], self.inputs["jobs"], self.cfg, self.since)

    @cached_property
    def stale_tables(self) -> DataFrame:
        return storage_ops.stale_tables(self.detail, self.cfg)

    @cached_property
    def stale_views(self) -> DataFrame:
        return storage_ops.stale_views(self.views, self.cfg)

    @cached_property
    def stale_jobs(self) -> DataFrame:
        return job_ops.stale_jobs(self.job_summary, self.cfg)

    @cached_property
    def cost(self) -> DataFrame:
        return job_ops.cost_estimate(self.job_summary, self.cfg)

    @cached_property
    def counters(self) -> DataFrame:
        return totals.optimization_counters(
            self.detail, self.views, self.job_summary, self.period_failures, self.cfg
        )

    @cached_property
    def totals(self) -> DataFrame:
        return totals.platform_totals(self.counters)

    @cached_property
    def dashboard(self) -> DataFrame:
        return totals.optimization_dashboard(self.counters)

    @cached_property
    def run_summary(self) -> DataFrame:
        return totals.run_summary(self.counters, self.cfg.run_date)


def run_optimization(
    inputs: Mapping[str, DataFrame], cfg: WatchConfig, store: WatchStore, report: Callable[[OptimizationAnalysis], object]
) -> OptimizationAnalysis:
    """One nightly run: look back to the last one, analyse, report, and record the run as the last step.

    ``report`` reads the sections. If it fails the run is not recorded, so the next one looks back as far.
    """
    store.ensure_tables()
    since = store.lookback_start(cfg.run_date)
    analysis = OptimizationAnalysis(inputs, cfg, since, share=materialise)
    report(analysis)
    store.save_tracker(analysis.run_summary, cfg)
    return analysis
