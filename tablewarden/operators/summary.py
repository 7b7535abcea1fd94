"""One-row totals and dashboards.

Every relation is read once for all of its counters; the one-row results are stacked and folded, which
needs neither a cross join nor a value on the driver.
"""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tablewarden.config import WatchConfig
from tablewarden.operators.jobs import (
    failing_rule,
    long_running_rule,
    monthly_cost,
    stale_job_rule,
    tenths,
)
from tablewarden.operators.storage import small_file_rule, stale_rule, unclustered_rule
from tablewarden.schemas import RUN_SUMMARY


def one_row(*parts: DataFrame) -> DataFrame:
    """Side-by-side columns of one-row relations with distinct column names."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def _count_where(rule: Column) -> Column:
    return F.count_if(F.coalesce(rule, F.lit(False)))


def storage_counters(detail: DataFrame, cfg: WatchConfig) -> DataFrame:
    """Counters over the tables whose storage detail is known."""
    hundredths = F.coalesce(F.sum(F.col("size_mb").cast("decimal(24,2)")), F.lit(0).cast("decimal(34,2)"))
    return detail.filter(F.col("has_detail")).agg(
        F.count(F.lit(1)).alias("tables_analyzed"),
        (hundredths.cast("double") / 1024).alias("total_gb"),
        _count_where(small_file_rule()).alias("small_file_tables"),
        _count_where(unclustered_rule(detail, cfg)).alias("missing_cluster"),
        _count_where(stale_rule(detail, cfg)).alias("stale_tables"),
    )


def view_counters(views: DataFrame, cfg: WatchConfig) -> DataFrame:
    return views.agg(
        F.count(F.lit(1)).alias("views_analyzed"), _count_where(stale_rule(views, cfg)).alias("stale_views")
    )


def job_counters(summary: DataFrame, cfg: WatchConfig) -> DataFrame:
    long_min = F.when(long_running_rule(cfg), F.col("avg_min"))
    totals = summary.withColumn("long_min", long_min).agg(
        F.count(F.lit(1)).alias("jobs_analyzed"),
        _count_where(long_running_rule(cfg)).alias("long_running_jobs"),
        _count_where(failing_rule(cfg)).alias("failing_jobs"),
        _count_where(stale_job_rule(cfg)).alias("stale_jobs"),
        tenths("avg_min").alias("all_min"),
        tenths("long_min").alias("slow_min"),
    )
    return totals.select(
        "jobs_analyzed", "long_running_jobs", "failing_jobs", "stale_jobs",
        monthly_cost(F.col("all_min"), cfg).alias("est_monthly_cost"),
        monthly_cost(F.col("slow_min"), cfg, cfg.savings_share).alias("est_savings"),
    )


def optimization_counters(
    detail: DataFrame, views: DataFrame, summary: DataFrame, failures: DataFrame, cfg: WatchConfig
) -> DataFrame:
    """All counters of the optimisation analysis in one row."""
    return one_row(
        storage_counters(detail, cfg),
        view_counters(views, cfg),
        job_counters(summary, cfg),
        failures.agg(F.count(F.lit(1)).alias("period_failures")),
    )


def platform_totals(counters: DataFrame) -> DataFrame:
    issues = F.col("small_file_tables") + F.col("missing_cluster") + F.col("failing_jobs")
    return counters.select(
        F.col("tables_analyzed").alias("tables"),
        "total_gb",
        F.col("views_analyzed").alias("views"),
        F.col("jobs_analyzed").alias("jobs"),
        issues.alias("issues"),
    )


def run_summary(counters: DataFrame, run_date: date) -> DataFrame:
    """The fourteen fields kept by the run tracker."""
    dated = counters.withColumn("run_date", F.lit(run_date.isoformat()))
    return dated.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in RUN_SUMMARY.fields])


def optimization_dashboard(counters: DataFrame) -> DataFrame:
    return counters.select("small_file_tables", "missing_cluster", "failing_jobs", "period_failures", "est_savings")


def change_counters(
    diff: DataFrame, raw_names: DataFrame, raw_columns: DataFrame, transform_names: DataFrame, governance: DataFrame
) -> DataFrame:
    """Counts by kind of change and the two totals; all inputs without listing limits."""
    kinds = {
        "new_tables": "NEW TABLE",
        "removed_tables": "REMOVED",
        "cols_added": "COL ADDED",
        "cols_removed": "COL REMOVED",
        "cols_changed": "TYPE CHANGE",
    }
    by_kind = diff.agg(
        *[F.count_if(F.col("change_type") == kind).alias(name) for name, kind in kinds.items()],
        F.count(F.lit(1)).alias("schema_changes"),
    )
    rules = {
        "raw_table_issues": raw_names,
        "raw_column_issues": raw_columns,
        "transform_issues": transform_names,
        "governance_issues": governance,
    }
    counts = one_row(by_kind, *[rows.agg(F.count(F.lit(1)).alias(name)) for name, rows in rules.items()])
    return counts.withColumn("standards_issues", sum((F.col(name) for name in rules), F.lit(0).cast("bigint")))


def change_totals(counters: DataFrame) -> DataFrame:
    return counters.select("schema_changes", "standards_issues")


def metadata_dashboard(
    counters: DataFrame, assets: DataFrame, rejected: DataFrame, stale: DataFrame, compared_with: date | None
) -> DataFrame:
    """The cards, the number of documents that could not be read, and the date compared with: null on a first run, which then differs from a night without changes."""
    cards = one_row(counters, assets, rejected, stale.agg(F.count(F.lit(1)).alias("stale_tables")))
    return cards.select(
        "new_tables",
        "removed_tables",
        "cols_added",
        (F.col("cols_removed") + F.col("cols_changed")).alias("cols_modified"),
        "standards_issues",
        "affected_assets",
        "stale_tables",
        "rejected_documents",
        F.lit(compared_with).cast("date").alias("compared_with"),
    )
