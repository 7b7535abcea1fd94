"""Run statistics, slow, failing and stale jobs, recent failures, cost."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from tablewarden.config import WatchConfig
from tablewarden.functions.schedule import schedule_label
from tablewarden.functions.times import et_label, run_minutes, run_ms
from tablewarden.operators.topk import latest_per_key

MS_PER_DAY = 86_400_000


def latest_runs(runs: DataFrame, depth: int = 25) -> DataFrame:
    """Newest runs of every job; all job figures are taken over these."""
    return latest_per_key(runs, ["job_id"], [F.col("start_time").desc(), F.col("run_id").desc()], depth)


def _failed() -> Column:
    return F.coalesce(F.col("result_state") == "FAILED", F.lit(False))


def run_stats(latest: DataFrame) -> DataFrame:
    """Per job, over the runs given: average and longest minutes, failure rate, last start."""
    spent = run_ms(F.col("start_time"), F.col("end_time"))
    # Milliseconds are summed as integers: the result does not depend on the order of the runs.
    totals = latest.groupBy("job_id").agg(
        F.count(F.lit(1)).alias("n_runs"),
        F.count_if(_failed()).alias("n_failed"),
        F.sum(spent).alias("total_ms"),
        F.max(spent).alias("longest_ms"),
        F.max("start_time").alias("last_ts"),
    )
    return totals.select(
        "job_id",
        F.bround(F.col("total_ms") / F.lit(60000.0) / F.col("n_runs"), 1).alias("avg_min"),
        F.bround(F.col("longest_ms") / F.lit(60000.0), 1).alias("max_min"),
        F.bround(F.col("n_failed") / F.col("n_runs") * 100, 1).alias("fail_rate"),
        "n_failed",
        "n_runs",
        "last_ts",
    )


def job_summary(jobs: DataFrame, stats: DataFrame, cfg: WatchConfig) -> DataFrame:
    """Every job with its figures; a job that never ran has zeros and "Never"."""
    joined = jobs.join(stats, "job_id", "left")
    ever_ran = F.coalesce("last_ts", F.lit(0)) > 0
    return joined.select(
        "job_id",
        F.col("name").alias("job_name"),
        "schedule",
        schedule_label(F.col("schedule")).alias("schedule_label"),
        *[F.coalesce(c, F.lit(0.0)).alias(c) for c in ("avg_min", "max_min", "fail_rate")],
        *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n_failed", "n_runs", "last_ts")],
        F.when(ever_ran, et_label(F.col("last_ts"), cfg)).otherwise("Never").alias("last_run"),
    )


def long_running_rule(cfg: WatchConfig) -> Column:
    return F.col("avg_min") > cfg.long_running_min


def failing_rule(cfg: WatchConfig) -> Column:
    return F.col("fail_rate") > cfg.failing_rate


def stale_job_rule(cfg: WatchConfig) -> Column:
    # A job that never ran has last_ts 0, which lies before any cut-off.
    return F.col("last_ts") < F.lit(cfg.as_of_ms - cfg.stale_asset_days * MS_PER_DAY)


def long_running_jobs(summary: DataFrame, cfg: WatchConfig) -> DataFrame:
    return summary.filter(long_running_rule(cfg))


def long_running_order() -> list[Column]:
    """Longest first."""
    return [F.col("avg_min").desc(), F.col("job_id")]


def failing_jobs(summary: DataFrame, cfg: WatchConfig) -> DataFrame:
    ratio = F.concat_ws("/", F.col("n_failed").cast("string"), F.col("n_runs").cast("string"))
    return summary.filter(failing_rule(cfg)).withColumn("failed_of_total", ratio)


def failing_order() -> list[Column]:
    """Worst rate first."""
    return [F.col("fail_rate").desc(), F.col("job_id")]


def stale_jobs(summary: DataFrame, cfg: WatchConfig) -> DataFrame:
    return summary.filter(stale_job_rule(cfg))


def failure_rule(cfg: WatchConfig, since: date) -> Column:
    return _failed() & (F.col("start_time") >= F.lit(cfg.midnight_ms(since)))


def period_failures(runs: DataFrame, jobs: DataFrame, cfg: WatchConfig, since: date) -> DataFrame:
    """All failed runs of known jobs that started on or after local midnight of ``since``, with their whole message."""
    failures = runs.filter(failure_rule(cfg, since)).select(
        "job_id",
        "run_id",
        "start_time",
        F.coalesce("state_message", F.lit("")).alias("error"),
        F.coalesce("run_page_url", F.lit("")).alias("url"),
        F.bround(run_minutes(F.col("start_time"), F.col("end_time")), 1).alias("duration"),
        et_label(F.col("start_time"), cfg).alias("date"),
    )
    # Joined without copies of the jobs: a few jobs are broadcast as they are, many are exchanged, where AQE splits a job with most of
    # the failures.
    return failures.join(jobs.select("job_id", F.col("name").alias("job_name")), "job_id")


def tenths(column: str) -> Column:
    """Sum of one-decimal numbers as exact decimals, so that it does not depend on the order of the rows."""
    return F.coalesce(F.sum(F.col(column).cast("decimal(18,1)")), F.lit(0).cast("decimal(28,1)")).cast("double")


def monthly_cost(daily_minutes: Column, cfg: WatchConfig, share: float | None = None) -> Column:
    minutes = daily_minutes if share is None else daily_minutes * F.lit(share)
    return F.bround(minutes * cfg.days_per_month * F.lit(cfg.price_per_hour) / 60, 2)


def cost_estimate(summary: DataFrame, cfg: WatchConfig) -> DataFrame:
    """One row: monthly cost of one daily run of every job, and savings on the long-running ones."""
    totals = summary.select(
        "avg_min", F.when(long_running_rule(cfg), F.col("avg_min")).alias("long_min")
    ).agg(tenths("avg_min").alias("all_min"), tenths("long_min").alias("long_min"))
    return totals.select(
        monthly_cost(F.col("all_min"), cfg).alias("est_monthly_cost"),
        monthly_cost(F.col("long_min"), cfg, cfg.savings_share).alias("est_savings"),
    )
