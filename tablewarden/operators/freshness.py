"""Age of the last data write of every table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tablewarden.config import WRITE_OPERATIONS, WatchConfig
from tablewarden.functions.labels import NO_VALUE, freshness_severity, rows_written
from tablewarden.functions.storage import fqn
from tablewarden.functions.times import age_days, local_wall_clock, minute_label
from tablewarden.sources.catalog import TABLE_KEY

NEVER_WRITTEN_DAYS = 9999


def newest_of(writes: DataFrame) -> DataFrame:
    """Of rows (table, version, timestamp, last_op, rows_written) the newest of every table; a null version is no write."""
    entry = F.struct("version", "timestamp", "last_op", "rows_written")
    return writes.groupBy(*TABLE_KEY).agg(F.max_by(entry, "version").alias("write")).select(*TABLE_KEY, "write.*")


def newest_writes(history: DataFrame) -> DataFrame:
    """Newest write of every table with a history; null columns when no entry is a write.

    One partial aggregate over the whole log: a table with very many entries sends a row per map task. The result is the
    same over any split of the log, so it can be kept and added to (``streaming.freshness``).
    """
    is_write = F.upper(F.coalesce("operation", F.lit(""))).isin(*WRITE_OPERATIONS)
    return newest_of(
        history.select(
            *TABLE_KEY,
            F.when(is_write, F.col("version")).alias("version"),
            "timestamp",
            F.col("operation").alias("last_op"),
            rows_written(F.col("operation_metrics")).alias("rows_written"),
        )
    )


def last_writes(newest: DataFrame, cfg: WatchConfig) -> DataFrame:
    """Newest writes with their local time and their age in days."""
    return newest.select(
        *TABLE_KEY,
        minute_label(local_wall_clock(newest, "timestamp", cfg), cfg).alias("last_write"),
        "last_op",
        "rows_written",
        age_days(newest, "timestamp", cfg).alias("days_since"),
    )


def stale_writes(newest: DataFrame, base: DataFrame, cfg: WatchConfig) -> DataFrame:
    """Base tables whose newest write is too old. A table without any history is not reported."""
    checked = last_writes(newest, cfg).join(base.select(*TABLE_KEY), TABLE_KEY, "left_semi")
    days = F.coalesce("days_since", F.lit(NEVER_WRITTEN_DAYS).cast("bigint"))
    reported = checked.withColumn("days_since", days).filter(F.col("days_since") > cfg.stale_data_days)
    return reported.select(
        *TABLE_KEY,
        fqn(cfg.catalog, F.col("table_schema"), F.col("table_name")).alias("fqn"),
        F.lit("DELTA").alias("fmt"),
        F.coalesce("last_write", F.lit("No writes found")).alias("last_write"),
        F.coalesce("last_op", F.lit(NO_VALUE)).alias("last_op"),
        F.coalesce("rows_written", F.lit(NO_VALUE)).alias("rows_written"),
        "days_since",
        freshness_severity(F.col("days_since")).alias("severity"),
    )


def data_freshness(history: DataFrame, base: DataFrame, cfg: WatchConfig) -> DataFrame:
    """Base tables whose last write is too old, from the whole history."""
    return stale_writes(newest_writes(history), base, cfg)


def freshness_order() -> list[Column]:
    """Oldest first."""
    return [F.col("days_since").desc(), F.col("fqn")]
