"""Durable state between runs: dated snapshots and the run tracker, as catalogue tables on Parquet."""

from __future__ import annotations

import tempfile
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from tablewarden.config import WatchConfig
from tablewarden.schemas import COLUMN_SNAPSHOT_DDL, LAST_WRITES_DDL, RUN_SUMMARY, RUNS_DDL, TABLE_SNAPSHOT_DDL, TRACKER_DDL

COLUMN_SNAPSHOT = "metadata_column_snapshot"
TABLE_SNAPSHOT = "metadata_table_snapshot"
TRACKER = "optimization_run_tracker"
RUNS = "job_runs"
LAST_WRITES = "table_last_writes"


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share. Only a local session without one gets a temporary folder."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="tablewarden-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """Result written once to the shared folder: computed once, read by many, and safe from lost executors."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def snapshot_at(snapshot: DataFrame, day: date) -> DataFrame:
    """Rows of one date; on a stored snapshot this prunes to one partition."""
    return snapshot.filter(F.col("snapshot_date") == F.lit(day))


def previous_snapshot_date(snapshot: DataFrame, as_of: date) -> DataFrame:
    """One row: the greatest date strictly before ``as_of``, null on a first run."""
    return snapshot.filter(F.col("snapshot_date") < F.lit(as_of)).agg(F.max("snapshot_date").alias("prev_date"))


def lookback_start(tracker: DataFrame, as_of: date) -> DataFrame:
    """One row: the latest run date before ``as_of``, else ``as_of``. A repeated run looks back as far as the first."""
    return tracker.filter(F.col("run_date") < F.lit(as_of)).agg(F.coalesce(F.max("run_date"), F.lit(as_of)).alias("lookback_start"))


class WatchStore:
    """Tables of one database. Every write of a date replaces that date, so a run can be repeated."""

    def __init__(self, spark: SparkSession, database: str, location: str | None = None):
        self.spark = spark
        self.database = database
        self.location = location

    def name(self, table: str) -> str:
        return f"`{self.database}`.`{table}`"

    def table(self, table: str) -> DataFrame:
        return self.spark.table(self.name(table))

    def fresh(self, table: str) -> DataFrame:
        """The table as it is now, also if another session has written to it."""
        self.spark.catalog.refreshTable(self.name(table))
        return self.table(table)

    def ensure_tables(self) -> None:
        """Create what is missing. On a cluster the store needs a ``location`` that all executors share."""
        if self.location is None and not self.spark.sparkContext.master.startswith("local"):
            raise RuntimeError("give the store a location that all executors share")
        place = f" LOCATION '{self.location}'" if self.location else ""
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.database}`{place}")
        for table, ddl, part in (
            (COLUMN_SNAPSHOT, COLUMN_SNAPSHOT_DDL, "snapshot_date"),
            (TABLE_SNAPSHOT, TABLE_SNAPSHOT_DDL, "snapshot_date"),
            (TRACKER, TRACKER_DDL, "run_date"),
            (RUNS, RUNS_DDL, "run_day"),
        ):
            self.ensure(table, ddl, part)

    def ensure_last_writes(self, instant: str) -> None:
        """The state of last writes, whose times have the type of the log's."""
        self.ensure(LAST_WRITES, LAST_WRITES_DDL.format(instant=instant), "bucket")

    def ensure(self, table: str, ddl: str, part: str) -> None:
        """Create one table, partitioned by the columns ``part``."""
        # The table option makes every overwrite replace only the partitions it brings.
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name(table)} ({ddl}) USING parquet "
            f"OPTIONS (partitionOverwriteMode 'dynamic') PARTITIONED BY ({part})"
        )

    def overwrite(self, rows: DataFrame, table: str) -> None:
        """Replace the partitions that ``rows`` brings, matching columns by name."""
        self.spark.sql(f"INSERT OVERWRITE TABLE {self.name(table)} BY NAME SELECT * FROM {{rows}}", rows=rows)

    def save_snapshot(self, df: DataFrame, table: str, day: date | None = None, part: str = "snapshot_date") -> None:
        """Replace the dates in ``df``, matching columns by name.

        ``day`` names the only date of ``df``. The insert replaces its partition in one step; only an empty
        ``df``, which brings no partition, drops the date instead.
        """
        if day is not None and df.isEmpty():
            self._drop_dates(table, [day], part)
            return
        # One output file per date until it outgrows the advisory partition size. A single date is spread
        # without a key: keyed by its date, all rows would meet in one partition first.
        rows = df.hint("rebalance", part) if day is None else df.hint("rebalance")
        self.overwrite(rows, table)

    def partitions(self, table: str) -> list[dict[str, str]]:
        """Stored partitions, from the catalogue: no data is read."""
        listed = self.spark.sql(f"SHOW PARTITIONS {self.name(table)}").collect()
        return [dict(part.split("=", 1) for part in row.partition.split("/")) for row in listed]

    def snapshot_dates(self, table: str) -> list[date]:
        """Stored dates: one entry per retained day."""
        return sorted(date.fromisoformat(part["snapshot_date"]) for part in self.partitions(table))

    def previous_date(self, as_of: date) -> date | None:
        return max((d for d in self.snapshot_dates(TABLE_SNAPSHOT) if d < as_of), default=None)

    def apply_retention(self, table: str, as_of: date, days: int = 90) -> None:
        """Drop the dates before ``as_of - days``; a metadata operation, no data is rewritten."""
        cutoff = as_of - timedelta(days=days)
        self._drop_dates(table, [d for d in self.snapshot_dates(table) if d < cutoff])

    def _drop_dates(self, table: str, days: list[date], part: str = "snapshot_date") -> None:
        self.drop_partitions(table, [f"{part} = DATE '{d.isoformat()}'" for d in days])

    def drop_partitions(self, table: str, specs: list[str]) -> None:
        if specs:
            self.spark.sql(f"ALTER TABLE {self.name(table)} DROP IF EXISTS " + ", ".join(f"PARTITION ({s})" for s in specs))

    def compact_snapshot(self, table: str, days: list[date]) -> None:
        """Rewrite the files of the given dates at the advisory size; the rows stay the same."""
        if days:
            self.save_snapshot(self.table(table).filter(F.col("snapshot_date").isin(*days)), table)

    def fragmented_dates(self, table: str, days: list[date], target_bytes: int = 64 << 20) -> list[date]:
        """Those of the given dates that lie in several files smaller than ``target_bytes`` on average."""
        file = F.col("_metadata")
        files = (
            self.table(table)
            .filter(F.col("snapshot_date").isin(*days))
            .select("snapshot_date", file["file_path"].alias("path"), file["file_size"].alias("bytes"))
            .distinct()
        )
        sizes = files.groupBy("snapshot_date").agg(F.count(F.lit(1)).alias("n"), F.avg("bytes").alias("mean"))
        return [r.snapshot_date for r in sizes.filter((F.col("n") > 1) & (F.col("mean") < target_bytes)).collect()]

    def lookback_start(self, as_of: date) -> date:
        return lookback_start(self.table(TRACKER), as_of).first().lookback_start

    def save_tracker(self, summary: DataFrame, cfg: WatchConfig) -> None:
        """Write the one-row run summary as a JSON document, in place of an earlier one of the same run date."""
        entry = summary.select(
            F.lit(cfg.run_date).alias("run_date"),
            F.to_json(F.struct(*summary.columns)).alias("analysis_json"),
            F.timestamp_millis(F.lit(cfg.as_of_ms)).alias("created_at"),
        )
        self.overwrite(entry, TRACKER)

    def drop(self) -> None:
        """Drop the database with all tables and files."""
        self.spark.sql(f"DROP DATABASE IF EXISTS `{self.database}` CASCADE")

    def tracker_history(self) -> DataFrame:
        """Run summaries of the tracker, parsed back into columns."""
        parsed = F.from_json("analysis_json", RUN_SUMMARY)
        return self.table(TRACKER).select(parsed.alias("summary"), "created_at").select("summary.*", "created_at")
