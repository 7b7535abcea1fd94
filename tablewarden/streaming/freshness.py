"""The last write of every table kept up to date from landed log entries, instead of a scan of the whole history."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tablewarden.operators.freshness import newest_writes, newest_of
from tablewarden.sources.catalog import TABLE_KEY
from tablewarden.state.store import LAST_WRITES, WatchStore, cut_lineage
from tablewarden.streaming.landing import catch_up, landed

HISTORY_DDL = "table_schema STRING, table_name STRING, version BIGINT, timestamp {instant}, operation STRING, operation_metrics MAP<STRING, STRING>"
# Parts of the state table; a batch writes the parts of its tables anew.
BUCKETS = 64


def _bucketed(writes: DataFrame) -> DataFrame:
    return writes.withColumn("bucket", F.pmod(F.xxhash64(*TABLE_KEY), F.lit(BUCKETS)).cast("int"))


def store_writes(database: str, location: str | None = None) -> Callable[[DataFrame, int], None]:
    """Merge a batch of log entries into the state, a row per table.

    The newest write is a maximum, so entries that come late or again change nothing, nor does a repeated batch.
    """

    def each(batch: DataFrame, _: int) -> None:
        store = WatchStore(batch.sparkSession, database, location)
        new = cut_lineage(_bucketed(newest_writes(batch)))
        # At most ``BUCKETS`` numbers.
        touched = [r.bucket for r in new.select("bucket").distinct().collect()]
        if touched:
            old = store.table(LAST_WRITES).filter(F.col("bucket").isin(*touched))
            merged = cut_lineage(_bucketed(newest_of(old.unionByName(new).drop("bucket"))))
            store.overwrite(merged.hint("rebalance", "bucket"), LAST_WRITES)

    return each


def follow_history(spark: SparkSession, folder: str, checkpoint: str, database: str, location: str | None = None, instant: str = "TIMESTAMP_NTZ", files_per_batch: int = 1000) -> None:
    """Take over all log entries that landed in ``folder`` since the last call with this ``checkpoint``.

    ``instant`` is the type of the log's times, TIMESTAMP or TIMESTAMP_NTZ; the state keeps them as they are.
    """
    WatchStore(spark, database, location).ensure_last_writes(instant)
    catch_up(landed(spark, folder, HISTORY_DDL.format(instant=instant), files_per_batch), store_writes(database, location), checkpoint)


def last_write_state(store: WatchStore) -> DataFrame:
    """The state as ``newest_writes`` of the whole history would give it."""
    return store.fresh(LAST_WRITES).drop("bucket")
