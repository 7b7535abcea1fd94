"""Job runs kept up to date from landed pages, a row per run in its newest state."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tablewarden.sources.payloads import runs_from_payload
from tablewarden.state.store import RUNS, WatchStore, cut_lineage
from tablewarden.streaming.landing import catch_up, landed

PAGE_DDL = "job_id BIGINT, payload STRING"
# What tells two states of a run apart; the later end, then the greater value of the others, is the newer state.
STATE = ["end_time", "result_state", "state_message", "run_page_url", "start_time", "job_id"]


def fresh_states(pages: DataFrame, remember: str) -> DataFrame:
    """Run states of streamed pages, each once within the time that is remembered.

    A page repeats the runs of the page before it. The clock is the time of arrival, so no state is late, however old its
    run; state that is delivered again later passes, and the table takes it without effect.
    """
    arrived = runs_from_payload(pages).withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", remember)
    return arrived.dropDuplicatesWithinWatermark(["run_id", *STATE]).drop("_arrived")


def newest_states(runs: DataFrame) -> DataFrame:
    """One row per run, in its newest state. Runs that have not started (start 0) are none yet."""
    newest = F.max(F.struct(*STATE)).alias("state")
    kept = runs.filter(F.col("start_time") > 0).groupBy("run_id").agg(newest).select("run_id", "state.*")
    # The UTC date, whatever the session's zone: a run stays in its partition.
    return kept.withColumn("run_day", F.expr("date_add(DATE'1970-01-01', CAST(start_time div 86400000 AS INT))"))


def store_states(database: str, location: str | None = None) -> Callable[[DataFrame, int], None]:
    """Merge a batch into the table of runs: the days of its runs are written anew, the others are not read."""

    def each(batch: DataFrame, _: int) -> None:
        store = WatchStore(batch.sparkSession, database, location)
        new = cut_lineage(newest_states(batch))
        # A date for every day with landed runs.
        days = [r.run_day for r in new.select("run_day").distinct().collect()]
        if days:
            old = store.table(RUNS).filter(F.col("run_day").isin(*days)).drop("run_day")
            merged = cut_lineage(newest_states(old.unionByName(new.drop("run_day"))))
            store.overwrite(merged.hint("rebalance", "run_day"), RUNS)

    return each


def follow_runs(spark: SparkSession, folder: str, checkpoint: str, database: str, location: str | None = None, remember: str = "2 days", files_per_batch: int = 1000) -> None:
    """Take over all pages (job_id, payload) that landed in ``folder`` since the last call with this ``checkpoint``."""
    catch_up(fresh_states(landed(spark, folder, PAGE_DDL, files_per_batch), remember), store_states(database, location), checkpoint)
