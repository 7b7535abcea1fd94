"""Landed documents followed as streams give the rows of the batch, also after failures and repeats."""

from __future__ import annotations

import json
import random
from datetime import datetime, timedelta

import pytest

from tablewarden import adapters as given
from tablewarden.operators.freshness import newest_writes, stale_writes
from tablewarden.sources.payloads import runs_from_payload
from tablewarden.state.store import LAST_WRITES, RUNS
from tablewarden.streaming import runs as run_stream
from tablewarden.streaming.freshness import HISTORY_DDL, follow_history, last_write_state
from tablewarden.streaming.landing import catch_up, landed
from tablewarden.streaming.runs import PAGE_DDL, follow_runs, fresh_states, newest_states, store_states

SF = "/root/testdata/sf0.001"
DAY = 86_400_000
T0 = 19_700 * DAY


def page(job, *runs):
    """A landed page of runs (run_id, start, end, state)."""
    listed = [{"run_id": i, "start_time": s, "end_time": e, "state": {"result_state": r, "state_message": "m"}} for i, s, e, r in runs]
    return (job, json.dumps({"runs": listed}))


@pytest.fixture
def feed(spark, store):
    """Land pages, then catch up."""
    folder, offsets = f"{store.location}/landing", f"{store.location}/offsets"

    def land(*pages, **options):
        if pages:
            spark.createDataFrame(list(pages), PAGE_DDL).coalesce(1).write.mode("append").parquet(folder)
        follow_runs(spark, folder, offsets, store.database, store.location, **options)
        return sorted((r.run_id, r.start_time, r.end_time, r.result_state) for r in store.fresh(RUNS).collect())

    land.folder, land.offsets = folder, offsets
    return land


def test_states_of_a_run_replace_each_other(feed):
    assert feed(page(1, (10, T0 + 5, 0, None), (11, T0 + 6, T0 + 9, "SUCCESS"))) == [(10, T0 + 5, 0, None), (11, T0 + 6, T0 + 9, "SUCCESS")]
    # The first run ends; the second comes again; one of another day is new; an older state comes late.
    last = feed(page(1, (10, T0 + 5, T0 + 99, "FAILED"), (11, T0 + 6, T0 + 9, "SUCCESS")), page(2, (12, T0 + 3 * DAY, 0, None)))
    assert last == [(10, T0 + 5, T0 + 99, "FAILED"), (11, T0 + 6, T0 + 9, "SUCCESS"), (12, T0 + 3 * DAY, 0, None)]
    assert feed(page(1, (10, T0 + 5, 0, None))) == last
    assert feed() == last


def test_a_state_that_is_forgotten_and_comes_again_changes_nothing(feed):
    first = feed(page(1, (10, T0, T0 + 1, "FAILED")), remember="0 seconds")
    assert feed(page(1, (10, T0, T0 + 1, "FAILED")), remember="0 seconds") == first == [(10, T0, T0 + 1, "FAILED")]


def test_only_days_with_landed_runs_are_written(feed, spark, store):
    feed(page(1, (1, T0, T0 + 1, "FAILED")), page(1, (2, T0 + DAY, T0 + DAY + 1, "FAILED")))
    files = {r.day: r.file for r in store.fresh(RUNS).selectExpr("CAST(run_day AS STRING) AS day", "_metadata.file_path AS file").collect()}
    feed(page(1, (3, T0 + DAY, T0 + DAY + 2, "SUCCESS")))
    after = {r.day: r.file for r in store.fresh(RUNS).selectExpr("CAST(run_day AS STRING) AS day", "_metadata.file_path AS file").collect()}
    assert set(files) == set(after) and [files[d] == after[d] for d in sorted(files)] == [True, False]


def test_broken_pages_and_runs_that_have_not_started(feed):
    assert feed((1, "{broken"), (None, None), (2, ""), page(3, (5, 0, 0, None)), page(4, (6, T0, 0, None))) == [(6, T0, 0, None)]


def test_a_failed_batch_is_handed_over_again(feed, spark, store):
    spark.createDataFrame([page(1, (1, T0, 0, None)), page(1, (2, T0, T0 + 5, "FAILED"))], PAGE_DDL).coalesce(1).write.parquet(feed.folder)
    keep = store_states(store.database, store.location)

    def failing(batch, number):
        keep(batch, number)
        raise RuntimeError("lost after the write")

    with pytest.raises(Exception, match="lost after the write"):
        catch_up(fresh_states(landed(spark, feed.folder, PAGE_DDL), "2 days"), failing, feed.offsets)
    assert feed() == [(1, T0, 0, None), (2, T0, T0 + 5, "FAILED")]


def test_all_runs_of_the_given_tables(spark, store):
    folder, offsets = f"{store.location}/landing", f"{store.location}/offsets"
    for night in given.run_nights(spark, SF):
        night.repartition(5).write.mode("append").parquet(folder)
        follow_runs(spark, folder, offsets, store.database, store.location, files_per_batch=2)
    want = newest_states(given.runs(spark, SF))
    got = store.fresh(RUNS).select(want.columns)
    assert got.count() == want.count() > 0 and got.exceptAll(want).isEmpty()
    assert set(run_stream.STATE) | {"run_id"} == set(runs_from_payload(given.run_pages(spark, SF)).columns)


def entries(n, instant=False):
    rng = random.Random(7)
    kinds = ["WRITE", "merge", "OPTIMIZE", "VACUUM END", None]
    start = datetime(2024, 1, 1)
    rows = [("s", f"t{rng.randrange(7)}", v, start + timedelta(hours=v), rng.choice(kinds), {"numOutputRows": str(v)}) for v in range(n)]
    return rows + [("s", "only_reads", 1, start, "OPTIMIZE", {}), ("s", None, 2, start, "WRITE", {})]


@pytest.mark.parametrize("instant", ["TIMESTAMP_NTZ", "TIMESTAMP"])
def test_state_after_three_landings_equals_the_whole_history(spark, store, cfg, instant):
    folder, offsets = f"{store.location}/landing", f"{store.location}/offsets"
    rows = entries(300)
    random.Random(3).shuffle(rows)
    # The later landings hold older entries, and the second some again.
    for part in (rows[:100], rows[50:200], rows[200:]):
        spark.createDataFrame(part, HISTORY_DDL.format(instant=instant)).coalesce(1).write.mode("append").parquet(folder)
        follow_history(spark, folder, offsets, store.database, store.location, instant)
    whole = newest_writes(spark.createDataFrame(rows, HISTORY_DDL.format(instant=instant)))
    state = last_write_state(store)
    assert state.count() == whole.count() == 9 and state.select(whole.columns).exceptAll(whole).isEmpty()
    base = whole.select("table_schema", "table_name")
    assert stale_writes(state, base, cfg).exceptAll(stale_writes(whole, base, cfg)).isEmpty()


def test_a_landing_without_entries_and_without_writes(spark, store):
    folder, offsets = f"{store.location}/landing", f"{store.location}/offsets"
    ddl = HISTORY_DDL.format(instant="TIMESTAMP_NTZ")
    for part in ([], [("s", "t", 1, datetime(2024, 1, 1), "OPTIMIZE", None)], [("s", "t", 0, datetime(2024, 1, 1), "WRITE", None)]):
        spark.createDataFrame(part, ddl).write.mode("append").parquet(folder)
        follow_history(spark, folder, offsets, store.database, store.location)
    assert [tuple(r)[:3] for r in last_write_state(store).collect()] == [("s", "t", 0)]
    assert store.table(LAST_WRITES).select("bucket").distinct().count() == 1
