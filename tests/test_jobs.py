from __future__ import annotations

from datetime import date, datetime

import pytest

from tablewarden.config import WatchConfig
from tablewarden.operators import jobs

RUNS = (
    "job_id BIGINT, run_id BIGINT, start_time BIGINT, end_time BIGINT, result_state STRING, "
    "state_message STRING, run_page_url STRING"
)
JOBS = "job_id BIGINT, name STRING, schedule STRING"
START = 1_700_000_000_000


def run(job, i, minutes=1.0, state="SUCCESS", start=None, end=None, message="m"):
    begun = START + i * 600_000 if start is None else start
    ended = begun + int(minutes * 60000) if end is None else end
    return (job, i, begun, ended, state, message, "u")


def summary(rows, cfg, *runs):
    known = rows(JOBS, (1, "one", "0 0 23 * * ?"))
    return jobs.job_summary(known, jobs.run_stats(jobs.latest_runs(rows(RUNS, *runs))), cfg)


def test_a_job_without_runs(rows, cfg):
    found = summary(rows, cfg, run(2, 1)).first()
    assert (found.avg_min, found.max_min, found.fail_rate, found.n_runs, found.last_run) == (0.0, 0.0, 0.0, 0, "Never")
    assert jobs.stale_jobs(summary(rows, cfg, run(2, 1)), cfg).count() == 1


def test_only_the_latest_25_runs_count(rows, cfg):
    oldest_failed = [run(1, 0, state="FAILED")] + [run(1, i) for i in range(1, 26)]
    found = summary(rows, cfg, *oldest_failed).first()
    assert (found.n_runs, found.fail_rate) == (25, 0.0)


def test_equal_starts_are_ordered_by_run_id(rows):
    same = [run(1, i, start=START) for i in range(30)]
    assert sorted(r.run_id for r in jobs.latest_runs(rows(RUNS, *same)).collect()) == list(range(5, 30))


@pytest.mark.parametrize(("failed", "total", "rate", "failing"), [(5, 25, 20.0, 0), (6, 25, 24.0, 1), (1, 16, 6.2, 0)])
def test_failure_rate(rows, cfg, failed, total, rate, failing):
    runs = [run(1, i, state="FAILED" if i < failed else "SUCCESS") for i in range(total)]
    found = summary(rows, cfg, *runs)
    assert found.first().fail_rate == rate
    rows_failing = jobs.failing_jobs(found, cfg).collect()
    assert len(rows_failing) == failing
    assert not failing or rows_failing[0].failed_of_total == f"{failed}/{total}"


@pytest.mark.parametrize("state", ["TIMEDOUT", "CANCELED", None, "failed"])
def test_other_states_are_not_failures(rows, cfg, state):
    assert summary(rows, cfg, run(1, 1, state=state)).first().fail_rate == 0.0


def test_open_and_failed_runs_count_in_the_average(rows, cfg):
    found = summary(rows, cfg, run(1, 1, end=0), run(1, 2, minutes=4.0, state="FAILED")).first()
    assert (found.avg_min, found.max_min) == (2.0, 4.0)


@pytest.mark.parametrize(("minutes", "expected"), [(10.0, 0), (10.04, 0), (10.06, 1), (10.1, 1)])
def test_long_running(rows, cfg, minutes, expected):
    assert jobs.long_running_jobs(summary(rows, cfg, run(1, 1, minutes=minutes)), cfg).count() == expected


@pytest.mark.parametrize(("offset", "stale"), [(-1, 1), (0, 0)])
def test_stale_job_at_the_cutoff(rows, cfg, offset, stale):
    cutoff = cfg.as_of_ms - 60 * 86_400_000
    assert jobs.stale_jobs(summary(rows, cfg, run(1, 1, start=cutoff + offset)), cfg).count() == stale


def test_period_failures_start_at_local_midnight(rows, cfg):
    # Midnight of January 30 in New York is 05:00 UTC.
    midnight = 1_706_590_800_000
    runs = rows(
        RUNS,
        run(1, 1, state="FAILED", start=midnight - 1),
        run(1, 2, state="FAILED", start=midnight, message="x" * 600),
        run(1, 3, start=midnight + 1),
        run(1, 4, state="FAILED", start=midnight + 2, message=None),
    )
    found = jobs.period_failures(runs, rows(JOBS, (1, "one", "")), cfg, date(2024, 1, 30)).orderBy("run_id").collect()
    assert [(r.run_id, len(r.error), r.date) for r in found] == [
        (2, 600, "2024-01-30 00:00 ET"),
        (4, 0, "2024-01-30 00:00 ET"),
    ]


def test_all_failures_of_a_job_are_reported(rows, cfg):
    midnight = 1_706_590_800_000
    runs = rows(RUNS, *[run(1, i, state="FAILED", start=midnight + i) for i in range(40)])
    assert jobs.period_failures(runs, rows(JOBS, (1, "one", "")), cfg, date(2024, 1, 30)).count() == 40


def test_look_back_is_a_local_midnight_in_summer_too():
    summer = WatchConfig(as_of=datetime(2024, 7, 2))
    assert summer.midnight_ms(date(2024, 7, 1)) == 1_719_806_400_000


def test_cost(rows, cfg):
    averages = [87.4, 64.2, 43.7, 38.1, 29.6]
    known = rows("job_id BIGINT, avg_min DOUBLE", *enumerate(averages))
    found = jobs.cost_estimate(known, cfg).first()
    assert found.est_monthly_cost == pytest.approx(9.205, abs=0.0051)
    assert found.est_savings == 2.76


def test_cost_of_no_jobs(rows, cfg):
    assert tuple(jobs.cost_estimate(rows("job_id BIGINT, avg_min DOUBLE"), cfg).first()) == (0.0, 0.0)
