"""Every landed document is accepted or rejected with a reason."""

from __future__ import annotations

import pytest

from tablewarden.operators.lineage import merge_lineage, rated_impact, rejected_assets
from tablewarden.sources.payloads import checked_pages, jobs_from_payload, landing_totals, lineage_from_payload, rejected_documents, runs_from_payload

GOOD = '{"runs": [{"run_id": 1, "start_time": 5, "state": {}}]}'
DOCUMENTS = [
    (1, GOOD, None),
    (1, GOOD, None),
    (2, '{"runs": []}', None),
    (3, "{}", None),
    (4, '{"runs": [], "more": {"x": 1}}', None),
    (None, GOOD, "no key"),
    (None, None, "no key"),
    (5, None, "no document"),
    (6, "", "empty document"),
    (7, "  ", "empty document"),
    (8, GOOD[:-4], "not JSON"),
    (9, "<html>502</html>", "not JSON"),
    (10, '{"runs": 7}', "unexpected shape"),
    (11, '{"runs": [{"run_id": "x"}]}', "unexpected shape"),
    (12, "null", "unexpected shape"),
    (13, '"text"', "unexpected shape"),
]


@pytest.fixture
def landed(rows):
    return rows("job_id BIGINT, payload STRING", *[d[:2] for d in DOCUMENTS])


def test_reasons(landed):
    got = [(r.job_id, r.payload, r.reason) for r in checked_pages(landed, "runs").collect()]
    assert sorted(got, key=str) == sorted(DOCUMENTS, key=str)


def test_accepted_and_rejected_are_all_that_landed(landed):
    total = landing_totals(landed, "runs").first()
    assert (total.source, total.landed, total.accepted, total.rejected) == ("runs", len(DOCUMENTS), 5, 11)
    assert (total.no_document, total.empty_document, total.not_json, total.unexpected_shape, total.no_key) == (1, 2, 2, 4, 2)
    assert rejected_documents(landed, "runs").count() == total.rejected
    # Nothing is taken from a rejected document.
    assert [(r.job_id, r.run_id) for r in runs_from_payload(landed).collect()] == [(1, 1), (1, 1)]


def test_rejects_name_their_file_and_key(spark, rows, tmp_path):
    rows("table_name STRING, payload STRING", ("c.s.t", "{"), ("c.s.u", "{}")).coalesce(1).write.parquet(str(tmp_path / "pages"))
    read = spark.read.parquet(str(tmp_path / "pages")).selectExpr("*", "_metadata.file_name AS file")
    (lost,) = rejected_documents(read, "lineage").collect()
    assert (lost.source, lost.key, lost.reason, lost.n_chars) == ("lineage", "c.s.t", "not JSON", 1) and lost.file.endswith(".parquet")


def test_job_pages_have_no_key(rows):
    pages = rows("payload STRING", ('{"jobs": [{"job_id": 1, "settings": {"name": "a"}}]}',), ("{",), (None,))
    assert [r.name for r in jobs_from_payload(pages, ()).collect()] == ["a"]
    assert sorted(r.reason for r in rejected_documents(pages, "jobs").collect()) == ["no document", "not JSON"]
    assert landing_totals(pages.limit(0), "jobs").first().landed == 0


def test_a_broken_lineage_page_is_seen_in_the_impact(rows):
    pages = rows(
        "table_name STRING, payload STRING",
        ("a", '{"downstreams": [{"name": "x"}, {"name": "x"}], "entity_lineage": [{"entity_type": "JOB", "name": "j"}, {"entity_type": "JOB", "name": "j"}]}'), ("a", "{"), ("b", None),
    )
    assert lineage_from_payload(pages).count() == 4
    access = rows("fqn STRING, asset_kind STRING, asset STRING", ("a", "JOB", "j"), ("a", "NOTEBOOK", "n"))
    merged = merge_lineage(lineage_from_payload(pages, mark_rejected=True), access)
    assert sorted(tuple(r) for r in merged.collect()) == [
        ("a", "DOWNSTREAM", "x"), ("a", "DOWNSTREAM", "x"), ("a", "JOB", "j"), ("a", "NOTEBOOK", "n"), ("a", "REJECTED", "not JSON"), ("b", "REJECTED", "no document"),
    ]
    summary = rows("fqn STRING, change_summary STRING, n_changes BIGINT, breaking BOOLEAN", ("a", "NAMING", 1, False), ("b", "NAMING", 1, False), ("c", "NAMING", 1, False))
    assert sorted((r.fqn, r.n_downstream, r.n_rejected, r.risk) for r in rated_impact(summary, merged).collect()) == [("a", 2, 1, "MEDIUM"), ("b", 0, 1, "LOW"), ("c", 0, 0, "LOW")]
    assert rejected_assets(merged).first().rejected_documents == 2
