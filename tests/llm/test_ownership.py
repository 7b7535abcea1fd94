from __future__ import annotations

import hashlib
import random
import re

import pytest

from tablewarden.llm.common import table
from tablewarden.llm.ownership import COPIED_OWNERS, secrets
from tablewarden.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
# The contract's patterns, with the lengths looked at afterwards.
BASE = {
    "assign": (re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), lambda m: len(m[2]) >= 12),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 18),
    "hex": (re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 16),
}


def base(text):
    spans = [(m.start(), place, f"{kind}:{m.start()}:{m.end()}") for place, (kind, (pattern, fits)) in enumerate(BASE.items()) for m in pattern.finditer(text or "") if fits(m)]
    told = [s for *_, s in sorted(spans)]
    counts = [sum(s.startswith(kind + ":") for s in told) for kind in BASE]
    return *counts, hashlib.sha256(",".join(told).encode()).hexdigest(), told


def test_base_of_the_whole_table_equals_the_contract(spark):
    got = {r.doc_id: r for r in QUERIES["op11_secret_scan"](spark, SF).collect()}
    docs = table(spark, SF, "documents").collect()
    assert len(got) == len(docs)
    for d in docs:
        *counts, digest, told = base(d.text)
        r = got[d.doc_id]
        assert [r.n_assign, r.n_access, r.n_hex, r.base_sha256] == [*counts, digest]
        assert [s for s in r.spans.split(",") if s.split(":")[0] in BASE] == told
    assert any(r.n_assign for r in got.values()) and any(r.n_hex for r in got.values())


def test_base_of_random_texts(spark):
    rng = random.Random(11)
    parts = ["password", "PassWd", "secret", "TOKEN", "api_key", "apikey", "api key", " ", "  ", "=", ":", "'", '"', "AKIA", "AKIAAKIA", "ABCDEFGHIJ1234", "0123456789abcdef", "deadbeef", "x", "é🙂", "\n", "\t", "Zz9+/_.=-", "hunter2hunter2", ",", "ſecret", "toKen"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 40))) for _ in range(400)]
    docs = spark.createDataFrame([(i, t, f"s{i}") for i, t in enumerate(texts)], "doc_id BIGINT, text STRING, source STRING")
    for r in secrets(docs).collect():
        *counts, digest, told = base(texts[r.doc_id])
        assert [r.n_assign, r.n_access, r.n_hex, r.base_sha256] == [*counts, digest], texts[r.doc_id]


LIVE = "9f3kQz71Lm"
TOKEN = "gh" + "p_" + "A1b2C3d4E5f6G7h8I9j0K1"


@pytest.fixture
def corpus(rows):
    copied = [(i, f"see {TOKEN} here", f"owner{i}") for i in range(COPIED_OWNERS)]
    own = [(10 + i, f"password = {LIVE} and gh" + "p_Zz1Yy2Xx3Ww4Vv5Uu6Tt7", "one") for i in range(50)]
    rest = [(90, "pwd: example-key-1", "two"), (91, "password = short1", "two"), (92, "postgres://admin:Hq82kd93lm@host/db", "two"), (93, "nothing at all", "two")]
    return rows("doc_id INT, text STRING, source STRING", *copied, *own, *rest)


def test_copied_examples_and_owner_specific_values(corpus):
    got = {r.doc_id: r for r in secrets(corpus).collect()}
    # Three owners hold the first token: an example. Fifty files of one owner hold the second: live.
    assert all((got[i].spans, got[i].n_live, got[i].n_copied) == ("", 0, 1) for i in range(COPIED_OWNERS))
    assert all((got[10 + i].spans, got[10 + i].n_live, got[10 + i].n_copied) == ("short:0:21,github:26:51", 2, 0) for i in range(50))
    assert (got[90].spans, got[91].spans, got[92].spans, got[93].spans) == ("", "", "userinfo:8:28", "")


def test_frequency_equals_a_count_over_all_pairs(corpus):
    owners: dict[str, set] = {}
    for r in corpus.collect():
        for value in (TOKEN, LIVE):
            if value in r.text:
                owners.setdefault(value, set()).add(r.source)
    assert {len(v) for v in owners.values()} == {1, COPIED_OWNERS}
    two_more = corpus.union(corpus.filter("doc_id = 10").selectExpr("200", "text", "'two'")).union(corpus.filter("doc_id = 10").selectExpr("201", "text", "NULL"))
    got = {r.doc_id: r for r in secrets(two_more).collect()}
    assert (got[10].spans, got[10].n_live, got[10].n_copied) == ("", 0, 2)


def test_odd_rows(rows):
    long = "word " * 200_000 + "token=abcdefghij123456"
    docs = rows(
        "doc_id BIGINT, text STRING, source STRING, _row INT, _hash STRING, spans INT",
        (1, None, "a", 1, "x", 1), (None, "", None, 1, "x", 1), (2, long, None, 1, "x", 1), (3, "token=abcdefghij123456", "a", 1, "x", 1), (3, "token=abcdefghij123456", "a", 1, "x", 1), (4, "0123456789abcdef " * 3000, "b", 1, "x", 1),
    )
    got = sorted(((str(r.doc_id), r.n_assign, r.n_hex, r.spans) for r in secrets(docs).collect()))
    spans = ",".join(f"hex:{17 * i}:{17 * i + 16}" for i in range(3000))
    assert got == sorted([("1", 0, 0, ""), ("None", 0, 0, ""), ("2", 1, 0, "assign:1000000:1000022"), ("3", 1, 0, "assign:0:22"), ("3", 1, 0, "assign:0:22"), ("4", 0, 3000, spans)])
    assert secrets(docs.limit(0)).count() == 0


def test_plan_has_no_python(spark):
    plan = QUERIES["op11_secret_scan"](spark, SF)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
