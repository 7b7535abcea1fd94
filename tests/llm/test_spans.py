from __future__ import annotations

import random
from collections import defaultdict

from tablewarden.llm.common import table
from tablewarden.llm.queries import QUERIES
from tablewarden.llm.spans import repeated_spans

SF = "/root/testdata/sf0.01"


def slow(docs, least=50):
    """(key, word): removed, for every word in a window that occurs again, from all windows of all texts in order."""
    places = defaultdict(list)
    for i in sorted(docs):
        words = (docs[i] or "").lower().split()
        for at in range(len(words) - least + 1):
            places[tuple(words[at : at + least])].append((i, at))
    out = {}
    for found in places.values():
        if len(found) > 1:
            for n, (i, at) in enumerate(found):
                for k in range(at, at + least):
                    out[i, k] = out.get((i, k), True) and n > 0
    return out


def read(df):
    got = {}
    for r in df.collect():
        for k in range(r.start, r.start + r.n_words):
            assert (r.doc_id, k) not in got
            got[r.doc_id, k] = r.removed
    return got


def test_whole_table_equals_brute_force(spark):
    want = slow({r.doc_id: r.text for r in table(spark, SF, "documents").collect()})
    assert read(QUERIES["op6_repeated_spans"](spark, SF)) == want and want


def test_wrapped_and_embedded_passages(spark):
    rng = random.Random(6)
    passage = [f"w{i}" for i in range(55)]

    def other(n):
        return [f"x{rng.random()}" for _ in range(n)]

    texts = {
        1: " ".join(other(30) + passage + other(40)),
        2: "\n".join([*other(3), *(" ".join(passage[i : i + 9]) for i in range(0, 55, 9)), *other(2)]),
        3: " ".join(passage[:49]),
        4: " ".join(other(20) + passage[3:53]),
        5: "word " * 300,
    }
    docs = spark.createDataFrame(list(texts.items()), "doc_id BIGINT, text STRING")
    rows = sorted((r.doc_id, r.start, r.n_words, r.removed) for r in repeated_spans(docs).collect())
    assert rows == [(1, 30, 55, False), (2, 3, 55, True), (4, 20, 50, True), (5, 0, 50, False), (5, 50, 250, True)]
    assert read(repeated_spans(docs)) == slow(texts)


def test_odd_rows(rows):
    long = " ".join(f"w{i}" for i in range(60))
    docs = rows("doc_id STRING, text STRING, _row INT, start INT", ("b", f"a\n{long}", 1, 1), (None, long, 1, 1), ("b", f"a\n{long}", 1, 1), ("c", None, 1, 1), ("d", "", 1, 1))
    got = repeated_spans(docs).collect()
    assert sorted(((r.doc_id, r.start, r.n_words, r.removed) for r in got), key=str) == sorted([("b", 0, 61, False), ("b", 0, 61, True), (None, 0, 60, True)], key=str)
    assert repeated_spans(docs.limit(0)).count() == 0
