from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from tablewarden.llm.binplan import best_fit, bins, complete_bins, lower_bound
from tablewarden.llm.common import table
from tablewarden.llm.packing import cuts, encode, pack
from tablewarden.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def reference():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


@settings(deadline=None, max_examples=200)
@given(st.lists(st.sampled_from([*"ab 'sZé\t\n  \x1c\x85漢9!|<>'", "<|endoftext|>", "  "]), max_size=60).map("".join))
def test_ids_equal_the_tokenizers_library(reference, text):
    assert encode(text).tolist() == reference(text)


def test_the_added_token_is_one_id():
    assert encode("a<|endoftext|>b").tolist() == [64, 50256, 65]


def check_bins(rows, length):
    found = defaultdict(list)
    for r in rows:
        found[r.sequence_id].append((r.offset, r.length))
    for parts in found.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= length
    return len(found)


def test_whole_table(spark, reference):
    rows = QUERIES["op2_best_fit_packing"](spark, SF).collect()
    got = {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows}
    want, total = {}, 0
    for r in table(spark, SF, "documents").collect():
        ids = np.array([*reference(r.text or ""), 2], "<u4")
        total += len(ids)
        for i, (start, n) in enumerate(cuts(len(ids), 1024)):
            want[r.doc_id, i] = (start, n, zlib.crc32(ids[start : start + n].tobytes()))
    assert got == want and len(rows) == len(want)
    assert check_bins(rows, 1024) <= -(-total // 1024) * 1.02 + 1


@pytest.mark.parametrize("n, want", [(1, [(0, 1)]), (1024, [(0, 1024)]), (1025, [(0, 1), (1, 1024)]), (2048, [(0, 1024), (1024, 1024)]), (2500, [(0, 452), (452, 1024), (1476, 1024)])])
def test_cuts(n, want):
    assert cuts(n, 1024) == want


def fewest(items, capacity):
    """Exhaustive search for a small instance."""
    best = len(items)

    def place(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(items):
            best = len(rooms)
            return
        for r in sorted(set(rooms)):
            if r >= items[i]:
                at = rooms.index(r)
                place(i + 1, [*rooms[:at], r - items[i], *rooms[at + 1 :]])
        place(i + 1, [*rooms, capacity - items[i]])

    place(0, [])
    return best


def test_plans_are_optimal_on_small_instances():
    rng = random.Random(2)
    for _ in range(60):
        items = sorted((rng.randint(8, 60) for _ in range(rng.randint(1, 10))), reverse=True)
        counts = Counter(items)
        plan = complete_bins(dict(counts), 100)
        used = Counter()
        for filling, times in plan:
            assert sum(s * n for s, n in filling) <= 100
            for s, n in filling:
                used[s] += n * times
        assert used == counts
        assert lower_bound(counts, 100) <= bins(plan) == fewest(items, 100) <= bins(best_fit(dict(counts), 100))


def test_odd_rows(spark, rows):
    docs = rows(
        "doc_id BIGINT, text STRING, length INT, _rank STRING",
        (1, None, 1, "x"), (None, "", 1, "x"), (2, "word " * 3000, 1, "x"), (2, "word " * 3000, 1, "x"), (3, "a", 1, "x"),
    )
    got = pack(docs).collect()
    assert Counter(r.doc_id for r in got)[2] == 2 * Counter(r.doc_id for r in got)[2] // 2
    assert sum(r.length for r in got) == 1 + 1 + 2 * (len(encode("word " * 3000)) + 1) + 2
    check_bins(got, 1024)
    assert pack(docs.limit(0)).count() == 0


def test_plans_of_many_short_documents_reach_the_lower_bound():
    for counts, capacity in (({129: 4000, 127: 4000}, 1024), ({65: 800, 63: 800}, 1024), ({s: 8 for s in range(90, 180, 2)}, 1024), ({37: 500, 26: 300, 11: 70}, 1024)):
        plan = complete_bins(dict(counts), capacity)
        used = Counter()
        for filling, times in plan:
            assert sum(s * n for s, n in filling) <= capacity
            for s, n in filling:
                used[s] += n * times
        assert used == counts and bins(plan) == lower_bound(counts, capacity)
