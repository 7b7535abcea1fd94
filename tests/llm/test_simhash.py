from __future__ import annotations

import numpy as np
import pytest
import xxhash

from tablewarden.llm.common import table
from tablewarden.llm.queries import QUERIES
from tablewarden.llm.simhash import fingerprint, first_of_group, links, near_duplicates

SF = "/root/testdata/sf0.01"


def slow_fingerprint(text, shingle=3):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", lowered) if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(prints, max_bits=3):
    values = np.array([prints[k] for k in prints], np.uint64)
    ids = list(prints)
    root = dict(zip(ids, ids))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(values):
        for j in np.nonzero(np.bitwise_count(values[i + 1 :] ^ a) <= max_bits)[0]:
            x, y = sorted((find(ids[i]), find(ids[i + 1 + j])))
            root[y] = x
    return {i: find(i) for i in ids}


def test_whole_table_equals_brute_force(spark):
    texts = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}
    got = {r.doc_id: r for r in QUERIES["op1_simhash_near_dedup"](spark, SF).collect()}
    prints = {i: slow_fingerprint(t) for i, t in texts.items()}
    want = slow_components(prints)
    assert {i: r.fingerprint for i, r in got.items()} == {i: f"{p:016x}" for i, p in prints.items()}
    assert {i: r.component_id for i, r in got.items()} == want


def test_links_over_dense_and_chained_fingerprints(spark):
    rng = np.random.default_rng(3)
    centre = int(rng.integers(0, 1 << 62))
    prints = {centre ^ sum(1 << int(b) for b in rng.choice(62, 2)) for _ in range(60)}
    chain = [7]
    for step in range(12):
        chain.append(chain[-1] ^ (0b111 << (5 * step)))
    prints |= set(chain) | {int(x) for x in rng.integers(0, 1 << 62, 200)}
    edges = links(spark.createDataFrame([(p,) for p in prints], "_fp BIGINT"), 3).collect()
    want = slow_components({p: p for p in sorted(prints)})
    root = {p: p for p in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        assert (a ^ b).bit_count() <= 64
        x, y = sorted((find(a), find(b)))
        root[y] = x
    assert {p: find(p) for p in prints} == want


@pytest.mark.parametrize("text", [None, "", " \t\n", "One", "one TWO", "Ünïcode A b c", "a " * 5000])
def test_fingerprint_of_odd_texts(text):
    value = fingerprint(None if text is None else text.encode(), 3)
    assert value & (1 << 64) - 1 == slow_fingerprint(text)


def test_nulls_repeats_and_clashing_columns(rows):
    docs = rows(
        "doc_id BIGINT, text STRING, _fp INT, root STRING, component_id INT",
        (5, "a b c d", 1, "x", 1), (5, "a b c d", 1, "x", 1), (3, "a b c d", 1, "x", 1), (None, "q r s t u v", 1, "x", 1), (1, None, 1, "x", 1), (2, "", 1, "x", 1),
    )
    got = sorted(((r.doc_id, r.component_id, r.component_size) for r in near_duplicates(docs).collect()), key=str)
    assert got == sorted([(5, 3, 3), (5, 3, 3), (3, 3, 3), (None, None, 1), (1, 1, 2), (2, 1, 2)], key=str)
    kept = first_of_group(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [1, 3, None]
    assert near_duplicates(docs.limit(0)).count() == 0 and first_of_group(docs.limit(0)).count() == 0
