from __future__ import annotations

import random
from collections import deque
from pathlib import Path
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pytest

from tablewarden.operators import hops as hops_module, walks as walks_module
from tablewarden.operators.hops import downstream_edges, downstream_hops, impact_depth
from tablewarden.operators.walks import Graph, walks


def slow(edges, roots):
    """Breadth-first search from every root."""
    out = {}
    for root in roots:
        distance, queue = {root: 0}, deque([root])
        while queue:
            at = queue.popleft()
            for a, b in edges:
                if a == at and b not in distance:
                    distance[b] = distance[at] + 1
                    queue.append(b)
        out |= {(root, k): d for k, d in distance.items() if d}
    return out


@pytest.fixture
def reached(rows):
    def run(edges, roots, **options):
        found = downstream_hops(rows("fqn STRING, asset STRING", *edges), rows("fqn STRING", *[(r,) for r in roots]), **options).collect()
        got = {(r.fqn, r.asset): r.distance for r in found}
        assert len(got) == len(found)
        return got

    return run


def test_a_chain_a_diamond_and_a_cycle(reached):
    edges = [("a", "b"), ("b", "c"), ("a", "d"), ("d", "c"), ("c", "e"), ("e", "a"), ("x", "y"), ("b", "b")]
    assert reached(edges, ["a", "e", "y"]) == {
        ("a", "b"): 1, ("a", "d"): 1, ("a", "c"): 2, ("a", "e"): 3, ("e", "a"): 1, ("e", "b"): 2, ("e", "d"): 2, ("e", "c"): 3,
    }


def test_random_graphs(reached):
    rng = random.Random(4)
    edges = [(f"n{rng.randrange(25)}", f"n{rng.randrange(25)}") for _ in range(40)]
    roots = [f"n{i}" for i in range(0, 25, 3)]
    want = slow([e for e in edges if e[0] != e[1]], roots)
    assert reached(edges, roots) == want
    assert reached(edges, roots, max_hops=2) == {k: d for k, d in want.items() if d <= 2}


def test_hubs(reached):
    """All roots meet in one table, which has very many readers."""
    edges = [(f"r{i}", "hub") for i in range(20)] + [("hub", f"leaf{i}") for i in range(500)]
    got = reached(edges, [f"r{i}" for i in range(20)])
    assert len(got) == 20 * 501 and sorted(set(got.values())) == [1, 2]


def test_repeats_nulls_and_empty_tables(reached):
    assert reached([("a", "b"), ("a", "b"), (None, "c"), ("a", None)], ["a", "a", None]) == {("a", "b"): 1}
    assert reached([("a", "b")], []) == {} and reached([], ["a"]) == {}


def test_first_hop_is_what_the_risk_rating_counts(rows):
    lineage = rows("fqn STRING, asset_kind STRING, asset STRING", ("a", "DOWNSTREAM", "b"), ("a", "DOWNSTREAM", "c"), ("c", "DOWNSTREAM", "d"), ("a", "JOB", "j"), ("d", "UPSTREAM", "c"))
    summary = rows("fqn STRING, change_summary STRING, breaking BOOLEAN", ("a", "COL REMOVED", True), ("z", "NAMING", False))
    hops = downstream_hops(downstream_edges(lineage), summary)
    assert sorted((r.fqn, r.asset) for r in hops.filter("distance = 1").collect()) == [("a", "b"), ("a", "c")]
    assert sorted(tuple(r) for r in impact_depth(summary, hops).collect()) == [("a", "COL REMOVED", True, 2, 3, 2), ("z", "NAMING", False, 0, 0, 0)]


def stored_bytes(spark):
    """Of all checkpoints of the session, which has a folder for them from the first one on."""
    folder = spark.sparkContext.getCheckpointDir()
    return sum(p.stat().st_size for p in Path(urlparse(folder).path).rglob("*") if p.is_file()) if folder else 0


def test_pairs_are_not_stored(spark, rows):
    """200 roots times 501 assets are many times the 700 edges."""
    edges = rows("fqn STRING, asset STRING", *[(f"r{i}", "hub") for i in range(200)], *[("hub", f"leaf{i}") for i in range(500)])
    roots = rows("fqn STRING", *[(f"r{i}",) for i in range(200)])
    before = stored_bytes(spark)
    assert downstream_hops(edges, roots).count() == 200 * 501
    assert stored_bytes(spark) - before < 1 << 17


def test_depth_of_many_pairs_without_storing_them(spark, rows):
    edges = rows("fqn STRING, asset STRING", *[(f"r{i}", "hub") for i in range(200)], *[("hub", f"leaf{i}") for i in range(500)])
    summary = rows("fqn STRING, change_summary STRING, breaking BOOLEAN", *[(f"r{i}", "NAMING", False) for i in range(200)], ("z", "NAMING", False))
    before = stored_bytes(spark)
    found = impact_depth(summary, downstream_hops(edges, summary)).collect()
    assert sorted((r.fqn, r.n_direct, r.n_reached, r.deepest) for r in found) == sorted([("z", 0, 0, 0), *[(f"r{i}", 1, 501, 2) for i in range(200)]])
    assert stored_bytes(spark) - before < 1 << 17


def test_graphs_too_large_to_hold(reached, monkeypatch):
    """The rounds of joins find the same, whether the edges or the names exceed the limit."""
    rng = random.Random(5)
    edges = [(f"n{rng.randrange(15)}", f"n{rng.randrange(15)}") for _ in range(25)]
    roots = [f"n{i}" for i in range(0, 15, 2)]
    want = reached(edges, roots)
    assert want == slow([e for e in edges if e[0] != e[1]], roots)
    for held in (0, 8 * len({e for e in edges if e[0] != e[1]})):
        monkeypatch.setattr(hops_module, "HELD_BYTES", held)
        monkeypatch.setattr(hops_module, "_by_walks", None)
        assert reached(edges, roots) == want


@pytest.mark.parametrize(("pairs", "step", "flags"), [(1 << 18, 1 << 18, 1 << 22), (40, 7, 1 << 22), (40, 7, 0), (1 << 18, 1 << 18, 0)])
def test_walks_in_blocks_and_pieces(monkeypatch, pairs, step, flags):
    """Blocks of roots that find too much are cut, a hub's edges are followed in pieces, found pairs are flags or a hash table."""
    for name, value in (("PAIRS", pairs), ("STEP", step), ("FLAGS", flags)):
        monkeypatch.setattr(walks_module, name, value)
    rng = random.Random(6)
    edges = {(rng.randrange(60), rng.randrange(60)) for _ in range(90)} | {(7, i) for i in range(60)} | {(100 + i, 101 + i) for i in range(50)}
    edges = sorted(e for e in edges if e[0] != e[1])
    graph = Graph.of(pa.array([str(i) for i in range(151)]), *np.array(edges, np.int32).T)
    roots = np.array([*range(0, 60, 2), *range(100, 151, 5)], np.int32)
    for most in (None, 0, 1, 3):
        found = [(int(r), int(k), int(d)) for block in walks(graph, roots, most) for r, k, d in zip(*block)]
        want = {k: d for k, d in slow(edges, roots.tolist()).items() if most is None or d <= most}
        assert len(found) == len(want) and {(r, k): d for r, k, d in found} == want
