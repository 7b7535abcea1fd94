from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import pytest

from tablewarden.llm.centroids import Search, clusters, integers
from tablewarden.llm.common import table
from tablewarden.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def slow(rows, k=40, rounds=5, size=64):
    """(vec_id, cluster, distance, cluster inertia, inertia, digest), by comparing with every centroid in Python integers."""
    kept = [(i, [math.floor(256 * float(x)) for x in v]) for i, v in rows if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)]
    named = [(hashlib.sha256(f"2:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None]
    centroids = [v for _, v in sorted(named)[:k]]
    if not centroids:
        return []

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        owned = [nearest(v)[1] for _, v in kept]
        for n in range(len(centroids)):
            own = [v for (_, v), o in zip(kept, owned) if o == n]
            if own:
                centroids[n] = [sum(c) // len(own) for c in zip(*own)]
    found = [(i, *nearest(v)) for i, v in kept]
    total = sum(d for _, d, _ in found)
    each = [sum(d for _, d, o in found if o == n) for n in range(len(centroids))]
    return [(i, n, d, each[n], total, hashlib.sha256(",".join(map(str, centroids[n])).encode()).hexdigest()) for i, d, n in found]


def read(df):
    return sorted(((r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in df.collect()), key=str)


def test_whole_table_equals_brute_force(spark):
    given = [(r.vec_id, r.embedding) for r in table(spark, SF, "embeddings").collect()]
    got = read(QUERIES["op12_centroid_clustering"](spark, SF))
    assert got == sorted(slow(given), key=str) and len({r[1] for r in got}) > 5


@pytest.mark.parametrize("spread", [1, 3, 200, 1 << 26])
def test_search_equals_all_distances(spread):
    rng = np.random.default_rng(spread)
    for k, size in ((1, 4), (7, 4), (40, 64), (60, 3)):
        centroids = rng.integers(-spread, spread, (k, size), endpoint=True)
        vectors = np.concatenate((rng.integers(-spread, spread, (300, size), endpoint=True), centroids))
        numbers, distances = Search(centroids).nearest(vectors)
        full = ((vectors[:, None, :] - centroids[None]) ** 2).sum(axis=2)
        assert (numbers == full.argmin(axis=1)).all() and (distances == full.min(axis=1)).all()


def test_bounds_reject_most_centroids():
    rng = np.random.default_rng(1)
    centroids = rng.normal(0, 40, (200, 1)).astype(np.int64) + rng.integers(-20, 20, (200, 16))
    search = Search(centroids)
    search.nearest(np.repeat(centroids, 10, axis=0) + rng.integers(-3, 4, (2000, 16)))
    assert search.compared < 0.2 * 2000 * 200


def test_null_not_finite_and_wrong_sizes_are_left_out():
    good = [0.5] * 4
    given = pa.array([good, None, [0.5] * 3, [], [0.5, None, 0.5, 0.5], [math.nan, 0, 0, 0], [math.inf, 0, 0, 0], [-0.001, 0, 0.999, 2]], pa.list_(pa.float64()))
    places, values = integers(given, 4, 256)
    assert places.tolist() == [0, 7] and values.tolist() == [[128] * 4, [-1, 0, 255, 512]]
    with pytest.raises(ValueError, match="64 bits"):
        integers(pa.array([[1e30] * 4], pa.list_(pa.float64())), 4, 256)


def test_odd_rows(spark, rows):
    rng = np.random.default_rng(5)
    vectors = [(i, rng.normal(0, 1, 64).tolist()) for i in range(90)]
    same = [0.25] * 64
    vectors += [(100, same), (100, same), (100, [0.75] * 64), (None, same), (101, None), (102, [1.0] * 63), (103, [None, *same[1:]]), (104, [math.nan, *same[1:]]), (105, [math.inf, *same[1:]])]
    frame = rows("vec_id BIGINT, embedding ARRAY<DOUBLE>, cluster STRING, _id INT, distance INT", *[(i, v, "x", 1, 1) for i, v in vectors])
    assert read(clusters(frame)) == sorted(slow(vectors), key=str)
    few = [(i, v) for i, v in vectors if i in (1, 2, 100)]
    assert read(clusters(frame.filter("vec_id in (1, 2, 100)"))) == sorted(slow(few), key=str)
    assert clusters(frame.limit(0)).count() == 0 and clusters(frame.filter("vec_id IS NULL")).count() == 0
    assert clusters(frame.limit(0)).columns == clusters(frame).columns
