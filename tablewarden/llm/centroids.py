"""Clusters of integer vectors: rounds of nearest centroids, found by equal-average equal-variance search."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tablewarden.llm.common import cut_lineage

SIZE, SCALE, CENTROIDS, ROUNDS, SEED = 64, 256, 40, 5, 2
# Components beyond it are refused: squared distances would not fit into 64 bits.
LARGEST = 1 << 27
# Vectors that are searched at once.
ROWS = 4096
_FAR = np.int64(1) << 62


def integers(vectors: pa.Array, size: int = SIZE, scale: int = SCALE) -> tuple[np.ndarray, np.ndarray]:
    """(places, floor(scale * x)) of the vectors with exactly ``size`` components, none null or not finite."""
    places = np.nonzero(pc.equal(pc.list_value_length(vectors), size).fill_null(False).to_numpy(zero_copy_only=False))[0]
    flat = vectors.take(pa.array(places)).flatten().to_numpy(zero_copy_only=False)
    values = np.asarray(flat, np.float64).reshape(-1, size)
    good = np.isfinite(values).all(axis=1)
    values = np.floor(values[good] * scale)
    if values.size and np.abs(values).max() >= LARGEST:
        raise ValueError(f"a component is not below {LARGEST // scale}: its squared distances would not fit into 64 bits")
    return places[good], values.astype(np.int64)


class Search:
    """Centroids sorted by the mean of their components, searched outward from a vector's own mean.

    With n components, mean m and deviation v = |x - m|, a distance is at least n (m_x - m_c)^2 + (v_x - v_c)^2. The
    first term alone ends a search, since the centroids further out differ more in mean; both together reject one
    centroid. What is left is decided by integer distances. The bounds are lowered by more than their rounding error,
    so no centroid as near as the best is rejected, and of equal distances the smaller number wins.
    """

    def __init__(self, centroids: np.ndarray):
        self.order = np.argsort(centroids.sum(axis=1), kind="stable")
        self.vectors = centroids[self.order]
        self.sums = self.vectors.sum(axis=1)
        self.spread = self._spread(self.vectors, self.sums)
        self.compared = 0

    @staticmethod
    def _spread(vectors: np.ndarray, sums: np.ndarray) -> np.ndarray:
        return np.sqrt(((vectors - (sums / vectors.shape[1])[:, None]) ** 2).sum(axis=1))

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number, squared distance) of each vector's nearest centroid."""
        parts = [self._nearest(vectors[at : at + ROWS]) for at in range(0, len(vectors), ROWS)]
        numbers, distances = zip(*parts) if parts else ([np.zeros(0, np.int64)], [np.zeros(0, np.int64)])
        return np.concatenate(numbers), np.concatenate(distances)

    def _nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        k, size = len(self.sums), x.shape[1]
        sums = x.sum(axis=1)
        spread = self._spread(x, sums)
        right = np.searchsorted(self.sums, sums)
        left = right - 1
        best, number = np.full(len(x), _FAR), np.full(len(x), k)
        open_ = np.arange(len(x))
        while len(open_):
            s, lo, hi = sums[open_], left[open_], right[open_]
            before = np.where(lo >= 0, s - self.sums[np.maximum(lo, 0)], _FAR)
            after = np.where(hi < k, self.sums[np.minimum(hi, k - 1)] - s, _FAR)
            at = np.where(before <= after, lo, hi)
            gap = np.minimum(before, after)
            mean = gap.astype(np.float64) ** 2 / size
            reach = best[open_] * (1 + 1e-9) + 1
            going = (gap < _FAR) & (mean <= reach)
            open_, at, mean, reach = open_[going], at[going], mean[going], reach[going]
            mine, other = spread[open_], self.spread[at]
            near = mean + (mine - other) ** 2 <= reach + 1e-9 * (mine + other) ** 2
            rows, tried = open_[near], at[near]
            distance = ((x[rows] - self.vectors[tried]) ** 2).sum(axis=1)
            self.compared += len(rows)
            numbered = self.order[tried]
            wins = (distance < best[rows]) | ((distance == best[rows]) & (numbered < number[rows]))
            best[rows[wins]], number[rows[wins]] = distance[wins], numbered[wins]
            leftward = at < right[open_]
            left[open_[leftward]] -= 1
            right[open_[~leftward]] += 1
        return number, best


def _seeds(vectors: DataFrame, kind: str, size: int, scale: int, centroids: int, seed: int) -> np.ndarray:
    """The vectors with the smallest hashes of their ids, in that order; ``centroids`` rows at most reach the driver."""

    def quantised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places, values = integers(batch.column(1), size, scale)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(values) + 1, dtype=np.int32) * size), pa.array(values.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(places)), lists], ["_id", "_x"])

    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("_id").cast("string")), 256)
    found = vectors.filter(F.col("_id").isNotNull()).mapInArrow(quantised, f"_id {kind}, _x ARRAY<BIGINT>")
    rows = found.select(hashed.alias("_hash"), "_x").orderBy("_hash", "_x").limit(centroids).collect()
    return np.array([r._x for r in rows], np.int64).reshape(-1, size)


def _moved(vectors: DataFrame, centroids: np.ndarray, size: int, scale: int) -> np.ndarray:
    """Every centroid with vectors becomes the floor of their exact mean.

    A task adds up its vectors to one row for each centroid; those rows are added up by Spark, and one row for each centroid
    reaches the driver.
    """

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(centroids)
        totals, counts = np.zeros(centroids.shape, np.int64), np.zeros(len(centroids), np.int64)
        for batch in batches:
            _, values = integers(batch.column(1), size, scale)
            numbers, _ = search.nearest(values)
            np.add.at(totals, numbers, values)
            counts += np.bincount(numbers, minlength=len(centroids))
        some = np.nonzero(counts)[0]
        yield pa.RecordBatch.from_arrays(
            [pa.array(some.astype(np.int32)), pa.array(counts[some]), pa.array(list(totals[some]), pa.list_(pa.int64()))], ["_number", "_count", "_totals"]
        )

    parts = vectors.mapInArrow(added, "_number INT, _count BIGINT, _totals ARRAY<BIGINT>")
    sums = [F.sum(F.col("_totals")[i]).alias(f"_{i}") for i in range(size)]
    out = centroids.copy()
    for row in parts.groupBy("_number").agg(F.sum("_count").alias("_count"), *sums).collect():
        out[row["_number"]] = [row[f"_{i}"] // row["_count"] for i in range(size)]
    return out


def clusters(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", size: int = SIZE, scale: int = SCALE, centroids: int = CENTROIDS, rounds: int = ROUNDS, seed: int = SEED
) -> DataFrame:
    """``key``, cluster, distance, cluster_inertia, inertia, centroid_sha256 for every vector of ``size`` finite components.

    Components become floor(scale * x). The ``centroids`` vectors with the smallest sha256 of ``seed:key`` are the first
    centroids; ``rounds`` times every vector goes to the nearest (ties: the smaller number) and every centroid to the floor
    of its vectors' mean; then vectors are assigned once more. All figures are exact integers.

    Null and wrongly sized vectors and those with a null or not finite component are left out. A null key is clustered but
    seeds nothing; repeated rows count each by itself (also as seeds, in the order of their components); fewer vectors than
    ``centroids`` give fewer clusters. Other columns are ignored; an empty table gives an empty result. A component of
    ``LARGEST / scale`` or more raises, for distances would not fit. The driver holds ``centroids`` vectors, no more; every
    round reads the two columns of the table again.
    """
    kind = vectors.schema[key].dataType.simpleString()
    given = vectors.select(F.col(key).alias("_id"), F.col(vector).cast("array<double>").alias("_x"))
    now = _seeds(given, kind, size, scale, centroids, seed)
    if not len(now):
        # Without a seed there is nothing to be near to.
        return given.filter(F.lit(False)).selectExpr(f"_id AS `{key}`", "0 AS cluster", "0L AS distance", "0L AS cluster_inertia", "0L AS inertia", "'' AS centroid_sha256")
    for _ in range(rounds):
        now = _moved(given, now, size, scale)
    last = now

    def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(last)
        for batch in batches:
            places, values = integers(batch.column(1), size, scale)
            numbers, distances = search.nearest(values)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(places)), pa.array(numbers.astype(np.int32)), pa.array(distances)], ["_id", "cluster", "distance"])

    found = cut_lineage(given.mapInArrow(assigned, f"_id {kind}, cluster INT, distance BIGINT"))
    inertia = {r.cluster: r.inertia for r in found.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()}
    told = [(c, n, sum(inertia.values()), hashlib.sha256(",".join(map(str, last[c].tolist())).encode()).hexdigest()) for c, n in inertia.items()]
    # A row for each centroid, never more.
    of_cluster = vectors.sparkSession.createDataFrame(told, "cluster INT, cluster_inertia BIGINT, inertia BIGINT, centroid_sha256 STRING")
    return found.join(F.broadcast(of_cluster), "cluster").select(F.col("_id").alias(key), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
