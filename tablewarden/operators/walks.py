"""Breadth-first walks from many nodes at once, over a graph that a task holds as arrays of numbers."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

# Pairs that the walks of one block of roots may find, beyond which the block is cut, and edges followed at a time.
PAIRS = STEP = 1 << 18
SLOTS_BITS = 20
# Up to so many places one flag each tells what was found; beyond, a hash table of twice the pairs that a block may hold.
FLAGS = 1 << 22
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Graph:
    """Node i is called ``names[i]`` and leads to ``targets[bounds[i] : bounds[i + 1]]``."""

    names: pa.Array
    bounds: np.ndarray
    targets: np.ndarray

    @staticmethod
    def of(names: pa.Array, start: np.ndarray, end: np.ndarray) -> Graph:
        """Edges lead from ``start`` to ``end``, fewer than 2^31."""
        bounds = np.concatenate([[0], np.cumsum(np.bincount(start, minlength=len(names)))]).astype(np.int32)
        return Graph(names, bounds, end[np.argsort(start)].astype(np.int32))


class _Found:
    """The keys found so far in the walks of one block."""

    def __init__(self, keys: int, flags: bool):
        self.flags = np.zeros(keys, bool) if flags else None
        self.slots = None if flags else np.full(1 << SLOTS_BITS, -1, np.int64)

    def add(self, keys: np.ndarray) -> np.ndarray:
        """Those of the distinct ``keys`` that were not found before."""
        if self.flags is not None:
            new = keys[~self.flags[keys]]
            self.flags[new] = True
            return new
        is_new, rest = np.zeros(len(keys), bool), np.arange(len(keys))
        slot = ((keys.view(np.uint64) * _MULTIPLIER) >> np.uint64(64 - SLOTS_BITS)).astype(np.int64)
        while len(rest):
            wanted = keys[rest]
            free = self.slots[slot] < 0
            # Of several keys for one free slot the last gets it; the others go on to the next.
            self.slots[slot[free]] = wanted[free]
            placed = self.slots[slot] == wanted
            is_new[rest[placed & free]] = True
            rest, slot = rest[~placed], (slot[~placed] + 1) & ((1 << SLOTS_BITS) - 1)
        return keys[is_new]


def _next(graph: Graph, last: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    """The distinct keys one edge away from ``last``, piece by piece: a hub's edges too are cut into pieces."""
    node = last & ((1 << bits) - 1)
    first, count = graph.bounds[node], graph.bounds[node + 1] - graph.bounds[node]
    ends = np.cumsum(count)
    for low in range(0, int(ends[-1]), STEP):
        rows = slice(np.searchsorted(ends, low, "right"), np.searchsorted(ends, low + STEP, "left") + 1)
        before = ends[rows] - count[rows]
        skipped = np.maximum(low - before, 0)
        taken = np.minimum(low + STEP - before, count[rows]) - skipped
        shift = first[rows] + skipped - (np.cumsum(taken) - taken)
        keys = graph.targets[np.arange(taken.sum()) + np.repeat(shift, taken)] + np.repeat(last[rows] - node[rows], taken)
        keys.sort()
        yield keys[np.concatenate([[True], keys[1:] != keys[:-1]])]


def _walk(graph: Graph, roots: np.ndarray, max_hops: int | None) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """(root, node, distance) of a block of roots; None if several roots find more than ``PAIRS`` together."""
    # A key is the root's place in the block and the node.
    bits = max(1, (len(graph.names) - 1).bit_length())
    last = (np.arange(len(roots), dtype=np.int64) << bits) + roots
    found = _Found(len(roots) << bits, len(roots) == 1 or len(roots) << bits <= FLAGS)
    found.add(last)
    levels: list[np.ndarray] = []
    total = len(roots)
    while len(last) and (max_hops is None or len(levels) < max_hops):
        new = [last[:0]]
        for keys in _next(graph, last, bits):
            new.append(found.add(keys))
            total += len(new[-1])
            if total > PAIRS and len(roots) > 1:
                return None
        last = np.concatenate(new)
        levels.append(last)
    keys = np.concatenate([last[:0], *levels])
    distances = np.repeat(np.arange(1, len(levels) + 1, dtype=np.int32), [len(level) for level in levels])
    return roots[keys >> bits], keys & ((1 << bits) - 1), distances


def walks(graph: Graph, roots: np.ndarray, max_hops: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(root, node, distance) of all nodes that are reached from each of the distinct ``roots``, block by block, with the fewest hops."""
    at, size = 0, 64
    while at < len(roots):
        block = roots[at : at + size]
        found = _walk(graph, block, max_hops)
        if found is None:
            size = max(1, len(block) // 4)
            continue
        yield found
        at += len(block)
        # So that the next block finds about two thirds of what it may.
        size = max(1, min(4 * len(block), 2 * PAIRS * len(block) // (3 * (len(block) + len(found[0])))))
