"""Repeated passages: near-equal paragraphs and passages across lines by MinHash banding, verified by exact Jaccard similarity."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tablewarden.llm.common import TokenHashes, bounded_batches, cut_lineage, filter_bits, in_blocks, link_groups, one_bucket_per_set, passes, rolling, spread_join
from tablewarden.llm.components import connected_components

# Paragraphs of fewer words are no passages. Two are near-equal if their sets of five-word shingles are this similar.
MIN_WORDS, SHINGLE, SIMILARITY = 50, 5, 0.8
# Paragraphs as similar as that meet in a band with probability 1 - (1 - 0.8**4)**16 = 0.9998, more similar ones more surely.
BANDS, ROWS = 16, 4
CHUNK = 1 << 12
# A border is the least of so many shingle hashes in a row. The wider, the fewer passages and the shorter: of 50 words in a row, one
# of 24 words or more is found.
SPREAD = 14
# Texts that are held at once; passages whose words a task remembers to have told; members of a bucket that meet in one group.
SLICE, TOLD, PART = 128, 1 << 17, 1024
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
# A bitmap has eight bits or more for each of its hashes; it has 2**27 bits (16 MB in a task) at most.
MOST_FILTERED = 1 << 24
_FORTH, _MIX = np.uint64(0xD1342543DE82EF95), np.uint64(0x9FB21C651E98DF25)
_BACK = np.uint64(pow(int(_FORTH), -1, 1 << 64))


@lru_cache(maxsize=4)
def _constants(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(6)
    return rng.integers(0, 1 << 63, n, np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 1 << 63, n, np.uint64)


def recall(similarity: float, bands: int = BANDS, rows: int = ROWS) -> float:
    """Chance that two sets of this similarity agree in a whole band."""
    return 1 - (1 - similarity**rows) ** bands


@dataclass(frozen=True)
class Borders:
    """A text's words as hashes, the hash of every shingle of them, the shingles at which a border lies, and the long lines."""

    tokens: np.ndarray
    hashes: np.ndarray
    at: np.ndarray
    lines: np.ndarray


@dataclass(frozen=True)
class Passages:
    """The passages of a text as word ranges, told apart by ``name``; only passages of one ``group`` are compared.

    Long lines form group 0. All other passages lie across lines: they begin at a border, end with the first border that is far
    enough, and form a group with those that begin and end with the same words, so that neighbours that overlap are not taken
    for copies.
    """

    start: np.ndarray
    end: np.ndarray
    name: np.ndarray
    group: np.ndarray
    first: np.ndarray
    last: np.ndarray


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    return tuple(np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(n, base, np.uint64)))) for base in (_FORTH, _BACK))


def range_hashes(values: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of ranges of ``values`` from one running polynomial: sums up to a place, shifted back by the inverse of the base."""
    forth, back = _powers(1 << max(16, len(values).bit_length()))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values * forth[: len(values)], dtype=np.uint64)))
    mixed = ((sums[end] - sums[begin]) * back[begin] + (end - begin).astype(np.uint64)) * _MIX
    return mixed ^ (mixed >> np.uint64(31))


def borders(text: str, least: int) -> Borders:
    """Words stand between ASCII white space and are lower-cased. A border is the least shingle hash of ``SPREAD`` in a row.

    Equal words have equal borders, but for those near their ends.
    """
    data = np.frombuffer(text.lower().encode(), np.uint8)
    solid = np.concatenate((np.zeros(1, bool), ~_SPACE[data], np.zeros(1, bool)))
    edges = np.flatnonzero(solid[1:] != solid[:-1])
    begin, end = edges[::2], edges[1::2]
    tokens = range_hashes(data.astype(np.uint64), begin, end)
    ends = np.concatenate(([0], np.searchsorted(begin, np.flatnonzero(data == 10)), [len(begin)]))
    long = np.flatnonzero(np.diff(ends) >= least)
    lines = np.stack((ends[long], ends[long + 1]), axis=1)
    if len(tokens) < SHINGLE + SPREAD - 1:
        return Borders(tokens, np.zeros(0, np.uint64), np.zeros(0, np.int64), lines)
    hashes = range_hashes(tokens, np.arange(len(tokens) - SHINGLE + 1), np.arange(SHINGLE, len(tokens) + 1))
    chosen = np.lib.stride_tricks.sliding_window_view(hashes, SPREAD).argmin(axis=1) + np.arange(len(hashes) - SPREAD + 1)
    return Borders(tokens, hashes, chosen[np.concatenate((np.ones(1, bool), chosen[1:] != chosen[:-1]))], lines)


def passages(found: Borders, least: int, repeated: Callable[[np.ndarray], np.ndarray]) -> Passages:
    """The passages that can occur again: those between borders whose words do, and lines that hold such a border.

    Of ``least`` words in a row the first SPREAD and the last SPREAD shingles each hold a border, and the passage that begins at
    the first ends with the last or before: it lies in those words and is the same wherever they stand.
    """
    again = repeated(found.hashes[found.at])
    reach = np.searchsorted(found.at, found.at + least - SHINGLE - 2 * SPREAD + 2)
    whole = again & np.append(again, False)[reach]
    start, last = found.at[whole], found.at[reach[whole]]
    # Of passages of one text that begin with the same words and share their end the longest stands for all.
    longest = np.sort(np.unique(found.hashes[start] * _MIX ^ last.astype(np.uint64), return_index=True)[1])
    start, last = start[longest], last[longest]
    marked = np.concatenate(([0], np.cumsum(again)))
    inside = marked[np.searchsorted(found.at, found.lines[:, 1] - SHINGLE, side="right")] > marked[np.searchsorted(found.at, found.lines[:, 0])]
    lines = found.lines[inside]
    none = np.zeros(len(lines), np.uint64)
    first_hash, last_hash = (np.concatenate((found.hashes[x], none)) for x in (start, last))
    group = first_hash * _MIX ^ last_hash
    begin, end = np.concatenate((start, lines[:, 0])), np.concatenate((last + SHINGLE, lines[:, 1]))
    return Passages(begin, end, range_hashes(found.tokens, begin, end) ^ group, group, first_hash, last_hash)


def shingles(words: list[str], n: int, known: TokenHashes) -> np.ndarray:
    """Distinct hashes of the windows of ``n`` words; of fewer words the whole is one."""
    return np.unique(rolling(words, min(n, len(words)), known))


def band_keys(sets: list[np.ndarray], bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """64-bit keys, a row of ``bands`` for each set: the hashed MinHash values of a band. Sets may repeat their members."""
    a, b = _constants(bands * rows)
    out = np.empty((len(sets), bands), np.uint64)
    at = 0
    while at < len(sets):
        to, size = at, 0
        while to < len(sets) and (to == at or size + len(sets[to]) <= CHUNK):
            size += len(sets[to])
            to += 1
        if size > CHUNK:
            # One very long paragraph, in parts.
            parts = [sets[at][i : i + CHUNK] for i in range(0, size, CHUNK)]
            least = np.min([(p[:, None] * a + b).min(axis=0) for p in parts], axis=0)[None]
        else:
            starts = np.concatenate(([0], np.cumsum([len(x) for x in sets[at : to - 1]], dtype=np.int64))).astype(np.int64)
            least = np.minimum.reduceat(np.concatenate(sets[at:to])[:, None] * a + b, starts, axis=0)
        key = np.arange(1, bands + 1, dtype=np.uint64)[None]
        for part in least.reshape(to - at, bands, rows).transpose(2, 0, 1):
            key = (key ^ part) * np.uint64(0x9FB21C651E98DF25)
            key = key ^ (key >> np.uint64(28))
        out[at:to] = key
        at = to
    return out


def _verify(similarity: float):
    """Local components of a block pair: every paragraph reached is compared with those not reached yet.

    Counts of shared shingles come from the places of a paragraph's shingles among all of the group's, so only paragraphs
    that share one cost anything.
    """

    def run(columns: list) -> list[tuple[int, int]]:
        ids, first = np.unique(columns[0].to_numpy(), return_index=True)
        sets = [columns[1][int(i)].values.to_numpy() for i in first]
        sizes = np.array([len(s) for s in sets])
        flat, owner = np.concatenate(sets), np.repeat(np.arange(len(ids)), sizes)
        order = np.argsort(flat, kind="stable")
        flat, owner = flat[order], owner[order]
        waiting = np.ones(len(ids), bool)
        ends: list[tuple[int, int]] = []
        for seed in range(len(ids)):
            if not waiting[seed]:
                continue
            waiting[seed] = False
            queue = [seed]
            while queue and waiting.any():
                one = queue.pop()
                lo, hi = np.searchsorted(flat, sets[one]), np.searchsorted(flat, sets[one], side="right")
                shared = np.bincount(np.concatenate([owner[x:y] for x, y in zip(lo.tolist(), hi.tolist())]), minlength=len(ids))
                found = np.nonzero(waiting & (shared >= similarity * (sizes + sizes[one] - shared)) & (shared > 0))[0].tolist()
                ends.extend((int(ids[seed]), int(ids[x])) for x in found)
                queue.extend(found)
                waiting[found] = False
        return ends

    return run


class _Among:
    """Whether hashes are among those of a stored table: by a bitmap in the tasks up to a measured size, by a join beyond it."""

    def __init__(self, hashes: DataFrame, column: str):
        self._hashes, self._column = hashes, column
        size = hashes.count()
        self.bits = filter_bits(hashes, column, max(16, (size * 8 - 1).bit_length())) if size <= MOST_FILTERED else None

    def __getstate__(self) -> dict:
        return {"bits": self.bits}

    def marks(self, hashes: np.ndarray) -> np.ndarray:
        """True for all that are among them, and for few others; for all if they are joined."""
        held = np.full(len(hashes), self.bits is None)
        if self.bits is not None:
            held[passes(self.bits, hashes)] = True
        return held

    def exactly(self, rows: DataFrame, column: str, spread_by: list[str], besides: Column | None = None) -> DataFrame:
        """The rows that ``marks`` would keep, or those of ``besides``, where the bitmap was too large."""
        if self.bits is not None:
            return rows
        wanted = self._hashes.select(F.col(self._column).alias(column))
        if besides is None:
            return spread_join(rows, wanted, [column], spread_by, "left_semi")
        return rows.filter(besides).unionByName(spread_join(rows.filter(~besides), wanted, [column], spread_by, "left_semi"))


def repeated_passages(
    docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = MIN_WORDS, similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """``key``, start, n_words, cluster_id, n_members, kept_doc, kept_start, removed: a row for every passage that occurs again,
    exactly or nearly, in this or another document.

    Words are numbered from 0. Passages are the lines of at least ``least`` words and, over all line breaks, word ranges
    between content-defined borders (see ``Passages``); they overlap, so that every run of ``least`` words that occurs again
    holds one. Lines meet by their bands, the others by the words at both of their ends; what meets is compared exactly. A
    cluster is a component of links of at least ``similarity``; its first member (smallest key, then row, then
    start) stays and the others are to be removed. Equal passages are one node and never paired. Null and empty texts have no
    passages; a null key is larger than any other; repeated rows repeat their passages; other columns are ignored; an empty
    table gives an empty result.
    """
    # Rows are numbered and their passages stored in one pass: the numbers are never made a second time.
    given = bounded_batches(docs).select(F.col(key).alias("_id"), F.monotonically_increasing_id().alias("_row"), F.col(text).cast("string").alias("_text"))
    kind = docs.schema[key].dataType.simpleString()

    def each_slice(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, list[Borders]]]:
        for batch in batches:
            for lo in range(0, batch.num_rows, SLICE):
                part = batch.slice(lo, SLICE)
                yield part, [borders(v.as_py() or "", least) for v in part.column(column)]

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, found in each_slice(batches, 0):
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([f.hashes[f.at] for f in found]).view(np.int64))], ["_anchor"])

    counted = given.select("_text").mapInArrow(anchors, "_anchor BIGINT").groupBy("_anchor").agg(F.count(F.lit(1)).alias("_n"))
    again = cut_lineage(counted.filter("_n > 1").select("_anchor"))
    repeated = _Among(again, "_anchor")

    def fresh(told: set[int], own: Passages, where: np.ndarray) -> list[int]:
        """Places of the passages that a task has not told yet; what it has told is forgotten now and then."""
        out = []
        for i in np.flatnonzero(where).tolist():
            if (name := int(own.name[i])) not in told:
                if len(told) >= TOLD:
                    told.clear()
                told.add(name)
                out.append(i)
        return out

    def occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told: set[int] = set()
        for part, found in each_slice(batches, 2):
            own = [passages(f, least, repeated.marks) for f in found]
            sets, shown = [], []
            for f, o in zip(found, own):
                new = np.zeros(len(o.start), bool)
                new[places := fresh(told, o, o.group == 0)] = True
                shown.append(new)
                sets += [f.hashes[o.start[i] : o.end[i] - SHINGLE + 1] for i in places]
            keys = band_keys(sets, bands, rows)
            new = np.concatenate(shown)
            ends = np.concatenate(([0], np.cumsum(np.where(new, bands, 0)))).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(keys.view(np.int64).ravel()), mask=pa.array(~new))
            taken = pa.array(np.repeat(np.arange(len(own)), [len(o.start) for o in own]))
            start, end, *hashes = (np.concatenate([getattr(o, f) for o in own]) for f in ("start", "end", "name", "group", "first", "last"))
            arrays = [part.column(0).take(taken), part.column(1).take(taken), pa.array(start.astype(np.int32)), pa.array((end - start).astype(np.int32)), *(pa.array(h.view(np.int64)) for h in hashes)]
            yield pa.RecordBatch.from_arrays([*arrays, lists], ["_id", "_row", "_start", "_words", "_pid", "_group", "_first", "_last", "_bands"])

    found = given.mapInArrow(occurrences, f"_id {kind}, _row BIGINT, _start INT, _words INT, _pid BIGINT, _group BIGINT, _first BIGINT, _last BIGINT, _bands ARRAY<BIGINT>")
    for end in ("_first", "_last"):
        found = repeated.exactly(found, end, ["_row", "_start"], F.col("_group") == 0)
    found = cut_lineage(found.drop("_first", "_last"))
    told = found.filter("_bands IS NOT NULL").groupBy("_pid").agg(F.first("_bands").alias("_bands")).select("_pid", F.explode("_bands").alias("_key"))
    # A line meets others by its bands; a passage across lines those with the same ends, where they are not all equal.
    across = found.filter("_group <> 0").select("_pid", "_group").distinct()
    mixed = across.groupBy("_group").agg(F.min("_pid").alias("_low"), F.max("_pid").alias("_high")).filter("_low <> _high").select("_group")
    members = cut_lineage(told.unionByName(across.join(mixed, "_group").select("_pid", F.col("_group").alias("_key"))))
    picked = cut_lineage(one_bucket_per_set(members, "_key", "_pid", {}, F.lit(True)))
    dealt = cut_lineage(in_blocks(members, picked, "_key", "_pid", PART).select("_g", "_pid"))
    wanted = _Among(cut_lineage(dealt.select("_pid").distinct()), "_pid")

    def spelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told: set[int] = set()
        for _, found in each_slice(batches, 0):
            names, sets = [], []
            for f in found:
                own = passages(f, least, repeated.marks)
                for i in fresh(told, own, wanted.marks(own.name)):
                    names.append(own.name[i])
                    sets.append(np.unique(f.hashes[own.start[i] : own.end[i] - SHINGLE + 1]).view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(np.array(names, np.uint64).view(np.int64)), pa.array(sets, pa.list_(pa.int64()))], ["_pid", "_set"])

    # The words of the passages that meet another one, read again rather than stored for all.
    sets = wanted.exactly(given.select("_text").mapInArrow(spelled, "_pid BIGINT, _set ARRAY<BIGINT>"), "_pid", ["_set"]).groupBy("_pid").agg(F.first("_set").alias("_set"))
    edges = link_groups(dealt.join(sets, "_pid").select("_g", "_pid", "_set"), "_g", _verify(similarity))
    roots = connected_components(edges).select(F.col("node").alias("_pid"), "root")
    classes = found.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"), F.min(F.struct(F.col("_id").isNull().alias("none"), F.col("_id").alias("id"), F.col("_row").alias("row"), F.col("_start").alias("start"))).alias("_first"))
    # Only the passages that are linked to different ones take part in components; all others are clusters by themselves.
    rooted = classes.join(roots, "_pid", "left")
    linked = rooted.filter("root IS NOT NULL")
    clusters = linked.groupBy("root").agg(F.sum("_n").alias("n_members"), F.min("_first").alias("_kept"))
    of_pid = spread_join(linked.select("_pid", "root"), clusters, ["root"], ["_pid"], "inner").select("_pid", "root", "n_members", "_kept")
    alone = rooted.filter("root IS NULL AND _n > 1").select("_pid", F.col("_pid").alias("root"), F.col("_n").alias("n_members"), F.col("_first").alias("_kept"))
    of_pid = of_pid.unionByName(alone)
    stays = (F.col("_row") == F.col("_kept.row")) & (F.col("_start") == F.col("_kept.start"))
    # Both sides are exchanged for this join, so that adaptive execution can split a passage that stands in very many texts.
    return found.drop("_group", "_bands").join(of_pid, "_pid").select(
        F.col("_id").alias(key), F.col("_start").alias("start"), F.col("_words").alias("n_words"), F.col("root").alias("cluster_id"), "n_members",
        F.col("_kept.id").alias("kept_doc"), F.col("_kept.start").alias("kept_start"), (~stays).alias("removed"),
    )
