"""Repeated passages wherever they stand: runs of equal words over line breaks and inside longer lines, found by winnowing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tablewarden.llm.common import TokenHashes, cut_lineage, filter_bits, passes, rolling, spread_join
from tablewarden.llm.paragraphs import MIN_WORDS

_MIX = np.uint64(0x9FB21C651E98DF25)


def groups(words: list[str], least: int, known: TokenHashes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(windows, anchors, first, last, extents): the hash of every window of ``least`` words, and the groups of following windows
    that have one anchor: its hash, their first and last place, and the hash of all their words.

    The anchor of a window is the least hash of the windows of half the length in it, the first of equal ones. Equal windows
    have equal anchors at equal distances, so what a window equals is in groups of the same anchor.
    """
    windows = rolling(words, least, known)
    if not len(windows):
        return windows, windows, *[np.zeros(0, np.int64)] * 2, windows
    half = (least + 1) // 2
    inner = rolling(words, half, known)
    chosen = np.lib.stride_tricks.sliding_window_view(inner, least - half + 1).argmin(axis=1) + np.arange(len(windows))
    first = np.concatenate(([0], np.nonzero(chosen[1:] != chosen[:-1])[0] + 1))
    last = np.concatenate((first[1:], [len(windows)])) - 1
    anchors = inner[chosen[first]]
    # The first and the last window cover the words of all of a group.
    extents = (windows[first] * _MIX ^ windows[last]) * _MIX + (last - first).astype(np.uint64) * np.uint64(2) + (chosen[first] - first).astype(np.uint64) * _MIX
    return windows, anchors, first, last, extents ^ (extents >> np.uint64(29))


def units(words: list[str], least: int, known: TokenHashes, repeated: np.ndarray, mixed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, place, words) of what may occur again: whole groups of windows, or single windows where groups of an anchor differ."""
    windows, anchors, first, last, extents = groups(words, least, known)
    again = np.zeros(len(anchors), bool)
    again[passes(repeated, anchors)] = True
    single = np.zeros(len(anchors), bool)
    single[passes(mixed, anchors)] = True
    whole, single = again & ~single, again & single
    each = np.concatenate([np.arange(a, b + 1) for a, b in zip(first[single].tolist(), last[single].tolist())] or [np.zeros(0, np.int64)])
    hashes = np.concatenate((extents[whole], windows[each]))
    return hashes, np.concatenate((first[whole], each)), np.concatenate(((last - first)[whole], np.zeros(len(each), np.int64))) + least


def runs(marked: np.ndarray) -> list[tuple[int, int]]:
    """(start, length) of the runs of true values."""
    edges = np.nonzero(np.diff(np.concatenate(([0], marked.astype(np.int8), [0]))))[0]
    return [(a, b - a) for a, b in zip(edges[::2].tolist(), edges[1::2].tolist())]


def repeated_spans(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = MIN_WORDS) -> DataFrame:
    """``key``, start, n_words, removed: the runs of words of every text that stand in a window of ``least`` words which occurs again,
    in this or another text.

    Words are those between white space, lower-cased and numbered from 0; line breaks do not matter. The first place of a window
    (smallest key, then row, then place) stays whole; the other words of repeated windows are to be removed. Every repeated window
    is found. Null and shorter texts have none; a null key is larger than any other; repeated rows repeat their windows; other
    columns are ignored; an empty table gives an empty result.
    """
    given = docs.select(F.col(key).alias("_id"), F.monotonically_increasing_id().alias("_row"), F.col(text).cast("string").alias("_text"))
    kind = docs.schema[key].dataType.simpleString()

    def anchored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = TokenHashes()
        for batch in batches:
            made = [groups((v.as_py() or "").lower().split(), least, known)[1::3] for v in batch.column(0)]
            columns = [np.concatenate([m[i] for m in made] or [np.zeros(0, np.uint64)]).view(np.int64) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["_anchor", "_extent"])

    anchors = given.select("_text").mapInArrow(anchored, "_anchor BIGINT, _extent BIGINT").groupBy("_anchor")
    again = cut_lineage(anchors.agg(F.count(F.lit(1)).alias("_n"), F.min("_extent").alias("_low"), F.max("_extent").alias("_high")).filter("_n > 1").select("_anchor", F.expr("_low <> _high").alias("_mixed")))
    # A bit decides alike for all groups of an anchor, so one that is set by another anchor costs rows and changes nothing.
    repeated, mixed = filter_bits(again, "_anchor"), filter_bits(again.filter("_mixed"), "_anchor")

    def occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = TokenHashes()
        for batch in batches:
            made = [units((v.as_py() or "").lower().split(), least, known, repeated, mixed) for v in batch.column(2)]
            taken = pa.array(np.repeat(np.arange(len(made)), [len(m[0]) for m in made]))
            hashes, at, size = (np.concatenate([m[i] for m in made] or [np.zeros(0, np.int64)]) for i in range(3))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(taken), batch.column(1).take(taken), pa.array(hashes.astype(np.uint64).view(np.int64)), pa.array(at.astype(np.int32)), pa.array(size.astype(np.int32))],
                ["_id", "_row", "_hash", "_at", "_size"],
            )

    # Rows are numbered and their units stored in one pass: the numbers are never made a second time.
    found = cut_lineage(given.mapInArrow(occurrences, f"_id {kind}, _row BIGINT, _hash BIGINT, _at INT, _size INT"))
    place = F.struct(F.col("_id").isNull().alias("none"), F.col("_id").alias("id"), F.col("_row").alias("row"), F.col("_at").alias("at"))
    firsts = found.groupBy("_hash").agg(F.count(F.lit(1)).alias("_n"), F.min(place).alias("_first")).filter("_n > 1")
    firsts = firsts.select("_hash", F.col("_first.row").alias("_first_row"), F.col("_first.at").alias("_first_at"))
    stays = (F.col("_row") == F.col("_first_row")) & (F.col("_at") == F.col("_first_at"))
    judged = spread_join(found, firsts, ["_hash"], ["_row"], "inner").select("_id", "_row", F.struct("_at", "_size", stays.alias("_stays")).alias("_unit"))
    # A list is bounded by the length of its text.
    texts = judged.groupBy("_row").agg(F.first("_id").alias("_id"), F.collect_list("_unit").alias("_units"))

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, made = [], []
            for row, units_ in enumerate(batch.column(1)):
                at, size, first = (f.to_numpy(zero_copy_only=False) for f in units_.values.flatten())
                edges = np.zeros((2, int((at + size).max()) + 1), np.int64)
                for which in (0, 1):
                    own = first == bool(which)
                    np.add.at(edges[which], at[own], 1)
                    np.add.at(edges[which], (at + size)[own], -1)
                other, kept = edges.cumsum(axis=1)[:, :-1] > 0
                spans = [(*r, False) for r in runs(kept)] + [(*r, True) for r in runs(other & ~kept)]
                rows += [row] * len(spans)
                made += sorted(spans)
            start, n_words, removed = zip(*made) if made else ([], [], [])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(start, pa.int32()), pa.array(n_words, pa.int32()), pa.array(removed, pa.bool_())], ["_id", "start", "n_words", "removed"]
            )

    made = texts.select("_id", "_units").mapInArrow(joined, f"_id {kind}, start INT, n_words INT, removed BOOLEAN")
    return made.select(F.col("_id").alias(key), "start", "n_words", "removed")
