"""Tokens of two public tokenizers aligned by the bytes that they cover."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tablewarden.llm.common import bounded_batches, cut_lineage, in_all_tasks, spread_join

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
# Bytes of text that are aligned at once, and distinct id pairs of documents that make a block. A longer text is taken whole.
BATCH, BLOCK = 1 << 20, 1 << 19


@dataclass(frozen=True)
class Side:
    """A tokenizer: ids of many texts, the bytes of every id, and the text of every id as a group's first or later one."""

    encode: Callable[[list[str]], list[np.ndarray]]
    spelled: list[bytes]
    lengths: np.ndarray

    @classmethod
    def of(cls, encode: Callable[[list[str]], list[np.ndarray]], spelled: list[bytes]) -> Side:
        return cls(encode, spelled, np.array([len(s) for s in spelled], np.int64))


@lru_cache(maxsize=2)
def byte_level(ranks: str) -> Side:
    """Byte-level BPE over space and text; the strings of special tokens are plain text. The ids are those of the JSON form of the vocabulary."""
    with open(ranks, "rb") as lines:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    spelled = [b""] * (max(table.values()) + 1)
    for token, rank in table.items():
        spelled[rank] = token
    coder = tiktoken.Encoding("byte_level", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
    return Side.of(lambda texts: [coder.encode_to_numpy(" " + t, disallowed_special=()).astype(np.int64) for t in texts], spelled)


@lru_cache(maxsize=2)
def piece_level(model: str) -> Side:
    """Pieces of a text, to which the model itself adds the space before; byte pieces stand for their byte."""
    coder = sentencepiece.SentencePieceProcessor(model_file=model)
    ids = range(coder.get_piece_size())
    spelled = [bytes([int(coder.id_to_piece(i)[3:-1], 16)]) if coder.is_byte(i) else coder.id_to_piece(i).replace("▁", " ").encode() for i in ids]
    return Side.of(lambda texts: [np.array(t, np.int64) for t in coder.encode(texts, num_threads=1)], spelled)


def overlapping(a: pd.DataFrame, b: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(places in ``a``, places in ``b``) of all tokens whose byte ranges overlap.

    Frames have the columns doc and at, the token's first byte, ordered by at; tokens of a document cover the same bytes on
    both sides. Of two ranges that overlap, one begins inside the other: every token finds the other side's covering token,
    in both directions. Tokens that begin together find each other twice and are taken once.
    """
    found = pd.merge_asof(a, b.assign(there=np.arange(len(b))), on="at", by="doc")["there"].to_numpy(np.int64)
    back = pd.merge_asof(b, a.assign(there=np.arange(len(a))), on="at", by="doc")["there"].to_numpy(np.int64)
    later = np.nonzero(a["at"].to_numpy()[back] != b["at"].to_numpy())[0]
    return np.concatenate((np.arange(len(a)), back[later])), np.concatenate((found, later))


@dataclass(frozen=True)
class Aligned:
    """Figures of some texts, and their linked id pairs: the text, the pair (A's id shifted by ``bits``, then B's) and its links."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    groups: list[str]
    doc: np.ndarray
    pair: np.ndarray
    times: np.ndarray


def bits(side: Side) -> int:
    return (len(side.spelled) - 1).bit_length()


def align(texts: list[str | None], left: Side, right: Side) -> Aligned:
    n = len(texts)
    given = [t or "" for t in texts]
    sides = []
    for side in (left, right):
        ids = side.encode(given)
        same = [bool(t) and b"".join(map(side.spelled.__getitem__, x.tolist())) == b" " + t.encode() for t, x in zip(given, ids)]
        sides.append((ids, same))
    usable = [i for i in range(n) if sides[0][1][i] and sides[1][1][i]]
    frames, flat, ends = [], [], []
    for (ids, _), side in zip(sides, (left, right)):
        held = np.concatenate([ids[i] for i in usable] or [np.zeros(0, np.int64)])
        end = np.cumsum(side.lengths[held])
        flat.append(held)
        ends.append(end)
        frames.append(pd.DataFrame({"doc": np.repeat(np.array(usable, np.int64), [len(ids[i]) for i in usable]), "at": end - side.lengths[held]}))
    a, b = overlapping(*frames)
    doc = frames[0]["doc"].to_numpy()[a]
    shift, low = bits(left) + bits(right), bits(right)
    coded, times = np.unique((doc << shift) | (flat[0][a] << low) | flat[1][b], return_counts=True)
    groups, n_groups = _groups(n, usable, [f["doc"].to_numpy() for f in frames], flat, ends)
    return Aligned(
        *(np.bincount(f["doc"].to_numpy(), minlength=n) for f in frames), n_groups, np.bincount(doc, minlength=n), groups, coded >> shift, coded & ((1 << shift) - 1), times,
    )


@lru_cache(maxsize=4)
def _parts(mark: str, n: int) -> list[str]:
    return [f"{mark}{i}" for i in range(n)]


def _groups(n: int, usable: list[int], docs: list[np.ndarray], ids: list[np.ndarray], ends: list[np.ndarray]) -> tuple[list[str], np.ndarray]:
    """``a1,a2|b1;a3|b2,b3`` of every text, and the number of its groups: they end where tokens of both sides end."""
    common = np.intersect1d(*ends, assume_unique=True)
    group = [np.searchsorted(common, e) for e in ends]
    firsts = [np.concatenate((np.ones(min(1, len(g)), bool), g[1:] != g[:-1])) for g in group]
    starts = [np.nonzero(f)[0] for f in firsts]
    # A's tokens of a group stand before B's of it.
    place = [np.arange(len(group[0])) + starts[1][group[0]], np.arange(len(group[1])) + np.append(starts[0][1:], len(group[0]))[group[1]]]
    size = max((int(i.max()) + 1 for i in ids if len(i)), default=0)
    size = 1 << size.bit_length()
    table = [*_parts(";", size), *_parts("|", size), *_parts(",", size)]
    words = np.empty(len(ids[0]) + len(ids[1]), np.int64)
    for side in (0, 1):
        words[place[side]] = ids[side] + size * np.where(firsts[side], side, 2)
    spelled, out, at = words.tolist(), [""] * n, 0
    for i, count in zip(usable, np.bincount(np.concatenate(docs), minlength=n)[usable].tolist() if usable else []):
        out[i] = "".join(map(table.__getitem__, spelled[at : at + count]))[1:]
        at += count
    return out, np.bincount(docs[0][starts[0]], minlength=n)


def _slices(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Runs of rows of ``most`` bytes at most, or of one row."""
    at, held = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if i > at and held + size > most:
            yield at, i
            at, held = i, 0
        held += size
    if at < len(sizes):
        yield at, len(sizes)


def _summed(keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    distinct, inverse = np.unique(keys, return_inverse=True)
    return distinct, np.bincount(inverse, times, len(distinct)).astype(np.int64)


def aligned_tokens(docs: DataFrame, key: str = "doc_id", text: str = "text", ranks: str = RANKS, model: str = PIECES) -> DataFrame:
    """``key``, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 for every row.

    Tokens of both sides are cut into groups where both end; a link is a pair of tokens whose bytes overlap. count_sum adds,
    over the links, how many links of the whole table hold the same two ids; n_best counts the links whose two ids are linked
    as often as any with that id of B (ties included).

    Null and empty texts and those that a tokenizer does not give back byte for byte have no tokens: zeros, and an empty
    groups_sha256. Null and repeated keys are rows like any other; repeated rows count each; other columns are ignored; an
    empty table gives an empty result. A very long text is aligned whole, in one task.

    Documents are stored in blocks with their id pairs. Pairs are added up by block, then over all; the figures go back
    to the blocks that hold the pair, and each block is finished with its own pairs only.
    """
    kind = docs.schema[key].dataType.simpleString()
    given = bounded_batches(docs).select(F.col(key).alias("_id"), F.col(text).cast("string").alias("_text"))
    shift, low = bits(byte_level(ranks)) + bits(piece_level(model)), bits(piece_level(model))
    stored = f"_id {kind}, _block BIGINT, _whole BOOLEAN, n_a BIGINT, n_b BIGINT, n_groups BIGINT, n_links BIGINT, groups_sha256 STRING, _pairs ARRAY<BIGINT>"
    names = [c.split()[0] for c in stored.split(", ")]

    def lists(counts: np.ndarray, pairs: np.ndarray, times: np.ndarray) -> pa.ListArray:
        # Two ids take ``shift`` bits of a number; the links of one text or block that hold them take the others.
        if len(times) and int(times.max()) >= 1 << 63 - shift:
            raise ValueError("a block holds more links of two ids than are counted")
        return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts))).astype(np.int32)), pa.array(pairs | times << shift))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left, right = byte_level(ranks), piece_level(model)
        block = TaskContext.get().partitionId() << 32
        pairs, times = np.zeros(0, np.int64), np.zeros(0, np.int64)
        held = 0

        def total() -> pa.RecordBatch:
            zero = pa.array([0], pa.int64())
            return pa.RecordBatch.from_arrays(
                [pa.nulls(1, kind_of), pa.array([block]), pa.array([True]), zero, zero, zero, zero, pa.array([""]), lists(np.array([len(pairs)]), pairs, times)], names
            )

        kind_of = None
        for batch in batches:
            texts = batch.column(1)
            kind_of = batch.column(0).type
            sizes = np.nan_to_num(pa.compute.binary_length(texts).to_numpy(zero_copy_only=False)).astype(np.int64)
            for lo, hi in _slices(sizes, BATCH):
                got = align(texts.slice(lo, hi - lo).to_pylist(), left, right)
                hashes = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in got.groups]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(lo, hi - lo), pa.array(np.full(hi - lo, block)), pa.array(np.zeros(hi - lo, bool)),
                        *(pa.array(x.astype(np.int64)) for x in (got.n_a, got.n_b, got.n_groups, got.n_links)), pa.array(hashes, pa.string()),
                        lists(np.bincount(got.doc, minlength=hi - lo), got.pair, got.times),
                    ],
                    names,
                )
                pairs, times = _summed(np.concatenate((pairs, got.pair)), np.concatenate((times, got.times)))
                held += len(got.pair)
                if held >= BLOCK:
                    yield total()
                    block, held, pairs, times = block + 1, 0, pairs[:0], times[:0]
        if held:
            yield total()

    rows = cut_lineage(given.mapInArrow(run, stored))
    coded = rows.filter("_whole").select("_block", F.explode("_pairs").alias("_p"))
    in_block = coded.select("_block", F.col("_p").bitwiseAND(F.lit((1 << shift) - 1)).alias("pair"), F.shiftright("_p", shift).alias("n"))
    counts = in_block.groupBy("pair").agg(F.sum("n").alias("count")).withColumn("_b", F.col("pair").bitwiseAND(F.lit((1 << low) - 1)))
    counts = cut_lineage(counts)
    # A row for each id of B at most: bounded by its vocabulary.
    best = F.broadcast(counts.groupBy("_b").agg(F.max("count").alias("best")))
    known = counts.join(best, "_b").select("pair", "count", (F.col("count") == F.col("best")).alias("is_best"))
    # A pair of frequent words is in every block.
    wanted = spread_join(in_block.select(F.col("_block").alias("_in"), "pair"), known, ["pair"], ["_in"], "inner")
    figures = "n_a BIGINT, n_b BIGINT, n_groups BIGINT, n_links BIGINT, n_best BIGINT, count_sum BIGINT, groups_sha256 STRING"

    def finish(part: pa.Table, found: pa.Table) -> pa.Table:
        part, found = part.combine_chunks(), found.sort_by("pair").combine_chunks()
        pair, count, is_best = (found[c].to_numpy() for c in ("pair", "count", "is_best"))
        held = part["_pairs"].combine_chunks()
        held = held.chunk(0) if isinstance(held, pa.ChunkedArray) else held
        coded = held.flatten().to_numpy()
        doc = np.repeat(np.arange(len(held)), held.value_lengths().to_numpy())
        at, times = np.searchsorted(pair, coded & ((1 << shift) - 1)), coded >> shift
        n_best, count_sum = np.zeros(len(held), np.int64), np.zeros(len(held), np.int64)
        np.add.at(n_best, doc, np.where(is_best[at], times, 0))
        np.add.at(count_sum, doc, times * count[at])
        return pa.table([part["_id"], part["n_a"], part["n_b"], part["n_groups"], part["n_links"], pa.array(n_best), pa.array(count_sum), part["groups_sha256"]], ["_id", *(c.split()[0] for c in figures.split(", "))])

    documents = rows.filter("NOT _whole").drop("_whole")
    # A block is bounded by its pairs, or by one text.
    done = in_all_tasks(documents, "_block").groupBy("_block").cogroup(in_all_tasks(wanted, "_in").groupBy("_in")).applyInArrow(finish, f"_id {kind}, {figures}")
    return done.withColumnRenamed("_id", key)
