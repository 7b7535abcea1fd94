"""Documents tokenized, cut and packed into as few sequences of a fixed length as the search finds."""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window as W, functions as F

from tablewarden.llm.binplan import Plan, complete_bins
from tablewarden.llm.common import bounded_batches, cut_lineage

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
END_ID, LENGTH = 2, 1024
# Fixed value: the added token that the vocabulary's JSON form declares; inside a text it is one id, as its library reads it.
SPECIAL = {"<|endoftext|>": 50256}
PIECE_DDL = "piece INT, start BIGINT, length BIGINT, ids_crc32 BIGINT"

_LOOKAHEAD = r"\s+(?!\S)|\s+"
_TWO_SPACES = re.compile(r"\s\s")


@lru_cache(maxsize=2)
def _encodings(ranks: str) -> tuple[tiktoken.Encoding, tiktoken.Encoding]:
    """The vocabulary with its own split pattern, and with one that needs no lookahead.

    Both split alike a text in which no white space follows white space; there the second is twice as fast.
    """
    with open(ranks, "rb") as lines:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    patterns = public_tokenizers.PATTERN, public_tokenizers.PATTERN.replace(_LOOKAHEAD, r"\s")
    return tuple(tiktoken.Encoding(f"byte_bpe_{i}", pat_str=p, mergeable_ranks=table, special_tokens=SPECIAL) for i, p in enumerate(patterns))


def encode(text: str, ranks: str = RANKS) -> np.ndarray:
    """Ids as little-endian uint32; the string of the added token is that token."""
    own, plain = _encodings(ranks)
    return (own if _TWO_SPACES.search(text) else plain).encode_to_numpy(text, allowed_special="all").astype("<u4", copy=False)


def cuts(n: int, length: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: only the first of several may be shorter."""
    if n <= length:
        return [(0, n)]
    first = n % length or length
    return [(0, first), *((at, length) for at in range(first, n, length))]


def pieces(docs: DataFrame, key: str, text: str, ranks: str, length: int) -> DataFrame:
    """``key`` and the pieces of every row; a null text is empty and gives the end id alone."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, made = [], []
            for row, value in enumerate(batch.column(1)):
                ids = np.append(encode(value.as_py() or "", ranks), np.uint32(END_ID)).astype("<u4", copy=False)
                data = memoryview(ids.tobytes())
                for i, (start, n) in enumerate(cuts(len(ids), length)):
                    rows.append(row)
                    made.append((i, start, n, zlib.crc32(data[4 * start : 4 * (start + n)])))
            columns = np.array(made, np.int64).reshape(-1, 4).T
            arrays = [pa.array(columns[0], pa.int32()), *(pa.array(c, pa.int64()) for c in columns[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), *arrays], ["_id", "piece", "start", "length", "ids_crc32"])

    return bounded_batches(docs).select(F.col(key).alias("_id"), F.col(text).cast("string").alias("_text")).mapInArrow(run, f"_id {kind}, {PIECE_DDL}")


def places(plan: Plan) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, end rank, times in a sequence, first sequence, offset) for every size of every filling."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for filling, times in plan:
        offset = 0
        for size, each in filling:
            first = used.get(size, 0)
            used[size] = first + times * each
            rows.append((size, first, used[size], each, sequence, offset))
            offset += size * each
        sequence += times
    return rows


def pack(docs: DataFrame, key: str = "doc_id", text: str = "text", ranks: str = RANKS, length: int = LENGTH) -> DataFrame:
    """A row per piece: ``key``, piece, start, length, ids_crc32, sequence_id, offset.

    Pieces of equal length are interchangeable, so the search sees only the count of each length (at most ``length``
    numbers, read by the driver). Its plan gives every rank within a length a sequence and an offset. Ranks are numbered
    within a length and a stored partition, after the offsets of the partitions before, so no task holds a whole
    length. Null and empty texts are one piece of the end id; null and repeated keys are packed like any other row;
    other columns are ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    cut = cut_lineage(pieces(docs, key, text, ranks, length))
    held = cut.withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id())
    per_part = cut_lineage(held.groupBy("length", "_part").agg(F.count(F.lit(1)).alias("_n")))
    counts = {r.length: r.n for r in per_part.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    plan = complete_bins(counts, length)
    # At most some rows for each of ``length`` sizes, whatever the corpus.
    where = spark.createDataFrame(places(plan), "length BIGINT, _first BIGINT, _end BIGINT, _each BIGINT, _sequence BIGINT, _offset BIGINT")
    earlier = W.partitionBy("length").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = per_part.select("length", "_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    ranked = (
        held.withColumn("_rank", F.row_number().over(W.partitionBy("length", "_part").orderBy("_at")) - 1)
        .join(offsets, ["length", "_part"])
        .withColumn("_rank", F.col("_rank") + F.col("_before"))
    )
    index = F.col("_rank") - F.col("_first")
    return (
        ranked.join(F.broadcast(where), "length")
        .filter((F.col("_rank") >= F.col("_first")) & (F.col("_rank") < F.col("_end")))
        .select(
            F.col("_id").alias(key),
            "piece",
            "start",
            "length",
            "ids_crc32",
            (F.col("_sequence") + F.expr("(_rank - _first) div _each")).alias("sequence_id"),
            (F.col("_offset") + index % F.col("_each") * F.col("length")).alias("offset"),
        )
    )
