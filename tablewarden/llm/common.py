"""Small helpers that the corpus operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from xxhash import xxh64_intdigest

from tablewarden.operators.joins import spread_join
from tablewarden.state.store import cut_lineage

# Members of one bucket that are compared in one task; larger buckets are dealt out in pairs of blocks.
BLOCK = 4096


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Rows of texts that go to a Python worker at once. The session's default, 10,000, are some 30 MB on both sides, twice with whole rows.
BATCH_ROWS = 1000


def bounded_batches(df: DataFrame) -> DataFrame:
    """``df``, whose session now hands rows to Python in batches of ``BATCH_ROWS`` at most; a smaller setting of its own stays."""
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(name)) <= BATCH_ROWS:
        conf.set(name, str(BATCH_ROWS))
    return df


def map_texts(df: DataFrame, keep: list[str], text: str, each: Callable[[list[bytes | None]], dict], ddl: str) -> DataFrame:
    """``keep`` and the columns that ``each`` makes of a batch's texts (UTF-8 bytes or None), a row for a row."""
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keep).schema] + [ddl])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = each(batch.column(batch.num_columns - 1).cast(pa.binary()).to_pylist())
            arrays = [batch.column(i) for i in range(len(keep))] + [pa.array(v) if not isinstance(v, pa.Array) else v for v in made.values()]
            yield pa.RecordBatch.from_arrays(arrays, names=[*keep, *made])

    return bounded_batches(df).select(*keep, F.col(text).cast("string").alias("_text")).mapInArrow(run, schema)


# Bits of the filters that reject most hashes of a big table before a join: 2 MB, whatever the size of the other table.
FILTER_BITS = 24
# Token hashes that a task remembers.
KNOWN = 1 << 17
_BASE = np.uint64(0x9E3779B97F4A7C15)


class TokenHashes(dict):
    """Token to hash, made when first asked for and remembered for a while."""

    def __missing__(self, token: str) -> int:
        if len(self) > KNOWN:
            self.clear()
        value = self[token] = xxh64_intdigest(token)
        return value


def rolling(tokens: list[str], n: int, known: TokenHashes) -> np.ndarray:
    """Karp-Rabin hash of every window of ``n`` tokens, modulo 2**64."""
    if len(tokens) < n:
        return np.zeros(0, np.uint64)
    values = np.fromiter(map(known.__getitem__, tokens), np.uint64, len(tokens))
    out = np.zeros(len(tokens) - n + 1, np.uint64)
    for i in range(n):
        out = out * _BASE + values[i : i + len(out)]
    return out ^ (out >> np.uint64(29))


def filter_bits(hashes: DataFrame, column: str, bits: int = FILTER_BITS) -> np.ndarray:
    """A bitmap of the low bits of all hashes. It is merged in tasks; the driver gets 2**bits bits, never more."""
    low = F.col(column).bitwiseAND(F.lit((1 << bits) - 1))
    words = hashes.select(low.alias("h")).groupBy(F.shiftright("h", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(h & 63 AS INT))")).alias("bits")).toPandas()
    out = np.zeros(1 << bits - 6, np.int64)
    out[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64)
    return out.view(np.uint8)


def passes(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Places of the hashes that may be in the bitmap; none that is in it is missed."""
    slot = (hashes & np.uint64(8 * len(bits) - 1)).astype(np.int64)
    return np.nonzero(bits[slot >> 3] >> (slot & 7).astype(np.uint8) & 1)[0]


def packed(docs: DataFrame, **more: str | Column) -> DataFrame:
    """(_doc, more): rows as structs, so that no column of theirs can clash with one of an operator's."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc")
    return docs.select(whole, *[(F.col(f"`{c}`") if isinstance(c, str) else c).alias(n) for n, c in more.items()])


def content_key(*columns: str) -> dict[str, Column]:
    """_k1 and _k2, 128 bits of hash of the columns. They tell contents apart when the same rows are read a second time.

    A row's number would not: the scan may be cut otherwise after an executor is lost or added.
    """
    named = [F.col(f"`{c}`") for c in columns]
    return {"_k1": F.xxhash64(*named), "_k2": F.xxhash64(F.lit("second"), *named)}


CONTENT = ["_k1", "_k2"]


def as_before(rows: DataFrame, docs: DataFrame, *more: str) -> DataFrame:
    """The rows of ``packed`` with the columns of ``docs``, then ``more``."""
    return rows.select(*[F.col(f"_doc.`{c}`") for c in docs.columns], *more)


def in_all_tasks(df: DataFrame, *keys: str) -> DataFrame:
    """Dealt by key to all shuffle partitions. Groups of few bytes and much work would otherwise be merged into one task."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def link_groups(df: DataFrame, key: str, each: Callable[[list[pa.Array]], list[tuple[int, int]]]) -> DataFrame:
    """(a, b): what ``each`` links within every group of ``key``, from the group's other columns.

    Groups are dealt to all partitions, sorted and streamed: one is held at a time, without the cost of a frame for each.
    """
    others = [c for c in df.columns if c != key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None

        def linked(part: pa.Table, bounds: np.ndarray) -> pa.RecordBatch:
            columns = [part.column(i + 1).combine_chunks() for i in range(len(others))]
            ends = [e for lo, hi in zip(bounds[:-1], bounds[1:]) for e in each([c.slice(lo, hi - lo) for c in columns])]
            a, b = np.array(ends, np.int64).reshape(-1, 2).T
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        for batch in batches:
            held = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            keys = held.column(0).to_numpy()
            cuts = np.nonzero(keys[1:] != keys[:-1])[0] + 1
            if len(cuts):
                # The last group may go on in the next batch.
                yield linked(held.slice(0, cuts[-1]), np.concatenate(([0], cuts)))
                held = held.slice(cuts[-1])
        if held is not None and held.num_rows:
            yield linked(held, np.array([0, held.num_rows]))

    return in_all_tasks(df, key).sortWithinPartitions(key).select(key, *others).mapInArrow(run, "a BIGINT, b BIGINT")


def one_bucket_per_set(members: DataFrame, key: str, member: str, extra: dict[str, Column], keep: Column) -> DataFrame:
    """Of the buckets with two or more members that satisfy ``keep``: ``key`` and the count ``_n``, one key for
    each set of members. Counts and set hashes are partial aggregates, so a hot bucket sends a row per map task."""
    buckets = (
        members.groupBy(key)
        .agg(F.count(F.lit(1)).alias("_n"), F.bit_xor(F.xxhash64(member)).alias("_x"), *[c.alias(n) for n, c in extra.items()])
        .filter((F.col("_n") > 1) & keep)
    )
    return buckets.groupBy("_n", "_x").agg(F.min(key).alias(key)).select(key, "_n")


def in_blocks(members: DataFrame, picked: DataFrame, key: str, member: str, block: int = BLOCK) -> DataFrame:
    """Members of the picked buckets with the block pair ``_g`` in which they meet. Every two members of a bucket
    meet in one block pair, and no pair holds more than about two blocks."""
    found = spread_join(members, picked, [key], [member], "inner")
    blocks = F.ceil(F.col("_n") / F.lit(block)).cast("int")
    own = F.pmod(F.xxhash64(F.lit(7), member), F.col("_blocks")).cast("int")
    return (
        found.withColumn("_blocks", blocks)
        .withColumn("_own", own)
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
        .withColumn("_g", F.xxhash64(key, F.least("_own", "_other"), F.greatest("_own", "_other")))
        .drop("_n", "_blocks", "_own", "_other")
    )

