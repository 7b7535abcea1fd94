"""SimHash near-duplicates found through deletion-variant signatures."""

from __future__ import annotations

from itertools import repeat

import numpy as np
from pyspark.sql import DataFrame, functions as F
from xxhash import xxh64_intdigest

from tablewarden.llm.common import (
    CONTENT,
    as_before,
    content_key,
    cut_lineage,
    in_blocks,
    link_groups,
    map_texts,
    one_bucket_per_set,
    packed,
    spread_join,
)
from tablewarden.llm.components import connected_components

SEED = 42
# Shingles whose bits are counted at once: a bound on the memory that a very long text takes.
CHUNK = 1 << 16


def fingerprint(text: bytes | None, shingle: int) -> int:
    """Signed 64-bit SimHash of lower-cased (A-Z) words: a bit is set if it is in over half of the shingles' XXH64.

    A text with fewer words is one shingle; a null or wordless text has the fingerprint zero.
    """
    words = (text or b"").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    grams = map(b" ".join, zip(*(words[i:] for i in range(shingle)))) if n > 1 or len(words) == shingle else iter([b" ".join(words)])
    hashes = np.fromiter(map(xxh64_intdigest, grams, repeat(SEED)), np.uint64, n)
    counts = np.zeros(64, np.int64)
    for at in range(0, n, CHUNK):
        bits = np.unpackbits(hashes[at : at + CHUNK].view(np.uint8), bitorder="little").reshape(-1, 64)
        counts += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(counts * 2 > n, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, keep: list[str], text: str = "text", shingle: int = 3) -> DataFrame:
    """``keep`` and ``_fp`` of every row; null and empty texts get zero."""
    return map_texts(docs, keep, text, lambda texts: {"_fp": [fingerprint(t, shingle) for t in texts]}, "`_fp` BIGINT")


def signatures(prints: DataFrame, max_bits: int) -> DataFrame:
    """(_key, _fp, _wild, _bit): every segment of a fingerprint whole (_wild false) and with each bit left out.

    There are ``max_bits // 2 + 1`` segments, so fingerprints within ``max_bits`` agree in one segment but for at
    most one bit, and thus in its whole form or in the variant without that bit.
    """
    segments = max_bits // 2 + 1
    width = 64 // segments
    widths = [width] * (segments - 1) + [64 - width * (segments - 1)]
    variants = []
    for s, bits in enumerate(widths):
        mask = (1 << bits) - 1
        value = F.shiftrightunsigned("_fp", s * width).bitwiseAND(F.lit(mask if mask < 1 << 63 else -1).cast("bigint"))
        place = F.explode(F.sequence(F.lit(-1), F.lit(bits - 1))).alias("_j")
        part = prints.select("_fp", value.alias("_v"), place).withColumn("_one", F.expr("CASE WHEN _j < 0 THEN 0L ELSE shiftleft(1L, _j) END"))
        variants.append(
            part.select(
                F.xxhash64(F.lit(s), "_j", F.expr("_v & ~_one")).alias("_key"),
                "_fp",
                (F.col("_j") >= 0).alias("_wild"),
                F.expr("(_v & _one) <> 0").alias("_bit"),
            )
        )
    out = variants[0]
    for more in variants[1:]:
        out = out.unionByName(more)
    return out


def _link(max_bits: int):
    """Local components of a block pair: every fingerprint reached scans those not reached yet."""

    def run(columns: list) -> list[tuple[int, int]]:
        rest = np.unique(columns[0].to_numpy())
        ends: list[tuple[int, int]] = []
        while len(rest):
            first, rest = int(rest[0]), rest[1:]
            queue = [first]
            while queue and len(rest):
                near = np.bitwise_count((rest ^ np.int64(queue.pop())).view(np.uint64)) <= max_bits
                if near.any():
                    found = rest[near].tolist()
                    ends.extend((first, x) for x in found)
                    queue.extend(found)
                    rest = rest[~near]
        return ends

    return run


def links(prints: DataFrame, max_bits: int) -> DataFrame:
    """Edges (a, b) between distinct fingerprints that leave every component of the distance graph connected.

    Buckets are equality groups of the signatures. A bucket of wildcard variants is looked at only if both values of
    the left-out bit occur; else the whole-segment bucket covers it. Of buckets with equal members one is looked at.
    """
    spelled = signatures(prints, max_bits)
    both = ~F.col("_wild") | (F.col("_low") < F.col("_high"))
    picked = one_bucket_per_set(
        spelled.withColumn("_bit", F.col("_bit").cast("int")), "_key", "_fp", {"_wild": F.max("_wild"), "_low": F.min("_bit"), "_high": F.max("_bit")}, both
    )
    dealt = in_blocks(spelled.select("_key", "_fp"), cut_lineage(picked), "_key", "_fp").select("_g", "_fp")
    return link_groups(dealt, "_g", _link(max_bits))


def _grouped(docs: DataFrame, key: str, text: str, shingle: int, max_bits: int, keep: tuple[str, ...]) -> DataFrame:
    """_id, ``keep``, _fp, root, component_id and component_size for every row."""
    base = cut_lineage(fingerprints(docs.select(F.col(key).alias("_id"), *keep, F.col(text).alias("_t")), ["_id", *keep], "_t", shingle))
    prints = cut_lineage(base.groupBy("_fp").agg(F.min("_id").alias("_least"), F.count(F.lit(1)).alias("_size")))
    roots = connected_components(links(prints.select("_fp"), max_bits)).select(F.col("node").alias("_fp"), "root")
    rooted = prints.join(roots, "_fp", "left").withColumn("root", F.coalesce("root", "_fp"))
    totals = rooted.groupBy("root").agg(F.min("_least").alias("component_id"), F.sum("_size").alias("component_size"))
    of_print = spread_join(rooted, totals, ["root"], ["_fp"], "inner").select("_fp", "root", "component_id", "component_size")
    return spread_join(base, of_print, ["_fp"], ["_id"], "left")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """``key``, fingerprint (hex), component_id and component_size for every row of ``docs``.

    component_id is the smallest key reachable over links of at most ``max_bits`` differing bits. Rows with equal
    fingerprints are one node, so copies are never paired. Null, empty and wordless texts share the fingerprint zero
    and link like any other. Rows with a null key are kept; a component without any key has a null id. Repeated rows
    stay repeated. Other columns are ignored, whatever their names; an empty table gives an empty result.
    """
    hexed = F.lower(F.lpad(F.hex("_fp"), 16, "0")).alias("fingerprint")
    return _grouped(docs, key, text, shingle, max_bits, ()).select(F.col("_id").alias(key), hexed, "component_id", "component_size")


def first_of_group(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """The row with the smallest key of every component, with the columns of ``docs``.

    A null key is larger than any. Of rows that repeat a key and its text any one stays.
    """
    whole = packed(docs, _key=key, _text=text, **content_key(key, text))
    found = cut_lineage(_grouped(whole, "_key", "_text", shingle, max_bits, ("_k1", "_k2")))
    order = F.struct(F.col("_id").isNull().alias("none"), F.col("_id").alias("id"), *CONTENT)
    best = found.groupBy("root").agg(F.min(order).alias("best")).select("best._k1", "best._k2")
    kept = whole.join(best, CONTENT, "left_semi")
    if found.groupBy(*CONTENT).count().filter("count > 1").isEmpty():
        return as_before(kept, docs)
    return as_before(kept.dropDuplicates(CONTENT), docs)
