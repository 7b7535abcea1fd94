"""Benchmark decontamination by greedy string tiling over shared-token seeds."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from tablewarden.llm.common import CONTENT, TokenHashes, as_before, bounded_batches, content_key, cut_lineage, filter_bits, in_all_tasks, packed, passes, rolling, spread_join

# A tile has this many words at least; a test item is found in a document if its tiles cover this share of its words.
MIN_MATCH, COVERAGE = 5, 0.8
_WORD = re.compile(r"[^\W_]+")


def words(text: str) -> list[str]:
    """Lower-cased runs of letters and digits, so case, punctuation and line breaks do not matter."""
    return _WORD.findall(text.lower())


def _seeds(df: DataFrame, names: list[str], lengths: list[int], bits: np.ndarray | None) -> DataFrame:
    """(the named columns, _at, _n, _seed, _hash): windows of the given lengths whose hash passes the filter, with their words."""
    schema = ", ".join([f"`{c}` {df.schema[c].dataType.simpleString()}" for c in names] + ["_at INT, _n INT, _seed STRING, _hash BIGINT"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = TokenHashes()
        for batch in batches:
            rows, at, size, seed, hashed = [], [], [], [], []
            for row, value in enumerate(batch.column(len(names))):
                tokens = words(value.as_py() or "")
                for n in lengths:
                    hashes = rolling(tokens, n, known)
                    signed = hashes.view(np.int64)
                    for i in range(len(hashes)) if bits is None else passes(bits, hashes).tolist():
                        rows.append(row)
                        at.append(i)
                        size.append(n)
                        seed.append(" ".join(tokens[i : i + n]))
                        hashed.append(int(signed[i]))
            taken = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i).take(taken) for i in range(len(names))), pa.array(at, pa.int32()), pa.array(size, pa.int32()), pa.array(seed, pa.string()), pa.array(hashed, pa.int64())],
                [*names, "_at", "_n", "_seed", "_hash"],
            )

    return bounded_batches(df).select(*names, "_text").mapInArrow(run, schema)


def tile(pairs: list[tuple[int, int, int]], item_words: int) -> tuple[int, int]:
    """(covered words, tiles) of greedy string tiling.

    ``pairs`` are (document place, item place, words) of equal seeds. Seeds on one diagonal that follow each other make
    a maximal match. The longest match whose words are all free is marked, again and again; one that is partly taken is
    cut down to its free stretches. Ties go to the match that begins first in the item, then in the document.
    """
    by_diagonal: dict[int, list[tuple[int, int]]] = {}
    for d, t, n in sorted(set(pairs)):
        by_diagonal.setdefault(d - t, []).append((t, n))
    matches: list[tuple[int, int, int]] = []
    shortest = min((n for *_, n in pairs), default=1)
    for shift, seeds in by_diagonal.items():
        begin, end, last = None, None, None
        for t, n in sorted(seeds):
            if begin is not None and t <= last + 1:
                end, last = max(end, t + n), t
                continue
            if begin is not None:
                matches.append((begin, shift, end - begin))
            begin, end, last = t, t + n, t
        matches.append((begin, shift, end - begin))
    taken_item = np.zeros(item_words, bool)
    taken_doc: set[int] = set()
    heap: dict[int, list[tuple[int, int]]] = {}
    for t, shift, n in matches:
        heap.setdefault(n, []).append((t, shift))
    covered = tiles = 0
    while heap:
        size = max(heap)
        for t, shift in sorted(heap.pop(size)):
            free = [not taken_item[t + i] and t + i + shift not in taken_doc for i in range(size)]
            if all(free):
                taken_item[t : t + size] = True
                taken_doc.update(range(t + shift, t + shift + size))
                covered, tiles = covered + size, tiles + 1
                continue
            run = 0
            for i, ok in enumerate([*free, False]):
                if ok:
                    run += 1
                    continue
                if run >= shortest:
                    heap.setdefault(run, []).append((t + i - run, shift))
                run = 0
    return covered, tiles


def _candidates(found: DataFrame, seeds: DataFrame, ids: list[str], min_match: int, coverage: float) -> DataFrame:
    """(ids, _passage) of the texts that may hold ``coverage`` of a passage.

    Tiles that cover so many words hold a fifth as many seeds of the passage (``min_match`` = 5), so of all seeds but that many, less
    one, some seed is among them. Those left out are the ones that most texts and passages share: an opening that thousands of
    items have in common joins nothing by itself.
    """
    used = found.groupBy("_seed").agg(F.count(F.lit(1)).alias("_texts"))
    shared = seeds.groupBy("_seed").agg(F.count(F.lit(1)).alias("_items"))
    own = seeds.select("_passage", "_seed", "_at", "_words").distinct().join(shared, "_seed").join(used, "_seed", "left")
    weight = F.coalesce("_texts", F.lit(0)) * F.col("_items")
    held = F.greatest(F.col("_words") - F.lit(min_match) + 1, F.lit(1))
    needed = F.greatest(F.ceil(F.col("_words") * F.lit(coverage) / F.lit(min_match)), F.lit(1))
    # The seeds of one passage: bounded by its length.
    rank = F.row_number().over(W.partitionBy("_passage").orderBy(weight, "_at"))
    rare = own.withColumn("_rank", rank).filter(F.col("_rank") <= held - needed + 1).select("_seed", "_passage")
    return found.select(*ids, "_seed").join(rare, "_seed").select(*ids, "_passage").distinct()


def overlaps(docs: DataFrame, benchmark: DataFrame, ids: list[str], text: str = "text", item: str = "item_id", item_text: str = "text", min_match: int = MIN_MATCH, coverage: float = 0.0) -> DataFrame:
    """``ids``, _item, covered, tiles, item_words for every text and item that share a seed of ``min_match`` words.

    With ``coverage`` only those are looked at whose tiles may cover that share of the item, see ``_candidates``.

    Every distinct text of an item is looked for by itself; a text without an item id too, with a null ``_item``, unless an item has
    the same text. Items of fewer words are seeds as a whole; items without a word match nothing. ``ids`` tell texts apart; rows with equal
    ``ids`` and equal texts are looked at once.
    """
    items = (
        benchmark.select(F.col(item).alias("_item"), F.col(item_text).cast("string").alias("_text"))
        .filter(F.col("_text").isNotNull())
        .distinct()
    )
    named = items.filter(F.col("_item").isNotNull())
    unnamed = items.filter(F.col("_item").isNull()).join(named.select("_text").distinct(), "_text", "left_anti").select("_item", "_text")
    # A passage of an item is told apart by the hash of its text.
    items = named.unionByName(unnamed).withColumn("_passage", F.xxhash64("_text"))

    def sized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [len(words(t or "")) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(counts, pa.int32())], ["_item", "_text", "_passage", "_words"])

    kind = benchmark.schema[item].dataType.simpleString()
    items = cut_lineage(items.mapInArrow(sized, f"_item {kind}, _text STRING, _passage BIGINT, _words INT").filter("_words > 0"))
    # At most ``min_match`` numbers.
    lengths = sorted(r[0] for r in items.select(F.least("_words", F.lit(min_match))).distinct().collect())
    own = [_seeds(items.filter(F.least("_words", F.lit(min_match)) == n), ["_item", "_passage", "_words"], [n], None) for n in lengths]
    if not own:
        own = [_seeds(items, ["_item", "_passage", "_words"], [min_match], None)]
    seeds = own[0]
    for more in own[1:]:
        seeds = seeds.unionByName(more)
    seeds = cut_lineage(seeds)
    bits = filter_bits(seeds, "_hash")
    found = cut_lineage(_seeds(docs.select(*ids, F.col(text).cast("string").alias("_text")), ids, lengths, bits).distinct())
    places = seeds.select("_seed", "_item", "_passage", F.col("_words").alias("_size"), F.col("_at").alias("_place"))
    if coverage:
        near = _candidates(found, seeds, ids, min_match, coverage)
        # A pair brings the seeds of its passage, and meets those that its text holds.
        held = found.select(*[F.col(c).alias(f"_own{i}") for i, c in enumerate(ids)], F.col("_seed").alias("_found"), "_at", "_n")
        same = [F.col(c).eqNullSafe(F.col(f"_own{i}")) for i, c in enumerate(ids)]
        matched = near.join(places, "_passage").join(held, [*same, F.col("_seed") == F.col("_found")]).select(*ids, "_item", "_passage", "_size", "_place", "_at", "_n")
    else:
        matched = found.join(places, "_seed")

    def greedy(rows: pd.DataFrame) -> pd.DataFrame:
        first = rows.iloc[:1]
        size = int(first["_size"].iloc[0])
        covered, tiles = tile(list(zip(rows["_at"].tolist(), rows["_place"].tolist(), rows["_n"].tolist())), size)
        return first[[*ids, "_item"]].assign(covered=covered, tiles=tiles, item_words=size)

    schema = ", ".join([f"`{c}` {found.schema[c].dataType.simpleString()}" for c in ids] + [f"_item {kind}, covered INT, tiles INT, item_words INT"])
    # A group is one text and one passage of an item: it is bounded by the length of that text.
    return in_all_tasks(matched, *ids, "_item", "_passage").groupBy(*ids, "_item", "_passage").applyInPandas(greedy, schema)


def contaminated(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", coverage: float = COVERAGE) -> DataFrame:
    """``key``, item, covered, tiles, item_words, coverage: a row for every document row and test item's text found in it.

    Documents in which no item is found have no row. Null and empty texts hold no item; a null key is kept; repeated
    rows are judged one by one; of a repeated item id every distinct text is an item; texts without id that no item has are looked for, with a null id;
    other columns are ignored; empty tables give an empty result.
    """
    # Numbers that are made and stored in one pass; repeated rows stay apart.
    rows = docs.select(F.col(key).alias("_id"), F.monotonically_increasing_id().alias("_row"), F.col(text).alias("_t"))
    found = overlaps(rows, benchmark, ["_id", "_row"], "_t", item, item_text, coverage=coverage).filter(F.col("covered") >= coverage * F.col("item_words"))
    return found.select(F.col("_id").alias(key), F.col("_item").alias(item), "covered", "tiles", "item_words", (F.col("covered") / F.col("item_words")).alias("coverage"))


def without_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text", coverage: float = COVERAGE) -> DataFrame:
    """The rows of ``docs`` in which no test item is found."""
    whole = packed(docs, _t=text, **content_key(text))
    found = overlaps(whole, benchmark, CONTENT, "_t", item, item_text, coverage=coverage).filter(F.col("covered") >= coverage * F.col("item_words"))
    # One text may be that of very many rows.
    return as_before(spread_join(whole, found.select(*CONTENT).distinct(), CONTENT, ["_doc"], "left_anti"), docs)
