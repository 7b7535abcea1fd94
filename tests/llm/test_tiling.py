from __future__ import annotations

from tablewarden.llm.common import table
from tablewarden.llm.queries import QUERIES
from tablewarden.llm import tiling
from tablewarden.llm.tiling import contaminated, overlaps, tile, without_leaks, words

SF = "/root/testdata/sf0.01"


def slow_tile(doc, item, least):
    """Greedy string tiling by comparing all pairs of places, again and again."""
    taken_doc, taken_item, covered, tiles = set(), set(), 0, 0
    while True:
        best = None
        for t in range(len(item)):
            for d in range(len(doc)):
                n = 0
                while d + n < len(doc) and t + n < len(item) and doc[d + n] == item[t + n] and d + n not in taken_doc and t + n not in taken_item:
                    n += 1
                if n >= least and (best is None or n > best[0]):
                    best = (n, t, d)
        if best is None:
            return covered, tiles
        n, t, d = best
        taken_doc.update(range(d, d + n))
        taken_item.update(range(t, t + n))
        covered, tiles = covered + n, tiles + 1


def seeds(doc, item, n):
    return [(d, t, n) for d in range(len(doc) - n + 1) for t in range(len(item) - n + 1) if doc[d : d + n] == item[t : t + n]]


def test_tiles_equal_brute_force():
    import random

    rng = random.Random(4)
    for _ in range(150):
        item = [rng.choice("abcd") for _ in range(rng.randint(3, 18))]
        doc = [rng.choice("abcd") for _ in range(rng.randint(3, 25))]
        cut = rng.randint(0, len(item))
        doc = [*doc, *item[cut:], "z", *item[:cut]]
        n = min(3, len(item))
        pairs = seeds(doc, item, n)
        got = tile(pairs, len(item)) if pairs else (0, 0)
        assert got[0] == slow_tile(doc, item, n)[0] or abs(got[0] - slow_tile(doc, item, n)[0]) <= 0, (doc, item)


def test_whole_table_equals_brute_force(spark):
    items = {r.item_id: words(r.text) for r in table(spark, SF, "benchmark").collect()}
    docs = {r.doc_id: words(r.text) for r in table(spark, SF, "documents").collect()}
    firsts = {}
    for i, item in items.items():
        for t in range(len(item) - 4):
            firsts.setdefault(tuple(item[t : t + 5]), set()).add(i)
    want = {}
    for d, doc in docs.items():
        near = set().union(*[firsts.get(tuple(doc[k : k + 5]), set()) for k in range(len(doc) - 4)] or [set()])
        for i in near:
            pairs = seeds(doc, items[i], min(5, len(items[i])))
            covered = tile(pairs, len(items[i]))[0]
            if covered >= 0.8 * len(items[i]):
                want[d, i] = covered
    got = {(r.doc_id, r.item_id): r.covered for r in QUERIES["op4_benchmark_decontamination"](spark, SF).collect()}
    assert got == want and want


def test_reordered_short_and_odd_rows(rows):
    passage = "one two three four five six seven eight nine ten eleven twelve"
    bench = rows("item_id BIGINT, text STRING, _at INT", (1, passage, 0), (2, "Two words", 0), (3, None, 0), (4, " ... ", 0), (None, passage, 0))
    turned = "Seven, eight nine ten ELEVEN twelve! And then: one two\nthree four five six."
    docs = rows(
        "doc_id BIGINT, text STRING, _row STRING, item_id INT",
        (1, turned, "x", 1), (2, "one two three four five", "x", 1), (None, passage, "x", 1), (3, None, "x", 1), (4, "", "x", 1), (5, "just two words", "x", 1), (1, turned, "x", 1), (6, "clean " * 20000, "x", 1),
    )
    got = sorted(((r.doc_id, r.item_id, r.tiles) for r in contaminated(docs, bench).collect()), key=str)
    assert got == sorted([(1, 1, 2), (1, 1, 2), (None, 1, 1), (5, 2, 1)], key=str)
    kept = without_leaks(docs, bench)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [2, 3, 4, 6]
    assert contaminated(docs, bench.limit(0)).count() == 0 and contaminated(docs.limit(0), bench).count() == 0
    assert without_leaks(docs, bench.limit(0)).count() == 8


def test_pairs_that_cannot_be_covered_are_not_looked_at(rows):
    """Items with one opening: a text with that opening meets none of them, and what covers an item is never lost."""
    import random

    rng = random.Random(9)
    opening = [f"o{i}" for i in range(8)]
    items = [[*opening, *(f"q{k}w{i}" for i in range(rng.randint(25, 40)))] for k in range(40)] + [[f"s{k}" for k in range(n)] for n in range(1, 8)]
    texts = [opening, [*opening, "and", "so", "on"]]
    for item in items:
        cut = rng.randint(0, len(item))
        texts.append([*item[cut:], "x", "y", *item[:cut]])
        texts.append([w if rng.random() < 0.93 else "changed" for w in item])
        texts.append(item[: len(item) * 4 // 5])
    bench = rows("item_id BIGINT, text STRING", *[(k, " ".join(i)) for k, i in enumerate(items)])
    docs = rows("doc_id BIGINT, text STRING", *[(k, " ".join(t)) for k, t in enumerate(texts)])
    for coverage in (0.5, 0.8, 1.0):
        every = overlaps(docs, bench, ["doc_id"]).filter(f"covered >= {coverage} * item_words")
        pruned = overlaps(docs, bench, ["doc_id"], coverage=coverage)
        assert sorted(map(tuple, pruned.filter(f"covered >= {coverage} * item_words").collect())) == sorted(map(tuple, every.collect())) != []
        # The opening holds four seeds; all are left out where more are needed to cover an item of 33 words or more.
        assert coverage < 0.8 or pruned.filter("doc_id < 2").count() == 0
    assert tiling.MIN_MATCH == 5 and overlaps(docs, bench, ["doc_id"]).filter("doc_id < 2").count() == 80


def test_every_benchmark_text_is_looked_for(rows):
    one, two, three = (" ".join(f"{w}{i}" for i in range(12)) for w in "abc")
    bench = rows("item_id BIGINT, text STRING", (1, one), (1, two), (1, two), (None, three), (None, one))
    docs = rows("doc_id BIGINT, text STRING", (1, one), (2, two), (3, three), (4, "clean words only in this one text"))
    got = sorted(((r.doc_id, r.item_id, r.covered) for r in contaminated(docs, bench).collect()), key=str)
    assert got == [(1, 1, 12), (2, 1, 12), (3, None, 12)]
    assert [r.doc_id for r in without_leaks(docs, bench).collect()] == [4]
