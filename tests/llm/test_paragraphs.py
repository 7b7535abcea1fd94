from __future__ import annotations

import random
from collections import Counter, defaultdict

import numpy as np

from tablewarden.llm import paragraphs as own
from tablewarden.llm.common import TokenHashes, table
from tablewarden.llm.paragraphs import band_keys, borders, passages, recall, repeated_passages, shingles
from tablewarden.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def number(word):
    data = np.frombuffer(word.encode(), np.uint8).astype(np.uint64)
    return own.range_hashes(data, np.array([0]), np.array([len(data)]))[0]


def slow(docs, least=50):
    """{(doc, start, words): (kept, members)}: all passages between borders whose words occur again, and lines with such a border."""
    all_cuts, seen = {}, Counter()
    for i in docs:
        words = (docs[i] or "").lower().split()
        # Borders depend on the operator's hashes of single words and shingles; all else is compared as words.
        ids = np.array([number(w) for w in words], np.uint64)
        n = len(words) - own.SHINGLE + 1
        hashes = own.range_hashes(ids, np.arange(n), np.arange(n) + own.SHINGLE).tolist() if n > 0 else []
        cuts = set()
        for k in range(len(hashes) - own.SPREAD + 1):
            window = hashes[k : k + own.SPREAD]
            cuts.add(k + window.index(min(window)))
        all_cuts[i] = [(c, tuple(words[c : c + own.SHINGLE])) for c in sorted(cuts)]
        seen.update(shingle for _, shingle in all_cuts[i])
    parts = []
    for i in docs:
        cuts, at = all_cuts[i], 0
        for line in (docs[i] or "").lower().split("\n"):
            n = len(line.split())
            if n >= least and any(at <= c <= at + n - own.SHINGLE and seen[x] > 1 for c, x in cuts):
                parts.append((i, at, n, None))
            at += n
        shared = set()
        for k, (a, first) in enumerate(cuts):
            far = [(b, last) for b, last in cuts[k:] if b >= a + least - own.SHINGLE - 2 * own.SPREAD + 2][:1]
            if far and (far[0][0], first) in shared:
                continue
            shared.update((b, first) for b, _ in far)
            parts += [(i, a, b + own.SHINGLE - a, (first, last)) for b, last in far if seen[first] > 1 and seen[last] > 1]
    spelled = {i: (docs[i] or "").lower().split() for i in docs}
    sets = [frozenset(tuple(spelled[i][k : k + 5]) for k in range(a, a + n - 4)) for i, a, n, _ in parts]
    root = list(range(len(parts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    nodes, places = {}, defaultdict(list)
    for j, (i, a, n, group) in enumerate(parts):
        same = nodes.setdefault((group, tuple(spelled[i][a : a + n])), j)
        if same != j:
            root[j] = find(same)
            continue
        for k, n_shared in Counter(k for x in sets[j] for k in places[group, x]).items():
            if n_shared >= 0.8 * (len(sets[j]) + len(sets[k]) - n_shared):
                x, y = sorted((find(j), find(k)))
                root[y] = x
        for x in sets[j]:
            places[group, x].append(j)
    groups = defaultdict(list)
    for j, (i, a, n, _) in enumerate(parts):
        groups[find(j)].append((i, a, n))
    return {place: (min(v)[:2], len(v)) for v in groups.values() if len(v) > 1 for place in v}


def read(df):
    rows = df.collect()
    for r in rows:
        assert r.removed == ((r.doc_id, r.start) != (r.kept_doc, r.kept_start))
    got = {(r.doc_id, r.start, r.n_words): ((r.kept_doc, r.kept_start), r.n_members) for r in rows}
    return got


def test_whole_table_equals_brute_force(spark):
    want = slow({r.doc_id: r.text for r in table(spark, SF, "documents").collect()})
    assert read(QUERIES["op6_substring_dedup"](spark, SF)) == want and want


def test_every_repeated_run_of_fifty_words_holds_a_found_passage(spark):
    docs = {r.doc_id: (r.text or "").lower().split() for r in table(spark, SF, "documents").collect()}
    found = defaultdict(list)
    for r in QUERIES["op6_substring_dedup"](spark, SF).collect():
        found[r.doc_id].append((r.start, r.start + r.n_words))
    places = defaultdict(list)
    for i, words in docs.items():
        for a in range(len(words) - 49):
            places[tuple(words[a : a + 50])].append((i, a))
    runs = [place for v in places.values() if len(v) > 1 for place in v]
    missed = [(i, a) for i, a in runs if not any(s >= a and t <= a + 50 or s < a + 50 and t > a and t - s >= 50 for s, t in found[i])]
    assert runs and not missed


def wrapped(words, width):
    return "\n".join(" ".join(words[i : i + width]) for i in range(0, len(words), width))


def test_a_passage_over_lines_and_inside_a_longer_line(spark):
    rng = random.Random(6)

    def other(n):
        return [f"x{rng.random()}" for _ in range(n)]

    passage = [f"w{i}" for i in range(52)]
    texts = {1: " ".join(other(300) + passage + other(200)), 2: wrapped(other(31) + passage + other(9), 9), 3: " ".join(other(400)), 4: " ".join(passage[:30]), 5: "short\n" * 100}
    docs = spark.createDataFrame(list(texts.items()), "doc_id BIGINT, text STRING")
    got = read(repeated_passages(docs))
    assert got == slow(texts)
    # The last text repeats itself.
    assert {i for i, *_ in got} == {1, 2, 5} and all(31 <= a and a + n <= 83 for i, a, n in got if i == 2)
    # The first document keeps the passage, the other loses it.
    assert {kept[0] for (i, *_), (kept, _) in got.items() if i < 5} == {1}


def test_near_copies_and_a_chain(spark):
    rng = random.Random(6)
    base = [f"w{rng.randint(0, 9999)}" for _ in range(120)]
    texts = {0: " ".join(base)}
    now = list(base)
    for i in range(1, 12):
        now[rng.randrange(120)] = f"x{i}"
        texts[i] = "short line\n" + " ".join(now)
    texts |= {50 + i: " ".join(f"r{rng.randint(0, 9999)}" for _ in range(60)) for i in range(10)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id BIGINT, text STRING")
    assert read(repeated_passages(docs)) == slow(texts)


def test_more_anchors_than_the_filter_holds_are_joined(spark, monkeypatch):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    filtered = read(repeated_passages(docs))
    monkeypatch.setattr(own, "MOST_FILTERED", 0)
    assert read(repeated_passages(docs)) == filtered and filtered


def test_passages_of_equal_words_are_equal_wherever_they_stand():
    rng = random.Random(2)
    seen = set()
    passage = [str(rng.random()) for _ in range(70)]
    for before in (0, 1, 7, 40):
        words = [str(rng.random()) for _ in range(before)] + passage + [str(rng.random()) for _ in range(before)]
        got = passages(borders(wrapped(words, 11), 50), 50, lambda h: np.ones(len(h), bool))
        seen.add(frozenset(n for a, b, n in zip(got.start.tolist(), got.end.tolist(), got.name.tolist()) if a >= before + 10 and b <= before + 60))
    assert len(seen) == 1 and len(seen.pop()) >= 1


def test_bands_meet_as_often_as_computed():
    rng = random.Random(1)
    met = 0
    for trial in range(400):
        shared = [f"{trial}-{rng.random()}" for _ in range(184)]
        a, b = (shingles(shared + [f"{side}{trial}{i}" for i in range(20)], 1, TokenHashes()) for side in "ab")
        met += bool((band_keys([a])[0] == band_keys([b])[0]).any())
    assert recall(0.8) > 0.999 and met >= 0.99 * 400


def test_band_keys_do_not_depend_on_neighbours_or_parts():
    rng = np.random.default_rng(1)
    sets = [rng.integers(0, 1 << 62, n).astype(np.uint64) for n in (1, 50, 5000, 3, 4096, 9000, 70)]
    together = band_keys(sets)
    assert all((band_keys([s])[0] == k).all() for s, k in zip(sets, together))
    assert (band_keys([np.concatenate([s, s[:1]]) for s in sets]) == together).all() and band_keys([]).shape == (0, 16)


def test_odd_rows(rows):
    long = " ".join(f"w{i}" for i in range(60))
    texts = [(2, f"a\n{long}"), (None, long), (2, f"a\n{long}"), (3, None), (4, ""), (5, "word " * 20000), (6, "x")]
    docs = rows("doc_id BIGINT, text STRING, _pid INT, root STRING, start INT", *[(i, t, 1, "x", 1) for i, t in texts])
    got = repeated_passages(docs).collect()
    lines = sorted(((r.doc_id, r.start, r.removed, r.kept_doc, r.n_members) for r in got if r.n_words == 60), key=str)
    assert lines == sorted([(2, 1, False, 2, 3), (2, 1, True, 2, 3), (None, 0, True, 2, 3)], key=str)
    assert {r.doc_id for r in got} == {2, None, 5} and sum(not r.removed for r in got if r.doc_id == 5) >= 1
    assert repeated_passages(docs.limit(0)).count() == 0
