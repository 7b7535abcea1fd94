from __future__ import annotations

import hashlib
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer, decoders

from tablewarden.llm import alignment
from tablewarden.llm.alignment import PIECES, RANKS, align, aligned_tokens, byte_level, piece_level
from tablewarden.llm.common import table
from tablewarden.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sides():
    """(id, bytes) of both tokenizers, from the libraries that the contract names."""
    json = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    json.encode_special_tokens = True
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    # The byte-level alphabet: printable bytes stand for themselves, the others are shifted beyond 255.
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    alphabet = {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in own)}
    assert decoders.ByteLevel().decode(["Ġa"]) == " a"

    def left(text):
        ids = json.encode(" " + text, add_special_tokens=False).ids
        return [(i, bytes(alphabet[c] for c in json.id_to_token(i))) for i in ids]

    def right(text):
        return [(i, bytes([int(model.id_to_piece(i)[3:-1], 16)]) if model.is_byte(i) else model.id_to_piece(i).replace("▁", " ").encode()) for i in model.encode(text)]

    return left, right


def slow(text, sides):
    """(A ids, B ids, links as places, groups) by comparing every two ranges."""
    if not text:
        return [], [], [], ""
    tokens = [side(text) for side in sides]
    if any(b"".join(b for _, b in t) != b" " + text.encode() for t in tokens):
        return [], [], [], ""
    ranges = []
    for side in tokens:
        at, own = 0, []
        for _, spelled in side:
            own.append((at, at + len(spelled)))
            at += len(spelled)
        ranges.append(own)
    links, first = [], 0
    for i, (a, b) in enumerate(ranges[0]):
        while ranges[1][first][1] <= a:
            first += 1
        j = first
        while j < len(ranges[1]) and ranges[1][j][0] < b:
            links.append((i, j))
            j += 1
    ends = sorted({e for _, e in ranges[0]} & {e for _, e in ranges[1]})
    parts, begin = [], 0
    for end in ends:
        parts.append("|".join(",".join(str(t[0]) for t, (s, _) in zip(side, own) if begin <= s < end) for side, own in zip(tokens, ranges)))
        begin = end
    ids = [[t[0] for t in side] for side in tokens]
    return *ids, links, ";".join(parts)


def expected(texts, sides):
    found = [slow(t, sides) for t in texts]
    counts = Counter((a[i], b[j]) for a, b, links, _ in found for i, j in links)
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(best.get(b, 0), n)
    out = []
    for a, b, links, groups in found:
        n = [counts[a[i], b[j]] for i, j in links]
        top = sum(counts[a[i], b[j]] == best[b[j]] for i, j in links)
        out.append((len(a), len(b), groups.count(";") + 1 if groups else 0, len(links), top, sum(n), hashlib.sha256(groups.encode()).hexdigest() if groups else ""))
    return out


FIGURES = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@settings(deadline=None, max_examples=150)
@given(st.lists(st.lists(st.sampled_from([*"ab 'sZé\t\n  \x1c\x85漢9!|<>▁🙂", "<|endoftext|>", "</s>", "<0x41>", "  ", "hello ", "tion"]), max_size=30).map("".join), max_size=5))
def test_links_and_groups_equal_all_pairs(sides, texts):
    got = align(texts, byte_level(RANKS), piece_level(PIECES))
    for i, text in enumerate(texts):
        a, b, links, groups = slow(text, sides)
        assert (got.n_a[i], got.n_b[i], got.n_links[i], got.groups[i]) == (len(a), len(b), len(links), groups)
        own = got.doc == i
        low = alignment.bits(piece_level(PIECES))
        made = {(p >> low, p & ((1 << low) - 1)): n for p, n in zip(got.pair[own].tolist(), got.times[own].tolist())}
        assert made == Counter((a[x], b[y]) for x, y in links)


def test_whole_table_equals_brute_force(spark, sides):
    docs = table(spark, SF, "documents").collect()
    want = {r.doc_id: w for r, w in zip(docs, expected([r.text for r in docs], sides))}
    got = {r.doc_id: tuple(r[c] for c in FIGURES) for r in QUERIES["op13_token_alignment"](spark, SF).collect()}
    assert got == want and any(w[0] for w in want.values())


def test_small_blocks_give_the_same(spark, sides, monkeypatch):
    monkeypatch.setattr(alignment, "BATCH", 4000)
    monkeypatch.setattr(alignment, "BLOCK", 500)
    # Closures of the tasks see the module's values of their own process, so the slices are looked at here.
    assert list(alignment._slices(__import__("numpy").array([3000, 2000, 9000, 1, 1]), 4000)) == [(0, 1), (1, 2), (2, 3), (3, 5)]
    docs = [r.text for r in table(spark, SF, "documents").limit(40).collect()]
    frame = spark.createDataFrame(list(enumerate(docs)), "doc_id BIGINT, text STRING").repartition(5)
    got = {r.doc_id: tuple(r[c] for c in FIGURES) for r in aligned_tokens(frame).collect()}
    assert got == dict(enumerate(expected(docs, sides)))


def test_odd_rows(spark, rows, sides):
    texts = [None, "", "a▁b", "same words", "same words", "  ", "\n", "word " * 60000, "x" * 3000, "</s> <|endoftext|> <unk>", "é漢🙂"]
    keys = [1, None, 2, 3, 3, 4, 5, 6, 7, 8, 9]
    docs = rows("doc_id BIGINT, text STRING, _block INT, pair STRING, n_a INT", *[(k, t, 1, "x", 1) for k, t in zip(keys, texts)])
    got = sorted((str(r.doc_id), *(r[c] for c in FIGURES)) for r in aligned_tokens(docs).collect())
    assert got == sorted((str(k), *w) for k, w in zip(keys, expected(texts, sides)))
    assert aligned_tokens(docs.limit(0)).count() == 0
    assert aligned_tokens(docs.filter("text = ''")).collect()[0][1:] == (0, 0, 0, 0, 0, 0, "")
