from __future__ import annotations

import zlib

import numpy as np
import pytest

from tablewarden.llm.common import table
from tablewarden.llm.mil import N_FEATURES, PASSAGE, Model, classify, fit, keep_good, passages
from tablewarden.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    good = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
    got = {r.doc_id: r for r in QUERIES["op9_quality_classifier"](spark, SF).collect()}
    assert len(got) == table(spark, SF, "documents").count()
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert r.predicted == int(r.score >= 0.7) and 0 <= r.score <= 1
    held = [i for i in good if got[i].held_out]
    assert np.mean([got[i].predicted == good[i] for i in held]) >= 0.95


def test_scores_depend_on_the_text_alone(spark, rows):
    labels = table(spark, SF, "labels")
    docs = table(spark, SF, "documents")
    other = docs.selectExpr("doc_id", "text", "'xx' AS lang", "'s' AS source")
    a, b = ({r.doc_id: r.score for r in classify(d, labels).collect()} for d in (docs, other))
    assert a == b


def test_passages():
    text = " ".join(f"w{i}" for i in range(2 * PASSAGE + 1)).encode()
    assert passages(text).shape == (3, N_FEATURES)
    assert not passages(None).any() and not passages(b"").any() and not passages(b" \n").any()
    assert np.allclose(passages(text)[:, :11].sum(axis=1), 1)
    assert passages("é " .encode() * 70000).shape[0] == -(-70000 // PASSAGE)


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    bags = [rng.standard_normal((n, N_FEATURES)).astype(np.float32) for n in (1, 3, 5, 2)]
    model = fit(bags, [1, 0, 1, 0])
    scores = model.scores(bags)
    assert (scores[[0, 2]] > 0.9).all() and (scores[[1, 3]] < 0.1).all()
    one_by_one = [model.scores([b])[0] for b in bags]
    assert np.allclose(scores, one_by_one, atol=1e-5)


def test_missing_labels_and_odd_rows(spark, rows):
    docs = rows("doc_id BIGINT, text STRING, _score INT, score STRING", (None, None, 1, "x"), (1, "", 1, "x"), (1, "", 1, "x"), (2, "some words here", 1, "x"))
    labels = rows("doc_id BIGINT, quality INT, text STRING", (1, None, "x"), (None, 1, "x"), (77, 1, "x"))
    got = classify(docs, labels).collect()
    assert len(got) == 4 and all(r.score == 1.0 and r.predicted == 1 for r in got)
    assert keep_good(docs, labels).columns == docs.columns and keep_good(docs, labels).count() == 4
    assert fit([np.zeros((1, N_FEATURES), np.float32)] * 3, [0, 0, 0]).constant == pytest.approx(0.2)
    assert classify(docs.limit(0), labels).count() == 0
    assert Model(constant=0.5).scores([]).tolist() == []
