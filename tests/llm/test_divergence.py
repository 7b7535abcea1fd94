from __future__ import annotations

import math
import re

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tablewarden.llm.common import table
from tablewarden.llm.divergence import distance, quality_rules, repeated_words
from tablewarden.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def slow(text):
    text = text or ""
    words = [w for w in re.split("[\x20\x09-\x0d]+", text) if w]
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    places = {}
    for i in range(len(words) - 7):
        places.setdefault(tuple(words[i : i + 8]), []).append(i)
    covered = {j for v in places.values() if len(v) > 1 for i in v for j in range(i, i + 8)}
    return [len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)]


def test_base_counts_and_verdicts_of_the_whole_table(spark):
    texts = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}
    good = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
    got = {r.doc_id: r for r in QUERIES["op3_quality_rules"](spark, SF).collect()}
    assert {i: [r[c] for c in BASE] for i, r in got.items()} == {i: slow(t) for i, t in texts.items()}
    for i, r in got.items():
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.base_failed and r.kept)
    long_enough = [i for i in good if not got[i].base_failed]
    assert sum(got[i].kept for i in long_enough if good[i]) >= 0.99 * sum(good[i] for i in long_enough)
    assert sum(not got[i].kept for i in good if not good[i]) >= 0.7 * sum(not good[i] for i in good)


def test_repeated_words(spark):
    texts = ["a " * 40, "a b c d e f g h " * 3, "x a b c d e f g h y a b c d e f g h z", "a b c d e f g h", "", "p q r s t u v w x " * 2 + "k"]
    df = spark.createDataFrame([(t,) for t in texts], "t STRING").select("t", repeated_words(F.filter(F.split("t", " "), lambda w: w != "")).alias("n"))
    assert {r.t: r.n for r in df.collect()} == {t: slow(t)[4] for t in texts}


def test_distance(spark):
    pairs = [([1.0, 0.0], [0.0, 1.0]), ([2.0, 2.0], [1.0, 1.0]), ([3.0, 1.0], [1.0, 3.0]), ([0.0, 0.0], [1.0, 1.0])]
    df = spark.createDataFrame(pairs, "p ARRAY<DOUBLE>, q ARRAY<DOUBLE>").select("p", distance(F.col("p"), F.col("q")).alias("d"))
    got = [r.d for r in df.collect()]
    kl = lambda p, m: sum(a * math.log2(a / b) for a, b in zip(p, m) if a)
    third = math.sqrt((kl([0.75, 0.25], [0.5, 0.5]) + kl([0.25, 0.75], [0.5, 0.5])) / 2)
    assert abs(got[0] - 1) < 1e-9 and abs(got[1]) < 1e-9 and abs(got[2] - third) < 1e-9 and got[3] is None


def test_odd_rows(rows):
    docs = rows("doc_id BIGINT, text STRING, lang STRING, _w INT, base_failed STRING", (None, None, None, 1, "x"), (1, "", "en", 1, "x"), (1, "the cat " * 5000, "tlh", 1, "x"), (2, "\n\n \n", None, 1, "x"))
    got = quality_rules(docs).collect()
    assert len(got) == 4 and all(r.base_failed and not r.kept for r in got)
    assert quality_rules(docs.limit(0)).count() == 0


def test_no_python_in_the_plan(spark):
    plan = quality_rules(table(spark, SF, "documents"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


@settings(deadline=None, max_examples=5)
@given(st.lists(st.text(alphabet="ab \n\t\x0b#é|", max_size=80), min_size=1, max_size=20))
def test_base_counts_of_any_text(spark, texts):
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id BIGINT, text STRING, lang STRING")
    assert {r.doc_id: [r[c] for c in BASE] for r in quality_rules(docs).collect()} == {i: slow(t) for i, t in enumerate(texts)}
