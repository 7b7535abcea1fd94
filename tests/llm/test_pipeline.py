from __future__ import annotations

from pyspark.sql import functions as F

import corpus_pipeline
from tablewarden.llm.common import table
from tablewarden.llm.packing import encode
from tablewarden.llm.queries import PII_KEY
from tablewarden.llm.simhash import fingerprint
from tablewarden.llm.surrogates import pseudonymise
from tablewarden.llm.mil import classify
from test_simhash import slow_components
from test_tiling import seeds
from tablewarden.llm.tiling import tile, words

SF = "/root/testdata/sf0.01"


def test_stages_equal_brute_force(spark):
    docs = {r.doc_id: r for r in table(spark, SF, "documents").collect()}
    good = {r.doc_id for r in classify(table(spark, SF, "documents"), table(spark, SF, "labels")).collect() if r.predicted}
    roots = slow_components({i: fingerprint(docs[i].text.encode(), 3) % (1 << 64) for i in sorted(good)})
    first = {i for i in good if roots[i] == i}
    items = [words(r.text) for r in table(spark, SF, "benchmark").collect()]

    def leaks(text):
        own = words(text)
        joined = " ".join(own)
        near = [i for i in items if any(" ".join(i[t : t + 5]) in joined for t in range(max(1, len(i) - 4)))]
        pairs = [(i, seeds(own, i, min(5, len(i)))) for i in near]
        return any(p and tile(p, len(i))[0] >= 0.8 * len(i) for i, p in pairs)

    clean = {i for i in first if not leaks(docs[i].text)}
    out = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in out} == clean and len(clean) < len(first) < len(good) < len(docs)
    kept = table(spark, SF, "documents").filter(F.col("doc_id").isin(list(clean)))
    total = sum(len(encode(r.text)) + 1 for r in pseudonymise(kept, PII_KEY).collect())
    assert abs(sum(r.length for r in out) - total) <= 0.001 * total
    assert len({r.sequence_id for r in out}) <= -(-total // 1024) * 1.02 + 1


def test_stages_keep_the_columns_of_documents(spark):
    docs = table(spark, SF, "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).schema.names == docs.schema.names


def test_odd_rows_and_empty_tables(spark, rows, tmp_path):
    def land(name, *documents):
        folder = tmp_path / name
        rows("doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT", *documents).coalesce(1).write.parquet(str(folder / "documents.parquet"))
        rows("doc_id BIGINT, quality INT, toxic INT").coalesce(1).write.parquet(str(folder / "labels.parquet"))
        rows("item_id BIGINT, text STRING", (None, None), (1, "")).coalesce(1).write.parquet(str(folder / "benchmark.parquet"))
        return str(folder)

    one, two = "a text of some words that nobody else has written down", "quite another text with words of its own in it"
    given = [(1, one, "en", None, None), (1, one, None, "s", 3), (4, None, None, None, None), (3, "", "en", "s", 0), (None, two, "en", "s", 1)]
    out = corpus_pipeline.run(spark, land("odd", *given)).collect()
    assert sorted((str(r.doc_id), r.length) for r in out) == sorted([("1", len(encode(one)) + 1), ("3", 1), ("None", len(encode(two)) + 1)])
    assert corpus_pipeline.run(spark, land("none")).count() == 0
