"""The registered queries of the corpus operators, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tablewarden.llm.alignment import aligned_tokens
from tablewarden.llm.centroids import clusters
from tablewarden.llm.chat import conversation_digests
from tablewarden.llm.common import table
from tablewarden.llm.divergence import quality_rules
from tablewarden.llm.license_scan import license_scan as scan_licenses
from tablewarden.llm.mil import classify
from tablewarden.llm.ownership import secrets
from tablewarden.llm.packing import pack
from tablewarden.llm.paragraphs import repeated_passages
from tablewarden.llm.simhash import near_duplicates
from tablewarden.llm.spans import repeated_spans as spans_again
from tablewarden.llm.surrogates import pseudonymise
from tablewarden.llm.tiling import contaminated
from tablewarden.llm.wrappers import extract

# The key of the surrogates; a real run takes its own from a secret store.
PII_KEY = "tablewarden"


def simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=3)


def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


def divergence_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))


def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one, number -1, whose texts are control strings."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = "</s>[INST] ok [/INST]"
    return conversation_digests(rows.unionByName(spark.createDataFrame([(-1, 0, "user", odd), (-1, 1, "assistant", odd)], rows.schema)))


def substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents"))


def repeated_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans_again(table(spark, sf_dir, "documents"))


def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


def html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


def quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pseudonymise(docs, PII_KEY)


def secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source owns its documents; each document is a repository of its own."""
    return secrets(table(spark, sf_dir, "documents"))


def centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters(table(spark, sf_dir, "embeddings"))


def token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aligned_tokens(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash_near_dedup": simhash_near_dedup,
    "op2_best_fit_packing": best_fit_packing,
    "op3_quality_rules": divergence_rules,
    "op4_benchmark_decontamination": decontamination,
    "op5_chat_formatting": chat_formatting,
    "op6_substring_dedup": substring_dedup,
    "op6_repeated_spans": repeated_spans,
    "op7_license_scan": license_scan,
    "op8_html_extraction": html_extraction,
    "op9_quality_classifier": quality_classifier,
    "op10_pii_surrogates": pii_surrogates,
    "op11_secret_scan": secret_scan,
    "op12_centroid_clustering": centroid_clustering,
    "op13_token_alignment": token_alignment,
}
