"""The training-corpus pipeline: each stage reads what its predecessor wrote."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from tablewarden.llm.common import table
from tablewarden.llm.mil import keep_good
from tablewarden.llm.packing import pack
from tablewarden.llm.queries import PII_KEY
from tablewarden.llm.simhash import first_of_group
from tablewarden.llm.surrogates import pseudonymise
from tablewarden.llm.tiling import without_leaks
from tablewarden.state.store import shared_folder


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier predicts to be good."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component."""
    return first_of_group(docs, shingle=3, max_bits=3)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced; n_chars follows the text."""
    n_chars = F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType), F.col("n_chars"))
    return pseudonymise(docs, PII_KEY).drop("n_entities").withColumn("n_chars", n_chars)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 1024 tokens."""
    return pack(docs)


STAGES = [("quality classifier", quality), ("SimHash near-dedup", near_dedup), ("benchmark decontamination", decontaminate), ("PII", pii), ("best-fit packing", packing)]

# Tokenizing, training and components are not SQL; tests/llm compare the pipeline with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage but the last is written to the shared folder and read again.

    Null and empty texts are documents like any other: the classifier scores them, at most one of them stays after the
    near-duplicates, and it packs as the end id alone. Of rows that repeat an id and text one stays; a null id is kept.
    Without usable labels the classifier keeps all; an empty table gives an empty result.
    """
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        place = f"{folder}/{name.replace(' ', '_')}"
        stage(spark, docs, sf_dir).write.parquet(place)
        docs = spark.read.parquet(place)
    return STAGES[-1][1](spark, docs, sf_dir)
