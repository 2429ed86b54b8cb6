"""The corpus pipeline: operators applied one after the other to ``documents``."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from starsift.llm import bpe, mixing, secrets, simhash, toxicity
from starsift.sources.workspace import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# Rows of whole documents that go to a Python worker at once; Spark's default of ten
# thousand takes hundreds of megabytes of an executor beside its heap.
BATCH_ROWS = 500


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier rejects go."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.without_toxic(docs, toxicity.fit_toxicity(docs, labels, fold=0))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: that of the smallest id."""
    return simhash.without_copies(docs, shingle=5, similarity=0.8)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in any layer of a text are masked; every document stays."""
    return secrets.redacted(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mixed(docs, (5, 2, 1), 1.5, 2.0)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, ids) of each document of the mix."""
    return bpe.token_digests(docs, public_tokenizers.path("word_bpe_49k.json"), with_ids=True)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", reject_toxic),
    ("simhash_near_dedup", near_dedup),
    ("secret_scan", mask_secrets),
    ("mix_sources", mix),
    ("bpe", encode),
]

# No SQL can express the classifier, SimHash or the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written before the next one reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
