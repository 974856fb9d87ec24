"""Corpus pipeline: toxicity, near duplicates, contamination, secrets, token ids.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows its
predecessor kept; its result is written as Parquet and read again as the next
stage's input. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tracery.llm import decontaminate, near_dup, pair_bpe, secrets, toxicity
from tracery.llm.common import read
from tracery.llm.queries import tokenizer
from tracery.session import scratch_path


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored toxic go; the classifier learns from the table's labels."""
    return toxicity.reject(docs, toxicity.train(docs, read(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: five-word shingles, likeness 0.8."""
    return near_dup.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark passages go."""
    return decontaminate.remove_contaminated(docs, read(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets found are masked in the text; every document stays."""
    return secrets.redact(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids, decoded_sha256`` of every document."""
    return pair_bpe.encode_and_decode(docs, tokenizer("word_bpe_49k.json"))


STAGES = [
    ("toxicity", reject_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", mask_secrets),
    ("token_ids", encode),
]

# Trained models and similarity components have no SQL form; tests compare the
# stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        folder = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
