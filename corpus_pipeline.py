"""Corpus pipeline: quality, near-duplicates, secrets, mixing, packing.

Each stage takes the documents that its predecessor wrote and returns documents; the last
one returns the packed pieces. ``run`` writes every stage's result as Parquet under the
shared folder in ``spark.checkpoint.dir`` and reads it back, so a lost executor costs a
stage at most.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ordo.llm import mixing, neardup, packing, quality, secrets
from ordo.llm.common import documents, table
from ordo.session import ensure_checkpoint_dir

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled ones, doesn't reject."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: five-word shingles, similarity 0.8."""
    return neardup.keep_one(docs, words_each=5, percent=80)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mask; n_chars follows a changed text."""
    return secrets.redacted(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.apply_mix(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their place in the training sequences."""
    return packing.pack(docs, TOKENIZER)


STAGES = [
    ("quality classifier", quality_classifier),
    ("near-duplicates", minhash_near_dedup),
    ("secret scan", secret_scan),
    ("source mix", source_mix),
    ("packing", best_fit_packing),
]

#: A learned score and near-duplicate groups have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents`` in turn; returns the last stage's rows."""
    base = f"{ensure_checkpoint_dir(spark)}/corpus-pipeline-{uuid.uuid4().hex}"
    docs = documents(spark, sf_dir)
    for k, (_, stage) in enumerate(STAGES):
        path = f"{base}/{k}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
