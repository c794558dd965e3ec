"""Training-data pipeline over the documents table: each stage works on what the one before it kept.

All stages but the last return the columns of documents; the last returns the tokens' digests. Between stages `run` writes
Parquet into the shared folder that the session names and reads it again, so a lost executor never costs a finished stage.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ascentframe.llm import byte_bpe, decontamination, quality_classifier, quality_rules, simhash
from ascentframe.llm.common import small_batches, table
from ascentframe.session import shared_dir

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def by_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the n-gram ratio."""
    small_batches(spark)
    return quality_rules.keep(docs, table(spark, sf_dir, "labels"))


def by_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier calls good."""
    small_batches(spark)
    return quality_classifier.keep_good(docs, table(spark, sf_dir, "labels"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    small_batches(spark)
    return simhash.keep_one(docs)


def without_test_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    small_batches(spark)
    return decontamination.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every document left."""
    small_batches(spark)
    return byte_bpe.digests(docs, public_tokenizers.path(VOCABULARY))


STAGES = [
    ("quality rules", by_rules),
    ("quality classifier", by_classifier),
    ("simhash near-dedup", one_of_each),
    ("benchmark decontamination", without_test_items),
    ("byte-level bpe", to_tokens),
]
#: Hashes, kernels and tokens are beyond SQL; tests hold the result against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage (doc_id, n_tokens, ids_sha256, decoded_sha256) for all documents that every stage kept.

    NULL and empty texts fall to the quality rules; repeated rows are near-duplicates of each other, so one stays; an empty
    table gives no rows; columns of documents beyond those used are carried along. Labels or benchmark may be empty: then
    nothing is learned, or nothing is found.
    """
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for number, (_, stage) in enumerate(STAGES[:-1]):
        path = f"{folder}/{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
