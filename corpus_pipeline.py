"""Training corpus from raw documents: quality, exact and near copies, secrets, packing.

Each stage reads all documents that the one before kept, as a Parquet table in the shared
folder, and returns a DataFrame; all but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from orebed.llm import boosted_quality, heavy_dedup, lsh_forest, min_slack, secret_tokens
from orebed.llm.common import ready, table
from orebed.session import durable

#: Bound of an Arrow batch here: workers go on from stage to stage and keep the room of the largest.
BATCH_BYTES = 2 << 20


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches 0.3; null texts are scored as empty ones."""
    labels = table(spark, sf_dir, "labels")
    ready(spark, BATCH_BYTES)
    return boosted_quality.accepted(docs, labels, threshold=0.3)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents equal but for white space runs, the one with the smallest doc_id."""
    ready(spark, BATCH_BYTES)
    return heavy_dedup.drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles with similarity 0.8 or more."""
    ready(spark, BATCH_BYTES)
    return lsh_forest.drop_near(docs, words=5, percent=80)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in place of each secret."""
    ready(spark, BATCH_BYTES)
    return secret_tokens.without_secrets(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequences of at most 2048 tokens."""
    ready(spark, BATCH_BYTES)
    return min_slack.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), limit=2048, end=0)


STAGES = [
    ("quality", quality),
    ("exact_copies", exact_copies),
    ("near_copies", near_copies),
    ("secrets", secrets),
    ("packing", packing),
]
#: Trees and token ids are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = durable(docs)
    return docs
