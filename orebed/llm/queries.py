"""Registered queries of the training-data operators: production parameters, whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from orebed.llm import oracles as sql
from orebed.llm import (
    arrow_ids,
    block_repair,
    boosted_quality,
    heavy_dedup,
    html_lstm,
    hyper_lang,
    lsh_forest,
    min_slack,
    pivot_grams,
    projection_dedup,
    secret_tokens,
    suffix_automaton,
    word_table,
)
from orebed.llm.common import table

WORD_BPE, BYTE_BPE, BYTE_RANKS = "word_bpe_49k.json", "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"


def page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_lstm.main_text(table(spark, sf_dir, "pages"))


def packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return min_slack.pack_documents(docs, public_tokenizers.path(WORD_BPE), limit=2048, end=0)


def token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return arrow_ids.round_trip(docs, public_tokenizers.path(WORD_BPE), size=2048, end=2)


def exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return heavy_dedup.find_copies(table(spark, sf_dir, "documents"))


def byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_table.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE))


def near_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projection_dedup.near_vectors(table(spark, sf_dir, "embeddings"), similarity=0.95)


def near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lsh_forest.near_groups(table(spark, sf_dir, "documents"), words=3, percent=85)


def languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hyper_lang.identify(table(spark, sf_dir, "documents"))


def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return boosted_quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_tokens.scan(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_RANKS))


def spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_grams.spelling_groups(table(spark, sf_dir, "documents"))


def contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return suffix_automaton.report(docs, items, window=10)


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return block_repair.repair_report(table(spark, sf_dir, "conversations"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_block_lstm": page_text,
        "op2_min_bin_slack": packing,
        "op3_arrow_token_files": token_files,
        "op4_heavy_hitter_dedup": exact_dedup,
        "op5_distinct_word_bpe": byte_bpe,
        "op6_sorted_projections": near_embeddings,
        "op7_lsh_forest": near_dedup,
        "op8_hyperdimensional_language": languages,
        "op9_boosted_quality": quality,
        "op10_token_efficiency": secrets,
        "op11_pivotal_grams": spelling,
        "op12_suffix_automaton": contamination,
        "op13_block_tables": conversations,
    }


def oracles() -> dict[str, str]:
    """SQL counterparts, where SQL can express the result."""
    return sql.oracles()
