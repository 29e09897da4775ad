from __future__ import annotations

import random
from collections import defaultdict

import corpus_pipeline
import pytest
from test_llm_dedup import near_by_hand

from orebed.llm import boosted_quality, heavy_dedup, lsh_forest, secret_tokens, words
from orebed.llm.common import ready, table
from orebed.session import durable

SF = "/root/testdata/sf0.01"


def test_stages_keep_the_columns(spark):
    docs = table(spark, SF, "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns


def test_rejected_documents_go_and_clean_ones_stay(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    kept = {r["doc_id"] for r in corpus_pipeline.quality(spark, docs, SF).select("doc_id").collect()}
    scored = boosted_quality.classify(docs, labels).collect()
    assert kept == {r["doc_id"] for r in scored if r["predicted"]}
    good = {r["doc_id"] for r in labels.where("quality = 1").collect()}
    assert len(good & kept) >= 0.99 * len(good)


def test_copies_stage(spark):
    docs = table(spark, SF, "documents")
    kept = [r["doc_id"] for r in corpus_pipeline.exact_copies(spark, docs, SF).collect()]
    assert sorted(kept) == sorted(r["doc_id"] for r in heavy_dedup.find_copies(docs).where("kept").collect())


def test_near_copies_stage(spark):
    ready(spark)
    rng = random.Random(8)
    text = [f"w{rng.randint(0, 900)}" for _ in range(120)]
    rows = [(i, " ".join([*text[: 3 * i], f"x{i}", *text[3 * i + 1 :]]) if i < 20 else f"clean text number {i} of many words here") for i in range(60)]
    df = spark.createDataFrame([(d, t, "en", "s", len(t)) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r["doc_id"] for r in corpus_pipeline.near_copies(spark, df, SF).collect()}
    assert kept == set(near_by_hand(rows, 5, 80)[1].values())


def test_secrets_stage_keeps_rows(spark):
    docs = table(spark, SF, "documents")
    out = corpus_pipeline.secrets(spark, docs, SF)
    assert out.count() == docs.count()
    left = secret_tokens.scan(out, corpus_pipeline.public_tokenizers.path("byte_bpe_50k.tiktoken"))
    assert left.where("n_access > 0 or n_hex > 0").count() == 0
    assert out.join(docs, ["doc_id", "text", "n_chars"], "left_anti").count() < docs.count() // 20


def test_run_packs_what_the_stages_keep(spark):
    docs = table(spark, SF, "documents")
    by_hand = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        by_hand = durable(stage(spark, by_hand, SF))
    rows = corpus_pipeline.run(spark, SF).collect()
    assert {r["doc_id"] for r in rows} == {r["doc_id"] for r in by_hand.select("doc_id").collect()}
    bins = defaultdict(int)
    for r in rows:
        bins[r["sequence_id"]] += r["length"]
    assert max(bins.values()) <= 2048


@pytest.mark.parametrize("stage", [f for _, f in corpus_pipeline.STAGES])
def test_empty_and_null_documents(spark, stage):
    ready(spark)
    schema = "doc_id long, text string, lang string, source string, n_chars long, kept string"
    assert stage(spark, spark.createDataFrame([], schema), SF).count() == 0
    nulls = spark.createDataFrame([(None, None, None, None, None, None), (1, "", "en", "s", 0, "k"), (1, "", "en", "s", 0, "k")], schema)
    assert stage(spark, nulls, SF).count() <= 3


@pytest.mark.parametrize("step", [boosted_quality._measure, lsh_forest._signatures(5, 13), lsh_forest._verify(5, 80)])
def test_workers_let_go_of_the_ids_of_an_earlier_stage(step):
    words.pieces(corpus_pipeline.public_tokenizers.path("word_bpe_49k.json"))
    list(step(iter(())))
    assert words.pieces.cache_info().currsize == 0


def test_batches_of_the_stages_are_small(spark):
    docs = table(spark, SF, "documents")
    for _, stage in corpus_pipeline.STAGES:
        ready(spark)
        stage(spark, docs.limit(50), SF)
        assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) <= 2 << 20
