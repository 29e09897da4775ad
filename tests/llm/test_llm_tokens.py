from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from conftest import odd_rows
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from orebed.llm import arrow_ids, min_slack, word_table, words
from orebed.llm.words import id_bytes, pieces
from orebed.session import durable, work_dir

WORD, BYTE = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json"))
LETTERS = list("abcXYZ  's\n\n\t\r're,.!?0129 éÉßÀ×÷ªº²½ſKΣςσ́ͅİı\x1c\x85\xa0 　中한🙂") + ["<|endoftext|>", "'LL", " a", "<|startoftext|>"]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    return ["".join(rng.choice(LETTERS) for _ in range(rng.randint(0, 30))) for _ in range(8000)]


def word_ids(text, end):
    return [*Tokenizer.from_file(WORD).encode(text or "", add_special_tokens=False).ids, end]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_piecewise_ids_are_those_of_the_whole_text(texts):
    library, cache = Tokenizer.from_file(WORD), pieces(WORD)
    for text in texts:
        assert np.frombuffer(id_bytes(cache, text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_words_that_differ_in_case_or_marks_are_merged_once():
    cache, asked = words.PieceCache(WORD), []
    merge = cache.tokenize
    cache.tokenize = lambda part: asked.append(part) or merge(part)
    text = 'Zumbly zumbly, ZUMBLY. (zumbly) "Zumbly!" zumblÿ Zumblÿ'
    assert np.frombuffer(id_bytes(cache, text), "<u4").tolist() == word_ids(text, 0)[:-1]
    assert len(asked) == len(set(asked))


def test_small_cache_gives_the_same_ids(texts, monkeypatch):
    monkeypatch.setattr(words, "CACHED", 40)
    library, cache = Tokenizer.from_file(WORD), words.PieceCache(WORD)
    for text in texts[:2000]:
        assert np.frombuffer(id_bytes(cache, text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
        assert len(cache) + len(cache.older) <= 2 * 40


def test_chunk_ids_are_those_of_the_whole_text(texts):
    bpe = word_table.byte_bpe(BYTE)
    for text in texts:
        chunks = [word_table.chunk_of(k) for k in word_table.word_keys(text, bpe.special)]
        assert "".join(chunks) == text
        ids = [i for c in chunks for i in bpe.ids(c)]
        assert ids == bpe.tokenizer.encode(text, add_special_tokens=False).ids
        assert b"".join(bpe.piece[i] for i in ids).decode() == bpe.tokenizer.decode(ids, skip_special_tokens=False)


def test_byte_bpe_round_trip(odd, empty):
    library = Tokenizer.from_file(BYTE)
    expected = Counter()
    for doc_id, text, _ in odd_rows():
        ids = library.encode(text or "", add_special_tokens=False).ids
        joined, back = ",".join(map(str, ids)), library.decode(ids, skip_special_tokens=False)
        expected[(doc_id, len(ids), *(hashlib.sha256(s.encode()).hexdigest() for s in (joined, back)))] += 1
    assert Counter(map(tuple, word_table.round_trip(odd, BYTE).collect())) == expected
    assert word_table.round_trip(empty, BYTE).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_fullest_is_optimal(seed):
    rng = random.Random(seed)
    for _ in range(60):
        counts = {rng.randint(1, 20): rng.randint(1, 3) for _ in range(5)}
        room = rng.randint(0, 40)
        sums = {0}
        for length, n in counts.items():
            sums = {s + k * length for s in sums for k in range(n + 1)}
        chosen = min_slack.fullest(counts, room)
        assert sum(x * n for x, n in chosen.items()) == max(s for s in sums if s <= room)
        assert all(n <= counts[x] for x, n in chosen.items())


def check_packing(rows, limit):
    bins = defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= limit
    return len(bins)


def test_pack_documents(odd, empty):
    rows = min_slack.pack_documents(odd, WORD, 512, 0).collect()
    pieces_of = defaultdict(list)
    expected = Counter()
    for doc_id, text, _ in odd_rows():
        ids = word_ids(text, 0)
        for k, at in enumerate(range(0, len(ids), 512)):
            expected[(doc_id, k, at, len(ids[at : at + 512]), crc(ids[at : at + 512]))] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == expected
    bins = check_packing(rows, 512)
    assert bins <= -(-sum(r["length"] for r in rows) // 512) + 1
    assert not pieces_of and min_slack.pack_documents(empty, WORD, 512, 0).count() == 0


def test_pieces_are_cut_and_numbered_by_one_python_worker(odd, monkeypatch):
    plans = []
    monkeypatch.setattr(min_slack, "durable", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or durable(df))
    min_slack.pack_documents(odd, WORD, 512, 0)
    assert sum("MapInArrow" in line for line in plans[0].splitlines()) == 1


def test_pack_ties_and_hot_lengths(spark):
    rng = random.Random(3)
    lengths = [rng.choice([700, 700, 700, 324, 1, 1024, rng.randint(1, 1024)]) for _ in range(4000)]
    items = spark.createDataFrame([(x, i) for i, x in enumerate(lengths)], "length long, id int").repartition(7)
    rows = min_slack.pack(items, 1024).collect()
    assert sorted(r["id"] for r in rows) == list(range(4000))
    assert all(r["length"] == lengths[r["id"]] for r in rows)
    # 700 does not go with 700, so those alone need a bin each; the rest has to fit around them.
    bound = max(sum(x > 512 for x in lengths), -(-sum(lengths) // 1024))
    assert check_packing(rows, 1024) <= bound * 1.01 + 1


def test_pack_refuses_lengths_beyond_the_limit(spark):
    with pytest.raises(Exception, match="outside"):
        min_slack.pack(spark.createDataFrame([(2000,)], "length long"), 1024).collect()


def test_arrow_files_round_trip(odd, empty):
    rows = arrow_ids.round_trip(odd, WORD, size=64, end=2).collect()
    expected = Counter()
    for doc_id, text, _ in odd_rows():
        ids = word_ids(text, 2)
        expected[(doc_id, len(ids), crc(ids))] += 1
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in rows) == expected
    at, last = 0, None
    for r in sorted(rows, key=lambda r: r["start"]):
        assert r["start"] == at
        assert last is None or (r["doc_id"] is not None and last <= r["doc_id"])
        at, last = at + r["n_tokens"], r["doc_id"]
    assert arrow_ids.round_trip(empty, WORD).count() == 0


def test_each_arrow_file_is_read_by_a_task_of_its_own(spark):
    docs = spark.createDataFrame([(i, f"word {i} " * 40) for i in range(4000)], "doc_id long, text string")
    folder = work_dir(spark, "files")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "6")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        files = arrow_ids.write_files(docs, folder, WORD, size=64, end=2)
        assert files.count() == 6
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    read = arrow_ids.read_digests(files, folder).withColumn("task", F.spark_partition_id())
    assert read.count() == 4000 and read.select("task").distinct().count() == 6


def test_arrow_sequences_are_views(spark, odd):
    folder = work_dir(spark, "files")
    files = arrow_ids.write_files(odd, folder, WORD, size=64, end=2).orderBy("file").collect()
    stream = []
    for f in files:
        reader = arrow_ids.open_arrow(folder, f"{f['file']}.sequences")
        number = -(-f["tokens"] // 64)
        for i in range(number):
            ids, mask = arrow_ids.sequence(reader, i)
            assert len(ids) == 64 and not ids.flags.owndata and not mask.flags.owndata and (mask.all() or i == number - 1)
            stream += ids[mask].tolist()
    first = [t for d, t, _ in odd_rows() if d == 1 or d == 2]
    assert stream.count(2) >= len(odd_rows()) and len(stream) == sum(f["tokens"] for f in files)
    assert sum(len(word_ids(t, 2)) for t in first) == 2
