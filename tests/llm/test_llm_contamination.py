from __future__ import annotations

import hashlib
import random
import re

import pytest
from conftest import odd_rows
from pyspark.sql import functions as F

from orebed.llm import suffix_automaton
from orebed.llm.common import ready


def words_by_hand(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def by_hand(docs, items, window):
    windows = []
    for item, text in set(items):
        words = words_by_hand(text)
        k = min(window, len(words))
        windows += [(item, tuple(words[i : i + k])) for i in range(len(words) - k + 1) if k]
    out = []
    for doc_id, text in docs:
        words, hit, found = words_by_hand(text), set(), set()
        for item, part in set(windows):
            for i in range(len(words) - len(part) + 1):
                if tuple(words[i : i + len(part)]) == part:
                    hit |= set(range(i, i + len(part)))
                    found |= {str(item)} if item is not None else set()
        names = ",".join(sorted(found))
        out.append((doc_id, len(words), len(hit), len(found), hashlib.sha256(names.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def rows_of(rng, letters, n, longest):
    return [" ".join(rng.choices(letters, k=rng.randint(0, longest))) for _ in range(n)]


@pytest.mark.parametrize(("letters", "window"), [("ab", 3), ("abc", 4), ("abcdefgh", 2), ("abcdÉ", 5)])
@pytest.mark.parametrize("block", [200_000, 30])
def test_hits_of_random_texts(spark, monkeypatch, letters, window, block):
    """Few different words, so states are cloned, windows overlap and short items nest; also in several blocks."""
    ready(spark)
    monkeypatch.setattr(suffix_automaton, "BLOCK", block)
    rng = random.Random(window)
    texts = rows_of(rng, letters, 14, 9)
    items = [(i % 11 or None, t) for i, t in enumerate(texts)] + [(3, "A b-A"), (3, None), (77, ""), (78, texts[0]), (0, texts[0])]
    docs = list(enumerate(rows_of(rng, letters + "z", 60, 25))) + [(None, texts[1]), (5, "x\x00a\x7fb{a}B É"), (5, None)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = [tuple(r) for r in suffix_automaton.report(df, benchmark, window).collect()]
    assert sorted(got, key=str) == by_hand(docs, items, window)


def test_long_items_in_pieces(spark, monkeypatch):
    ready(spark)
    monkeypatch.setattr(suffix_automaton, "PIECE", 7)
    rng = random.Random(5)
    long = " ".join(rng.choices("abcdefg", k=200))
    items = [(1, long), (2, long[:19]), (3, long[40:59])]
    docs = [(1, "q " + long[60:100] + " q " + long[20:38]), (2, long), (3, long[:16])]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert sorted((tuple(r) for r in suffix_automaton.report(df, benchmark, 10).collect()), key=str) == by_hand(docs, items, 10)


def test_automaton_lengths_are_longest_matches():
    """Every state's longest run ends where the words of its own path lead, and links are its suffixes."""
    rng = random.Random(9)
    items = [([bytes([c]) for c in rng.choices(b"abc", k=rng.randint(1, 12))], [str(i)], True) for i in range(20)]
    built = suffix_automaton.Automaton(items, 4)
    runs = {tuple(w[i:j]) for w, _, _ in items for i in range(len(w)) for j in range(i + 1, len(w) + 1)}
    reached = set()
    for part in runs:
        state = 0
        for word in part:
            state = built.go[state * built.words + built.vocabulary[word]]
        assert built.length[built.link[state]] < len(part) <= built.length[state]
        reached.add(state)
    assert reached == set(range(1, len(built.length)))


def test_passages_are_removed(spark):
    ready(spark)
    passage = "one two three four five six seven eight nine ten eleven"
    rest = " ".join(f"word{i}" for i in range(20))
    docs = [
        (1, f"Start here: {passage.title()}, end. {rest}", 7),
        (2, rest, 8),
        (3, passage, 9),
        (4, None, None),
        (5, "", 0),
    ]
    df = spark.createDataFrame(docs, "doc_id long, text string, n_chars int").withColumn("spans", F.lit("x"))
    benchmark = spark.createDataFrame([(1, passage), (2, "word3")], "item_id long, text string")
    out = suffix_automaton.without_benchmark(df, benchmark)
    assert out.columns == df.columns and out.schema["n_chars"].dataType == df.schema["n_chars"].dataType
    short = f"Start here: , end. {rest}"
    assert {tuple(r)[:3] for r in out.collect()} == {(1, short, len(short)), (2, rest, 8), (4, None, None), (5, "", 0)}


def test_odd_rows(spark, odd, empty):
    df = odd.withColumn("__x", F.lit(1)).withColumn("spans", F.lit("x")).withColumn("items", F.lit(2))
    items = [(1, "the same text here twice"), (2, "Ünïcödé ßtraße"), (3, "lorem ipsum dolor " * 30), (4, "word"), (None, "another text")]
    benchmark = spark.createDataFrame(items, "item_id long, text string").withColumn("words", F.lit(1))
    got = sorted((tuple(r) for r in suffix_automaton.report(df, benchmark).collect()), key=str)
    docs = [(d, t) for d, t, _ in odd_rows() if d not in (10, 11)]
    assert [r for r in got if r[0] not in (10, 11)] == by_hand(docs, items, 10)
    assert {r[1:4] for r in got if r[0] in (10, 11)} == {(90000, 90000, 1)}
    assert suffix_automaton.report(empty, benchmark).count() == 0
    nothing = suffix_automaton.report(df, benchmark.where("false"))
    assert nothing.count() == len(odd_rows()) and nothing.where("contaminated or n_hit > 0").count() == 0
    assert suffix_automaton.without_benchmark(df, benchmark).columns == df.columns
