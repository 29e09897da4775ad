from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import pytest
from conftest import odd_rows
from pyspark.sql import functions as F

from orebed.llm import pivot_grams
from orebed.llm.common import ready


def near_by_hand(words):
    """Words of the same letters but one, by their forms without one letter."""
    without, near = defaultdict(set), {w: set() for w in words}
    for w in words:
        for i in range(len(w)):
            part = w[:i] + w[i + 1 :]
            without[i, part].add(w)
            if part in near:
                near[w].add(part)
                near[part].add(w)
    for group in without.values():
        for a, b in combinations(group, 2):
            near[a].add(b)
            near[b].add(a)
    return near


def groups_by_hand(counts, times=2):
    near, form = near_by_hand(counts), {}
    for w, others in near.items():
        if others:
            best = min(others, key=lambda x: (-counts[x], x.encode()))
            if counts[best] >= times * counts[w]:
                form[w] = best

    def root(w):
        return root(form[w]) if w in form else w

    return {(w, form.get(w), root(w), n, len(near[w]), counts.get(form.get(w))) for w, n in counts.items()}


def words_by_hand(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 97 == 0 else run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


@pytest.mark.parametrize("letters", ["ab", "abcdeé", "abcdefghijklmnopqrstuvwxyzÀß×"])
def test_variants_of_random_words(spark, letters):
    ready(spark)
    rng = random.Random(len(letters))
    counts = {"".join(rng.choices(letters, k=rng.randint(5, 9))): rng.randint(1, 60) for _ in range(400)}
    for w in list(counts)[:200]:  # chains, and repeated bigrams
        for _ in range(3):
            i, w = rng.randint(0, len(w)), w if len(w) < 12 else w[:6]
            w = rng.choice([w[:i] + rng.choice(letters) + w[i:], w[:i] + rng.choice(letters) + w[i + 1 :], w[:i] + w[i + 1 :]])
            if len(w) >= 5:
                counts.setdefault(w, rng.randint(1, 60))
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert set(map(tuple, pivot_grams.variants(df).collect())) == groups_by_hand(counts)


def test_pivots_are_the_lightest_disjoint_pair():
    rng = random.Random(2)
    for _ in range(500):
        prefix = sorted(rng.sample(range(12), rng.randint(3, 8)))
        weights = [rng.randint(1, 9) for _ in range(12)]
        prefix = [(place, rng.randrange(12)) for place in prefix]
        found = pivot_grams.pivots_of(prefix, weights)
        least = min(weights[a[1]] + weights[b[1]] for a, b in combinations(prefix, 2) if b[0] - a[0] >= 2)
        assert found[1][0] - found[0][0] >= 2 and sum(weights[g] for _, g in found) == least


def test_words_of_documents(spark):
    ready(spark)
    rng = random.Random(7)
    vocabulary = ["Strasse", "strasse", "straße", "Élan", "élans", "ÉLANS", "naïve", "naive", "wörter", "woerter", "abcd", "x" * 300]
    rows = [(i % 90 or None, " 1-".join(rng.choices(vocabulary, k=40))) for i in range(200)] + [(1, None), (2, ""), (None, " \n ")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    counted = {r["word"]: r["n"] for r in pivot_grams.word_counts(df).collect()}
    assert counted == words_by_hand(rows)
    assert any(w.startswith("x") and len(w) == 299 for w in counted) or len(counted) > 8
    assert set(map(tuple, pivot_grams.spelling_groups(df).collect())) == groups_by_hand(counted)


def test_odd_rows(odd, empty):
    df = odd.withColumn("word", F.lit("x")).withColumn("key", F.lit("x"))
    expected = groups_by_hand(words_by_hand([(d, t) for d, t, _ in odd_rows()]))
    assert set(map(tuple, pivot_grams.spelling_groups(df).collect())) == expected
    out = pivot_grams.spelling_groups(empty)
    assert out.count() == 0 and out.columns == ["word", "form", "root", "n", "n_near", "form_n"]
