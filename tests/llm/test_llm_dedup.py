from __future__ import annotations

import hashlib
import random
import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import odd_rows

from orebed.llm import common, heavy_dedup, lsh_forest, projection_dedup
from orebed.session import durable


def unite(nodes, links):
    above = {n: n for n in nodes}

    def top(n):
        while above[n] != n:
            n = above[n]
        return n

    for a, b in links:
        a, b = top(a), top(b)
        above[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


def test_components_of_paths_stars_and_cycles(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 400)] + [(2000, 2001), (2001, 2002), (2002, 2000)]
    rng.shuffle(links)
    expected = unite({x for p in links for x in p}, links)
    df = spark.createDataFrame(links, "a long, b long").repartition(9)
    assert {r["node"]: r["component"] for r in common.components(df, "long").collect()} == expected
    assert common.components(df.where("false"), "long").count() == 0


def test_frequent_finds_all_heavy_values(spark):
    values = [f"v{i % 5}" for i in range(3000)] + [f"rare{i}" for i in range(20000)] + [None] * 50
    df = spark.createDataFrame([(v,) for v in values], "v string").repartition(6)
    found = common.frequent(df, "v")
    assert {f"v{i}" for i in range(5)} <= set(found) and len(found) <= common.COUNTERS + 1


def test_exact_copies(odd, empty):
    rows = heavy_dedup.find_copies(odd).collect()
    groups, expected = defaultdict(list), Counter()
    for doc_id, text, _ in odd_rows():
        digest = hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", text or "").encode()).hexdigest()
        groups[digest].append(doc_id)
    for digest, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        for doc_id in ids:
            expected[(doc_id, keep, len(ids), digest)] += 1
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in rows) == expected
    kept = Counter(r["text_sha256"] for r in rows if r["kept"])
    assert kept == Counter(groups.keys()) and all(r["doc_id"] == r["keep_id"] for r in rows if r["kept"])
    stays = heavy_dedup.drop_copies(odd)
    assert stays.columns == odd.columns and stays.count() == len(groups)
    assert heavy_dedup.find_copies(empty).count() == 0 and heavy_dedup.drop_copies(empty).count() == 0


def test_frequent_digests_need_no_workers_of_their_own(odd, monkeypatch):
    plans = []
    monkeypatch.setattr(heavy_dedup, "durable", lambda df: plans.append(df._jdf.queryExecution().analyzed().toString()) or durable(df))
    heavy_dedup.find_copies(odd)
    # A list of rows becomes a LogicalRDD, whose rows pass through plain Python workers.
    assert len(plans) == 2 and "LogicalRDD" not in plans[1]


def test_hot_group_of_copies(spark):
    rows = [(i, "hot text" if i % 3 == 0 else f"text {i // 2}") for i in range(9000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    found = {r["doc_id"]: r for r in heavy_dedup.find_copies(df).collect()}
    assert len(found) == 9000 and found[3]["group_size"] == 3000 and found[8997]["keep_id"] == 0
    assert sum(r["kept"] for r in found.values()) == len({t for _, t in rows})


def shingle_set(text, words):
    found = [w.lower() if w.isascii() else w for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
    n = min(words, len(found))
    return {tuple(found[i : i + n]) for i in range(len(found) - n + 1)} if n else set()


def near_by_hand(rows, words, percent):
    sets = {d: shingle_set(t, words) for d, t in rows}
    links = []
    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    links.append((a, b))
    return sets, unite(list(sets), links)


@pytest.mark.parametrize(("words", "percent"), [(3, 85), (5, 80)])
def test_near_copies_match_all_pairs(spark, words, percent):
    rng = random.Random(words)
    base = [[f"w{rng.randint(0, 400)}" for _ in range(rng.randint(6, 120))] for _ in range(60)]
    rows = []
    for text in base:
        for _ in range(rng.choice([1, 1, 2, 3, 25])):
            copy = list(text)
            for _ in range(rng.randint(0, max(1, len(copy) // 30))):
                copy[rng.randrange(len(copy))] = f"x{rng.randint(0, 99)}"
            rows.append((len(rows), " ".join(copy)))
    rows += [(len(rows), None), (len(rows) + 1, ""), (len(rows) + 2, "one"), (len(rows) + 3, "ONE"), (len(rows) + 4, "one two")]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    sets, expected = near_by_hand(rows, words, percent)
    found = lsh_forest.near_groups(df, words, percent).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == expected
    assert all(r["n_shingles"] == len(sets[r["doc_id"]]) and r["kept"] == (r["doc_id"] == r["component_id"]) for r in found)


@pytest.mark.parametrize("ids", ["null", "one"])
def test_near_copies_without_ids_meet_only_themselves(spark, monkeypatch, ids):
    rng = random.Random(9)
    texts = []
    for _ in range(700):
        text = [f"w{rng.randint(0, 10**6)}" for _ in range(60)]
        texts += [" ".join(text), " ".join([*text[:-1], "z"]), " ".join([*text[:-1], "z"])]
    read = []
    real = lsh_forest.with_text

    def counting(wanted, rows):
        out = real(wanted, rows)
        read.append((wanted.count(), out.count()))
        return out

    monkeypatch.setattr(lsh_forest, "with_text", counting)
    df = spark.createDataFrame([(None if ids == "null" else 7, t) for t in texts], "doc_id long, text string").repartition(4)
    assert lsh_forest.drop_near(df, 3, 85).count() == 700
    assert read == [(1400, 1400)]  # one text a class, however often it is there


def test_near_copies_across_blocks(spark, monkeypatch):
    monkeypatch.setattr(lsh_forest, "SPAN", 16)
    rng = random.Random(2)
    text = [f"w{i}" for i in range(300)]
    rows = [(i, " ".join([*text[: rng.randint(0, 299)], f"x{i}", *text[299:]])) for i in range(40)]
    rows += [(100 + i, " ".join([*text[: i % 290], f"y{i}", *text[i % 290 + 1 :]])) for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = lsh_forest.near_groups(df, 3, 85).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == near_by_hand(rows, 3, 85)[1]


def test_a_full_block_is_compared_in_bounded_memory():
    rng = np.random.default_rng(3)
    common_part = rng.integers(0, 1 << 62, 60).astype(np.uint64)
    sets = [np.unique(np.append(common_part, rng.integers(0, 1 << 62, 5 + 20 * (i % 2)).astype(np.uint64))) for i in range(2 * lsh_forest.SPAN)]
    tracemalloc.start()
    links = lsh_forest.spanning_links(sets, 80)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # 60 of 70 are shared by two of the small sets, 60 of 90 by a small and a large one.
    assert sorted(links) == [(0, i) for i in range(2, len(sets), 2)]
    assert peak < 64e6


def test_near_copies_of_one_template(spark, monkeypatch):
    monkeypatch.setattr(lsh_forest, "SPAN", 32)
    template = [f"w{i}" for i in range(92)]
    # Any two share the template's 90 shingles of 98 (similarity 0.849); each planted pair a few more.
    rows = [(i, " ".join([*template, *(f"x{i}-{k}" for k in range(8))])) for i in range(3000)]
    for i in range(0, 400, 2):
        rows[i + 1] = (i + 1, " ".join([*rows[i][1].split()[:98], f"y{i}", f"z{i}"]))
    rng = random.Random(5)
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = lsh_forest.near_groups(df, 3, 85).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == {i: i - i % 2 if i < 400 else i for i, _ in rows}


def test_near_copies_of_odd_rows(odd, empty):
    rows = lsh_forest.near_groups(odd).collect()
    assert len(rows) == len(odd_rows())
    by_id = {r["doc_id"]: r["component_id"] for r in rows if r["doc_id"] not in (None, 13)}
    assert by_id == {5: 3, 3: 3, 8: 3, 1: 1, 2: 2, 9: 9, 10: 10, 11: 10, 12: 12, 14: 14}
    assert sorted((r["component_id"], r["n_shingles"]) for r in rows if r["doc_id"] is None and r["n_shingles"]) == [(3, 3)]
    assert lsh_forest.near_groups(empty).count() == 0
    assert lsh_forest.drop_near(odd).columns == odd.columns and lsh_forest.drop_near(empty).count() == 0


def test_one_row_of_each_group_stays(spark, odd):
    text = [f"w{i}" for i in range(60)]
    near = [" ".join([*text, f"x{i}"]) for i in range(9)]
    clean = [f"clean text number {i} of words that nothing else has {i}" for i in range(6)]
    rows = [(1, near[0]), (None, near[1]), (None, clean[0]), (None, clean[1]), (2, near[2]), (2, clean[2]), (4, clean[3]), (4, clean[3])]
    other = [" ".join([*(f"v{i}" for i in range(60)), f"x{i}"]) for i in range(4)]
    last = [" ".join([*(f"u{i}" for i in range(60)), f"x{i}"]) for i in range(3)]
    rows += [(7, other[0]), (7, other[1]), (8, other[2]), *((None, t) for t in last), (None, None), (None, ""), (None, " ")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = Counter((r["doc_id"], r["text"]) for r in lsh_forest.drop_near(df).collect())

    def smallest(texts):
        return min(texts, key=lambda t: hashlib.sha256(t.encode()).hexdigest())

    wanted = [(1, near[0]), (None, clean[0]), (None, clean[1]), (2, clean[2]), (4, clean[3]), (7, smallest(other[:2])), (None, smallest(last))]
    assert found == Counter([*wanted, (None, None), (None, ""), (None, " ")])
    stays = Counter((r["doc_id"], r["text"]) for r in lsh_forest.drop_near(odd).collect())
    gone = Counter((i, t) for i, t, _ in odd_rows()) - stays
    assert gone == Counter([(5, odd_rows()[0][1]), (3, odd_rows()[1][1]), (8, odd_rows()[0][1]), (None, odd_rows()[0][1]), (11, odd_rows()[10][1])])


def vectors(rng):
    centres = rng.standard_normal((40, 16))
    out = [c + rng.normal(0, s, 16) for c in centres for s in [0.0] * 3 + [0.02] * 6 + [0.2] * 2]
    return [x.astype(np.float32).tolist() for x in out]


def test_vectors_match_all_pairs(spark):
    rows = list(enumerate(vectors(np.random.default_rng(4)))) + [(1000, [2.0 * v for v in vectors(np.random.default_rng(4))[0]])]
    x = np.array([v for _, v in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.95
    odd = [(2000, None), (2001, []), (2002, [0.0] * 16), (2003, [float("nan")] * 16), (2004, [None, *[1.0] * 15]), (2005, [float("inf")] * 16)]
    odd += [(2006, [1.0, 0.0]), (2007, [1.0, 0.01]), (None, [1e-30, 0.0]), (2008, [0.0, 1.0])]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>").withColumnRenamed("x", "digest").repartition(5)
    found = {r["vec_id"]: r for r in projection_dedup.near_vectors(df).collect()}
    ids = [i for i, _ in rows]
    expected = unite(ids, [(ids[a], ids[b]) for a, b in zip(*np.nonzero(np.triu(near, 1)), strict=True)])
    assert {i: found[i]["component_id"] for i in ids} == expected
    assert {i: found[i]["n_links"] for i in ids} == {i: int(near[k].sum()) - 1 for k, i in enumerate(ids)}
    assert all(found[i]["n_links"] == 0 and found[i]["kept"] and found[i]["component_id"] == i for i in (2000, 2001, 2002, 2003, 2004, 2005, 2008))
    assert found[2006]["n_links"] == found[2007]["n_links"] == found[None]["n_links"] == 2
    assert found[None]["component_id"] == 2006 and not found[None]["kept"]
    assert projection_dedup.near_vectors(df.where("false")).count() == 0


def test_repeated_vectors_count(spark):
    df = spark.createDataFrame([(i // 2, [1.0, 2.0]) for i in range(3000)], "vec_id long, embedding array<double>")
    assert {tuple(r)[1:] for r in projection_dedup.near_vectors(df).collect()} >= {(2999, 0, True), (2999, 0, False)}


def test_pairs_in_a_dense_group_without_links(spark):
    rng = np.random.default_rng(6)

    def units(shape):
        x = rng.standard_normal(shape)
        return x / np.linalg.norm(x, axis=1, keepdims=True)

    centre, size = np.eye(64)[0], 20000
    rest = units((size, 64))
    rest[:, 0] = 0
    rest /= np.linalg.norm(rest, axis=1, keepdims=True)
    # In the group any two have a cosine of about 0.88; each planted pair 0.952.
    x = np.sqrt(0.88) * centre + np.sqrt(0.12) * rest
    for i in range(0, 600, 2):
        across = rest[i + 1] - (rest[i + 1] @ rest[i]) * rest[i]
        across /= np.linalg.norm(across)
        x[i + 1] = np.sqrt(0.88) * centre + np.sqrt(0.12) * (0.6 * rest[i] + 0.8 * across)
    near = [(a + int(i), int(j)) for a in range(0, size, 2000) for i, j in zip(*np.nonzero(x[a : a + 2000] @ x.T >= 0.95), strict=True)]
    expected = unite(range(size), [(i, j) for i, j in near if i < j])
    assert all(expected[i + 1] == expected[i] for i in range(0, 600, 2))
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate([x, units((size, 64))]))]
    found = projection_dedup.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(8))
    labels = {r["vec_id"]: r["component_id"] for r in found.where(f"vec_id < {size}").collect()}
    assert sum(labels[i] != expected[i] for i in range(size)) <= 3


def test_component_larger_than_a_block(spark, monkeypatch):
    monkeypatch.setattr(projection_dedup, "BLOCK", 32)
    rng = np.random.default_rng(3)
    x = np.ones(24) + rng.normal(0, 0.12, (150, 24))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    units = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = units @ units.T >= 0.95
    assert {r["vec_id"]: r["n_links"] for r in projection_dedup.near_vectors(df).collect()} == {i: int(n) - 1 for i, n in enumerate(near.sum(axis=1))}
