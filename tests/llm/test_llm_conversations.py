from __future__ import annotations

import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest
from pyspark.sql import functions as F

from orebed.llm import block_repair
from orebed.llm.common import ready

KEPT = {"": "su", "s": "u", "u": "a", "a": "u"}  # initials that may follow
SCHEMA = "conv_id long, turn long, role string, text string"


def cheapest(rows):
    """Least (cost, letters, lines) over all edits of (role, text, must go, unfinished) rows, tried one by one."""

    @lru_cache(maxsize=None)
    def rest(k, last, inserts):
        new = "assistant" if last == "u" else "user"
        found = []
        if k == len(rows) and last in ("", "a"):
            found.append((0, "", ()))
        if inserts < 3:
            cost, letters, lines = rest(k, new[0], inserts + 1)
            found.append((cost + 3, "I" + letters, (f"{new}:", *lines)))
        if k < len(rows):
            role, text, gone, unfinished = rows[k]
            steps = [(4, "D", last, ())]
            if not gone:
                if role[:1] and role[0] in KEPT[last]:
                    steps.append((3 * unfinished, "K", role[0], (f"{role}:{text}",)))
                steps.append((3 + 3 * unfinished, "R", new[0], (f"{new}:{text}",)))
            for cost, letter, to, line in steps:
                more = rest(k + 1, to, 0)
                found.append((cost + more[0], letter + more[1], (*line, *more[2])))
        return min(found, default=(10**6, "", ()))

    return rest(0, "", 0)


def by_hand(table):
    plain = [tuple(" " if x is None else x for x in (c, t, r, s)) for c, t, r, s in table]
    out = []
    for conv in {c for c, *_ in table}:
        rows = []
        for (c, turn, _, _), (name, number, role, text) in zip(table, plain, strict=True):
            kind = zlib.crc32(f"{name}:{number}".encode()) % 20
            if c != conv or kind == 0:
                continue
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            rows += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
        turns, faults, seen, symbols = {t for t, _, _ in rows if t is not None}, [], set(), []
        for _, role, text in rows:
            visible = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = "blank" if not visible else "duplicate" if (role, text) in seen else "truncated" if visible[-1] not in ".!?" else None
            seen.add((role, text))
            faults.append(fault)
            symbols.append((role, text, fault in ("blank", "duplicate"), fault == "truncated"))
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:], strict=False)]
        cost, letters, lines = cheapest(tuple(symbols))
        out.append((
            conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(faults.count(x) for x in ("blank", "duplicate", "truncated")),
            sum(p not in ("su", "ua", "au") for p in pairs), cost, letters, hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def test_plans_of_random_symbols():
    rng = random.Random(3)
    roles = ["system", "user", "assistant", "tool", ""]
    for n in range(2500):
        rows = tuple((rng.choice(roles), "x", rng.random() < 0.2, rng.random() < 0.3) for _ in range(n % 23))
        codes = bytes(block_repair.symbol(r, "blank" if gone else "truncated" if cut else None) for r, _, gone, cut in rows)
        assert block_repair.tables().plan(codes) == cheapest(rows)[:2]


def test_tables_are_few_and_agree_with_single_steps():
    built = block_repair.tables()
    assert len(built.vectors) < 200 and built.block_to.shape == (len(built.vectors), 10**block_repair.BLOCK)
    rng = random.Random(1)
    for _ in range(300):
        vector, digits = rng.randrange(len(built.vectors)), [rng.randrange(10) for _ in range(block_repair.BLOCK)]
        costs = built.vectors[vector]
        for code in reversed(digits):
            costs = block_repair.before(costs, code)
        block = int("".join(map(str, digits)))
        after, add = built.vectors[built.block_to[vector, block]], built.block_adds[vector, block]
        assert tuple(c + add for c in after) == costs


def random_rows(rng, conversations, longest):
    texts = ["Fine.", "Well!", "no end", "", " \n", None, "a?\t", "Hm. and", "Ünïcödé…", "Same.", "Same."]
    roles = ["user", "assistant"] * 4 + ["system", "tool", None, "User", "aide", ""]
    rows = []
    for conv in [*range(conversations), None]:
        turn = rng.randint(0, 3)
        for _ in range(rng.randint(1, longest)):
            rows.append((conv, turn if rng.random() < 0.95 else None, rng.choice(roles), rng.choice(texts)))
            turn += rng.choice([0, 1, 1, 1, 1, 2, 5])
            if rng.random() < 0.05:
                rows.append(rows[-1])
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_reports_of_random_conversations(spark, seed):
    ready(spark)
    rows = random_rows(random.Random(seed), 250, 12)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5).withColumn("audit", F.lit("x")).withColumn("is_row", F.lit(1)).withColumn("digest", F.lit("x"))
    got = block_repair.repair_report(df)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == by_hand(rows)


def test_conversation_over_many_batches(spark):
    """One conversation with most rows, longer than an Arrow batch, and conversations that lose all rows."""
    ready(spark)
    lost = [(c, 0) for c in range(10, 300) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    rows = [(5, i, ("user", "assistant")[i % 2], f"Row {i % 700}.") for i in range(9001)]
    rows += [(c, t, "user", "x") for c, t in lost] + [(6, 0, "user", "x" * 300_000 + "."), (6, 1, "assistant", "y.")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r["conv_id"]: r for r in block_repair.repair_report(df).collect()}
    assert set(got) == {c for c, *_ in rows} and got[5]["duplicate"] > 7000
    empty = hashlib.sha256(b"").hexdigest()
    assert lost and all(tuple(got[c])[1:] == (0, 0, 0, 0, 0, 0, "", empty) for c, _ in lost)


def test_repaired_conversations_are_legal(spark):
    ready(spark)
    rows = random_rows(random.Random(4), 150, 10)
    df = spark.createDataFrame(rows, SCHEMA)
    talks = {}
    for r in block_repair.repaired(df).orderBy("turn").collect():
        talks.setdefault(r["conv_id"], []).append(r)
    for talk in talks.values():
        assert re.fullmatch("s?(ua)+", "".join(r["role"][0] for r in talk))
        assert [r["turn"] for r in talk] == list(range(len(talk)))
    empty = df.where("false")
    assert block_repair.repaired(empty).count() == 0 and block_repair.repair_report(empty).count() == 0
