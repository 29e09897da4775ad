"""Versions of a table compared by bucket checksums, against a brute-force difference."""

from __future__ import annotations

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from orebed.operators.versions import differing_buckets, drilldown, save_version
from orebed.session import work_dir

SCHEMA = "k string, surplus int, v string, list array<string>"


def saved(spark, rows, buckets=16, keys=("k",), schema=SCHEMA):
    path = work_dir(spark, "version")
    save_version(spark.createDataFrame(rows, schema), keys, path, buckets)
    return path


def files_read(spark, left, right) -> int:
    """Row files that a comparison opened, from the metrics of a plan in one piece."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = drilldown(spark, left, right)
        df.collect()
        leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    scans = [leaves.apply(i) for i in range(leaves.size())]
    return sum(s.metrics().apply("numFiles").value() for s in scans if "/rows" in s.toString())


def expected(left, right):
    a, b = (Counter((k, s, v, tuple(x) if x is not None else None) for k, s, v, x in rows) for rows in (left, right))
    found = defaultdict(lambda: (Counter(), Counter()))
    for row, n in (a - b).items():
        found[row[0]][0][row] = n
    for row, n in (b - a).items():
        found[row[0]][1][row] = n
    out = set()
    for k, (gone, new) in found.items():
        change = "changed" if gone and new else "removed" if gone else "added"
        named = [
            name for name, at in (("list", 3), ("surplus", 1), ("v", 2))
            if {r[at] for r in gone} != {r[at] for r in new}
        ] if change == "changed" else []
        out.add((k, change, sum(gone.values()), sum(new.values()), ",".join(named)))
    return out


def test_all_kinds_of_change(spark):
    left = [(f"k{i}", i % 7, f"v{i % 5}", ["x", None]) for i in range(400)] + [(None, 1, None, None)] * 3
    left += [("twice", 1, "a", [])] * 2 + [("hot", i, "h", None) for i in range(300)] + [("swap", None, "x", None), ("list", 1, "x", [None, "a"])]
    right = [r for r in left if r[0] not in ("k3", "k77")]
    right = [(k, s + 100, v, x) if k == "k5" else (k, s, None, ["x"]) if k == "k6" else (k, s, v, x) for k, s, v, x in right]
    right.remove(("twice", 1, "a", []))  # only a copy is gone
    right.remove((None, 1, None, None))
    right.remove(("list", 1, "x", [None, "a"]))
    right += [("new", 0, "n", None), ("list", 1, "x", ["a", None])]
    a, b = saved(spark, left), saved(spark, right)
    found = {tuple(r) for r in drilldown(spark, a, b).collect()}
    assert found == expected(left, right) and len(found) == 8
    assert {tuple(r) for r in drilldown(spark, b, a).collect()} == expected(right, left)


def test_nulls_keep_their_place(spark):
    schema = "k int, v string, w string"
    a = saved(spark, [(1, "x", None)], schema=schema)
    b = saved(spark, [(1, None, "x")], schema=schema)
    assert [tuple(r) for r in drilldown(spark, a, b).collect()] == [(1, "changed", 1, 1, "v,w")]


def test_only_differing_buckets_are_read(spark):
    rows = [(f"k{i}", i, "v", None) for i in range(2_000)]
    a, b = saved(spark, rows, 64), saved(spark, [*rows[:-1], ("k1999", 0, "w", None)], 64)
    assert differing_buckets(spark, a, b).count() == 1
    files = sum(len(spark.read.parquet(f"{p}/rows").inputFiles()) for p in (a, b))
    assert 0 < files_read(spark, a, b) <= files / 16
    assert [tuple(r) for r in drilldown(spark, a, b).collect()] == [("k1999", "changed", 1, 1, "surplus,v")]
    same = saved(spark, rows[::-1], 64)  # another order of rows
    assert differing_buckets(spark, a, same).count() == 0
    assert files_read(spark, a, same) == 0 and drilldown(spark, a, same).count() == 0


def test_a_hot_key_is_written_by_several_tasks(spark):
    df = spark.range(40_000).select(F.lit("hot").alias("k"), F.lit(1).alias("v"))
    path = work_dir(spark, "version")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small partitions stay as they are
    try:
        save_version(df, ["k"], path, 4)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    rows = spark.read.parquet(f"{path}/rows")
    assert rows.count() == 40_000 and len(rows.inputFiles()) > 1


def test_few_buckets_are_written_where_their_rows_lie(spark):
    """Every task writes its rows of each bucket; of many buckets, a task writes some whole ones."""
    df = spark.range(0, 16_000, 1, 4).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    few, many = work_dir(spark, "version"), work_dir(spark, "version")
    save_version(df, ["k"], few, 8)
    save_version(df, ["k"], many, 100)
    written = {p: spark.read.parquet(f"{p}/rows") for p in (few, many)}
    assert {p: rows.count() for p, rows in written.items()} == {few: 16_000, many: 16_000}
    assert len(written[few].inputFiles()) == 4 * 8 and len(written[many].inputFiles()) < 2 * 100


def test_empty_versions_and_other_layouts(spark):
    rows = [("k", 1, "v", ["x"])]
    empty, full = saved(spark, []), saved(spark, rows)
    assert [tuple(r) for r in drilldown(spark, empty, full).collect()] == [("k", "added", 0, 1, "")]
    assert [tuple(r) for r in drilldown(spark, full, empty).collect()] == [("k", "removed", 1, 0, "")]
    assert drilldown(spark, empty, saved(spark, [])).count() == 0
    for other in (saved(spark, rows, 8), saved(spark, rows, keys=("k", "v")), saved(spark, [(1, 2)], schema="k int, v int")):
        with pytest.raises(ValueError, match="versions differ"):
            drilldown(spark, full, other)
    with pytest.raises(ValueError, match="buckets"):
        saved(spark, rows, 0)
