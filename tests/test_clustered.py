"""Z-ordered tables: the rows asked for, from as few folders as the question allows."""

from __future__ import annotations

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from orebed.session import work_dir
from orebed.sinks.clustered import ZONE, Layout, read_clustered, write_clustered, zone_of

LAYOUT = Layout(ranges=("day", "amount"), lookups=("customer",), bits=2)
START = date(2020, 1, 1)


@pytest.fixture(scope="module")
def facts(spark):
    """A third of all rows belong to one customer, some days, amounts and customers are NULL."""
    i = F.col("id")
    df = spark.range(20_000).select(
        i.alias("id"),
        F.when(i % 50 != 0, F.date_add(F.lit(START), (i * 7919 % 1000).cast("int"))).alias("day"),
        F.when(i % 70 != 0, (i * 104729 % 9973).cast("decimal(12,2)")).alias("amount"),
        F.when(i % 3 == 0, "hot").when(i % 90 != 1, F.concat(F.lit("c"), i % 400)).alias("customer"),
    )
    write_clustered(df, "clustered.facts", work_dir(spark, "clustered"), LAYOUT)
    return df


def files_read(df) -> int:
    """Files that the scan of the facts opened, from the metrics of the plan that ran."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().finalPhysicalPlan().collectLeaves()
    scans = [leaves.apply(i) for i in range(leaves.size())]
    return sum(s.metrics().apply("numFiles").value() for s in scans if "rows" in s.toString() and s.nodeName().startswith("Scan"))


CASES = [
    ({"day": (START + timedelta(100), START + timedelta(160))}, {}, 0.6),
    ({"day": (START + timedelta(990), None)}, {}, 0.35),
    ({"amount": (None, 40)}, {}, 0.35),
    ({}, {"customer": ["c17"]}, 0.35),
    ({"day": (START, START + timedelta(30)), "amount": (9000, None)}, {"customer": ["c17", "hot"]}, 0.15),
    ({"day": (START + timedelta(5000), None)}, {}, 0.0),
    ({"id": (5, 9)}, {}, 1.0),
    ({}, {"day": [START + timedelta(3)], "id": [1, 2, 3]}, 0.35),
    ({}, {}, 1.0),
]


@pytest.mark.parametrize(("between", "equal", "share"), CASES)
def test_rows_and_files(spark, facts, between, equal, share):
    found = read_clustered(spark, "clustered.facts", LAYOUT, between, equal)
    expected = facts
    for c, (low, high) in between.items():
        expected = expected.where(F.col(c) >= low) if low is not None else expected
        expected = expected.where(F.col(c) <= high) if high is not None else expected
    for c, values in equal.items():
        expected = expected.where(F.col(c).isin(*values))
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, expected.collect())) if between or equal else found.count() == 20_000
    assert found.columns == facts.columns
    files = len(spark.table("clustered.facts").inputFiles())
    assert files_read(found) <= share * files


def test_a_hot_zone_is_written_by_several_tasks(spark):
    df = spark.range(30_000).select(F.lit(1).alias("k"), F.col("id").alias("v"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small partitions stay as they are
    try:
        write_clustered(df, "clustered.one", work_dir(spark, "clustered"), Layout(ranges=("k",), bits=1))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    table = spark.table("clustered.one")
    assert table.select(ZONE).distinct().count() == 1 and len(table.inputFiles()) > 1 and table.count() == 30_000


def test_zones_interleave_the_bits(spark):
    row = spark.range(1).select(zone_of([F.lit(0b10), F.lit(0b01)], 2).alias("z"), zone_of([F.lit(3), F.lit(0), F.lit(3)], 2).alias("y"))
    assert tuple(row.first()) == (0b1001, 0b101101)


def test_bounds_of_a_layout():
    for bad in (Layout, lambda: Layout(ranges=("a", "b", "c"), lookups=("d",), bits=4)):
        with pytest.raises(ValueError):
            bad()
    assert Layout(("a",), ("b",), 6).bins == 64


def test_empty_table(spark, facts):
    write_clustered(facts.limit(0), "clustered.empty", work_dir(spark, "clustered"), LAYOUT)
    found = read_clustered(spark, "clustered.empty", LAYOUT, {"day": (START, None)}, {"customer": ["hot"]})
    assert found.count() == 0 and found.columns == facts.columns


def test_few_zones_are_written_where_their_rows_lie(spark):
    """Every task writes its rows of each zone; of many zones, a task writes some whole ones."""
    df = spark.range(0, 16_000, 1, 4).select(F.col("id"), (F.col("id") * 7919 % 9973).alias("n"))
    files = {}
    for bits in (2, 4):
        path, name, layout = work_dir(spark, "few"), f"clustered.few_{bits}", Layout(ranges=("n",), lookups=("id",), bits=bits)
        write_clustered(df, name, path, layout)
        assert sorted(map(tuple, read_clustered(spark, name, layout).collect())) == sorted(map(tuple, df.collect()))
        files[bits] = spark.read.parquet(f"{path}/rows").inputFiles()
        assert all(f.endswith(".zstd.parquet") for f in files[bits])
    assert len(files[2]) == 4 * 16 and len(files[4]) < 2 * 256
