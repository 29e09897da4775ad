"""Roll-up states against the values they stand for, on skewed data."""

from __future__ import annotations

import glob
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from orebed.operators.rollup import ROWS, Rollup, beside_next, in_both, members_kept, read_members, read_states
from orebed.plans import rollups
from orebed.session import work_dir

ROLLUP = Rollup(("day", "g"), {"total": "v"}, {"ids": "id"}, {"values": "v"}, lg_entries=10, k=200)


@pytest.fixture(scope="module")
def rows(spark):
    """A group with half of the rows and far more ids than a sketch holds; null groups, ids and values."""
    return spark.range(120_000).select(
        (F.col("id") % 7).cast("int").alias("day"),
        F.when(F.col("id") % 2 == 0, "hot").when(F.col("id") % 50 != 1, F.concat(F.lit("g"), (F.col("id") % 5).cast("string"))).alias("g"),
        F.when(F.col("id") % 11 != 0, (F.col("id") * 7919) % 40_000).alias("id"),
        F.when(F.col("id") % 13 != 0, (F.col("id") * 104_729) % 5_003).alias("v"),
    ).cache()


def held(rows, found, quantiles):
    data = rows.toPandas()
    for r in found:
        own = data[data["g"].isna() if r["g"] is None else data["g"] == r["g"]]
        values = own["v"].dropna().to_numpy()
        exact = own["id"].nunique()
        assert r[ROWS] == len(own) and r["total"] == values.sum()
        limit = 0 if exact <= 2**ROLLUP.lg_entries else 4 * ROLLUP.distinct_error * exact
        assert abs(r["ids"] - exact) <= limit
        for alias, p in quantiles.items():
            below, upto = (values < r[alias]).mean(), (values <= r[alias]).mean()
            assert below - 2 * ROLLUP.rank_error <= p <= upto + 2 * ROLLUP.rank_error


def test_merged_states_stand_for_all_rows(rows):
    asked = {"p50": ("values", 0.5), "p99": ("values", 0.99)}
    merged = ROLLUP.merge(ROLLUP.states(rows), "g")
    found = ROLLUP.read(merged, asked).collect()
    assert len(found) == rows.select("g").distinct().count() > 3
    held(rows, found, {"p50": 0.5, "p99": 0.99})
    # In two steps: by day, then over the days.
    twice = ROLLUP.read(ROLLUP.merge(ROLLUP.merge(ROLLUP.states(rows), "g", "day"), "g"), asked).collect()
    held(rows, twice, {"p50": 0.5, "p99": 0.99})


def test_rows_are_not_shuffled(rows):
    plan = ROLLUP.states(rows)._jdf.queryExecution().executedPlan().toString()
    assert "partial_theta_sketch_agg" in plan and "partial_kll_sketch_agg_double" in plan
    assert plan.count("Exchange") == 1


def test_a_refresh_replaces_its_days_only(spark, rows):
    path = work_dir(spark, "states")
    ROLLUP.refresh(rows, path)
    kept = {f for day in (0, 1, 2, 4, 5, 6) for f in glob.glob(f"{path}/day={day}/*")}
    late = rows.where("day = 3").withColumn("v", F.lit(1).cast("bigint"))
    for _ in range(2):  # a refresh that failed is repeated
        ROLLUP.refresh(late, path)
    assert kept == {f for day in (0, 1, 2, 4, 5, 6) for f in glob.glob(f"{path}/day={day}/*")}
    totals = {r.day: r.total for r in ROLLUP.merge(read_states(spark, path), "day").collect()}
    before = {r.day: r.total for r in rows.groupBy("day").agg(F.sum("v").alias("total")).collect()}
    assert totals.pop(3) == late.count() and before.pop(3) != late.count()
    assert totals == before


def test_a_question_reads_its_days_and_columns(spark, rows):
    path = work_dir(spark, "states")
    ROLLUP.refresh(rows, path)
    asked = Rollup(("day", "g"), {"total": "v"})
    found = asked.read(asked.merge(read_states(spark, path).where("day = 2"), "g"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "(day#" in plan
    assert "ids:binary" not in plan and "values:binary" not in plan
    assert len(found.inputFiles()) <= len(glob.glob(f"{path}/*/*.parquet"))
    assert {r[ROWS] for r in found.collect()} == {r["count"] for r in rows.where("day = 2").groupBy("g").count().collect()}


def test_no_rows_and_nulls(spark):
    schema = "day int, g string, id bigint, v bigint"
    empty = spark.createDataFrame([], schema)
    asked = {"p50": ("values", 0.5)}
    row = ROLLUP.read(ROLLUP.merge(ROLLUP.states(empty)), asked).first()
    assert (row[ROWS], row["total"], row["ids"], row["p50"]) == (0, None, 0, None)
    nulls = spark.createDataFrame([(None, None, None, None)] * 3, schema)
    row = ROLLUP.read(ROLLUP.merge(ROLLUP.states(nulls), "g"), asked).first()
    assert (row["g"], row[ROWS], row["total"], row["ids"], row["p50"]) == (None, 3, None, 0, None)
    with pytest.raises(ValueError, match="clash"):
        Rollup(("day",), {"day": "v"})


def test_values_shared_by_neighbouring_days(spark):
    rng = np.random.default_rng(3)
    data = {(d, g): set(map(int, rng.integers(0, 300, 200))) for d in (1, 2, 4) for g in ("a", None)}
    rows = spark.createDataFrame([(d, g, i) for (d, g), ids in data.items() for i in ids], "day int, g string, id bigint")
    rollup = Rollup(("day", "g"), distinct={"ids": "id"})
    paired = beside_next(rollup.states(rows), "day", ["g"], F.col("day") - 1, "ids")
    found = {(r.day, r.g): r.n for r in paired.select("day", "g", in_both("ids", "ids_next").alias("n")).collect()}
    assert found == {(d, g): len(ids & data.get((d + 1, g), set())) for (d, g), ids in data.items()}


def test_members_are_counted_exactly_beyond_a_sketch(spark, rows):
    rollup, path = Rollup(("day", "g"), members={"ids": "id"}), work_dir(spark, "members")
    rollup.refresh(rows, path)
    rollup.refresh(rows.where("day >= 3"), path)
    members = read_members(spark, path, "ids")
    data = rows.toPandas()
    found = {(r.day, r.g): (r.ids, r.kept) for r in members_kept(members, "day", ["g"], "ids", F.col("day") - 1, "kept").collect()}
    own = {(d, None if g != g or g is None else g): set(x["id"].dropna()) for (d, g), x in data.groupby(["day", "g"], dropna=False)}
    assert max(map(len, own.values())) > 2**12
    assert found == {(d, g): (len(ids), len(ids & own.get((d + 1, g), set()))) for (d, g), ids in own.items()}
    # A day whose ids are gone keeps none of them.
    rollup.refresh(rows.where("day = 3").withColumn("id", F.lit(None).cast("bigint")), path)
    left = read_members(spark, path, "ids").groupBy("day").agg(F.count("ids").alias("n"))
    assert {r.day for r in left.collect() if not r.n} == {3}


def shuffle_files(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {n for i in range(found.size()) if (n := found.apply(i).getName()).startswith("shuffle_")}


def none_left(spark, before):
    until = time.time() + 20  # files are removed in the background
    while (left := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    return not left


def test_a_refresh_leaves_no_shuffle_files(spark, rows):
    rollup, before = Rollup(("day", "g"), {"total": "v"}, members={"ids": "id"}), shuffle_files(spark)
    rollup.refresh(rows, work_dir(spark, "states"))
    assert none_left(spark, before)
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_distinct_counts_of_null_groups_and_values_leave_no_shuffle_files(spark, rows):
    before = shuffle_files(spark)
    found = rollups.distinct_counts(rows, [F.col("g").alias("_g"), F.col("day").alias("_day")], {"_ids": "id", "_values": "v"})
    assert none_left(spark, before)
    assert found.columns == ["_g", "_day", "_ids", "_values"]
    own = rows.toPandas().groupby(["g", "day"], dropna=False)
    exact = {(None if g != g or g is None else g, d): (x["id"].nunique(), x["v"].nunique()) for (g, d), x in own}
    assert {(r[0], r[1]): (r[2], r[3]) for r in found.collect()} == exact


def test_customers_do_not_travel_with_items(spark):
    """An item's shuffles on product and seller carry no customer; each join keeps repeated and drops unknown keys."""
    orders = spark.createDataFrame([("o1", "c" * 32), ("o2", "c" * 32), ("o3", "d" * 32), ("o4", None)], "order_id string, customer_unique_id string")
    orders = orders.withColumn("order_purchase_timestamp", F.lit("1995-03-04").cast("timestamp"))
    customers = spark.createDataFrame([("c" * 32, "ASIA"), ("d" * 32, None)], "customer_unique_id string, customer_state string")
    items = spark.createDataFrame(
        [("o1", "p1", "s1", 1), ("o1", "p1", "s1", 1), ("o2", "p2", "s1", 2), ("o3", "p1", None, 3), ("o3", "p2", "s1", 4), ("o4", "p1", "s1", 5), ("o9", "p1", "s1", 6), ("o1", "p9", "s1", 7), (None, "p1", "s1", 8)],
        "order_id string, product_id string, seller_id string, price int",
    )
    products = spark.createDataFrame([("p1", "tools"), ("p2", None)], "product_id string, product_category_name string")
    sellers = spark.createDataFrame([("s1", "EUROPE")], "seller_id string, seller_state string")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        sales = rollups.monthly_items(orders, customers, items, products, sellers)
        found = sorted(map(repr, sales.select("order_id", "price", "customer_state", "product_category_name", "seller_state").collect()))
        joins = sales._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert [r.split("price=")[1].split(",")[0] for r in found] == ["1", "1", "2", "4"]
    # The customer is joined last, so above every join of items with products and sellers.
    assert joins.index("[order_id") < min(joins.index("[product_id"), joins.index("[seller_id"))
