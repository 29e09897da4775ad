"""Plans: what must hold at any scale is read off the physical plan."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from oracle import SF_DIR
from orebed.operators.envelope import parse, split
from orebed.plans import analytics, gold, models
from orebed.plans.lake import Lake
from orebed.plans.registry import CATEGORY, PIVOT, STAGED, STATES
from orebed.session import durable, work_dir


def text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return text(df)


@pytest.fixture
def large_tables(spark):
    """Join as at scale: nothing is broadcast, skew is split from small sizes on."""
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def hot_customer_orders(spark):
    """Half of all orders belong to one customer."""
    orders = Lake(spark, SF_DIR).view("order")
    hot = F.col("order_id").cast("int") % 2 == 0
    orders = orders.withColumn("customer_id", F.when(hot, "7").otherwise(F.col("customer_id")))
    # Splits are made of whole map outputs: a large table has many.
    return orders.repartition(16, "order_id")


def test_hot_customer_is_split_in_the_enrichment(spark, large_tables):
    lake = Lake(spark, SF_DIR)
    orders = durable(hot_customer_orders(spark))
    enriched = gold.orders_enriched(
        orders, lake.staged("customer"), lake.staged("payment"), lake.staged("review")
    )
    plan = final(enriched)
    assert "skew=true" in plan
    assert enriched.count() == orders.count()


def test_the_enrichment_is_written_in_order_buckets_without_another_shuffle(spark, large_tables):
    lake = Lake(spark, SF_DIR)
    enriched = gold.fct_orders(lake.enriched())
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert text(enriched).count("Exchange") == text(enriched.repartition(n, "order_id")).count("Exchange") > 0


def test_hot_customer_is_split_in_the_state_bridge(spark, large_tables):
    lake = Lake(spark, SF_DIR)
    orders = durable(
        hot_customer_orders(spark).select("order_id", F.col("customer_id").alias("customer_unique_id"))
    )
    people = lake.staged("customer").select(
        F.col("customer_id").alias("customer_unique_id"), "customer_state"
    )
    bridge = analytics._state_per_order(orders, people, "customer_unique_id")
    assert "skew=true" in final(bridge)


@pytest.mark.parametrize(
    "name", ["mart_category_performance", "mart_seller_performance", "q3_category_revenue", "q7_string_ops"]
)
def test_items_are_summed_before_they_are_shuffled(spark, large_tables, name):
    """Every exchange of item measures follows a partial aggregate, or feeds a join AQE can split."""
    plan = text(contract.queries()[name](spark, SF_DIR))
    assert "partial_sum" in plan or "partial_count" in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("name", sorted(n for n in contract.oracle_sql() if not n.startswith("stream_")))
def test_no_cross_joins(spark, name):
    plan = text(contract.queries()[name](spark, SF_DIR))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_only_needed_columns_are_scanned(spark):
    plan = text(contract.queries()["q3_category_revenue"](spark, SF_DIR))
    schemas = [line.split("ReadSchema: ")[1] for line in plan.splitlines() if "ReadSchema" in line]
    items = next(s for s in schemas if "l_partkey" in s)
    assert "l_tax" not in items and "l_shipdate" not in items


def test_filters_reach_the_scan(spark):
    plan = text(contract.queries()["audit_throughput_range"](spark, SF_DIR))
    assert "DataFilters: [" in plan and "ts" in plan.split("DataFilters: [")[1].split("]")[0]


def test_top_k_needs_no_global_sort(spark):
    plan = text(contract.queries()["q2_state_ltv"](spark, SF_DIR))
    assert "TakeOrderedAndProject" in plan


def test_messages_are_parsed_once(spark):
    good, _ = split(parse(spark.createDataFrame([("{}",)], "value string"), "seller"))
    assert text(good.select("payload.seller_id")).count("from_json") == 1


def test_shared_folder_comes_from_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert work_dir(spark, "x").startswith(root)
    assert durable(spark.range(3)).count() == 3


@pytest.fixture(scope="module")
def built(spark):
    lake = Lake(spark, SF_DIR)
    staged = {name: lake.staged(entity) for name, entity in STAGED.items()}
    return models.build(spark, staged, work_dir(spark, "gold"), "plans", database="plans", buckets=6)


def exchanges_of(plan: str, key: str) -> list[str]:
    return [line for line in plan.splitlines() if "Exchange hashpartitioning(" in line and key in line.split("hashpartitioning(")[1].split(")")[0]]


def test_facts_are_bucketed_tables_of_one_file_a_bucket(spark, built):
    for name in ("fct_orders", "fct_order_items"):
        about = {r.col_name.strip(): r.data_type for r in spark.sql(f"DESCRIBE EXTENDED plans.{name}").collect()}
        assert about["Num Buckets"] == "6" and about["Bucket Columns"] == "[`order_id`]"
        assert len(built[name].inputFiles()) == 6


@pytest.mark.parametrize("query", ["q5", "q8", "q9", "rows per order"])
def test_facts_meet_without_a_shuffle_on_the_order(built, large_tables, query):
    """Orders and items of one bucket are read by one task: no exchange on the order, on either side."""
    orders, items = built["fct_orders"], built["fct_order_items"]
    # Dimensions small enough for a broadcast; facts never are.
    people, products, sellers = (F.broadcast(built[t]) for t in ("dim_customers", "dim_products", "dim_sellers"))
    if query == "q5":
        df = analytics.orders_by_state_and_category(orders, people, items, products, STATES, CATEGORY)
    elif query == "q8":
        df = analytics.category_pivot(items, products, orders, people, PIVOT)
    elif query == "q9":
        df = analytics.star_join(orders, people, items, products, sellers)
    else:
        df = orders.join(items.groupBy("order_id").agg(F.sum("price")), "order_id", "left")
    plan = text(df)
    assert exchanges_of(plan, "order_id") == [] and plan.count("Bucketed: true") == 2
    assert ("Exchange" in plan) == (query != "rows per order") and df.count() > 0


def test_a_later_build_replaces_the_table_not_its_readers(spark):
    first, second = spark.range(5).toDF("order_id"), spark.range(3).toDF("order_id")
    models.save_table(first, "plans.swapped", work_dir(spark, "swap"), bucket_by="order_id", buckets=2)
    reader = spark.table("plans.swapped")
    assert reader.count() == 5
    models.save_table(second, "plans.swapped", work_dir(spark, "swap"), bucket_by="order_id", buckets=3)
    assert reader.count() == 5 and spark.table("plans.swapped").count() == 3
