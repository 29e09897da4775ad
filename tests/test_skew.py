"""The same answers when one key holds a third of all rows and nothing is broadcast."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as contract
from oracle import compare, connect

SOURCE = "/root/testdata/sf0.001"
HOT = {
    "orders": "* REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 7 ELSE o_custkey END AS o_custkey)",
    "lineitem": """* REPLACE (
        CASE WHEN hash(l_orderkey, l_linenumber) % 3 = 0 THEN 11 ELSE l_partkey END AS l_partkey,
        CASE WHEN hash(l_linenumber, l_orderkey) % 3 = 0 THEN 3 ELSE l_suppkey END AS l_suppkey,
        CASE WHEN hash(l_partkey, l_suppkey) % 3 = 0 THEN 42 ELSE l_orderkey END AS l_orderkey)""",
    "events": """* REPLACE (
        CASE WHEN event_id % 3 = 0 THEN 'error' ELSE event_type END AS event_type,
        CASE WHEN event_id % 3 = 1 THEN 1 ELSE user_id END AS user_id)""",
}
CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}
NAMES = [
    "int_orders_enriched",
    "dim_customers",
    "mart_category_performance",
    "mart_seller_performance",
    "q2_state_ltv",
    "q3_category_revenue",
    "q4_rfm_rank_full",
    "q4_rfm_recency",
    "q5_semi_join_all",
    "q6_rolling_30_rows",
    "q7_string_ops",
    "q8_pivot",
    "q9_star_join_all",
    "q10_percentile_exact",
    "silver_keep_latest",
    "silver_upsert",
    "silver_table_diff",
    "dq_unique",
    "dq_relationships",
    "dq_staging_tests",
    "audit_status",
    "audit_throughput",
    "lag_sum",
    "test_history",
    "e2e_latency",
    "lineage_ancestors",
]


@pytest.fixture(scope="module")
def hot(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("hot")
    con = connect(SOURCE)
    for name in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"):
        columns = HOT.get(name, "*")
        con.execute(
            f"COPY (SELECT {columns} FROM {name}) TO '{folder}/{name}.parquet' (FORMAT parquet)"
        )
    before = {k: spark.conf.get(k, None) for k in CONF}
    for k, v in CONF.items():
        spark.conf.set(k, v)
    yield str(folder)
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("name", NAMES)
def test_hot_keys_change_no_answer(spark, hot, name):
    assert os.path.exists(f"{hot}/lineitem.parquet")
    query, sql = contract.queries()[name], contract.oracle_sql()[name]
    assert compare(query(spark, hot), sql, connect(hot)) > 0
