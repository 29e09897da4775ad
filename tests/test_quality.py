"""Data tests and row contracts with known violations."""

from __future__ import annotations

import pytest

from orebed.catalog import ORDER_CONTRACT
from orebed.operators import contracts, governance, quality


@pytest.fixture(scope="module")
def orders(spark):
    return spark.createDataFrame(
        [("o1", "delivered"), ("o1", "lost"), ("o2", None), (None, "shipped"), (None, "lost")],
        "order_id string, order_status string",
    )


def test_unique_and_not_null(orders):
    assert [(r.order_id, r.n) for r in quality.unique(orders, "order_id").collect()] == [("o1", 2)]
    found = {r.column: r.failures for r in quality.not_null(orders, "order_id", "order_status").collect()}
    assert found == {"order_id": 2, "order_status": 1}


def test_accepted_values_and_relationships(spark, orders):
    found = quality.accepted_values(orders, "order_status", ["delivered", "shipped"]).collect()
    assert [(r.value, r.n) for r in found] == [("lost", 2)]
    child = spark.createDataFrame([("o1",), ("x",), ("x",), (None,)], "k string")
    orphans = quality.relationships(child, "k", orders, "order_id").collect()
    assert [(r.value, r.n) for r in orphans] == [("x", 2)]


def test_run_tests(spark, orders):
    items = spark.createDataFrame([("o1", 1), ("gone", 2)], "order_id string, order_item_sequence int")
    customers = orders.selectExpr("order_id AS customer_id")
    tables = {"stg_orders": orders.crossJoin(customers.limit(1)), "stg_order_items": items}
    found = {
        (r.table, r.test, r.column): (r.failures, r.status)
        for r in quality.run_tests(tables, quality.STAGING_TESTS).collect()
    }
    assert found["stg_orders", "unique", "order_id"] == (1, "fail")
    assert found["stg_orders", "not_null", "order_id"] == (2, "fail")
    assert found["stg_orders", "accepted_values", "order_status"] == (2, "fail")
    assert found["stg_order_items", "relationships", "order_id"] == (1, "fail")
    assert found["stg_order_items", "not_null", "order_item_sequence"] == (0, "pass")
    assert len(found) == 7


def test_number_of_declared_tests():
    def kinds(tests):
        return {k: sum(t.kind == k for t in tests) for k in sorted({t.kind for t in tests})}

    assert kinds(quality.STAGING_TESTS) == {
        "accepted_values": 2, "not_null": 14, "relationships": 3, "unique": 6
    }
    assert kinds(quality.GOLD_TESTS) == {"not_null": 11, "unique": 6}


def test_row_tests_of_a_table_share_one_pass(orders):
    plan = quality.not_null(orders, "order_id", "order_status")._jdf.queryExecution().toString()
    assert plan.split("Physical Plan")[1].count("Scan ExistingRDD") == 1


def test_table_diff_counts_copies(spark):
    left = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "x string")
    right = spark.createDataFrame([("a",), ("c",), (None,)], "x string")
    found = {r.x: r.surplus for r in quality.table_diff(left, right).collect()}
    assert found == {"a": 1, "b": 1, "c": -1}


def test_has_rows(orders):
    assert quality.has_rows(orders) and not quality.has_rows(orders.limit(0))


def test_contract(spark):
    names = [f.name for f in ORDER_CONTRACT.fields]
    good = ["o1", "c1", "delivered", "2024-01-01", None, "", None, "2024-01-09"]
    rows = [
        good,
        ["", None, *good[2:]],
        [*good[:2], "lost", "bad", "soon", *good[5:]],
    ]
    df = spark.createDataFrame([tuple(r) for r in rows], ", ".join(f"{n} string" for n in names))
    passed, rejected = contracts.split(contracts.check_rows(df, ORDER_CONTRACT))
    assert passed.count() == 1
    assert sorted(tuple(r.errors) for r in rejected.collect()) == [
        ("order_id: missing", "customer_id: missing"),
        (
            "order_status: value not accepted",
            "order_purchase_timestamp: not a timestamp",
            "order_approved_at: not a timestamp",
        ),
    ]
    lacking = contracts.check_rows(df.drop("customer_id").limit(1), ORDER_CONTRACT).first()
    assert lacking.errors == ["customer_id: missing"]


def test_pii_flags_drive_the_masks(spark):
    df = spark.createDataFrame([("o1", "customer", 5)], "order_id string, customer_id string, n int")
    tagged = governance.tag_contract(df, ORDER_CONTRACT)
    assert governance.personal_columns(tagged) == {"customer_id": "confidential"}
    rows = {(r.table, r.column): (r.pii, r.classification) for r in governance.catalogue(spark, {"t": tagged}).collect()}
    assert rows == {
        ("t", "order_id"): (False, None),
        ("t", "customer_id"): (True, "confidential"),
        ("t", "n"): (False, None),
    }
    masked = governance.mask_tagged(tagged).first()
    assert (masked.order_id, masked.customer_id, masked.n) == ("o1", "cust****-PII-MASKED-****", 5)
    assert governance.personal_columns(governance.tag_entity(df, "customer")) == {"customer_id": "confidential"}
