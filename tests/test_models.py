"""Gold rules on hand-written rows, the model build, contracts and lineage edges."""

from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from orebed.catalog import ENTITIES, FCT_ORDERS_CONTRACT, STAGED_METADATA
from orebed.operators.contracts import ContractError, enforce, schema_violations
from orebed.plans import analytics, gold, models
from orebed.plans.staging import stage
from orebed.sinks.audit import read_audit
from orebed.sources.silver import as_variant, create_external_tables, create_views, read_table

META = ["e", "2024-01-01", "1.0.0", "2024-02-01"]
SILVER = {
    "order": [
        ["o1", "c1", "delivered", "2024-01-01 23:59:00", "", None, "2024-01-02 00:01:00", "2024-01-05"],
        ["o2", "c2", "shipped", "2024-01-03 00:00:00", "x", None, None, "2024-01-05"],
        ["o3", "gone", "created", "2024-01-04 00:00:00", "", None, None, "2024-01-05"],
    ],
    "order_item": [
        ["o1", "1", "p1", "s1", "2024-01-02", "10.5", "1.25"],
        ["o1", "2", "p1", "s1", "2024-01-02", "bad", "2"],
        ["o2", "1", "p2", "s1", "2024-01-02", "3", "1"],
    ],
    "payment": [
        ["o1", "1", "voucher", "1", "4.5"],
        ["o1", "2", "credit_card", "3", "7.25"],
        ["o1", "2", "credit_card", "2", "1"],
    ],
    "review": [
        ["r1", "o1", "5", "", "", "2024-01-03", "2024-01-03"],
        ["r2", "o1", "2", "", "", "2024-01-03", "2024-01-03"],
    ],
    "customer": [
        ["c1", "u1", "00001", "rio", "RJ"],
        ["c2", "u1", "00002", "sampa", "SP"],
        ["c9", "u9", "00003", "bh", "MG"],
    ],
    "product": [
        ["p1", "toys", "1", "1", "1", "100", "1", "1", "1"],
        ["p2", None, "1", "1", "1", "100", "1", "1", "1"],
        ["p3", "books", "1", "1", "1", "100", "1", "1", "1"],
    ],
    "product_category": [["toys", "toys_en"], ["books", "books_en"]],
    "seller": [["s1", "00001", "rio", "RJ"], ["s2", "00002", "sampa", "SP"]],
    "geolocation": [["00001", "-22.9", "-43.2", "rio", "RJ"]],
}


@pytest.fixture(scope="module")
def silver(spark):
    return {
        f"silver.{entity}": spark.createDataFrame(
            [(*row, *META) for row in rows],
            ", ".join(
                f"{c} string"
                for c in [*ENTITIES[entity].columns, *[f.source for f in STAGED_METADATA]]
            ),
        )
        for entity, rows in SILVER.items()
    }


@pytest.fixture(scope="module")
def built(spark, silver, tmp_path_factory):
    root = tmp_path_factory.mktemp("gold")
    return models.build(spark, silver, str(root / "tables"), "run-1", str(root / "audit")), root


def rows_of(df, key):
    return {r[key]: r for r in df.collect()}


def test_orders(built):
    orders = rows_of(built[0]["fct_orders"], "order_id")
    first, second, third = orders["o1"], orders["o2"], orders["o3"]
    assert first.total_payment_sequences == 2
    assert first.total_payment_value == Decimal("12.75")
    assert first.max_payment_installments == 3
    assert (first.avg_review_score, first.total_reviews) == (3.5, 2)
    # Two minutes over midnight are one calendar day.
    assert (first.delivery_time_days, first.delta_delivery_vs_estimated_days) == (1, -3)
    assert second.total_payment_value == 0 and second.avg_review_score == 0
    assert second.delivery_time_days is None and second.order_approved_at is None
    assert third.customer_unique_id is None


def test_customers(built):
    people = rows_of(built[0]["dim_customers"], "customer_unique_id")
    # The later registration decides the place, unreviewed orders pull the score down.
    assert people["u1"].customer_state == "SP" and people["u1"].total_orders == 2
    assert people["u1"].avg_lifetime_review_score == 1.75
    assert people["u9"].total_orders == 0 and people["u9"].total_lifetime_value == 0


def test_reviewed_score_ignores_unreviewed_orders(built):
    people = rows_of(gold.dim_customers(built[0]["stg_customers"], built[0]["fct_orders"]), "customer_unique_id")
    assert people["u1"].avg_reviewed_score == 3.5 and people["u9"].avg_reviewed_score is None


def test_marts(built):
    categories = rows_of(built[0]["mart_category_performance"], "product_category_name")
    assert set(categories) == {"toys", "books"}
    assert categories["toys"].total_items_sold == 2 and categories["toys"].total_orders == 1
    assert categories["toys"].total_revenue == Decimal("10.5")
    assert categories["toys"].average_item_price == 10.5
    assert categories["books"].total_items_sold == 0 and categories["books"].total_revenue is None
    sellers = rows_of(built[0]["mart_seller_performance"], "seller_id")
    assert sellers["s1"].total_orders_fulfilled == 2
    assert sellers["s1"].total_freight_value == Decimal("4.25")
    assert sellers["s2"].total_items_sold == 0
    items = built[0]["fct_order_items"].where("order_id = 'o1' AND order_item_id = 1").first()
    assert items.total_item_value == Decimal("11.75")


def test_run_log_has_a_row_per_model(spark, built):
    log = rows_of(read_audit(spark, str(built[1] / "audit")), "entity_type")
    assert set(log) == {m.name for m in models.MODELS}
    assert log["fct_orders"].rows_processed == 3 and log["fct_orders"].status == "success"


def test_a_failing_model_is_logged_and_raised(spark, silver, tmp_path):
    broken = {**silver, "silver.seller": spark.createDataFrame([(1,)], "seller_id int")}
    broken["stg_sellers"] = broken.pop("silver.seller")
    with pytest.raises(Exception, match="seller_zip_code_prefix"):
        models.build(spark, broken, str(tmp_path / "t"), "run-2", str(tmp_path / "audit"))
    log = rows_of(read_audit(spark, str(tmp_path / "audit")), "entity_type")
    assert log["dim_sellers"].status == "failed" and log["dim_sellers"].error_message


def test_contract_differences_are_listed(built):
    orders = built[0]["fct_orders"]
    assert schema_violations(orders, FCT_ORDERS_CONTRACT) == []
    changed = orders.drop("order_status").withColumn("extra", F.lit(1)).withColumn(
        "total_reviews", F.col("total_reviews").cast("int")
    )
    with pytest.raises(ContractError) as error:
        enforce(changed, FCT_ORDERS_CONTRACT, "fct_orders")
    for text in ("missing column order_status", "unexpected column extra", "total_reviews is int"):
        assert text in str(error.value)


def test_lineage_edges(spark, built):
    rows = models.lineage_edges(spark, built[0], "r").collect()
    edges = {(r.output, r.output_column, r.input, r.input_column) for r in rows}
    assert len(edges) == len(rows)
    assert ("dim_customers", None, "fct_orders", None) in edges
    assert ("dim_customers", "customer_unique_id", "fct_orders", "customer_unique_id") in edges
    assert ("stg_sellers", "seller_id", "silver.seller", "seller_id") in edges
    assert ("stg_order_items", "order_item_sequence", "silver.order_item", "order_item_id") in edges
    assert ("fct_order_items", "order_item_id", "stg_order_items", "order_item_sequence") in edges
    assert {e[3] for e in edges if e[:2] == ("fct_order_items", "total_item_value")} == {"price", "freight_value"}
    assert ("mart_seller_performance", "total_revenue", "fct_order_items", "price") in edges
    assert ("int_orders_enriched", "total_reviews", "stg_reviews", "review_id") in edges


def test_build_publishes_masked_tables(spark, built):
    row = spark.table("published_fct_orders").where("order_id = 'o1'").first()
    assert row.customer_id == "c1****-PII-MASKED-****" and "published_dim_customers" in built[0]


def test_publish_masks_personal_columns_only(built):
    row = gold.publish(built[0]["fct_orders"], "fct_orders").where("order_id = 'o1'").first()
    assert row.customer_id == "c1****-PII-MASKED-****" and row.customer_city == "rio"
    joined = gold.publish(built[0]["fct_orders"], "fct_orders", "sha256").join(
        gold.publish(built[0]["dim_customers"], "dim_customers", "sha256"), "customer_unique_id"
    )
    assert joined.count() == 2


def test_asking_for_fewer_columns_skips_joins(built):
    tables = built[0]
    args = [tables[t] for t in ("stg_orders", "stg_customers", "stg_payments", "stg_reviews")]
    few = gold.orders_enriched(*args, columns=["order_id", "customer_state"])
    plan = few._jdf.queryExecution().optimizedPlan().toString()
    assert "payment" not in plan and "review" not in plan
    assert sorted(few.collect()) == sorted(
        gold.orders_enriched(*args).select("order_id", "customer_state").collect()
    )


def test_variant_source_equals_flat_source(silver):
    for entity in ("payment", "order_item", "seller"):
        flat = stage(silver[f"silver.{entity}"], entity)
        variant = stage(as_variant(silver[f"silver.{entity}"]), entity)
        assert flat.exceptAll(variant).isEmpty() and flat.schema == variant.schema


def test_columns_a_source_lacks_become_null(silver):
    row = stage(silver["silver.seller"].drop("seller_city"), "seller").first()
    assert row.seller_city is None and row.seller_state is not None


def test_catalog(spark, silver, tmp_path):
    path = str(tmp_path / "seller")
    silver["silver.seller"].write.parquet(path)
    assert read_table(spark, path).count() == 2
    names = create_external_tables(spark, {"seller": path})
    assert spark.table(names[0]).count() == 2
    spark.sql("DROP DATABASE silver CASCADE")
    create_views({"seller": silver["silver.seller"]})
    assert spark.table("silver_seller").count() == 2
    with pytest.raises(ValueError):
        create_external_tables(spark, {}, "platinum")


def test_sales_aggregate(spark):
    df = spark.createDataFrame(
        [("1", "p", 1.5), ("2", "p", 2.0), (None, "q", None)], "id string, product_id string, amount double"
    )
    found = rows_of(gold.sales_aggregate(df), "product_id")
    assert (found["p"].total_sales, found["p"].transaction_count) == (3.5, 2)
    assert (found["q"].total_sales, found["q"].transaction_count) == (None, 0)


def test_sales_aggregate_job(spark, tmp_path):
    source, target = str(tmp_path / "events"), str(tmp_path / "sales")
    spark.sql("SELECT '1' id, 'p' product_id, 2.5D amount").write.parquet(source)
    for _ in range(2):
        gold.write_sales_aggregate(spark, source, target)
    assert spark.read.parquet(target).collect()[0].total_sales == 2.5


def test_literal_predicate_of_the_compat_mode(built):
    """Comparing the order's customer id with the person id finds nothing without a mask."""
    tables = built[0]
    found = analytics.orders_by_state_and_category(
        tables["fct_orders"], tables["dim_customers"], tables["stg_order_items"],
        tables["stg_products"], ["SP"], "toys", key="customer_id",
    )
    assert found.count() == 0
    person = analytics.orders_by_state_and_category(
        tables["fct_orders"], tables["dim_customers"], tables["stg_order_items"],
        tables["stg_products"], ["SP"], "toys",
    )
    assert [r.order_id for r in person.collect()] == ["o1"]
