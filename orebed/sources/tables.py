"""Entity-shaped views over the star-schema test tables.

The order/customer/item tables of a TPC-H-like set are mapped to the entities of
the catalog, so every operator can run on any scale factor. All views are lazy
and prune to the columns a query needs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orebed.catalog import NUMERIC


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _text(c) -> Column:
    return F.col(c).cast("string")


def _cents(c) -> Column:
    return F.col(c).cast("decimal(12,2)")


def _rate(c) -> Column:
    return F.col(c).cast("decimal(4,2)")


def _places(spark, sf_dir) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey)


def order(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    shipped = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(F.min("l_shipdate").alias("first_ship"), F.max("l_shipdate").alias("last_ship"))
    )
    bought = F.col("o_orderdate").cast("timestamp")
    status = F.col("o_orderstatus")
    return orders.join(shipped, orders.o_orderkey == shipped.l_orderkey, "left").select(
        _text("o_orderkey").alias("order_id"),
        _text("o_custkey").alias("customer_id"),
        F.when(status == "F", "delivered")
        .when(status == "O", "processing")
        .otherwise("shipped")
        .alias("order_status"),
        bought.alias("order_purchase_timestamp"),
        F.when(F.col("o_orderpriority") != "5-LOW", bought).alias("order_approved_at"),
        F.col("first_ship").cast("timestamp").alias("order_delivered_carrier_date"),
        F.when(status == "F", F.col("last_ship").cast("timestamp")).alias(
            "order_delivered_customer_date"
        ),
        (bought + F.expr("INTERVAL '30' DAY")).alias("order_estimated_delivery_date"),
    )


def order_item(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        _text("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        _text("l_partkey").alias("product_id"),
        _text("l_suppkey").alias("seller_id"),
        F.col("l_shipdate").cast("date").alias("shipping_limit_date"),
        _cents("l_extendedprice").cast(NUMERIC).alias("price"),
        (_cents("l_extendedprice") * _rate("l_tax")).cast(NUMERIC).alias("freight_value"),
        F.col("l_quantity").alias("quantity"),
    )


def payment(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = F.col("l_returnflag")
    return table(spark, sf_dir, "lineitem").select(
        _text("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("payment_sequential"),
        F.when(flag == "A", "credit_card")
        .when(flag == "N", "boleto")
        .otherwise("voucher")
        .alias("payment_type"),
        F.col("l_quantity").cast("int").alias("payment_installments"),
        (_cents("l_extendedprice") * (F.lit(1) - _rate("l_discount")))
        .cast(NUMERIC)
        .alias("payment_value"),
    )


def review(spark: SparkSession, sf_dir: str) -> DataFrame:
    half = F.floor(F.col("event_id") / 2).cast("bigint").cast("string")
    return table(spark, sf_dir, "events").select(
        _text("event_id").alias("review_id"),
        half.alias("order_id"),
        (F.floor(F.col("value") / 100) + 1).cast("int").alias("review_score"),
        F.col("event_type").alias("review_comment_title"),
        F.col("props").alias("review_comment_message"),
        F.col("ts").cast("timestamp").alias("review_creation_date"),
        F.col("ts").cast("timestamp").alias("review_answer_timestamp"),
    )


def customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer")
    places = _places(spark, sf_dir)
    person = F.floor(F.col("c_custkey") / 2).cast("bigint").cast("string")
    return customers.join(places, customers.c_nationkey == places.n_nationkey).select(
        _text("c_custkey").alias("customer_id"),
        F.md5(F.concat(F.lit("u"), person)).alias("customer_unique_id"),
        F.lpad(_text("c_nationkey"), 5, "0").alias("customer_zip_code_prefix"),
        F.col("n_name").alias("customer_city"),
        F.col("r_name").alias("customer_state"),
    )


def product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        _text("p_partkey").alias("product_id"),
        F.when(F.col("p_brand") != "Brand#25", F.lower("p_type")).alias("product_category_name"),
        F.length("p_name").alias("product_name_length"),
        F.length("p_type").alias("product_description_length"),
        F.lit(1).alias("product_photos_qty"),
        F.col("p_size").cast(NUMERIC).alias("product_weight_g"),
        F.col("p_size").cast(NUMERIC).alias("product_length_cm"),
        F.col("p_size").cast(NUMERIC).alias("product_height_cm"),
        F.col("p_size").cast(NUMERIC).alias("product_width_cm"),
    )


def seller(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = table(spark, sf_dir, "supplier")
    places = _places(spark, sf_dir)
    return suppliers.join(places, suppliers.s_nationkey == places.n_nationkey).select(
        _text("s_suppkey").alias("seller_id"),
        F.lpad(_text("s_nationkey"), 5, "0").alias("seller_zip_code_prefix"),
        F.col("n_name").alias("seller_city"),
        F.col("r_name").alias("seller_state"),
    )


def product_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.lower("p_type")
    return (
        table(spark, sf_dir, "part")
        .select(name.alias("product_category_name"))
        .distinct()
        .select(
            "product_category_name",
            F.concat(F.lit("en_"), "product_category_name").alias("product_category_name_english"),
        )
    )


def geolocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("n_nationkey")
    return _places(spark, sf_dir).select(
        F.lpad(key.cast("string"), 5, "0").alias("geolocation_zip_code_prefix"),
        (key * 3 - 30).cast(NUMERIC).alias("geolocation_lat"),
        (key * 5 - 60).cast(NUMERIC).alias("geolocation_lng"),
        F.col("n_name").alias("geolocation_city"),
        F.col("r_name").alias("geolocation_state"),
    )


def audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("event_id")
    started = F.col("ts").cast("timestamp")
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("run-"), _text("user_id")).alias("run_id"),
        F.when(key % 3 == 0, "ingestion")
        .when(key % 3 == 1, "spark")
        .otherwise("dbt")
        .alias("pipeline_stage"),
        F.col("event_type").alias("entity_type"),
        F.floor("value").cast("bigint").alias("rows_processed"),
        F.when(key % 10 == 0, key % 7).otherwise(F.lit(0)).cast("bigint").alias("rows_failed"),
        started.alias("started_at"),
        F.timestamp_add("SECOND", (key % 600).cast("int"), started).alias("finished_at"),
        key.alias("event_id"),
    )


def lag_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("ts").cast("timestamp").alias("ts"),
        F.concat(F.lit("gcs-bronze-"), "event_type").alias("consumergroup"),
        F.col("event_type").alias("topic"),
        (F.col("user_id") % 4).cast("int").alias("partition"),
        F.floor(F.col("value") * 10).cast("bigint").alias("lag"),
    )


VIEWS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "order": order,
    "order_item": order_item,
    "payment": payment,
    "review": review,
    "customer": customer,
    "product": product,
    "seller": seller,
    "product_category": product_category,
    "geolocation": geolocation,
    "audit": audit,
    "lag": lag_sample,
}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return VIEWS[name](spark, sf_dir)


def staged(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    """A view with the staged column names."""
    df = view(spark, sf_dir, entity)
    return df.withColumnRenamed("order_item_id", "order_item_sequence")
