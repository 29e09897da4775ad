"""Gold models: one enrichment, facts, dimensions and marts.

Join sides are aggregated to one row per key before they are joined, so no join
fans out, and measures are summed on the fact key first, so a key that holds a
large part of all rows shrinks to one row per task before it is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orebed.operators.governance import mask_tagged, tag_table
from orebed.operators.latest import keep_latest
from orebed.sinks.clustered import Layout

# Column names of the published tables.
_PAYMENT_METRICS = ("total_payment_sequences", "total_payment_value", "max_payment_installments")
_REVIEW_METRICS = ("avg_review_score", "total_reviews")
_CUSTOMER_COLUMNS = ("customer_unique_id", "customer_city", "customer_state")
_ORDER_COLUMNS = (
    "order_id",
    "customer_id",
    "order_status",
    "order_purchase_timestamp",
    "order_approved_at",
    "order_delivered_carrier_date",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
)
FCT_ORDERS_COLUMNS = (
    "order_id",
    "customer_id",
    *_CUSTOMER_COLUMNS,
    *_ORDER_COLUMNS[2:],
    *_PAYMENT_METRICS,
    *_REVIEW_METRICS,
    "delivery_time_days",
    "delta_delivery_vs_estimated_days",
)


def payments_per_order(payments: DataFrame) -> DataFrame:
    return payments.groupBy("order_id").agg(
        F.countDistinct("payment_sequential").alias("total_payment_sequences"),
        F.sum("payment_value").alias("total_payment_value"),
        F.max("payment_installments").alias("max_payment_installments"),
    )


def reviews_per_order(reviews: DataFrame) -> DataFrame:
    return reviews.groupBy("order_id").agg(
        F.avg("review_score").alias("avg_review_score"),
        F.count("review_id").alias("total_reviews"),
    )


def orders_enriched(
    orders: DataFrame,
    customers: DataFrame,
    payments: DataFrame,
    reviews: DataFrame,
    columns: Iterable[str] | None = None,
) -> DataFrame:
    """Orders with customer, payment and review metrics and delivery durations.

    Payments and reviews hold one row per order, so a side none of whose columns
    is asked for is not joined at all: the result is the same without its shuffle.
    The join on the skewed ``customer_id`` comes first, over narrow rows, and AQE may
    split hot customers. The joins on ``order_id`` share one partitioning, which is that
    of the result, so a table in buckets of its orders is written without another shuffle.
    """
    wanted = tuple(columns or FCT_ORDERS_COLUMNS)
    joined = orders.select(*_ORDER_COLUMNS)
    joined = joined.join(customers.select("customer_id", *_CUSTOMER_COLUMNS), "customer_id", "left")
    if set(wanted) & set(_PAYMENT_METRICS):
        joined = joined.join(payments_per_order(payments), "order_id", "left")
    if set(wanted) & set(_REVIEW_METRICS):
        joined = joined.join(reviews_per_order(reviews), "order_id", "left")

    bought = F.col("order_purchase_timestamp")
    delivered = F.col("order_delivered_customer_date")
    derived: dict[str, Column] = {
        "total_payment_sequences": F.coalesce("total_payment_sequences", F.lit(0).cast("bigint")),
        "total_payment_value": F.coalesce("total_payment_value", F.lit(0).cast("decimal(38,9)")),
        "max_payment_installments": F.coalesce("max_payment_installments", F.lit(0)),
        "avg_review_score": F.coalesce("avg_review_score", F.lit(0.0)),
        "total_reviews": F.coalesce("total_reviews", F.lit(0).cast("bigint")),
        "delivery_time_days": F.datediff(delivered, bought),
        "delta_delivery_vs_estimated_days": F.datediff(
            delivered, F.col("order_estimated_delivery_date")
        ),
    }
    return joined.select(*[derived.get(c, F.col(c)).alias(c) for c in wanted])


def fct_orders(enriched: DataFrame) -> DataFrame:
    """One row per order, with raw keys; masks are applied on publishing."""
    return enriched.select(*FCT_ORDERS_COLUMNS)


def dim_customers(customers: DataFrame, enriched: DataFrame) -> DataFrame:
    """One row per person: the latest registration and lifetime metrics.

    ``avg_lifetime_review_score`` counts unreviewed orders as 0;
    ``avg_reviewed_score`` averages reviewed orders only.
    """
    order = [
        F.col(c).desc_nulls_last()
        for c in ("silver_loaded_at", "ingested_at", "customer_id")
        if c in customers.columns
    ]
    latest = keep_latest(customers, ["customer_unique_id"], order).select(*_CUSTOMER_COLUMNS)
    lifetime = enriched.groupBy("customer_unique_id").agg(
        F.countDistinct("order_id").alias("total_orders"),
        F.sum("total_payment_value").alias("total_lifetime_value"),
        F.avg("avg_review_score").alias("avg_lifetime_review_score"),
        F.avg(F.when(F.col("total_reviews") > 0, F.col("avg_review_score"))).alias(
            "avg_reviewed_score"
        ),
    )
    return latest.join(lifetime, "customer_unique_id", "left").select(
        *_CUSTOMER_COLUMNS,
        F.coalesce("total_orders", F.lit(0).cast("bigint")).alias("total_orders"),
        F.coalesce("total_lifetime_value", F.lit(0).cast("decimal(38,9)")).alias(
            "total_lifetime_value"
        ),
        F.coalesce("avg_lifetime_review_score", F.lit(0.0)).alias("avg_lifetime_review_score"),
        "avg_reviewed_score",
    )


def dim_products(products: DataFrame) -> DataFrame:
    return products.select(
        "product_id",
        "product_category_name",
        "product_weight_g",
        "product_length_cm",
        "product_height_cm",
        "product_width_cm",
    )


def dim_sellers(sellers: DataFrame) -> DataFrame:
    return sellers.select("seller_id", "seller_zip_code_prefix", "seller_city", "seller_state")


def fct_order_items(items: DataFrame) -> DataFrame:
    return items.select(
        "order_id",
        F.col("order_item_sequence").alias("order_item_id"),
        "product_id",
        "seller_id",
        "price",
        "freight_value",
        (F.col("price") + F.col("freight_value")).alias("total_item_value"),
    )


def _mean(total: str, count: str) -> Column:
    return F.when(F.col(count) > 0, F.col(total).cast("double") / F.col(count))


def mart_category_performance(products: DataFrame, items: DataFrame) -> DataFrame:
    """Sales per category; a category without sales keeps a row with zero counts.

    The facts are inner-joined and rolled up, then attached to the short list of
    categories. A left join from the dimension to raw facts would leave a hot
    product on one task, because an outer join cannot split its right side.
    """
    known = products.where(F.col("product_category_name").isNotNull())
    sales = (
        items.join(known.select("product_id", "product_category_name"), "product_id")
        .groupBy("product_category_name")
        .agg(
            F.countDistinct("order_id").alias("total_orders"),
            F.count("order_item_id").alias("total_items_sold"),
            F.sum("price").alias("total_revenue"),
            F.count("price").alias("_priced"),
        )
    )
    return (
        known.select("product_category_name")
        .distinct()
        .join(sales, "product_category_name", "left")
        .select(
            "product_category_name",
            F.coalesce("total_orders", F.lit(0).cast("bigint")).alias("total_orders"),
            F.coalesce("total_items_sold", F.lit(0).cast("bigint")).alias("total_items_sold"),
            "total_revenue",
            _mean("total_revenue", "_priced").alias("average_item_price"),
        )
    )


def mart_seller_performance(sellers: DataFrame, items: DataFrame) -> DataFrame:
    """Sales per seller; items are rolled up per seller before the join."""
    sales = items.groupBy("seller_id").agg(
        F.countDistinct("order_id").alias("total_orders_fulfilled"),
        F.count("order_item_id").alias("total_items_sold"),
        F.sum("price").alias("total_revenue"),
        F.sum("freight_value").alias("total_freight_value"),
        F.count("price").alias("_priced"),
    )
    zero = F.lit(0).cast("bigint")
    return (
        sellers.select("seller_id", "seller_city", "seller_state")
        .join(sales, "seller_id", "left")
        .select(
            "seller_id",
            "seller_city",
            "seller_state",
            F.coalesce("total_orders_fulfilled", zero).alias("total_orders_fulfilled"),
            F.coalesce("total_items_sold", zero).alias("total_items_sold"),
            "total_revenue",
            "total_freight_value",
            _mean("total_revenue", "_priced").alias("average_item_price"),
        )
    )


def sales_aggregate(events: DataFrame) -> DataFrame:
    """Total amount and number of transactions per product."""
    return events.groupBy("product_id").agg(
        F.sum("amount").alias("total_sales"), F.count("id").alias("transaction_count")
    )


def write_sales_aggregate(
    spark: SparkSession, source: str, target: str, format: str = "parquet"
) -> None:
    """Read typed events, replace the aggregate table."""
    totals = sales_aggregate(spark.read.format(format).load(source))
    totals.write.mode("overwrite").format(format).save(target)


def publish(df: DataFrame, table: str, mode: str = "prefix") -> DataFrame:
    """The table as consumers see it: every column flagged as personal is masked."""
    return mask_tagged(tag_table(df, table), mode)


#: How the item facts with their orders are laid out for questions about days, customers and products.
SALES_LAYOUT = Layout(ranges=("order_date",), lookups=("customer_unique_id", "product_id"))


def sales_facts(orders: DataFrame, items: DataFrame) -> DataFrame:
    """One row per item with the day and the customer of its order."""
    bought = orders.select(
        "order_id", "customer_unique_id", F.to_date("order_purchase_timestamp").alias("order_date"), "order_status"
    )
    return items.join(bought.hint("merge"), "order_id").select(
        "order_date",
        "customer_unique_id",
        "product_id",
        "seller_id",
        "order_id",
        "order_item_id",
        "order_status",
        "price",
        "freight_value",
    )
