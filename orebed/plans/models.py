"""The model list: staging views, one inlined enrichment, Gold tables.

A model names the models it reads, so the same list drives the build, the run log
and the lineage edges.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orebed.catalog import (
    DIM_CUSTOMERS_CONTRACT,
    ENTITIES,
    FCT_ORDERS_CONTRACT,
    PII_COLUMNS,
    STAGED_METADATA,
)
from orebed.operators.contracts import enforce
from orebed.plans import gold
from orebed.plans.staging import stage
from orebed.sinks.audit import append_audit, audit_row


@dataclass(frozen=True)
class Model:
    """One model. ``columns`` names the input columns of each output column that is derived or
    renamed, as ``{output: ("input.column", ...)}``; all others keep the name they have in an input.
    Tables with the same ``bucket_by`` are written in as many buckets each, so that joins and
    groups on that key read them side by side, without a shuffle."""

    name: str
    inputs: tuple[str, ...]
    build: Callable[..., DataFrame]
    layer: str = "gold"
    kind: str = "table"  # table, view or inline
    contract: T.StructType | None = None
    columns: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    bucket_by: str | None = None


def _staging(name: str, entity: str) -> Model:
    source = f"silver.{entity}"
    fields = (*ENTITIES[entity].fields, *STAGED_METADATA)
    renamed = {f.name: (f"{source}.{f.source}",) for f in fields if f.name != f.source}
    return Model(name, (source,), lambda df: stage(df, entity), "staging", "view", columns=renamed)


def _dim_customers(customers: DataFrame, orders: DataFrame) -> DataFrame:
    return gold.dim_customers(customers, orders).select(*DIM_CUSTOMERS_CONTRACT.names)


# In dependency order. The customer dimension reads the order facts, which hold the
# whole enrichment, so that the enrichment is computed once per build.
MODELS: tuple[Model, ...] = (
    _staging("stg_orders", "order"),
    _staging("stg_order_items", "order_item"),
    _staging("stg_payments", "payment"),
    _staging("stg_reviews", "review"),
    _staging("stg_customers", "customer"),
    _staging("stg_products", "product"),
    _staging("stg_sellers", "seller"),
    _staging("stg_product_categories", "product_category"),
    _staging("stg_geolocation", "geolocation"),
    Model(
        "int_orders_enriched",
        ("stg_orders", "stg_customers", "stg_payments", "stg_reviews"),
        gold.orders_enriched,
        "intermediate",
        "inline",
        columns={
            "total_payment_sequences": ("stg_payments.payment_sequential",),
            "total_payment_value": ("stg_payments.payment_value",),
            "max_payment_installments": ("stg_payments.payment_installments",),
            "avg_review_score": ("stg_reviews.review_score",),
            "total_reviews": ("stg_reviews.review_id",),
            "delivery_time_days": (
                "stg_orders.order_delivered_customer_date",
                "stg_orders.order_purchase_timestamp",
            ),
            "delta_delivery_vs_estimated_days": (
                "stg_orders.order_delivered_customer_date",
                "stg_orders.order_estimated_delivery_date",
            ),
        },
    ),
    Model(
        "fct_orders",
        ("int_orders_enriched",),
        gold.fct_orders,
        contract=FCT_ORDERS_CONTRACT,
        bucket_by="order_id",
    ),
    Model(
        "dim_customers",
        ("stg_customers", "fct_orders"),
        _dim_customers,
        contract=DIM_CUSTOMERS_CONTRACT,
        columns={
            "total_orders": ("fct_orders.order_id",),
            "total_lifetime_value": ("fct_orders.total_payment_value",),
            "avg_lifetime_review_score": ("fct_orders.avg_review_score",),
        },
    ),
    Model("dim_products", ("stg_products",), gold.dim_products),
    Model("dim_sellers", ("stg_sellers",), gold.dim_sellers),
    Model(
        "fct_order_items",
        ("stg_order_items",),
        gold.fct_order_items,
        columns={
            "order_item_id": ("stg_order_items.order_item_sequence",),
            "total_item_value": ("stg_order_items.price", "stg_order_items.freight_value"),
        },
        bucket_by="order_id",
    ),
    Model(
        "mart_category_performance",
        ("dim_products", "fct_order_items"),
        gold.mart_category_performance,
        columns={
            "total_orders": ("fct_order_items.order_id",),
            "total_items_sold": ("fct_order_items.order_item_id",),
            "total_revenue": ("fct_order_items.price",),
            "average_item_price": ("fct_order_items.price",),
        },
    ),
    Model(
        "mart_seller_performance",
        ("dim_sellers", "fct_order_items"),
        gold.mart_seller_performance,
        columns={
            "total_orders_fulfilled": ("fct_order_items.order_id",),
            "total_items_sold": ("fct_order_items.order_item_id",),
            "total_revenue": ("fct_order_items.price",),
            "total_freight_value": ("fct_order_items.freight_value",),
            "average_item_price": ("fct_order_items.price",),
        },
    ),
)


def build(
    spark: SparkSession,
    sources: Mapping[str, DataFrame],
    target: str,
    run_id: str,
    audit: str | None = None,
    format: str = "parquet",
    database: str = "gold",
    buckets: int | None = None,
) -> dict[str, DataFrame]:
    """Materialise the models under ``target/{run_id}`` and return all of them by name.

    Tables are catalog tables ``{database}.{model}``; a later run points the name at its own
    folder, and readers that were planned before go on with theirs. Facts are written in
    ``buckets`` buckets of their order, by default as many as the session has shuffle
    partitions; choose so many that a bucket is about as large as a task should read.

    ``sources`` holds ``silver.{entity}`` frames, or staged frames under the names
    of staging models. Each table's contract is checked before it is written; the
    run log gets one row per model, with the error text if it failed. Tables with personal
    columns are also published, masked, as the view ``published_{table}``; consumers read
    that, and the frame is returned under the view's name.
    """
    built = dict(sources)
    log = []
    for model in MODELS:
        if model.name in built:
            continue
        started = datetime.now(timezone.utc)
        rows, error = 0, None
        try:
            df = model.build(*[built[i] for i in model.inputs])
            if model.contract is not None:
                enforce(df, model.contract, model.name)
            if model.kind == "table":
                path = f"{target.rstrip('/')}/{run_id}/{model.name}"
                counted = Observation()
                observed = df.observe(counted, F.count("*").alias("n"))
                save_table(observed, f"{database}.{model.name}", path, format, model.bucket_by, buckets)
                df = spark.table(f"{database}.{model.name}")
                rows = counted.get["n"]
                if model.name in PII_COLUMNS:
                    built[f"published_{model.name}"] = gold.publish(df, model.name)
                    built[f"published_{model.name}"].createOrReplaceTempView(f"published_{model.name}")
            elif model.kind == "view":
                df.createOrReplaceTempView(model.name)
            built[model.name] = df
        except Exception as problem:  # noqa: BLE001 - logged, then raised
            error = problem
        log.append(
            audit_row(
                run_id,
                "dbt",
                model.name,
                rows,
                0 if error is None else 1,
                started,
                datetime.now(timezone.utc),
                status="success" if error is None else "failed",
                error=None if error is None else str(error),
            )
        )
        if error is not None:
            if audit:
                append_audit(spark, log, audit)
            raise error
    if audit and log:
        append_audit(spark, log, audit)
    return built


def save_table(
    df: DataFrame,
    name: str,
    path: str,
    format: str = "parquet",
    bucket_by: str | None = None,
    buckets: int | None = None,
) -> None:
    """Replace a catalog table by the rows of ``df``, written to a folder of its own.

    With ``bucket_by`` every task writes one bucket, one file, sorted by that column. Formats that have a
    layout of their own are not bucketed.
    """
    spark = df.sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name.rpartition('.')[0] or 'default'}")
    if bucket_by and format in ("parquet", "orc"):
        n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        writer = df.repartition(n, bucket_by).write.bucketBy(n, bucket_by).sortBy(bucket_by)
    else:
        writer = df.write
    if format == "parquet":
        writer = writer.option("compression", "zstd")
    writer.mode("overwrite").format(format).option("path", path).saveAsTable(name)


def lineage_edges(spark: SparkSession, built: Mapping[str, DataFrame], run_id: str) -> DataFrame:
    """``(run_id, output, output_column, input, input_column)``: one row per input column of an
    output column, and one without columns per table-level edge."""
    rows = []
    for model in MODELS:
        for source in model.inputs:
            rows.append((run_id, model.name, None, source, None))
            if model.name not in built:
                continue
            present = set(built[source].columns) if source in built else set()
            for column in built[model.name].columns:
                if column in model.columns:
                    names = [c.rpartition(".") for c in model.columns[column]]
                    rows += [(run_id, model.name, column, source, c) for t, _, c in names if t == source]
                elif column in present:
                    rows.append((run_id, model.name, column, source, column))
    return spark.createDataFrame(
        rows, "run_id string, output string, output_column string, input string, input_column string"
    )
