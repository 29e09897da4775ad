"""Named queries over a test data folder."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orebed.catalog import ENTITIES, LEGACY_FIELD_MAP, ORDER_CONTRACT
from orebed.functions import (
    cents_to_dollars,
    checksum,
    clean_string,
    format_date,
    mask_pii,
    register_sql_functions,
    strip,
)
from orebed.operators import contracts, envelope, governance, observe, quality
from orebed.operators.envelope import parse as parse_stream
from orebed.operators.latest import keep_latest
from orebed.plans import analytics, gold
from orebed.plans.ingest import ingestion_summary
from orebed.plans.lake import Lake, comparable
from orebed.plans.silver import refine, silver_table
from orebed.plans.staging import stage
from orebed.session import durable, open_writers, tidy_shuffles, work_dir
from orebed.sinks.keyed import KeyedTable
from orebed.sources.bronze import read_bronze
from orebed.sources.csv import read_csv
from orebed.sources.silver import as_variant
from orebed.sources.texts import silver_text
from orebed.sources.topics import read_topics
from orebed.streaming.alerts import ALERT, TOTAL, append_stream, lag_alerts, lag_totals
from orebed.streaming.bronze import BACKFILL, land_bronze
from orebed.streaming.events import dedup_events, hourly_totals, publish_totals, read_totals
from orebed.streaming.silver import maintain_silver

Query = Callable[[Lake], DataFrame]
_QUERIES: dict[str, Query] = {}

# Parameters of the analytical queries on the test tables.
STATES = ("ASIA", "EUROPE", "AFRICA")
CATEGORY = "promo"
PIVOT = {f"revenue_{c}": c for c in ("promo", "small", "large", "economy")}
SEARCH = ("prom", "mall", "econ")


def register(name: str):
    def add(function: Query) -> Query:
        _QUERIES[name] = function
        return function

    return add


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from orebed.plans import runs  # noqa: F401, PLC0415 - registers the queries of whole runs

    def bind(function: Query):
        return lambda spark, sf_dir: comparable(function(Lake(spark, sf_dir)))

    return {name: bind(function) for name, function in _QUERIES.items()}


def _rounded(df: DataFrame, *columns: str, places: int = 9) -> DataFrame:
    return df.withColumns({c: F.round(c, places) for c in columns})


# Models


@register("int_orders_enriched")
def _(lake):
    return lake.enriched()


@register("fct_orders")
def _(lake):
    return gold.fct_orders(lake.enriched())


@register("fct_orders_masked")
def _(lake):
    return gold.publish(gold.fct_orders(lake.enriched()), "fct_orders")


@register("pii_mask_modes")
def _(lake):
    person = "customer_unique_id"
    return lake.staged("customer").select(
        "customer_id",
        mask_pii(person, "prefix").alias("by_prefix"),
        mask_pii(person, "sha256").alias("by_sha256"),
        mask_pii(person, "null").alias("by_null"),
        mask_pii(person, "none").alias("by_none"),
        mask_pii(F.length(person), "prefix", "int").alias("number_by_prefix"),
    )


@register("pii_catalogue")
def _(lake):
    """Every column of the published tables: its flags and how many values it holds."""
    tables = {
        "fct_orders": gold.fct_orders(lake.enriched()),
        "dim_customers": lake.dim_customers().drop("avg_reviewed_score"),
        "dim_products": lake.dim_products(),
        "dim_sellers": lake.dim_sellers(),
        "fct_order_items": lake.fct_order_items(),
    }
    counts = []
    for name, df in tables.items():
        counted = df.agg(*[F.count(c).alias(c) for c in df.columns])
        counts.append(counted.unpivot([], df.columns, "column", "filled").withColumn("table", F.lit(name)))
    flags = governance.catalogue(
        lake.spark, {n: governance.tag_table(df, n) for n, df in tables.items()}
    )
    return (
        reduce(DataFrame.unionByName, counts)
        .join(F.broadcast(flags), ["table", "column"])
        .select("table", "column", F.col("pii").cast("int").alias("pii"), "classification", "filled")
    )


@register("dim_customers")
def _(lake):
    return _rounded(lake.dim_customers(), "avg_lifetime_review_score", "avg_reviewed_score")


@register("dim_products")
def _(lake):
    return lake.dim_products()


@register("dim_sellers")
def _(lake):
    return lake.dim_sellers()


@register("fct_order_items")
def _(lake):
    return lake.fct_order_items()


@register("mart_category_performance")
def _(lake):
    return gold.mart_category_performance(lake.dim_products(), lake.fct_order_items())


@register("mart_seller_performance")
def _(lake):
    return gold.mart_seller_performance(lake.dim_sellers(), lake.fct_order_items())


@register("sales_aggregate")
def _(lake):
    sales = lake.raw("lineitem").select(
        F.col("l_orderkey").alias("id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("amount"),
    )
    return gold.sales_aggregate(sales)


# Analytical queries


@register("q1_full_scan")
def _(lake):
    return _rounded(
        analytics.full_scan(lake.fct_orders("total_payment_value", "delivery_time_days")), "avg_days"
    )


@register("q2_state_ltv")
def _(lake):
    return analytics.lifetime_value_by_state(lake.dim_customers())


@register("q2_state_ltv_all")
def _(lake):
    return analytics.lifetime_value_by_state(lake.dim_customers(), n=None)


@register("q3_category_revenue_all")
def _(lake):
    return analytics.revenue_by_category(lake.staged("order_item"), lake.staged("product"), n=None)


@register("q3_category_revenue")
def _(lake):
    return analytics.revenue_by_category(lake.staged("order_item"), lake.staged("product"))


def _spending(lake):
    return lake.fct_orders(
        "order_id", "customer_unique_id", "order_purchase_timestamp", "total_payment_value"
    )


@register("q4_rfm_rank")
def _(lake):
    return analytics.rfm_top(_spending(lake))


@register("q4_rfm_rank_full")
def _(lake):
    return analytics.rfm_all(_spending(lake))


@register("q4_rfm_recency")
def _(lake):
    return analytics.rfm_recency(_spending(lake))


_Q5 = ("order_id", "customer_id", "customer_unique_id", "total_payment_value", "order_status")


@register("q5_semi_join")
def _(lake):
    return analytics.orders_by_state_and_category(
        lake.fct_orders(*_Q5),
        lake.customer_places(),
        lake.staged("order_item"),
        lake.staged("product"),
        STATES,
        CATEGORY,
    )


@register("q5_semi_join_all")
def _(lake):
    return analytics.orders_by_state_and_category(
        lake.fct_orders(*_Q5),
        lake.customer_places(),
        lake.staged("order_item"),
        lake.staged("product"),
        STATES,
        CATEGORY,
        n=None,
    )


@register("q5_semi_join_compat")
def _(lake):
    """Masked order customers looked up among masked persons: matches by collision only."""
    orders = lake.fct_orders(*_Q5).withColumn("customer_id", mask_pii("customer_id"))
    people = gold.publish(lake.customer_places(), "dim_customers")
    chosen = people.where(F.col("customer_state").isin(*STATES)).select(
        F.col("customer_unique_id").alias("customer_id")
    )
    return (
        orders.join(chosen, "customer_id", "left_semi")
        .select("order_id", "customer_id", "total_payment_value", "order_status")
    )


@register("q6_rolling_30_rows")
def _(lake):
    return analytics.rolling_revenue(
        lake.fct_orders("order_purchase_timestamp", "total_payment_value"), rows=30
    )


@register("q6_rolling_30_days")
def _(lake):
    return analytics.rolling_revenue(
        lake.fct_orders("order_purchase_timestamp", "total_payment_value"), rows=None, days=30
    )


@register("q6_rolling_by_state")
def _(lake):
    """Whole series, one moving average per customer state."""
    orders = lake.fct_orders("order_purchase_timestamp", "total_payment_value", "customer_state")
    return analytics.rolling_revenue(orders, rows=30, n=None, by=["customer_state"])


@register("q7_string_ops")
def _(lake):
    return analytics.product_search(lake.staged("product"), lake.staged("order_item"), SEARCH)


@register("q7_string_ops_all")
def _(lake):
    return analytics.product_search(lake.staged("product"), lake.staged("order_item"), SEARCH, n=None)


@register("q8_pivot_all")
def _(lake):
    return analytics.category_pivot(
        lake.staged("order_item"),
        lake.staged("product"),
        lake.fct_orders("order_id", "customer_unique_id"),
        lake.customer_places(),
        PIVOT,
        n=None,
    )


@register("q8_pivot")
def _(lake):
    return analytics.category_pivot(
        lake.staged("order_item"),
        lake.staged("product"),
        lake.fct_orders("order_id", "customer_unique_id"),
        lake.customer_places(),
        PIVOT,
    )


@register("q9_star_join")
def _(lake):
    return analytics.star_join(
        lake.fct_orders("order_id", "customer_unique_id"),
        lake.customer_places(),
        lake.staged("order_item"),
        lake.staged("product"),
        lake.staged("seller"),
    )


@register("q9_star_join_all")
def _(lake):
    return analytics.star_join(
        lake.fct_orders("order_id", "customer_unique_id"),
        lake.customer_places(),
        lake.staged("order_item"),
        lake.staged("product"),
        lake.staged("seller"),
        n=None,
    )


_Q10 = ("customer_unique_id", "total_payment_value", "delivery_time_days")


@register("q10_percentile_exact")
def _(lake):
    result = analytics.percentiles_exact(lake.fct_orders(*_Q10), lake.customer_places())
    return _rounded(result, "median_payment", "p90_delivery_time", places=6)


@register("q10_percentile_exact_all")
def _(lake):
    result = analytics.percentiles_exact(lake.fct_orders(*_Q10), lake.customer_places(), n=None)
    return _rounded(result, "median_payment", "p90_delivery_time", places=6)


@register("q10_percentile_approx_all")
def _(lake):
    return analytics.percentiles_approximate(lake.fct_orders(*_Q10), lake.customer_places(), n=None)


@register("q10_percentile_approx")
def _(lake):
    return analytics.percentiles_approximate(lake.fct_orders(*_Q10), lake.customer_places())


# Staging


def _register_staging(name: str, entity: str) -> None:
    @register(name)
    def _(lake):
        return stage(silver_text(lake.spark, lake.sf_dir, entity), entity)


STAGED = {
    "stg_orders": "order",
    "stg_order_items": "order_item",
    "stg_payments": "payment",
    "stg_reviews": "review",
    "stg_customers": "customer",
    "stg_products": "product",
    "stg_sellers": "seller",
    "stg_product_categories": "product_category",
    "stg_geolocation": "geolocation",
}

for _name, _entity in STAGED.items():
    _register_staging(_name, _entity)


@register("stg_payments_variant")
def _(lake):
    """The same staging projection over one semi-structured column."""
    return stage(as_variant(silver_text(lake.spark, lake.sf_dir, "payment")), "payment")


# Silver


def _items_order(df):
    return [F.col("shipping_limit_date").desc(), *map(F.col, ("product_id", "seller_id", "price", "quantity"))]


@register("silver_keep_latest")
def _(lake):
    items = lake.view("order_item")
    return keep_latest(items, ["order_id", "order_item_id"], _items_order(items))


@register("silver_keep_latest_compat")
def _(lake):
    items = lake.view("order_item")
    return keep_latest(items, ["order_item_id"], _items_order(items))


@register("silver_upsert")
def _(lake):
    """Batches by shipping year over a table built from the first of them; one of them comes twice."""
    items = lake.view("order_item")
    keys = ["order_id", "order_item_id"]
    table = KeyedTable(lake.spark, work_dir(lake.spark, "upsert"), keys, _items_order)
    year = F.year("shipping_limit_date")
    table.rebuild(items.where(year % 3 == 0))
    for number in (1, 2, 1):
        table.upsert(items.where(year % 3 == number), "years", number)
    return table.read()


@register("silver_refine")
def _(lake):
    """Reviews from envelope text to typed Silver rows."""
    messages = _review_messages(lake)
    good, _ = envelope.split(envelope.parse(messages, "review"))
    flat = envelope.unpack(good.select("metadata", "payload"))
    return refine(flat, "review", loaded_at=F.lit("2024-02-01").cast("timestamp")).select(
        *ENTITIES["review"].columns, "entity_type", "checksum", "_silver_loaded_at"
    )


@register("silver_table_diff")
def _(lake):
    """What deduplication removed: rows whose number of copies changed."""
    items = lake.view("order_item")
    kept = keep_latest(items, ["order_id", "order_item_id"], _items_order(items))
    return quality.table_diff(items, kept)


@register("reconcile")
def _(lake):
    items = lake.view("order_item")
    kept = keep_latest(items, ["order_id", "order_item_id"], _items_order(items))
    return quality.reconcile(items, kept, "order_item_id")


# Envelopes


def _review_envelopes(lake):
    day = "yyyy-MM-dd HH:mm:ss"
    rows = lake.view("review").withColumn("_at", F.col("review_creation_date"))
    rows = rows.withColumns(
        {c: F.date_format(c, day) for c in ("review_creation_date", "review_answer_timestamp")}
    )
    return envelope.wrap(
        rows, "review", run_id="run-1", ingested_at=F.col("_at"), identity=["review_id"]
    )


def _review_messages(lake):
    enveloped = _review_envelopes(lake)
    return envelope.serialise(enveloped, envelope.message_key(enveloped, "review"))


@register("envelope_roundtrip")
def _(lake):
    """Wrapped, written as JSON, parsed and flattened again."""
    good, _ = envelope.split(envelope.parse(_review_messages(lake), "review"))
    return envelope.unpack(good.select("metadata", "payload"))


@register("envelope_unpack")
def _(lake):
    """Payload-only rows."""
    return envelope.unpack(_review_envelopes(lake).select("payload"))


@register("kafka_key")
def _(lake):
    items = lake.view("order_item").withColumn("price", F.col("price").cast("string"))
    enveloped = envelope.wrap(items, "order_item")
    return enveloped.select(
        "payload.order_id",
        "payload.order_item_id",
        envelope.message_key(enveloped, "order_item").alias("message_key"),
        envelope.message_key(enveloped, "order_item", compat=True).alias("compat_key"),
    )


@register("checksum")
def _(lake):
    return lake.view("customer").select("customer_id", checksum(ENTITIES["customer"].columns).alias("checksum"))


@register("checksum_verify")
def _(lake):
    """Payloads changed after the checksum was taken are found."""
    wrapped = envelope.wrap(lake.view("customer"), "customer")
    moved = F.when(F.col("payload.customer_state") == "ASIA", "EUROPE").otherwise(
        F.col("payload.customer_state")
    )
    changed = wrapped.withColumn("payload", F.col("payload").withField("customer_state", moved))
    return envelope.verify(changed).select(
        "payload.customer_id", "payload.customer_state", F.col("checksum_ok").cast("int")
    )


@register("field_mapping")
def _(lake):
    events = lake.raw("events").select(
        "user_id", F.col("value").alias("price"), F.col("ts").alias("timestamp"), "props"
    )
    return envelope.map_fields(events, LEGACY_FIELD_MAP)


@register("typed_event")
def _(lake):
    """Purchases carry their amount as text that does not parse for errors."""
    text = F.col("value").cast("decimal(12,2)").cast("string")
    events = lake.raw("events").select(
        F.col("event_id").cast("string").alias("id"),
        F.col("user_id").cast("string").alias("product_id"),
        F.when(F.col("event_type") == "error", "free").otherwise(text).alias("amount"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("created_at"),
        F.when(F.col("event_type") == "purchase", "PAID").alias("status"),
    )
    return envelope.typed_event(events).withColumn("is_valid", F.col("is_valid").cast("int"))


def _order_rows(lake):
    """Orders as text with broken rules: unknown status, missing customer, unreadable date."""
    orders = lake.view("order")
    day = F.date_format("order_purchase_timestamp", "yyyy-MM-dd HH:mm:ss")
    ends = F.substring("order_id", -1, 1)
    return orders.select(
        "order_id",
        F.when(ends != "3", F.col("customer_id")).alias("customer_id"),
        F.when(F.col("order_approved_at").isNull(), "lost").otherwise(F.col("order_status")).alias("order_status"),
        F.when(ends == "5", "yesterday").otherwise(day).alias("order_purchase_timestamp"),
        *[
            F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)
            for c in ENTITIES["order"].columns[4:]
        ],
    )


@register("contract_split")
def _(lake):
    checked = contracts.check_rows(_order_rows(lake), ORDER_CONTRACT)
    return checked.select(
        "order_id",
        F.when(F.size("errors") == 0, "pass").otherwise("reject").alias("outcome"),
        F.array_join("errors", "; ").alias("reason"),
    )


@register("dlq_split")
def _(lake):
    """Messages cut off in the middle go to the dead letters, whole ones are enveloped."""
    events = lake.raw("events")
    body = F.to_json(
        F.struct(
            F.struct(F.col("event_id").cast("string").alias("event_id")).alias("metadata"),
            F.struct("event_type", F.col("props").alias("props")).alias("payload"),
        )
    )
    cut = F.when(F.col("event_type") == "error", F.substr(body, F.lit(1), F.length(body) - 1))
    messages = events.select("event_id", F.coalesce(cut, body).alias("value"))
    return envelope.parse(messages).select(
        "event_id",
        F.when(F.col("error").isNull(), "bronze").otherwise("dead_letter").alias("sink"),
        F.col("payload").getItem("event_type").alias("event_type"),
    )


# Text and money functions


@register("clean_string")
def _(lake):
    """Message texts in four languages without special characters."""
    return lake.raw("conversations").select("conv_id", "turn", clean_string("text").alias("cleaned"))


@register("strip_values")
def _(lake):
    padded = F.concat(F.lit(" \t\n"), "text", F.lit("\r\n  "))
    return lake.raw("documents").select("doc_id", F.sha2(strip(padded), 256).alias("stripped"))


@register("format_date")
def _(lake):
    text = F.when(F.col("event_type") == "error", "soon").otherwise(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    )
    return lake.raw("events").select("event_id", format_date(text).alias("iso"))


@register("cents_to_dollars")
def _(lake):
    cents = F.col("l_extendedprice").cast("decimal(12,2)")
    return lake.raw("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", cents_to_dollars(cents).alias("dollars")
    )


@register("sql_functions")
def _(lake):
    """The same functions called from SQL."""
    register_sql_functions(lake.spark)
    return lake.raw("orders").selectExpr(
        "o_orderkey",
        "mask_pii(o_orderpriority) AS masked",
        "cents_to_dollars(CAST(CAST(o_totalprice AS DECIMAL(14,2)) AS STRING)) AS dollars",
        "safe_integer(substr(o_orderpriority, 1, 1)) AS priority",
        "safe_integer(o_orderstatus) AS not_a_number",
    )


@register("csv_scan")
def _(lake):
    """All texts written as CSV, with their line breaks and quotes, and scanned back."""
    path = work_dir(lake.spark, "csv") + ".csv"
    texts = lake.raw("conversations").select("conv_id", "turn", "role", "text")
    texts.write.option("header", True).option("escape", '"').csv(path)
    return read_csv(lake.spark, path).select(
        F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), "role",
        F.sha2("text", 256).alias("text_hash"), "_error",
    )


# Quality


@register("dq_unique")
def _(lake):
    return quality.unique(lake.view("order_item"), "order_id", "order_item_id")


@register("dq_not_null")
def _(lake):
    orders = lake.view("order")
    return quality.not_null(orders, *ENTITIES["order"].columns)


@register("dq_accepted_values")
def _(lake):
    return quality.accepted_values(lake.view("review"), "review_comment_title", ["view", "click", "purchase"])


@register("dq_relationships")
def _(lake):
    return quality.relationships(lake.view("order"), "order_id", lake.view("order_item"), "order_id")


@register("dq_staging_tests")
def _(lake):
    """All declared staging tests."""
    tables = {name: lake.staged(entity) for name, entity in STAGED.items()}
    return quality.run_tests(tables, quality.STAGING_TESTS)


@register("dq_gold_tests")
def _(lake):
    tables = {
        "fct_orders": lake.fct_orders("order_id", "customer_id"),
        "dim_customers": lake.customer_places(),
        "dim_products": lake.dim_products(),
        "dim_sellers": lake.dim_sellers(),
        "fct_order_items": lake.fct_order_items(),
        "mart_category_performance": gold.mart_category_performance(
            lake.dim_products(), lake.fct_order_items()
        ),
        "mart_seller_performance": gold.mart_seller_performance(
            lake.dim_sellers(), lake.fct_order_items()
        ),
    }
    return quality.run_tests(tables, quality.GOLD_TESTS)


# Observability


@register("audit_status")
def _(lake):
    return observe.run_totals(lake.view("audit"), "run_id", "pipeline_stage")


@register("audit_throughput")
def _(lake):
    return observe.throughput(lake.view("audit"))


@register("audit_throughput_range")
def _(lake):
    return observe.throughput(lake.view("audit"), "2024-01-10", "2024-01-20")


@register("audit_error_rate")
def _(lake):
    runs = lake.view("audit").withColumn("status", observe.run_status())
    return _rounded(observe.runs_by_status(runs, "pipeline_stage"), "share")


@register("audit_run_history")
def _(lake):
    runs = lake.view("audit").withColumn("status", observe.run_status())
    return observe.run_history(runs, "dbt")


@register("ingest_summary")
def _(lake):
    counts = lake.view("audit").where("pipeline_stage = 'ingestion'").select(
        F.col("entity_type").alias("file_name"),
        F.col("rows_processed").alias("produced"),
        F.col("rows_failed").alias("failed"),
    )
    return ingestion_summary(counts, "file_name")


def _hourly_lag(lake):
    return observe.lag_sum(lake.view("lag"), F.date_trunc("hour", "ts"))


@register("lag_sum")
def _(lake):
    return _hourly_lag(lake)


@register("lag_alert")
def _(lake):
    return observe.sustained_breach(
        _hourly_lag(lake), hold_seconds=3 * 3600, max_gap_seconds=3600
    )


def _daily(lake):
    return (
        lake.view("audit")
        .groupBy("entity_type", F.to_date("started_at").alias("day"))
        .agg(F.sum("rows_processed").alias("n"))
    )


@register("volume_anomaly")
def _(lake):
    """Volumes shifted far from zero: sums of squares would lose them."""
    shifted = _daily(lake).withColumn("n", F.col("n") + 10**12)
    return _rounded(observe.volume_anomalies(shifted, ["entity_type"]), "z_score", places=3)


@register("freshness")
def _(lake):
    found = observe.freshness(
        lake.view("audit"), "finished_at", "2024-01-31 07:00:00", 7 * 3600 + 300, "pipeline_stage", "entity_type"
    )
    return found.withColumn("is_fresh", F.col("is_fresh").cast("int"))


@register("schema_diff")
def _(lake):
    """Fields seen in every state of an order against those seen in any order, as kinds."""
    orders = _order_rows(lake)
    pairs = [x for c in orders.columns for x in (F.lit(c), F.col(c))]
    payloads = orders.select(F.col("order_status").alias("status"), F.create_map(*pairs).alias("payload"))
    # Orders are read for their fields once; what fits all of them follows from what fits each state.
    proofs = durable(observe.field_proofs(payloads, "payload", "status"))
    whole, fields = observe.kinds(proofs), observe.kinds(proofs, "status")
    states = [r.status for r in payloads.select("status").distinct().orderBy("status").collect()]
    changes = [
        observe.schema_changes(whole, fields.where(F.col("status") == s).drop("status")).withColumn("status", F.lit(s))
        for s in states
    ]
    return reduce(DataFrame.unionByName, changes)


@register("test_history")
def _(lake):
    results = lake.view("audit").select(
        F.concat_ws(".", "pipeline_stage", "entity_type").alias("test"),
        F.when(F.col("rows_failed") > 0, "fail").otherwise("pass").alias("status"),
        F.col("started_at").alias("run_at"),
    )
    return observe.result_history(results, ["test"])


@register("e2e_latency")
def _(lake):
    found = observe.end_to_end_latency(
        lake.view("audit"), "started_at", "finished_at", "entity_type"
    )
    return _rounded(found, "p50_seconds", "p95_seconds", places=6)


@register("lineage_ancestors")
def _(lake):
    """Per run: each stage's table of an entity reads the table of the stage before it."""
    done = lake.view("audit").select("run_id", "pipeline_stage", "entity_type").distinct()

    def edge(stage_name: str, reads: str):
        return done.where(F.col("pipeline_stage") == stage_name).select(
            "run_id",
            F.concat(F.lit(stage_name + "."), "entity_type").alias("output"),
            F.concat(F.lit(reads + "."), "entity_type").alias("input"),
        )

    edges = edge("dbt", "spark").unionByName(edge("spark", "ingestion")).unionByName(
        edge("ingestion", "file")
    )
    return observe.ancestors(edges, ["run_id"])


def _query_log(lake):
    events = lake.raw("events")
    return events.select(
        F.col("event_type").alias("query"),
        F.when(F.col("user_id") % 2 == 0, "A").otherwise("B").alias("platform"),
        F.when(F.col("event_id") % 2 == 0, "cold").otherwise("warm").alias("run"),
        F.col("value").cast("decimal(12,2)").alias("seconds"),
        (F.col("user_id") * 1_000_000).alias("bytes"),
        "event_id",
    )


@register("query_log_compare")
def _(lake):
    return _rounded(observe.compare_runs(_query_log(lake)), "cold_seconds", "warm_seconds")


@register("cost_estimate")
def _(lake):
    costs = observe.cost_estimate(_query_log(lake))
    return _rounded(
        costs.select("event_id", "scan_usd", "compute_usd", "scan_usd_per_million", "compute_usd_per_million"),
        "scan_usd",
        "compute_usd",
        "scan_usd_per_million",
        "compute_usd_per_million",
    )


SILVER_ORDER = ("order_id", "customer_id", "order_status", "order_purchase_timestamp", "ingested_at")


def run_silver(lake, stream, entity: str, table) -> str:
    """Maintain a Silver table until the stream is drained, with a checkpoint of its own."""
    offsets, quarantine = work_dir(lake.spark, "offsets"), work_dir(lake.spark, "quarantine")
    maintain_silver(stream, entity, table, offsets, quarantine).awaitTermination()
    return quarantine


# Streams: events and orders written as messages, read by a query that runs until nothing is left


#: Messages in a file of a folder stream, at most.
MESSAGES = 200_000
#: Files that a trigger takes of a stream that consumes its topics, at most: 16 million messages.
TRIGGER_FILES = 80


def _stream(lake, messages, files: int = 4, consume: bool = False):
    """Messages of a batch frame as a folder stream of two triggers, each of about half the files.

    ``files`` is the least number of files; none holds more than MESSAGES messages, since compressed
    files are not split. The text is neither shuffled nor sorted by topic.

    ``consume`` is for topics that one query reads once: a trigger takes TRIGGER_FILES files at most, and
    files are deleted when the trigger after theirs begins, so topics and what is made of them are never
    both on disk in full. These topics are Parquet, smaller than NDJSON.
    """
    source = work_dir(lake.spark, "topics")
    stamped = messages.withColumn("timestamp", F.lit("2024-02-01").cast("timestamp"))
    most = min(MESSAGES, max(1, -(-messages.count() // files)))
    form = "parquet" if consume else "json"
    # The fastest level is the smallest too: more effort finds chance matches among the digits of ids.
    packed = {"compression": "zstd", "parquet.compression.codec.zstd.level": 1} if consume else {"compression": "gzip"}
    with open_writers(lake.spark), tidy_shuffles(lake.spark):
        writer = stamped.write.partitionBy("topic").option("maxRecordsPerFile", most)
        writer.format(form).options(**packed).save(source)
    written = len(read_topics(lake.spark, source, format=form, streaming=False).inputFiles())
    half = max(1, -(-written // 2))
    if consume:
        return read_topics(
            lake.spark, source, format=form, maxFilesPerTrigger=min(half, TRIGGER_FILES), cleanSource="delete"
        )
    return read_topics(lake.spark, source, maxFilesPerTrigger=half)


def _mixed_messages(lake):
    """Review messages; those of one kind are cut off and cannot be read."""
    broken = F.col("value").contains('"review_comment_title":"error"')
    cut = F.substr("value", F.lit(1), F.length("value") - 1)
    return _review_messages(lake).withColumn("value", F.when(broken, cut).otherwise(F.col("value")))


def _land(lake):
    root, quarantine = work_dir(lake.spark, "bronze"), work_dir(lake.spark, "quarantine")
    query = land_bronze(
        _stream(lake, _mixed_messages(lake)),
        root,
        quarantine,
        work_dir(lake.spark, "offsets"),
        trigger=BACKFILL,
        compression="gzip",
    )
    query.awaitTermination()
    return root, quarantine


@register("stream_bronze")
def _(lake):
    """Landed Bronze read back."""
    root, _ = _land(lake)
    landed = read_bronze(lake.spark, root, "review")
    return landed.select("review_id", "order_id", "review_comment_message", "ingested_at", "checksum")


@register("stream_quarantine")
def _(lake):
    _, quarantine = _land(lake)
    kept = lake.spark.read.json(quarantine)
    return kept.select("key", "error")


@register("stream_dedup")
def _(lake):
    """Every message sent twice, kept once."""
    messages = _review_messages(lake)
    stream = parse_stream(_stream(lake, messages.unionByName(messages)))
    out = work_dir(lake.spark, "unique")
    query = (
        dedup_events(stream, "40 days")
        .select("key", "event_id")
        .writeStream.format("parquet")
        .option("checkpointLocation", work_dir(lake.spark, "offsets"))
        .trigger(**BACKFILL)
        .start(out)
    )
    query.awaitTermination()
    return lake.spark.read.parquet(out)


@register("stream_hourly_throughput")
def _(lake):
    source, out = work_dir(lake.spark, "audit"), work_dir(lake.spark, "totals")
    runs = lake.view("audit")
    runs.repartitionByRange(4, "finished_at").write.parquet(source)
    stream = lake.spark.readStream.schema(runs.schema).option("maxFilesPerTrigger", 2).parquet(source)
    query = publish_totals(
        hourly_totals(stream, delay="40 days"), out, work_dir(lake.spark, "offsets")
    )
    query.awaitTermination()
    return read_totals(lake.spark, out)


@register("stream_silver")
def _(lake):
    """Two states of every order in one topic, and another topic beside it; the later ingest stays."""
    orders = _order_rows(lake)
    old = orders.withColumn("order_status", F.lit("created"))

    def messages(df, day: str):
        enveloped = envelope.wrap(df, "order", ingested_at=F.lit(day).cast("timestamp"))
        return envelope.serialise(enveloped, envelope.message_key(enveloped, "order"))

    both = messages(orders, "2024-01-02").unionByName(messages(old, "2024-01-01"))
    both = both.unionByName(_review_messages(lake))
    table = silver_table(lake.spark, work_dir(lake.spark, "silver"), "order")
    run_silver(lake, _stream(lake, both), "order", table)
    return table.read().select(*SILVER_ORDER)


@register("stream_lag_alert")
def _(lake):
    """Alerts raised while hourly lag is high: one stream closes the totals, one watches them."""
    source, totals, out = (work_dir(lake.spark, p) for p in ("lag", "totals", "alerts"))
    samples = lake.view("lag")
    samples.repartitionByRange(4, "ts").write.parquet(source)
    stream = lake.spark.readStream.schema(samples.schema).parquet(source)
    closed = lag_totals(stream, delay="1 hour", bucket="1 hour")
    append_stream(closed, totals, work_dir(lake.spark, "offsets")).awaitTermination()
    watched = lag_alerts(
        lake.spark.readStream.schema(TOTAL).parquet(totals),
        hold_seconds=3 * 3600,
        max_gap_seconds=3600,
    )
    append_stream(watched, out, work_dir(lake.spark, "offsets")).awaitTermination()
    return lake.spark.read.schema(ALERT).parquet(out)
