"""Named queries of whole runs: each writes, acts and reads back what it did."""

from __future__ import annotations

from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orebed.catalog import ENTITIES, FCT_ORDERS_CONTRACT, ORDER_CONTRACT
from orebed.operators import contracts, envelope, observe
from orebed.operators.latest import keep_latest
from orebed.operators.rollup import read_members, read_states
from orebed.operators.versions import drilldown, save_version
from orebed.plans import gold, models, rollups, silver
from orebed.plans.ingest import accept
from orebed.plans.registry import (
    MESSAGES,
    SILVER_ORDER,
    STAGED,
    _items_order,
    _land,
    _mixed_messages,
    _order_rows,
    _review_envelopes,
    _review_messages,
    _stream,
    register,
    run_silver,
)
from orebed.session import durable, open_writers, tidy_shuffles, work_dir
from orebed.sinks import clustered
from orebed.sinks.audit import append_audit, audit_row, read_audit
from orebed.sinks.topics import write_topics
from orebed.sources.bronze import read_bronze
from orebed.sources.csv import FILE, read_csv, route_files, row_count, row_numbers
from orebed.sources.silver import create_external_tables, read_table
from orebed.sources.texts import silver_text
from orebed.sources.topics import read_topics
from orebed.streaming.bronze import BACKFILL, land_bronze, write_batch


def _csv(df: DataFrame, path: str) -> None:
    df.write.option("header", True).option("escape", '"').csv(path)


def _part_files(df: DataFrame, path: str) -> None:
    """CSV of several part files: large enough to be split, small enough to be quick."""
    _csv(df.repartition(3), path)


# Sources


@register("csv_row_count")
def _(lake):
    """Records, not lines: the texts hold line breaks."""
    path = work_dir(lake.spark, "count") + ".csv"
    _csv(lake.raw("conversations").select("conv_id", "text"), path)
    return lake.spark.range(1).select(F.lit(row_count(lake.spark, path)).cast("bigint").alias("n"))


@register("csv_routes")
def _(lake):
    """A folder of three datasets: two registered names and one unknown, with their rows."""
    root = work_dir(lake.spark, "routes")
    for entity, name in (("customer", None), ("seller", None), ("geolocation", "unknown.csv")):
        _part_files(lake.view(entity), f"{root}/{name or ENTITIES[entity].csv_file}")
    routed = route_files(lake.spark, root)
    counts = [
        read_csv(lake.spark, r.path, multiline=False).agg(F.count("*").alias("n")).withColumn("file_name", F.lit(r.file_name))
        for r in routed.select("path", "file_name").collect()
    ]
    return routed.join(reduce(DataFrame.unionByName, counts), "file_name").select("file_name", "topic", "entity_type", "n")


@register("ingest_event_ids")
def _(lake):
    """Event ids of the same files read in one piece each and in many: rows, ids, ids in common."""
    path = f"{work_dir(lake.spark, 'ids')}/{ENTITIES['customer'].csv_file}"
    _part_files(lake.view("customer"), path)
    found = []
    setting = "spark.sql.files.maxPartitionBytes"
    before = lake.spark.conf.get(setting)
    for i, size in enumerate(("64m", "8k")):
        lake.spark.conf.set(setting, size)
        try:
            target = work_dir(lake.spark, "landed")
            read_csv(lake.spark, path, multiline=False).write.parquet(target)
        finally:
            lake.spark.conf.set(setting, before)
        landed = lake.spark.read.parquet(target)
        rows = row_numbers(landed, landed).withColumn("_name", F.element_at(F.split(FILE, "/"), -1))
        ids = envelope.wrap(rows, "customer", identity=("_name", "row_num"))
        found.append(ids.select("metadata.event_id", F.lit(i).alias("i")))
    per_id = found[0].unionByName(found[1]).groupBy("event_id").agg(F.countDistinct("i").alias("reads"), F.count("*").alias("n"))
    return per_id.agg(
        F.floor(F.sum("n") / 2).alias("n"), F.count("*").alias("ids"), F.count_if(F.col("reads") == 2).alias("same")
    )


@register("silver_catalog")
def _(lake):
    """A Silver table read by its catalog name."""
    path = work_dir(lake.spark, "seller")
    lake.view("seller").write.parquet(path)
    create_external_tables(lake.spark, {"seller": path})
    return lake.spark.table("silver.seller")


@register("bronze_since")
def _(lake):
    """Landed Bronze from one day on; the folders of earlier days are not read."""
    root, _ = _land(lake)
    landed = read_bronze(lake.spark, root, "review", since=date(2024, 1, 5))
    return landed.select("review_id", "order_id", "review_comment_message", "ingested_at", "checksum")


# Sinks


@register("sales_aggregate_table")
def _(lake):
    events, table = work_dir(lake.spark, "events"), work_dir(lake.spark, "sales")
    lake.raw("lineitem").select(
        F.col("l_orderkey").alias("id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("amount"),
    ).write.parquet(events)
    gold.write_sales_aggregate(lake.spark, events, table)
    return read_table(lake.spark, table)


@register("topic_sink")
def _(lake):
    target = work_dir(lake.spark, "sink")
    stamp = F.lit("2024-02-01").cast("timestamp").alias("timestamp")
    write_topics(_review_messages(lake).select("*", stamp), target)
    sent = envelope.parse(read_topics(lake.spark, target, streaming=False), "review")
    return sent.select("topic", "key", "metadata.event_id")


def _letters(lake, letters: DataFrame) -> DataFrame:
    """Dead letters written to their topic and read back."""
    target = work_dir(lake.spark, "letters")
    stamp = F.lit("2024-02-01").cast("timestamp").alias("timestamp")
    write_topics(letters.select(F.lit("ecommerce.dlq.v1").alias("topic"), "key", "value", stamp), target)
    return read_topics(lake.spark, target, ["ecommerce.dlq.v1"], streaming=False)


@register("dead_letters_raw")
def _(lake):
    """Orders that break their contract, as raw dead letters."""
    landed = _order_rows(lake).withColumns(
        {FILE: F.lit("orders.csv"), "row_num": F.col("order_id").cast("bigint"), "_error": F.lit(None).cast("string")}
    )
    _, bad = accept(landed, ORDER_CONTRACT)
    letters = envelope.dead_letters_raw(bad, ENTITIES["order"].topic, ENTITIES["order"].columns)
    return _letters(lake, letters).select(
        "key",
        F.get_json_object("value", "$.raw_payload.order_id").alias("order_id"),
        F.get_json_object("value", "$.error").alias("error"),
    )


@register("dead_letters_enveloped")
def _(lake):
    """Envelopes too large for their topic: those of one kind carry a text of many bytes."""
    large = F.when(F.col("payload.review_comment_title") == "error", F.repeat(F.lit("x"), 3000))
    message = F.coalesce(large, F.col("payload.review_comment_message"))
    wrapped = _review_envelopes(lake)
    wrapped = wrapped.withColumn("payload", F.col("payload").withField("review_comment_message", message))
    _, refused = envelope.deliverable(wrapped, 3000)
    letters = _letters(lake, envelope.dead_letters_enveloped(refused, F.lit("message of more than 3000 bytes")))
    return letters.select(
        "key",
        F.get_json_object("value", "$.original_topic").alias("original_topic"),
        F.get_json_object("value", "$.envelope.payload.review_id").alias("review_id"),
    )


@register("audit_log")
def _(lake):
    """One audit row per stage, appended and read back."""
    path, at = work_dir(lake.spark, "audit"), datetime(2024, 2, 1)
    totals = observe.run_totals(lake.view("audit"), "pipeline_stage").collect()  # three stages
    rows = [audit_row("run", r.pipeline_stage, "all", r.rows_processed, r.rows_failed, at, at) for r in totals]
    append_audit(lake.spark, rows, path)
    return read_audit(lake.spark, path).select("pipeline_stage", "rows_processed", "rows_failed", "status")


# Models


def _build(lake, audit: str | None = None) -> dict[str, DataFrame]:
    staged = {name: lake.staged(entity) for name, entity in STAGED.items()}
    return models.build(lake.spark, staged, work_dir(lake.spark, "gold"), "run", audit)


@register("gold_build")
def _(lake):
    """Rows of every materialised model."""
    built = _build(lake)
    tables = [m.name for m in models.MODELS if m.kind == "table"]
    counts = [built[t].agg(F.count("*").alias("n")).select(F.lit(t).alias("model"), "n") for t in tables]
    return reduce(DataFrame.unionByName, counts)


@register("gold_published")
def _(lake):
    """The masked view that consumers read."""
    _build(lake)
    return lake.spark.table("published_fct_orders")


def _sales(lake) -> str:
    """The clustered sales facts of the whole tables, under a name of their own."""
    orders = lake.fct_orders("order_id", "customer_unique_id", "order_purchase_timestamp", "order_status")
    path = work_dir(lake.spark, "sales")
    name = f"gold.sales_{path.rpartition('-')[2]}"
    clustered.write_clustered(gold.sales_facts(orders, lake.fct_order_items()), name, path, gold.SALES_LAYOUT)
    return name


#: What is asked of the clustered facts.
DAYS, CUSTOMERS = (date(1995, 3, 1), date(1995, 6, 30)), tuple(range(1, 12))


@register("gold_time_range")
def _(lake):
    """Sales per day of four months, read from the zones that hold such days."""
    sales = clustered.read_clustered(lake.spark, _sales(lake), gold.SALES_LAYOUT, between={"order_date": DAYS})
    return sales.groupBy("order_date").agg(
        F.countDistinct("order_id").alias("orders"), F.count("*").alias("items"), F.sum("price").alias("revenue")
    )


@register("gold_customer_range")
def _(lake):
    """Items that eleven people bought since a day, newest first: both columns choose the zones."""
    people = lake.customer_places().select("customer_unique_id")
    wanted = [r[0] for r in people.orderBy("customer_unique_id").limit(len(CUSTOMERS)).collect()]
    sales = clustered.read_clustered(
        lake.spark, _sales(lake), gold.SALES_LAYOUT, {"order_date": (DAYS[0], None)}, {"customer_unique_id": wanted}
    )
    columns = ["customer_unique_id", "order_date", "order_id", "order_item_id", "product_id", "price"]
    return sales.select(*columns).orderBy(F.desc("order_date"), "order_id", "order_item_id")


@register("model_run_log")
def _(lake):
    audit = work_dir(lake.spark, "runs")
    _build(lake, audit)
    return read_audit(lake.spark, audit).select(F.col("entity_type").alias("model"), "rows_processed", "status")


@register("lineage_edges")
def _(lake):
    """Column-level edges of a build."""
    edges = models.lineage_edges(lake.spark, _build(lake), "run")
    return edges.select("output", "output_column", "input", "input_column")


@register("table_contract")
def _(lake):
    """The fact table's columns and types once its contract is enforced, and its rows."""
    facts = contracts.enforce(gold.fct_orders(lake.enriched()), FCT_ORDERS_CONTRACT, "fct_orders")
    return observe.schema_snapshot(facts).withColumn("n", F.lit(facts.count()).cast("bigint"))


# Silver loads


def _messages(lake, entity: str, rows: DataFrame | None = None) -> DataFrame:
    rows = lake.view(entity) if rows is None else rows
    at = F.lit("2024-01-02").cast("timestamp")
    enveloped = envelope.wrap(rows, entity, ingested_at=at, identity=ENTITIES[entity].key)
    return envelope.serialise(enveloped, envelope.message_key(enveloped, entity))


def _bronze(lake, messages: DataFrame) -> str:
    root = work_dir(lake.spark, "bronze")
    stamped = messages.withColumn("timestamp", F.lit("2024-02-01").cast("timestamp"))
    write_batch(envelope.parse(stamped), "batch-0", root, work_dir(lake.spark, "quarantine"), "gzip")
    return root


@register("silver_load_summary")
def _(lake):
    """Two entities with every message sent twice."""
    messages = _messages(lake, "customer").unionByName(_messages(lake, "seller"))
    bronze = _bronze(lake, messages.unionByName(messages))
    loads = silver.load_all(lake.spark, bronze, work_dir(lake.spark, "silver"), ["customer", "seller"])
    return silver.load_summary(lake.spark, loads).drop("error")


@register("dq_nonempty")
def _(lake):
    """An entity whose Bronze has blank lines only fails its load, another goes on."""
    bronze, target = _bronze(lake, _messages(lake, "seller")), work_dir(lake.spark, "silver")
    blank = lake.raw("customer").select(F.lit("").alias("value"), F.lit("2024").alias("year"), F.lit("01").alias("month"), F.lit("02").alias("day"))
    blank.write.partitionBy("year", "month", "day").text(f"{bronze}/entity=customer")
    loads = silver.load_all(lake.spark, bronze, target, ["customer", "seller"])
    lines = blank.agg(F.count("*").alias("n")).select(F.lit("customer").alias("entity"), "n")
    rows = silver.silver_table(lake.spark, target, "seller").read().agg(F.count("*").alias("n"))
    counted = lines.unionByName(rows.select(F.lit("seller").alias("entity"), "n"))
    return silver.load_summary(lake.spark, loads).select("entity", "status").join(counted, "entity")


@register("dq_null_keys")
def _(lake):
    """Rows without a key stop the load before it is published."""
    gone = F.when(F.col("customer_state") != "ASIA", F.col("customer_id"))
    rows = lake.view("customer").withColumn("customer_id", gone)
    flat = envelope.unpack(envelope.wrap(rows, "customer", identity=["customer_unique_id"]))
    missing = flat.where(silver.null_keys(flat, "customer")).count()
    bronze, target = _bronze(lake, _messages(lake, "customer", rows)), work_dir(lake.spark, "silver")
    loads = silver.load_all(lake.spark, bronze, target, ["customer"])
    if silver.silver_table(lake.spark, target, "customer").read() is not None:
        raise AssertionError("a load that failed was published")
    return silver.load_summary(lake.spark, loads).select("entity", "status").withColumn("n", F.lit(missing).cast("bigint"))


# Streams


@register("stream_flush")
def _(lake):
    """A folder stream without a bound drains in one batch."""
    root, quarantine = work_dir(lake.spark, "bronze"), work_dir(lake.spark, "quarantine")
    source = work_dir(lake.spark, "topics")
    stamped = _mixed_messages(lake).withColumn("timestamp", F.lit("2024-02-01").cast("timestamp"))
    with open_writers(lake.spark):
        stamped.write.partitionBy("topic").option("maxRecordsPerFile", MESSAGES).json(source, compression="gzip")
    stream = read_topics(lake.spark, source)
    land_bronze(stream, root, quarantine, work_dir(lake.spark, "offsets"), trigger=BACKFILL, compression="gzip").awaitTermination()
    landed = lake.spark.read.text(root)
    return landed.agg(F.count("*").alias("n"), F.countDistinct("batch").alias("batches"))


@register("stream_all_topics")
def _(lake):
    """All nine entities through one query, read back one by one."""
    rows = {e: silver_text(lake.spark, lake.sf_dir, e) for e in ENTITIES}
    messages = reduce(DataFrame.unionByName, [_messages(lake, e, df) for e, df in rows.items()])
    root, quarantine = work_dir(lake.spark, "bronze"), work_dir(lake.spark, "quarantine")
    land_bronze(
        _stream(lake, messages, consume=True),
        root,
        quarantine,
        work_dir(lake.spark, "offsets"),
        trigger=BACKFILL,
        compression="gzip",
    ).awaitTermination()
    counts = [read_bronze(lake.spark, root, e).agg(F.count("*").alias("n")).select(F.lit(e).alias("entity"), "n") for e in ENTITIES]
    return reduce(DataFrame.unionByName, counts)


@register("stream_replay")
def _(lake):
    """A second group with a new checkpoint lands everything again, in folders of its own."""
    root, quarantine = work_dir(lake.spark, "bronze"), work_dir(lake.spark, "quarantine")
    stream = _stream(lake, _mixed_messages(lake))
    for group in ("first", "second"):
        land_bronze(stream, root, quarantine, work_dir(lake.spark, "offsets"), group, BACKFILL, "gzip").awaitTermination()
    return read_bronze(lake.spark, root, "review").groupBy("review_id", "order_id").agg(F.count("*").alias("n"))


def _order_states(lake) -> tuple[DataFrame, DataFrame]:
    """Messages of every order as it was created, and as it is a day later."""
    orders = _order_rows(lake)

    def messages(df: DataFrame, day: str) -> DataFrame:
        enveloped = envelope.wrap(df, "order", ingested_at=F.lit(day).cast("timestamp"))
        return envelope.serialise(enveloped, envelope.message_key(enveloped, "order"))

    return messages(orders.withColumn("order_status", F.lit("created")), "2024-01-01"), messages(orders, "2024-01-02")


@register("stream_silver_after_rebuild")
def _(lake):
    """Half of the orders, as created, rebuilt from Bronze; then batch 0 of a fresh stream brings all."""
    old, new = _order_states(lake)
    root = work_dir(lake.spark, "silver")
    even = F.get_json_object("value", "$.payload.order_id").cast("bigint") % 2 == 0
    silver.load_entity(lake.spark, _bronze(lake, old.where(even)), root, "order")
    table = silver.silver_table(lake.spark, root, "order")
    run_silver(lake, _stream(lake, new), "order", table)
    return table.read().select(*SILVER_ORDER)


@register("stream_silver_replay")
def _(lake):
    """A stream, then the same topics once more with a new checkpoint."""
    old, new = _order_states(lake)
    table = silver.silver_table(lake.spark, work_dir(lake.spark, "silver"), "order")
    run_silver(lake, _stream(lake, old), "order", table)
    run_silver(lake, _stream(lake, old.unionByName(new)), "order", table)
    return table.read().select(*SILVER_ORDER)


@register("stream_silver_quarantine")
def _(lake):
    """Messages that cannot be read are kept aside, none enters the table."""
    table = silver.silver_table(lake.spark, work_dir(lake.spark, "silver"), "review")
    kept = lake.spark.read.json(run_silver(lake, _stream(lake, _mixed_messages(lake)), "review", table))
    return kept.select("key", "error")


# Roll-ups


def _refreshed(lake, rollup, rows: DataFrame) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Monthly states and members of all rows, those of the later half refreshed a second time."""
    path = work_dir(lake.spark, "states")
    rollup.refresh(rows, path)
    rollup.refresh(rows.where(F.col("order_month") >= "1995-06-01"), path)
    return read_states(lake.spark, path), {m: read_members(lake.spark, path, m) for m in rollup.members}


@register("q9_distinct_rollup")
def _(lake):
    """The star join from monthly states and members, its distinct counts held against those of the facts."""
    # Written once: states, members and the check read the same rows.
    sales = rollups.monthly_items(
        lake.fct_orders("order_id", "customer_unique_id", "order_purchase_timestamp"),
        lake.customer_places(),
        lake.staged("order_item"),
        lake.staged("product"),
        lake.staged("seller"),
    )
    with tidy_shuffles(lake.spark):
        rows = durable(sales, "zstd")
    groups = rollups.SALES.keys[1:]
    found = rollups.sales_by_place(*_refreshed(lake, rollups.SALES, rows))
    by = [F.col(c).alias(f"_{c}") for c in groups]
    exact = rollups.distinct_counts(rows, by, {"_orders": "order_id", "_customers": "customer_unique_id"})
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in groups])
    return found.join(exact, same, "full").select(
        *groups,
        F.col("row_count").alias("item_count"),
        "gross_merchandise_value",
        F.col("_orders").alias("exact_orders"),
        F.col("unique_orders").eqNullSafe(F.col("_orders")).alias("orders_near"),
        F.col("_customers").alias("exact_customers"),
        F.col("unique_customers").eqNullSafe(F.col("_customers")).alias("customers_near"),
    )


@register("q10_kll_rollup")
def _(lake):
    """Percentiles from monthly states, held against the share of the facts below them.

    Sketches draw at random, so twice the error of 99 cases in 100 is allowed: five standard errors.
    """
    columns = ("order_id", "customer_unique_id", "order_purchase_timestamp", "total_payment_value", "delivery_time_days")
    rows = rollups.monthly_orders(lake.fct_orders(*columns), lake.customer_places())
    found = rollups.percentiles_by_state(_refreshed(lake, rollups.PAYMENTS, rows)[0])
    near = []
    checked = {"median_payment": ("total_payment_value", 0.5), "p90_delivery_time": ("delivery_time_days", 0.9)}
    for name, (column, p) in checked.items():
        value, room = F.col(column).cast("double"), 2 * rollups.PAYMENTS.rank_error
        below = F.count_if(value < F.col(name)) / F.count(value)
        upto = F.count_if(value <= F.col(name)) / F.count(value)
        near.append(((below - room <= p) & (upto + room >= p)).alias(f"{name}_near"))
    return (
        rows.select("customer_state", *[c for c, _ in checked.values()])
        .join(found.withColumnRenamed("total_payment_value", "revenue"), "customer_state")
        .groupBy("customer_state")
        .agg(F.first("row_count").alias("order_count"), F.first("revenue").alias("revenue"), *near)
    )


@register("retention_rollup")
def _(lake):
    """Customers of each month and state that come again in the next month, from monthly members."""
    columns = ("order_id", "customer_unique_id", "order_purchase_timestamp", "total_payment_value", "delivery_time_days")
    rows = durable(rollups.monthly_orders(lake.fct_orders(*columns), lake.customer_places()))
    _, members = _refreshed(lake, rollups.CUSTOMERS, rows)
    return rollups.retention(members["customers"])


@register("table_drilldown")
def _(lake):
    """Item lines before and after deduplication and corrections: which keys differ, and in what."""
    items, keys = lake.view("order_item"), ["order_id", "order_item_id"]
    day = F.col("shipping_limit_date")
    corrected = keep_latest(items, keys, _items_order(items)).where(day >= "1995-02-01")
    late = day >= "2001-10-01"
    corrected = corrected.withColumns(
        {
            "price": F.when(late, F.col("price") + 1).otherwise(F.col("price")).cast(items.schema["price"].dataType),
            "seller_id": F.when(late & (F.col("quantity") > 40), None).otherwise(F.col("seller_id")),
        }
    )
    root = work_dir(lake.spark, "versions")
    save_version(items, keys, f"{root}/before", buckets=32)
    save_version(corrected, keys, f"{root}/after", buckets=32)
    return drilldown(lake.spark, f"{root}/before", f"{root}/after")
