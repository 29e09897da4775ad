"""Streams over several files: same rows as the batch form, nothing twice after a restart."""

from __future__ import annotations

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from orebed.operators.envelope import parse
from orebed.plans.silver import silver_table
from orebed.sources.bronze import read_bronze
from orebed.sources.topics import flush_options, read_topics
from orebed.streaming import alerts, bronze, events
from orebed.session import work_dir
from orebed.streaming.silver import maintain_silver

TOPIC = "ecommerce.olist.sellers.v1"


def message(key, city, at, event=None):
    body = {
        "metadata": {
            "event_id": event or f"{key}-{at}",
            "entity_type": "seller",
            "ingested_at": at,
        },
        "payload": {"seller_id": key, "seller_city": city},
    }
    return {"key": key, "value": json.dumps(body), "timestamp": "2024-03-01T00:00:00Z"}


def put(root, name, messages, topic=TOPIC):
    folder = root / f"topic={topic}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(m) for m in messages) + "\n")


@pytest.fixture
def topics(tmp_path):
    root = tmp_path / "topics"
    put(root, "1.json", [message("a", "a1", "2024-01-01T10:00:00Z"), message("b", "b1", "2024-01-01T10:00:00Z")])
    put(root, "2.json", [message("a", "a1", "2024-01-01T10:00:00Z"), {"key": "x", "value": "{broken"}])
    put(root, "3.json", [message("a", "a2", "2024-01-02T10:00:00Z"), {"key": "y", "value": ""}])
    put(root, "4.json", [message("c", "c1", "2024-01-02T10:00:00Z")])
    return root


def land(spark, topics, tmp_path, group="g", checkpoint="offsets"):
    stream = read_topics(spark, str(topics), maxFilesPerTrigger=1)
    query = bronze.land_bronze(
        stream,
        str(tmp_path / "bronze"),
        str(tmp_path / "quarantine"),
        str(tmp_path / checkpoint),
        group,
        bronze.BACKFILL,
    )
    query.awaitTermination()


def test_bronze_layout_quarantine_and_restart(spark, topics, tmp_path):
    land(spark, topics, tmp_path)
    assert read_bronze(spark, str(tmp_path / "bronze"), "seller").count() == 5
    assert spark.read.json(str(tmp_path / "quarantine")).count() == 2
    days = {p.name for p in (tmp_path / "bronze" / "entity=seller" / "year=2024" / "month=01").iterdir()}
    assert days == {"day=01", "day=02"}
    land(spark, topics, tmp_path)
    assert read_bronze(spark, str(tmp_path / "bronze"), "seller").count() == 5
    put(topics, "5.json", [message("d", "d1", "2024-01-03T10:00:00Z")])
    land(spark, topics, tmp_path)
    assert read_bronze(spark, str(tmp_path / "bronze"), "seller").count() == 6


def test_replay_under_a_new_group_appends(spark, topics, tmp_path):
    land(spark, topics, tmp_path)
    land(spark, topics, tmp_path, "replay", "offsets-2")
    assert read_bronze(spark, str(tmp_path / "bronze"), "seller").count() == 10


def test_a_repeated_batch_replaces_its_files(spark, topics, tmp_path):
    batch = parse(read_topics(spark, str(topics), streaming=False))
    for _ in range(2):
        bronze.write_batch(batch, "g-0", str(tmp_path / "b"), str(tmp_path / "q"))
    assert read_bronze(spark, str(tmp_path / "b"), "seller").count() == 5
    assert spark.read.json(str(tmp_path / "q")).count() == 2


def test_compaction_keeps_lines(spark, topics, tmp_path):
    land(spark, topics, tmp_path)
    source = spark.read.text(str(tmp_path / "bronze"))
    bronze.compact(source, str(tmp_path / "compact"))
    assert read_bronze(spark, str(tmp_path / "compact"), "seller").count() == 5
    assert len(list((tmp_path / "compact").rglob("*.txt"))) <= len(list((tmp_path / "bronze").rglob("*.txt")))


def test_dedup_across_files_and_late_events(spark, topics, tmp_path):
    put(topics, "5.json", [message("late", "x", "2023-01-01T00:00:00Z")])
    stream = parse(read_topics(spark, str(topics), maxFilesPerTrigger=1))
    query = (
        events.dedup_events(stream, "1 hour")
        .select("event_id")
        .writeStream.format("parquet")
        .option("checkpointLocation", str(tmp_path / "offsets"))
        .trigger(**bronze.BACKFILL)
        .start(str(tmp_path / "out"))
    )
    query.awaitTermination()
    found = sorted(r.event_id for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert found == [
        "a-2024-01-01T10:00:00Z",
        "a-2024-01-02T10:00:00Z",
        "b-2024-01-01T10:00:00Z",
        "c-2024-01-02T10:00:00Z",
    ]


def run_silver(spark, topics, tmp_path, table, checkpoint="offsets"):
    stream = read_topics(spark, str(topics), maxFilesPerTrigger=1)
    folders = str(tmp_path / checkpoint), str(tmp_path / "aside")
    maintain_silver(stream, "seller", table, *folders).awaitTermination()
    return {r.seller_id: r.seller_city for r in table.read().collect()}


def test_silver_stays_latest(spark, topics, tmp_path):
    table = silver_table(spark, str(tmp_path / "silver"), "seller")
    assert run_silver(spark, topics, tmp_path, table) == {"a": "a2", "b": "b1", "c": "c1"}
    put(topics, "5.json", [message("a", "stale", "2023-01-01T00:00:00Z"), message("b", "b2", "2024-02-01T00:00:00Z")])
    assert run_silver(spark, topics, tmp_path, table) == {"a": "a2", "b": "b2", "c": "c1"}


def test_silver_takes_its_entity_and_keeps_the_rest_aside(spark, topics, tmp_path):
    put(topics, "6.json", [message("z", "no seller", "2024-01-01T10:00:00Z")], "ecommerce.olist.customers.v1")
    other = message("w", "w1", "2024-01-01T10:00:00Z")
    other["value"] = other["value"].replace('"seller"', '"order"')
    put(topics, "7.json", [other])
    table = silver_table(spark, str(tmp_path / "silver"), "seller")
    assert run_silver(spark, topics, tmp_path, table) == {"a": "a2", "b": "b1", "c": "c1"}
    errors = sorted(r.error for r in spark.read.json(str(tmp_path / "aside")).collect())
    assert errors == ["not a readable envelope"] * 2 + ["not an event of seller"]


def test_silver_after_a_rebuild_and_a_replay(spark, topics, tmp_path):
    table = silver_table(spark, str(tmp_path / "silver"), "seller")
    run_silver(spark, topics, tmp_path, table)
    table.rebuild(table.read().where("seller_id <> 'c'"))
    put(topics, "8.json", [message("d", "d1", "2024-01-03T10:00:00Z")])
    found = run_silver(spark, topics, tmp_path, table, "offsets-2")
    assert found == {"a": "a2", "b": "b1", "c": "c1", "d": "d1"}


def test_hourly_totals_drop_what_is_behind_the_watermark(spark, tmp_path):
    source = tmp_path / "audit"
    source.mkdir()

    def add(name, *rows):
        (source / name).write_text(
            "".join(json.dumps({"finished_at": t, "entity_type": "order", "rows_processed": n}) + "\n" for t, n in rows)
        )

    schema = "finished_at timestamp, entity_type string, rows_processed bigint"

    def run():
        stream = spark.readStream.schema(schema).json(str(source))
        events.publish_totals(
            events.hourly_totals(stream, delay="2 hours"), str(tmp_path / "out"), str(tmp_path / "offsets")
        ).awaitTermination()
        found = events.read_totals(spark, str(tmp_path / "out")).collect()
        return {r.hour.hour: r.total_rows for r in found}

    add("1.json", ("2024-01-01T10:05:00Z", 5), ("2024-01-01T15:00:00Z", 1))
    assert run() == {10: 5, 15: 1}
    add("2.json", ("2024-01-01T14:05:00Z", 2), ("2024-01-01T10:30:00Z", 100))
    assert run() == {10: 5, 14: 2, 15: 1}


def test_alert_fires_once_per_breach(spark, tmp_path):
    source, totals, out = (str(tmp_path / p) for p in ("lag", "totals", "alerts"))
    start = datetime(2024, 1, 1)
    lags = [0] * 4 + [800] * 25 + [0] * 4 + [800] * 10 + [0] * 20
    rows = [
        (start + timedelta(seconds=15 * i), "g", "t", p, lag) for i, lag in enumerate(lags) for p in (0, 1)
    ]
    df = spark.createDataFrame(
        rows, "ts timestamp, consumergroup string, topic string, partition int, lag bigint"
    )
    for half in (df.where(F.col("ts") < start + timedelta(minutes=4)), df.where(F.col("ts") >= start + timedelta(minutes=4))):
        half.coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(df.schema).parquet(source)
        alerts.append_stream(alerts.lag_totals(stream), totals, str(tmp_path / "o1")).awaitTermination()
        closed = spark.readStream.schema(alerts.TOTAL).parquet(totals)
        alerts.append_stream(alerts.lag_alerts(closed), out, str(tmp_path / "o2")).awaitTermination()
    found = spark.read.schema(alerts.ALERT).parquet(out).collect()
    begin = start + timedelta(minutes=1)
    assert [(r.started_at, r.fired_at, r.lag) for r in found] == [(begin, begin + timedelta(minutes=5), 1600)]


def test_flush_options_bound_no_throughput():
    assert flush_options("kafka", 1000, "30s") == {"minOffsetsPerTrigger": "1000", "maxTriggerDelay": "30s"}
    assert flush_options("json") == {} and bronze.FLUSH == {"processingTime": "0 seconds"}


def test_a_folder_drains_in_one_batch(spark, topics, tmp_path):
    stream = read_topics(spark, str(topics))
    bronze.land_bronze(
        stream, str(tmp_path / "b"), str(tmp_path / "q"), str(tmp_path / "o"), trigger=bronze.BACKFILL
    ).awaitTermination()
    assert len({p.name for p in (tmp_path / "b").rglob("batch=*")}) == 1


def test_a_folder_stream_is_dealt_by_messages_in_two_triggers(spark, monkeypatch):
    from orebed.plans import registry

    monkeypatch.setattr(registry, "MESSAGES", 100)
    lake = registry.Lake(spark, "/root/testdata/sf0.001")
    messages = registry._review_messages(lake).limit(950)
    stream = registry._stream(lake, messages)
    source = work_dir(spark, "copied")
    query = stream.writeStream.option("checkpointLocation", work_dir(spark, "offsets")).trigger(availableNow=True)
    query = query.format("json").start(source)
    query.awaitTermination()
    assert spark.read.json(source).count() == messages.count() > 0
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == 2


def test_landing_a_batch_neither_sorts_nor_shuffles_its_text(spark, tmp_path):
    rows = spark.range(1000).select(F.lit("t").alias("topic"), F.col("id").cast("string").alias("key"), F.lit('{"metadata": {"entity_type": "order"}, "payload": {}}').alias("value"), F.lit("2024-01-01").cast("timestamp").alias("timestamp"))
    bronze.write_batch(parse(rows), "b", str(tmp_path / "b"), str(tmp_path / "q"), "gzip")
    assert spark.read.text(str(tmp_path / "b")).count() == 1000
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"


def test_consumed_topics_are_deleted_trigger_by_trigger(spark, monkeypatch, tmp_path):
    from orebed.plans import registry

    monkeypatch.setattr(registry, "TRIGGER_FILES", 2)
    monkeypatch.setattr(registry, "work_dir", lambda spark, purpose: str(tmp_path / purpose))
    text = '{"metadata": {"entity_type": "%s", "ingested_at": "2024-01-02"}, "payload": {"order_id": "%d"}}'
    parts = [
        spark.range(0, 1000, 1, 4).select(F.lit(f"ecommerce.olist.{e}s.v1").alias("topic"), F.col("id").cast("string").alias("key"), F.format_string(text, F.lit(e), "id").alias("value"))
        for e in ("order", "payment")
    ]
    stream = registry._stream(registry.Lake(spark, str(tmp_path)), parts[0].unionByName(parts[1]), consume=True)
    topics, left, write = tmp_path / "topics", [], bronze.write_batch
    files = len([*topics.rglob("*.parquet")])

    def watched(*args):
        write(*args)
        left.append(len([*topics.rglob("*.parquet")]))

    monkeypatch.setattr(bronze, "write_batch", watched)
    root = str(tmp_path / "bronze")
    bronze.land_bronze(stream, root, str(tmp_path / "q"), str(tmp_path / "o"), trigger=bronze.BACKFILL).awaitTermination()
    assert files == 8 and len(left) == 4 and left[-1] < files
    assert len([*topics.rglob("*.parquet")]) == 2  # those of the last trigger
    for entity in ("order", "payment"):
        landed = read_bronze(spark, root, entity).agg(F.count("*").alias("n"), F.countDistinct("order_id").alias("ids"))
        assert landed.first() == (1000, 1000)
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_digits_of_ids_are_packed_without_chance_matches(spark, tmp_path):
    metadata = F.struct(F.lit("order").alias("entity_type"), F.sha2(F.col("id").cast("string"), 256).alias("event_id"))
    value = F.to_json(F.struct(metadata.alias("metadata"), F.struct(F.sha2((-F.col("id")).cast("string"), 256).alias("order_id")).alias("payload")))
    rows = spark.range(0, 20_000, 1, 1).select(F.lit("t").alias("topic"), F.lit("k").alias("key"), value.alias("value"), F.lit("2024-01-01").cast("timestamp").alias("timestamp"))
    bronze.write_batch(parse(rows), "b", str(tmp_path / "b"), str(tmp_path / "q"), "gzip")
    size = sum(f.stat().st_size for f in (tmp_path / "b").rglob("*.gz"))
    assert spark.read.text(str(tmp_path / "b")).count() == 20_000 and size / 20_000 < 84
