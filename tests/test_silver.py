"""Keep-latest rules, Bronze reading, keyed tables and the per-entity load."""

from __future__ import annotations

import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from orebed.operators.latest import keep_latest_entity, latest_order
from orebed.plans import silver
from orebed.sinks.keyed import KeyedTable
from orebed.sources.bronze import read_bronze

COLUMNS = "seller_id string, seller_city string, ingested_at string, event_id string"


def test_ties_nulls_and_empty_keys(spark):
    rows = [
        ("s1", "old", "2024-01-01", "a"),
        ("s1", "tie", "2024-01-02", "a"),
        ("s1", "win", "2024-01-02", "b"),
        (None, "x", "2024-01-01", "a"),
        (None, "y", "2024-01-03", "a"),
        ("", "z", "2024-01-01", "a"),
    ]
    df = spark.createDataFrame(rows, COLUMNS)
    kept = {r.seller_id: r.seller_city for r in keep_latest_entity(df, "seller").collect()}
    assert kept == {"s1": "win", None: "y", "": "z"}


def test_missing_key_column_keeps_everything(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2)], "other string, n int")
    assert keep_latest_entity(df, "seller").count() == 2


def test_compat_key_drops_items_and_payments(spark):
    items = spark.createDataFrame(
        [("o1", "1", "t1", "a"), ("o1", "2", "t1", "b"), ("o2", "1", "t2", "c")],
        "order_id string, order_item_id string, ingested_at string, event_id string",
    )
    assert keep_latest_entity(items, "order_item").count() == 3
    assert keep_latest_entity(items, "order_item", compat=True).count() == 2


def test_load_stamp_orders_rows_without_ingest_time(spark):
    df = spark.createDataFrame([("s", 1), ("s", 2)], "seller_id string, _silver_loaded_at int")
    assert keep_latest_entity(df, "seller").first()._silver_loaded_at == 2


def bronze_file(root, entity, day, lines, name="batch_1.json"):
    folder = root / f"entity={entity}" / "year=2024" / "month=01" / f"day={day:02d}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n", encoding="utf-8")


def seller(key, city, at, event="e"):
    return json.dumps(
        {
            "metadata": {"event_id": event, "entity_type": "seller", "ingested_at": at},
            "payload": {"seller_id": key, "seller_city": city},
        }
    )


def test_read_bronze_prunes_days_and_skips_blank_lines(spark, tmp_path):
    bronze_file(tmp_path, "seller", 1, [seller("s1", "a", "2024-01-01T00:00:00Z"), ""])
    bronze_file(tmp_path, "seller", 5, [seller("s2", "b", "2024-01-05T00:00:00Z")])
    assert read_bronze(spark, str(tmp_path), "seller").count() == 2
    recent = read_bronze(spark, str(tmp_path), "seller", since=date(2024, 1, 3))
    assert [r.seller_id for r in recent.collect()] == ["s2"]
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "make_date" in plan.split("PartitionFilters: [")[1]
    with pytest.raises(FileNotFoundError):
        read_bronze(spark, str(tmp_path), "customer")


def test_other_bronze_shapes(spark, tmp_path):
    bronze_file(tmp_path, "seller", 1, ['{"payload": {"seller_id": "s1"}}'])
    bronze_file(tmp_path, "customer", 1, ['{"customer_id": "c1", "event_id": "e1"}'])
    only = read_bronze(spark, str(tmp_path), "seller", shape="payload")
    assert only.first().seller_id == "s1" and "event_id" not in only.columns
    flat = read_bronze(spark, str(tmp_path), "customer", shape="flat").first()
    assert (flat.customer_id, flat.event_id) == ("c1", "e1")


def test_load_reports_each_entity(spark, tmp_path):
    bronze, target = tmp_path / "bronze", tmp_path / "silver"
    bronze_file(
        bronze,
        "seller",
        1,
        [
            seller("s1", "old", "2024-01-01T00:00:00Z"),
            seller("s1", "new", "2024-01-02T00:00:00Z"),
            seller("s2", "x", "2024-01-01T00:00:00Z"),
        ],
    )
    bronze_file(bronze, "customer", 1, [""])
    bronze_file(bronze, "product", 1, ['{"metadata": {"event_id": "e"}, "payload": {"product_id": null}}'])
    loads = silver.load_all(
        spark, str(bronze), str(target), ["seller", "customer", "product", "order"]
    )
    found = {
        r.entity: (r.raw_count, r.silver_count, r.duplicates_dropped, r.status)
        for r in silver.load_summary(spark, loads).collect()
    }
    assert found["seller"] == (3, 2, 1, "SUCCESS")
    assert found["customer"][3] == found["product"][3] == "DQ_FAIL"
    assert found["order"][3] == "ERROR"
    table = silver.silver_table(spark, str(target), "seller")
    assert {r.seller_id: r.seller_city for r in table.read().collect()} == {"s1": "new", "s2": "x"}
    table.view("silver_seller")
    assert spark.table("silver_seller").count() == 2
    # What failed its checks was not published.
    assert silver.silver_table(spark, str(target), "product").read() is None


def rows(spark, *values):
    return spark.createDataFrame(
        [(k, v, at, f"{k}{at}") for k, v, at in values],
        "seller_id string, seller_city string, ingested_at string, event_id string",
    )


def state(table):
    current = table.read()
    return {} if current is None else {r.seller_id: r.seller_city for r in current.collect()}


@pytest.fixture
def table(spark, tmp_path):
    return KeyedTable(spark, str(tmp_path), ["seller_id"], latest_order)


def test_upsert_is_latest_wins_in_any_order(spark, table):
    assert table.read() is None
    with pytest.raises(FileNotFoundError):
        table.view("nothing")
    table.upsert(rows(spark, ("a", "a1", "1"), ("b", "b1", "1"), ("a", "a0", "0")), "s", 0)
    table.upsert(rows(spark, ("a", "late", "0"), ("c", "c1", "1")), "s", 1)
    table.upsert(rows(spark, ("b", "b2", "2")), "s", 2)
    assert state(table) == {"a": "a1", "b": "b2", "c": "c1"}


def test_a_repeated_batch_changes_nothing(spark, table):
    table.upsert(rows(spark, ("a", "a1", "1"), ("b", "b1", "1")), "s", 0)
    batch = rows(spark, ("a", "a2", "2"), ("c", "c1", "1"))
    for _ in range(2):
        table.upsert(batch, "s", 1)
        assert state(table) == {"a": "a2", "b": "b1", "c": "c1"} and table.read().count() == 3


def test_batches_after_a_rebuild_show_whatever_their_number(spark, table):
    table.upsert(rows(spark, ("a", "old", "1")), "first", 7)
    table.rebuild(rows(spark, ("a", "rebuilt", "2"), ("b", "rebuilt", "2")))
    assert state(table) == {"a": "rebuilt", "b": "rebuilt"}
    table.upsert(rows(spark, ("a", "new", "3"), ("c", "new", "3")), "second", 0)
    assert state(table) == {"a": "new", "b": "rebuilt", "c": "new"}


def files(tmp_path):
    return {p: p.stat().st_mtime_ns for p in (tmp_path / "rows").rglob("*.parquet")}


def test_a_batch_rewrites_its_buckets_whatever_came_before(spark, table, tmp_path):
    table.rebuild(rows(spark, *[(f"k{i}", "x", "1") for i in range(200)]))
    expected, counts = {f"k{i}": "x" for i in range(200)}, []
    for v in range(2, 9):
        before = files(tmp_path)
        table.upsert(rows(spark, (f"k{v}", f"v{v}", str(v)), ("all", f"v{v}", str(v))), "s", v)
        expected |= {f"k{v}": f"v{v}", "all": f"v{v}"}
        assert state(table) == expected
        after = files(tmp_path)
        counts.append(len(after))
        # Two keys lie in two folders at most: all other files are the same ones as before.
        folders = {p.parent for p in after if before.get(p) != after[p]}
        assert 1 <= len(folders) <= 2
    # One file a bucket, and one staged batch, however many batches there were.
    assert set(counts) == {table.buckets}
    staged = spark.read.parquet(f"{table.root}/staged")
    assert staged.select(table.bucket).distinct().count() <= 2


@pytest.mark.parametrize("lost", ["before", "between"])
def test_a_batch_that_fails_is_finished_when_it_is_repeated(spark, table, tmp_path, monkeypatch, lost):
    """The write of the folders fails, before it begins or with one folder gone; then the batch comes again."""
    table.rebuild(rows(spark, *[(f"k{i}", "x", "1") for i in range(60)]))
    batch = rows(spark, ("k1", "new", "2"), ("k2", "old", "0"), ("n", "new", "2"))

    def fail(staged, mode):
        if lost == "between":
            bucket = staged.select(table.bucket).first()[0]
            for p in (tmp_path / "rows" / f"{table.bucket}={bucket}").iterdir():
                p.unlink()
        raise RuntimeError("executor lost")

    with monkeypatch.context() as patched:
        patched.setattr(table, "_replace", fail)
        with pytest.raises(RuntimeError):
            table.upsert(batch, "s", 3)
    again = KeyedTable(spark, str(tmp_path), ["seller_id"], latest_order)
    again.upsert(batch, "s", 3)
    assert state(again) == {f"k{i}": "x" for i in range(60)} | {"k1": "new", "n": "new"}


def test_the_number_of_buckets_belongs_to_the_table(spark, table, tmp_path):
    table.rebuild(rows(spark, ("a", "a1", "1")))
    other = KeyedTable(spark, str(tmp_path), ["seller_id"], latest_order, buckets=8)
    with pytest.raises(ValueError, match="8 buckets"):
        other.upsert(rows(spark, ("a", "a2", "2")), "s", 0)


def test_an_empty_batch_changes_nothing(spark, table):
    table.upsert(rows(spark, ("a", "a1", "1")).limit(0), "s", 0)
    assert state(table) == {}
    table.upsert(rows(spark, ("a", "a1", "1")), "s", 1)
    table.upsert(rows(spark, ("a", "a1", "1")).limit(0), "s", 2)
    assert state(table) == {"a": "a1"}


def test_columns_may_be_added(spark, table):
    table.upsert(rows(spark, ("a", "a1", "1"), ("b", "b1", "1")), "s", 0)
    table.upsert(rows(spark, ("a", "a2", "2")).withColumn("seller_state", F.lit("RJ")), "s", 1)
    table.upsert(rows(spark, ("b", "late", "0")), "s", 2)
    found = {r.seller_id: (r.seller_city, r.seller_state) for r in table.read().collect()}
    assert found == {"a": ("a2", "RJ"), "b": ("b1", None)}


def test_rebuild_drops_rows_that_are_gone(spark, table):
    table.rebuild(rows(spark, *[(f"k{i}", "x", "1") for i in range(40)]))
    table.rebuild(rows(spark, ("only", "x", "1")))
    assert state(table) == {"only": "x"}
    table.rebuild(rows(spark, ("only", "x", "1")).limit(0))
    assert state(table) == {}


def test_a_failed_check_publishes_nothing(spark, table):
    table.rebuild(rows(spark, ("a", "a1", "1")))

    def refuse(written):
        raise silver.QualityError(str(written.count()))

    with pytest.raises(silver.QualityError):
        table.publish(rows(spark, ("b", "b1", "1")), refuse)
    assert state(table) == {"a": "a1"}


def test_hot_key_is_reduced_before_the_shuffle(spark):
    df = spark.range(1000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("seller_id"),
        F.col("id").cast("string").alias("ingested_at"),
        F.col("id").cast("string").alias("event_id"),
    )
    plan = keep_latest_entity(df, "seller")._jdf.queryExecution().executedPlan().toString()
    exchange = plan.index("Exchange hashpartitioning")
    assert "WindowGroupLimit" in plan[exchange:] and "WindowGroupLimit" in plan[:exchange]
