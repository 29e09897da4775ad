"""CSV reading, routing, enveloping, dead letters and audit rows on hand-written files."""

from __future__ import annotations

import csv
import hashlib
import io
import json
import random

import pytest
from pyspark.sql import functions as F

from orebed.catalog import ENTITIES, ORDER_CONTRACT
from orebed.operators import envelope
from orebed.plans.ingest import ingest, ingest_file
from orebed.sinks.audit import read_audit
from orebed.sources import csv as csv_source
from orebed.sources import records
from orebed.sources.topics import read_topics

HEADER = "product_category_name,product_category_name_english\n"


def write(path, text, encoding="utf-8"):
    path.write_text(text, encoding=encoding, newline="")
    return str(path)


def test_bom_quotes_breaks_and_padding(spark, tmp_path):
    text = '﻿a,b\n1,"line one\nline two"\n2,"say ""hi"""\n3,   padded\t \n'
    path = write(tmp_path / "x.csv", text)
    rows = csv_source.read_csv(spark, path).orderBy("a").collect()
    with open(path, newline="", encoding="utf-8-sig") as fh:
        expected = [{k: v.strip() for k, v in r.items()} for r in csv.DictReader(fh)]
    assert [{"a": r.a, "b": r.b} for r in rows] == expected
    assert csv_source.row_count(spark, path) == 3


def test_empty_short_and_long_rows(spark, tmp_path):
    text = 'a,b,c\n1,,x\n2,"",y\n3,x\n4,y,z,EXTRA\n5,y,,,\n6,"q,1",w\n7,"a,b","c\nd"\n'
    path = write(tmp_path / "x.csv", text)
    rows = {r.a: r for r in csv_source.read_csv(spark, path).collect()}
    assert (rows["1"].b, rows["2"].b) == ("", "")
    assert (rows["3"].b, rows["3"].c, rows["3"]._error) == ("x", None, None)
    assert rows["4"]._error and "EXTRA" in rows["4"]._raw
    assert rows["5"]._error
    assert (rows["6"].b, rows["6"]._error) == ("q,1", None)
    assert (rows["7"].c, rows["7"]._error) == ("c\nd", None)


def small_blocks(spark, size):
    """Session settings under which a file is read in blocks of so many bytes."""
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    return before


def large_blocks(spark, before):
    spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
    spark.conf.set("spark.sql.files.openCostInBytes", before[1])


@pytest.mark.parametrize("size", [600, 2000])
def test_quoted_line_breaks_across_blocks(spark, tmp_path, size):
    rng = random.Random(size)
    values = ["plain", "", "two\nlines", "a\r\nb", 'say "hi"', "a,b", "\n\n", '"', "é" * 30, "x\n" * 60, ' "not quoted']
    rows = [[str(i), *(rng.choice(values) for _ in range(3))] for i in range(300)]
    text = io.StringIO()
    csv.writer(text, lineterminator="\n").writerows([["id", "a", "b", "c"], *rows])
    path = write(tmp_path / "x.csv", text.getvalue().replace("\n17,", "\n\n17,"))
    before = small_blocks(spark, size)
    try:
        found = csv_source.read_csv(spark, path)
        assert spark.read.text(path).rdd.getNumPartitions() > 10
        got = {r.id: r for r in found.collect()}
        numbers = {r.id: r.row_num for r in csv_source.row_numbers(found, found).collect()}
        assert csv_source.row_count(spark, path) == 300
    finally:
        large_blocks(spark, before)
    assert len(got) == 300 and all(r._error is None for r in got.values())
    assert [[i, *(got[i][c] for c in "abc")] for i in map(str, range(300))] == [[v.strip() for v in r] for r in rows]
    assert all(numbers[str(i)] == i + 1 for i in range(300))


@pytest.mark.parametrize(
    ("line", "outside", "inside"),
    [
        ("a,b", False, True),
        ('a,"b', True, False),
        ('a,"b"', False, False),  # from inside the first quote closes, the rest runs to the line's end
        ('5" pipe,3', False, False),  # a quote inside an unquoted value is a character
        ('"say ""hi""",x', False, False),
        ('b","c', True, True),
        ('b"" c', False, True),
        ("", False, True),
    ],
)
def test_line_states(line, outside, inside):
    assert (records.inside_after(line, False), records.inside_after(line, True)) == (outside, inside)


def test_one_task_reading_agrees(spark, tmp_path):
    text = 'a,b\n1,5" pipe\n2,"x"y\n3,"p\nq"\n\n4,"no ""end"\n5,z\n'
    path = write(tmp_path / "x.csv", text)
    options = {"header": True, "multiLine": True, "escape": '"'}
    expected = {(r.a, r.b) for r in spark.read.options(**options).csv(path).collect()}
    before = small_blocks(spark, 8)
    try:
        assert {(r.a, r.b) for r in csv_source.read_csv(spark, path).collect()} == expected
    finally:
        large_blocks(spark, before)


def test_wrong_suffix_and_missing_file(spark, tmp_path):
    with pytest.raises(ValueError):
        csv_source.read_csv(spark, str(tmp_path / "x.txt"))
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        csv_source.read_csv(spark, str(tmp_path / "none.csv"))


def test_routes(spark, tmp_path):
    for name in ("olist_sellers_dataset.csv", "unknown.csv"):
        write(tmp_path / name, "a\n1\n")
    write(tmp_path / "notes.txt", "x")
    found = {r.file_name: r.entity_type for r in csv_source.route_files(spark, str(tmp_path)).collect()}
    assert found == {"olist_sellers_dataset.csv": "seller", "unknown.csv": None}
    with pytest.raises(ValueError):
        csv_source.route_file("unknown.csv")


def test_row_numbers_over_part_files(spark, tmp_path):
    folder = tmp_path / "olist_sellers_dataset.csv"
    folder.mkdir()
    for part in range(3):
        write(folder / f"part-{part}.csv", "a,b\n" + "".join(f"{part},{i}\n" for i in range(5)))
    landed = csv_source.read_csv(spark, str(folder))
    numbered = csv_source.row_numbers(landed, landed.where("b = '3'")).collect()
    assert len(numbered) == 3 and {r.row_num for r in numbered} == {4}


def test_row_numbers_of_a_split_file(spark, tmp_path):
    path = write(tmp_path / "x.csv", "a,b\n" + "".join(f"{i},{'x' * (i % 40)}\n" for i in range(1, 4001)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
    try:
        split = csv_source.read_csv(spark, path, multiline=False)
        assert split.rdd.getNumPartitions() > 4
        split.write.parquet(str(tmp_path / "landed"))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    landed = spark.read.parquet(str(tmp_path / "landed"))
    numbered = csv_source.row_numbers(landed, landed)
    assert numbered.count() == 4000 and numbered.where("row_num <> CAST(a AS INT)").isEmpty()


def test_ingest_publishes_rejects_and_audits(spark, tmp_path):
    data, topics = tmp_path / "data", str(tmp_path / "topics")
    data.mkdir()
    names = ENTITIES["order"].columns
    good = ["o1", "c1", "delivered", "2024-01-01 00:00:00", "", "", "", "2024-02-01 00:00:00"]
    odd = ["o2", "c2", "lost", "yesterday", "", "", "", "2024-02-01 00:00:00"]
    lines = [",".join(r) for r in (names, good, odd, [*good, "EXTRA"])]
    write(data / ENTITIES["order"].csv_file, "\n".join(lines) + "\n")
    write(data / ENTITIES["product_category"].csv_file, HEADER + "perfumaria,perfumery\n")
    write(data / "unknown.csv", "a\n1\n")

    run = ingest(
        spark,
        str(data),
        topics,
        str(tmp_path / "landing"),
        str(tmp_path / "audit"),
        "run-1",
        contracts={"order": ORDER_CONTRACT},
    )
    assert run.skipped == ["unknown.csv"]
    assert sorted((e, p, f) for _, e, p, f in run.counts) == [
        ("order", 1, 2),
        ("product_category", 1, 0),
    ]
    total = {r.file_name: (r.produced, r.failed) for r in run.summary(spark).collect()}
    assert total["TOTAL"] == (2, 2)

    messages = read_topics(spark, topics, streaming=False).collect()
    assert sorted(m.key for m in messages) == ["o1", "perfumaria"]
    body = json.loads(next(m.value for m in messages if m.key == "o1"))
    digest = hashlib.sha256(json.dumps(body["payload"], sort_keys=True).encode()).hexdigest()
    assert body["metadata"]["checksum"] == digest
    assert body["payload"]["order_approved_at"] == ""
    assert body["metadata"]["event_type"] == "olist.order.created"

    letters = [
        json.loads(r.value)
        for r in read_topics(spark, topics, ["ecommerce.dlq.v1"], streaming=False).collect()
    ]
    assert sorted(x["row_num"] for x in letters) == [2, 3]
    reason = next(x["error"] for x in letters if x["row_num"] == 2)
    assert "order_status: value not accepted" in reason
    assert "order_purchase_timestamp: not a timestamp" in reason

    audit = {r.entity_type: r for r in read_audit(spark, str(tmp_path / "audit")).collect()}
    assert audit["order"].status == "partial" and audit["product_category"].status == "success"
    assert audit["order"].error_message == "2 of 3 rows went to the dead letters"


def test_checksum_equals_json_library(spark):
    rows = [
        ('café "q"', "tab\there \\ back"),
        ("literal \\u00E3 and \\\\u00AB", "del\x7f one\x01 break\n return\r"),
        (None, "emoji \U0001f600 /slash"),
        ("", "'x'"),
    ]
    df = spark.createDataFrame(rows, "b string, a string")
    wrapped = envelope.wrap(df, "seller", columns=["b", "a"])
    got = {r.payload.a: r.metadata.checksum for r in wrapped.collect()}
    for b, a in rows:
        text = json.dumps({"a": a, "b": b}, sort_keys=True)
        assert got[a] == hashlib.sha256(text.encode()).hexdigest()
    checked = envelope.verify(wrapped)
    assert checked.where("checksum_ok").count() == 4
    broken = wrapped.withColumn("payload", F.col("payload").withField("a", F.lit("x")))
    assert envelope.verify(broken).where("NOT checksum_ok").count() == 4


def test_event_ids_are_stable(spark):
    df = spark.createDataFrame([("s1",), ("s1",)], "seller_id string").withColumn(
        "row", F.monotonically_increasing_id()
    )

    def ids(**options):
        wrapped = envelope.wrap(df, "seller", columns=["seller_id"], **options)
        return sorted(r[0] for r in wrapped.select("metadata.event_id").collect())

    assert ids(identity=["row"]) == ids(identity=["row"])
    assert len(set(ids(identity=["row"]))) == 2
    assert len(set(ids())) == 1
    assert ids(random_ids=True) != ids(random_ids=True)


def test_keys(spark):
    df = spark.createDataFrame([("o1", "1"), ("", ""), ("", "2")], "order_id string, order_item_id string")
    wrapped = envelope.wrap(df, "order_item", columns=["order_id", "order_item_id"])

    def keys(compat):
        return [
            r.k or "" for r in wrapped.select(
                envelope.message_key(wrapped, "order_item", compat).alias("k")).collect()
        ]

    assert keys(False)[0] == "o1|1" and keys(False)[2] == "|2" and len(keys(False)[1]) == 64
    assert keys(True)[0] == "1"


def test_bad_messages_are_split_off(spark):
    good = '{"metadata": {"event_id": "e1"}, "payload": {"a": "1", "b": null}}'
    df = spark.createDataFrame([(good,), ("{broken",), ("",), (None,)], "value string")
    ok, bad = envelope.split(envelope.parse(df))
    assert ok.count() == 1 and bad.count() == 3
    assert ok.first().payload == {"a": "1", "b": None}


def test_unpack_shapes(spark):
    both = spark.sql("SELECT struct('e' AS event_id) metadata, struct('x' AS a) payload")
    assert envelope.unpack(both).columns == ["a", "event_id"]
    assert envelope.unpack(both.drop("metadata")).columns == ["a"]
    assert envelope.unpack(both.select("payload.a")).columns == ["a"]


def test_mapping_and_typed_events(spark):
    raw = spark.createDataFrame(
        [("u1", "9.5", "2024-01-01", "x"), ("u2", "bad", "2024-01-01", "x")],
        "user_id string, price string, timestamp string, other string",
    )
    from orebed.catalog import LEGACY_FIELD_MAP

    mapped = envelope.map_fields(raw, LEGACY_FIELD_MAP)
    assert mapped.columns == ["id", "product_id", "amount", "created_at"]
    typed = {r.id: r for r in envelope.typed_event(mapped.fillna("p", ["product_id"])).collect()}
    assert typed["u1"].status == "NEW" and typed["u1"].is_valid and typed["u1"].amount == 9.5
    assert not typed["u2"].is_valid


def test_dead_letter_with_envelope(spark):
    df = spark.createDataFrame([("s1",)], "seller_id string")
    wrapped = envelope.wrap(df, "seller", columns=["seller_id"])
    row = envelope.dead_letters_enveloped(wrapped, F.lit("broker said no")).first()
    body = json.loads(row.value)
    assert body["original_topic"] == ENTITIES["seller"].topic
    assert body["envelope"]["payload"] == {"seller_id": "s1"}


def test_event_ids_do_not_depend_on_splits(spark, tmp_path):
    folder = tmp_path / "olist_sellers_dataset.csv"
    folder.mkdir()
    for part in range(3):
        lines = [f"s{part}-{i},01000,city,SP" for i in range(400)]
        (folder / f"part-{part}.csv").write_text("\n".join(["seller_id,seller_zip_code_prefix,seller_city,seller_state", *lines]) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    found = []
    for i, size in enumerate(("64m", "4k")):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            ingest(spark, str(tmp_path), str(tmp_path / f"topics{i}"), str(tmp_path / f"landing{i}"), run_id=f"r{i}")
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        sent = envelope.parse(read_topics(spark, str(tmp_path / f"topics{i}"), streaming=False))
        found.append({r[0] for r in sent.select("metadata.event_id").collect()})
    assert len(found[0]) == 1200 and found[0] == found[1]


def test_messages_too_large_are_dead_letters(spark, tmp_path):
    data = tmp_path / "data"
    data.mkdir()
    header = "seller_id,seller_zip_code_prefix,seller_city,seller_state\n"
    (data / "olist_sellers_dataset.csv").write_text(header + f"s1,1,{'x' * 5000},SP\ns2,1,city,SP\n")
    path, topics = str(data / "olist_sellers_dataset.csv"), str(tmp_path / "topics")
    assert ingest_file(spark, path, topics, str(tmp_path / "landing"), "r", max_message_bytes=4000)[2:] == (1, 1)
    letter = read_topics(spark, topics, ["ecommerce.dlq.v1"], streaming=False).first()
    assert json.loads(letter.value)["envelope"]["payload"]["seller_id"] == "s1"
