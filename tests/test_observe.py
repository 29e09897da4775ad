"""Alerts, anomalies, schema changes, lineage and cost on hand-written series."""

from __future__ import annotations

from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from orebed.operators import observe
from orebed.sinks.audit import append_audit, audit_row, read_audit, status_of

T0 = datetime(2024, 1, 1, 23, 58)


def series(topic, lags, step=15, start=T0):
    return [
        (start + timedelta(seconds=step * i), "g", topic, lag)
        for i, lag in enumerate(lags)
        if lag is not None
    ]


def breaches(spark, rows, **options):
    df = spark.createDataFrame(rows, "ts timestamp, consumergroup string, topic string, lag bigint")
    found = observe.sustained_breach(df, **options).collect()
    return {(r.topic, r.started_at): (r.ended_at, r.samples, r.peak) for r in found}


@pytest.mark.parametrize("chunk", [86_400, 60, 15])
def test_lag_alert_cases(spark, chunk):
    quiet = series("quiet", [2000] * 20)  # 4 min 45 s
    fires = series("fires", [0, 0] + [1500] * 20 + [3000] + [0, 0])  # 5 min
    gap = series("gap", [2000] * 12 + [None] * 6 + [2000] * 12)
    dip = series("dip", [2000] * 12 + [10] + [2000] * 12)
    edge = series("edge", [1000] * 40)
    found = breaches(spark, quiet + fires + gap + dip + edge, chunk_seconds=chunk)
    start = T0 + timedelta(seconds=30)
    assert found == {("fires", start): (start + timedelta(minutes=5), 21, 3000)}


@pytest.mark.parametrize("chunk", [40, 86_400])
def test_alert_equals_a_plain_loop(spark, chunk):
    rng = np.random.default_rng(3)
    rows, expected = [], {}
    for topic in map(str, range(6)):
        lags = [
            None if rng.random() < 0.15 else int(rng.choice([500, 1500], p=[0.1, 0.9]))
            for _ in range(300)
        ]
        own = series(topic, lags)
        rows += own
        run = []
        for row in [*own, (None, None, None, 0)]:
            late = bool(run) and row[0] is not None and row[0] - run[-1][0] > timedelta(seconds=30)
            if run and (row[3] <= 1000 or late):
                if run[-1][0] - run[0][0] >= timedelta(seconds=60):
                    expected[topic, run[0][0]] = (run[-1][0], len(run), max(r[3] for r in run))
                run = []
            if row[3] > 1000:
                run.append(row)
    assert expected
    assert breaches(spark, rows, hold_seconds=60, max_gap_seconds=30, chunk_seconds=chunk) == expected


def test_lag_is_summed_over_partitions(spark):
    df = spark.createDataFrame(
        [(T0, "g", "t", 0, 600), (T0, "g", "t", 1, 500)],
        "ts timestamp, consumergroup string, topic string, partition int, lag bigint",
    )
    assert observe.lag_sum(df).first().lag == 1100


def test_volume_anomaly(spark):
    rows = [("e", i, 100 + i % 2) for i in range(20)] + [("e", 20, 500), ("short", 1, 5)]
    df = spark.createDataFrame(rows, "entity string, day int, n bigint")
    found = observe.volume_anomalies(df, ["entity"]).collect()
    assert [r.day for r in found] == [20]
    window = [100 + i % 2 for i in range(6, 20)]
    expected = (500 - np.mean(window)) / np.std(window, ddof=1)
    assert found[0].z_score == pytest.approx(expected)


def test_schema_changes(spark):
    before = observe.schema_snapshot(spark.createDataFrame([], "a int, b string, c int"))
    after = observe.schema_snapshot(spark.createDataFrame([], "a bigint, b string, d int"))
    found = {r.column: (r.change, r.old_type, r.new_type) for r in observe.schema_changes(before, after).collect()}
    assert found == {
        "a": ("retyped", "int", "bigint"),
        "c": ("removed", "int", None),
        "d": ("added", None, "int"),
    }


def test_observed_fields(spark):
    df = spark.createDataFrame(
        [({"a": "1", "b": "1.5", "c": "2024-01-01"},), ({"a": "2", "b": "1", "c": "x", "d": None},)],
        "p map<string,string>",
    )
    found = {r.column: r.type for r in observe.observed_fields(df, "p").collect()}
    assert found == {"a": "integer", "b": "numeric", "c": "string"}


def test_kinds_of_odd_texts_are_those_of_the_casts(spark):
    """Texts that are not cast, because they surely fail, are told as the casts tell them."""
    texts = ["", " ", ".", "-", "1", " 7 ", "\x7f7", "7\x7f", "+5", "1.", "1.5", "1e3", "A", "a1", "~", "é", "nan", "Infinity", "0x10"]
    texts += ["12:30", ":1", "T12:30", "T12", "2024", "0999", "999", "-290308", "-290309", "-294248", "-9223372036854775808"]
    texts += ["294247", "294248", "+294248", "999999", "1000000", "20240101", "2024-01", "2024-01-01 10:00:00", "9" * 19, "1000000-01-01", "300000.5"]
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "g string, t string")
    found = observe.field_proofs(df.select("g", F.create_map(F.lit("t"), "t").alias("p")), "p", "g").drop("column")
    casts = {"_integer": "bigint", "_number": "double", "_time": "timestamp"}
    plain = df.select("g", *[F.col("t").try_cast(k).isNotNull().alias(n) for n, k in casts.items()])
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, plain.collect()))


def test_fields_of_all_rows_follow_from_those_of_groups(spark):
    rows = [("a", "2001"), ("a", "2002"), ("b", "2001-01-01"), (None, "2003"), (None, None)]
    df = spark.createDataFrame(rows, "g string, t string").select("g", F.create_map(F.lit("t"), "t").alias("p"))
    proofs = observe.field_proofs(df, "p", "g")
    assert [tuple(r) for r in observe.kinds(proofs).collect()] == [("t", "timestamp")]
    assert {tuple(r) for r in observe.kinds(proofs, "g").collect()} == {("a", "t", "integer"), ("b", "t", "timestamp"), (None, "t", "integer")}


@pytest.mark.parametrize("chunk", [10, 25, 86_400])
def test_result_history(spark, chunk):
    rng = np.random.default_rng(5)
    rows, expected = [], {}
    for test in map(str, range(12)):
        own = [str(rng.choice(["fail", "pass"], p=[0.7, 0.3])) for _ in range(int(rng.integers(1, 12)))]
        if test == "0":
            own = ["fail"] * 9
        rows += [(test, s, T0 + timedelta(seconds=7 * i)) for i, s in enumerate(own)]
        streak = len(own) if "pass" not in own else own[::-1].index("pass")
        expected[test] = (own[-1], len(own), own.count("fail"), streak)
    df = spark.createDataFrame(rows, "test string, status string, run_at timestamp")
    found = observe.result_history(df, ["test"], chunk_seconds=chunk).collect()
    assert {
        r.test: (r.last_status, r.runs, r.failed_runs, r.failure_streak) for r in found
    } == expected


def test_ancestors(spark):
    edges = [("d", "c"), ("c", "b"), ("b", "a"), ("d", "a"), ("x", "y")]
    df = spark.createDataFrame(edges, "output string, input string")
    found = {(r.output, r.input): r.depth for r in observe.ancestors(df).collect()}
    assert found == {
        ("d", "c"): 1, ("c", "b"): 1, ("b", "a"): 1, ("d", "a"): 1, ("x", "y"): 1,
        ("d", "b"): 2, ("c", "a"): 2,
    }


def test_cycles_end(spark):
    df = spark.createDataFrame([("a", "b"), ("b", "a")], "output string, input string")
    found = {(r.output, r.input): r.depth for r in observe.ancestors(df).collect()}
    assert found == {("a", "b"): 1, ("b", "a"): 1, ("a", "a"): 2, ("b", "b"): 2}


def test_costs(spark):
    df = spark.createDataFrame([("q", "A", "cold", 3600.0, 10**12)], "query string, platform string, run string, seconds double, bytes bigint")
    row = observe.cost_estimate(df).first()
    assert (row.scan_usd, row.compute_usd) == (5.0, 3.0)
    assert (row.scan_usd_per_million, row.compute_usd_per_million) == (5e6, 3e6)
    assert observe.compare_runs(df).first().warm_seconds is None


def test_audit_rows(spark, tmp_path):
    assert [status_of(1, 0), status_of(1, 1), status_of(0, 1)] == ["success", "partial", "failed"]
    path = str(tmp_path / "audit")
    for n in (0, 1):
        append_audit(spark, [audit_row("r", "spark", "order", 5, n, T0, T0 + timedelta(hours=1))], path)
    log = read_audit(spark, path)
    assert observe.throughput(log).first().total_rows == 10
    assert {r.status: r.share for r in observe.runs_by_status(log).collect()} == {"success": 0.5, "partial": 0.5}
    assert observe.run_history(log, "spark").first().duration_seconds == 3600
    late = observe.freshness(log, "finished_at", T0 + timedelta(hours=3), 3600, "entity_type").first()
    assert late.age_seconds == 7200 and not late.is_fresh


def test_anomalies_among_large_volumes(spark):
    days = [(f"2024-01-{d:02d}", 10**12 + (1000 if d == 20 else d % 3 - 1)) for d in range(1, 25)]
    df = spark.createDataFrame([("s", d, n) for d, n in days], "s string, day string, n bigint")
    assert [r.day for r in observe.volume_anomalies(df, ["s"]).where("n > 1000000000500").collect()] == ["2024-01-20"]
