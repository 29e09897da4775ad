"""Ranks, percentiles and moving averages against brute force, on skewed data."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from orebed.operators import ordered


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows in one group, a third of one group's values equal, NULLs."""
    rng = np.random.default_rng(7)
    rows = []
    for i in range(6000):
        group = "hot" if i % 3 == 0 else f"g{rng.integers(0, 6)}"
        value = 5 if i % 9 == 0 else int(rng.integers(-500, 500))
        rows.append((i, group if i % 50 else None, None if i % 11 == 0 else value))
    rows += [(9000 + i, "empty", None) for i in range(5)] + [(9999, "single", 3)]
    return spark.createDataFrame(rows, "id int, g string, v int").repartition(8).cache()


def test_percentiles(skewed):
    metrics = {"p50": ("v", 0.5), "p90": ("v", 0.9), "p0": ("v", 0.0), "p100": ("id", 1.0)}
    found = {
        r.g: r for r in ordered.exact_percentiles(skewed, ["g"], metrics).collect()
    }
    data = skewed.toPandas()
    groups = data.groupby("g", dropna=False)
    assert len(found) == groups.ngroups
    for key, frame in groups:
        row = found[key if isinstance(key, str) else None]
        for alias, (column, p) in metrics.items():
            values = frame[column].dropna().to_numpy(float)
            if len(values) == 0:
                assert row[alias] is None
            else:
                assert row[alias] == pytest.approx(np.percentile(values, p * 100), abs=1e-9)


def test_approximate_percentiles_are_values_near_the_rank(skewed):
    metrics = {"p50": ("v", 0.5)}
    data = skewed.toPandas()
    for r in ordered.approximate_percentiles(skewed, ["g"], metrics).collect():
        own = data[data["g"].isna() if r.g is None else data["g"] == r.g]["v"].dropna()
        if len(own):
            assert r.p50 in set(own)
            assert (own < r.p50).mean() <= 0.5 <= (own <= r.p50).mean()


def test_dense_rank(skewed):
    found = ordered.dense_rank_all(skewed, "v", "r").collect()
    values = sorted({r.v for r in found if r.v is not None}, reverse=True)
    expected = {v: i + 1 for i, v in enumerate(values)}
    expected[None] = len(values) + 1
    assert len(found) == skewed.count()
    assert all(r.r == expected[r.v] for r in found)


def test_top_by_rank(skewed):
    top = ordered.top_by_rank(skewed.where("v IS NOT NULL"), "v", "id", 300, "r").collect()
    everything = ordered.dense_rank_all(skewed.where("v IS NOT NULL"), "v", "r").collect()
    expected = sorted((r.r, r.id) for r in everything)[:300]
    assert sorted((r.r, r.id) for r in top) == expected


def test_large_groups_never_meet_in_one_task(skewed):
    """The distributed forms plan no exchange to a single partition over rows."""
    df = skewed.groupBy("id").agg(F.max("v").alias("v"))
    ranked = ordered.dense_rank_all(df, "v", "r")
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    single = [line for line in plan.splitlines() if "Exchange SinglePartition" in line]
    # Only the range starts, one row per shuffle partition.
    assert len(single) <= 1


def test_moving_average_by_rows_and_days(spark):
    rows = [("2024-01-01", 10), ("2024-01-02", 20), ("2024-02-15", 60), ("2024-02-16", 90)]
    df = spark.createDataFrame(rows, "d string, v int").select(F.to_date("d").alias("d"), "v")
    by_rows = ordered.moving_average(df, "d", "v", "m", rows=3).orderBy("d")
    assert [r.m for r in by_rows.collect()] == [10, 15, 30, pytest.approx(170 / 3)]
    by_days = ordered.moving_average(df, "d", "v", "m", days=30).orderBy("d")
    assert [r.m for r in by_days.collect()] == [10, 15, 60, 75]
    with pytest.raises(ValueError):
        ordered.moving_average(df, "d", "v", "m")


@pytest.mark.parametrize("values", [[1e-10, 3e-10, 5e-10], [1e200, 3e200, 5e200], [-1e30, 0.5, 1e30]])
def test_percentiles_keep_the_type_of_the_values(spark, values):
    df = spark.createDataFrame([("a", v, i) for i, v in enumerate(values)], "g string, v double, i int")
    row = ordered.exact_percentiles(df, ["g"], {"p50": ("v", 0.5), "p25": ("v", 0.25), "n": ("i", 0.5)}).first()
    assert (row.p50, row.n) == (values[1], 1.0)
    assert row.p25 == pytest.approx(np.percentile(values, 25), rel=1e-12)


def test_discrete_percentiles_are_the_values_at_their_rank(spark):
    # Far more distinct values than the sketch tells apart; 0.9 of 30 as a double is above 27.
    rows = spark.range(60_000).select(
        F.when(F.col("id") < 30, "small").otherwise("large").alias("g"),
        ((F.col("id") * 7919) % 60_013).cast("decimal(38,9)").alias("v"),
    )
    metrics = {"p50": ("v", 0.5), "p90": ("v", 0.9), "p0": ("v", 0.0), "p100": ("v", 1.0)}
    data = rows.toPandas()
    found = ordered.exact_percentiles(rows, ["g"], metrics, accuracy=200, discrete=True)
    assert found.schema["p50"].dataType == rows.schema["v"].dataType
    for r in found.collect():
        own = sorted(data[data["g"] == r.g]["v"])
        for alias, tenths in (("p50", 5), ("p90", 9), ("p0", 0), ("p100", 10)):
            assert r[alias] == own[max(-(-len(own) * tenths // 10) - 1, 0)]


def test_discrete_percentiles_of_nulls(skewed):
    for r in ordered.exact_percentiles(skewed, ["g"], {"p50": ("v", 0.5)}, discrete=True).collect():
        own = sorted(x.v for x in skewed.where(F.col("g").eqNullSafe(F.lit(r.g))).collect() if x.v is not None)
        assert r.p50 == (own[-(-len(own) // 2) - 1] if own else None)
