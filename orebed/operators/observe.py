"""Observability: audit reports, lag, alerts, anomalies, freshness, lineage, costs."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import count

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orebed.operators.ordered import exact_percentiles
from orebed.session import durable

# Alert threshold and hold time, prices of scanned data and compute.
LAG_THRESHOLD = 1000
LAG_HOLD_SECONDS = 300
USD_PER_TB = 5.0
USD_PER_HOUR = 3.0


def between(df: DataFrame, column: str, start=None, end=None) -> DataFrame:
    """Time range filter, start inclusive and end exclusive; open where None."""
    if start is not None:
        df = df.where(F.col(column) >= F.lit(start).cast("timestamp"))
    if end is not None:
        df = df.where(F.col(column) < F.lit(end).cast("timestamp"))
    return df


def run_status(processed: str = "rows_processed", failed: str = "rows_failed") -> Column:
    return (
        F.when(F.col(failed) == 0, "success")
        .when(F.col(processed) > 0, "partial")
        .otherwise("failed")
    )


def run_totals(audit: DataFrame, *by: str) -> DataFrame:
    """Rows processed and failed per run with the resulting status."""
    return (
        audit.groupBy(*by)
        .agg(
            F.sum("rows_processed").alias("rows_processed"),
            F.sum("rows_failed").alias("rows_failed"),
        )
        .withColumn("status", run_status())
    )


def throughput(audit: DataFrame, start=None, end=None) -> DataFrame:
    """Rows per hour and entity."""
    return (
        between(audit, "finished_at", start, end)
        .groupBy(F.date_trunc("hour", "finished_at").alias("hour"), "entity_type")
        .agg(F.sum("rows_processed").alias("total_rows"))
    )


def runs_by_status(audit: DataFrame, *by: str, start=None, end=None) -> DataFrame:
    """Runs per status and their share, within each group of ``by``."""
    counted = (
        between(audit, "started_at", start, end)
        .groupBy(*by, "status")
        .agg(F.count("run_id").alias("total_runs"))
    )
    total = F.sum("total_runs").over(Window.partitionBy(*by))
    return counted.withColumn("share", F.col("total_runs") / total)


def run_history(audit: DataFrame, stage: str = "dbt", start=None, end=None) -> DataFrame:
    """Runs of one stage with their duration, newest first."""
    seconds = F.timestamp_diff("SECOND", F.col("started_at"), F.col("finished_at"))
    return (
        between(audit, "started_at", start, end)
        .where(F.col("pipeline_stage") == stage)
        .orderBy(F.desc("started_at"))
        .select("run_id", "entity_type", seconds.alias("duration_seconds"), "status", "started_at")
    )


def lag_sum(samples: DataFrame, time: str | Column = "ts") -> DataFrame:
    """Lag over all partitions of a topic, per group and sample time."""
    moment = F.col(time) if isinstance(time, str) else time
    return samples.groupBy(moment.alias("ts"), "consumergroup", "topic").agg(
        F.sum("lag").alias("lag")
    )


def sustained_breach(
    samples: DataFrame,
    threshold: float = LAG_THRESHOLD,
    hold_seconds: int = LAG_HOLD_SECONDS,
    max_gap_seconds: int = 60,
    by: Sequence[str] = ("consumergroup", "topic"),
    value: str = "lag",
    chunk_seconds: int = 86_400,
) -> DataFrame:
    """Periods in which a series stays above the threshold for at least the hold time.

    A lower sample or a gap longer than ``max_gap_seconds`` ends a period. Needs
    one row per series and time. A series is cut into time chunks that are worked
    on independently; periods that touch a chunk border are then joined, using one
    row per chunk, so a long series does not end up in one task.
    """
    by = list(by)
    seconds = F.unix_micros("ts") / 1e6
    df = samples.select(
        *by,
        "ts",
        F.col(value).alias("_value"),
        (F.col(value) > threshold).alias("_high"),
        F.floor(seconds / chunk_seconds).alias("_chunk"),
    )
    in_chunk = Window.partitionBy(*by, "_chunk").orderBy("ts")
    gap = (F.unix_micros("ts") - F.unix_micros(F.lag("ts").over(in_chunk))) > max_gap_seconds * 10**6
    begins = F.col("_high") & (
        F.lag("_high").over(in_chunk).isNull() | ~F.lag("_high").over(in_chunk) | gap
    )
    marked = df.withColumn("_begins", begins.cast("int")).withColumns(
        {
            "_first": F.row_number().over(in_chunk) == 1,
            "_last": F.lead("ts").over(in_chunk).isNull(),
            "_period": F.sum("_begins").over(in_chunk),
        }
    )
    keys = [*by, "_chunk"]
    # One row per chunk and one per period in a chunk.
    chunks = marked.groupBy(*keys).agg(
        F.max("ts").alias("_chunk_end"), F.max(F.when(F.col("_last"), F.col("_high"))).alias("_ends_high")
    )
    periods = (
        marked.where(F.col("_high"))
        .groupBy(*keys, "_period")
        .agg(
            F.min("ts").alias("started_at"),
            F.max("ts").alias("ended_at"),
            F.count("*").alias("samples"),
            F.max("_value").alias("peak"),
            F.max("_first").alias("_at_start"),
            F.max("_last").alias("_at_end"),
        )
    )
    series = Window.partitionBy(*by).orderBy("_chunk")
    previous = chunks.select(
        *keys,
        F.lag("_chunk_end").over(series).alias("_previous_end"),
        F.lag("_ends_high").over(series).alias("_previous_high"),
    )
    border = F.col("_at_start") | F.col("_at_end")
    inner = periods.where(~border).select(*by, "started_at", "ended_at", "samples", "peak")
    joined_gap = F.unix_micros("started_at") - F.unix_micros("_previous_end")
    continues = (
        F.col("_at_start")
        & F.coalesce("_previous_high", F.lit(False))
        & (joined_gap <= max_gap_seconds * 10**6)
    )
    # At most two border periods per chunk.
    pieces = Window.partitionBy(*by).orderBy("started_at")
    merged = (
        periods.where(border)
        .join(previous, keys, "left")
        .withColumn("_new", F.when(F.coalesce(continues, F.lit(False)), 0).otherwise(1))
        .withColumn("_run", F.sum("_new").over(pieces))
        .groupBy(*by, "_run")
        .agg(
            F.min("started_at").alias("started_at"),
            F.max("ended_at").alias("ended_at"),
            F.sum("samples").alias("samples"),
            F.max("peak").alias("peak"),
        )
        .drop("_run")
    )
    held = F.unix_micros("ended_at") - F.unix_micros("started_at") >= hold_seconds * 10**6
    return inner.unionByName(merged).where(held)


def volume_anomalies(
    daily: DataFrame,
    by: Sequence[str],
    day: str = "day",
    value: str = "n",
    window: int = 14,
    minimum: int = 7,
    limit: float = 2.0,
) -> DataFrame:
    """Days whose volume is more than ``limit`` standard deviations from the days before.

    Needs one row per series and day.
    """
    before = Window.partitionBy(*by).orderBy(day).rowsBetween(-window, -1)
    x = F.col(value).cast("double")
    # Spark updates mean and deviation value by value: large volumes do not cancel.
    seen = {"_k": F.count(value), "_mean": F.avg(x), "_spread": F.stddev_samp(x)}
    scored = (
        daily.withColumns({name: f.over(before) for name, f in seen.items()})
        .where((F.col("_k") >= minimum) & (F.col("_spread") > 0))
        .withColumn("z_score", (x - F.col("_mean")) / F.col("_spread"))
    )
    return scored.where(F.abs("z_score") > limit).drop(*seen)


def freshness(
    df: DataFrame, time: str, as_of, max_age_seconds: int, *by: str
) -> DataFrame:
    """Last load per group, its age at ``as_of`` and whether it is within the SLA."""
    moment = F.lit(as_of).cast("timestamp") if not isinstance(as_of, Column) else as_of
    return (
        df.groupBy(*by)
        .agg(F.max(time).alias("last_loaded_at"))
        .withColumn("age_seconds", F.timestamp_diff("SECOND", F.col("last_loaded_at"), moment))
        .withColumn("is_fresh", F.col("age_seconds") <= max_age_seconds)
    )


def schema_snapshot(df: DataFrame) -> DataFrame:
    """Columns and types of a table as rows."""
    rows = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    return df.sparkSession.createDataFrame(rows, "column string, type string")


_PROOFS = ("_integer", "_number", "_time")
# No timestamp has a year further from zero.
_LAST_YEAR = 294_247


def _integer(text: Column) -> Column:
    """The text as a whole number; a failed cast raises and catches an error, so texts that surely fail are not cast."""
    word = (text >= "A") & (text < "\x7f")  # by its first byte, which is neither digit nor sign nor blank
    return F.when(~(word | F.contains(text, F.lit(":"))), text.try_cast("bigint"))


def _is_time(text: Column) -> Column:
    # A whole number can only be a year: one beyond all timestamps is not cast, for the same reason.
    beyond = ~_integer(text).between(-_LAST_YEAR, _LAST_YEAR)
    return F.when(beyond, False).otherwise(text.try_cast("timestamp").isNotNull())


def field_proofs(payloads: DataFrame, payload: str, *by: str) -> DataFrame:
    """Fields that occur with a value in map payloads, and which types fit all their values.

    Proofs of several groups can be joined to those of a larger one by ``kinds``.
    """
    # The outer form adds no size filter that would compute the payload twice.
    pairs = payloads.select(*by, F.explode_outer(payload).alias("column", "_text")).where(
        F.col("_text").isNotNull()
    )
    text = F.col("_text")
    return pairs.groupBy(*by, "column").agg(
        F.every(_integer(text).isNotNull()).alias("_integer"),
        F.every(text.try_cast("double").isNotNull()).alias("_number"),
        F.every(_is_time(text)).alias("_time"),
    )


def kinds(proofs: DataFrame, *by: str) -> DataFrame:
    """The narrowest type that fits all values of a field in each group of ``by``."""
    counted = proofs.groupBy(*by, "column").agg(*[F.every(c).alias(c) for c in _PROOFS])
    kind = (
        F.when(F.col("_integer"), "integer")
        .when(F.col("_number"), "numeric")
        .when(F.col("_time"), "timestamp")
        .otherwise("string")
    )
    return counted.select(*by, "column", kind.alias("type"))


def observed_fields(payloads: DataFrame, payload: str, *by: str) -> DataFrame:
    """Fields that occur with a value in map payloads, and the narrowest type that fits them all."""
    return kinds(field_proofs(payloads, payload, *by), *by)


def schema_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """Columns added, removed or retyped between two ``(column, type)`` snapshots."""
    old = before.select("column", F.col("type").alias("old_type"))
    new = after.select("column", F.col("type").alias("new_type"))
    change = (
        F.when(F.col("old_type").isNull(), "added")
        .when(F.col("new_type").isNull(), "removed")
        .when(F.col("old_type") != F.col("new_type"), "retyped")
    )
    return (
        old.join(new, "column", "full").withColumn("change", change).where(F.col("change").isNotNull())
    )


def result_history(
    results: DataFrame, by: Sequence[str], time: str = "run_at", chunk_seconds: int = 86_400
) -> DataFrame:
    """Latest status per test, its runs and failures, and the current failure streak.

    The streak is the failures after the last pass. It is counted within time chunks
    first; a test then has one row per chunk, however often it ran.
    """
    by = list(by)
    failed = F.col("status") == "fail"
    chunk = F.floor(F.unix_timestamp(time) / chunk_seconds)
    within = Window.partitionBy(*by, "_chunk")
    last_pass = F.max(F.when(~failed, F.col(time))).over(within)
    trailing = failed & (F.col("_pass").isNull() | (F.col(time) > F.col("_pass")))
    chunks = (
        results.withColumn("_chunk", chunk)
        .withColumn("_pass", last_pass)
        .groupBy(*by, "_chunk")
        .agg(
            F.count("*").alias("_runs"),
            F.count_if(failed).alias("_failed"),
            F.max_by("status", time).alias("_status"),
            F.max(time).alias("_time"),
            F.count_if(trailing).alias("_trailing"),
            F.max(F.when(F.col("_pass").isNotNull(), F.col("_chunk"))).alias("_pass_chunk"),
        )
    )
    # One row per test and chunk from here on.
    whole = Window.partitionBy(*by)
    after = F.col("_last").isNull() | (F.col("_chunk") >= F.col("_last"))
    return (
        chunks.withColumn("_last", F.max("_pass_chunk").over(whole))
        .groupBy(*by)
        .agg(
            F.sum("_runs").alias("runs"),
            F.sum("_failed").alias("failed_runs"),
            F.max_by("_status", "_time").alias("last_status"),
            F.max("_time").alias("last_run_at"),
            F.sum(F.when(after, F.col("_trailing")).otherwise(0)).alias("failure_streak"),
        )
    )


def end_to_end_latency(df: DataFrame, ingested: str, loaded: str, *by: str) -> DataFrame:
    """Median and 95th percentile of the seconds from ingest to Gold."""
    seconds = F.timestamp_diff("SECOND", F.col(ingested), F.col(loaded))
    metrics = {"p50_seconds": ("_seconds", 0.5), "p95_seconds": ("_seconds", 0.95)}
    return exact_percentiles(df.select(*by, seconds.alias("_seconds")), by, metrics)


def ancestors(edges: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """All inputs an output depends on, directly or not, with the shortest distance.

    ``edges`` has ``output`` and ``input`` (and the ``by`` columns). Each round joins
    only the pairs found last, until there are none; a cycle ends too, as no pair is
    found twice. Rounds are as many as the longest chain. The frontier is written to shared storage, so plans do not grow with the rounds.
    """
    by = list(by)
    pair = [*by, "output", "input"]
    edges = edges.select(*pair).distinct()
    step = edges.select(*by, F.col("output").alias("input"), F.col("input").alias("_next"))
    frontier = durable(edges.withColumn("depth", F.lit(1)))
    found = [frontier]
    for depth in count(2):
        known = reduce(DataFrame.unionByName, found).select(*pair)
        frontier = durable(
            frontier.join(step, [*by, "input"])
            .select(*by, "output", F.col("_next").alias("input"))
            .distinct()
            .join(known, pair, "left_anti")
            .withColumn("depth", F.lit(depth))
        )
        if frontier.isEmpty():
            break
        found.append(frontier)
    return reduce(DataFrame.unionByName, found)


def compare_runs(log: DataFrame) -> DataFrame:
    """Cold and warm times side by side per query and platform, with bytes scanned."""
    measured = log.groupBy("query", "platform").pivot("run", ["cold", "warm"]).agg(
        F.sum("seconds").alias("sum"), F.count("seconds").alias("n")
    )
    scanned = log.groupBy("query", "platform").agg(F.max("bytes").alias("bytes_scanned"))
    return measured.join(scanned, ["query", "platform"]).select(
        "query",
        "platform",
        *[
            F.when(F.col(f"{r}_n") > 0, F.col(f"{r}_sum").cast("double") / F.col(f"{r}_n")).alias(
                f"{r}_seconds"
            )
            for r in ("cold", "warm")
        ],
        "bytes_scanned",
    )


def cost_estimate(
    log: DataFrame, usd_per_tb: float = USD_PER_TB, usd_per_hour: float = USD_PER_HOUR
) -> DataFrame:
    """Price of a run by bytes scanned and by time, and of a million such runs."""
    scan = F.col("bytes") / F.lit(1e12) * F.lit(usd_per_tb)
    compute = F.col("seconds").cast("double") / F.lit(3600.0) * F.lit(usd_per_hour)
    return log.withColumns(
        {
            "scan_usd": scan,
            "compute_usd": compute,
            "scan_usd_per_million": scan * 1e6,
            "compute_usd_per_million": compute * 1e6,
        }
    )
