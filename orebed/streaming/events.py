"""Event-time operators: idempotent events and live hourly throughput."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from orebed.streaming.bronze import BACKFILL


def dedup_events(parsed: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Drop repeated event ids that arrive within the watermark delay of each other.

    Unreadable messages have no event id: they are left out here and belong in the quarantine
    (``land_bronze`` puts them there), so that none of them stands for the others.
    """
    return (
        parsed.where(F.col("error").isNull() & F.col("metadata.event_id").isNotNull())
        .withColumn("event_id", F.col("metadata.event_id"))
        .withColumn("ingested_at", F.col("metadata.ingested_at").try_cast("timestamp"))
        .withWatermark("ingested_at", delay)
        .dropDuplicatesWithinWatermark(["event_id"])
    )


def hourly_totals(
    audit: DataFrame, time: str = "finished_at", delay: str = "2 hours"
) -> DataFrame:
    """Rows per hour and entity; hours older than the watermark are closed."""
    return (
        audit.withWatermark(time, delay)
        .groupBy(F.window(time, "1 hour").alias("window"), "entity_type")
        .agg(F.sum("rows_processed").alias("total_rows"))
        .select(F.col("window.start").alias("hour"), "entity_type", "total_rows")
    )


def publish_totals(
    totals: DataFrame, path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Append every changed total under its batch; a repeated batch replaces its rows."""

    def write(batch: DataFrame, batch_id: int) -> None:
        (
            batch.withColumn("batch", F.lit(batch_id))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch")
            .parquet(path)
        )

    return (
        totals.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or BACKFILL))
        .foreachBatch(write)
        .start()
    )


def read_totals(spark: SparkSession, path: str) -> DataFrame:
    """Current total per hour and entity: the one of the newest batch."""
    return (
        spark.read.parquet(path)
        .groupBy("hour", "entity_type")
        .agg(F.max_by("total_rows", "batch").alias("total_rows"))
    )
