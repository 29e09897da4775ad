"""Topics to Bronze with Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from orebed.operators.envelope import parse
from orebed.session import open_writers

#: One batch after the other; the source decides when there is enough for one (`flush_options`).
FLUSH = {"processingTime": "0 seconds"}
BACKFILL = {"availableNow": True}
MAX_RECORDS = 500_000


def write_batch(parsed: DataFrame, batch: str, root: str, quarantine: str, compression: str = "none") -> None:
    """Write one batch of parsed messages.

    Good messages go, unchanged, to ``entity=/year=/month=/day=/batch=``, unreadable
    ones to the quarantine. The batch name is the innermost folder and only the
    batch's own folders are replaced, so a batch written again after a crash
    leaves the same files. Files are bounded, as compressed ones are not split; the text is not sorted by folder, whose number a batch's days bound.
    """
    parsed = parsed.withColumn("batch", F.lit(batch))
    ingested = F.coalesce(F.col("metadata.ingested_at").try_cast("timestamp"), F.col("timestamp"))
    good = parsed.where(F.col("error").isNull()).select(
        "value",
        F.col("metadata.entity_type").alias("entity"),
        F.date_format(ingested, "yyyy").alias("year"),
        F.date_format(ingested, "MM").alias("month"),
        F.date_format(ingested, "dd").alias("day"),
        "batch",
    )
    bad = parsed.where(F.col("error").isNotNull()).select("topic", "key", "value", "error", "batch")

    def replace(df: DataFrame, *folders: str):
        # Digits of ids and checksums repeat by chance only: their short matches cost gzip more than they save.
        return (
            df.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("maxRecordsPerFile", MAX_RECORDS)
            .option("zlib.compress.strategy", "FILTERED")
            .option("compression", compression)
            .partitionBy(*folders)
        )

    with open_writers(parsed.sparkSession):
        replace(good, "entity", "year", "month", "day", "batch").text(root)
        replace(bad, "batch").json(quarantine)


def land_bronze(
    messages: DataFrame,
    root: str,
    quarantine: str,
    checkpoint: str,
    group: str = "gcs-bronze",
    trigger: dict | None = None,
    compression: str = "none",
) -> StreamingQuery:
    """One query for all topics. Offsets are committed after both writes are done.

    A new ``group`` with a new checkpoint replays everything into folders of its own.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        # Read twice rather than kept: the parsed text of a batch takes more room than its source.
        write_batch(batch, f"{group}-{batch_id:09d}", root, quarantine, compression)

    return (
        parse(messages)
        .writeStream.queryName(f"{group}-land")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or FLUSH))
        .foreachBatch(write)
        .start()
    )


def compact(source: DataFrame, target: str, max_records: int = 1_000_000) -> None:
    """Rewrite the small files of landed Bronze into few large ones.

    ``source`` is Bronze text with its partition columns, such as one day of it.
    Rows are spread over all tasks by AQE's rebalance, so a hot entity is split.
    """
    (
        source.drop("batch")
        .hint("rebalance", "entity", "year", "month", "day")
        .write.mode("overwrite")
        .option("maxRecordsPerFile", max_records)
        .partitionBy("entity", "year", "month", "day")
        .text(target)
    )
