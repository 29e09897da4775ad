"""Message sources: ``(topic, key, value, timestamp)`` streams and batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orebed.catalog import ENTITIES

MESSAGE_SCHEMA = "key string, value string, timestamp timestamp, topic string"


def flush_options(format: str, messages: int = 500, wait: str = "30s") -> dict[str, str]:
    """Size-or-time batching as source options.

    A broker source starts a batch as soon as ``messages`` are waiting, or after ``wait`` with
    any at all, and takes all that are there: nothing bounds the throughput. A folder source
    takes all new files at once.
    """
    return {"minOffsetsPerTrigger": str(messages), "maxTriggerDelay": wait} if format == "kafka" else {}


def read_topics(
    spark: SparkSession,
    source: str,
    topics: list[str] | None = None,
    format: str = "json",
    streaming: bool = True,
    **options,
) -> DataFrame:
    """All entity topics, or some, from their earliest message.

    Positions live in the checkpoint of the query that reads the stream, so a
    new checkpoint folder replays everything.
    """
    reader = spark.readStream if streaming else spark.read
    topics = topics or [e.topic for e in ENTITIES.values()]
    if format == "kafka":
        messages = (
            reader.format("kafka")
            .option("kafka.bootstrap.servers", source)
            .option("subscribe", ",".join(topics))
            .option("startingOffsets", "earliest")
            .options(**({**flush_options(format), **options} if streaming else options))
            .load()
        )
        return messages.select(
            F.col("key").cast("string").alias("key"),
            F.col("value").cast("string").alias("value"),
            "timestamp",
            "topic",
        )
    messages = reader.format(format).schema(MESSAGE_SCHEMA).options(**options).load(source)
    return messages.where(F.col("topic").isin(*topics))
