"""Message sinks: a broker when its connector is present, else partitioned NDJSON folders."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_topics(messages: DataFrame, target: str, format: str = "json", **options) -> None:
    """Append ``(topic, key, value)`` messages.

    ``kafka``: target is the bootstrap server list; the connector gives keyed
    partitioning. ``json``: one folder per topic under the target path.
    """
    if format == "kafka":
        (
            messages.write.format("kafka")
            .option("kafka.bootstrap.servers", target)
            .option("kafka.acks", "all")
            .option("kafka.enable.idempotence", "true")
            .options(**options)
            .save()
        )
        return
    messages.write.mode("append").options(**options).partitionBy("topic").format(format).save(target)
