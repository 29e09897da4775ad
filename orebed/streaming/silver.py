"""Streaming Silver: the latest row per key, kept current as events arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from orebed.catalog import ENTITIES
from orebed.operators.envelope import parse, unpack
from orebed.plans.silver import prepare
from orebed.sinks.keyed import KeyedTable
from orebed.streaming.bronze import BACKFILL


def maintain_silver(
    messages: DataFrame,
    entity: str,
    table: KeyedTable,
    checkpoint: str,
    quarantine: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Upsert each batch of the entity's topic under the query's id and the batch's number.

    The id belongs to the checkpoint: a retried batch replaces its own rows, and a replay
    with a new checkpoint writes under a name of its own. Messages of the topic that cannot
    be read, or that carry another entity, go to the quarantine; other topics are not read.
    """

    def upsert(batch: DataFrame, batch_id: int) -> None:
        source = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        # Read anew by each step rather than kept: a batch's text takes more room than its rows.
        foreign = ~F.col("metadata.entity_type").eqNullSafe(F.lit(entity))
        marked = parse(batch, entity).withColumn(
            "error", F.coalesce("error", F.when(foreign, F.lit(f"not an event of {entity}")))
        )
        flat = unpack(marked.where("error IS NULL").select("metadata", "payload"))
        # The ingest time stands for the load time: a retried batch writes the same rows.
        stamp = F.col("ingested_at").try_cast("timestamp")
        table.upsert(prepare(flat, entity, stamp), source, batch_id)
        bad = marked.where("error IS NOT NULL").select("topic", "key", "value", "error")
        bad.write.mode("overwrite").json(f"{quarantine}/source={source}/batch={batch_id}", compression="gzip")

    return (
        messages.where(F.col("topic") == ENTITIES[entity].topic)
        .writeStream.option("checkpointLocation", checkpoint)
        .trigger(**(trigger or BACKFILL))
        .foreachBatch(upsert)
        .start()
    )
