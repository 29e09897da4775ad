"""CSV folder to topics, with rejects in the dead-letter topic and an audit row per file."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from orebed.catalog import DEAD_LETTER_TOPIC, ENTITIES, SOURCE_SYSTEM, Contract
from orebed.operators import contracts, envelope
from orebed.sinks.audit import append_audit, audit_row
from orebed.sinks.topics import write_topics
from orebed.sources.csv import (
    BOOKKEEPING,
    ERROR,
    FILE,
    RAW,
    read_csv,
    route_file,
    route_files,
    row_numbers,
)


# Fixed value: what a broker takes as one message by default, less some room for headers.
MAX_MESSAGE_BYTES = 1_000_000
_NAME = "_name"


@dataclass
class Ingestion:
    """What one run did: rows per file, and the files no route is known for."""

    run_id: str
    counts: list[tuple[str, str, int, int]]
    skipped: list[str]

    def summary(self, spark: SparkSession) -> DataFrame:
        rows = spark.createDataFrame(
            self.counts, "file_name string, entity_type string, produced bigint, failed bigint"
        )
        return ingestion_summary(rows, "file_name")


def ingestion_summary(counts: DataFrame, by: str) -> DataFrame:
    """Produced and failed rows per file with a total line."""
    return (
        counts.rollup(by)
        .agg(F.sum("produced").alias("produced"), F.sum("failed").alias("failed"))
        .withColumn(by, F.coalesce(by, F.lit("TOTAL")))
    )


def accept(
    landed: DataFrame, contract: Contract | None = None
) -> tuple[DataFrame, DataFrame]:
    """Split landed rows into rows to envelope and rows to reject with a reason."""
    if contract is not None:
        broken = F.array_join("errors", "; ")
        landed = (
            contracts.check_rows(landed, contract)
            .withColumn(ERROR, F.coalesce(ERROR, F.nullif(broken, F.lit(""))))
            .drop("errors")
        )
    return landed.where(F.col(ERROR).isNull()), landed.where(F.col(ERROR).isNotNull())


def ingest_file(
    spark: SparkSession,
    path: str,
    topics: str,
    landing: str,
    run_id: str,
    env: str = "dev",
    source_system: str = SOURCE_SYSTEM,
    contract: Contract | None = None,
    format: str = "json",
    max_message_bytes: int = MAX_MESSAGE_BYTES,
) -> tuple[str, str, int, int]:
    """Envelope and publish one file: ``(file, entity, produced, failed)``.

    The CSV is parsed once and landed as Parquet; everything after reads the
    landed rows, which can be split. Event ids come from the file's name, the row's number in
    it and the content, so they do not change with the place of the file or its splits.
    Rejected rows go to the dead letters as they are, messages too large to be delivered in
    their envelope.
    """
    file_name = path.rstrip("/").rsplit("/", 1)[-1]
    topic, entity = route_file(file_name)
    read_csv(spark, path, multiline=ENTITIES[entity].multiline).write.mode("overwrite").parquet(landing)
    landed = spark.read.parquet(landing)
    columns = [c for c in landed.columns if c not in BOOKKEEPING]
    part = F.element_at(F.split(FILE, "/"), -1)
    good, bad = accept(row_numbers(landed, landed).withColumn(_NAME, part), contract)

    enveloped = envelope.wrap(
        good,
        entity,
        topic,
        columns,
        run_id,
        env,
        source_system,
        F.lit(datetime.now(timezone.utc)),
        identity=(_NAME, "row_num"),
    )
    stamp = F.current_timestamp().alias("timestamp")
    # The rows are counted while they are written.
    seen = Observation(), Observation()
    total = F.count("*").alias("n")
    fits, large = envelope.deliverable(enveloped, max_message_bytes)
    messages = envelope.serialise(fits, envelope.message_key(fits, entity))
    write_topics(messages.select("*", stamp).observe(seen[0], total), topics, format)

    raw = envelope.dead_letters_raw(bad.withColumn(FILE, F.lit(file_name)), topic, [*columns, RAW])
    size = F.lit(f"message of more than {max_message_bytes} bytes")
    letters = raw.unionByName(envelope.dead_letters_enveloped(large, size))
    letters = letters.select(F.lit(DEAD_LETTER_TOPIC).alias("topic"), "key", "value", stamp)
    write_topics(letters.observe(seen[1], total), topics, format)
    return file_name, entity, seen[0].get["n"], seen[1].get["n"]


def ingest(
    spark: SparkSession,
    data_dir: str,
    topics: str,
    landing: str,
    audit: str | None = None,
    run_id: str | None = None,
    env: str = "dev",
    source_system: str = SOURCE_SYSTEM,
    contracts: dict[str, Contract] | None = None,
    format: str = "json",
) -> Ingestion:
    """Publish every registered CSV file of a folder; unknown files are reported, not read."""
    run_id = run_id or f"run-{uuid.uuid4().hex[:8]}"
    # The listing: one row per file of the folder, at most nine of them registered.
    files = route_files(spark, data_dir).orderBy("file_name").collect()
    result = Ingestion(run_id, [], [f.file_name for f in files if f.topic is None])
    log = []
    for f in files:
        if f.topic is None:
            continue
        started = datetime.now(timezone.utc)
        count = ingest_file(
            spark,
            f.path,
            topics,
            f"{landing.rstrip('/')}/{run_id}/{f.entity_type}",
            run_id,
            env,
            source_system,
            (contracts or {}).get(f.entity_type),
            format,
        )
        result.counts.append(count)
        failed = count[3]
        log.append(
            audit_row(
                run_id,
                "ingestion",
                f.entity_type,
                count[2],
                failed,
                started,
                datetime.now(timezone.utc),
                ENTITIES[f.entity_type].topic,
                error=f"{failed} of {failed + count[2]} rows went to the dead letters" if failed else None,
            )
        )
    if audit and log:
        append_audit(spark, log, audit)
    return result
