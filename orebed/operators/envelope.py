"""Event envelopes: wrap, key, serialise, parse, unpack and verify."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orebed.catalog import (
    ENTITIES,
    EVENT_TYPE,
    METADATA_FIELDS,
    SCHEMA_VERSION,
    SOURCE_SYSTEM,
    envelope_schema,
)
from orebed.functions import canonical_json, checksum

_CORRUPT = "_corrupt"
_ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def wrap(
    df: DataFrame,
    entity: str,
    topic: str | None = None,
    columns: Sequence[str] | None = None,
    run_id: str | None = None,
    env: str = "dev",
    source_system: str = SOURCE_SYSTEM,
    ingested_at: Column | None = None,
    identity: Sequence[str] = (),
    random_ids: bool = False,
) -> DataFrame:
    """Rows to ``(metadata, payload)``.

    The event id is derived from entity, ``identity`` columns (such as file and
    row) and checksum, so a retried or replayed row keeps its id; ``random_ids``
    draws a UUID instead.
    """
    topic = topic or ENTITIES[entity].topic
    columns = list(columns or ENTITIES[entity].columns)
    # A column of its own: event id and metadata use it, it is computed once.
    df = df.withColumn("_checksum", checksum(columns))
    digest = F.col("_checksum")
    if random_ids:
        event_id = F.uuid()
    else:
        parts = [F.lit(entity), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in identity]]
        event_id = F.sha2(F.concat_ws("\x1f", *parts, digest), 256)
    metadata = {
        "event_id": event_id,
        "event_type": F.lit(EVENT_TYPE.format(entity=entity)),
        "entity_type": F.lit(entity),
        "source_system": F.lit(source_system),
        "source_topic": F.lit(topic),
        "schema_version": F.lit(SCHEMA_VERSION),
        "ingested_at": F.date_format(
            F.current_timestamp() if ingested_at is None else ingested_at, _ISO
        ),
        "ingestion_env": F.lit(env),
        "pipeline_run_id": F.lit(run_id).cast("string"),
        "data_layer": F.lit("bronze"),
        "checksum": digest,
    }
    return df.select(
        F.struct(*[metadata[n].alias(n) for n in METADATA_FIELDS]).alias("metadata"),
        F.struct(*[F.col(c).cast("string").alias(c) for c in columns]).alias("payload"),
    )


def message_key(enveloped: DataFrame, entity: str, compat: bool = False) -> Column:
    """Key that decides the topic partition: the entity's key values, else the event id.

    ``compat`` takes the first non-empty of ``{entity}_id``, ``id``, ``order_id``
    and ``customer_id``; for order items that is the sequence number, which puts
    most of the topic on few partitions.
    """
    present = set(enveloped.schema["payload"].dataType.names)
    event_id = F.col("metadata.event_id")

    def value(c: str) -> Column:
        return F.nullif(F.col(f"payload.{c}"), F.lit(""))

    if compat:
        # The columns that are tried in turn.
        candidates = [f"{entity}_id", "id", "order_id", "customer_id"]
        return F.coalesce(*[value(c) for c in candidates if c in present], event_id)
    keys = [c for c in ENTITIES[entity].key if c in present]
    if not keys:
        return event_id
    # A missing part keeps its place, so (a, -) and (-, a) stay apart.
    joined = F.concat_ws("|", *[F.coalesce(value(c), F.lit("")) for c in keys])
    return F.when(F.coalesce(*[value(c) for c in keys]).isNotNull(), joined).otherwise(event_id)


def serialise(enveloped: DataFrame, key: Column | None = None) -> DataFrame:
    """Envelopes to ``(topic, key, value)`` messages; NULL fields are written as null."""
    return enveloped.select(
        F.col("metadata.source_topic").alias("topic"),
        (F.col("metadata.event_id") if key is None else key).alias("key"),
        F.to_json(F.struct("metadata", "payload"), {"ignoreNullFields": "false"}).alias("value"),
    )


def deliverable(enveloped: DataFrame, max_bytes: int) -> tuple[DataFrame, DataFrame]:
    """Envelopes that fit one message of the broker, and those that do not."""
    body = F.to_json(F.struct("metadata", "payload"), {"ignoreNullFields": "false"})
    fits = F.octet_length(body) <= max_bytes
    return enveloped.where(fits), enveloped.where(~fits)


def parse(messages: DataFrame, entity: str | None = None) -> DataFrame:
    """Add ``metadata`` and ``payload`` parsed from ``value``, and ``error`` for bad messages."""
    schema = envelope_schema(entity).add(_CORRUPT, "string")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    # One row in, one row out. The generator keeps filters on the parsed fields above
    # the parser; through a plain projection they would parse the text a second time.
    record = F.from_json(F.col("value"), schema, options)
    parsed = messages.select("*", F.explode_outer(F.array(record)).alias("_parsed"))
    bad = F.col("_parsed").isNull() | F.col(f"_parsed.{_CORRUPT}").isNotNull()
    return (
        parsed.withColumn("error", F.when(bad, F.lit("not a readable envelope")))
        .withColumn("metadata", F.when(~bad, F.col("_parsed.metadata")))
        .withColumn("payload", F.when(~bad, F.col("_parsed.payload")))
        .drop("_parsed")
    )


def split(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good and bad rows by the ``error`` column."""
    return parsed.where(F.col("error").isNull()).drop("error"), parsed.where(
        F.col("error").isNotNull()
    )


def unpack(df: DataFrame) -> DataFrame:
    """Flat columns from payload and metadata, from payload only, or as they are."""
    present = set(df.columns)
    if {"payload", "metadata"} <= present:
        return df.select("payload.*", "metadata.*")
    if "payload" in present:
        return df.select("payload.*")
    return df


def verify(enveloped: DataFrame) -> DataFrame:
    """Add ``checksum_ok``: the payload still has the checksum its metadata carries."""
    names = enveloped.schema["payload"].dataType.names
    actual = F.sha2(canonical_json({n: F.col(f"payload.{n}") for n in names}), 256)
    return enveloped.withColumn("checksum_ok", actual.eqNullSafe(F.col("metadata.checksum")))


def map_fields(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename source fields to target fields, drop the rest; missing fields become NULL."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(source) if source in present else F.lit(None).cast("string")).alias(target)
            for source, target in mapping.items()
        ]
    )


def typed_event(df: DataFrame) -> DataFrame:
    """Legacy sales event: typed columns, default status, and whether the row is valid."""
    status = F.col("status") if "status" in df.columns else F.lit(None)
    typed = df.select(
        F.col("id").cast("string").alias("id"),
        F.col("product_id").cast("string").alias("product_id"),
        F.col("amount").try_cast("double").alias("amount"),
        F.col("created_at").try_cast("timestamp").alias("created_at"),
        F.coalesce(status.cast("string"), F.lit("NEW")).alias("status"),
    )
    required = [F.col(c).isNotNull() for c in ("id", "product_id", "amount", "created_at")]
    return typed.withColumn("is_valid", required[0] & required[1] & required[2] & required[3])


def dead_letters_raw(rejected: DataFrame, topic: str, columns: Sequence[str]) -> DataFrame:
    """Rows that never became an envelope: needs ``_file``, ``row_num`` and ``_error``."""
    value = F.struct(
        F.lit(topic).alias("original_topic"),
        F.col("_file").alias("source_file"),
        "row_num",
        F.col("_error").alias("error"),
        F.struct(*columns).alias("raw_payload"),
    )
    return rejected.select(
        F.concat_ws(":", F.col("_file"), F.lit("row"), F.col("row_num")).alias("key"),
        F.to_json(value, {"ignoreNullFields": "false"}).alias("value"),
    )


def dead_letters_enveloped(enveloped: DataFrame, error: Column) -> DataFrame:
    """Envelopes that could not be delivered, with the reason."""
    value = F.struct(
        F.col("metadata.source_topic").alias("original_topic"),
        error.alias("error"),
        F.struct("metadata", "payload").alias("envelope"),
    )
    return enveloped.select(
        F.col("metadata.event_id").alias("key"),
        F.to_json(value, {"ignoreNullFields": "false"}).alias("value"),
    )
