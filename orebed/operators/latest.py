"""Keep the latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orebed.catalog import ENTITIES

_RANK = "_rank"


def keep_latest(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per key in the given order; rows with NULL keys form one group.

    ``row_number() = 1`` is planned with a partial group limit in front of the
    shuffle, so each task sends at most one row per key: a key holding a third of
    all rows costs its reducer one row per task, not a third of the table.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn(_RANK, F.row_number().over(window)).where(F.col(_RANK) == 1).drop(_RANK)
    )


def latest_order(df: DataFrame) -> list[Column]:
    """Total order for enveloped rows: newest ingest first, then event id.

    Rows without an ingest time fall back to the load stamp.
    """
    columns = [c for c in ("ingested_at", "_silver_loaded_at") if c in df.columns][:1]
    if "event_id" in df.columns:
        columns.append("event_id")
    return [F.col(c).desc_nulls_last() for c in columns]


def keep_latest_entity(df: DataFrame, entity: str, compat: bool = False) -> DataFrame:
    """Deduplicate one entity on its key; unchanged if a key column is missing.

    ``compat`` uses the narrow key, which drops all but one row per item
    sequence number and all but one payment per order.
    """
    spec = ENTITIES[entity]
    keys = spec.compat_key if compat else spec.key
    if not set(keys) <= set(df.columns):
        return df
    return keep_latest(df, keys, latest_order(df))
