"""Bronze to Silver: flatten, coerce dates, stamp the load, keep the latest row per key."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from orebed.catalog import ENTITIES
from orebed.functions import coerce_timestamp
from orebed.operators.latest import keep_latest_entity
from orebed.sinks.keyed import KeyedTable
from orebed.sources.bronze import read_bronze


class QualityError(AssertionError):
    """Input or output of a Silver load breaks a rule."""


def prepare(flat: DataFrame, entity: str, loaded_at: Column | None = None) -> DataFrame:
    """Dates coerced (unreadable text becomes NULL) and the load stamp added."""
    dates = [c for c in ENTITIES[entity].date_columns if c in flat.columns]
    stamp = F.current_timestamp() if loaded_at is None else loaded_at
    return flat.withColumns(
        {**{c: coerce_timestamp(c) for c in dates}, "_silver_loaded_at": stamp}
    )


def refine(
    flat: DataFrame, entity: str, compat: bool = False, loaded_at: Column | None = None
) -> DataFrame:
    return keep_latest_entity(prepare(flat, entity, loaded_at), entity, compat)


def silver_table(spark: SparkSession, root: str, entity: str) -> KeyedTable:
    return KeyedTable(spark, f"{root.rstrip('/')}/{entity}", ENTITIES[entity].key)


def no_records(entity: str, raw: int) -> None:
    """An input without rows breaks the load."""
    if not raw:
        raise QualityError(f"no records in Bronze for {entity!r}")


def null_keys(df: DataFrame, entity: str) -> Column:
    """Whether a row lacks a part of its entity's key."""
    missing = F.lit(False)
    for c in ENTITIES[entity].key:
        missing = missing | F.col(c).isNull()
    return missing


@dataclass
class Load:
    entity: str
    raw_count: int = 0
    silver_count: int = 0
    status: str = "SUCCESS"
    error: str | None = None

    @property
    def duplicates_dropped(self) -> int:
        return self.raw_count - self.silver_count


def load_entity(spark: SparkSession, bronze: str, silver: str, entity: str) -> Load:
    """Full rebuild of one entity: one write, which counts its rows in, out and without a key.

    The new base is published only after its checks; one that fails leaves the table as it was.
    """
    table = silver_table(spark, silver, entity)
    flat = read_bronze(spark, bronze, entity)
    read, kept = Observation(f"raw_{entity}"), Observation(f"kept_{entity}")
    raw = prepare(flat, entity).observe(read, F.count("*").alias("n"))
    latest = keep_latest_entity(raw, entity).observe(
        kept, F.count("*").alias("n"), F.count_if(null_keys(raw, entity)).alias("bad")
    )

    def check(_: DataFrame) -> None:
        no_records(entity, read.get["n"])
        if kept.get["bad"]:
            raise QualityError(f"{kept.get['bad']} rows with a NULL key in Silver {entity!r}")

    table.publish(latest, check)
    return Load(entity, read.get["n"], kept.get["n"])


def load_all(
    spark: SparkSession, bronze: str, silver: str, entities: Iterable[str] = tuple(ENTITIES)
) -> list[Load]:
    """Load every entity; one that fails is reported and the others go on."""
    loads = []
    for entity in entities:
        try:
            loads.append(load_entity(spark, bronze, silver, entity))
        except QualityError as error:
            loads.append(Load(entity, status="DQ_FAIL", error=str(error)))
        except Exception as error:  # noqa: BLE001 - the run goes on with the other entities
            loads.append(Load(entity, status="ERROR", error=str(error)))
    return loads


def load_summary(spark: SparkSession, loads: Iterable[Load]) -> DataFrame:
    return spark.createDataFrame(
        [
            (x.entity, x.raw_count, x.silver_count, x.duplicates_dropped, x.status, x.error)
            for x in loads
        ],
        "entity string, raw_count bigint, silver_count bigint, duplicates_dropped bigint, "
        "status string, error string",
    )
