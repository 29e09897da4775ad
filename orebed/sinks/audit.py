"""Audit log: one row per stage and entity, appended."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from orebed.catalog import AUDIT_SCHEMA


def status_of(processed: int, failed: int) -> str:
    if failed == 0:
        return "success"
    return "partial" if processed > 0 else "failed"


def audit_row(
    run_id: str,
    stage: str,
    entity: str,
    processed: int,
    failed: int,
    started_at: datetime,
    finished_at: datetime,
    topic: str | None = None,
    status: str | None = None,
    error: str | None = None,
) -> dict:
    return {
        "run_id": run_id,
        "pipeline_stage": stage,
        "entity_type": entity,
        "source_topic": topic,
        "rows_processed": processed,
        "rows_failed": failed,
        "started_at": started_at,
        "finished_at": finished_at,
        "status": status or status_of(processed, failed),
        "error_message": error,
    }


def append_audit(spark: SparkSession, rows: Iterable[Mapping], path: str) -> None:
    spark.createDataFrame(list(rows), AUDIT_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(AUDIT_SCHEMA).parquet(path)
