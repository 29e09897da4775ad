"""Bronze: NDJSON envelopes under ``entity=/year=/month=/day=``."""

from __future__ import annotations

from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orebed.catalog import envelope_schema
from orebed.operators.envelope import unpack


def read_bronze(
    spark: SparkSession,
    root: str,
    entity: str,
    since: date | None = None,
    shape: str = "envelope",
) -> DataFrame:
    """Flat rows of one entity. Blank lines are skipped, the schema is never inferred.

    ``since`` prunes the date folders. ``shape`` tells whether lines hold payload
    and metadata, a payload only, or flat columns.
    """
    full = envelope_schema(entity)
    payload, metadata = full["payload"], full["metadata"]
    schema = {
        "envelope": full,
        "payload": T.StructType([payload]),
        "flat": T.StructType([*payload.dataType.fields, *metadata.dataType.fields]),
    }[shape]
    path = f"{root.rstrip('/')}/entity={entity}"
    try:
        rows = spark.read.schema(schema).option("basePath", root).json(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"no Bronze data at {path}") from error
        raise
    if since is not None:
        rows = rows.where(F.make_date("year", "month", "day") >= F.lit(since))
    return unpack(rows.select(*schema.names))
