"""Silver to staging: rename and safely cast, one generic projection for all entities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orebed.catalog import ENTITIES, SQL_TYPES, STAGED_METADATA
from orebed.functions import safe_cast


def stage(silver: DataFrame, entity: str) -> DataFrame:
    """Typed, renamed columns of one entity plus its metadata columns.

    Works on flat Silver columns and on a single VARIANT column named ``value``.
    Columns the source lacks become NULL.
    """
    read = _variant_reader() if silver.columns == ["value"] else _flat_reader(silver.columns)
    fields = (*ENTITIES[entity].fields, *STAGED_METADATA)
    return silver.select(*[read(f.source, f.type).alias(f.name) for f in fields])


def _flat_reader(columns: list[str]):
    present = set(columns)

    def read(name: str, type: str) -> Column:
        return safe_cast(F.col(name) if name in present else F.lit(None), type)

    return read


def _variant_reader():
    def read(name: str, type: str) -> Column:
        return F.try_variant_get(F.col("value"), f"$.{name}", SQL_TYPES[type])

    return read
