"""PII catalogue: flags live on the columns, masks follow the flags."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orebed.catalog import ENTITIES, PII_COLUMNS, Contract
from orebed.functions import mask_pii


def tag(df: DataFrame, classes: Mapping[str, str]) -> DataFrame:
    """Flag personal columns, ``{column: classification}``, in the schema's metadata."""
    return df.select(
        *[
            F.col(c).alias(c, metadata={"pii": True, "classification": classes[c]})
            if c in classes
            else F.col(c)
            for c in df.columns
        ]
    )


def tag_table(df: DataFrame, table: str) -> DataFrame:
    return tag(df, PII_COLUMNS.get(table, {}))


def tag_entity(df: DataFrame, entity: str) -> DataFrame:
    return tag(df, {f.name: "confidential" for f in ENTITIES[entity].fields if f.pii})


def tag_contract(df: DataFrame, contract: Contract) -> DataFrame:
    return tag(
        df, {f.name: f.classification or "internal" for f in contract.fields if f.pii}
    )


def personal_columns(df: DataFrame) -> dict[str, str]:
    """Flagged columns and their classification."""
    return {
        f.name: f.metadata.get("classification", "")
        for f in df.schema.fields
        if f.metadata.get("pii")
    }


def catalogue(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """``(table, column, type, pii, classification)`` of every column."""
    rows = [
        (
            table,
            f.name,
            f.dataType.simpleString(),
            bool(f.metadata.get("pii")),
            f.metadata.get("classification"),
        )
        for table, df in tables.items()
        for f in df.schema.fields
    ]
    return spark.createDataFrame(
        rows, "table string, column string, type string, pii boolean, classification string"
    )


def mask_tagged(df: DataFrame, mode: str = "prefix") -> DataFrame:
    """The frame with every flagged column masked."""
    types = dict(df.dtypes)
    masked = {c: mask_pii(c, mode, types[c]) for c in personal_columns(df)}
    return df.withColumns(masked) if masked else df
