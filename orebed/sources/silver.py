"""Silver and Gold tables through the catalog: one namespace per layer."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LAYERS = ("bronze", "silver", "staging", "gold")


def read_table(spark: SparkSession, path: str, format: str = "parquet") -> DataFrame:
    """A columnar table by path; ``delta`` works where that connector is installed."""
    return spark.read.format(format).load(path)


def create_external_tables(
    spark: SparkSession, paths: Mapping[str, str], layer: str = "silver", format: str = "parquet"
) -> list[str]:
    """Register one external table per entity, over files that stay where they are."""
    if layer not in LAYERS:
        raise ValueError(f"unknown layer {layer!r}; one of {LAYERS}")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")
    names = []
    for entity, path in paths.items():
        name = f"{layer}.`{entity}`"
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.catalog.createTable(f"{layer}.{entity}", path=path, source=format)
        names.append(name)
    return names


def create_views(tables: Mapping[str, DataFrame], layer: str = "silver") -> list[str]:
    """Temporary views ``{layer}_{entity}`` for sessions without a catalog."""
    for entity, df in tables.items():
        df.createOrReplaceTempView(f"{layer}_{entity}")
    return [f"{layer}_{entity}" for entity in tables]


def as_variant(df: DataFrame) -> DataFrame:
    """All columns as one VARIANT column ``value``, as semi-structured tables hold them."""
    return df.select(F.parse_json(F.to_json(F.struct("*"))).alias("value"))
