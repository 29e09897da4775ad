"""The column functions as SQL functions, callable from ``spark.sql``."""

from __future__ import annotations

from pyspark.sql import SparkSession

from orebed.catalog import NUMERIC
from orebed.functions.masking import KEPT_CHARACTERS, MASK_TEXT

_FUNCTIONS = {
    "mask_pii(v STRING) RETURNS STRING": f"concat(substr(v, 1, {KEPT_CHARACTERS}), '{MASK_TEXT}')",
    "cents_to_dollars(v STRING) RETURNS DECIMAL(38,2)": f"round(try_cast(v AS {NUMERIC}) / 100, 2)",
    "safe_integer(v STRING) RETURNS INT": "try_cast(v AS INT)",
    "safe_numeric(v STRING) RETURNS DECIMAL(28,9)": f"try_cast(v AS {NUMERIC})",
    "safe_timestamp(v STRING) RETURNS TIMESTAMP": "try_cast(v AS TIMESTAMP)",
}


def register_sql_functions(spark: SparkSession) -> list[str]:
    """Register session-scoped SQL functions; they are inlined into the plan."""
    for signature, body in _FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")
    return [s.split("(")[0] for s in _FUNCTIONS]
