"""Row contracts and table contracts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orebed.catalog import Contract
from orebed.functions import safe_cast


class ContractError(ValueError):
    """A table does not have the columns and types it promises."""


def check_rows(df: DataFrame, contract: Contract) -> DataFrame:
    """Add ``errors``: one text per broken rule, empty for rows that pass.

    NULL and empty text both count as missing.
    """
    present = set(df.columns)
    rules: list[Column] = []
    for field in contract.fields:
        value = F.col(field.name) if field.name in present else F.lit(None).cast("string")
        missing = value.isNull() | (value.cast("string") == "")
        if not field.nullable:
            rules.append(F.when(missing, F.lit(f"{field.name}: missing")))
        if field.type != "string":
            unreadable = ~missing & safe_cast(value, field.type).isNull()
            rules.append(F.when(unreadable, F.lit(f"{field.name}: not a {field.type}")))
        if field.accepted_values:
            unknown = ~missing & ~value.isin(*field.accepted_values)
            rules.append(F.when(unknown, F.lit(f"{field.name}: value not accepted")))
    return df.withColumn("errors", F.array_compact(F.array(*rules)))


def split(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    passed = F.size("errors") == 0
    return checked.where(passed).drop("errors"), checked.where(~passed)


def schema_violations(df: DataFrame, expected: T.StructType) -> list[str]:
    """Differences in column names, order and types; nullability is not compared."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    wanted = {f.name: f.dataType.simpleString() for f in expected.fields}
    found = [f"missing column {n} {t}" for n, t in wanted.items() if n not in actual]
    found += [f"unexpected column {n} {t}" for n, t in actual.items() if n not in wanted]
    found += [
        f"column {n} is {actual[n]}, expected {t}"
        for n, t in wanted.items()
        if n in actual and actual[n] != t
    ]
    return found


def enforce(df: DataFrame, expected: T.StructType, table: str) -> DataFrame:
    """The frame itself, or an error that lists every difference, before anything is written."""
    found = schema_violations(df, expected)
    if found:
        raise ContractError(f"{table}: " + "; ".join(found))
    return df
