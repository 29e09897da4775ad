"""Safe casts: a value that does not parse becomes NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from orebed.catalog import SQL_TYPES


def _column(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_cast(column: Column | str, type: str = "string") -> Column:
    """Cast to string, integer, numeric or timestamp; NULL when not possible."""
    return _column(column).try_cast(SQL_TYPES[type])


def coerce_timestamp(column: Column | str) -> Column:
    """Text to timestamp; empty or unreadable text becomes NULL. Zone-less text is UTC
    because the session time zone is."""
    return _column(column).try_cast("timestamp")
