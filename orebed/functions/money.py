from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from orebed.functions.casting import safe_cast


def cents_to_dollars(column: Column | str, scale: int = 2) -> Column:
    """Exact decimal division by 100, rounded half up."""
    return F.round(safe_cast(column, "numeric") / 100, scale)
