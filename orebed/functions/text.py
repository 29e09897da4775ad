"""Text helpers used when rows enter the system."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode white space plus the four ASCII separators that also count as space.
_SPACE = r"[\s\x1c-\x1f]"
_ISO = (
    r"^\d{4}-\d{2}-\d{2}"
    r"([T ]\d{2}(:\d{2}(:\d{2}(\.\d{1,6})?)?)?([+-]\d{2}:\d{2}|Z)?)?$"
)
_OFFSET = r"(?<=[T ].{2,15})([+-]\d{2}:\d{2}|Z)$"


def _column(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(column: Column | str) -> Column:
    """Remove white space of any kind from both ends."""
    return F.regexp_replace(_column(column), f"(?U)^{_SPACE}+|{_SPACE}+$", "")


def clean_string(column: Column | str) -> Column:
    """Keep letters, digits and white space of any script."""
    return F.regexp_replace(_column(column), r"(?U)[^\p{L}\p{N}\s\x1c-\x1f]", "")


def format_date(column: Column | str) -> Column:
    """ISO text to its normal form ``yyyy-MM-ddTHH:mm:ss[.ffffff][+hh:mm]``; NULL if unreadable."""
    c = _column(column)
    text = F.when(c.rlike(_ISO), c)
    offset = F.regexp_extract(text, _OFFSET, 1)
    local = F.regexp_replace(text, _OFFSET, "")
    # An hour alone is ISO, but the cast wants minutes.
    local = F.when(F.length(local) == 13, F.concat(local, F.lit(":00"))).otherwise(local)
    stamp = local.try_cast("timestamp_ntz")
    base = F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss")
    fraction = F.date_format(stamp, ".SSSSSS")
    return F.concat(
        base,
        F.when(fraction == ".000000", "").otherwise(fraction),
        F.when(offset == "Z", "+00:00").otherwise(offset),
    )
