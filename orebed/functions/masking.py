"""Masking of personal data in published tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters kept and the replacement text of the prefix mask.
KEPT_CHARACTERS = 4
MASK_TEXT = "****-PII-MASKED-****"

MASK_MODES = ("prefix", "sha256", "null", "none")


def mask_pii(column: Column | str, mode: str = "prefix", data_type: str = "string") -> Column:
    """Mask one column.

    ``prefix`` keeps four characters, so distinct keys collide: use it for display
    only. ``sha256`` keeps equality, so masked keys still join. ``null`` hides the
    value, ``none`` publishes it. In ``prefix`` mode values that are not text
    become NULL; NULL stays NULL in every mode.
    """
    c = F.col(column) if isinstance(column, str) else column
    if mode == "none":
        return c
    if mode == "null" or (mode == "prefix" and data_type != "string"):
        return F.lit(None).cast("string")
    text = c.cast("string")
    if mode == "prefix":
        return F.concat(F.substring(text, 1, KEPT_CHARACTERS), F.lit(MASK_TEXT))
    if mode == "sha256":
        return F.sha2(text, 256)
    raise ValueError(f"unknown mask mode {mode!r}; one of {MASK_MODES}")
