"""Column functions: every one maps Columns to Columns and stays on the JVM."""

from orebed.functions.canonical import canonical_json, checksum
from orebed.functions.casting import coerce_timestamp, safe_cast
from orebed.functions.masking import MASK_MODES, mask_pii
from orebed.functions.money import cents_to_dollars
from orebed.functions.sql import register_sql_functions
from orebed.functions.text import clean_string, format_date, strip

__all__ = [
    "MASK_MODES",
    "canonical_json",
    "cents_to_dollars",
    "checksum",
    "clean_string",
    "coerce_timestamp",
    "format_date",
    "mask_pii",
    "register_sql_functions",
    "safe_cast",
    "strip",
]
