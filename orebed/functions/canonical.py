"""Canonical JSON text of a row, and its SHA-256 checksum.

The text has sorted keys, ``", "`` and ``": "`` as separators and is pure ASCII,
with lower-case hexadecimal escapes: any JSON library that sorts keys and escapes
non-ASCII characters produces the same bytes, so producers outside Spark can
compute the same checksum.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

_JSON_OPTIONS = {"writeNonAsciiCharacterAsCodePoint": "true", "ignoreNullFields": "false"}
_DEL = "\x7f"


def _lower_escapes(part: Column) -> Column:
    pieces = F.split(part, r"(?=\\u[0-9A-Fa-f]{4})")
    return F.array_join(
        F.transform(
            pieces,
            lambda p: F.when(
                p.startswith("\\u"), F.concat(F.lower(F.substring(p, 1, 6)), F.substr(p, F.lit(7)))
            ).otherwise(p),
        ),
        "",
    )


def _json_value(column: Column) -> Column:
    # A one-element array keeps NULL and needs only its brackets removed: a JSON
    # string starts and ends with a quote, so no bracket of the text is touched.
    return F.btrim(F.to_json(F.array(column.cast("string")), _JSON_OPTIONS), F.lit("[]"))


def canonical_json(columns: Mapping[str, Column | str] | Iterable[str]) -> Column:
    """Canonical JSON of text columns: ``{name: column}`` or plain column names."""
    named = dict(columns) if isinstance(columns, Mapping) else {c: c for c in columns}
    members = []
    for name in sorted(named):
        value = named[name]
        value = F.col(value) if isinstance(value, str) else value
        members.append(F.concat(F.lit(f'"{name}": '), _json_value(value)))
    text = F.concat(F.lit("{"), F.concat_ws(", ", *members), F.lit("}"))
    # The one-element transform names the text, so it is built once per row.
    return F.element_at(F.transform(F.array(text), _normal_escapes), 1)


def _normal_escapes(text: Column) -> Column:
    # An escaped backslash may stand before a plain "u": split on the pairs first.
    lowered = F.array_join(F.transform(F.split(text, r"\\\\"), _lower_escapes), "\\\\")
    escaped = F.when(F.contains(text, F.lit("\\u")), lowered).otherwise(text)
    return F.replace(escaped, F.lit(_DEL), F.lit("\\u007f"))


def checksum(columns: Mapping[str, Column | str] | Iterable[str]) -> Column:
    """SHA-256 of the canonical JSON, in lower-case hexadecimal."""
    return F.sha2(canonical_json(columns), 256)
