"""Secrets by fixed patterns and by token efficiency.

Ordinary words take few tokens of a byte-pair vocabulary, random strings many. Runs of key
characters with a low number of characters per token are marked, unless they are known
digests (hexadecimal of a hash's length), UUIDs, numbers or identifiers made of several words.
Runs of letters alone are judged by that number like all others: random ones have about 1.5,
words and camel case more than 2.1. Where a base span covers a part of a run, what it leaves is judged.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orebed.llm.common import columns_of

#: The base patterns and their kinds, in order.
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "random")
#: Lengths of common digests in hexadecimal digits.
DIGESTS = {32, 40, 48, 56, 64, 96, 128}
#: Runs shorter than this, or with more characters a token, are not taken for random.
SHORTEST, PER_TOKEN = 20, 2.1
_RUN = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}")
_UUID = re.compile(r"[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}")
_HEXADECIMAL = re.compile(r"[0-9a-f]+|[0-9A-F]+")
_WORDS = re.compile(r"(?:[A-Z]?[a-z]+|[A-Z]+|[0-9]{1,4})(?:[_/=+-]+(?:[A-Z]?[a-z]+|[A-Z]+|[0-9]{1,4}))*")


@lru_cache(maxsize=2)
def ranks(path: str):
    """The encoding of a rank file."""
    import base64

    import public_tokenizers
    import tiktoken

    with open(path, "rb") as lines:
        known = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=known, special_tokens={})


def is_random(run: str, encoding) -> bool:
    """Whether a run of key characters is a random string and no digest or identifier."""
    core = run.strip("=-_/+")
    if len(core) < SHORTEST or not any(c.isalpha() for c in core):
        return False
    if _UUID.fullmatch(core) or (not core.isalpha() and _WORDS.fullmatch(core)):
        return False
    if _HEXADECIMAL.fullmatch(core) and len(core) in DIGESTS:
        return False
    return len(core) < PER_TOKEN * len(encoding.encode_ordinary(core))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """Spans (start, kind, end) of the fixed patterns, each kind's matches not overlapping."""
    low, found = text.lower(), []
    if any(word in low for word in ("passw", "secret", "token", "api")):
        found += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if len(m[0]) >= 20]
    if any(len(piece) >= SHORTEST for piece in text.split()):
        found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(found)


def uncovered(start: int, end: int, spans: list[tuple[int, int, int]]) -> Iterator[tuple[int, int]]:
    """The stretches of start to end outside all spans, which are sorted by start."""
    for a, _, b in spans:
        if b > start and a < end:
            if a > start:
                yield start, a
            start = b
    if start < end:
        yield start, end


def _goes_on(text: str, start: int, end: int, run: re.Match, base: list) -> bool:
    """Whether a letter or digit of the stretch adjoins a key that a base span covers in part."""
    for a, kind, b in base:
        joins = (b == start and text[start].isalnum()) or (a == end and text[end - 1].isalnum())
        if joins and kind and run.start() <= a and b <= run.end():
            return True
    return False


def all_spans(text: str, encoding) -> tuple[list, list]:
    """Base spans, and these with the random runs outside them.

    Of a run that meets base spans, each uncovered stretch counts if it is random by itself, or
    if the run is and the stretch goes on directly where a key or hexadecimal span ends or begins.
    """
    base = base_spans(text)
    extra = []
    if any(len(piece) >= SHORTEST for piece in text.split()):
        for m in _RUN.finditer(text):
            rest = list(uncovered(m.start(), m.end(), base))
            if rest == [m.span()]:
                rest = rest if is_random(m[0], encoding) else []
            elif rest:
                whole = is_random(m[0], encoding)
                rest = [
                    (a, b)
                    for a, b in rest
                    if (whole and _goes_on(text, a, b, m, base)) or is_random(text[a:b], encoding)
                ]
            extra += [(a, 3, b) for a, b in rest]
    return base, sorted(base + extra)


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def redacted(text: str, spans: list[tuple[int, int, int]], mark: str) -> str:
    """The text with each stretch of spans replaced by the mark."""
    out, at = [], 0
    for start, _, end in spans:
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])


def _scan(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = ranks(path)
        for batch in batches:
            rows = []
            for value in batch.column("text"):
                base, spans = all_spans(value.as_py() or "", encoding)
                kinds = [kind for _, kind, _ in base]
                digest = hashlib.sha256(joined(base).encode()).hexdigest()
                rows.append((*(kinds.count(k) for k in range(3)), digest, joined(spans)))
            columns = list(zip(*rows, strict=True)) or [()] * 5
            types = [pa.int64()] * 3 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
            )

    return run


def scan(docs: DataFrame, path: str) -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans.

    Spans are kind:start:end in code points (end exclusive), by start, then kind. Null texts
    count as empty and have none. Repeated rows give repeated rows; other columns are left out.
    """
    schema = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    return columns_of(docs, doc_id="long", text="string").mapInArrow(_scan(path), schema)


def _redact(path: str, mark: str):
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoding = ranks(path)
        for batch in texts:
            yield batch.map(lambda t: t if not t else redacted(t, all_spans(t, encoding)[1], mark))

    return F.pandas_udf(run, "string")


def without_secrets(docs: DataFrame, path: str, mark: str = "[secret]") -> DataFrame:
    """The documents with each secret in `text` replaced by the mark; null stays null.

    All rows and columns stay; n_chars, if there, counts the new text.
    """
    out = docs.withColumn("text", clean_text("text", path, mark))
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def clean_text(column: str, path: str, mark: str) -> Column:
    return _redact(path, mark)(F.col(column))
