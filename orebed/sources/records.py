"""Records of CSV files with quoted line breaks, read by as many tasks as the files have blocks.

A block of a file does not know whether it begins inside a quoted value. So its lines are
followed from both states, outside and inside quotes, which gives each block a function from
its first to its last state and two counts of records. One small row per block is then
chained along the file, and says which of the two readings was right. Lines that are a record
of their own stay where they are; only the pieces of longer records are shuffled and joined.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orebed.session import durable, ship_package

FILE, BLOCK = "_file", "_block"
#: A value is quoted if it begins with a quote; what follows the closing one counts to the comma.
_VALUE = re.compile(r'"(?:[^"]++|"")*+"[^,]*+|(?!")[^,]*+')
_REST = re.compile(r'(?:[^"]++|"")*+"[^,]*+')


def inside_after(line: str, inside: bool) -> bool:
    """Whether the line after this one begins inside a quoted value."""
    value = (_REST if inside else _VALUE).match(line)
    while value is not None and value.end() < len(line):
        value = _VALUE.match(line, value.end() + 1)
    return value is None


class _Reading:
    """The lines of one block, followed from one first state: the state and the records begun so far."""

    def __init__(self, inside: bool):
        self.inside, self.records = inside, 0

    def take(self, line: str, quoted: bool) -> tuple[bool, bool, int]:
        """State before and after the line, and the number of the record it belongs to."""
        before = self.inside
        if not before and line not in ("", "\r"):
            self.records += 1
        if quoted:
            self.inside = inside_after(line, before)
        return before, self.inside, self.records


def _follow(batches: Iterator[pa.RecordBatch]):
    """Each line of the task's blocks with its place in the block and both readings."""
    block, place, readings = None, 0, ()
    for batch in batches:
        lines = batch.column("value")
        quoted = pc.match_substring(lines, '"').to_pylist()
        keys = zip(batch.column(FILE).to_pylist(), batch.column(BLOCK).to_pylist(), strict=True)
        for key, line, has in zip(keys, lines.to_pylist(), quoted, strict=True):
            if key != block:
                block, place, readings = key, 0, (_Reading(False), _Reading(True))
            if place == 0 and key[1] == 0 and line.startswith("\ufeff"):
                line, has = line[1:], True  # the mark may hide a quoted first value
            yield key, place, line, [r.take(line, has) for r in readings]
            place += 1


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    last: dict = {}
    for key, _, _, read in _follow(batches):
        last[key] = [x for _, after, records in read for x in (after, records)]
    rows = [(*key, *ends) for key, ends in last.items()]
    columns = list(zip(*rows, strict=True)) or [()] * 6
    kinds = (pa.string(), pa.int64(), pa.bool_(), pa.int64(), pa.bool_(), pa.int64())
    names = [FILE, BLOCK, "inside_0", "records_0", "inside_1", "records_1"]
    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


_LINE = pa.schema(
    [(FILE, pa.string()), (BLOCK, pa.int64()), ("place", pa.int64()), ("value", pa.string())]
    + [(f"{name}_{k}", kind) for k in (0, 1) for name, kind in (("before", pa.bool_()), ("after", pa.bool_()), ("nth", pa.int64()))]
)


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = []

    def out() -> pa.RecordBatch:
        columns = list(zip(*held, strict=True)) or [()] * len(_LINE)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _LINE, strict=True)], schema=_LINE)

    for key, place, line, read in _follow(batches):
        held.append((*key, place, line, *read[0], *read[1]))
        if len(held) == 4000:
            yield out()
            held.clear()
    yield out()


def _chain(blocks: pd.DataFrame) -> pd.DataFrame:
    """First state and number of earlier records of each block of one file."""
    inside, records, rows = False, 0, []
    for b in blocks.sort_values(BLOCK).to_dict("records"):
        rows.append((b[FILE], b[BLOCK], inside, records))
        side = int(inside)
        inside, records = b[f"inside_{side}"], records + b[f"records_{side}"]
    return pd.DataFrame(rows, columns=[FILE, BLOCK, "inside", "base"])


def split_records(spark: SparkSession, path: str) -> DataFrame:
    """Records of a UTF-8 CSV file or folder: _file, _block, nth, record.

    nth is the record's number in its file, from 1, whose first is the header; _block is where the
    block of its first line starts. Line ends inside values stay, one \\n or \\r\\n after a record is taken
    off, and empty lines between records are none. The file is read
    three times: for one row per block, for lines that are a record, for pieces of longer ones.
    A quote that is never closed makes the rest of its file one record, as in any CSV reader.
    """
    ship_package(spark)
    raw = spark.read.option("lineSep", "\n").text(path)
    raw = raw.select("value", F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_block_start").alias(BLOCK))
    kind = f"{FILE} string, {BLOCK} long, inside_0 boolean, records_0 long, inside_1 boolean, records_1 long"
    blocks = durable(raw.mapInArrow(_summaries, kind))
    starts = durable(blocks.groupBy(FILE).applyInPandas(_chain, f"{FILE} string, {BLOCK} long, inside boolean, base long"))
    sides = ", ".join(f"before_{k} boolean, after_{k} boolean, nth_{k} long" for k in (0, 1))
    lines = raw.mapInArrow(_lines, f"{FILE} string, {BLOCK} long, place long, value string, {sides}").join(starts, [FILE, BLOCK])
    right = {n: F.when(F.col("inside"), F.col(f"{n}_1")).otherwise(F.col(f"{n}_0")) for n in ("before", "after", "nth")}
    lines = lines.select(
        FILE, BLOCK, "place", "value", right["before"].alias("before"), right["after"].alias("after"), (F.col("base") + right["nth"]).alias("nth")
    )
    lines = lines.where(F.col("before") | ~F.col("value").isin("", "\r"))
    alone = ~F.col("before") & ~F.col("after")
    whole = lines.where(alone).select(FILE, BLOCK, "nth", "value")
    pieces = F.array_sort(F.collect_list(F.struct(BLOCK, "place", "value")))
    joined = lines.where(~alone).groupBy(FILE, "nth").agg(pieces.alias("pieces"))
    text = F.array_join(F.col("pieces.value"), "\n")
    joined = joined.select(FILE, F.col("pieces")[0][BLOCK].alias(BLOCK), "nth", text.alias("value"))
    return whole.union(joined).select(FILE, BLOCK, "nth", F.regexp_replace("value", r"\r$", "").alias("record"))
