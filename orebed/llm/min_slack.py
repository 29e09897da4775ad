"""Packing by minimum bin slack.

A packing depends on the lengths alone, and there are at most `limit` different ones. So
Spark counts the pieces of each length, and one bin after the other is planned on that
histogram: the longest length left opens the bin, and a subset-sum dynamic programme over
the lengths still available, held in the bits of one integer, finds the fullest feasible
rest. The combination is taken as often as the counts allow and removed. Pieces then find
their place from their number among the pieces of their length, which is a count per task
plus the counts of the tasks before.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orebed.llm.common import columns_of
from orebed.llm.words import id_bytes, pieces
from orebed.session import durable

#: Room for the number of a piece among those of its length, in one integer with the length.
_RANKS = 1 << 48


def fullest(counts: dict[int, int], room: int) -> Counter:
    """Lengths (with repeats, within their counts) whose sum comes closest to room from below.

    Longer lengths are offered first, and the search ends as soon as the room is filled, so
    short ones are left for later bins.
    """
    reach, steps, within = 1, [], (1 << (room + 1)) - 1
    for length in sorted((x for x, n in counts.items() if n and x <= room), reverse=True):
        left, take = min(counts[length], room // length), 1
        while left and not reach >> room & 1:
            take = min(take, left)
            steps.append((length, take, reach))
            reach |= reach << (length * take) & within
            left, take = left - take, take * 2
        if reach >> room & 1:
            break
    target, chosen = reach.bit_length() - 1, Counter()
    for length, take, before in reversed(steps):
        if not before >> target & 1:
            chosen[length] += take
            target -= length * take
    return chosen


def plan(histogram: dict[int, int], limit: int) -> np.ndarray:
    """Rows (length, first number, per bin, first bin, offset in bin) for all pieces.

    Pieces of a length from `first number` on go to bins from `first bin` on, `per bin` of
    them side by side. Every combination uses up a length or its last multiples, so the plan
    is bounded by the limit, not by the number of pieces.
    """
    counts = {x: n for x, n in histogram.items() if n}
    used, bins, rows = Counter(), 0, []
    while counts:
        longest = max(counts)
        counts[longest] -= 1
        chosen = fullest(counts, limit - longest)
        counts[longest] += 1
        chosen[longest] += 1
        times = min(counts[x] // n for x, n in chosen.items())
        offset = 0
        for length, n in sorted(chosen.items(), reverse=True):
            rows.append((length, used[length], n, bins, offset))
            offset += length * n
            used[length] += n * times
            counts[length] -= n * times
            if not counts[length]:
                del counts[length]
        bins += times
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the task's number and each piece's number among those of its length in the task."""
    seen: Counter = Counter()
    task = TaskContext.get().partitionId()
    for batch in batches:
        lengths = batch.column("length").to_numpy()
        order = np.argsort(lengths, kind="stable")
        values, first, n = np.unique(lengths[order], return_index=True, return_counts=True)
        nth = np.empty(len(lengths), dtype=np.int64)
        for value, start, count in zip(values.tolist(), first, n, strict=True):
            nth[order[start : start + count]] = seen[value] + np.arange(count)
            seen[value] += int(count)
        yield batch.append_column("task", pa.array(np.full(len(nth), task, np.int32))).append_column("nth", pa.array(nth))


def _place(rows: np.ndarray):
    starts = rows[:, 0] * _RANKS + rows[:, 1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            at = rows[np.searchsorted(starts, lengths * _RANKS + rank, side="right") - 1]
            nth = rank - at[:, 1]
            out = batch.drop_columns(["rank"])
            out = out.append_column("sequence_id", pa.array(at[:, 3] + nth // at[:, 2]))
            yield out.append_column("offset", pa.array(at[:, 4] + nth % at[:, 2] * lengths))

    return run


def pack(items: DataFrame, limit: int) -> DataFrame:
    """Items with a column `length` (long, 1 to limit) plus sequence_id and offset.

    Every row is placed, repeated ones too; no bin holds more than `limit`, and offsets have
    no gaps from 0. Columns named task, nth, rank, sequence_id or offset must not be there.
    A null, non-positive or longer length raises. An empty table gives an empty table.
    """
    bad = F.col("length").isNull() | (F.col("length") < 1) | (F.col("length") > limit)
    checked = items.withColumn("length", F.when(bad, F.raise_error("length outside 1..limit")).otherwise(F.col("length")).cast("long"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in checked.schema)
    return _packed(durable(checked.mapInArrow(_number, f"{schema}, task int, nth long")), schema, limit)


def _packed(numbered: DataFrame, schema: str, limit: int) -> DataFrame:
    """Numbered items (the columns of schema, task, nth) with their places."""
    per_task = numbered.groupBy("length", "task").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    per_task = durable(per_task.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))))
    # At most `limit` rows come to the driver: one per length.
    histogram = {r["length"]: r["n"] for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    ranked = numbered.join(per_task.drop("n"), ["length", "task"]).withColumn("rank", F.col("base") + F.col("nth"))
    ranked = ranked.select(*[F.col(f"`{c}`") for c in numbered.columns if c not in ("task", "nth")], "rank")
    return ranked.mapInArrow(_place(plan(histogram, limit)), f"{schema}, sequence_id long, offset long")


def _cut(path: str, limit: int, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, tail, step = pieces(path), end.to_bytes(4, "little"), 4 * limit
        for batch in batches:
            texts, which, piece, length, crc = batch.column("text"), [], [], [], []
            for i, text in enumerate(texts):
                ids = id_bytes(cache, text.as_py()) + tail
                for k, at in enumerate(range(0, len(ids), step)):
                    part = ids[at : at + step]
                    which.append(i)
                    piece.append(k)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(which, pa.int64())),
                    pa.array(piece, pa.int32()),
                    pa.array([k * limit for k in piece], pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array(crc, pa.int64()),
                ],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return run


_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def token_pieces(docs: DataFrame, path: str, limit: int, end: int) -> DataFrame:
    """The ids of every whole text, closed by the id `end`, in pieces of at most `limit`.

    Null and empty texts are the end id alone. Only documents longer than the limit are cut;
    their last piece may be shorter. Rows with a null or repeated doc_id are documents of
    their own. Other columns are left out.
    """
    narrow = columns_of(docs, doc_id="long", text="string")
    return narrow.mapInArrow(_cut(path, limit, end), _PIECES)


def pack_documents(docs: DataFrame, path: str, limit: int = 2048, end: int = 0) -> DataFrame:
    """All documents as token pieces, packed into sequences of at most `limit` tokens.

    Like pack(token_pieces(...)), but pieces are numbered where they are cut: one Python worker a task, not two.
    """
    cut = _cut(path, limit, end)
    narrow = columns_of(docs, doc_id="long", text="string")
    return _packed(durable(narrow.mapInArrow(lambda batches: _number(cut(batches)), f"{_PIECES}, task int, nth long")), _PIECES, limit)
