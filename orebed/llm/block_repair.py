"""Repair of conversations by Four-Russians block tables.

A conversation's rows become symbols (role initial, kind of fault). What the rest of it costs
from each of the four states of a legal conversation is a vector; taken relative to its least
entry, only few vectors occur. A table holds, for every vector and every block of BLOCK symbols,
the vector before the block and the cost it adds, so a conversation is priced by one lookup a
block, from its end to its start. The cheapest edits are then read from the start: each block is
expanded backward from the vector behind it, and of equally cheap edits the first letter in
ASCII order is taken.

Rows are sorted by Spark and pass through tasks in batches; of a conversation in hand, a
task keeps one symbol a row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orebed.session import durable

#: Symbols of a block of the table.
BLOCK = 4
#: White space, ends of sentences, and the costs of the edits.
SPACE, ENDS = " \t\n\x0b\x0c\r", (".", "!", "?")
INSERT, REROLE, DELETE, UNFINISHED = 3, 3, 4, 3
#: States: nothing yet, after the system row, after a user's, after an assistant's.
START, SYSTEM, USER, ASSISTANT = range(4)
#: Where the initials s, u and a lead from each state, and the one an inserted or reroled row takes.
NEXT = {START: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
NEW = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
NAMES = {USER: "user", ASSISTANT: "assistant"}
#: Symbols: initial (s, u, a, other) and unfinished or not, a row to delete, and no row at all.
INITIALS, GONE, NONE = "sua", 8, 9


def symbol(role: str, fault: str | None) -> int:
    """The symbol of a row; blank and duplicate rows must go."""
    if fault in ("blank", "duplicate"):
        return GONE
    initial = INITIALS.find(role[:1]) if role else -1
    return 2 * (initial if initial >= 0 else 3) + (fault == "truncated")


def edges(state: int, code: int) -> list[tuple[str, int, int]]:
    """(letter, cost, next state) of the edits of a row, in order of letters."""
    if code == NONE:
        return [("", 0, state)]
    out = [("D", DELETE, state)]
    if code != GONE:
        extra = UNFINISHED if code % 2 else 0
        kept = NEXT[state].get(INITIALS[code // 2]) if code // 2 < 3 else None
        out += [("K", extra, kept)] if kept is not None else []
        out.append(("R", REROLE + extra, NEW[state]))
    return out


def with_inserts(costs: list[int]) -> tuple[int, ...]:
    """Costs to go when rows may also be inserted first."""
    costs = list(costs)
    for _ in range(2):  # two insertions in a row lead everywhere that insertions lead
        costs = [min(costs[q], INSERT + costs[NEW[q]]) for q in range(4)]
    return tuple(costs)


#: Costs to go behind the last row: whatever lies between, an assistant's row or nothing ends it.
FAR = 1 << 20
END = with_inserts([0, FAR, FAR, 0])


def before(costs: tuple[int, ...], code: int) -> tuple[int, ...]:
    """Costs to go before a row, from those behind it."""
    return with_inserts([min(cost + costs[to] for _, cost, to in edges(q, code)) for q in range(4)])


class Tables:
    """All normalised vectors, and their transitions by symbol and by block."""

    def __init__(self) -> None:
        self.vectors = [tuple(c - min(END) for c in END)]
        number = {self.vectors[0]: 0}
        steps: list[list[tuple[int, int]]] = []
        for vector in self.vectors:  # grows while it is walked
            row = []
            for code in range(NONE + 1):
                costs = before(vector, code)
                least = min(costs)
                plain = tuple(c - least for c in costs)
                if plain not in number:
                    number[plain] = len(self.vectors)
                    self.vectors.append(plain)
                row.append((number[plain], least))
            steps.append(row)
        self.to = np.array([[to for to, _ in row] for row in steps], np.int32)
        self.adds = np.array([[add for _, add in row] for row in steps], np.int64)
        # Blocks as numbers of BLOCK decimal digits, the first symbol first.
        codes = np.arange((NONE + 1) ** BLOCK)
        self.block_to = np.repeat(np.arange(len(self.vectors))[:, None], len(codes), axis=1)
        self.block_adds = np.zeros_like(self.block_to)
        for i in range(BLOCK):  # from the last symbol to the first
            digit = codes // (NONE + 1) ** i % (NONE + 1)
            self.block_adds += self.adds[self.block_to, digit]
            self.block_to = self.to[self.block_to, digit]
        self.expand = lru_cache(maxsize=100_000)(self._expand)

    def _expand(self, block: int, vector: int, state: int) -> tuple[str, int]:
        """Edits of a block entered in a state, with the vector behind it; the state it is left in."""
        digits = [block // (NONE + 1) ** i % (NONE + 1) for i in reversed(range(BLOCK))]
        behind = [self.vectors[vector]]
        for code in reversed(digits):
            behind.append(before(behind[-1], code))
        behind.reverse()
        out = []
        for code, here, after in zip(digits, behind, behind[1:], strict=False):
            letter = "I"
            while letter == "I":
                choices = [*edges(state, code), ("I", INSERT, NEW[state])] if code != NONE else edges(state, code)
                # Of the cheapest ones the first letter; every insertion lowers the cost to go.
                fits = [(x, to) for x, cost, to in choices if cost + (here if x == "I" else after)[to] == here[state]]
                letter, state = min(fits)
                out.append(letter)
        return "".join(out), state

    def plan(self, symbols: bytes) -> tuple[int, str]:
        """Cost and letters of the cheapest edits of a conversation, of equal ones the least in ASCII."""
        digits = np.frombuffer(symbols + bytes([NONE]) * (-len(symbols) % BLOCK), np.uint8).reshape(-1, BLOCK)
        blocks = (digits.astype(np.int64) @ (NONE + 1) ** np.arange(BLOCK - 1, -1, -1)).tolist()
        behind, cost, vector = [0] * len(blocks), 0, 0
        for k in range(len(blocks) - 1, -1, -1):
            behind[k] = vector
            cost += int(self.block_adds[vector, blocks[k]])
            vector = int(self.block_to[vector, blocks[k]])
        cost += self.vectors[vector][START]
        letters, state = [], START
        for block, vector in zip(blocks, behind, strict=True):
            part, state = self.expand(block, vector, state)
            letters.append(part)
        while END[state]:
            letters.append("I")
            state = NEW[state]
        return cost, "".join(letters)


@lru_cache(maxsize=1)
def tables() -> Tables:
    """The worker's tables; their size depends on the costs alone."""
    return Tables()


def _plain(name: str, kind: str) -> Column:
    return F.coalesce(F.col(name).cast(kind), F.lit(" "))


def damage(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) with planted faults, by checksum of conversation and turn.

    Of twenty rows one is dropped, one emptied, one loses its sentence ends, one is repeated, one
    becomes a user's; nulls count as one space.
    """
    key = F.concat(_plain("conv_id", "string"), F.lit(":"), _plain("turn", "string")).cast("binary")
    text, kind = _plain("text", "string"), F.crc32(key) % 20
    copies = F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    changed = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    rows = conversations.where(kind != 0).select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.when(kind == 4, "user").otherwise(_plain("role", "string")).alias("role"),
        changed.alias("text"),
        F.explode(copies).alias("copy"),
    )
    return rows.drop("copy")


def described(rows: DataFrame) -> DataFrame:
    """Rows with a digest of their text and its faults; nulls in role and text count as one space."""
    text = _plain("text", "string")
    trimmed = F.rtrim(text, F.lit(SPACE))
    return rows.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        _plain("role", "string").alias("role"),
        text.alias("text"),
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"),
        (trimmed == "").alias("blank"),
        (~F.right(trimmed, F.lit(1)).isin(*ENDS)).alias("unfinished"),
    )


ORDER = ["conv_id", "is_row", "turn", "role", "digest"]


def in_order(headers: DataFrame, rows: DataFrame) -> DataFrame:
    """Each conversation's header, then its rows by turn (nulls first), role and text digest."""
    both = headers.withColumn("is_row", F.lit(False)).unionByName(rows.withColumn("is_row", F.lit(True)), allowMissingColumns=True)
    return both.repartition("conv_id").sortWithinPartitions(*ORDER)


class Report:
    """Counts and symbols of the conversation in hand."""

    def __init__(self, conv_id) -> None:
        self.conv_id = conv_id
        self.counts = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.illegal = self.distinct = 0
        self.low = self.high = self.last = None
        self.symbols = bytearray()

    def add(self, turn, role: str, digest: bytes, earlier: bool, blank: bool, unfinished: bool) -> None:
        # Equal rows of one turn follow each other: only the first of them is no duplicate.
        again = earlier or self.last == (turn, role, digest)
        fault = "blank" if blank else "duplicate" if again else "truncated" if unfinished else None
        if fault:
            self.counts[fault] += 1
        if self.last and self.last[1][:1] + role[:1] not in ("su", "ua", "au"):
            self.illegal += 1
        if turn is not None and turn != self.high:
            self.low = turn if self.low is None else self.low
            self.high = turn
            self.distinct += 1
        self.last = (turn, role, digest)
        self.symbols.append(symbol(role, fault))

    def row(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.distinct
        cost, audit = tables().plan(bytes(self.symbols))
        return (self.conv_id, gaps, *self.counts.values(), self.illegal, cost, audit)


_FIELDS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def _plans(kind: pa.DataType):
    kinds = [kind, *[pa.int64()] * len(_FIELDS), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        report = None
        for batch in batches:
            done = []
            for is_row, conv_id, *rest in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if is_row:
                    report.add(*rest)
                else:
                    if report:
                        done.append(report.row())
                    report = Report(conv_id)
            if done:
                yield as_batch(done)
        if report:
            yield as_batch([report.row()])

    def as_batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["conv_id", *_FIELDS, "audit"]
        )

    return run


def plans(conv_ids: DataFrame, rows: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit.

    rows is described(); conv_ids has one row per conversation, those without rows included.
    """
    narrow = rows.select("conv_id", "turn", "role", "digest", "blank", "unfinished")
    turn = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    first = narrow.groupBy("conv_id", "role", "digest").agg(F.min(turn).alias("first"))
    first = first.select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"), "first")
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d"))
    joined = narrow.join(first, same).withColumn("earlier", turn != F.col("first")).drop("c", "r", "d", "first")
    stream = in_order(conv_ids, joined).select("is_row", "conv_id", "turn", "role", "digest", "earlier", "blank", "unfinished")
    kind = T.StructType([conv_ids.schema["conv_id"], *[T.StructField(f, T.LongType()) for f in _FIELDS], T.StructField("audit", T.StringType())])
    return stream.mapInArrow(_plans(_arrow(conv_ids)), kind)


def _arrow(frame: DataFrame) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(frame.schema["conv_id"].dataType)


class Editor:
    """Applies a conversation's letters to its rows in order; gives the rows that it then has."""

    def __init__(self, audit: str) -> None:
        self.audit, self.at, self.state = audit, 0, START

    def _new(self) -> str:
        self.state = NEW[self.state]
        return NAMES[self.state]

    def inserted(self) -> Iterator[tuple[str, str]]:
        while self.audit[self.at : self.at + 1] == "I":
            self.at += 1
            yield self._new(), ""

    def row(self, role: str, text: str) -> Iterator[tuple[str, str]]:
        yield from self.inserted()
        letter, self.at = self.audit[self.at], self.at + 1
        if letter == "K":
            self.state = NEXT[self.state][role[0]]
            yield role, text
        elif letter == "R":
            yield self._new(), text


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Per batch: (conv_id, None) where a conversation starts, else its rows (conv_id, (role, text)) after repair."""
    editor, held = None, None
    for batch in batches:
        out = []
        for is_row, conv_id, audit, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if is_row:
                out += [(held, line) for line in editor.row(role, text)]
            else:
                if editor:
                    out += [(held, line) for line in editor.inserted()]
                editor, held = Editor(audit), conv_id
                out.append((held, None))
        yield out
    if editor:
        yield [(held, line) for line in editor.inserted()]


def _digests(kind: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, sha, lines, started = None, hashlib.sha256(), 0, False
        for events in _edited(batches):
            done = []
            for conv_id, line in events:
                if line is None:
                    if started:
                        done.append((held, sha.hexdigest()))
                    held, sha, lines, started = conv_id, hashlib.sha256(), 0, True
                else:
                    sha.update(f"{chr(10) if lines else ''}{line[0]}:{line[1]}".encode())
                    lines += 1
            if done:
                yield as_batch(done)
        if started:
            yield as_batch([(held, sha.hexdigest())])

    def as_batch(rows: list[tuple]) -> pa.RecordBatch:
        ids, digests = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(ids, kind), pa.array(digests)], names=["conv_id", "repaired_sha256"])

    return run


def _lines(kind: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = 0
        for events in _edited(batches):
            rows = []
            for conv_id, line in events:
                at = 0 if line is None else at + 1
                if line is not None:
                    rows.append((conv_id, at - 1, *line))
            columns = list(zip(*rows, strict=True)) or [()] * 4
            kinds = [kind, pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["conv_id", "turn", "role", "text"]
            )

    return run


def _ids(conversations: DataFrame) -> DataFrame:
    return conversations.select("conv_id").distinct()


def repaired(conversations: DataFrame) -> DataFrame:
    """The conversations after the cheapest repair: conv_id, turn (from 0), role, text.

    Every result is an optional system row and then a user's and an assistant's in turn, or has no
    rows at all. Blank and repeated rows go, rows of a wrong role are given another or go, missing
    ones are inserted with empty text. Rows are taken by turn (nulls first), equal turns by role and text
    digest; null roles and texts count as one space, rows with a null conv_id as one conversation.
    Other columns are left out; an empty table gives an empty table.
    """
    rows = durable(described(conversations))
    found = durable(plans(_ids(conversations), rows))
    stream = in_order(found.select("conv_id", "audit"), rows).select("is_row", "conv_id", "audit", "role", "text")
    kind = T.StructType([conversations.schema["conv_id"]]).add("turn", "long").add("role", "string").add("text", "string")
    return stream.mapInArrow(_lines(_arrow(conversations)), kind)


def repair_report(conversations: DataFrame) -> DataFrame:
    """One row per conv_id, for its rows after damage(): conv_id, gaps, blank, duplicate, truncated,
    illegal, cost, audit, repaired_sha256.

    A conversation without rows after damage has zeros, no edits and the digest of an empty
    string; ties, nulls and other columns as in repaired().
    """
    rows = durable(described(damage(conversations)))
    found = durable(plans(_ids(conversations), rows))
    stream = in_order(found.select("conv_id", "audit"), rows).select("is_row", "conv_id", "audit", "role", "text")
    kind = T.StructType([conversations.schema["conv_id"]]).add("repaired_sha256", "string")
    digests = stream.mapInArrow(_digests(_arrow(conversations)), kind).withColumnRenamed("conv_id", "id")
    same = F.col("conv_id").eqNullSafe(F.col("id"))
    return found.join(digests, same).select("conv_id", *_FIELDS, "audit", "repaired_sha256")
