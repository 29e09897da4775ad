"""Benchmark decontamination by a generalised suffix automaton.

The automaton holds every run of consecutive words of the test items. A document's words are
streamed through it: its state is the longest run of words, ending here, that some item has.
Where that run is as long as a window, or ends with a whole item that is shorter than one,
its words are hit, and the state names the items.

Benchmarks of any size are cut into blocks of about BLOCK words, each an automaton of its
own; documents meet one block after the other, so what a task holds stays bounded.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orebed.llm.common import columns_of
from orebed.session import durable

#: Words of one automaton (half as many are expected), and of one piece of a long item.
BLOCK, PIECE = 200_000, 4000
#: What is not part of a word, after lower-casing A-Z; other bytes belong to words.
SPACES = bytes(
    c + 32 if 65 <= c <= 90 else 32 if c <= 0x2F or 0x3A <= c <= 0x60 or 0x7B <= c <= 0x7F else c for c in range(256)
)
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def words_of(text: bytes) -> list[bytes]:
    """Lower-case (A-Z only) words of UTF-8 text."""
    return text.translate(SPACES).split()


class Automaton:
    """Suffix automaton of several word sequences, with the items of every window.

    Transitions lie in one dict under state * words + word. `length` is the longest run of a
    state, `link` the state of its longest suffix that other places share.
    """

    def __init__(self, items: list[tuple[list[bytes], list[str | None], bool]], window: int):
        """Items are (words, ids, whole): whole is false for a piece of a longer item."""
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        for words, _, _ in items:
            for word in words:
                self.vocabulary.setdefault(word, len(self.vocabulary))
        self.words = max(1, len(self.vocabulary))
        self.go: dict[int, int] = {}
        self.length, self.link = [0], [-1]
        self._out: list[list[int]] = [[]]  # words that leave each state, needed to clone it
        coded = [[self.vocabulary[w] for w in words] for words, _, _ in items]
        for codes in coded:
            last = 0
            for code in codes:
                last = self._extend(last, code)
        #: State -> items whose window it is, for full windows and by length for short items.
        self.found: dict[int, list[str | None]] = {}
        self.short: dict[int, dict[int, list[str | None]]] = {}
        self.shortest = window
        for codes, (_, ids, whole) in zip(coded, items, strict=True):
            if whole and codes and len(codes) < window:
                self.shortest = min(self.shortest, len(codes))
            for state, length in self._windows(codes, whole):
                place = self.found if length == window else self.short.setdefault(state, {})
                place.setdefault(state if length == window else length, []).extend(ids)
        # Nearest state up the links, itself included, that has short items.
        self.above = [0] * len(self.link)
        for state in sorted(range(1, len(self.link)), key=self.length.__getitem__):
            self.above[state] = state if state in self.short else self.above[self.link[state]]
        pairs = {a * self.words + b for codes in coded for a, b in zip(codes, codes[1:], strict=False)}
        self.pairs = np.array(sorted(pairs), np.int64)
        del self._out

    def _extend(self, last: int, code: int) -> int:
        go, words, length, link = self.go, self.words, self.length, self.link
        there = go.get(last * words + code)
        if there is not None:
            return there if length[there] == length[last] + 1 else self._clone(last, there, code)
        state = self._state(length[last] + 1)
        at = last
        while at >= 0 and (at * words + code) not in go:
            go[at * words + code] = state
            self._out[at].append(code)
            at = link[at]
        if at < 0:
            link[state] = 0
        else:
            there = go[at * words + code]
            link[state] = there if length[there] == length[at] + 1 else self._clone(at, there, code)
        return state

    def _state(self, length: int) -> int:
        self.length.append(length)
        self.link.append(0)
        self._out.append([])
        return len(self.length) - 1

    def _clone(self, at: int, there: int, code: int) -> int:
        go, words = self.go, self.words
        copy = self._state(self.length[at] + 1)
        self._out[copy] = list(self._out[there])
        for c in self._out[there]:
            go[copy * words + c] = go[there * words + c]
        self.link[copy], self.link[there] = self.link[there], copy
        while at >= 0 and go.get(at * words + code) == there:
            go[at * words + code] = copy
            at = self.link[at]
        return copy

    def _windows(self, codes: list[int], whole: bool) -> set[tuple[int, int]]:
        """(state, length) of each distinct window of an item."""
        size = self.window if len(codes) >= self.window else len(codes) if whole else 0
        found, state = set(), 0
        for i, code in enumerate(codes if size else []):
            state = self.go[state * self.words + code]
            if i + 1 >= size:
                # The state of the last `size` words: up the links while they are in a shorter one.
                while self.length[self.link[state]] >= size:
                    state = self.link[state]
                found.add((state, size))
        return found

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str | None]]:
        """Stretches (first, end) of words inside windows, not overlapping, and the items met."""
        spans: list[list[int]] = []
        items: set[str | None] = set()
        for first, end in self._candidates(words):
            self._stream(words, first, end, spans, items)
        return [tuple(s) for s in spans], items

    def _candidates(self, words: list[bytes]) -> Iterator[tuple[int, int]]:
        """Stretches of words that the automaton can follow far enough for a window.

        At an unknown word, or between two words that follow each other in no item, the matching
        run starts anew, so a stretch between such places that is too short needs no streaming.
        """
        least = self.shortest
        if len(words) < least:
            return
        codes = np.fromiter(map(self.vocabulary.get, words, repeat(-1)), np.int64, len(words))
        joined = (codes[:-1] >= 0) & (codes[1:] >= 0)
        at = np.flatnonzero(joined)
        if len(at):
            pairs = codes[at] * self.words + codes[at + 1]
            near = np.minimum(np.searchsorted(self.pairs, pairs), max(len(self.pairs) - 1, 0))
            joined[at] = self.pairs[near] == pairs if len(self.pairs) else False
        cuts = np.flatnonzero(~joined) + 1
        firsts, ends = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(words)]])
        for k in np.flatnonzero((ends - firsts >= least) & (codes[firsts] >= 0)):
            yield int(firsts[k]), int(ends[k])

    def _stream(self, words: list[bytes], first: int, end: int, spans: list[list[int]], items: set) -> None:
        go, size, link, length, window = self.go, self.words, self.link, self.length, self.window
        state = run = 0
        for i in range(first, end):
            code = self.vocabulary[words[i]]
            there = go.get(state * size + code)
            while there is None and state:
                state = link[state]
                run = length[state]
                there = go.get(state * size + code)
            if there is None:
                continue
            state, run = there, run + 1
            # A link's run is whole, so `run` never exceeds the state's length.
            reach = 0
            if run >= window:
                reach, at = run, state
                while length[link[at]] >= window:
                    at = link[at]
                items.update(self.found.get(at, ()))
            at = self.above[state]
            while at:
                for size_of, ids in self.short[at].items():
                    if size_of <= run:
                        reach = max(reach, size_of)
                        items.update(ids)
                at = self.above[link[at]]
            if reach:
                start = i + 1 - reach
                while spans and spans[-1][0] >= start:
                    spans.pop()
                if spans and spans[-1][1] >= start:
                    spans[-1][1] = i + 1
                else:
                    spans.append([start, i + 1])


def _pieces(window: int):
    """Items as pieces that overlap by a window less one word: (item_id, words, whole, part)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for item, text in zip(batch.column("item_id").to_pylist(), batch.column("text"), strict=True):
                words = words_of((text.as_py() or "").encode())
                starts = range(0, max(1, len(words) - window + 1), PIECE)
                for at in starts if words else ():
                    part = b" ".join(words[at : at + PIECE + window - 1]).decode()
                    rows.append((item, part, len(starts) == 1, min(len(words) - at, PIECE + window - 1)))
            columns = list(zip(*rows, strict=True)) or [()] * 4
            kinds = [pa.string(), pa.string(), pa.bool_(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["item_id", "part", "whole", "n"]
            )

    return run


@lru_cache(maxsize=1)
def automaton_of(parts: tuple[tuple[str, tuple[str | None, ...], bool], ...], window: int) -> Automaton:
    """The worker's automaton for one block, built once for all its tasks."""
    return Automaton([(p.encode().split(), list(ids), whole) for p, ids, whole in parts], window)


def _mark(parts: tuple[tuple[str, tuple[str | None, ...], bool], ...], window: int):
    spans_type = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = automaton_of(parts, window)
        for batch in batches:
            counts, spans, items = [], [], []
            earlier = zip(batch.column("__spans").to_pylist(), batch.column("__items").to_pylist(), strict=True)
            for text, (old_spans, old_items) in zip(batch.column("text"), earlier, strict=True):
                words = words_of((text.as_py() or "").encode())
                hit, found = automaton.hits(words)
                counts.append(len(words))
                spans.append([{"first": a, "end": b} for a, b in united([*hit, *((s["first"], s["end"]) for s in old_spans)])])
                items.append(sorted({i for i in found if i is not None} | set(old_items)))
            new = [pa.array(counts, pa.int64()), pa.array(spans, spans_type), pa.array(items, pa.list_(pa.string()))]
            kept = [i for i, name in enumerate(batch.schema.names) if name not in ("__n_words", "__spans", "__items")]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in kept), *new],
                names=[*(batch.schema.names[i] for i in kept), "__n_words", "__spans", "__items"],
            )

    return run


def united(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted stretches with overlapping and touching ones made one."""
    out: list[tuple[int, int]] = []
    for first, end in sorted(spans):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((first, end))
    return out


def marked(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """All rows and columns of docs plus __n_words, __spans (of words) and __items (sorted ids).

    docs has a string column `text`; null counts as empty. Benchmark rows (item_id, text) of one
    id are one item; rows without words have no window; rows without an id mark words but are
    not listed. Items with fewer words than a window are one window of their own.
    """
    narrow = columns_of(benchmark, item_id="string", text="string").distinct()
    kind = "item_id string, part string, whole boolean, n long"
    parts = durable(narrow.mapInArrow(_pieces(window), kind).distinct())
    total = parts.agg(F.sum("n")).first()[0] or 0
    blocks = max(1, math.ceil(2 * total / BLOCK)) if total > BLOCK else 1
    block = F.pmod(F.xxhash64("part", "item_id"), F.lit(blocks))
    out = docs.select(
        *[F.col(f"`{c}`") for c in docs.columns],
        F.lit(0).cast("long").alias("__n_words"),
        F.array().cast("array<struct<first: bigint, end: bigint>>").alias("__spans"),
        F.array().cast("array<string>").alias("__items"),
    )
    for k in range(blocks):
        # About BLOCK / 2 words: the bound of what comes to the driver and is shipped at once.
        rows = parts.where(block == k).select("part", "item_id", "whole").collect()
        ids: dict[tuple[str, bool], list[str | None]] = {}
        for part, item, whole in rows:
            ids.setdefault((part, whole), []).append(item)
        texts = tuple((part, tuple(names), whole) for (part, whole), names in ids.items())
        out = out.mapInArrow(_mark(texts, window), out.schema)
        if k < blocks - 1:
            out = durable(out)
    return out


def _hit(spans: str = "__spans") -> Column:
    return F.aggregate(spans, F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["first"])


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, spans (of words), items (sorted ids).

    A word is hit inside any occurrence of a window: `window` consecutive words of an item, or
    all words of a shorter item. Null and empty texts have no words; repeated rows give repeated
    rows; columns of other names are left out; empty tables give no rows, or no hits.
    """
    out = marked(columns_of(docs, doc_id="long", text="string"), benchmark, window)
    return out.select(
        "doc_id", F.col("__n_words").alias("n_words"), _hit().alias("n_hit"), F.col("__spans").alias("spans"), F.col("__items").alias("items")
    )


def report(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """contamination() in numbers: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    return contamination(docs, benchmark, window).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def cut(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of the given stretches and what lies between them."""
    raw = text.encode()
    ends = [m.span() for m in _WORD.finditer(raw.translate(_LOWER))]
    out, at = [], 0
    for first, end in spans:
        out.append(raw[at : ends[first][0]])
        at = ends[end - 1][1]
    return b"".join([*out, raw[at:]]).decode()


def _cut(text: str, spans: str) -> Column:
    def run(texts: pd.Series, found: pd.Series) -> pd.Series:
        pairs = zip(texts, found, strict=True)
        return pd.Series([cut(t, [(s["first"], s["end"]) for s in f]) if len(f) else t for t, f in pairs], dtype=object)

    return F.pandas_udf(run, "string")(text, spans)


def without_benchmark(docs: DataFrame, benchmark: DataFrame, window: int = 10, longest: int = 10, coverage: float = 0.5) -> DataFrame:
    """The documents without benchmark passages, in the columns of docs.

    Stretches of hit words longer than `longest` or equal to it are taken out of the text;
    documents with a greater share of hit words than `coverage` go as a whole. Texts without
    such stretches, null and empty ones stay as they are; n_chars, if there, counts the new text.
    """
    found = marked(docs, benchmark, window)
    share = _hit() / F.greatest(F.col("__n_words"), F.lit(1))
    long = F.filter("__spans", lambda s: s["end"] - s["first"] >= longest)
    kept = found.where(share <= coverage).withColumn("__spans", long)
    text = F.when(F.size("__spans") > 0, _cut("text", "__spans")).otherwise(F.col("text"))
    out = kept.withColumn("text", text)
    if "n_chars" in docs.columns:
        changed = F.when(F.size("__spans") > 0, F.length("text").cast(docs.schema["n_chars"].dataType))
        out = out.withColumn("n_chars", changed.otherwise(F.col("n_chars")))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])
