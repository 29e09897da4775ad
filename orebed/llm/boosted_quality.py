"""Quality classifier: histogram gradient-boosted trees over document statistics.

Trees are grown level by level on binned statistics of a bounded sample of labelled rows and
flattened into arrays, through which numpy sends all documents of a batch at once.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orebed.llm.common import columns_of, crc32_mod
from orebed.llm.words import forget
from orebed.session import durable

#: About this many labelled rows are learned from, by a hash of their id.
LEARNED = 20000
TREES, DEPTH, BINS, RATE, SMOOTHING, LEAST = 120, 4, 48, 0.15, 1.0, 20

_SPACE, _LOWER, _UPPER, _DIGIT, _MARK, _OTHER = range(6)


def _classes() -> np.ndarray:
    """Class of each code point below 0x3000; all beyond count as lower-case letters."""
    table = np.full(0x3000, _OTHER, dtype=np.uint8)
    for c in range(0x3000):
        s = chr(c)
        if s.isspace():
            table[c] = _SPACE
        elif s.isalpha():
            table[c] = _UPPER if s.isupper() else _LOWER
        elif s.isdigit():
            table[c] = _DIGIT
        elif s in ".,;:?'\"()-":
            table[c] = _MARK
    return table


_CLASS = _classes()
STATISTICS = (
    "characters words lines word_length word_length_sd short_words long_words upper digit mark other "
    "title_words odd_ends lone_symbols stops distinct top_word again_next distinct_pairs distinct_lines "
    "line_words compressed upper_words ends_in_mark"
).split()


def statistics(text: str | None) -> list[float]:
    """The statistics of a whole text, in the order of STATISTICS; null counts as empty."""
    text = text or ""
    words, lines = text.split(), text.split("\n")
    n = len(words)
    if not n:
        return [float(len(text)), 0.0, float(len(lines))] + [0.0] * (len(STATISTICS) - 3)
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    share = np.bincount(np.where(points < 0x3000, _CLASS[np.minimum(points, 0x2FFF)], _LOWER), minlength=6)
    seen = len(points) - share[_SPACE]
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=n)
    counts = Counter(words)
    odd = titles = lone = upper = ends = 0
    for word, k in counts.items():
        last = word[-1]
        odd += k * (not last.isalnum() and last not in ".,;:?'\")")
        ends += k * (last in ".!?")
        titles += k * word[0].isupper()
        upper += k * (len(word) > 1 and word.isupper())
        lone += k * (len(word) == 1 and not last.isalnum())
    raw = text.encode("utf-8", "surrogatepass")
    return [
        float(len(text)),
        float(n),
        float(len(lines)),
        float(lengths.mean()),
        float(lengths.std()),
        float((lengths <= 3).mean()),
        float((lengths > 12).mean()),
        share[_UPPER] / seen,
        share[_DIGIT] / seen,
        share[_MARK] / seen,
        share[_OTHER] / seen,
        titles / n,
        odd / n,
        lone / n,
        sum(1 for w in words if w[-1] == ".") / n,
        len(counts) / n,
        max(counts.values()) / n,
        sum(map(str.__eq__, words, words[1:])) / n,
        len(set(zip(words, words[1:], strict=False))) / n,
        len(set(lines)) / len(lines),
        n / len(lines),
        len(zlib.compress(raw, 1)) / len(raw),
        upper / n,
        ends / n,
    ]


def matrix(texts: list[str | None]) -> np.ndarray:
    return np.array([statistics(t) for t in texts], dtype=np.float64).reshape(-1, len(STATISTICS))


def train(x: np.ndarray, y: np.ndarray) -> tuple[float, np.ndarray, np.ndarray, np.ndarray]:
    """Base score, and per tree the inner nodes' statistics and thresholds and the leaves' values.

    Node k's children are 2k + 1 and 2k + 2; a node that is not split sends all rows left
    (its threshold is infinite). Without rows the trees say nothing.
    """
    inner, leaves = 2**DEPTH - 1, 2**DEPTH
    feature = np.zeros((TREES, inner), dtype=np.int64)
    threshold = np.full((TREES, inner), np.inf)
    value = np.zeros((TREES, leaves))
    if not len(y):
        return 0.0, feature, threshold, value
    rate = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    base = float(np.log(rate / (1 - rate)))
    width = x.shape[1]
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(width)]
    binned = np.stack([np.searchsorted(edges[j], x[:, j], side="left") for j in range(width)], axis=1)
    score = np.full(len(y), base)
    for t in range(TREES):
        p = 1 / (1 + np.exp(-score))
        gradient, weight = y - p, p * (1 - p)
        node = np.zeros(len(y), dtype=np.int64)
        for level in range(DEPTH):
            first, nodes = 2**level - 1, 2**level
            best = np.zeros(nodes)
            for j in range(width):
                place = (node - first) * BINS + binned[:, j]
                g, h, n = (
                    np.bincount(place, w, nodes * BINS).reshape(nodes, BINS).cumsum(axis=1) for w in (gradient, weight, None)
                )
                all_g, all_h, all_n = g[:, -1:], h[:, -1:], n[:, -1:]
                gain = g**2 / (h + SMOOTHING) + (all_g - g) ** 2 / (all_h - h + SMOOTHING) - all_g**2 / (all_h + SMOOTHING)
                gain[(n < LEAST) | (all_n - n < LEAST)] = 0
                at = gain.argmax(axis=1)
                for k in range(nodes):
                    if gain[k, at[k]] > best[k] + 1e-9 and at[k] < len(edges[j]):
                        best[k] = gain[k, at[k]]
                        feature[t, first + k], threshold[t, first + k] = j, edges[j][at[k]]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[t, node]] > threshold[t, node])
        leaf = node - inner
        g, h = np.bincount(leaf, gradient, leaves), np.bincount(leaf, weight, leaves)
        value[t] = RATE * g / (h + SMOOTHING)
        score += value[t, leaf]
    return base, feature, threshold, value


def predict(model: tuple, x: np.ndarray) -> np.ndarray:
    """Probability of label 1 for each row."""
    base, feature, threshold, value = model
    score, rows = np.full(len(x), base), np.arange(len(x))
    for t in range(TREES):
        node = np.zeros(len(x), dtype=np.int64)
        for _ in range(DEPTH):
            node = 2 * node + 1 + (x[rows, feature[t, node]] > threshold[t, node])
        score += value[t, node - (2**DEPTH - 1)]
    return 1 / (1 + np.exp(-score))


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    forget()
    for batch in batches:
        x = matrix(batch.column("text").to_pylist())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64()))],
            names=["doc_id", "x"],
        )


def learn(docs: DataFrame, labels: DataFrame) -> tuple:
    """The model of about LEARNED labelled documents, those with the smallest hashes of their id.

    A doc_id with several labels takes their majority, 1 if they tie; rows without a label
    or a doc_id are not used. At most that many rows of statistics come to the driver.
    """
    known = columns_of(labels, doc_id="long", quality="double").where("doc_id is not null and quality is not null")
    known = durable(known.groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("y")))
    share = min(1.0, LEARNED / max(1, known.count()))
    near = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30))
    sample = columns_of(docs, doc_id="long", text="string").where(near).mapInArrow(_measure, "doc_id long, x array<double>")
    rows = sample.join(known.where(near), "doc_id").orderBy("doc_id", "x").collect()
    x = np.array([r["x"] for r in rows], dtype=np.float64).reshape(-1, len(STATISTICS))
    return train(x, np.array([r["y"] for r in rows], dtype=np.float64))


def _score(model: tuple, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = predict(model, matrix(batch.column("text").to_pylist()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(score), pa.array((score >= threshold).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    return run


def classify(docs: DataFrame, labels: DataFrame, folds: int = 5, fold: int = 0, threshold: float = 0.3) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    Learns from labelled rows outside the held-out fold (crc32 of the id's text modulo
    `folds`); a null id is in no fold. Null texts count as empty and are scored like any other;
    without labels every score is 0.5. Repeated rows stay; other columns are left out.
    """
    held = F.coalesce(crc32_mod("doc_id", folds) == fold, F.lit(False))
    rows = columns_of(docs, doc_id="long", text="string").withColumn("held_out", held)
    model = learn(rows.where("not held_out"), labels)
    return rows.mapInArrow(_score(model, threshold), "doc_id long, held_out boolean, score double, predicted int")


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """The documents, with all their columns, whose score reaches the threshold."""
    held = F.coalesce(crc32_mod("doc_id", 5) == 0, F.lit(False))
    model = learn(docs.where(~held), labels)

    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        forget()
        for batch in texts:
            yield pd.Series(predict(model, matrix(batch.tolist())))

    return docs.where(F.pandas_udf(score, "double")("text") >= threshold)
