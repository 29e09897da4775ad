"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. An n-gram binds the vectors of its letters,
each permuted by its place, into one vector; a text bundles its n-grams into their sum.
A language's prototype bundles the normalised vectors of its texts, and a document takes
the language whose prototype has the largest cosine with its own vector.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orebed.llm.common import columns_of, crc32_mod
from orebed.session import durable

#: Components of the vectors, letters of an n-gram, symbols that letters map to (0: no letter).
DIMENSIONS, GRAM, SYMBOLS = 512, 3, 128
#: About this many documents of each language are learned from, by a hash of their id.
PER_LANGUAGE = 5000
#: Documents whose counts are multiplied at once, and the characters they may have.
TOGETHER, CHARACTERS = 256, 1 << 20
#: Parts into which a component is rounded, so that sums do not depend on their order.
SCALE = 1 << 20
#: How sharply scores follow differences of cosines.
SHARPNESS = 40.0


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.random.default_rng(20240607).choice(np.array([-1, 1], np.int8), (SYMBOLS, DIMENSIONS))


@lru_cache(maxsize=1)
def _symbols() -> np.ndarray:
    """Symbol of each code point: 0 if it is no letter, a-z 1 to 26, others by a hash."""
    table = np.zeros(0x110000, dtype=np.int64)
    for c in range(0x110000):
        if chr(c).isalpha():
            table[c] = c - 96 if 97 <= c <= 122 else 27 + c * 2654435761 % (1 << 32) % (SYMBOLS - 27)
    return table


def gram_codes(text: str | None) -> np.ndarray:
    """The n-grams of a whole text's letters as numbers; words are framed by one blank."""
    points = np.frombuffer(f" {(text or '').lower()} ".encode("utf-32-le", "surrogatepass"), dtype="<u4")
    symbols = _symbols()[points]
    kept = np.ones(len(symbols), dtype=bool)
    kept[1:] = (symbols[1:] > 0) | (symbols[:-1] > 0)
    symbols = symbols[kept]
    codes = np.zeros(max(0, len(symbols) - GRAM + 1), dtype=np.int64)
    for k in range(GRAM if len(codes) else 0):
        codes = codes * SYMBOLS + symbols[k : len(codes) + k]
    # A text without letters has no n-grams: all of them would be blanks.
    return codes[codes > 0]


def gram_vectors(codes: np.ndarray) -> np.ndarray:
    """Bound vectors of n-grams: letters rolled by their distance to the end, multiplied."""
    out = np.ones((len(codes), DIMENSIONS), dtype=np.int8)
    for k in range(GRAM):
        symbol = codes // SYMBOLS**k % SYMBOLS
        out *= np.roll(_letters(), k, axis=1)[symbol]
    return out


def profiles(texts: list[str | None]) -> np.ndarray:
    """The normalised bundle of each text; zero for texts without letters."""
    out = np.zeros((len(texts), DIMENSIONS), dtype=np.float32)
    at = 0
    while at < len(texts):
        size, end = 0, at
        while end < len(texts) and end - at < TOGETHER and (end == at or size + len(texts[end] or "") <= CHARACTERS):
            size += len(texts[end] or "")
            end += 1
        grams = [np.unique(gram_codes(t), return_counts=True) for t in texts[at:end]]
        known = np.unique(np.concatenate([g for g, _ in grams]))
        counts = np.zeros((end - at, len(known)), dtype=np.float32)
        for i, (codes, n) in enumerate(grams):
            counts[i, np.searchsorted(known, codes)] = n
        out[at:end] = counts @ gram_vectors(known).astype(np.float32)
        at = end
    norms = np.linalg.norm(out, axis=1, keepdims=True)
    return out / np.where(norms > 0, norms, 1)


def _bundle(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        vectors = np.rint(profiles(batch["text"].tolist()).astype(np.float64) * SCALE).astype(np.int64)
        for lang, rows in batch.groupby("lang").indices.items():
            sums[lang] = sums.get(lang, 0) + vectors[rows].sum(axis=0)
    for lang, total in sums.items():
        yield pd.DataFrame({"lang": lang, "i": np.arange(DIMENSIONS), "value": total})


def learn(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages and their prototypes, from rows (doc_id, text, lang) with a lang and a text.

    About PER_LANGUAGE documents of each language are taken, those with the smallest hashes of
    their id; a language with fewer gives all. One vector per language comes to the driver.
    """
    known = docs.where("lang is not null and text is not null").withColumn(
        "place", F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / float(1 << 30)
    )
    sizes = durable(known.groupBy("lang").agg(F.count("*").alias("n")))
    share = sizes.select("lang", (PER_LANGUAGE / F.col("n")).alias("share"))
    taken = known.join(F.broadcast(share), "lang").where("place < share").select("lang", "text")
    sums = taken.mapInPandas(_bundle, "lang string, i int, value long").groupBy("lang", "i").agg(F.sum("value").alias("value"))
    rows = sums.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("i", "value"))).alias("vector")).orderBy("lang").collect()
    vectors = np.array([[v["value"] for v in r["vector"]] for r in rows], dtype=np.float64).reshape(-1, DIMENSIONS)
    return [r["lang"] for r in rows], vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)


def _compare(langs: list[str], prototypes: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = profiles(batch.column("text").to_pylist()).astype(np.float64)
            letters = np.abs(vectors).sum(axis=1) > 0
            if langs:
                cosines = vectors @ prototypes.T
                best = cosines.argmax(axis=1)
                odds = np.exp(SHARPNESS * (cosines - cosines.max(axis=1, keepdims=True)))
                score = np.where(letters, 1 / odds.sum(axis=1), 0.0)
                found = [langs[b] if known else "und" for b, known in zip(best, letters, strict=True)]
            else:
                score, found = np.zeros(len(vectors)), ["und"] * len(vectors)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(found, pa.string()), pa.array(score)],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    return run


def identify(docs: DataFrame, folds: int = 4, fold: int = 2) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score.

    Prototypes come from rows with a lang outside the held-out fold (crc32 of the id's text
    modulo `folds`); a null id is in no fold. lang_pred is `und`, with score 0, for null texts
    and texts without letters, and for all rows if nothing can be learned. Ties go to the
    first language in order. Repeated rows stay; other columns are left out.
    """
    rows = columns_of(docs, doc_id="long", text="string", lang="string")
    held = F.coalesce(crc32_mod("doc_id", folds) == fold, F.lit(False))
    langs, prototypes = learn(rows.where(~held))
    marked = rows.select("doc_id", "text", held.alias("held_out"))
    return marked.mapInArrow(_compare(langs, prototypes), "doc_id long, held_out boolean, lang_pred string, score double")
