"""Near-duplicate vectors by sorted projection passes.

Each pass gives every distinct vector the signs of its products with random directions,
concatenated to one key, and sorts by it; vectors that agree in the whole key are compared all
with all in double precision, however many they are, in pairs of blocks where they are more
than BLOCK. Verified pairs of all passes are united to components. Then the members of each
component are compared with one another, in blocks, so that every vector's links are counted
in full.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orebed.llm.common import components, stars
from orebed.session import durable

#: Evenly spread vectors to a key, members of a block.
WINDOW, BLOCK = 64, 256
#: Share of pairs at the threshold that no pass may bring together.
MISSED = 1e-3


def signs_for(vectors: int) -> int:
    """Signs in a key: as many as leave about WINDOW evenly spread vectors to each."""
    return min(60, max(1, round(math.log2(max(2, vectors) / WINDOW))))


def passes_for(vectors: int, similarity: float) -> int:
    """Passes needed, by the chance that a pair at the threshold agrees on all signs of a key.

    It agrees on each with probability 1 - angle / pi, whatever lies around it, and is then
    compared.
    """
    together = (1 - math.acos(similarity) / math.pi) ** signs_for(vectors)
    return math.ceil(math.log(MISSED) / math.log(1 - min(together, 0.999)))


def normalised(column: pa.Array) -> list[np.ndarray | None]:
    """Unit vectors in double precision; None for null, zero or non-finite ones."""
    out = []
    for value in column:
        x = None if not value.is_valid else value.values
        if x is None or len(x) == 0 or x.null_count:
            out.append(None)
            continue
        x = x.to_numpy(zero_copy_only=False).astype(np.float64)
        largest = np.abs(x).max()
        if not np.isfinite(largest) or largest == 0:
            out.append(None)
            continue
        x = x / largest  # so that squares neither vanish nor overflow
        out.append(x / np.linalg.norm(x))
    return out


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        units = normalised(batch.column("embedding"))
        digests = [None if u is None else hashlib.blake2b(u.tobytes(), digest_size=16).hexdigest() for u in units]
        yield pa.RecordBatch.from_arrays(
            [batch.column("vec_id"), pa.array(digests, pa.string()), pa.array(units, pa.list_(pa.float64()))],
            names=["vec_id", "digest", "unit"],
        )


def _keys(passes: int, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            units = batch.column("unit").to_pylist()
            for size in sorted({len(u) for u in units}):
                rows = [i for i, u in enumerate(units) if len(u) == size]
                if size not in planes:
                    planes[size] = np.random.default_rng(size).standard_normal((size, passes * bits))
                signs = (np.array([units[i] for i in rows]) @ planes[size] > 0).reshape(len(rows), passes, bits)
                keys = signs @ (1 << np.arange(bits - 1, -1, -1, dtype=np.int64))
                digests = batch.column("digest").take(pa.array(rows))
                for k in range(passes):
                    fixed = [pa.array(np.full(len(rows), x, np.int32)) for x in (size, k)]
                    yield pa.RecordBatch.from_arrays(
                        [*fixed, pa.array(keys[:, k]), digests], names=["size", "pass", "key", "digest"]
                    )

    return run


def _same_key(similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        series, names, parts, units = None, [], [], []

        def links() -> pa.RecordBatch:
            found: list[tuple] = []
            if len(names) > 1:
                x, part = np.concatenate(units).reshape(len(names), -1), np.array(parts)
                a, b = np.flatnonzero(part == series[-2]), np.flatnonzero(part == series[-1])
                i, j = np.nonzero(x[a] @ x[b].T >= similarity)
                i, j = a[i], b[j]
                other = i < j if series[-2] == series[-1] else i != j
                # Only the components matter here: dense keys send few links.
                found = stars((names[p], names[q]) for p, q in zip(i[other].tolist(), j[other].tolist(), strict=True))
            return pa.RecordBatch.from_arrays([pa.array([p[k] for p in found], pa.string()) for k in (0, 1)], names=["a", "b"])

        for batch in batches:
            keys = list(zip(*(batch.column(c).to_pylist() for c in ("size", "pass", "key", "left", "right")), strict=True))
            digests, mine, vectors = batch.column("digest").to_pylist(), batch.column("part").to_pylist(), batch.column("unit")
            at = 0
            while at < len(keys):  # one stretch per key and pair of blocks
                end = at
                while end < len(keys) and keys[end] == keys[at]:
                    end += 1
                if keys[at] != series:
                    yield links()
                    series, names, parts, units = keys[at], [], [], []
                names += digests[at:end]
                parts += mine[at:end]
                units.append(vectors.slice(at, end - at).flatten().to_numpy())
                at = end
        yield links()

    return run


def _count_blocks(similarity: float):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        mine, theirs = group[group["mine"]], group[~group["mine"]]
        if mine.empty or theirs.empty:
            return pd.DataFrame({"digest": [], "links": []})
        linked = np.stack(mine["unit"].to_list()) @ np.stack(theirs["unit"].to_list()).T >= similarity
        same = mine["digest"].to_numpy()[:, None] == theirs["digest"].to_numpy()[None, :]
        links = (linked | same) @ theirs["n"].to_numpy()  # a class links with itself whatever the rounding
        return pd.DataFrame({"digest": mine["digest"], "links": links})

    return run


def near_vectors(vectors: DataFrame, similarity: float = 0.95) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Vectors link if their cosine in double precision is at least `similarity` and they have
    as many components. n_links counts the other rows linked directly, component_id is the
    smallest vec_id reachable by links, itself included, and kept marks the rows that carry it.
    Null, empty, zero and non-finite vectors link with nothing. Equal directions are one class.
    A null vec_id is above all others; repeated rows each count. Other columns are left out;
    an empty table gives an empty table.
    """
    narrow = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("embedding"))
    rows = durable(narrow.mapInArrow(_digests, "vec_id long, digest string, unit array<double>"))
    classes = durable(
        rows.where("digest is not null")
        .groupBy("digest")
        .agg(F.min("vec_id").alias("first"), F.count("*").alias("n"), F.first("unit").alias("unit"))
    )
    n = classes.count()
    run = _keys(passes_for(n, similarity), signs_for(n))
    keyed = durable(classes.select("digest", "unit").mapInArrow(run, "size int, pass int, key long, digest string"))
    same = ["size", "pass", "key"]
    shared = durable(keyed.groupBy(*same).agg(F.count("*").alias("rows")).where("rows > 1"))
    blocks = F.floor((F.col("rows") - 1) / BLOCK).cast("int") + 1
    places = keyed.join(shared.select(*same, blocks.alias("blocks")), same)
    # The places of a vector travel together to it, and it goes out with each pair of blocks.
    places = places.groupBy("digest").agg(F.collect_list(F.struct(*same, "blocks")).alias("places"))
    dealt = places.join(classes.select("digest", "unit"), "digest").select("digest", "unit", F.explode("places").alias("p"))
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64("digest"), F.col("p.blocks")).cast("int"))
    dealt = dealt.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("p.blocks") - 1)))
    pair = [F.least("part", "block").alias("left"), F.greatest("part", "block").alias("right")]
    dealt = dealt.select("p.size", "p.pass", "p.key", *pair, "part", "digest", "unit")
    key = [*same, "left", "right"]
    sorted_rows = dealt.repartition(*key).sortWithinPartitions(*key)
    found = durable(sorted_rows.mapInArrow(_same_key(similarity), "a string, b string"))
    labels = durable(components(found, "string"))
    # Blocks of a component's members, in the order of their digests; its size decides how many.
    sizes = labels.groupBy("component").agg(F.count("*").alias("members"))
    spread = F.floor((F.col("members") - 1) / BLOCK).cast("int") + 1
    part = F.pmod(F.xxhash64("digest"), F.col("blocks")).cast("int")
    members = labels.join(sizes, "component").select(F.col("node").alias("digest"), "component", spread.alias("blocks"))
    members = durable(members.join(classes, "digest").withColumn("part", part))
    # A group compares one block, whose members it counts for, with one block of the same component.
    pairs = members.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    mine = pairs.select("component", F.col("part").alias("left"), F.col("block").alias("right"), "digest", "unit", "n", F.lit(True).alias("mine"))
    theirs = pairs.select("component", F.col("block").alias("left"), F.col("part").alias("right"), "digest", "unit", "n", F.lit(False).alias("mine"))
    both = mine.union(theirs)
    counted = both.groupBy("component", "left", "right").applyInPandas(_count_blocks(similarity), "digest string, links long")
    links = durable(counted.groupBy("digest").agg(F.sum("links").alias("links")))
    grouped = members.select("digest", "component", "first")
    smallest = grouped.groupBy("component").agg(F.min("first").alias("component_id"))
    named = durable(
        classes.select("digest", "first", "n")
        .join(grouped.select("digest", "component").join(smallest, "component"), "digest", "left")
        .join(links, "digest", "left")
        .select("digest", F.coalesce("links", "n").alias("links"), F.coalesce("component_id", "first").alias("component_id"))
    )
    out = rows.select("vec_id", "digest").join(named, "digest", "left")
    component = F.when(F.col("digest").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select(
        "vec_id",
        F.coalesce(F.col("links") - 1, F.lit(0)).alias("n_links"),
        component.alias("component_id"),
        component.eqNullSafe(F.col("vec_id")).alias("kept"),
    )
