"""Shared helpers: input columns, batch bounds, frequent keys, connected components."""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orebed.session import durable

#: Bounds of one Arrow batch, so that very long texts cannot fill a Python worker.
BATCH_BYTES, BATCH_ROWS = 8 << 20, 4000
#: Counters of one Misra-Gries summary; at most this many keys are ever broadcast.
COUNTERS = 1024


def bounded_batches(spark: SparkSession, batch_bytes: int = BATCH_BYTES) -> None:
    """Bound the Arrow batches of this session in bytes as well as rows."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(batch_bytes))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


@lru_cache(maxsize=1)
def _ship(context) -> None:
    """Send the package to Python workers that would not find it by their own path."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)]
    if root not in map(os.path.abspath, filter(None, known)):
        folder = tempfile.mkdtemp()
        context.addPyFile(shutil.make_archive(f"{folder}/orebed", "zip", root, "orebed"))


def ready(spark: SparkSession, batch_bytes: int = BATCH_BYTES) -> None:
    """Bound the session's Arrow batches, and see that its workers find this package."""
    bounded_batches(spark, batch_bytes)
    _ship(spark.sparkContext)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, in a session made ready for the operators."""
    ready(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def columns_of(df: DataFrame, **kinds: str) -> DataFrame:
    """Only the named columns, cast to the given types; others, whatever their names, are left out."""
    return df.select(*[df[name].cast(kind).alias(name) for name, kind in kinds.items()])


def _summaries(key: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, int] = {}
        rows = 0
        for batch in batches:
            rows += len(batch)
            counts = batch[key].value_counts()
            for value, n in counts.items():
                held[value] = held.get(value, 0) + int(n)
            if len(held) > COUNTERS:
                # Take away the (COUNTERS + 1)-th largest count from all: what Misra-Gries
                # does one by one, for a whole batch.
                cut = sorted(held.values(), reverse=True)[COUNTERS]
                held = {v: n - cut for v, n in held.items() if n > cut}
        out = {key: [*held, None], "n": [*held.values(), 0], "rows": [0] * len(held) + [rows]}
        yield pd.DataFrame(out)

    return run


def frequent(df: DataFrame, key: str) -> list[str]:
    """Candidates for the most frequent values of a string column, COUNTERS + 1 at most.

    Every partition keeps a Misra-Gries summary of COUNTERS counters; summaries are added
    up in Spark. A summary is short of a value's count by rows / (COUNTERS + 1) at most, so
    each value in more than 2 / (COUNTERS + 1) of all rows has a sum of at least
    1 / (COUNTERS + 1) of them, and no more than COUNTERS + 1 values can have that: the
    bound of what comes to the driver. Nulls are not counted.
    """
    kind = f"{key} string, n long, rows long"
    summed = durable(
        df.select(key).mapInPandas(_summaries(key), kind).groupBy(key).agg(F.sum("n").alias("n"), F.sum("rows").alias("rows"))
    )
    rows = summed.where(F.col(key).isNull()).agg(F.sum("rows")).first()[0] or 0
    found = summed.where(F.col(key).isNotNull() & (F.col("n") * (COUNTERS + 1) >= rows) & (F.col("n") > 1))
    return [r[0] for r in found.select(key).collect()]


def stars(links: Iterable[tuple]) -> list[tuple]:
    """Links as stars around the smallest node of each component: as connected, fewer than nodes."""
    above: dict = {}

    def top(node):
        while above.setdefault(node, node) != node:
            above[node] = above[above[node]]
            node = above[node]
        return node

    for a, b in links:
        a, b = top(a), top(b)
        if a != b:
            above[max(a, b)] = min(a, b)
    return [(node, top(node)) for node in above if top(node) != node]


def _forest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield pd.DataFrame(stars(zip(batch["a"], batch["b"], strict=True)), columns=["a", "b"])


def components(links: DataFrame, kind: str) -> DataFrame:
    """Connected components of links (a, b): rows (node, component), component = smallest node.

    Nodes are of type `kind`, compared as Spark and Python do alike (long, or ASCII string).
    Batches of links are first thinned to local stars. Then every node takes the smallest
    label among its neighbours and afterwards the label of its label, until nothing changes;
    each round is written to the shared folder, so labels never pass through the driver.
    """
    spark = links.sparkSession
    thin = durable(links.select("a", "b").mapInPandas(_forest, f"a {kind}, b {kind}"))
    both = durable(thin.union(thin.select("b", "a")).distinct())
    labels = durable(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("component")))
    while True:
        seen = labels.select(F.col("node").alias("b"), F.col("component").alias("theirs"))
        near = both.join(seen, "b").groupBy(F.col("a").alias("node")).agg(F.min("theirs").alias("theirs"))
        step = durable(
            labels.join(near, "node").select(
                "node", F.least("component", "theirs").alias("component"), F.col("component").alias("old")
            )
        )
        jump = step.select(F.col("node").alias("component"), F.col("component").alias("further"))
        after = durable(
            step.join(jump, "component", "left").select(
                "node",
                F.coalesce("further", "component").alias("component"),
                (F.coalesce("further", "component") != F.col("old")).alias("changed"),
            )
        )
        labels = after.select("node", "component")
        if after.where("changed").isEmpty():
            return labels


def crc32_mod(column: str, modulus: int):
    """crc32 of a column's decimal text, modulo; null stays null."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % modulus
