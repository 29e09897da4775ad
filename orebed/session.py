"""Session helpers: tuned builder, shared work folder, lineage cut."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "orebed", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the library relies on.

    AQE re-plans joins at run time, splits skewed join partitions and merges
    small ones. The number of shuffle partitions is left to the caller.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.optimizer.runtime.bloomFilter.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@lru_cache(maxsize=1)
def _shipped(context) -> None:
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    known = [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)]
    if root not in map(os.path.abspath, filter(None, known)):
        # Only the archive that the driver hands out lies here, no data.
        folder = tempfile.mkdtemp()
        context.addPyFile(shutil.make_archive(f"{folder}/orebed", "zip", root, "orebed"))


def ship_package(spark: SparkSession) -> None:
    """See that Python workers find this package where they would not by their own path."""
    _shipped(spark.sparkContext)


@contextmanager
def open_writers(spark: SparkSession, most: int = 64) -> Iterator[None]:
    """Tasks write up to ``most`` folders side by side in place of sorting their rows by folder."""
    setting = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(setting)
    spark.conf.set(setting, most)
    try:
        yield
    finally:
        spark.conf.set(setting, before)


@contextmanager
def tidy_shuffles(spark: SparkSession) -> Iterator[None]:
    """Queries run inside remove their shuffle files at their end, not when the driver collects garbage.

    For writes: a frame whose own plan is executed again would first compute its shuffles again.
    """
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, True)
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def _shared_root(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    # The warehouse is shared wherever tables are.
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_work"


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh path under the shared folder named by spark.checkpoint.dir."""
    return f"{_shared_root(spark).rstrip('/')}/{purpose}-{uuid.uuid4().hex[:12]}"


def durable(df: DataFrame, compression: str | None = None) -> DataFrame:
    """Write a frame to the shared folder once and go on from the files.

    Lost executors then cost no recomputation, every later use sees the same rows,
    and each reads only its columns. ``compression`` is the session's own if not given.
    """
    spark = df.sparkSession
    path = work_dir(spark, "cut")
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)
