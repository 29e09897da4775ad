"""A keyed table as partitioned Parquet: the latest row per key by ingest order.

Rows lie in folders by a hash of their key. A batch rewrites the folders it has keys in, and
no others: their rows and the batch's pass ``keep_latest`` together and replace them by a
dynamic partition overwrite. Which row stays depends on the ingest order alone, so batches,
replays and rebuilds may arrive in any order and more than once, and a batch costs what its
folders hold, however many batches came before. Readers read the folder; there is nothing
to merge or to compact.

A table has one writer at a time, as a streaming query is. Before a folder is replaced, its new
rows are complete under ``staged``; a batch that is repeated after a failure finishes from there.

Where the catalog supports row-level changes, ``merge_into`` does the same with MERGE.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orebed.operators.latest import keep_latest, latest_order
from orebed.session import open_writers


class KeyedTable:
    """``buckets`` is fixed when a table is first written and part of its folder names: opened with
    another number, the table is not readable rather than wrong."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        keys: Sequence[str],
        order: Callable[[DataFrame], Sequence[Column]] = latest_order,
        buckets: int = 16,
    ):
        self.spark, self.root = spark, root.rstrip("/")
        self.keys, self.order, self.buckets = list(keys), order, buckets
        self.bucket = f"_bucket_of_{buckets}"

    def _read(self, folder: str) -> DataFrame | None:
        try:
            return self.spark.read.parquet(f"{self.root}/{folder}")
        except AnalysisException as error:
            if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            return None

    def _rows(self) -> DataFrame | None:
        rows = self._read("rows")
        if rows is not None and self.bucket not in rows.columns:
            raise ValueError(f"{self.root} was not written in {self.buckets} buckets")
        return rows

    def read(self) -> DataFrame | None:
        """Current rows; None before anything was written. To be read anew after the next write."""
        rows = self._rows()
        return None if rows is None else rows.drop(self.bucket)

    def view(self, name: str) -> None:
        """Point a temporary view at the current state."""
        current = self.read()
        if current is None:
            raise FileNotFoundError(f"nothing written under {self.root}")
        current.createOrReplaceTempView(name)

    def _placed(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.bucket, F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int"))

    def _numbers(self, rows: DataFrame) -> list[int]:
        """Buckets that rows are in: as many values as there are buckets, at most."""
        return [r[0] for r in rows.select(self.bucket).distinct().collect()]

    def _stage(self, rows: DataFrame, of: str) -> DataFrame:
        """Write the new rows of buckets to the side, then a mark that they are complete."""
        path = f"{self.root}/staged"
        rows.repartition(self.bucket).write.mode("overwrite").parquet(path, compression="zstd")
        self.spark.range(0, 1, 1, 1).select(F.lit(of).alias("of")).write.mode("overwrite").parquet(f"{self.root}/staged_for")
        return self.spark.read.schema(rows.schema).parquet(path)

    def _staged(self, of: str) -> DataFrame | None:
        """What is staged for this batch, if it is complete."""
        mark = self._read("staged_for")
        return self._read("staged") if mark is not None and mark.first()[0] == of else None

    def _replace(self, staged: DataFrame, mode: str) -> None:
        """Replace the buckets that the staged rows are in ('dynamic'), or the whole table ('static').

        Staged files hold whole buckets, so the copy is neither shuffled nor sorted."""
        writer = staged.write.mode("overwrite").option("partitionOverwriteMode", mode).option("compression", "zstd")
        with open_writers(self.spark):
            writer.partitionBy(self.bucket).parquet(f"{self.root}/rows")

    def upsert(self, df: DataFrame, source: str, batch: int) -> None:
        """Bring a batch into the buckets it has keys in; rows with a later ingest stay.

        Source and number stand for one content. A batch that failed while its buckets were being
        replaced is finished from its staged rows, and one that is repeated changes nothing.
        A batch that brings a new column rewrites all buckets, so that all files have it.
        """
        of = f"{source}-{batch}"
        staged = self._staged(of)
        if staged is None:
            rows, current = self._placed(df), self._rows()
            if current is not None:
                if set(df.columns) <= set(current.columns):
                    current = current.where(F.col(self.bucket).isin(*self._numbers(rows)))
                rows = current.unionByName(rows, allowMissingColumns=True)
            staged = self._stage(keep_latest(rows, self.keys, self.order(rows)), of)
        self._replace(staged, "dynamic")

    def rebuild(self, df: DataFrame, check: Callable[[DataFrame], None] | None = None) -> DataFrame | None:
        """Replace the whole table by ``df``, one row per key."""
        return self.publish(keep_latest(df, self.keys, self.order(df)), check)

    def publish(self, rows: DataFrame, check: Callable[[DataFrame], None] | None = None) -> DataFrame | None:
        """Replace the whole table by rows that have one row per key.

        ``check`` sees the new rows before any folder is replaced and may raise. Folders change at
        the end of the write; only a table some of whose buckets become empty is cleared first.
        """
        staged = self._stage(self._placed(rows), "rebuild")
        if check is not None:
            check(staged.drop(self.bucket))
        current = self._rows()
        gone = current is not None and set(self._numbers(current)) - set(self._numbers(staged))
        self._replace(staged, "static" if gone else "dynamic")
        return self.read()


def merge_into(df: DataFrame, table: str, keys: Sequence[str], order: Callable[[DataFrame], Sequence[Column]] = latest_order) -> None:
    """Upsert into a catalog table whose format supports MERGE, newest ingest wins."""
    latest = keep_latest(df, list(keys), order(df)).alias("new")
    same = F.lit(True)
    for key in keys:
        same = same & F.col(f"new.{key}").eqNullSafe(F.col(f"{table}.{key}"))
    newer = F.col("new.ingested_at") >= F.col(f"{table}.ingested_at")
    latest.mergeInto(table, same).whenMatched(newer).updateAll().whenNotMatched().insertAll().merge()
