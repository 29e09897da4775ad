"""Tables laid out along a Z-order curve of several columns, so that scans skip folders.

Every column is cut into 2 ** bits bins: columns that are asked for by range at quantiles of
their values, columns that are looked up by a hash. The bits of a row's bins, interleaved, are its
zone, and a zone is a partition folder. A second, small table holds each zone's bins and the
ranges of its values. A query filters that table and joins it on the zone; Spark's dynamic
partition pruning then lists the folders of the zones that are left, and reads no others.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orebed.session import durable, open_writers

#: A zone table has at most 2 ** this many rows, and is broadcast.
MOST_BITS = 12
#: So many zones at most are written side by side by a task.
OPEN_ZONES = 64
ZONE = "_zone"


@dataclass(frozen=True)
class Layout:
    """``ranges`` are columns with an order, ``lookups`` columns that are compared with single values."""

    ranges: Sequence[str] = ()
    lookups: Sequence[str] = ()
    bits: int = 2

    def __post_init__(self) -> None:
        if not 0 < self.bits * len(self.columns) <= MOST_BITS:
            raise ValueError(f"1 to {MOST_BITS} bits in all, not {self.bits} for each of {self.columns}")

    @property
    def columns(self) -> tuple[str, ...]:
        return (*self.ranges, *self.lookups)

    @property
    def bins(self) -> int:
        return 1 << self.bits


def _hash_bin(value: Column, bins: int) -> Column:
    return F.pmod(F.xxhash64(value), F.lit(bins)).cast("int")


def _bins(df: DataFrame, layout: Layout) -> dict[str, Column]:
    """The bin of each column; quantiles come from one pass over all rows."""
    steps = [i / layout.bins for i in range(1, layout.bins)]
    cuts = df.agg(*[F.percentile_approx(c, steps).alias(c) for c in layout.ranges]).first() if layout.ranges else {}
    out = {}
    for c in layout.ranges:
        kind = df.schema[c].dataType
        above = [(F.col(c) > F.lit(cut).cast(kind)).cast("int") for cut in cuts[c] or ()]
        out[c] = F.coalesce(sum(above, F.lit(0)), F.lit(0))
    return out | {c: _hash_bin(F.col(c), layout.bins) for c in layout.lookups}


def zone_of(bins: Sequence[Column], bits: int) -> Column:
    """Interleaved bits of the bins, the highest bits first."""
    zone = F.lit(0)
    for bit in reversed(range(bits)):
        for b in bins:
            zone = zone * 2 + F.shiftright(b, bit).bitwiseAND(F.lit(1))
    return zone.cast("int")


def write_clustered(df: DataFrame, name: str, path: str, layout: Layout) -> None:
    """Write ``df`` as table ``name`` with its zones in ``{name}_zones``, under folders of ``path``.

    Up to OPEN_ZONES zones are written by every task where its rows lie, a file each, without a
    shuffle. More of them would leave too many files: their rows are range-partitioned by (zone,
    columns, hash of the row), so that every task writes few folders. Either way a zone which one hot
    value fills is written by several tasks. The input is written once before, because it is read
    for its quantiles, its ranges and its rows.
    """
    spark, rows = df.sparkSession, durable(df, "zstd")
    bins = _bins(rows, layout)
    numbered = rows.withColumn(ZONE, zone_of([bins[c] for c in layout.columns], layout.bits))
    placed = numbered
    if layout.bins ** len(layout.columns) > OPEN_ZONES:
        placed = numbered.repartitionByRange(ZONE, *layout.columns, F.xxhash64(*rows.columns))
    database = name.rpartition(".")[0] or "default"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    writer = placed.write.mode("overwrite").partitionBy(ZONE).option("compression", "zstd")
    with open_writers(spark, OPEN_ZONES):
        writer.option("path", f"{path}/rows").saveAsTable(name)
    bounds = [f(c).alias(f"{label}_{c}") for c in layout.ranges for f, label in ((F.min, "low"), (F.max, "high"))]
    hashes = [F.max(bins[c]).alias(f"bin_{c}") for c in layout.lookups]
    zones = numbered.groupBy(ZONE).agg(F.count("*").alias("rows"), *bounds, *hashes)
    zones.coalesce(1).write.mode("overwrite").option("path", f"{path}/zones").saveAsTable(f"{name}_zones")


def read_clustered(
    spark: SparkSession,
    name: str,
    layout: Layout,
    between: Mapping[str, tuple] | None = None,
    equal: Mapping[str, Sequence] | None = None,
) -> DataFrame:
    """Rows whose columns lie between two values (both included, None is open) and in lists of values.

    Any column may be asked for; those of the layout also choose the zones that are read.
    """
    zones, rows = spark.table(f"{name}_zones"), spark.table(name)
    for c, (low, high) in (between or {}).items():
        kind = rows.schema[c].dataType
        for value, bound, here in ((low, f"high_{c}", F.col(c).__ge__), (high, f"low_{c}", F.col(c).__le__)):
            if value is None:
                continue
            limit = F.lit(value).cast(kind)
            rows = rows.where(here(limit))
            if c in layout.ranges:
                zones = zones.where(F.col(bound) >= limit if bound.startswith("high") else F.col(bound) <= limit)
    for c, values in (equal or {}).items():
        kind = rows.schema[c].dataType
        wanted = [F.lit(v).cast(kind) for v in values]
        rows = rows.where(F.col(c).isin(*wanted))
        if c in layout.lookups:
            zones = zones.where(F.col(f"bin_{c}").isin(*[_hash_bin(v, layout.bins) for v in wanted]))
        elif c in layout.ranges:
            inside = [(F.col(f"low_{c}") <= v) & (v <= F.col(f"high_{c}")) for v in wanted]
            zones = zones.where(F.array_contains(F.array(*inside), True))
    return rows.join(F.broadcast(zones.select(ZONE)), ZONE).drop(ZONE)
