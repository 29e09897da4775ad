"""Two versions of a table, or two targets, compared by checksums of key buckets.

A version is saved in folders by a hash of its keys, with one row of checksums per folder: its
rows, and sums of two hashes of each row. Sums do not depend on the order of rows, and a row
that comes twice counts twice. To compare versions, their checksums are joined first; only
folders that differ are read again, through dynamic partition pruning.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orebed.operators.quality import table_diff
from orebed.session import open_writers

BUCKET = "_bucket"
#: Checksums of at most so many buckets are broadcast.
MOST_BUCKETS = 1 << 16
#: So many buckets at most are written side by side by a task.
OPEN_BUCKETS = 64
_NESTED = (T.ArrayType, T.StructType, T.MapType, T.VariantType)


def _comparable(df: DataFrame) -> list[Column]:
    """Columns as values that can be hashed, grouped and ordered; nested ones as JSON."""
    whole = {"ignoreNullFields": "false"}
    return [
        (F.to_json(F.col(f"`{f.name}`"), whole) if isinstance(f.dataType, _NESTED) else F.col(f"`{f.name}`")).alias(f.name)
        for f in df.schema.fields
    ]


def _row_hash(columns: Sequence[str], seed: int) -> Column:
    # A null leaves a hash as it is, so its place is hashed too.
    named = [F.col(f"`{c}`") for c in columns]
    return F.xxhash64(F.lit(seed), *named, *[c.isNull() for c in named])


def save_version(df: DataFrame, keys: Sequence[str], path: str, buckets: int = 256) -> None:
    """Write ``df`` under ``path`` in ``buckets`` folders by its keys, with their checksums.

    Checksums are taken of the rows as written. Up to OPEN_BUCKETS buckets are written by every task
    where its rows lie, a file each, without a shuffle. More of them would leave too many files: their
    rows are range-partitioned by bucket and task of origin, so that a bucket which one hot key fills
    is still written by several tasks.
    """
    if not 0 < buckets <= MOST_BUCKETS:
        raise ValueError(f"1 to {MOST_BUCKETS} buckets, not {buckets}")
    spark = df.sparkSession
    plain = df.select(*_comparable(df))
    columns = plain.columns
    number = F.pmod(_row_hash(keys, 0), F.lit(buckets)).cast("int")
    placed = plain.withColumn(BUCKET, number)
    if buckets > OPEN_BUCKETS:
        placed = placed.withColumn("_task", F.spark_partition_id()).repartitionByRange(BUCKET, "_task").drop("_task")
    with open_writers(spark, OPEN_BUCKETS):
        placed.write.mode("overwrite").partitionBy(BUCKET).parquet(f"{path}/rows", compression="zstd")
    schema = T.StructType([*plain.schema.fields, T.StructField(BUCKET, T.IntegerType())])
    written = spark.read.schema(schema).parquet(f"{path}/rows")
    sums = [F.sum(_row_hash(columns, seed).cast("decimal(20,0)")).alias(f"sum_{seed}") for seed in (1, 2)]
    kept = written.groupBy(BUCKET).agg(F.count("*").alias("rows"), *sums)
    # What another version has to agree on, beside each bucket.
    about = [F.lit(json.dumps(list(keys))).alias("keys"), F.lit(buckets).alias("buckets"), F.lit(plain.schema.json()).alias("of")]
    head = spark.range(1).select(*about)
    head.write.mode("overwrite").parquet(f"{path}/about")
    kept.coalesce(1).write.mode("overwrite").parquet(f"{path}/sums")


def _about(spark: SparkSession, path: str) -> tuple:
    return tuple(spark.read.parquet(f"{path}/about").first())


def differing_buckets(spark: SparkSession, left: str, right: str) -> DataFrame:
    """Buckets whose checksums differ or that one version lacks: ``_bucket, left_rows, right_rows``."""
    a, b = (spark.read.parquet(f"{p}/sums") for p in (left, right))
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in ("rows", "sum_1", "sum_2")]
    zero = F.lit(0).cast("bigint")
    return (
        a.alias("a")
        .join(b.alias("b"), F.col(f"a.{BUCKET}") == F.col(f"b.{BUCKET}"), "full")
        .where(~reduce(Column.__and__, same))
        .select(
            F.coalesce(f"a.{BUCKET}", f"b.{BUCKET}").alias(BUCKET),
            F.coalesce("a.rows", zero).alias("left_rows"),
            F.coalesce("b.rows", zero).alias("right_rows"),
        )
    )


def drilldown(spark: SparkSession, left: str, right: str) -> DataFrame:
    """Keys whose rows differ: ``keys, change, left_rows, right_rows, columns``.

    ``change`` is added, removed or changed, seen from left to right; the counts are of rows that
    the other version has not, or not as often; ``columns`` names, in order of the alphabet, those
    of a changed key whose smallest or largest value differs. Only differing buckets are read.
    Versions must have the same columns, keys and number of buckets.
    """
    about = _about(spark, left)
    if about != _about(spark, right):
        raise ValueError("versions differ in columns, keys or number of buckets")
    keys, schema = json.loads(about[0]), T.StructType.fromJson(json.loads(about[2]))
    wanted = F.broadcast(differing_buckets(spark, left, right).select(BUCKET))
    full = T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType())])
    # Numbered, so that no name of the table meets one of the steps below.
    number = {c: f"c{i}" for i, c in enumerate(schema.names)}
    renamed = [F.col(f"`{c}`").alias(n) for c, n in number.items()]
    sides = [spark.read.schema(full).parquet(f"{p}/rows").join(wanted, BUCKET).select(*renamed) for p in (left, right)]
    surplus, rest = F.col("surplus"), {c: n for c, n in sorted(number.items()) if c not in keys}
    ends = (("a_low", F.min, surplus > 0), ("a_high", F.max, surplus > 0), ("b_low", F.min, surplus < 0), ("b_high", F.max, surplus < 0))
    # A struct is never null, so a null value is compared too.
    bounds = [f(F.when(side, F.struct(n))).alias(f"{label}_{n}") for n in rest.values() for label, f, side in ends]
    found = table_diff(*sides).groupBy(*[number[k] for k in keys]).agg(
        F.sum(F.greatest(surplus, F.lit(0))).alias("left_rows"), F.sum(F.greatest(-surplus, F.lit(0))).alias("right_rows"), *bounds
    )
    change = F.when(F.col("right_rows") == 0, "removed").when(F.col("left_rows") == 0, "added").otherwise("changed")
    equal = {c: F.col(f"a_low_{n}").eqNullSafe(F.col(f"b_low_{n}")) & F.col(f"a_high_{n}").eqNullSafe(F.col(f"b_high_{n}")) for c, n in rest.items()}
    named = F.concat_ws(",", *[F.when(~same, F.lit(c)) for c, same in equal.items()])
    return found.select(
        *[F.col(number[k]).alias(k) for k in keys],
        change.alias("change"),
        "left_rows",
        "right_rows",
        F.when(change == "changed", named).otherwise("").alias("columns"),
    )
