"""CSV files with a header: every value is text, rows keep file and row identity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orebed.catalog import ENTITIES
from orebed.functions import strip
from orebed.sources.records import split_records

FILE, BLOCK, ROW_ID, ERROR, RAW = "_file", "_block", "_row_id", "_error", "_raw"
BOOKKEEPING = (FILE, BLOCK, ROW_ID, ERROR, RAW)
_END = "\x01end\x01"


def read_csv(
    spark: SparkSession, path: str, encoding: str = "UTF-8", multiline: bool = True
) -> DataFrame:
    """Scan one CSV file, or a folder of part files, named ``*.csv``.

    Values are stripped and empty values stay empty text. A row with too few
    values has NULLs at its end; a row with too many is marked in ``_error`` and
    kept as text in ``_raw``. Files with quoted line breaks are split too, by
    ``split_records``, which reads them three times and shuffles their longer records; files
    known to have none are split more cheaply with ``multiline=False``. With quoted line
    breaks, an encoding other than UTF-8 is one task per file: land the result once and go on from there.
    """
    if not path.lower().rstrip("/").endswith(".csv"):
        raise ValueError(f"expected a .csv file, got {path}")
    options = {"header": True, "multiLine": multiline, "escape": '"', "encoding": encoding}
    names = spark.read.options(**options).csv(path).columns
    schema = T.StructType([T.StructField(n, T.StringType()) for n in (*names, RAW)])
    parsing = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": RAW}
    file, block = F.col("_metadata.file_path"), F.col("_metadata.file_block_start")
    row_id = F.monotonically_increasing_id()
    if multiline and encoding.upper() in ("UTF-8", "UTF8"):
        records = split_records(spark, path).where("nth > 1")
        record = F.from_csv("record", _ddl(schema), {"escape": '"', **parsing})
        rows = records.select(FILE, "nth", record.alias("_record")).select(FILE, "nth", "_record.*")
        # Numbers run through the whole file, which counts as one block.
        file, block, row_id = F.col(FILE), F.lit(0).cast("long"), F.col("nth")
    else:
        rows = spark.read.schema(schema).options(**options, **parsing).csv(path)
    malformed = F.col(RAW).isNotNull()
    too_long = malformed & ~_ends_within(F.col(RAW), len(names))
    values = [
        # Unquoted empty values arrive as NULL; only short rows really lack values.
        strip(F.when(malformed, F.col(f"`{n}`")).otherwise(F.coalesce(f"`{n}`", F.lit("")))).alias(n)
        for n in names
    ]
    return rows.select(
        *values,
        file.alias(FILE),
        block.alias(BLOCK),
        row_id.alias(ROW_ID),
        F.when(too_long, F.lit(f"row has more than {len(names)} values")).alias(ERROR),
        F.when(too_long, F.col(RAW)).alias(RAW),
    )


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` string" for f in schema)


def _ends_within(text: Column, width: int) -> Column:
    """Whether a CSV record has at most ``width`` values: append an end mark, find its column."""
    wide = ", ".join(f"c{i} string" for i in range(width + 1))
    marked = F.concat(F.regexp_replace(text, r"[\r\n]+$", ""), F.lit("," + _END))
    record = F.from_csv(marked, wide, {"escape": '"', "mode": "PERMISSIVE"})
    return F.array_contains(
        F.array(*[F.coalesce(record.getField(f"c{i}"), F.lit("")) for i in range(width + 1)]), _END
    )


def row_count(spark: SparkSession, path: str, multiline: bool = True) -> int:
    """Number of records, without the header; nothing is parsed into values."""
    if multiline:
        return split_records(spark, path).where("nth > 1").count()
    return read_csv(spark, path, multiline=False).count()


def row_numbers(landed: DataFrame, rows: DataFrame) -> DataFrame:
    """Add ``row_num``, 1-based within its file, to some or all of the landed rows.

    The number does not depend on how the file was split. Row ids grow along a block of a file without gaps, so the number is the rows of
    the blocks before plus the distance to the block's first id. Only one small row
    per block is numbered, not the rows themselves.
    """
    before = Window.partitionBy(FILE).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    blocks = (
        landed.groupBy(FILE, BLOCK)
        .agg(F.min(ROW_ID).alias("_first"), F.count("*").alias("_rows"))
        .withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
        .drop("_rows")
    )
    number = F.col("_before") + F.col(ROW_ID) - F.col("_first") + 1
    return rows.join(blocks, [FILE, BLOCK], "left").withColumn("row_num", number)


def routes(spark: SparkSession) -> DataFrame:
    """File name, topic and entity of the nine registered files."""
    return spark.createDataFrame(
        [(e.csv_file, e.topic, e.name) for e in ENTITIES.values()],
        "file_name string, topic string, entity_type string",
    )


def route_files(spark: SparkSession, data_dir: str) -> DataFrame:
    """All ``*.csv`` of a folder, with topic and entity or NULLs for unknown names.

    A name stands for a file, or for a folder of part files. Only the listing is read: the
    content column is pruned.
    """
    parts = F.regexp_extract("path", r"^(.*/([^/]+\.csv))(/[^/]+)?$", 1)
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.csv")
        .option("recursiveFileLookup", True)
        .load(data_dir)
        .select(F.regexp_replace(parts, r"(\.csv)/[^/]+\.csv$", "$1").alias("path"), "length")
        .groupBy("path")
        .agg(F.sum("length").alias("length"))
        .withColumn("file_name", F.element_at(F.split("path", "/"), -1))
    )
    return files.join(F.broadcast(routes(spark)), "file_name", "left")


def route_file(file_name: str) -> tuple[str, str]:
    """Topic and entity of one file; unknown names are an error."""
    for e in ENTITIES.values():
        if e.csv_file == file_name:
            return e.topic, e.name
    known = [e.csv_file for e in ENTITIES.values()]
    raise ValueError(f"no topic for file {file_name!r}; registered files: {known}")
