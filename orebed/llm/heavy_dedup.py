"""Exact deduplication with frequent digests split off.

Misra-Gries summaries find the few digests that many rows share. Their exact winners and
sizes are aggregated (one row per task and digest is shuffled) and broadcast, so the rows of
hot groups never move. All other digests go through an ordinary shuffle, in which no group
can hold more than 2 / (COUNTERS + 1) of the rows.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orebed.llm.common import columns_of, frequent
from orebed.session import durable

#: The white space that counts as one space.
SPACE = r"[\x20\x09-\x0D]+"


def text_digest(text: str = "text") -> Column:
    """SHA-256 (lowercase hex) of a text with white space runs as one space; null as empty."""
    return F.sha2(F.regexp_replace(F.coalesce(F.col(text), F.lit("")), SPACE, " ").cast("binary"), 256)


def winners(keys: DataFrame) -> DataFrame:
    """Rows (digest, doc_id, row) plus keep_id, group_size and kept."""
    spark = keys.sparkSession
    first = F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "row")
    # From Arrow, which the JVM reads itself; rows of a list would start a second set of Python workers.
    hot = spark.createDataFrame(pa.table({"digest": pa.array(frequent(keys, "digest"), pa.string())}))
    # Verified: exact counts and winners of the candidates, at most COUNTERS + 1 rows.
    best = keys.join(F.broadcast(hot), "digest").groupBy("digest").agg(F.min(first).alias("best"), F.count("*").alias("group_size"))
    best = durable(best)
    here = keys.join(F.broadcast(best), "digest")
    group = Window.partitionBy("digest")
    rest = keys.join(F.broadcast(best.select("digest")), "digest", "left_anti")
    rest = rest.withColumn("best", F.min(first).over(group)).withColumn("group_size", F.count("*").over(group))
    both = here.unionByName(rest)
    return both.select(
        "doc_id", "digest", "row", F.col("best.doc_id").alias("keep_id"), "group_size", (F.col("best.row") == F.col("row")).alias("kept")
    )


def find_copies(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts (white space runs count as one space, null as empty) the row with the
    smallest doc_id is kept; null doc_ids come last. Of rows that repeat doc_id and text, one
    is kept. Other columns are left out; an empty table gives an empty table.
    """
    narrow = columns_of(docs, doc_id="long", text="string")
    keys = durable(narrow.select("doc_id", text_digest().alias("digest"), F.monotonically_increasing_id().alias("row")))
    return winners(keys).select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


def drop_copies(docs: DataFrame) -> DataFrame:
    """The documents that find_copies keeps, with all their columns."""
    # The id as text, empty for null: join and window then share one shuffle of the documents.
    named = F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit("")).alias("__id")
    stays = find_copies(docs).where("kept").select(F.col("text_sha256").alias("__digest"), named)
    marked = docs.withColumn("__digest", text_digest()).withColumn("__id", named)
    once = Window.partitionBy("__digest", "__id").orderBy("__digest")
    out = marked.join(stays, ["__digest", "__id"], "left_semi").withColumn("__nth", F.row_number().over(once))
    return out.where("__nth = 1").select(*[F.col(f"`{c}`") for c in docs.columns])
