"""Declarative data tests. Every test is an aggregate that returns what failed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orebed.catalog import ORDER_STATUSES, PAYMENT_TYPES


def unique(df: DataFrame, *columns: str) -> DataFrame:
    """Keys that occur more than once; keys with a NULL are left to ``not_null``."""
    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    return (
        df.where(known).groupBy(*columns).agg(F.count("*").alias("n")).where(F.col("n") > 1)
    )


def not_null(df: DataFrame, *columns: str) -> DataFrame:
    """NULLs per column, all columns in one pass."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counted.unpivot([], list(columns), "column", "failures")


def accepted_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Values outside the list, with their counts."""
    return (
        df.where(~F.col(column).isin(*values))
        .groupBy(F.col(column).alias("value"))
        .agg(F.count("*").alias("n"))
    )


def relationships(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child keys without a parent. Both sides are one row per key before the anti join."""
    keys = (
        child.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count("*").alias("n"))
    )
    known = parent.select(F.col(parent_column).alias("value")).distinct()
    return keys.join(known, "value", "left_anti")


def has_rows(df: DataFrame) -> bool:
    return not df.isEmpty()


def table_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows whose number of copies differs, with the surplus on the left (negative: right).

    Both tables are counted in one aggregation, so equal copies meet map-side.
    """
    columns = left.columns
    both = left.select(*columns, F.lit(1).alias("_side")).unionByName(
        right.select(*columns, F.lit(-1).alias("_side"))
    )
    return (
        both.groupBy(*columns)
        .agg(F.sum("_side").alias("surplus"))
        .where(F.col("surplus") != 0)
    )


def reconcile(raw: DataFrame, kept: DataFrame, *groups: str) -> DataFrame:
    """Row counts before and after deduplication, and the difference."""

    def counted(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(*groups).agg(F.count("*").alias(name))

    joined = counted(raw, "raw_count").join(counted(kept, "silver_count"), list(groups), "left")
    silver = F.coalesce("silver_count", F.lit(0).cast("bigint"))
    return joined.select(
        *groups,
        "raw_count",
        silver.alias("silver_count"),
        (F.col("raw_count") - silver).alias("duplicates_dropped"),
    )


@dataclass(frozen=True)
class DataTest:
    """One declared test of a table's column."""

    table: str
    column: str
    kind: str
    values: tuple[str, ...] = ()
    parent: str | None = None
    parent_column: str | None = None


def _tests(table: str, kind: str, *columns: str) -> list[DataTest]:
    return [DataTest(table, c, kind) for c in columns]


# The declared tests of the staging and Gold tables.
STAGING_TESTS: tuple[DataTest, ...] = (
    *_tests("stg_orders", "unique", "order_id"),
    *_tests("stg_orders", "not_null", "order_id", "customer_id"),
    DataTest("stg_orders", "order_status", "accepted_values", ORDER_STATUSES),
    *_tests("stg_customers", "unique", "customer_id"),
    *_tests("stg_customers", "not_null", "customer_id", "customer_unique_id"),
    *_tests("stg_order_items", "not_null", "order_id", "order_item_sequence"),
    DataTest("stg_order_items", "order_id", "relationships", (), "stg_orders", "order_id"),
    *_tests("stg_payments", "not_null", "order_id"),
    DataTest("stg_payments", "order_id", "relationships", (), "stg_orders", "order_id"),
    DataTest("stg_payments", "payment_type", "accepted_values", PAYMENT_TYPES),
    *_tests("stg_products", "unique", "product_id"),
    *_tests("stg_products", "not_null", "product_id"),
    *_tests("stg_sellers", "unique", "seller_id"),
    *_tests("stg_sellers", "not_null", "seller_id"),
    *_tests("stg_reviews", "not_null", "review_id", "order_id"),
    DataTest("stg_reviews", "order_id", "relationships", (), "stg_orders", "order_id"),
    *_tests("stg_product_categories", "unique", "product_category_name"),
    *_tests("stg_product_categories", "unique", "product_category_name_english"),
    *_tests("stg_product_categories", "not_null", "product_category_name"),
    *_tests("stg_product_categories", "not_null", "product_category_name_english"),
    *_tests("stg_geolocation", "not_null", "geolocation_zip_code_prefix"),
)
GOLD_TESTS: tuple[DataTest, ...] = (
    *_tests("fct_orders", "unique", "order_id"),
    *_tests("fct_orders", "not_null", "order_id", "customer_id"),
    *_tests("dim_customers", "unique", "customer_unique_id"),
    *_tests("dim_customers", "not_null", "customer_unique_id"),
    *_tests("dim_products", "unique", "product_id"),
    *_tests("dim_products", "not_null", "product_id"),
    *_tests("dim_sellers", "unique", "seller_id"),
    *_tests("dim_sellers", "not_null", "seller_id"),
    *_tests("fct_order_items", "not_null", "order_id", "order_item_id", "product_id", "seller_id"),
    *_tests("mart_category_performance", "unique", "product_category_name"),
    *_tests("mart_category_performance", "not_null", "product_category_name"),
    *_tests("mart_seller_performance", "unique", "seller_id"),
    *_tests("mart_seller_performance", "not_null", "seller_id"),
)


def run_tests(tables: Mapping[str, DataFrame], tests: Sequence[DataTest]) -> DataFrame:
    """``(table, test, column, failures)`` for every test whose table is given.

    Each table is read once, grouped on the column of its ``unique`` or ``relationships``
    tests, and all its row-level tests are counted on the way; only tests on a further key
    read it again. ``unique`` counts surplus keys and ``relationships`` orphan rows.
    """
    results: list[DataFrame] = []
    by_table: dict[str, list[DataTest]] = {}
    for test in tests:
        if test.table in tables:
            by_table.setdefault(test.table, []).append(test)
    for table, own in by_table.items():
        rows = [t for t in own if t.kind in ("not_null", "accepted_values")]
        keys = list(dict.fromkeys(t.column for t in own if t not in rows))
        for i, key in enumerate(keys or [None]):
            keyed = [t for t in own if t not in rows and t.column == key]
            results.append(_counted(tables, table, key, keyed, rows if i == 0 else []))
    return reduce(DataFrame.unionByName, results).withColumn(
        "status", F.when(F.col("failures") == 0, "pass").otherwise("fail")
    )


def _failing(t: DataTest) -> Column:
    c = F.col(t.column)
    return c.isNull() if t.kind == "not_null" else ~c.isin(*t.values)


def _counted(
    tables: Mapping[str, DataFrame],
    table: str,
    key: str | None,
    keyed: Sequence[DataTest],
    rows: Sequence[DataTest],
) -> DataFrame:
    """All given tests of one table from one pass over it, one line each."""
    counts = [F.count_if(_failing(t)).alias(f"r{i}") for i, t in enumerate(rows)]
    totals = [F.sum(f"r{i}").alias(f"r{i}") for i in range(len(rows))]
    if key is None:
        counted = tables[table].agg(*counts)
    else:
        groups = tables[table].groupBy(F.col(key).alias("_key")).agg(F.count("*").alias("_n"), *counts)
        known = F.col("_key").isNotNull()
        for i, t in enumerate(keyed):
            if t.kind == "unique":
                totals.append(F.count_if(known & (F.col("_n") > 1)).alias(f"k{i}"))
                continue
            parents = tables[t.parent].select(F.col(t.parent_column).alias("_key")).distinct()
            groups = groups.join(parents.withColumn(f"_p{i}", F.lit(True)), "_key", "left")
            orphans = F.sum(F.when(known & F.col(f"_p{i}").isNull(), F.col("_n")).otherwise(0))
            totals.append(orphans.alias(f"k{i}"))
        counted = groups.agg(*totals)
    named = [(f"r{i}", t) for i, t in enumerate(rows)] + [(f"k{i}", t) for i, t in enumerate(keyed)]
    lines = F.array(
        *[
            F.struct(
                F.lit(table).alias("table"),
                F.lit(t.kind).alias("test"),
                F.lit(t.column).alias("column"),
                F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias("failures"),
            )
            for c, t in named
        ]
    )
    return counted.select(F.inline(lines))
