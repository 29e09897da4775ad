"""Gold over one test data folder, derived lazily and only as far as a query needs."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orebed.plans import gold
from orebed.sources import tables


class Lake:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def raw(self, name: str) -> DataFrame:
        return tables.table(self.spark, self.sf_dir, name)

    def view(self, name: str) -> DataFrame:
        return tables.view(self.spark, self.sf_dir, name)

    def staged(self, entity: str) -> DataFrame:
        return tables.staged(self.spark, self.sf_dir, entity)

    def enriched(self, columns: Iterable[str] | None = None) -> DataFrame:
        return gold.orders_enriched(
            self.staged("order"),
            self.staged("customer"),
            self.staged("payment"),
            self.staged("review"),
            columns,
        )

    def fct_orders(self, *columns: str) -> DataFrame:
        return self.enriched(columns or None)

    def dim_customers(self) -> DataFrame:
        needed = ["order_id", "customer_unique_id", "total_payment_value"]
        needed += ["avg_review_score", "total_reviews"]
        return gold.dim_customers(self.staged("customer"), self.enriched(needed))

    def customer_places(self) -> DataFrame:
        """Current state of every person, without the lifetime metrics."""
        order = [F.col("customer_id").desc()]
        return gold.keep_latest(self.staged("customer"), ["customer_unique_id"], order).select(
            "customer_unique_id", "customer_city", "customer_state"
        )

    def dim_products(self) -> DataFrame:
        return gold.dim_products(self.staged("product"))

    def dim_sellers(self) -> DataFrame:
        return gold.dim_sellers(self.staged("seller"))

    def fct_order_items(self) -> DataFrame:
        return gold.fct_order_items(self.staged("order_item"))


def comparable(df: DataFrame) -> DataFrame:
    """Result columns in types every client reads alike.

    Decimals end as text with nine places, integers as BIGINT, dates and timestamps as ISO
    text in UTC.
    """
    columns = []
    for field in df.schema.fields:
        c, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, T.DecimalType):
            # By way of another scale: a sketch returns decimals with fewer places than their type.
            c = c.cast("decimal(38,10)").cast("decimal(38,9)").cast("string")
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(kind, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("bigint")
        columns.append(c.alias(field.name))
    return df.select(*columns)
