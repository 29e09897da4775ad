"""Silver-shaped text rows over the test tables: every business value is text, as it
arrives from Bronze, and some values do not parse."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orebed.catalog import ENTITIES
from orebed.sources.tables import staged

_LOADED = "2024-02-01 00:00:00"
_INGESTED = "2024-01-31 12:30:00"


def _as_text(df: DataFrame, field) -> Column:
    c = F.col(field.name)
    if field.type == "timestamp":
        return F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    if field.type == "numeric":
        # Two fraction digits and no exponent in any engine.
        return c.cast("decimal(28,4)").cast("string")
    return c.cast("string")


# Where a column's text does not parse: (entity, column) -> (condition, text).
BROKEN = {
    ("order", "order_approved_at"): ("order_status = 'shipped'", "not yet"),
    ("order_item", "price"): ("seller_id LIKE '%7'", "n/a"),
    ("payment", "payment_installments"): ("payment_type = 'voucher'", "one"),
    ("review", "review_score"): ("review_comment_title = 'error'", "five"),
    ("product", "product_weight_g"): ("product_category_name = 'promo'", "1,5 kg"),
}


def silver_text(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    spec = ENTITIES[entity]
    df = staged(spark, sf_dir, entity)
    columns = []
    for field in spec.fields:
        text = _as_text(df, field)
        if (entity, field.source) in BROKEN:
            condition, broken = BROKEN[entity, field.source]
            text = F.when(F.expr(condition), F.lit(broken)).otherwise(text)
        columns.append(text.alias(field.source))
    key = F.concat_ws("|", *[F.col(ENTITY_KEYS.get(k, k)).cast("string") for k in spec.key])
    return df.select(
        *columns,
        F.sha2(F.concat(F.lit(entity + "|"), key), 256).alias("event_id"),
        F.lit(_INGESTED).alias("ingested_at"),
        F.lit("1.0.0").alias("schema_version"),
        F.lit(_LOADED).alias("_silver_loaded_at"),
    )


ENTITY_KEYS = {"order_item_id": "order_item_sequence"}
