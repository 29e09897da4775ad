"""Data model: entities, envelope, contracts and the fixed values they rest on.

Everything here is metadata. The entity table drives CSV reading, enveloping,
Silver typing, staging projections, quality tests and PII masking, so that a
column is described once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Money, weights and coordinates. Nine fraction digits; the 28 digits of
# precision leave room for sums, which Spark widens to DECIMAL(38,9).
NUMERIC = "decimal(28,9)"

SQL_TYPES = {
    "string": "string",
    "integer": "int",
    "numeric": NUMERIC,
    "timestamp": "timestamp",
}


@dataclass(frozen=True)
class Field:
    """One column: its name in the source, its staged name and logical type."""

    source: str
    type: str = "string"
    staged: str | None = None
    pii: bool = False

    @property
    def name(self) -> str:
        return self.staged or self.source


@dataclass(frozen=True)
class Entity:
    name: str
    topic: str
    csv_file: str
    fields: tuple[Field, ...]
    key: tuple[str, ...]
    # Key used when results of the narrower, lossy deduplication are wanted.
    compat_key: tuple[str, ...]
    # Whether values of the CSV file hold line breaks, so that it cannot be split.
    multiline: bool = False

    @property
    def columns(self) -> list[str]:
        return [f.source for f in self.fields]

    @property
    def date_columns(self) -> list[str]:
        return [f.source for f in self.fields if f.type == "timestamp"]

    @property
    def text_schema(self) -> T.StructType:
        """Business columns as they travel in CSV, topics and Bronze: text."""
        return T.StructType([T.StructField(c, T.StringType()) for c in self.columns])


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "timestamp": T.TimestampType(),
    "money": T.DecimalType(38, 9),
}


def _struct(ddl: str) -> T.StructType:
    pairs = (part.split() for part in ddl.split(","))
    return T.StructType([T.StructField(name, _TYPES[type]) for name, type in pairs])


def _f(source, type="string", staged=None, pii=False):
    return Field(source, type, staged, pii)


# Topic names, file names, column names and keys of the nine entities.
_ENTITIES = [
    Entity(
        "order",
        "ecommerce.olist.orders.v1",
        "olist_orders_dataset.csv",
        (
            _f("order_id"),
            _f("customer_id", pii=True),
            _f("order_status"),
            _f("order_purchase_timestamp", "timestamp"),
            _f("order_approved_at", "timestamp"),
            _f("order_delivered_carrier_date", "timestamp"),
            _f("order_delivered_customer_date", "timestamp"),
            _f("order_estimated_delivery_date", "timestamp"),
        ),
        key=("order_id",),
        compat_key=("order_id",),
    ),
    Entity(
        "order_item",
        "ecommerce.olist.order-items.v1",
        "olist_order_items_dataset.csv",
        (
            _f("order_id"),
            _f("order_item_id", "integer", "order_item_sequence"),
            _f("product_id"),
            _f("seller_id"),
            _f("shipping_limit_date"),
            _f("price", "numeric"),
            _f("freight_value", "numeric"),
        ),
        key=("order_id", "order_item_id"),
        compat_key=("order_item_id",),
    ),
    Entity(
        "payment",
        "ecommerce.olist.payments.v1",
        "olist_order_payments_dataset.csv",
        (
            _f("order_id"),
            _f("payment_sequential", "integer"),
            _f("payment_type"),
            _f("payment_installments", "integer"),
            _f("payment_value", "numeric"),
        ),
        key=("order_id", "payment_sequential"),
        compat_key=("order_id",),
    ),
    Entity(
        "review",
        "ecommerce.olist.reviews.v1",
        "olist_order_reviews_dataset.csv",
        (
            _f("review_id"),
            _f("order_id"),
            _f("review_score", "integer"),
            _f("review_comment_title"),
            _f("review_comment_message"),
            _f("review_creation_date", "timestamp"),
            _f("review_answer_timestamp", "timestamp"),
        ),
        key=("review_id", "order_id"),
        compat_key=("review_id",),
        multiline=True,
    ),
    Entity(
        "customer",
        "ecommerce.olist.customers.v1",
        "olist_customers_dataset.csv",
        (
            _f("customer_id", pii=True),
            _f("customer_unique_id", pii=True),
            _f("customer_zip_code_prefix"),
            _f("customer_city"),
            _f("customer_state"),
        ),
        key=("customer_id",),
        compat_key=("customer_id",),
    ),
    Entity(
        "product",
        "ecommerce.olist.products.v1",
        "olist_products_dataset.csv",
        (
            _f("product_id"),
            _f("product_category_name"),
            _f("product_name_lenght", "integer", "product_name_length"),
            _f("product_description_lenght", "integer", "product_description_length"),
            _f("product_photos_qty", "integer"),
            _f("product_weight_g", "numeric"),
            _f("product_length_cm", "numeric"),
            _f("product_height_cm", "numeric"),
            _f("product_width_cm", "numeric"),
        ),
        key=("product_id",),
        compat_key=("product_id",),
    ),
    Entity(
        "product_category",
        "ecommerce.olist.product-categories.v1",
        "product_category_name_translation.csv",
        (
            _f("product_category_name"),
            _f("product_category_name_english"),
        ),
        key=("product_category_name",),
        compat_key=("product_category_name",),
    ),
    Entity(
        "seller",
        "ecommerce.olist.sellers.v1",
        "olist_sellers_dataset.csv",
        (
            _f("seller_id"),
            _f("seller_zip_code_prefix"),
            _f("seller_city"),
            _f("seller_state"),
        ),
        key=("seller_id",),
        compat_key=("seller_id",),
    ),
    Entity(
        "geolocation",
        "ecommerce.olist.geolocation.v1",
        "olist_geolocation_dataset.csv",
        (
            _f("geolocation_zip_code_prefix"),
            _f("geolocation_lat", "numeric"),
            _f("geolocation_lng", "numeric"),
            _f("geolocation_city"),
            _f("geolocation_state"),
        ),
        key=(
            "geolocation_zip_code_prefix",
            "geolocation_lat",
            "geolocation_lng",
            "geolocation_city",
            "geolocation_state",
        ),
        compat_key=("geolocation_zip_code_prefix",),
    ),
]
ENTITIES: dict[str, Entity] = {e.name: e for e in _ENTITIES}

# Dead-letter topic, envelope defaults, legacy field names.
DEAD_LETTER_TOPIC = "ecommerce.dlq.v1"
EVENT_TYPE = "olist.{entity}.created"
SOURCE_SYSTEM = "olist-csv-producer"
SCHEMA_VERSION = "1.0.0"
LEGACY_FIELD_MAP = {
    "user_id": "id",
    "item_id": "product_id",
    "price": "amount",
    "timestamp": "created_at",
}

METADATA_FIELDS = (
    "event_id",
    "event_type",
    "entity_type",
    "source_system",
    "source_topic",
    "schema_version",
    "ingested_at",
    "ingestion_env",
    "pipeline_run_id",
    "data_layer",
    "checksum",
)
METADATA_SCHEMA = T.StructType([T.StructField(n, T.StringType()) for n in METADATA_FIELDS])

# Columns every staged entity carries next to its business columns.
STAGED_METADATA = (
    Field("event_id"),
    Field("ingested_at", "timestamp"),
    Field("schema_version"),
    Field("_silver_loaded_at", "timestamp", "silver_loaded_at"),
)


def envelope_schema(entity: str | None = None) -> T.StructType:
    """Envelope of one entity, or of any entity with the payload as a map."""
    payload = (
        ENTITIES[entity].text_schema
        if entity
        else T.MapType(T.StringType(), T.StringType())
    )
    return T.StructType(
        [T.StructField("metadata", METADATA_SCHEMA), T.StructField("payload", payload)]
    )


AUDIT_SCHEMA = _struct(
    "run_id string, pipeline_stage string, entity_type string, source_topic string, "
    "rows_processed bigint, rows_failed bigint, started_at timestamp, finished_at timestamp, "
    "status string, error_message string"
)
LAG_SCHEMA = _struct(
    "ts timestamp, consumergroup string, topic string, partition int, lag bigint"
)

# Accepted values of the staging tests.
ORDER_STATUSES = (
    "delivered",
    "shipped",
    "canceled",
    "invoiced",
    "processing",
    "approved",
    "unavailable",
    "created",
)
PAYMENT_TYPES = ("credit_card", "boleto", "voucher", "debit_card", "not_defined")


@dataclass(frozen=True)
class ContractField:
    name: str
    type: str = "string"
    nullable: bool = True
    pii: bool = False
    classification: str | None = None
    accepted_values: tuple[str, ...] = ()


@dataclass(frozen=True)
class Contract:
    entity: str
    version: str
    owner: str
    topic: str
    fields: tuple[ContractField, ...]


# The row contract for orders.
ORDER_CONTRACT = Contract(
    "order",
    "1.0.0",
    "data-engineering-team",
    "ecommerce.olist.orders.v1",
    (
        ContractField("order_id", nullable=False),
        ContractField("customer_id", nullable=False, pii=True, classification="confidential"),
        ContractField(
            "order_status",
            nullable=False,
            accepted_values=("delivered", "shipped", "canceled", "invoiced", "processing"),
        ),
        ContractField("order_purchase_timestamp", "timestamp", nullable=False),
        ContractField("order_approved_at", "timestamp"),
        ContractField("order_delivered_carrier_date", "timestamp"),
        ContractField("order_delivered_customer_date", "timestamp"),
        ContractField("order_estimated_delivery_date", "timestamp", nullable=False),
    ),
)

# Column types the two enforced Gold tables must have.
FCT_ORDERS_CONTRACT = _struct(
    "order_id string, customer_id string, customer_unique_id string, customer_city string, "
    "customer_state string, order_status string, order_purchase_timestamp timestamp, "
    "order_approved_at timestamp, order_delivered_carrier_date timestamp, "
    "order_delivered_customer_date timestamp, order_estimated_delivery_date timestamp, "
    "total_payment_sequences bigint, total_payment_value money, "
    "max_payment_installments int, avg_review_score double, total_reviews bigint, "
    "delivery_time_days int, delta_delivery_vs_estimated_days int"
)
DIM_CUSTOMERS_CONTRACT = _struct(
    "customer_unique_id string, customer_city string, customer_state string, "
    "total_orders bigint, total_lifetime_value money, avg_lifetime_review_score double"
)

# Columns published under a mask, per Gold table.
PII_COLUMNS = {
    "fct_orders": {"customer_id": "confidential", "customer_unique_id": "confidential"},
    "dim_customers": {"customer_unique_id": "confidential"},
}
