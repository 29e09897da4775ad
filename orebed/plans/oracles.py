"""The same questions in ANSI SQL, over the plain tables.

Common table expressions are written once and pulled in by name; a CTE that reads
another names it in its text.
"""

from __future__ import annotations

import re

from orebed.catalog import DIM_CUSTOMERS_CONTRACT, ENTITIES, FCT_ORDERS_CONTRACT
from orebed.operators.quality import GOLD_TESTS, STAGING_TESTS, DataTest
from orebed.sources.texts import BROKEN

_CTE: dict[str, str] = {}


def money(x: str) -> str:
    return f"CAST(CAST({x} AS DECIMAL(38,9)) AS VARCHAR)"


def ratio(x: str) -> str:
    """A decimal as a double, to divide it."""
    return f"CAST(CAST({x} AS DECIMAL(38,9)) AS DOUBLE)"


def stamp(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S.%f')"


def query(body: str) -> str:
    """Prefix the body with the CTEs it mentions, in definition order."""
    needed: set[str] = set()
    texts = [body]
    while texts:
        text = texts.pop()
        for name, definition in _CTE.items():
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                texts.append(definition)
    parts = [f"{name} AS ({sql})" for name, sql in _CTE.items() if name in needed]
    own = body.strip()
    if own.startswith("WITH RECURSIVE"):
        return ", ".join(["WITH RECURSIVE " + ", ".join(parts), own.removeprefix("WITH RECURSIVE")])
    return f"WITH {', '.join(parts)} {own}" if parts else own


_CTE["f_place"] = """
  SELECT n_nationkey, LPAD(CAST(n_nationkey AS VARCHAR), 5, '0') AS zip, n_name AS city, r_name AS state
  FROM nation JOIN region ON n_regionkey = r_regionkey"""
_CTE["f_shipped"] = """
  SELECT l_orderkey, MIN(l_shipdate) AS first_ship, MAX(l_shipdate) AS last_ship
  FROM lineitem GROUP BY l_orderkey"""
_CTE["f_order"] = """
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
    CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'processing' ELSE 'shipped' END AS order_status,
    CAST(o_orderdate AS TIMESTAMP) AS order_purchase_timestamp,
    CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(o_orderdate AS TIMESTAMP) END AS order_approved_at,
    CAST(first_ship AS TIMESTAMP) AS order_delivered_carrier_date,
    CASE WHEN o_orderstatus = 'F' THEN CAST(last_ship AS TIMESTAMP) END AS order_delivered_customer_date,
    CAST(o_orderdate AS TIMESTAMP) + INTERVAL '30' DAY AS order_estimated_delivery_date
  FROM orders LEFT JOIN f_shipped ON o_orderkey = l_orderkey"""
_CTE["f_order_item"] = """
  SELECT CAST(l_orderkey AS VARCHAR) AS order_id, l_linenumber AS order_item_id,
    CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_suppkey AS VARCHAR) AS seller_id,
    CAST(l_shipdate AS DATE) AS shipping_limit_date,
    CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS DECIMAL(28,9)) AS price,
    CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(28,9)) AS freight_value,
    l_quantity AS quantity
  FROM lineitem"""
_CTE["f_payment"] = """
  SELECT CAST(l_orderkey AS VARCHAR) AS order_id, l_linenumber AS payment_sequential,
    CASE l_returnflag WHEN 'A' THEN 'credit_card' WHEN 'N' THEN 'boleto' ELSE 'voucher' END AS payment_type,
    CAST(l_quantity AS INT) AS payment_installments,
    CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(28,9)) AS payment_value
  FROM lineitem"""
_CTE["f_review"] = """
  SELECT CAST(event_id AS VARCHAR) AS review_id,
    CAST(CAST(FLOOR(event_id / 2) AS BIGINT) AS VARCHAR) AS order_id,
    CAST(FLOOR(value / 100) + 1 AS INT) AS review_score, event_type AS review_comment_title,
    props AS review_comment_message, CAST(ts AS TIMESTAMP) AS review_creation_date,
    CAST(ts AS TIMESTAMP) AS review_answer_timestamp
  FROM events"""
_CTE["f_customer"] = """
  SELECT CAST(c_custkey AS VARCHAR) AS customer_id,
    MD5('u' || CAST(CAST(FLOOR(c_custkey / 2) AS BIGINT) AS VARCHAR)) AS customer_unique_id,
    zip AS customer_zip_code_prefix, city AS customer_city, state AS customer_state
  FROM customer JOIN f_place ON c_nationkey = n_nationkey"""
_CTE["f_product"] = """
  SELECT CAST(p_partkey AS VARCHAR) AS product_id,
    CASE WHEN p_brand <> 'Brand#25' THEN LOWER(p_type) END AS product_category_name,
    LENGTH(p_name) AS product_name_length, LENGTH(p_type) AS product_description_length,
    1 AS product_photos_qty, CAST(p_size AS DECIMAL(28,9)) AS product_weight_g,
    CAST(p_size AS DECIMAL(28,9)) AS product_length_cm, CAST(p_size AS DECIMAL(28,9)) AS product_height_cm,
    CAST(p_size AS DECIMAL(28,9)) AS product_width_cm
  FROM part"""
_CTE["f_seller"] = """
  SELECT CAST(s_suppkey AS VARCHAR) AS seller_id, zip AS seller_zip_code_prefix,
    city AS seller_city, state AS seller_state
  FROM supplier JOIN f_place ON s_nationkey = n_nationkey"""
_CTE["f_product_category"] = """
  SELECT DISTINCT LOWER(p_type) AS product_category_name,
    'en_' || LOWER(p_type) AS product_category_name_english FROM part"""
_CTE["f_geolocation"] = """
  SELECT zip AS geolocation_zip_code_prefix, CAST(n_nationkey * 3 - 30 AS DECIMAL(28,9)) AS geolocation_lat,
    CAST(n_nationkey * 5 - 60 AS DECIMAL(28,9)) AS geolocation_lng, city AS geolocation_city,
    state AS geolocation_state FROM f_place"""
_CTE["f_audit"] = """
  SELECT 'run-' || CAST(user_id AS VARCHAR) AS run_id,
    CASE event_id % 3 WHEN 0 THEN 'ingestion' WHEN 1 THEN 'spark' ELSE 'dbt' END AS pipeline_stage,
    event_type AS entity_type, CAST(FLOOR(value) AS BIGINT) AS rows_processed,
    CASE WHEN event_id % 10 = 0 THEN event_id % 7 ELSE 0 END AS rows_failed,
    CAST(ts AS TIMESTAMP) AS started_at, CAST(ts AS TIMESTAMP) + to_seconds(event_id % 600) AS finished_at,
    event_id
  FROM events"""
_CTE["f_lag"] = """
  SELECT CAST(ts AS TIMESTAMP) AS ts, 'gcs-bronze-' || event_type AS consumergroup, event_type AS topic,
    CAST(user_id % 4 AS INT) AS "partition", CAST(FLOOR(value * 10) AS BIGINT) AS lag
  FROM events"""

# Gold
_CTE["g_payments"] = """
  SELECT order_id, COUNT(DISTINCT payment_sequential) AS total_payment_sequences,
    SUM(payment_value) AS total_payment_value, MAX(payment_installments) AS max_payment_installments
  FROM f_payment GROUP BY order_id"""
_CTE["g_reviews"] = """
  SELECT order_id, AVG(review_score) AS avg_review_score, COUNT(review_id) AS total_reviews
  FROM f_review GROUP BY order_id"""
_CTE["g_orders"] = """
  SELECT o.order_id, o.customer_id, c.customer_unique_id, c.customer_city, c.customer_state, o.order_status,
    o.order_purchase_timestamp, o.order_approved_at, o.order_delivered_carrier_date,
    o.order_delivered_customer_date, o.order_estimated_delivery_date,
    COALESCE(p.total_payment_sequences, 0) AS total_payment_sequences,
    COALESCE(p.total_payment_value, 0) AS total_payment_value,
    COALESCE(p.max_payment_installments, 0) AS max_payment_installments,
    COALESCE(r.avg_review_score, 0) AS avg_review_score, COALESCE(r.total_reviews, 0) AS total_reviews,
    date_diff('day', o.order_purchase_timestamp, o.order_delivered_customer_date) AS delivery_time_days,
    date_diff('day', o.order_estimated_delivery_date, o.order_delivered_customer_date) AS delta_delivery_vs_estimated_days
  FROM f_order o LEFT JOIN f_customer c ON o.customer_id = c.customer_id
    LEFT JOIN g_payments p ON o.order_id = p.order_id LEFT JOIN g_reviews r ON o.order_id = r.order_id"""
_CTE["g_places"] = """
  SELECT customer_unique_id, customer_city, customer_state FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY customer_unique_id ORDER BY customer_id DESC) AS rn FROM f_customer)
  WHERE rn = 1"""
_CTE["g_bought"] = """
  SELECT DISTINCT CAST(date_trunc('month', order_purchase_timestamp) AS DATE) AS m, c.customer_state, o.customer_unique_id
  FROM g_orders o JOIN g_places c ON o.customer_unique_id = c.customer_unique_id"""
_CTE["g_lifetime"] = """
  SELECT customer_unique_id, COUNT(DISTINCT order_id) AS total_orders,
    SUM(total_payment_value) AS total_lifetime_value, AVG(avg_review_score) AS avg_lifetime_review_score,
    AVG(CASE WHEN total_reviews > 0 THEN avg_review_score END) AS avg_reviewed_score
  FROM g_orders GROUP BY customer_unique_id"""
_CTE["g_customers"] = """
  SELECT c.*, COALESCE(o.total_orders, 0) AS total_orders,
    COALESCE(o.total_lifetime_value, 0) AS total_lifetime_value,
    COALESCE(o.avg_lifetime_review_score, 0) AS avg_lifetime_review_score, o.avg_reviewed_score
  FROM g_places c LEFT JOIN g_lifetime o ON c.customer_unique_id = o.customer_unique_id"""

_ORDERS = f"""
  customer_city, customer_state, order_status, order_id,
  {stamp('order_purchase_timestamp')} AS order_purchase_timestamp,
  {stamp('order_approved_at')} AS order_approved_at,
  {stamp('order_delivered_carrier_date')} AS order_delivered_carrier_date,
  {stamp('order_delivered_customer_date')} AS order_delivered_customer_date,
  {stamp('order_estimated_delivery_date')} AS order_estimated_delivery_date,
  total_payment_sequences, {money('total_payment_value')} AS total_payment_value,
  CAST(max_payment_installments AS BIGINT) AS max_payment_installments, avg_review_score, total_reviews,
  delivery_time_days, delta_delivery_vs_estimated_days"""


# Envelopes of reviews
_REVIEW_JSON = " || ', ' || ".join(
    f"""'"{c}": "' || {expression} || '"'"""
    for c, expression in {
        "order_id": "order_id",
        "review_answer_timestamp": "strftime(review_answer_timestamp, '%Y-%m-%d %H:%M:%S')",
        "review_comment_message": """replace(review_comment_message, '"', '\\"')""",
        "review_comment_title": "review_comment_title",
        "review_creation_date": "strftime(review_creation_date, '%Y-%m-%d %H:%M:%S')",
        "review_id": "review_id",
        "review_score": "CAST(review_score AS VARCHAR)",
    }.items()
)
_CTE["g_digest"] = f"""
  SELECT *, sha256('{{' || {_REVIEW_JSON} || '}}') AS checksum FROM f_review"""
_CTE["g_envelope"] = """
  SELECT *, sha256('review' || chr(31) || review_id || chr(31) || checksum) AS event_id,
    strftime(review_creation_date, '%Y-%m-%dT%H:%M:%S.%fZ') AS ingested_at FROM g_digest"""
_REVIEW_TEXT = """
  review_id, order_id, CAST(review_score AS VARCHAR) AS review_score, review_comment_title,
  review_comment_message, strftime(review_creation_date, '%Y-%m-%d %H:%M:%S') AS review_creation_date,
  strftime(review_answer_timestamp, '%Y-%m-%d %H:%M:%S') AS review_answer_timestamp"""

# Orders with broken rules
_CTE["f_order_text"] = """
  SELECT order_id, CASE WHEN RIGHT(order_id, 1) <> '3' THEN customer_id END AS customer_id,
    CASE WHEN order_approved_at IS NULL THEN 'lost' ELSE order_status END AS order_status,
    CASE WHEN RIGHT(order_id, 1) = '5' THEN 'yesterday'
      ELSE strftime(order_purchase_timestamp, '%Y-%m-%d %H:%M:%S') END AS order_purchase_timestamp,
    strftime(order_approved_at, '%Y-%m-%d %H:%M:%S') AS order_approved_at,
    strftime(order_delivered_carrier_date, '%Y-%m-%d %H:%M:%S') AS order_delivered_carrier_date,
    strftime(order_delivered_customer_date, '%Y-%m-%d %H:%M:%S') AS order_delivered_customer_date,
    strftime(order_estimated_delivery_date, '%Y-%m-%d %H:%M:%S') AS order_estimated_delivery_date
  FROM f_order"""

# Silver
_CTE["g_items_latest"] = """
  SELECT * EXCLUDE (rn) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY order_id, order_item_id
    ORDER BY shipping_limit_date DESC, product_id, seller_id, price, quantity) AS rn FROM f_order_item)
  WHERE rn = 1"""
_ITEM = f"""
  order_id, CAST(order_item_id AS BIGINT) AS order_item_id, product_id, seller_id,
  CAST(shipping_limit_date AS VARCHAR) AS shipping_limit_date, {money('price')} AS price,
  {money('freight_value')} AS freight_value, quantity"""

# Lag
_CTE["g_lag"] = """
  SELECT date_trunc('hour', ts) AS ts, consumergroup, topic, SUM(lag) AS lag FROM f_lag GROUP BY 1, 2, 3"""


def _islands(source: str) -> str:
    """Hourly samples above 1000, numbered by unbroken hour-to-hour stretches."""
    return f"""
      SELECT *, MIN(ts) OVER (PARTITION BY topic, island) AS since FROM (
        SELECT *, SUM(begins) OVER (PARTITION BY topic ORDER BY ts) AS island FROM (
          SELECT *, CASE WHEN LAG(lag) OVER w > 1000 AND LAG(ts) OVER w >= ts - INTERVAL 1 HOUR
              THEN 0 ELSE 1 END AS begins
          FROM {source} WINDOW w AS (PARTITION BY topic ORDER BY ts))
      ) WHERE lag > 1000"""


def _staged(entity: str) -> str:
    """Text columns, some broken, cast back where they parse."""
    spec = ENTITIES[entity]
    columns = []
    for f in spec.fields:
        name = "order_item_id" if f.name == "order_item_sequence" else f.name
        text = {
            "timestamp": f"strftime({name}, '%Y-%m-%d %H:%M:%S')",
            "numeric": f"CAST(CAST({name} AS DECIMAL(28,4)) AS VARCHAR)",
        }.get(f.type, f"CAST({name} AS VARCHAR)")
        if (entity, f.source) in BROKEN:
            condition, broken = BROKEN[entity, f.source]
            text = f"CASE WHEN {condition} THEN '{broken}' ELSE {text} END"
        columns.append(
            {
                "timestamp": stamp(f"TRY_CAST({text} AS TIMESTAMP)"),
                "numeric": money(f"TRY_CAST({text} AS DECIMAL(28,9))"),
                "integer": f"CAST(TRY_CAST({text} AS INT) AS BIGINT)",
            }.get(f.type, text)
            + f" AS {f.name}"
        )
    key = " || '|' || ".join(
        money_key(k) if k in ("geolocation_lat", "geolocation_lng") else f"CAST({k} AS VARCHAR)"
        for k in spec.key
    )
    return f"""
      SELECT {', '.join(columns)}, sha256('{entity}|' || {key}) AS event_id,
        '2024-01-31 12:30:00.000000' AS ingested_at, '1.0.0' AS schema_version,
        '2024-02-01 00:00:00.000000' AS silver_loaded_at
      FROM f_{entity}"""


def money_key(c: str) -> str:
    return f"CAST(CAST({c} AS DECIMAL(28,9)) AS VARCHAR)"


def _test_sql(test: DataTest, tables: dict[str, str]) -> str:
    def name(c: str) -> str:
        return "order_item_id" if c == "order_item_sequence" else c

    table, c = tables[test.table], name(test.column)
    if test.kind == "not_null":
        count = f"SELECT COUNT(*) FROM {table} WHERE {c} IS NULL"
    elif test.kind == "accepted_values":
        values = ", ".join(f"'{v}'" for v in test.values)
        count = f"SELECT COUNT(*) FROM {table} WHERE {c} NOT IN ({values})"
    elif test.kind == "unique":
        count = f"SELECT COUNT(*) FROM (SELECT {c} FROM {table} WHERE {c} IS NOT NULL GROUP BY 1 HAVING COUNT(*) > 1)"
    else:
        parent = tables[test.parent]
        count = f"""SELECT COUNT(*) FROM {table} t WHERE {c} IS NOT NULL
          AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{test.parent_column} = t.{c})"""
    return f"""SELECT '{test.table}' AS "table", '{test.kind}' AS test, '{test.column}' AS "column", ({count}) AS failures"""


def _tests_sql(tests: tuple[DataTest, ...], tables: dict[str, str]) -> str:
    union = " UNION ALL ".join(_test_sql(t, tables) for t in tests)
    return f"SELECT *, CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status FROM ({union})"


def _mask(c: str) -> str:
    return f"SUBSTR({c}, 1, 4) || '****-PII-MASKED-****'"


def oracles() -> dict[str, str]:
    out: dict[str, str] = {}

    # Models
    out["int_orders_enriched"] = f"SELECT customer_id, customer_unique_id, {_ORDERS} FROM g_orders"
    out["fct_orders"] = out["int_orders_enriched"]
    out["fct_orders_masked"] = f"""
      SELECT {_mask('customer_id')} AS customer_id, {_mask('customer_unique_id')} AS customer_unique_id,
        {_ORDERS} FROM g_orders"""
    out["pii_mask_modes"] = f"""
      SELECT customer_id, {_mask('customer_unique_id')} AS by_prefix,
        sha256(customer_unique_id) AS by_sha256, CAST(NULL AS VARCHAR) AS by_null,
        customer_unique_id AS by_none, CAST(NULL AS VARCHAR) AS number_by_prefix
      FROM f_customer"""
    personal = {("fct_orders", "customer_id"), ("fct_orders", "customer_unique_id"), ("dim_customers", "customer_unique_id")}
    published = {
        "fct_orders": ("g_orders", FCT_ORDERS_CONTRACT.names),
        "dim_customers": ("g_customers", DIM_CUSTOMERS_CONTRACT.names),
        "dim_products": ("f_product", "product_id product_category_name product_weight_g product_length_cm product_height_cm product_width_cm".split()),
        "dim_sellers": ("f_seller", "seller_id seller_zip_code_prefix seller_city seller_state".split()),
        "fct_order_items": (
            "(SELECT *, price + freight_value AS total_item_value FROM f_order_item)",
            "order_id order_item_id product_id seller_id price freight_value total_item_value".split(),
        ),
    }
    out["pii_catalogue"] = " UNION ALL ".join(
        f"""SELECT '{t}' AS "table", '{c}' AS "column", {int((t, c) in personal)} AS pii,
          {"'confidential'" if (t, c) in personal else "NULL"} AS classification, COUNT({c}) AS filled FROM {source}"""
        for t, (source, columns) in published.items()
        for c in columns
    )
    out["dim_customers"] = f"""
      SELECT customer_unique_id, customer_city, customer_state, total_orders,
        {money('total_lifetime_value')} AS total_lifetime_value,
        ROUND(avg_lifetime_review_score, 9) AS avg_lifetime_review_score,
        ROUND(avg_reviewed_score, 9) AS avg_reviewed_score FROM g_customers"""
    out["dim_products"] = f"""
      SELECT product_id, product_category_name, {money('product_weight_g')} AS product_weight_g,
        {money('product_length_cm')} AS product_length_cm, {money('product_height_cm')} AS product_height_cm,
        {money('product_width_cm')} AS product_width_cm FROM f_product"""
    out["dim_sellers"] = "SELECT * FROM f_seller"
    out["fct_order_items"] = f"""
      SELECT order_id, CAST(order_item_id AS BIGINT) AS order_item_id, product_id, seller_id,
        {money('price')} AS price, {money('freight_value')} AS freight_value,
        {money('price + freight_value')} AS total_item_value FROM f_order_item"""
    out["mart_category_performance"] = f"""
      SELECT p.product_category_name, COUNT(DISTINCT i.order_id) AS total_orders,
        COUNT(i.order_item_id) AS total_items_sold, {money('SUM(i.price)')} AS total_revenue,
        {ratio('SUM(i.price)')} / COUNT(i.price) AS average_item_price
      FROM f_product p LEFT JOIN f_order_item i ON p.product_id = i.product_id
      WHERE p.product_category_name IS NOT NULL GROUP BY 1"""
    out["mart_seller_performance"] = f"""
      SELECT s.seller_id, s.seller_city, s.seller_state, COUNT(DISTINCT i.order_id) AS total_orders_fulfilled,
        COUNT(i.order_item_id) AS total_items_sold, {money('SUM(i.price)')} AS total_revenue,
        {money('SUM(i.freight_value)')} AS total_freight_value,
        {ratio('SUM(i.price)')} / COUNT(i.price) AS average_item_price
      FROM f_seller s LEFT JOIN f_order_item i ON s.seller_id = i.seller_id GROUP BY 1, 2, 3"""
    out["sales_aggregate"] = f"""
      SELECT CAST(l_partkey AS VARCHAR) AS product_id,
        {money('SUM(CAST(l_extendedprice AS DECIMAL(12,2)))')} AS total_sales,
        COUNT(l_orderkey) AS transaction_count
      FROM lineitem GROUP BY l_partkey"""

    # Analytical queries
    out["q1_full_scan"] = f"""
      SELECT COUNT(*) AS cnt, {money('SUM(total_payment_value)')} AS sum_val,
        ROUND(CAST(SUM(delivery_time_days) AS DOUBLE) / COUNT(delivery_time_days), 9) AS avg_days FROM g_orders"""
    out["q2_state_ltv"] = f"""
      SELECT customer_state, COUNT(*) AS cnt, {money('SUM(total_lifetime_value)')} AS ltv
      FROM g_customers GROUP BY 1 ORDER BY CAST(ltv AS DOUBLE) DESC, 1 LIMIT 10"""
    out["q3_category_revenue"] = f"""
      SELECT product_category_name, COUNT(order_id) AS item_count, {money('SUM(price)')} AS revenue
      FROM f_order_item JOIN f_product USING (product_id) GROUP BY 1 ORDER BY CAST(revenue AS DOUBLE) DESC, 1 LIMIT 10"""
    rfm = """
      SELECT customer_unique_id, COUNT(order_id) AS total_orders, SUM(total_payment_value) AS spent,
        DENSE_RANK() OVER (ORDER BY SUM(total_payment_value) DESC) AS monetary_rank
      FROM g_orders GROUP BY 1"""
    out["q4_rfm_rank"] = f"""
      SELECT customer_unique_id, total_orders, {money('spent')} AS monetary_value, monetary_rank
      FROM ({rfm}) ORDER BY monetary_rank, customer_unique_id LIMIT 100"""
    out["q4_rfm_rank_full"] = f"""
      SELECT customer_unique_id, total_orders, {money('spent')} AS monetary_value, monetary_rank FROM ({rfm})"""
    out["q4_rfm_recency"] = f"""
      SELECT customer_unique_id, order_id AS last_order_id,
        {stamp('order_purchase_timestamp')} AS last_purchase, total_orders, {money('spent')} AS monetary_value
      FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY customer_unique_id
              ORDER BY order_purchase_timestamp DESC, order_id DESC) AS rn,
            COUNT(order_id) OVER (PARTITION BY customer_unique_id) AS total_orders,
            SUM(total_payment_value) OVER (PARTITION BY customer_unique_id) AS spent FROM g_orders)
      WHERE rn = 1"""
    out["q5_semi_join"] = f"""
      SELECT order_id, customer_id, {money('total_payment_value')} AS total_payment_value, order_status
      FROM g_orders
      WHERE customer_unique_id IN (SELECT customer_unique_id FROM g_places
          WHERE customer_state IN ('ASIA', 'EUROPE', 'AFRICA'))
        AND order_id IN (SELECT order_id FROM f_order_item JOIN f_product USING (product_id)
          WHERE product_category_name = 'promo')
      ORDER BY order_id LIMIT 100"""
    out["q5_semi_join_compat"] = f"""
      SELECT order_id, customer_id, {money('total_payment_value')} AS total_payment_value, order_status
      FROM (SELECT order_id, {_mask('customer_id')} AS customer_id, total_payment_value, order_status FROM g_orders)
      WHERE customer_id IN (SELECT {_mask('customer_unique_id')} FROM g_places
          WHERE customer_state IN ('ASIA', 'EUROPE', 'AFRICA'))"""
    out["q5_semi_join_all"] = out["q5_semi_join"].replace("ORDER BY order_id LIMIT 100", "")
    daily = """
      SELECT CAST(order_purchase_timestamp AS DATE) AS d, SUM(total_payment_value) AS revenue
      FROM g_orders GROUP BY 1"""
    for name, frame in {
        "q6_rolling_30_rows": "ROWS BETWEEN 29 PRECEDING AND CURRENT ROW",
        "q6_rolling_30_days": "RANGE BETWEEN INTERVAL 29 DAYS PRECEDING AND CURRENT ROW",
    }.items():
        out[name] = f"""
          SELECT CAST(d AS VARCHAR) AS order_date, {money('revenue')} AS daily_revenue,
            {ratio(f'SUM(revenue) OVER (ORDER BY d {frame})')} / COUNT(revenue) OVER (ORDER BY d {frame})
              AS rolling_30d_avg
          FROM ({daily}) ORDER BY d DESC LIMIT 100"""
    frame = "PARTITION BY customer_state ORDER BY d ROWS BETWEEN 29 PRECEDING AND CURRENT ROW"
    out["q6_rolling_by_state"] = f"""
      SELECT customer_state, CAST(d AS VARCHAR) AS order_date, {money('revenue')} AS daily_revenue,
        {ratio(f'SUM(revenue) OVER ({frame})')} / COUNT(revenue) OVER ({frame}) AS rolling_30d_avg
      FROM (SELECT customer_state, CAST(order_purchase_timestamp AS DATE) AS d,
        SUM(total_payment_value) AS revenue FROM g_orders GROUP BY 1, 2)"""
    out["q7_string_ops"] = """
      SELECT product_id, UPPER(product_category_name) AS cat_upper,
        SUBSTR(product_id, 1, 8) || '...' AS short_id, COUNT(order_id) AS sales_count
      FROM f_product JOIN f_order_item USING (product_id)
      WHERE product_category_name LIKE '%prom%' OR product_category_name LIKE '%mall%'
        OR product_category_name LIKE '%econ%'
      GROUP BY product_id, product_category_name ORDER BY sales_count DESC, product_id LIMIT 100"""
    pivot = ", ".join(
        money(f"SUM(CASE WHEN product_category_name = '{c}' THEN price ELSE 0 END)")
        + f" AS revenue_{c}"
        for c in ("promo", "small", "large", "economy")
    )
    out["q8_pivot"] = f"""
      SELECT c.customer_state, {pivot}, COUNT(i.order_id) AS total_items
      FROM f_order_item i JOIN f_product p ON i.product_id = p.product_id
        JOIN g_orders o ON i.order_id = o.order_id
        JOIN g_places c ON o.customer_unique_id = c.customer_unique_id
      GROUP BY 1 ORDER BY total_items DESC, 1 LIMIT 100"""
    out["q9_star_join"] = f"""
      SELECT c.customer_state, s.seller_state, p.product_category_name,
        COUNT(DISTINCT o.order_id) AS unique_orders, {money('SUM(i.price)')} AS gross_merchandise_value
      FROM g_orders o JOIN g_places c ON o.customer_unique_id = c.customer_unique_id
        JOIN f_order_item i ON o.order_id = i.order_id JOIN f_product p ON i.product_id = p.product_id
        JOIN f_seller s ON i.seller_id = s.seller_id
      GROUP BY 1, 2, 3
      ORDER BY CAST(gross_merchandise_value AS DOUBLE) DESC, 1, 2, 3 NULLS FIRST LIMIT 100"""
    out["q9_star_join_all"] = out["q9_star_join"].split("ORDER BY")[0]
    out["q10_percentile_exact"] = """
      SELECT c.customer_state, ROUND(quantile_cont(CAST(CAST(o.total_payment_value AS DECIMAL(38,9)) AS DOUBLE), 0.5), 6)
          AS median_payment,
        ROUND(quantile_cont(CAST(o.delivery_time_days AS DOUBLE), 0.9), 6) AS p90_delivery_time
      FROM g_orders o JOIN g_places c ON o.customer_unique_id = c.customer_unique_id
      GROUP BY 1 ORDER BY median_payment DESC, 1 LIMIT 100"""

    # Staging
    for name, entity in STAGED.items():
        out[name] = _staged(entity)
    out["stg_payments_variant"] = out["stg_payments"]

    # Silver
    out["silver_keep_latest"] = f"SELECT {_ITEM} FROM g_items_latest"
    out["silver_keep_latest_compat"] = f"""
      SELECT {_ITEM} FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY order_item_id
        ORDER BY shipping_limit_date DESC, product_id, seller_id, price, quantity) AS rn FROM f_order_item)
      WHERE rn = 1"""
    out["silver_upsert"] = out["silver_keep_latest"]
    out["silver_refine"] = """
      SELECT review_id, order_id, CAST(review_score AS VARCHAR) AS review_score, review_comment_title,
        review_comment_message, strftime(review_creation_date, '%Y-%m-%d %H:%M:%S.000000') AS review_creation_date,
        strftime(review_answer_timestamp, '%Y-%m-%d %H:%M:%S.000000') AS review_answer_timestamp,
        'review' AS entity_type, checksum, '2024-02-01 00:00:00.000000' AS _silver_loaded_at
      FROM g_envelope"""
    out["silver_table_diff"] = f"""
      SELECT {_ITEM}, CAST(SUM(n) AS BIGINT) AS surplus FROM (
        SELECT *, 1 AS n FROM f_order_item UNION ALL SELECT *, -1 AS n FROM g_items_latest)
      GROUP BY ALL HAVING SUM(n) <> 0"""
    out["reconcile"] = """
      SELECT CAST(order_item_id AS BIGINT) AS order_item_id, raw_count, silver_count,
        raw_count - silver_count AS duplicates_dropped
      FROM (SELECT order_item_id, COUNT(*) AS raw_count, COUNT(DISTINCT order_id) AS silver_count
            FROM f_order_item GROUP BY 1)"""

    # Envelopes
    out["envelope_roundtrip"] = f"""
      SELECT {_REVIEW_TEXT}, event_id, 'olist.review.created' AS event_type, 'review' AS entity_type,
        'olist-csv-producer' AS source_system, 'ecommerce.olist.reviews.v1' AS source_topic,
        '1.0.0' AS schema_version, ingested_at, 'dev' AS ingestion_env, 'run-1' AS pipeline_run_id,
        'bronze' AS data_layer, checksum FROM g_envelope"""
    out["envelope_unpack"] = f"SELECT {_REVIEW_TEXT} FROM f_review"
    out["kafka_key"] = """
      SELECT order_id, CAST(order_item_id AS VARCHAR) AS order_item_id,
        order_id || '|' || CAST(order_item_id AS VARCHAR) AS message_key,
        CAST(order_item_id AS VARCHAR) AS compat_key FROM f_order_item"""
    customer_json = " || ', ' || ".join(
        f"""'"{c}": "' || {c} || '"'""" for c in sorted(ENTITIES["customer"].columns)
    )
    out["checksum"] = f"""
      SELECT customer_id, sha256('{{' || {customer_json} || '}}') AS checksum FROM f_customer"""
    out["checksum_verify"] = """
      SELECT customer_id, CASE WHEN customer_state = 'ASIA' THEN 'EUROPE' ELSE customer_state END AS customer_state,
        CASE WHEN customer_state = 'ASIA' THEN 0 ELSE 1 END AS checksum_ok FROM f_customer"""
    out["field_mapping"] = f"""
      SELECT user_id AS id, CAST(NULL AS VARCHAR) AS product_id, value AS amount,
        {stamp('CAST(ts AS TIMESTAMP)')} AS created_at FROM events"""
    out["typed_event"] = """
      SELECT CAST(event_id AS VARCHAR) AS id, CAST(user_id AS VARCHAR) AS product_id,
        CASE WHEN event_type <> 'error' THEN CAST(CAST(value AS DECIMAL(12,2)) AS DOUBLE) END AS amount,
        strftime(ts, '%Y-%m-%d %H:%M:%S.000000') AS created_at,
        CASE WHEN event_type = 'purchase' THEN 'PAID' ELSE 'NEW' END AS status,
        CASE WHEN event_type = 'error' THEN 0 ELSE 1 END AS is_valid FROM events"""
    out["contract_split"] = """
      SELECT order_id, CASE WHEN reason = '' THEN 'pass' ELSE 'reject' END AS outcome, reason FROM (
        SELECT order_id, concat_ws('; ',
          CASE WHEN customer_id IS NULL THEN 'customer_id: missing' END,
          CASE WHEN order_status = 'lost' THEN 'order_status: value not accepted' END,
          CASE WHEN order_purchase_timestamp = 'yesterday' THEN 'order_purchase_timestamp: not a timestamp' END
        ) AS reason FROM f_order_text)"""
    out["dlq_split"] = """
      SELECT event_id, CASE WHEN event_type = 'error' THEN 'dead_letter' ELSE 'bronze' END AS sink,
        CASE WHEN event_type <> 'error' THEN event_type END AS event_type FROM events"""

    # Text and money functions
    blank = "^[\\s\\x0b\\x1c-\\x1f\\p{Z}]+|[\\s\\x0b\\x1c-\\x1f\\p{Z}]+$"
    out["clean_string"] = """
      SELECT conv_id, turn,
        regexp_replace(text, '[^\\p{L}\\p{N}\\s\\x0b\\x1c-\\x1f\\p{Z}]', '', 'g') AS cleaned
      FROM conversations"""
    out["strip_values"] = f"""
      SELECT doc_id, sha256(regexp_replace(text, '{blank}', '', 'g')) AS stripped FROM documents"""
    out["format_date"] = """
      SELECT event_id, CASE WHEN event_type <> 'error' THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')
        || CASE WHEN strftime(ts, '.%f') = '.000000' THEN '' ELSE strftime(ts, '.%f') END END AS iso
      FROM events"""
    out["cents_to_dollars"] = f"""
      SELECT l_orderkey, l_linenumber, l_partkey, {money(
          "ROUND(CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(28,4)), 2)"
      )} AS dollars FROM lineitem"""
    out["sql_functions"] = f"""
      SELECT o_orderkey, {_mask('o_orderpriority')} AS masked, {money(
          "ROUND(CAST(CAST(o_totalprice AS DECIMAL(14,2)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(28,4)), 2)"
      )} AS dollars, TRY_CAST(SUBSTR(o_orderpriority, 1, 1) AS BIGINT) AS priority,
        CAST(NULL AS BIGINT) AS not_a_number FROM orders"""
    out["csv_scan"] = f"""
      SELECT conv_id, turn, role, sha256(regexp_replace(text, '{blank}', '', 'g')) AS text_hash,
        CAST(NULL AS VARCHAR) AS _error FROM conversations"""

    # Quality
    out["dq_unique"] = """
      SELECT order_id, CAST(order_item_id AS BIGINT) AS order_item_id, COUNT(*) AS n FROM f_order_item
      GROUP BY 1, 2 HAVING COUNT(*) > 1"""
    out["dq_not_null"] = " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", COUNT(*) - COUNT({c}) AS failures FROM f_order"""
        for c in ENTITIES["order"].columns
    )
    out["dq_accepted_values"] = """
      SELECT review_comment_title AS value, COUNT(*) AS n FROM f_review
      WHERE review_comment_title NOT IN ('view', 'click', 'purchase') GROUP BY 1"""
    out["dq_relationships"] = """
      SELECT order_id AS value, COUNT(*) AS n FROM f_order
      WHERE order_id NOT IN (SELECT order_id FROM f_order_item) GROUP BY 1"""
    out["dq_staging_tests"] = _tests_sql(
        STAGING_TESTS, {name: f"f_{entity}" for name, entity in STAGED.items()}
    )
    out["dq_gold_tests"] = _tests_sql(
        GOLD_TESTS,
        {
            "fct_orders": "g_orders",
            "dim_customers": "g_places",
            "dim_products": "f_product",
            "dim_sellers": "f_seller",
            "fct_order_items": "f_order_item",
            "mart_category_performance": f"({out['mart_category_performance']})",
            "mart_seller_performance": f"({out['mart_seller_performance']})",
        },
    )

    # Observability
    status = """CASE WHEN rows_failed = 0 THEN 'success' WHEN rows_processed > 0 THEN 'partial' ELSE 'failed' END"""
    out["audit_status"] = f"""
      SELECT *, {status} AS status FROM (
        SELECT run_id, pipeline_stage, CAST(SUM(rows_processed) AS BIGINT) AS rows_processed,
          CAST(SUM(rows_failed) AS BIGINT) AS rows_failed FROM f_audit GROUP BY 1, 2)"""
    hourly = f"""
      SELECT {stamp("date_trunc('hour', finished_at)")} AS hour, entity_type,
        CAST(SUM(rows_processed) AS BIGINT) AS total_rows FROM f_audit"""
    out["audit_throughput"] = f"{hourly} GROUP BY 1, 2"
    out["audit_throughput_range"] = f"""{hourly}
      WHERE finished_at >= TIMESTAMP '2024-01-10' AND finished_at < TIMESTAMP '2024-01-20' GROUP BY 1, 2"""
    out["audit_error_rate"] = f"""
      SELECT pipeline_stage, status, COUNT(*) AS total_runs,
        ROUND(CAST(COUNT(*) AS DOUBLE) / SUM(COUNT(*)) OVER (PARTITION BY pipeline_stage), 9) AS share
      FROM (SELECT *, {status} AS status FROM f_audit) GROUP BY 1, 2"""
    out["audit_run_history"] = f"""
      SELECT run_id, entity_type, date_sub('second', started_at, finished_at) AS duration_seconds,
        {status} AS status, {stamp('started_at')} AS started_at FROM f_audit WHERE pipeline_stage = 'dbt'"""
    out["ingest_summary"] = """
      SELECT COALESCE(entity_type, 'TOTAL') AS file_name, CAST(SUM(rows_processed) AS BIGINT) AS produced,
        CAST(SUM(rows_failed) AS BIGINT) AS failed
      FROM f_audit WHERE pipeline_stage = 'ingestion' GROUP BY ROLLUP (entity_type)"""
    out["lag_sum"] = f"""
      SELECT {stamp('ts')} AS ts, consumergroup, topic, CAST(lag AS BIGINT) AS lag FROM g_lag"""
    out["lag_alert"] = f"""
      SELECT consumergroup, topic, {stamp('MIN(ts)')} AS started_at, {stamp('MAX(ts)')} AS ended_at,
        COUNT(*) AS samples, CAST(MAX(lag) AS BIGINT) AS peak
      FROM ({_islands('g_lag')}) GROUP BY consumergroup, topic, island
      HAVING MAX(ts) - MIN(ts) >= INTERVAL 3 HOURS"""
    out["volume_anomaly"] = """
      SELECT entity_type, CAST(day AS VARCHAR) AS day, n, ROUND(z, 3) AS z_score FROM (
        SELECT *, (n - mean) / spread AS z FROM (
          SELECT *, COUNT(n) OVER w AS k, AVG(CAST(n AS DOUBLE)) OVER w AS mean,
            stddev_samp(CAST(n AS DOUBLE)) OVER w AS spread FROM (
              SELECT entity_type, CAST(started_at AS DATE) AS day,
                CAST(SUM(rows_processed) AS BIGINT) + 1000000000000 AS n
              FROM f_audit GROUP BY 1, 2)
          WINDOW w AS (PARTITION BY entity_type ORDER BY day ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING))
        WHERE k >= 7 AND spread > 0)
      WHERE abs(z) > 2"""
    out["freshness"] = f"""
      SELECT pipeline_stage, entity_type, {stamp('t')} AS last_loaded_at, age AS age_seconds,
        CASE WHEN age <= 25500 THEN 1 ELSE 0 END AS is_fresh
      FROM (SELECT *, date_sub('second', t, TIMESTAMP '2024-01-31 07:00:00') AS age FROM (
        SELECT pipeline_stage, entity_type, MAX(finished_at) AS t FROM f_audit GROUP BY 1, 2))"""
    def fields(by: str) -> str:
        return " UNION ALL ".join(
            f"""SELECT {by}'{c}' AS "column",
              CASE WHEN bool_and(TRY_CAST({c} AS BIGINT) IS NOT NULL) THEN 'integer'
                WHEN bool_and(TRY_CAST({c} AS DOUBLE) IS NOT NULL) THEN 'numeric'
                WHEN bool_and(TRY_CAST({c} AS TIMESTAMP) IS NOT NULL) THEN 'timestamp' ELSE 'string' END AS type
              FROM f_order_text WHERE {c} IS NOT NULL GROUP BY ALL"""
            for c in ENTITIES["order"].columns
        )

    out["schema_diff"] = f"""
      SELECT * FROM (SELECT coalesce(a.status, b.order_status) AS status, coalesce(a."column", b."column") AS "column",
        a.type AS old_type, b.type AS new_type,
        CASE WHEN a.type IS NULL THEN 'added' WHEN b.type IS NULL THEN 'removed'
          WHEN a.type <> b.type THEN 'retyped' END AS change
        FROM (SELECT order_status AS status, w."column", w.type FROM ({fields("")}) w
          CROSS JOIN (SELECT DISTINCT order_status FROM f_order_text)) a
        FULL JOIN ({fields("order_status, ")}) b ON a.status = b.order_status AND a."column" = b."column")
      WHERE change IS NOT NULL"""
    out["test_history"] = f"""
      SELECT test, COUNT(*) AS runs, COUNT(*) FILTER (status = 'fail') AS failed_runs,
        arg_max(status, started_at) AS last_status, {stamp('MAX(started_at)')} AS last_run_at,
        COUNT(*) FILTER (status = 'fail' AND passes = total) AS failure_streak
      FROM (SELECT *, SUM(CASE WHEN status = 'pass' THEN 1 ELSE 0 END) OVER (PARTITION BY test ORDER BY started_at) AS passes,
          SUM(CASE WHEN status = 'pass' THEN 1 ELSE 0 END) OVER (PARTITION BY test) AS total
        FROM (SELECT pipeline_stage || '.' || entity_type AS test, started_at,
          CASE WHEN rows_failed > 0 THEN 'fail' ELSE 'pass' END AS status FROM f_audit))
      GROUP BY test"""
    out["e2e_latency"] = """
      SELECT entity_type, ROUND(quantile_cont(s, 0.5), 6) AS p50_seconds, ROUND(quantile_cont(s, 0.95), 6) AS p95_seconds
      FROM (SELECT entity_type, CAST(date_sub('second', started_at, finished_at) AS DOUBLE) AS s FROM f_audit)
      GROUP BY 1"""
    out["lineage_ancestors"] = """
      WITH RECURSIVE edge AS (
        SELECT DISTINCT run_id, pipeline_stage || '.' || entity_type AS output,
          CASE pipeline_stage WHEN 'dbt' THEN 'spark' WHEN 'spark' THEN 'ingestion' ELSE 'file' END
            || '.' || entity_type AS input FROM f_audit),
      walk AS (
        SELECT run_id, output, input, 1 AS depth FROM edge
        UNION ALL
        SELECT w.run_id, w.output, e.input, w.depth + 1 FROM walk w
          JOIN edge e ON e.run_id = w.run_id AND e.output = w.input)
      SELECT run_id, output, input, MIN(depth) AS depth FROM walk GROUP BY 1, 2, 3"""
    _log = """
      SELECT event_type AS query, CASE WHEN user_id % 2 = 0 THEN 'A' ELSE 'B' END AS platform,
        CASE WHEN event_id % 2 = 0 THEN 'cold' ELSE 'warm' END AS run,
        CAST(value AS DECIMAL(12,2)) AS seconds, user_id * 1000000 AS bytes, event_id FROM events"""
    out["query_log_compare"] = f"""
      SELECT query, platform, {', '.join(
          f"ROUND({ratio(f'SUM(seconds) FILTER (run = {r!r})')} / COUNT(seconds) FILTER (run = {r!r}), 9) AS {r}_seconds"
          for r in ('cold', 'warm')
      )}, MAX(bytes) AS bytes_scanned FROM ({_log}) GROUP BY 1, 2"""
    out["cost_estimate"] = f"""
      SELECT event_id, ROUND(scan, 9) AS scan_usd, ROUND(compute, 9) AS compute_usd,
        ROUND(scan * 1e6, 9) AS scan_usd_per_million, ROUND(compute * 1e6, 9) AS compute_usd_per_million
      FROM (SELECT event_id, CAST(bytes AS DOUBLE) / CAST(1e12 AS DOUBLE) * CAST(5 AS DOUBLE) AS scan,
        CAST(seconds AS DOUBLE) / CAST(3600 AS DOUBLE) * CAST(3 AS DOUBLE) AS compute FROM ({_log}))"""

    # Streams
    out["stream_bronze"] = """
      SELECT review_id, order_id, review_comment_message, ingested_at, checksum FROM g_envelope
      WHERE review_comment_title <> 'error'"""
    out["stream_quarantine"] = """
      SELECT review_id || '|' || order_id AS key, 'not a readable envelope' AS error FROM f_review
      WHERE review_comment_title = 'error'"""
    out["stream_dedup"] = "SELECT review_id || '|' || order_id AS key, event_id FROM g_envelope"
    out["stream_hourly_throughput"] = out["audit_throughput"]
    out["stream_silver"] = """
      SELECT order_id, customer_id, order_status,
        strftime(TRY_CAST(order_purchase_timestamp AS TIMESTAMP), '%Y-%m-%d %H:%M:%S.%f') AS order_purchase_timestamp,
        '2024-01-02T00:00:00.000000Z' AS ingested_at FROM f_order_text"""
    closed = """(SELECT * FROM g_lag WHERE ts + INTERVAL 2 HOURS <= (SELECT MAX(ts) FROM f_lag))"""
    out["stream_lag_alert"] = f"""
      SELECT consumergroup, topic, {stamp('since')} AS started_at, {stamp('MIN(ts)')} AS fired_at,
        CAST(arg_min(lag, ts) AS BIGINT) AS lag
      FROM ({_islands(closed)}) WHERE ts - since >= INTERVAL 3 HOURS GROUP BY consumergroup, topic, island, since"""
    # Groups of fewer rows than the sketch's accuracy are exact: a value at the rank.
    out["q10_percentile_approx"] = f"""
      SELECT c.customer_state, {money('quantile_disc(o.total_payment_value, 0.5)')} AS median_payment,
        quantile_disc(o.delivery_time_days, 0.9) AS p90_delivery_time
      FROM g_orders o JOIN g_places c ON o.customer_unique_id = c.customer_unique_id
      GROUP BY 1 ORDER BY CAST(median_payment AS DOUBLE) DESC, 1 LIMIT 100"""
    for name in ("q2_state_ltv", "q3_category_revenue", "q7_string_ops", "q8_pivot", "q10_percentile_exact", "q10_percentile_approx"):
        out[f"{name}_all"] = out[name].rpartition("ORDER BY")[0]
    out |= _runs(out)
    return {name: query(body) for name, body in out.items()}


def _runs(out: dict[str, str]) -> dict[str, str]:
    """Counterparts of the queries of whole runs."""
    reject = f"(SELECT * FROM ({out['contract_split']}) WHERE outcome = 'reject')"
    review = ENTITIES["review"].topic
    tables = {
        "fct_orders": "g_orders",
        "dim_customers": "g_customers",
        "dim_products": "f_product",
        "dim_sellers": "f_seller",
        "fct_order_items": "f_order_item",
        "mart_category_performance": "(SELECT DISTINCT product_category_name FROM f_product WHERE product_category_name IS NOT NULL)",
        "mart_seller_performance": "f_seller",
    }
    gold_rows = " UNION ALL ".join(f"SELECT '{t}' AS model, COUNT(*) AS n FROM {source}" for t, source in tables.items())
    kept = {
        e.name: f"(SELECT DISTINCT {', '.join(k if k != 'order_item_sequence' else 'order_item_id' for k in e.key)} FROM f_{e.name})"
        for e in ENTITIES.values()
    }
    done = "SELECT pipeline_stage, SUM(rows_processed) AS p, SUM(rows_failed) AS f FROM f_audit GROUP BY 1"
    columns = " UNION ALL ".join(f"SELECT '{f.name}' AS \"column\", '{f.dataType.simpleString()}' AS type" for f in FCT_ORDERS_CONTRACT.fields)
    silver = out["stream_silver"]
    placed = "g_orders o JOIN g_places c ON o.customer_unique_id = c.customer_unique_id"
    rest = ("freight_value", "price", "product_id", "quantity", "seller_id", "shipping_limit_date")
    differs = ", ".join(
        f"CASE WHEN MIN({c}) FILTER (n > 0) IS DISTINCT FROM MIN({c}) FILTER (n < 0)"
        f" OR MAX({c}) FILTER (n > 0) IS DISTINCT FROM MAX({c}) FILTER (n < 0) THEN '{c}' END"
        for c in rest
    )
    return {
        "table_drilldown": f"""
          SELECT order_id, CAST(order_item_id AS BIGINT) AS order_item_id, change, CAST(l AS BIGINT) AS left_rows,
            CAST(r AS BIGINT) AS right_rows, CASE change WHEN 'changed' THEN named ELSE '' END AS "columns"
          FROM (
            SELECT order_id, order_item_id, SUM(GREATEST(n, 0)) AS l, SUM(GREATEST(-n, 0)) AS r, concat_ws(',', {differs}) AS named,
              CASE WHEN MIN(n) > 0 THEN 'removed' WHEN MAX(n) < 0 THEN 'added' ELSE 'changed' END AS change
            FROM (
              SELECT * EXCLUDE (one), SUM(one) AS n FROM (
                SELECT *, 1 AS one FROM f_order_item
                UNION ALL BY NAME
                SELECT * REPLACE (CASE WHEN shipping_limit_date >= DATE '2001-10-01' THEN price + 1 ELSE price END AS price,
                  CASE WHEN shipping_limit_date < DATE '2001-10-01' OR quantity <= 40 THEN seller_id END AS seller_id), -1 AS one
                FROM g_items_latest WHERE shipping_limit_date >= DATE '1995-02-01')
              GROUP BY ALL HAVING SUM(one) <> 0)
            GROUP BY 1, 2)""",
        "q9_distinct_rollup": f"""
          SELECT c.customer_state, s.seller_state, p.product_category_name, COUNT(*) AS item_count,
            {money('SUM(i.price)')} AS gross_merchandise_value,
            COUNT(DISTINCT o.order_id) AS exact_orders, TRUE AS orders_near,
            COUNT(DISTINCT o.customer_unique_id) AS exact_customers, TRUE AS customers_near
          FROM {placed} JOIN f_order_item i ON o.order_id = i.order_id
            JOIN f_product p ON i.product_id = p.product_id JOIN f_seller s ON i.seller_id = s.seller_id
          GROUP BY 1, 2, 3""",
        "q10_kll_rollup": f"""
          SELECT c.customer_state, COUNT(*) AS order_count, {money('SUM(o.total_payment_value)')} AS revenue,
            TRUE AS median_payment_near, TRUE AS p90_delivery_time_near
          FROM {placed} GROUP BY 1""",
        "retention_rollup": """
          SELECT CAST(a.m AS VARCHAR) AS order_month, a.customer_state, COUNT(*) AS customers,
            COUNT(b.m) AS "returning"
          FROM g_bought a LEFT JOIN g_bought b ON b.customer_unique_id = a.customer_unique_id
            AND b.customer_state = a.customer_state AND b.m = a.m + INTERVAL '1' MONTH
          GROUP BY 1, 2""",
        "csv_row_count": "SELECT COUNT(*) AS n FROM conversations",
        "csv_routes": f"""
          SELECT 'olist_customers_dataset.csv' AS file_name, '{ENTITIES["customer"].topic}' AS topic, 'customer' AS entity_type, COUNT(*) AS n FROM f_customer
          UNION ALL SELECT 'olist_sellers_dataset.csv', '{ENTITIES["seller"].topic}', 'seller', COUNT(*) FROM f_seller
          UNION ALL SELECT 'unknown.csv', NULL, NULL, COUNT(*) FROM f_geolocation""",
        "ingest_event_ids": "SELECT COUNT(*) AS n, COUNT(*) AS ids, COUNT(*) AS same FROM f_customer",
        "silver_catalog": "SELECT seller_id, seller_zip_code_prefix, seller_city, seller_state FROM f_seller",
        "sales_aggregate_table": out["sales_aggregate"],
        "topic_sink": f"SELECT '{review}' AS topic, review_id || '|' || order_id AS key, event_id FROM g_envelope",
        "dead_letters_raw": f"SELECT 'orders.csv:row:' || order_id AS key, order_id, reason AS error FROM {reject}",
        "dead_letters_enveloped": f"""
          SELECT event_id AS key, '{review}' AS original_topic, review_id FROM g_envelope
          WHERE review_comment_title = 'error'""",
        "gold_build": gold_rows,
        "gold_published": out["fct_orders_masked"],
        "gold_time_range": f"""
          SELECT CAST(CAST(order_purchase_timestamp AS DATE) AS VARCHAR) AS order_date, COUNT(DISTINCT order_id) AS orders,
            COUNT(*) AS items, {money('SUM(price)')} AS revenue
          FROM g_orders JOIN f_order_item USING (order_id)
          WHERE CAST(order_purchase_timestamp AS DATE) BETWEEN DATE '1995-03-01' AND DATE '1995-06-30' GROUP BY 1""",
        "gold_customer_range": f"""
          SELECT customer_unique_id, CAST(CAST(order_purchase_timestamp AS DATE) AS VARCHAR) AS order_date, order_id,
            order_item_id, product_id, {money('price')} AS price
          FROM g_orders JOIN f_order_item USING (order_id)
          WHERE CAST(order_purchase_timestamp AS DATE) >= DATE '1995-03-01' AND customer_unique_id IN (
            SELECT customer_unique_id FROM g_places ORDER BY customer_unique_id LIMIT 11)""",
        "audit_log": f"""
          SELECT pipeline_stage, CAST(p AS BIGINT) AS rows_processed, CAST(f AS BIGINT) AS rows_failed,
            CASE WHEN f = 0 THEN 'success' WHEN p > 0 THEN 'partial' ELSE 'failed' END AS status FROM ({done})""",
        "model_run_log": f"""
          SELECT model, n AS rows_processed, 'success' AS status FROM ({gold_rows})
          UNION ALL SELECT 'int_orders_enriched', 0, 'success'""",
        "silver_load_summary": """
          SELECT 'customer' AS entity, 2 * COUNT(*) AS raw_count, COUNT(*) AS silver_count, COUNT(*) AS duplicates_dropped,
            'SUCCESS' AS status FROM f_customer
          UNION ALL SELECT 'seller', 2 * COUNT(*), COUNT(*), COUNT(*), 'SUCCESS' FROM f_seller""",
        "dq_nonempty": """
          SELECT 'customer' AS entity, 'DQ_FAIL' AS status, COUNT(*) AS n FROM customer
          UNION ALL SELECT 'seller', 'SUCCESS', COUNT(*) FROM f_seller""",
        "dq_null_keys": "SELECT entity, status, n FROM (SELECT 'customer' AS entity, 'DQ_FAIL' AS status, COUNT(*) FILTER (customer_state = 'ASIA') AS n FROM f_customer)",
        "table_contract": f"SELECT \"column\", type, (SELECT COUNT(*) FROM g_orders) AS n FROM ({columns})",
        "stream_flush": "SELECT COUNT(*) AS n, 1 AS batches FROM f_review WHERE review_comment_title <> 'error'",
        "stream_all_topics": " UNION ALL ".join(f"SELECT '{name}' AS entity, COUNT(*) AS n FROM f_{name}" for name in kept),
        "stream_replay": "SELECT review_id, order_id, 2 AS n FROM f_review WHERE review_comment_title <> 'error'",
        "bronze_since": out["stream_bronze"] + " AND review_creation_date >= TIMESTAMP '2024-01-05'",
        "stream_silver_after_rebuild": f"""
          SELECT * FROM ({silver})""",
        "stream_silver_replay": silver,
        "stream_silver_quarantine": """
          SELECT review_id || '|' || order_id AS key, 'not a readable envelope' AS error FROM f_review
          WHERE review_comment_title = 'error'""",
    }


# Staging tables and their entities.
STAGED = {
    "stg_orders": "order",
    "stg_order_items": "order_item",
    "stg_payments": "payment",
    "stg_reviews": "review",
    "stg_customers": "customer",
    "stg_products": "product",
    "stg_sellers": "seller",
    "stg_product_categories": "product_category",
    "stg_geolocation": "geolocation",
}
