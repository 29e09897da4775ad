"""Monthly roll-ups of the Gold facts and the questions they answer without the facts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orebed.operators.rollup import Rollup, members_kept
from orebed.session import durable, tidy_shuffles

SALES = Rollup(
    keys=("order_month", "customer_state", "seller_state", "product_category_name"),
    sums={"gross_merchandise_value": "price"},
    members={"unique_orders": "order_id", "unique_customers": "customer_unique_id"},
)
PAYMENTS = Rollup(
    keys=("order_month", "customer_state"),
    sums={"total_payment_value": "total_payment_value"},
    distinct={"unique_customers": "customer_unique_id"},
    quantiles={"payment": "total_payment_value", "delivery_days": "delivery_time_days"},
)
PERCENTILES = {"median_payment": ("payment", 0.5), "p90_delivery_time": ("delivery_days", 0.9)}


def _month() -> Column:
    return F.date_trunc("MONTH", "order_purchase_timestamp").cast("date").alias("order_month")


def monthly_orders(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Orders with their month and the current state of their customer, as PAYMENTS reads them."""
    places = customers.select("customer_unique_id", "customer_state")
    chosen = orders.select(
        "order_id", "customer_unique_id", _month(), "total_payment_value", "delivery_time_days"
    )
    return chosen.join(places, "customer_unique_id")


def monthly_items(
    orders: DataFrame, customers: DataFrame, items: DataFrame, products: DataFrame, sellers: DataFrame
) -> DataFrame:
    """Items with the month, the places and the category that SALES counts them under.

    Items meet their category and place first: an order's customer, as long as all the rest of a row,
    joins last and travels once an order, not with each item through every shuffle.
    """
    places = customers.select("customer_unique_id", "customer_state")
    bridge = orders.select("order_id", "customer_unique_id", _month()).join(places, "customer_unique_id")
    return (
        items.select("order_id", "product_id", "seller_id", "price")
        .join(products.select("product_id", "product_category_name"), "product_id")
        .drop("product_id")
        .join(sellers.select("seller_id", "seller_state"), "seller_id")
        .drop("seller_id")
        .join(bridge.hint("merge"), "order_id")
    )


def distinct_counts(rows: DataFrame, by: Sequence[Column], counted: Mapping[str, str]) -> DataFrame:
    """Distinct values per group, exactly, as ``{result: column}``; written one after the other.

    All values pass through a shuffle. Its files are gone before the next count, and few rows stay.
    """
    found = []
    for name, column in counted.items():
        with tidy_shuffles(rows.sparkSession):
            found.append(durable(rows.groupBy(*by).agg(F.countDistinct(column).alias(name))))
    keys = [c for c in found[0].columns if c not in counted]

    def beside(left: DataFrame, right: DataFrame) -> DataFrame:
        named = right.withColumnsRenamed({c: f"{c}_" for c in keys})
        same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"{c}_")) for c in keys])
        return left.join(named, same).drop(*[f"{c}_" for c in keys])

    return reduce(beside, found)


def sales_by_place(states: DataFrame, members: Mapping[str, DataFrame]) -> DataFrame:
    """The star join's groups from monthly states and members: exact sums and distinct counts."""
    by = SALES.keys[1:]
    found = SALES.read(SALES.merge(states, *by))
    for name, rows in members.items():
        counts = distinct_counts(rows, [F.col(c).alias(f"_{c}") for c in by], {name: name})
        same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by])
        found = found.join(counts, same, "left").drop(*[f"_{c}" for c in by]).fillna(0, [name])
    return found


def percentiles_by_state(states: DataFrame) -> DataFrame:
    """Median payment and 90th percentile of delivery days by state from monthly states."""
    return PAYMENTS.read(PAYMENTS.merge(states, "customer_state"), PERCENTILES)


#: Customers of a month and state, kept whole: who comes again is counted, not estimated.
CUSTOMERS = Rollup(keys=("order_month", "customer_state"), members={"customers": "customer_unique_id"})


def retention(customers: DataFrame) -> DataFrame:
    """Customers by month and state, and how many of them bought in the next month too."""
    before = F.add_months("order_month", -1)
    return members_kept(customers, "order_month", ["customer_state"], "customers", before, "returning")
