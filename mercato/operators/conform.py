"""Conformance rules applied between silver and gold.

Keyed dedup, the three date flags, the financial consistency flag with its two
per-order pre-aggregates, customer cleaning and the delivery measures.

Scale notes
* Keyed dedup is ``row_number() == 1`` over a *total* order; Spark plans it
  with a partial ``WindowGroupLimit`` before the shuffle, so a key repeated in
  a third of the rows is cut to one row per map task before it moves.
* Payments and items are aggregated per order *before* the joins (partial
  aggregation map-side); the joins then meet at most one row per order on each
  side, so they cannot fan out or skew.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercato.contracts import (
    DEDUP_ORDER,
    FREIGHT_TYPE,
    INGESTION_COLUMNS,
    KEYS,
    PAYMENT_TYPE,
    PRICE_TYPE,
)
from mercato.functions.scalars import coalesce_false

DATE_FLAGS = ("flag_delivered_before_purchase", "flag_estimated_before_purchase",
              "flag_future_purchase")


# ---------------------------------------------------------------- Q11 dedup
def dedup_by_key(df: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """Keep one row per ``keys``: the first by ``order`` then every other column.

    Nulls sort first.  Because the order is total, the kept row does not depend
    on partitioning or on task scheduling (unlike ``dropDuplicates(subset)``).
    """
    order = list(order or [])
    # Ingestion metadata is not part of a row's content: leaving it out of the
    # tie-break keeps the kept row's contract columns the same and lets the
    # scan skip those columns.
    rest = [c for c in df.columns
            if c not in keys and c not in order and c not in INGESTION_COLUMNS]
    sort_cols = [F.col(c).asc_nulls_first() for c in order + rest]
    w = Window.partitionBy(*keys).orderBy(*sort_cols) if sort_cols else \
        Window.partitionBy(*keys).orderBy(*[F.col(k) for k in keys])
    return (
        df.withColumn("__rn", F.row_number().over(w))
        .where(F.col("__rn") == 1)
        .drop("__rn")
    )


def dedup_orders(orders: DataFrame) -> DataFrame:
    return dedup_by_key(orders, KEYS["orders"],
                        [c for c in DEDUP_ORDER["orders"] if c in orders.columns])


def dedup_items(items: DataFrame) -> DataFrame:
    return dedup_by_key(items, KEYS["order_items"],
                        [c for c in DEDUP_ORDER["order_items"] if c in items.columns])


# ---------------------------------------------------------------- Q12 / Q13
def order_date_flags(orders: DataFrame) -> DataFrame:
    """Three booleans; a comparison with a null operand yields False."""
    purchase = F.col("order_purchase_timestamp")
    return orders.withColumns({
        "flag_delivered_before_purchase":
            coalesce_false(F.col("order_delivered_customer_date") < purchase),
        "flag_estimated_before_purchase":
            coalesce_false(F.col("order_estimated_delivery_date") < purchase),
        "flag_future_purchase": coalesce_false(purchase > F.current_timestamp()),
    })


def any_date_flag() -> Column:
    return F.col(DATE_FLAGS[0]) | F.col(DATE_FLAGS[1]) | F.col(DATE_FLAGS[2])


def invalid_date_count(flagged_orders: DataFrame) -> DataFrame:
    """One row: orders with at least one date flag, and all orders."""
    return flagged_orders.agg(
        F.count_if(any_date_flag()).alias("invalid_dates"),
        F.count(F.lit(1)).alias("total_orders"),
    )


# ---------------------------------------------------------------- A1 / A2 / Q14
def payments_per_order(payments: DataFrame) -> DataFrame:
    """Sum of non-negative payments per order (decimal, exact)."""
    value = F.col("payment_value").cast(PAYMENT_TYPE)
    return (
        payments.where(value >= 0)
        .groupBy("order_id")
        .agg(F.sum(value).alias("total_payment"))
    )


def items_per_order(items: DataFrame) -> DataFrame:
    """Price, freight and their sum per order over non-negative item rows."""
    price = F.col("price").cast(PRICE_TYPE)
    freight = F.col("freight_value").cast(FREIGHT_TYPE)
    return (
        items.where((price >= 0) & (freight >= 0))
        .groupBy("order_id")
        .agg(F.sum(price).alias("total_items"), F.sum(freight).alias("total_freight"))
        .withColumn("total_items_freight", F.col("total_items") + F.col("total_freight"))
    )


def financial_flag(orders: DataFrame, payments: DataFrame, items: DataFrame) -> DataFrame:
    """Orders with per-order totals and ``flag_financial_inconsistency``.

    The flag is True when the totals differ at two decimals and False when
    either side is missing.
    """
    out = (
        orders.join(payments_per_order(payments), "order_id", "left")
        .join(items_per_order(items), "order_id", "left")
    )
    return out.withColumn(
        "flag_financial_inconsistency",
        coalesce_false(F.round("total_payment", 2) != F.round("total_items_freight", 2)),
    )


# ---------------------------------------------------------------- Q15
ZIP_MIN, ZIP_MAX = 1000, 99999
UNKNOWN = "unknown"


def customer_rules(customers: DataFrame) -> DataFrame:
    zip_col = F.col("customer_zip_code_prefix")
    return customers.withColumns({
        "customer_zip_code_prefix": F.when(zip_col.between(ZIP_MIN, ZIP_MAX), zip_col),
        "customer_city": F.coalesce(F.col("customer_city"), F.lit(UNKNOWN)),
        "customer_state": F.coalesce(F.col("customer_state"), F.lit(UNKNOWN)),
    })


def invalid_zip_count(cleaned_customers: DataFrame) -> DataFrame:
    return cleaned_customers.agg(
        F.count_if(F.col("customer_zip_code_prefix").isNull()).alias("invalid_zip"),
        F.count(F.lit(1)).alias("total_customers"),
    )


# ---------------------------------------------------------------- Q16
def delivery_measures(orders: DataFrame) -> DataFrame:
    """Calendar-day measures; ``flag_delayed`` compares instants."""
    delivered = F.col("order_delivered_customer_date")
    estimate = F.col("order_estimated_delivery_date")
    purchase = F.col("order_purchase_timestamp")
    delayed = coalesce_false(delivered > estimate)
    return orders.withColumns({
        "delivery_days": F.datediff(delivered, purchase),
        "estimated_delivery_days": F.datediff(estimate, purchase),
        "flag_delayed": delayed,
        "delay_days": F.when(delayed, F.datediff(delivered, estimate)).otherwise(F.lit(0)),
    })
