"""Star schema: four dimensions and two facts (M1-M6)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.contracts import FREIGHT_TYPE, PRICE_TYPE
from mercato.operators import conform
from mercato.operators.joins import hot_key_table, salted_join

UNCATEGORIZED = "uncategorized"

DIM_CUSTOMERS_COLUMNS = ["customer_id", "customer_unique_id", "customer_zip_code_prefix",
                         "customer_city", "customer_state"]
DIM_PRODUCTS_COLUMNS = ["product_id", "product_category_name", "product_category_name_english",
                        "product_name_length", "product_description_length",
                        "product_photos_qty", "product_weight_g", "product_length_cm",
                        "product_height_cm", "product_width_cm"]
DIM_SELLERS_COLUMNS = ["seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"]
FACT_ORDERS_COLUMNS = [
    "order_id", "customer_id", "customer_state", "customer_city", "order_status",
    "order_purchase_timestamp", "purchase_date", "order_approved_at",
    "order_delivered_carrier_date", "order_delivered_customer_date",
    "order_estimated_delivery_date", "total_payment", "total_items", "total_freight",
    "total_items_freight", "delivery_days", "estimated_delivery_days", "flag_delayed",
    "delay_days", "flag_financial_inconsistency", "flag_delivered_before_purchase",
    "flag_estimated_before_purchase", "flag_future_purchase",
]
FACT_ORDER_ITEMS_COLUMNS = ["order_id", "order_item_id", "product_id", "seller_id",
                            "seller_state", "product_category_name_english",
                            "shipping_limit_date", "price", "freight_value", "total_value"]


def dim_customers(customers: DataFrame) -> DataFrame:
    cleaned = conform.customer_rules(customers).select(*DIM_CUSTOMERS_COLUMNS)
    return conform.dedup_by_key(cleaned, ["customer_id"])


def dim_products(products: DataFrame, category_translation: DataFrame) -> DataFrame:
    """Products with the English category; missing translation -> ``uncategorized``.

    The translation table is a lookup of categories; Catalyst/AQE broadcast it
    when its measured size is under the broadcast threshold.
    """
    joined = products.join(category_translation, "product_category_name", "left").select(
        *[
            F.coalesce(F.col(c), F.lit(UNCATEGORIZED)).alias(c)
            if c == "product_category_name_english" else F.col(c)
            for c in DIM_PRODUCTS_COLUMNS
        ]
    )
    return conform.dedup_by_key(joined, ["product_id"])


def dim_sellers(sellers: DataFrame) -> DataFrame:
    return conform.dedup_by_key(sellers.select(*DIM_SELLERS_COLUMNS), ["seller_id"])


def dim_dates(orders: DataFrame) -> DataFrame:
    """Calendar attributes of every date that has an order (not a full calendar)."""
    dates = (
        orders.select(F.to_date("order_purchase_timestamp").alias("date"))
        .where(F.col("date").isNotNull())
        .distinct()
    )
    dow = F.dayofweek("date")
    return dates.select(
        "date",
        F.year("date").alias("year"),
        F.month("date").alias("month"),
        F.dayofmonth("date").alias("day"),
        F.weekofyear("date").alias("week"),
        F.quarter("date").alias("quarter"),
        dow.alias("day_of_week"),
        dow.isin(1, 7).alias("is_weekend"),
    )


def fact_orders(orders: DataFrame, customers: DataFrame, payments: DataFrame,
                items: DataFrame) -> DataFrame:
    """One row per order: date flags, dedup, totals, financial flag, delivery measures.

    Joins the *raw* customers for state and city, as the source pipeline does
    (so ``unknown`` never appears here and a missing customer leaves nulls).
    """
    flagged = conform.order_date_flags(orders)
    flagged = conform.dedup_orders(flagged)
    items = conform.dedup_items(items)
    with_totals = conform.financial_flag(flagged, payments, items)
    measured = conform.delivery_measures(with_totals)
    fact = measured.join(
        customers.select("customer_id", "customer_state", "customer_city"),
        "customer_id",
        "left",
    )
    return fact.withColumn("purchase_date", F.to_date("order_purchase_timestamp")) \
        .select(*FACT_ORDERS_COLUMNS)


def fact_order_items(items: DataFrame, dim_products_df: DataFrame,
                     dim_sellers_df: DataFrame) -> DataFrame:
    """Item rows (not deduplicated) with category, seller state and item total.

    The two lookups come out of dedup windows, which AQE's skew split does not
    cover; a product or seller holding a large share of the items is salted
    (one frequent-items pass finds both kinds of hot keys).
    """
    hot = hot_key_table(items, ["product_id", "seller_id"])
    fact = salted_join(items, dim_products_df.select("product_id", "product_category_name_english"),
                       "product_id", "left", salts=hot)
    fact = salted_join(fact, dim_sellers_df.select("seller_id", "seller_state"), "seller_id",
                       "left", salts=hot)
    # Money is exact decimal whatever the silver layout (CSV-typed silver carries doubles).
    price = F.col("price").cast(PRICE_TYPE)
    freight = F.col("freight_value").cast(FREIGHT_TYPE)
    return fact.withColumns({"price": price, "freight_value": freight,
                             "total_value": price + freight}) \
        .select(*FACT_ORDER_ITEMS_COLUMNS)
