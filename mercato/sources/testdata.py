"""Canonical silver tables derived from the driver's TPC-H-like tables.

The driver ships ``region nation customer supplier part orders lineitem
events`` as Parquet.  This module maps them onto the nine silver datasets of
``mercato.contracts`` (ids stay bigint, money is decimal).  The same mapping is
written as SQL in ``mercato.plans.oracle`` so both engines start from
identical silver rows.

Scale notes: every mapping is a narrow projection of one scan except
``orders`` (one partial aggregate of lineitem per order, then an equi-join on
the order key) and the two lookups of ``nation``/``region``: fixed 25/5-row TPC-H tables whose
file size is known at planning time, so Catalyst broadcasts them by its own
size check.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.contracts import FREIGHT_TYPE, PAYMENT_TYPE, PRICE_TYPE

# --- Fixed values: order status letter -> canonical status.
STATUS_BY_LETTER = {"F": "delivered", "P": "canceled", "O": "shipped"}
# Category spelled in part.p_type that has no English translation.
UNTRANSLATED_CATEGORY = "ECONOMY"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _status(col: str) -> F.Column:
    expr = None
    for letter, status in STATUS_BY_LETTER.items():
        expr = (F.when(F.col(col) == letter, status) if expr is None
                else expr.when(F.col(col) == letter, status))
    return expr


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    ship = (
        read_table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.min("l_shipdate").alias("first_ship"), F.max("l_shipdate").alias("last_ship"))
    )
    status = _status("o_orderstatus")
    return o.join(ship, "o_orderkey", "left").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        status.alias("order_status"),
        F.col("o_orderdate").alias("order_purchase_timestamp"),
        F.timestamp_add("DAY", F.lit(1), "o_orderdate").alias("order_approved_at"),
        F.col("first_ship").alias("order_delivered_carrier_date"),
        F.when(status == "delivered", F.col("last_ship")).alias("order_delivered_customer_date"),
        F.timestamp_add("DAY", F.col("o_orderkey") % 90 - 5, "o_orderdate")
        .alias("order_estimated_delivery_date"),
    )


def _price() -> F.Column:
    return F.col("l_extendedprice").cast(PRICE_TYPE)


def _freight() -> F.Column:
    return (_price() * F.col("l_tax")).cast(FREIGHT_TYPE)


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        F.col("l_shipdate").alias("shipping_limit_date"),
        _price().alias("price"),
        _freight().alias("freight_value"),
    )


def order_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("payment_sequential"),
        F.col("l_returnflag").alias("payment_type"),
        F.lit(1).alias("payment_installments"),
        (_price() + _freight()).cast(PAYMENT_TYPE).alias("payment_value"),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return c.join(n, c.c_nationkey == n.n_nationkey, "inner").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_custkey").alias("customer_unique_id"),
        ((F.col("c_custkey") * 37) % 110000).cast("int").alias("customer_zip_code_prefix"),
        F.when(F.col("c_custkey") % 50 != 0, F.col("c_mktsegment")).alias("customer_city"),
        F.col("n_name").alias("customer_state"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part")
    size = F.col("p_size").cast("int")
    return p.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_type").alias("product_category_name"),
        F.length("p_name").alias("product_name_length"),
        F.length("p_brand").alias("product_description_length"),
        (F.col("p_partkey") % 5).cast("int").alias("product_photos_qty"),
        size.alias("product_weight_g"),
        size.alias("product_length_cm"),
        size.alias("product_height_cm"),
        size.alias("product_width_cm"),
    )


def category_translation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        read_table(spark, sf_dir, "part")
        .select(F.col("p_type").alias("product_category_name"))
        .where(F.col("product_category_name") != UNTRANSLATED_CATEGORY)
        .distinct()
        .select("product_category_name",
                F.lower("product_category_name").alias("product_category_name_english"))
    )


def sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read_table(spark, sf_dir, "supplier")
    n = read_table(spark, sf_dir, "nation")
    r = read_table(spark, sf_dir, "region")
    geo = n.join(r, n.n_regionkey == r.r_regionkey, "inner").select("n_nationkey", "n_name", "r_name")
    return s.join(geo, s.s_nationkey == geo.n_nationkey, "inner").select(
        F.col("s_suppkey").alias("seller_id"),
        ((F.col("s_suppkey") * 37) % 110000).cast("int").alias("seller_zip_code_prefix"),
        F.col("r_name").alias("seller_city"),
        F.col("n_name").alias("seller_state"),
    )


def order_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").alias("review_id"),
        (F.col("event_id") * 2).alias("order_id"),
        (F.floor("value") % 5 + 1).cast("int").alias("review_score"),
        F.lit(None).cast("string").alias("review_comment_title"),
        F.lit(None).cast("string").alias("review_comment_message"),
        F.col("ts").alias("review_creation_date"),
        F.lit(None).cast(e.schema["ts"].dataType).alias("review_answer_timestamp"),
    )


SILVER_BUILDERS = {
    "orders": orders,
    "order_items": order_items,
    "order_payments": order_payments,
    "customers": customers,
    "products": products,
    "category_translation": category_translation,
    "sellers": sellers,
    "order_reviews": order_reviews,
}


def load_silver(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All canonical silver DataFrames (lazy; nothing is read until an action)."""
    return {name: build(spark, sf_dir) for name, build in SILVER_BUILDERS.items()}
