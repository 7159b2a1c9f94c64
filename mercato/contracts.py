"""Silver data contracts: schemas, strict (non-null) columns, keys, renames.

The contract is metadata only.  ``nullable`` in a schema documents intent; the
rows are filtered by ``STRICT`` (see ``operators.quality.drop_strict_nulls``).
"""

from __future__ import annotations

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

S, I, D, T = StringType(), IntegerType(), DoubleType(), TimestampType()


def _schema(*fields: tuple[str, object, bool]) -> StructType:
    return StructType([StructField(n, t, nullable) for n, t, nullable in fields])


# --- Fixed values: the nine silver schemas (column, type, nullable), in order.
SCHEMAS: dict[str, StructType] = {
    "orders": _schema(
        ("order_id", S, False),
        ("customer_id", S, False),
        ("order_status", S, False),
        ("order_purchase_timestamp", T, False),
        ("order_approved_at", T, True),
        ("order_delivered_carrier_date", T, True),
        ("order_delivered_customer_date", T, True),
        ("order_estimated_delivery_date", T, True),
    ),
    "customers": _schema(
        ("customer_id", S, False),
        ("customer_unique_id", S, False),
        ("customer_zip_code_prefix", I, False),
        ("customer_city", S, False),
        ("customer_state", S, False),
    ),
    "products": _schema(
        ("product_id", S, False),
        ("product_category_name", S, True),
        ("product_name_length", I, True),
        ("product_description_length", I, True),
        ("product_photos_qty", I, True),
        ("product_weight_g", I, True),
        ("product_length_cm", I, True),
        ("product_height_cm", I, True),
        ("product_width_cm", I, True),
    ),
    "order_items": _schema(
        ("order_id", S, False),
        ("order_item_id", I, False),
        ("product_id", S, False),
        ("seller_id", S, False),
        ("shipping_limit_date", T, True),
        ("price", D, False),
        ("freight_value", D, False),
    ),
    "order_payments": _schema(
        ("order_id", S, False),
        ("payment_sequential", I, False),
        ("payment_type", S, False),
        ("payment_installments", I, False),
        ("payment_value", D, False),
    ),
    "order_reviews": _schema(
        ("review_id", S, False),
        ("order_id", S, False),
        ("review_score", I, False),
        ("review_comment_title", S, True),
        ("review_comment_message", S, True),
        ("review_creation_date", T, True),
        ("review_answer_timestamp", T, True),
    ),
    "sellers": _schema(
        ("seller_id", S, False),
        ("seller_zip_code_prefix", I, False),
        ("seller_city", S, False),
        ("seller_state", S, False),
    ),
    "geolocation": _schema(
        ("geolocation_zip_code_prefix", I, False),
        ("geolocation_lat", D, False),
        ("geolocation_lng", D, False),
        ("geolocation_city", S, False),
        ("geolocation_state", S, False),
    ),
    "category_translation": _schema(
        ("product_category_name", S, False),
        ("product_category_name_english", S, False),
    ),
}

# --- Fixed values: columns that must not be null, per dataset.
STRICT: dict[str, list[str]] = {
    "orders": ["order_id", "customer_id", "order_status", "order_purchase_timestamp"],
    "customers": ["customer_id", "customer_unique_id", "customer_zip_code_prefix",
                  "customer_city", "customer_state"],
    "products": ["product_id"],
    "order_items": ["order_id", "order_item_id", "product_id", "seller_id", "price",
                    "freight_value"],
    "order_payments": ["order_id", "payment_sequential", "payment_type",
                       "payment_installments", "payment_value"],
    "order_reviews": ["review_id", "order_id", "review_score"],
    "sellers": ["seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"],
    "geolocation": ["geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng",
                    "geolocation_city", "geolocation_state"],
    "category_translation": ["product_category_name", "product_category_name_english"],
}

# --- Fixed values: misspelt raw column names and their contract names.
RENAMES: dict[str, dict[str, str]] = {
    "products": {
        "product_name_lenght": "product_name_length",
        "product_description_lenght": "product_description_length",
    },
}

# Columns added at ingestion; exempt from the contract's "extra column" warning.
INGESTION_COLUMNS = ("ingestion_date", "ingestion_year", "ingestion_month")

# Logical keys used by keyed deduplication and dimension builders.
KEYS: dict[str, list[str]] = {
    "orders": ["order_id"],
    "order_items": ["order_id", "order_item_id"],
    "customers": ["customer_id"],
    "products": ["product_id"],
    "sellers": ["seller_id"],
}

# Total tie-break order used when one row per key is kept (keyed dedup).  A
# total order makes the kept row independent of the physical layout.
DEDUP_ORDER: dict[str, list[str]] = {
    "orders": ["customer_id", "order_status", "order_purchase_timestamp",
               "order_approved_at", "order_delivered_carrier_date",
               "order_delivered_customer_date", "order_estimated_delivery_date"],
    "order_items": ["product_id", "seller_id", "shipping_limit_date", "price",
                    "freight_value"],
}

# Money is summed exactly: prices and payments at 2 decimals; freight and the
# values derived from it at 4.
PRICE_TYPE = "decimal(18,2)"
FREIGHT_TYPE = "decimal(18,4)"
PAYMENT_TYPE = "decimal(18,4)"
