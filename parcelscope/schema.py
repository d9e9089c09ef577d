"""Declared schemas of the eleven canonical tables.

One ``StructType`` per table is the single source of column types; the raw
zone uses the same column names with every column a string.  The sort key of
each table (its warehouse ``ORDER BY``) is kept next to the schema so that the
load step can cluster files by it.
"""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()
I = T.IntegerType()
D = T.DoubleType()
TS = T.TimestampType()


def _struct(*cols: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in cols])


# Table and column names as the source data spells them
# (``lenght`` included).
SCHEMAS: dict[str, T.StructType] = {
    "orders": _struct(
        ("order_id", S, False),
        ("customer_id", S, False),
        ("order_status", S, False),
        ("order_purchase_timestamp", TS, True),
        ("order_approved_at", TS, True),
        ("order_delivered_carrier_date", TS, True),
        ("order_delivered_customer_date", TS, True),
        ("order_estimated_delivery_date", TS, True),
    ),
    "order_items": _struct(
        ("order_id", S, False),
        ("order_item_id", I, False),
        ("product_id", S, False),
        ("seller_id", S, False),
        ("shipping_limit_date", TS, True),
        ("price", D, False),
        ("freight_value", D, False),
    ),
    "sellers": _struct(
        ("seller_id", S, False),
        ("seller_zip_code_prefix", S, False),
        ("seller_city", S, False),
        ("seller_state", S, False),
    ),
    "customers": _struct(
        ("customer_id", S, False),
        ("customer_unique_id", S, False),
        ("customer_zip_code_prefix", S, False),
        ("customer_city", S, False),
        ("customer_state", S, False),
    ),
    "geolocation": _struct(
        ("geolocation_zip_code_prefix", S, False),
        ("geolocation_lat", D, False),
        ("geolocation_lng", D, False),
        ("geolocation_city", S, False),
        ("geolocation_state", S, False),
    ),
    "order_reviews": _struct(
        ("review_id", S, False),
        ("order_id", S, False),
        ("review_score", I, True),
        ("review_comment_title", S, True),
        ("review_comment_message", S, True),
        ("review_creation_date", TS, True),
        ("review_answer_timestamp", TS, True),
    ),
    "products": _struct(
        ("product_id", S, False),
        ("product_category_name", S, True),
        ("product_name_lenght", I, True),
        ("product_description_lenght", I, True),
        ("product_photos_qty", I, True),
        ("product_weight_g", D, True),
        ("product_length_cm", D, True),
        ("product_height_cm", D, True),
        ("product_width_cm", D, True),
    ),
    "category_translation": _struct(
        ("product_category_name", S, False),
        ("product_category_name_english", S, False),
    ),
    "order_payments": _struct(
        ("order_id", S, False),
        ("payment_sequential", I, False),
        ("payment_type", S, False),
        ("payment_installments", I, False),
        ("payment_value", D, False),
    ),
    "closed_deals": _struct(
        ("mql_id", S, False),
        ("seller_id", S, False),
        ("sdr_id", S, True),
        ("sr_id", S, True),
        ("won_date", S, True),
        ("business_segment", S, True),
        ("lead_type", S, True),
        ("lead_behaviour_profile", S, True),
        ("has_company", S, True),
        ("has_gtin", S, True),
        ("average_stock", S, True),
        ("business_type", S, True),
        ("declared_product_catalog_size", D, True),
        ("declared_monthly_revenue", D, True),
    ),
    "mql": _struct(
        ("mql_id", S, False),
        ("first_contact_date", S, True),
        ("landing_page_id", S, True),
        ("origin", S, True),
    ),
}

# The warehouse sort key of every table.
SORT_KEYS: dict[str, tuple[str, ...]] = {
    "orders": ("order_id",),
    "order_items": ("order_id", "order_item_id"),
    "sellers": ("seller_id",),
    "customers": ("customer_id",),
    "geolocation": ("geolocation_zip_code_prefix",),
    "order_reviews": ("review_id",),
    "products": ("product_id",),
    "category_translation": ("product_category_name",),
    "order_payments": ("order_id", "payment_sequential"),
    "closed_deals": ("mql_id",),
    "mql": ("mql_id",),
}

# Tables with rules of their own for what is rejected (the others only reject what cannot be typed).
RULED_TABLES: tuple[str, ...] = ("orders", "geolocation")

# The columns of closed deals whose values are counted.
DEAL_VALUE_COLUMNS: tuple[str, ...] = (
    "business_segment", "lead_type", "lead_behaviour_profile", "has_company", "has_gtin", "average_stock", "business_type",
    "declared_product_catalog_size")

# Order in which the pipeline visits the tables.
TABLES: tuple[str, ...] = tuple(SCHEMAS)

# Orders are rejected with this extra column.
REJECT_REASON = "reject_reason"


def raw_schema(name: str) -> T.StructType:
    """All-string variant of a table schema (the raw zone)."""
    return T.StructType([T.StructField(f.name, S, True) for f in SCHEMAS[name].fields])
