"""Datasets, their columns, keys and types."""

from __future__ import annotations

from pyspark.sql import types as T

# The columns each raw dataset must have (source spelling kept).
RAW_COLUMNS: dict[str, tuple[str, ...]] = {
    "customers": (
        "customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state",
    ),
    "orders": (
        "order_id", "customer_id", "order_status", "order_purchase_timestamp", "order_approved_at",
        "order_delivered_carrier_date", "order_delivered_customer_date", "order_estimated_delivery_date",
    ),
    "order_items": (
        "order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date", "price", "freight_value",
    ),
    "payments": (
        "order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value",
    ),
    "products": (
        "product_id", "product_category_name", "product_name_lenght", "product_description_lenght",
        "product_photos_qty", "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm",
    ),
    "category_translation": ("product_category_name", "product_category_name_english"),
}

# The columns that identify a row.
KEYS: dict[str, tuple[str, ...]] = {
    "customers": ("customer_id",),
    "orders": ("order_id",),
    "order_items": ("order_id", "order_item_id"),
    "payments": ("order_id", "payment_sequential"),
    "products": ("product_id",),
    "category_translation": ("product_category_name",),
}

# File names looked up in the raw folder, as glob patterns; pass your own mapping to override.
RAW_FILES: dict[str, str] = {
    "customers": "*customers_dataset.csv",
    "orders": "*orders_dataset.csv",
    "order_items": "*order_items_dataset.csv",
    "payments": "*order_payments_dataset.csv",
    "products": "*products_dataset.csv",
    "category_translation": "*category_name_translation.csv",
}

# Corrected spellings of two source columns.
COLUMN_SPELLINGS = {
    "product_name_lenght": "product_name_length",
    "product_description_lenght": "product_description_length",
}

LIFECYCLE_COLUMNS = (
    "order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
    "order_delivered_customer_date", "order_estimated_delivery_date",
)
PRODUCT_MEASURES = ("product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm")
PRODUCT_NUMBERS = (
    "product_name_length", "product_description_length", "product_photos_qty", *PRODUCT_MEASURES,
)

# Datasets that are cleaned and published, parents before children.
CLEAN_DATASETS = ("customers", "products", "orders", "order_items", "payments")

AMOUNT = T.DecimalType(10, 2)
MOMENT = T.TimestampNTZType()


def _fields(*columns: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns])


def _text(*names: str) -> list[tuple[str, T.DataType]]:
    return [(name, T.StringType()) for name in names]


CLEAN_SCHEMAS: dict[str, T.StructType] = {
    "customers": _fields(*_text(*RAW_COLUMNS["customers"])),
    "products": _fields(
        *_text("product_id", "product_category_name"),
        *[(name, T.IntegerType()) for name in PRODUCT_NUMBERS],
        *_text("product_category_name_english"),
    ),
    "orders": _fields(
        *_text("order_id", "customer_id", "order_status"),
        *[(name, MOMENT) for name in LIFECYCLE_COLUMNS],
        ("has_invalid_dates", T.BooleanType()),
    ),
    "order_items": _fields(
        *_text("order_id"),
        ("order_item_id", T.IntegerType()),
        *_text("product_id", "seller_id"),
        ("shipping_limit_date", MOMENT),
        ("price", AMOUNT),
        ("freight_value", AMOUNT),
    ),
    "payments": _fields(
        *_text("order_id"),
        ("payment_sequential", T.IntegerType()),
        *_text("payment_type"),
        ("payment_installments", T.IntegerType()),
        ("payment_value", AMOUNT),
    ),
}

# Where rows were read in order, their place: file, first byte of the split, number within it.
ROW_ORDER = "_row_order"
