"""A consistent set of raw CSV files derived from the star tables, for timing and testing the batch run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from merchlens.sources.raw_csv import RawFolder
from merchlens.sources.schemas import RAW_COLUMNS
from merchlens.sources.star_tables import star_model
from merchlens.sources.states import STATE_CODES


def _stamp(moment, days) -> F.Column:
    shifted = moment + F.make_dt_interval(days.cast("int") if hasattr(days, "cast") else F.lit(days))
    return F.date_format(shifted, "yyyy-MM-dd HH:mm:ss")


def raw_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    model = star_model(spark, folder)
    key = F.col("customer_id")
    codes = F.array(*[F.lit(code) for code in STATE_CODES])
    customers = model.customers.select(
        key,
        key.alias("customer_unique_id"),
        F.lpad((key % 100000).cast("string"), 5, "0").alias("customer_zip_code_prefix"),
        "customer_city",
        F.element_at(codes, (key % len(STATE_CODES) + 1).cast("int")).alias("customer_state"),
    )
    bought, number = F.col("order_purchase_timestamp"), F.col("order_id")
    delivered = F.col("order_status") == "delivered"
    orders = model.order_headers.select(
        "order_id",
        "customer_id",
        "order_status",
        _stamp(bought, 0).alias("order_purchase_timestamp"),
        F.when(number % 97 != 0, _stamp(bought, number % 2)).alias("order_approved_at"),
        F.when(delivered, _stamp(bought, number % 5 + 1)).alias("order_delivered_carrier_date"),
        F.when(delivered, _stamp(bought, number % 30 + 6)).alias("order_delivered_customer_date"),
        _stamp(bought, 25).alias("order_estimated_delivery_date"),
    )
    line = F.row_number().over(Window.partitionBy("order_id").orderBy("product_id", "seller_id", "price"))
    order_items = model.order_items.withColumn("order_item_id", line).withColumn(
        "shipping_limit_date", _stamp(F.col("shipping_limit_date"), 0)
    )
    payments = model.payments.join(model.order_headers.select("order_id"), "order_id", "left_semi").withColumn(
        "payment_installments", F.coalesce("payment_installments", F.lit(0))
    )
    size = F.col("product_weight_g")
    products = model.products.select(
        "product_id",
        F.lower("product_category_name").alias("product_category_name"),
        size.alias("product_name_lenght"),
        size.alias("product_description_lenght"),
        F.lit(1).alias("product_photos_qty"),
        "product_weight_g",
        "product_length_cm",
        "product_height_cm",
        "product_width_cm",
    )
    translation = (
        products.select("product_category_name")
        .where(F.col("product_category_name").isNotNull())
        .distinct()
        .withColumn("product_category_name_english", F.concat(F.lit("english "), "product_category_name"))
    )
    tables = {
        "customers": customers, "orders": orders, "order_items": order_items, "payments": payments,
        "products": products, "category_translation": translation,
    }
    return {name: data.select(*RAW_COLUMNS[name]) for name, data in tables.items()}


def write_raw_files(spark: SparkSession, source: str, target: str) -> RawFolder:
    """Write one folder of CSV part files per dataset."""
    for name, data in raw_tables(spark, source).items():
        data.write.option("header", True).csv(f"{target}/{name}")
    return RawFolder(target, {name: name for name in RAW_COLUMNS}, multiline=False)
