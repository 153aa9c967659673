"""Raw text tables derived from the star tables, with the defects that cleaning and profiling must handle.

Every row of the source tables takes part; keys only decide which defect a row shows.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from merchlens.sources.schemas import RAW_COLUMNS
from merchlens.sources.star_tables import read_table, star_model


def _text(column: Column) -> Column:
    return column.cast("string")


def _stamp(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM-dd HH:mm:ss")


def _days_after(moment: Column, days: Column | int) -> Column:
    count = F.lit(days) if isinstance(days, int) else days.cast("int")
    return moment + F.make_dt_interval(count)


def _repeated(data: DataFrame, twice: Column) -> DataFrame:
    """The same rows, some of them as two identical copies."""
    copies = F.sequence(F.lit(1), F.when(twice, 2).otherwise(1))
    return data.withColumn("_copy", F.explode(copies)).drop("_copy")


def _customers(spark: SparkSession, folder: str) -> DataFrame:
    key, segment, nation = F.col("c_custkey"), F.col("c_mktsegment"), F.col("n_name")
    customers = (
        read_table(spark, folder, "customer")
        .join(read_table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            "c_custkey",
            F.when(key % 101 != 7, F.concat(F.lit("C"), _text(key))).alias("customer_id"),
            F.concat(F.lit("U"), _text(F.floor(key / 2))).alias("customer_unique_id"),
            F.when(key % 5 == 0, _text(key % 10000))
            .otherwise(F.lpad(_text(key % 100000), 5, "0"))
            .alias("customer_zip_code_prefix"),
            F.when(key % 2 == 0, F.concat(F.lit("  "), F.upper(segment), F.lit("  TOWN ")))
            .otherwise(F.concat(F.lower(segment), F.lit(" town")))
            .alias("customer_city"),
            F.when(key % 3 == 0, F.concat(F.lit(" "), F.lower(nation))).otherwise(nation).alias("customer_state"),
        )
    )
    return _repeated(customers, key % 10 == 0)


def _orders(spark: SparkSession, folder: str) -> DataFrame:
    status, bought = F.col("order_status"), F.col("order_purchase_timestamp")
    number = F.col("order_id")
    orders = star_model(spark, folder).order_headers.select(
        number.alias("o_orderkey"),
        F.when(number % 499 != 3, F.concat(F.lit("O"), _text(number))).alias("order_id"),
        F.concat(F.lit("C"), _text(F.col("customer_id"))).alias("customer_id"),
        F.when(number % 4 == 0, F.concat(F.lit(" "), F.upper(status), F.lit(" "))).otherwise(status).alias(
            "order_status"
        ),
        F.when(number % 211 == 5, "not a date").otherwise(_stamp(bought)).alias("order_purchase_timestamp"),
        F.when(number % 97 != 0, _stamp(_days_after(bought, number % 3))).alias("order_approved_at"),
        _stamp(_days_after(bought, number % 7 - 1)).alias("order_delivered_carrier_date"),
        F.when(number % 13 != 0, _stamp(_days_after(bought, number % 11 - 1))).alias("order_delivered_customer_date"),
        _stamp(_days_after(bought, 20)).alias("order_estimated_delivery_date"),
    )
    return _repeated(orders, F.col("o_orderkey") % 20 == 0)


def _order_items(spark: SparkSession, folder: str) -> DataFrame:
    price, freight = _text(F.col("price")), _text(F.col("freight_value"))
    sold = F.col("product_id")
    order_items = star_model(spark, folder).order_items.select(
        sold.alias("l_partkey"),
        F.concat(F.lit("O"), _text(F.col("order_id"))).alias("order_id"),
        F.when(sold % 97 == 0, "x").otherwise(_text(F.col("order_item_id"))).alias("order_item_id"),
        F.concat(F.lit("P"), _text(sold)).alias("product_id"),
        F.concat(F.lit("S"), _text(F.col("seller_id"))).alias("seller_id"),
        _stamp(F.col("shipping_limit_date")).alias("shipping_limit_date"),
        F.when(sold % 50 == 0, F.concat(F.lit("-"), price)).when(sold % 53 == 0, "abc")
        # Too small to be seen after rounding, half a cent, and more than the column holds.
        .when(sold % 59 == 1, "-0.004").when(sold % 61 == 1, "0.004").when(sold % 67 == 1, "10.005")
        .when(sold % 71 == 1, "123456789.5").otherwise(price).alias("price"),
        F.when(sold % 7 == 0, "0").when(sold % 73 == 1, "0.004").otherwise(freight).alias("freight_value"),
    )
    return _repeated(order_items, F.col("l_partkey") % 100 == 1)


def _payments(spark: SparkSession, folder: str) -> DataFrame:
    event, payer = F.col("event_id"), F.col("user_id")
    return (
        read_table(spark, folder, "events")
        .where(F.col("event_type") == "purchase")
        .select(
            F.concat(F.lit("O"), _text(event)).alias("order_id"),
            _text(payer % 4 + 1).alias("payment_sequential"),
            F.when(payer % 3 == 0, " Credit_Card").when(payer % 3 == 1, "boleto").otherwise("not_defined").alias(
                "payment_type"
            ),
            _text(payer % 7).alias("payment_installments"),
            F.when(payer % 37 == 1, "-5.00")
            .when(payer % 41 == 2, "0")
            .otherwise(_text(F.col("value").cast("decimal(18,2)")))
            .alias("payment_value"),
        )
    )


def _products(spark: SparkSession, folder: str) -> DataFrame:
    product, brand, size = F.col("p_partkey"), F.col("p_brand"), F.col("p_size")
    return read_table(spark, folder, "part").select(
        F.concat(F.lit("P"), _text(product)).alias("product_id"),
        F.when(product % 41 == 0, F.lit(None))
        .when(product % 5 == 0, F.concat(F.lit(" "), F.upper(brand), F.lit(" ")))
        .otherwise(F.lower(brand))
        .alias("product_category_name"),
        F.concat(_text(size), F.lit(".5")).alias("product_name_lenght"),
        _text(size * 10).alias("product_description_lenght"),
        F.when(product % 61 == 0, "many").otherwise(_text(product % 4)).alias("product_photos_qty"),
        F.when(product % 29 == 0, "0").otherwise(_text(size)).alias("product_weight_g"),
        _text(size).alias("product_length_cm"),
        _text(size).alias("product_height_cm"),
        F.when(product % 31 != 0, _text(size - 1)).alias("product_width_cm"),
    )


def _category_translation(spark: SparkSession, folder: str) -> DataFrame:
    brand = F.col("p_brand")
    return (
        read_table(spark, folder, "part")
        .select(F.lower(brand).alias("product_category_name"))
        .distinct()
        .where(~F.col("product_category_name").isin("brand#13", "brand#7"))
        .select("product_category_name", F.concat(F.lit("English "), "product_category_name").alias("english"))
        .withColumnRenamed("english", "product_category_name_english")
    )


BUILDERS = {
    "customers": _customers,
    "orders": _orders,
    "order_items": _order_items,
    "payments": _payments,
    "products": _products,
    "category_translation": _category_translation,
}


class UntidyTables(Mapping[str, DataFrame]):
    """The raw tables by name, each built when it is first asked for."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self._spark, self._folder, self._built = spark, folder, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = BUILDERS[name](self._spark, self._folder).select(*RAW_COLUMNS[name])
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(BUILDERS)

    def __len__(self) -> int:
        return len(BUILDERS)
