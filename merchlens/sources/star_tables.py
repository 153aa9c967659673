"""The sales model over generic star-schema tables (customer, orders, lineitem, part, nation, region, events)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from merchlens.functions.dates import before
from merchlens.functions.metrics import Calendar
from merchlens.plans.model import CATEGORY, SalesModel

# Reporting periods that fit the generic tables' date range.
STAR_CALENDAR = Calendar(
    trend_start="1996-01-01",
    trend_end="2001-01-01",
    prior_start="2000-01-01",
    recent_start="2000-07-01",
    recent_end="2001-01-01",
    base_year=1999,
    compare_year=2000,
)

PROMISED_DAYS = 1095

# Declared, so that reading a table starts no job to infer its schema.
STAR_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
        "l_shipdate timestamp_ntz"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    ),
}


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(STAR_SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def star_model(spark: SparkSession, folder: str) -> SalesModel:
    """Logical tables derived from the star tables, all lazy."""
    customer = read_table(spark, folder, "customer")
    nation = read_table(spark, folder, "nation")
    region = read_table(spark, folder, "region")
    lineitem = read_table(spark, folder, "lineitem")

    states = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_name").alias("state_code"),
        F.col("n_name").alias("state_name"),
        F.col("r_name").alias("macro_region"),
    )
    custkey, partkey, event = F.col("c_custkey"), F.col("p_partkey"), F.col("event_id")
    customers = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        custkey.alias("customer_id"),
        custkey.alias("customer_unique_id"),
        F.when(custkey % 200 != 0, F.lpad((custkey % 100000).cast("string"), 5, "0"))
        .otherwise((custkey % 1000).cast("string"))
        .alias("customer_zip_code_prefix"),
        F.lower("c_mktsegment").alias("customer_city"),
        F.col("n_name").alias("customer_state"),
    )
    size = F.col("p_size")
    products = read_table(spark, folder, "part").select(
        partkey.alias("product_id"),
        F.when(partkey % 41 != 0, F.col("p_brand")).alias("product_category_name"),
        F.when(partkey % 53 != 0, size).alias("product_weight_g"),
        size.alias("product_length_cm"),
        size.alias("product_height_cm"),
        F.when(partkey % 59 != 0, size).alias("product_width_cm"),
        F.col("p_type").alias(CATEGORY),
    )
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    tax = F.col("l_tax").cast("decimal(4,2)")
    order_items = lineitem.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        F.col("l_shipdate").alias("shipping_limit_date"),
        price.alias("price"),
        F.round(price * tax, 2).cast("decimal(18,2)").alias("freight_value"),
    )
    # A purchase event pays the order of the same number.
    kinds = F.array(*[F.lit(k) for k in ("credit_card", "boleto", "voucher", "debit_card", "not_defined")])
    payer = F.col("user_id")
    payments = (
        read_table(spark, folder, "events")
        .where(F.col("event_type") == "purchase")
        .select(
            event.alias("order_id"),
            (payer % 4 + 1).cast("int").alias("payment_sequential"),
            F.element_at(kinds, (payer % 5 + 1).cast("int")).alias("payment_type"),
            F.when(payer % 7 != 0, (payer % 7).cast("int")).alias("payment_installments"),
            F.col("value").cast("decimal(18,2)").alias("payment_value"),
        )
    )
    headers = _headers(read_table(spark, folder, "orders"))
    deliveries = _deliveries(headers, lineitem)
    return SalesModel(
        customers=customers,
        orders=_full_lifecycle(deliveries, lineitem),
        order_items=order_items,
        products=products,
        payments=payments,
        states=states,
        calendar=STAR_CALENDAR,
        headers=headers,
        deliveries=deliveries,
    )


def _headers(orders: DataFrame) -> DataFrame:
    priority = F.col("o_orderpriority")
    status = (
        F.when(F.col("o_orderstatus").isin("F", "O"), "delivered")
        .when(priority == "1-URGENT", "canceled")
        .when(priority == "5-LOW", "unavailable")
        .when(priority == "2-HIGH", "shipped")
        .when(priority == "3-MEDIUM", "processing")
        .otherwise("invoiced")
    )
    return orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        status.alias("order_status"),
        F.col("o_orderdate").alias("order_purchase_timestamp"),
    )


def _deliveries(headers: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Delivered on the last ship date; one row per order before the join."""
    last_shipped = lineitem.groupBy(F.col("l_orderkey").alias("order_id")).agg(
        F.max("l_shipdate").alias("order_delivered_customer_date")
    )
    purchased = F.col("order_purchase_timestamp")
    return (
        headers.join(last_shipped, "order_id", "left")
        .withColumn("order_estimated_delivery_date", purchased + F.make_dt_interval(F.lit(PROMISED_DAYS)))
        .withColumn("has_invalid_dates", before("order_delivered_customer_date", "order_purchase_timestamp"))
    )


def _full_lifecycle(deliveries: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Adds approval and carrier hand-over: the first ship date not before the purchase.

    Ship dates are reduced to distinct (order, date) pairs before they meet the orders, so an order with very
    many lines costs no more than its number of dates.
    """
    ship_days = lineitem.select(
        F.col("l_orderkey").alias("order_id"), F.col("l_shipdate").alias("shipped")
    ).distinct()
    purchased = F.col("order_purchase_timestamp")
    handed_over = (
        ship_days.join(deliveries.select("order_id", "order_purchase_timestamp"), "order_id")
        .where(F.col("shipped") >= purchased)
        .groupBy("order_id")
        .agg(F.min("shipped").alias("order_delivered_carrier_date"))
    )
    approval_days = (F.col("order_id") % 3).cast("int")
    return deliveries.join(handed_over, "order_id", "left").withColumn(
        "order_approved_at",
        F.when(F.col("order_id") % 97 != 0, purchased + F.make_dt_interval(approval_days)),
    )
