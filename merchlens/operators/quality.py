"""Data quality of the published tables: 36 checks and their roll-up."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchlens.functions.numbers import percent
from merchlens.operators import keys as k
from merchlens.operators import rules as r
from merchlens.operators.rules import CRITICAL, INFO, WARNING, Rule
from merchlens.operators.validation import ORDER_STATUSES, PAYMENT_TYPES, ZIP_PATTERN
from merchlens.sources.schemas import PRODUCT_MEASURES

PURCHASED, APPROVED = "order_purchase_timestamp", "order_approved_at"
HANDED_OVER, RECEIVED = "order_delivered_carrier_date", "order_delivered_customer_date"
PROMISED = "order_estimated_delivery_date"


def quality_scopes(data: Mapping[str, DataFrame], states: DataFrame, profiles: Mapping[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """What the checks are measured on: each table is read once for its own checks, and once for its keys unless the
    profiles of these were taken before.
    """
    last_purchase = data["orders"].agg(F.max(PURCHASED).alias("last_purchase"))
    known = states.select(F.col("state_code").alias("customer_state"), F.lit(True).alias("known_state")).distinct()
    folded = F.lower(F.trim("product_category_name"))
    return {
        "customers": data["customers"].join(known, "customer_state", "left"),
        "orders": data["orders"],
        "order_items": data["order_items"].crossJoin(F.broadcast(last_purchase)),
        "payments": data["payments"],
        "products": data["products"],
        **(profiles or k.key_profiles(data)),
        # More than one spelling exactly when the smallest and the largest differ.
        "category_names": data["products"]
        .groupBy(folded.alias("folded"))
        .agg(
            r.rows().alias("n"),
            F.min("product_category_name").alias("first_spelling"),
            F.max("product_category_name").alias("last_spelling"),
        ),
    }


def quality_rules(
    statuses: Sequence[str] = ORDER_STATUSES, payment_types: Sequence[str] = PAYMENT_TYPES
) -> list[Rule]:
    """All 36 checks by category."""
    status = F.col("order_status")

    def check(category: str, table: str, name: str, severity: str, count: Column) -> Rule:
        return Rule(name, table, severity, table, count, r.rows(), category)

    def keyed(category: str, table: str, name: str, severity: str, scope: str, count: Column, n: str) -> Rule:
        return Rule(name, table, severity, scope, count, k.rows_of(n), category)

    # Check categories, names and severities.
    absent, twice, invalid = "Missing values", "Duplicate records", "Invalid values"
    dates, orphan, unmatched, mixed = (
        "Invalid dates", "Orphan records", "Unmatched foreign keys", "Inconsistent categories",
    )
    undated = F.col(RECEIVED).isNull()
    return [
        check(absent, "orders", "Delivered order without delivery date", WARNING,
              F.count_if((status == "delivered") & undated)),
        check(absent, "orders", "No delivery date (order not delivered)", INFO,
              F.count_if((status != "delivered") & undated)),
        check(absent, "orders", "No approval date", INFO, r.missing(APPROVED)),
        check(absent, "products", "Product category missing (shown as unknown)", WARNING,
              r.missing("product_category_name")),
        check(absent, "products", "Weight or dimensions missing", INFO, r.missing(*PRODUCT_MEASURES)),
        check(absent, "payments", "Installments missing (invalid 0 in source)", WARNING,
              r.missing("payment_installments")),
        keyed(twice, "customers", "Duplicate customer_id", CRITICAL, "customer_keys",
              k.extra_rows_beyond_distinct("n_customers"), "n_customers"),
        keyed(twice, "orders", "Duplicate order_id", CRITICAL, "order_keys",
              k.extra_rows_beyond_distinct("n_orders"), "n_orders"),
        keyed(twice, "order_items", "Duplicate order_id + order_item_id", CRITICAL, "item_keys",
              k.extra_rows("n"), "n"),
        keyed(twice, "payments", "Duplicate order_id + payment_sequential", CRITICAL, "payment_keys",
              k.extra_rows("n"), "n"),
        keyed(twice, "products", "Duplicate product_id", CRITICAL, "product_keys",
              k.extra_rows_beyond_distinct("n_products"), "n_products"),
        check(invalid, "order_items", "Negative price", CRITICAL, r.negative("price")),
        check(invalid, "order_items", "Zero price", WARNING, r.equal_to("price", 0)),
        check(invalid, "order_items", "Negative freight", CRITICAL, r.negative("freight_value")),
        check(invalid, "payments", "Negative payment value", CRITICAL, r.negative("payment_value")),
        check(invalid, "payments", "Zero payment value", WARNING, r.equal_to("payment_value", 0)),
        check(invalid, "customers", "Zip code prefix not 5 digits", WARNING,
              F.count_if(~F.col("customer_zip_code_prefix").rlike(ZIP_PATTERN))),
        check(dates, "orders", "Delivered before purchase", CRITICAL, r.recorded_before(RECEIVED, PURCHASED)),
        check(dates, "orders", "Estimated delivery before purchase", CRITICAL,
              r.recorded_before(PROMISED, PURCHASED)),
        check(dates, "orders", "Approved before purchase", WARNING, r.recorded_before(APPROVED, PURCHASED)),
        check(dates, "orders", "Handed to carrier before purchase", WARNING,
              r.recorded_before(HANDED_OVER, PURCHASED)),
        check(dates, "orders", "Delivered to customer before handed to carrier", WARNING,
              r.recorded_before(RECEIVED, HANDED_OVER)),
        check(dates, "order_items", "Shipping limit after last purchase date in data", WARNING,
              F.count_if(F.col("shipping_limit_date") > F.col("last_purchase"))),
        keyed(orphan, "orders", "Order without items", WARNING, "order_keys",
              k.rows_without_match("n_orders", "n_order_items"), "n_orders"),
        keyed(orphan, "orders", "Order without payments", WARNING, "order_keys",
              k.rows_without_match("n_orders", "n_payments"), "n_orders"),
        keyed(orphan, "customers", "Customer without orders", WARNING, "customer_keys",
              k.rows_without_match("n_customers", "n_orders"), "n_customers"),
        keyed(orphan, "products", "Product never ordered", WARNING, "product_keys",
              k.rows_without_match("n_products", "n_order_items"), "n_products"),
        keyed(unmatched, "orders", "customer_id not in customers", CRITICAL, "customer_keys",
              k.unmatched_rows("n_orders", "n_customers"), "n_orders"),
        keyed(unmatched, "order_items", "order_id not in orders", CRITICAL, "order_keys",
              k.unmatched_rows("n_order_items", "n_orders"), "n_order_items"),
        keyed(unmatched, "order_items", "product_id not in products", CRITICAL, "product_keys",
              k.unmatched_rows("n_order_items", "n_products"), "n_order_items"),
        keyed(unmatched, "payments", "order_id not in orders", CRITICAL, "order_keys",
              k.unmatched_rows("n_payments", "n_orders"), "n_payments"),
        check(mixed, "orders", "Unknown order status", WARNING, r.outside("order_status", statuses)),
        check(mixed, "orders", "Canceled order with a delivery date", WARNING,
              F.count_if((status == "canceled") & ~undated)),
        check(mixed, "payments", "Payment type not_defined or unknown", WARNING,
              r.outside("payment_type", payment_types)),
        check(mixed, "customers", "State code not a Brazilian state", WARNING, r.missing("known_state")),
        Rule("Category name variants differing only by case/spacing", "products", WARNING, "category_names",
             F.count_if(F.col("first_spelling") < F.col("last_spelling")), F.sum("n"), mixed),
    ]


def data_quality_summary(
    data: Mapping[str, DataFrame], states: DataFrame, profiles: Mapping[str, DataFrame] | None = None, **domains: Sequence[str]
) -> DataFrame:
    """One row per check with its share of the table and its status."""
    return (
        r.evaluate(quality_rules(**domains), quality_scopes(data, states, profiles))
        .select(
            F.col("category").alias("check_category"),
            F.col("dataset").alias("table_name"),
            F.col("check").alias("check_name"),
            "severity",
            "record_count",
            "total_records",
            percent(F.col("record_count"), F.col("total_records")).alias("pct_of_records"),
            r.status_for(F.col("record_count"), F.col("severity")).alias("status"),
        )
        .orderBy("check_category", "table_name", "check_name")
    )


def data_quality_by_category(summary: DataFrame) -> DataFrame:
    """Checks per category and outcome; informative checks do not count as affected records."""
    status = F.col("status")
    return (
        summary.groupBy("check_category")
        .agg(
            r.rows().alias("checks"),
            F.count_if(status == "PASS").alias("passed"),
            F.count_if(status == "WARNING").alias("warnings"),
            F.count_if(status == "FAIL").alias("failed"),
            F.count_if(status == "INFO").alias("info"),
            F.sum(F.when(F.col("severity") != INFO, F.col("record_count"))).alias("affected_records"),
        )
        .orderBy("check_category")
    )
