"""Validation of the clean tables: 44 rules, a gate, and the constraints enforced when publishing."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchlens.operators import keys as k
from merchlens.operators import rules as r
from merchlens.operators.rules import CRITICAL, WARNING, Rule
from merchlens.sources.schemas import CLEAN_SCHEMAS, KEYS, PRODUCT_MEASURES
from merchlens.sources.states import STATE_CODES

# Known order statuses and payment types.
ORDER_STATUSES = (
    "created", "approved", "invoiced", "processing", "shipped", "delivered", "canceled", "unavailable",
)
PAYMENT_TYPES = ("credit_card", "boleto", "voucher", "debit_card")
ZIP_PATTERN = r"^[0-9]{5}\z"

# Columns that must be filled, in report order.
REQUIRED = (
    ("customers", "customer_unique_id"),
    ("customers", "customer_state"),
    ("orders", "customer_id"),
    ("orders", "order_status"),
    ("orders", "order_purchase_timestamp"),
    ("orders", "order_estimated_delivery_date"),
    ("order_items", "product_id"),
    ("order_items", "seller_id"),
    ("order_items", "price"),
    ("order_items", "freight_value"),
    ("payments", "payment_type"),
    ("payments", "payment_value"),
)

# Child table, child column, parent table, parent column.
REFERENCES = (
    ("orders", "customer_id", "customers", "customer_id"),
    ("order_items", "order_id", "orders", "order_id"),
    ("order_items", "product_id", "products", "product_id"),
    ("payments", "order_id", "orders", "order_id"),
)

VALIDATED = ("customers", "orders", "order_items", "payments", "products")


class ValidationError(Exception):
    """At least one critical rule is broken."""


@dataclass(frozen=True)
class Domains:
    """Allowed values; the defaults are those of the source data."""

    states: Sequence[str] = STATE_CODES
    statuses: Sequence[str] = ORDER_STATUSES
    payment_types: Sequence[str] = PAYMENT_TYPES


def rule_scopes(data: Mapping[str, DataFrame], profiles: Mapping[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """The tables themselves and the profiles of their keys, taken here unless they were before."""
    return {**{name: data[name] for name in VALIDATED}, **(profiles or k.key_profiles(data))}


# Where the rows per key of each table are counted: scope and count column.
KEY_SCOPES = {
    "customers": ("customer_keys", "n_customers"),
    "orders": ("order_keys", "n_orders"),
    "order_items": ("item_keys", "n"),
    "payments": ("payment_keys", "n"),
    "products": ("product_keys", "n_products"),
}
PARENT_SCOPES = {"customers": "customer_keys", "orders": "order_keys", "products": "product_keys"}


def validation_rules(domains: Domains = Domains()) -> list[Rule]:
    """All 44 rules in report order."""
    rules: list[Rule] = []
    for table in VALIDATED:
        named = ", ".join(KEYS[table])
        scope, count = KEY_SCOPES[table]
        rules.append(Rule(f"Primary key ({named}) is not NULL", table, CRITICAL, table, r.missing(*KEYS[table])))
        rules.append(Rule(f"Primary key ({named}) is unique", table, CRITICAL, scope, k.extra_rows(count)))
    for table, column in REQUIRED:
        rules.append(Rule(f"Required field {column} is not NULL", table, CRITICAL, table, r.missing(column)))
    for child, column, parent, parent_column in REFERENCES:
        broken = k.broken_references(f"n_{child}", f"n_{parent}")
        name = f"{child}.{column} exists in {parent}.{parent_column}"
        rules.append(Rule(name, child, CRITICAL, PARENT_SCOPES[parent], broken))

    purchased, promised = "order_purchase_timestamp", "order_estimated_delivery_date"
    received = "order_delivered_customer_date"
    undated = F.count_if((F.col("order_status") == "delivered") & F.col(received).isNull())
    # Rule names and severities, in report order.
    rules += [
        Rule("price is not negative", "order_items", CRITICAL, "order_items", r.negative("price")),
        Rule("freight_value is not negative", "order_items", CRITICAL, "order_items", r.negative("freight_value")),
        Rule("payment_value is not negative", "payments", CRITICAL, "payments", r.negative("payment_value")),
        Rule("Delivered to customer on/after purchase date", "orders", CRITICAL, "orders",
             r.recorded_before(received, purchased)),
        Rule("Estimated delivery on/after purchase date", "orders", CRITICAL, "orders",
             r.recorded_before(promised, purchased)),
        Rule("Orders with inconsistent lifecycle dates (flagged has_invalid_dates)", "orders", WARNING, "orders",
             F.count_if(F.col("has_invalid_dates"))),
        Rule("Delivered orders missing delivery date", "orders", WARNING, "orders", undated),
        Rule("Orders without order items (orphan orders)", "orders", WARNING, "order_keys",
             k.unreferenced_rows("n_orders", "n_order_items")),
        Rule("Orders without payments", "orders", WARNING, "order_keys",
             k.unreferenced_rows("n_orders", "n_payments")),
        Rule("Customers without orders (orphan customers)", "customers", WARNING, "customer_keys",
             k.unreferenced_rows("n_customers", "n_orders")),
        Rule("Products never ordered (orphan products)", "products", WARNING, "product_keys",
             k.unreferenced_rows("n_products", "n_order_items")),
        Rule("order_status is a known status", "orders", WARNING, "orders",
             r.outside("order_status", domains.statuses)),
        Rule("customer_state is a valid Brazilian state", "customers", WARNING, "customers",
             r.outside("customer_state", domains.states)),
        Rule("customer_zip_code_prefix has 5 digits", "customers", WARNING, "customers",
             r.not_matching("customer_zip_code_prefix", ZIP_PATTERN)),
        Rule("payment_type is a known type", "payments", WARNING, "payments",
             r.outside("payment_type", domains.payment_types)),
        Rule("price is greater than zero", "order_items", WARNING, "order_items", r.equal_to("price", 0)),
        Rule("payment_value is greater than zero", "payments", WARNING, "payments", r.equal_to("payment_value", 0)),
        Rule("Product has a category", "products", WARNING, "products", r.missing("product_category_name")),
    ]
    return rules


Tables = Mapping[str, DataFrame]


def _report(rules: Sequence[Rule], data: Tables, profiles: Tables | None = None) -> DataFrame:
    return r.evaluate(rules, rule_scopes(data, profiles)).select(
        "position",
        "check",
        "dataset",
        "severity",
        "record_count",
        r.status_for(F.col("record_count"), F.col("severity")).alias("status"),
    )


def validate(data: Tables, domains: Domains = Domains(), profiles: Tables | None = None) -> DataFrame:
    """One row per rule: position, check, dataset, severity, record_count, status."""
    return _report(validation_rules(domains), data, profiles)


def summarize(results: DataFrame) -> DataFrame:
    """Number of rules per outcome and the overall result, in one row."""
    status = F.col("status")
    failed = F.count_if(status == "FAIL")
    return results.agg(
        F.count_if(status == "PASS").alias("passed"),
        F.count_if(status == "WARNING").alias("warnings"),
        failed.alias("failed"),
        r.rows().alias("checks"),
        F.when(failed > 0, "FAILED").otherwise("PASSED").alias("overall"),
    )


def gate(results: DataFrame) -> DataFrame:
    """Raise with every broken critical rule; warnings pass. Only the failed rule rows reach the driver."""
    failures = results.where(F.col("status") == "FAIL").orderBy("position").collect()
    if failures:
        listed = "; ".join(f"{f.dataset}: {f.check} ({f.record_count:,})" for f in failures)
        raise ValidationError(f"{len(failures)} critical validation check(s) failed: {listed}")
    return results


# ------------------------------------------------------------------ constraints of the published tables

# Longest text per column, and the columns that may stay empty.
TEXT_LENGTHS = {
    "customers": {"customer_id": 32, "customer_unique_id": 32, "customer_zip_code_prefix": 5, "customer_city": 100,
                  "customer_state": 2},
    "products": {"product_id": 32, "product_category_name": 100, "product_category_name_english": 100},
    "orders": {"order_id": 32, "customer_id": 32, "order_status": 20},
    "order_items": {"order_id": 32, "product_id": 32, "seller_id": 32},
    "payments": {"order_id": 32, "payment_type": 20},
}
NULLABLE = {
    "customers": (),
    "products": ("product_category_name", "product_name_length", "product_description_length", "product_photos_qty",
                 *PRODUCT_MEASURES),
    "orders": ("order_approved_at", "order_delivered_carrier_date", "order_delivered_customer_date"),
    "order_items": (),
    "payments": ("payment_installments",),
}
SMALL_INTEGERS = (
    ("order_items", "order_item_id"), ("payments", "payment_sequential"), ("payments", "payment_installments"),
)
AMOUNTS = (("order_items", "price"), ("order_items", "freight_value"), ("payments", "payment_value"))


def publish_constraints() -> list[Rule]:
    """What the published tables enforce beyond the rules above: filled columns, lengths, ranges, keys."""
    def critical(check: str, table: str, scope: str, count) -> Rule:
        return Rule(check, table, CRITICAL, scope, count)

    rules = []
    for table in VALIDATED:
        for column in CLEAN_SCHEMAS[table].fieldNames():
            if column not in NULLABLE[table]:
                rules.append(critical(f"{column} is filled", table, table, r.missing(column)))
        for column, longest in TEXT_LENGTHS[table].items():
            too_long = F.count_if(F.length(F.col(column).cast("string")) > longest)
            rules.append(critical(f"{column} has at most {longest} characters", table, table, too_long))
        scope, count = KEY_SCOPES[table]
        rules.append(critical("primary key is unique", table, scope, k.extra_rows(count)))
    for child, column, parent, _ in REFERENCES:
        broken = k.broken_references(f"n_{child}", f"n_{parent}")
        rules.append(critical(f"{column} refers to {parent}", child, PARENT_SCOPES[parent], broken))
    for column in PRODUCT_MEASURES:
        rules.append(critical(f"{column} is positive", "products", "products", F.count_if(F.col(column) <= 0)))
    rules.append(critical("payment_installments is positive", "payments", "payments",
                          F.count_if(F.col("payment_installments") <= 0)))
    for table, column in SMALL_INTEGERS:
        too_large = F.count_if((F.col(column) > 32767) | (F.col(column) < -32768))
        rules.append(critical(f"{column} fits a small integer", table, table, too_large))
    for table, column in AMOUNTS:
        out_of_range = F.count_if((F.col(column) < 0) | (F.col(column) >= 100_000_000))
        rules.append(critical(f"{column} is a valid amount", table, table, out_of_range))
    for later in ("order_delivered_customer_date", "order_estimated_delivery_date"):
        early = r.recorded_before(later, "order_purchase_timestamp")
        rules.append(critical(f"{later} is not before the purchase", "orders", "orders", early))
    return rules


def check_everything(data: Tables, domains: Domains = Domains(), profiles: Tables | None = None) -> DataFrame:
    """The rows of `validate` and of `check_constraints`, told apart by `is_rule`, from one evaluation of each scope."""
    rules = validation_rules(domains)
    found = _report([*rules, *publish_constraints()], data, profiles).withColumn("is_rule", F.col("position") <= len(rules))
    return found.withColumn("position", F.when(F.col("is_rule"), F.col("position")).otherwise(F.col("position") - len(rules)))


def check_constraints(data: Tables, profiles: Tables | None = None) -> DataFrame:
    """One row per publish constraint, same columns as `validate`."""
    return _report(publish_constraints(), data, profiles)
