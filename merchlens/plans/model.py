"""The star model and its order-level building blocks.

Every order-level aggregate is built from item rows that were pre-aggregated map-side, so an order or product
holding a large share of all rows collapses before it is shuffled, and joins on the order key only ever meet
one row per order.
"""

from __future__ import annotations

from collections.abc import Collection
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchlens.functions import metrics as m
from merchlens.functions.dates import micros_between, within
from merchlens.functions.numbers import MICROS_PER_DAY, MICROS_PER_HOUR

CATEGORY = "product_category_name_english"
PERSON = ("customer_unique_id", "customer_state")
# The month of purchase, which stored facts are laid out by.
MONTH = "order_month"


@dataclass(frozen=True)
class SalesModel:
    """Clean tables plus the reporting calendar.

    `headers` (order, customer, status, purchase time) and `deliveries` (headers plus delivery, promise and
    date flag) are narrower versions of `orders` for sources where lifecycle dates must be derived first; by
    default they are the orders table itself, which Spark prunes to the columns in use.

    `facts` and `category_facts` are stored results of `order_base` and `category_base`. A run writes them once, and
    every report reads one of them without joining tables; without them each report joins what it needs.
    """

    customers: DataFrame
    orders: DataFrame
    order_items: DataFrame
    products: DataFrame
    payments: DataFrame
    states: DataFrame
    calendar: m.Calendar = field(default_factory=m.Calendar)
    headers: DataFrame | None = None
    deliveries: DataFrame | None = None
    facts: DataFrame | None = None
    category_facts: DataFrame | None = None

    @property
    def order_headers(self) -> DataFrame:
        return self.facts if self.facts is not None else self.headers if self.headers is not None else self.orders

    @property
    def order_deliveries(self) -> DataFrame:
        return self.facts if self.facts is not None else self.deliveries if self.deliveries is not None else self.orders

    @property
    def order_lifecycles(self) -> DataFrame:
        return self.facts if self.facts is not None else self.orders

    def during(self, start: str, end: str) -> Column:
        """start <= purchase < end; stored facts of other months are not read."""
        period = within(m.PURCHASED, start, end)
        if self.facts is None:
            return period
        first = F.trunc(F.lit(start).cast("date"), "month")
        return period & (F.col(MONTH) >= first) & (F.col(MONTH) < F.lit(end).cast("timestamp_ntz").cast("date"))

    def in_trend(self) -> Column:
        return self.during(self.calendar.trend_start, self.calendar.trend_end)

    def valued(self, orders: DataFrame, how: str = "inner") -> DataFrame:
        """Orders of the model with the totals of their items; an inner join leaves out those without items."""
        if self.facts is None:
            return orders.join(item_totals(self.order_items), "order_id", how)
        return orders.where(F.col("item_count").isNotNull()) if how == "inner" else orders

    def bare(self, orders: DataFrame) -> DataFrame:
        """Orders of the model without items."""
        if self.facts is None:
            return orders.join(item_totals(self.order_items).select("order_id"), "order_id", "left_anti")
        return orders.where(F.col("item_count").isNull())

    def placed(self, orders: DataFrame) -> DataFrame:
        """Orders of the model with their customer's identity and state; orders without a customer drop out."""
        if self.facts is None:
            return orders.join(self.customers.select("customer_id", *PERSON), "customer_id")
        return orders.where("has_customer")

    def per_customer(self, orders: DataFrame, *totals: Column) -> DataFrame:
        """Totals of orders with their customer's identity and state; orders without a customer drop out.

        Orders are added up before they meet the customers, so a customer with very many orders is one row.
        """
        if self.facts is None:
            return self.placed(orders.groupBy("customer_id").agg(*totals))
        return self.placed(orders).groupBy(*PERSON).agg(*totals)

    def categorised(self, orders: DataFrame) -> DataFrame:
        """Orders of the model with the category holding most of their value, as product_category."""
        if self.facts is None:
            return orders.join(largest_category(self.order_categories()), "order_id")
        return orders.where("in_catalogue").withColumnRenamed("primary_category", "product_category")

    def order_categories(self) -> DataFrame:
        """One row per (order, category), for items whose product is in the catalogue."""
        if self.category_facts is not None:
            return self.category_facts.where("in_catalogue")
        return category_totals(self.order_items, self.products)

    def category_orders(self, condition: Column) -> DataFrame:
        """The same for orders that meet a condition on status and purchase, with these columns."""
        if self.category_facts is not None:
            return self.order_categories().where(condition)
        headers = self.order_headers.where(condition).select("order_id", "order_status", m.PURCHASED)
        return self.order_categories().join(headers, "order_id")

    def tables(self) -> dict[str, DataFrame]:
        return {
            "customers": self.customers,
            "orders": self.orders,
            "order_items": self.order_items,
            "payments": self.payments,
            "products": self.products,
        }


# ------------------------------------------------------------------ per-order aggregates


def item_totals(items: DataFrame) -> DataFrame:
    """One row per order with items: item count and exact value totals."""
    return items.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("item_count"),
        F.sum("price").alias("product_value"),
        F.sum("freight_value").alias("freight_value"),
        F.sum(F.col("price") + F.col("freight_value")).alias("order_value"),
    )


def category_totals(items: DataFrame, products: DataFrame) -> DataFrame:
    """One row per (order, category), for items whose product is in the catalogue.

    The product join feeds another exchange, so adaptive execution is free to split a partition that one
    best-selling product makes too large.
    """
    catalogue = products.select("product_id", F.col(CATEGORY).alias("product_category"))
    return (
        items.select("order_id", "product_id", "price", "freight_value")
        .join(catalogue, "product_id")
        .groupBy("order_id", "product_category")
        .agg(
            F.count(F.lit(1)).alias("items"),
            F.count("price").alias("priced_items"),
            F.sum("price").alias("product_value"),
            F.sum(F.col("price") + F.col("freight_value")).alias("value"),
        )
    )


def _most_valuable(value: Column, category: Column, known: Column) -> Column:
    """Category of the largest value; ties go to the first name in binary order."""
    return F.min_by(category, F.when(known, F.struct((-value).alias("v"), category.alias("c"))))


def primary_category(items: DataFrame, products: DataFrame) -> DataFrame:
    """One row per order: the category holding most of its value."""
    return largest_category(category_totals(items, products))


def largest_category(per_category: DataFrame) -> DataFrame:
    """The same from category totals."""
    return per_category.groupBy("order_id").agg(
        _most_valuable(F.col("value"), F.col("product_category"), F.lit(True)).alias("product_category")
    )


def category_profile(items: DataFrame, products: DataFrame) -> DataFrame:
    """One row per (order, category), items whose product is not in the catalogue being told apart by a flag."""
    catalogue = products.select(
        "product_id", F.col(CATEGORY).alias("product_category"), F.lit(True).alias("in_catalogue")
    )
    return (
        items.select("order_id", "product_id", "price", "freight_value")
        .join(catalogue, "product_id", "left")
        .withColumn("in_catalogue", F.coalesce("in_catalogue", F.lit(False)))
        .groupBy("order_id", "product_category", "in_catalogue")
        .agg(
            F.count(F.lit(1)).alias("items"),
            F.count("price").alias("priced_items"),
            F.sum("price").alias("product_value"),
            F.sum("freight_value").alias("freight_value"),
            F.sum(F.col("price") + F.col("freight_value")).alias("value"),
        )
    )


def item_profile(per_category: DataFrame) -> DataFrame:
    """Item totals and primary category per order from its category profile."""
    return per_category.groupBy("order_id").agg(
        F.sum("items").alias("item_count"),
        F.sum("product_value").alias("product_value"),
        F.sum("freight_value").alias("freight_value"),
        F.sum("value").alias("order_value"),
        F.bool_or("in_catalogue").alias("in_catalogue"),
        _most_valuable(F.col("value"), F.col("product_category"), F.col("in_catalogue")).alias("primary_category"),
    )


# ------------------------------------------------------------------ stored facts

ITEM_FACTS = ("item_count", "product_value", "freight_value", "order_value", "in_catalogue", "primary_category")
LIFECYCLE = (m.PURCHASED, m.APPROVED, m.HANDED_OVER, m.RECEIVED, m.PROMISED, "has_invalid_dates")


def order_months(orders: DataFrame) -> DataFrame:
    """order_id and the month it was placed in, one row per order."""
    return orders.groupBy("order_id").agg(F.min(m.purchase_month()).alias(MONTH))


def category_base(items: DataFrame, products: DataFrame, orders: DataFrame) -> DataFrame:
    """The category profile with what reports ask of an order: status, purchase and month.

    Items of an unknown order keep their row, without these.
    """
    headers = orders.select("order_id", "order_status", m.PURCHASED, m.purchase_month().alias(MONTH))
    return category_profile(items, products).join(headers, "order_id", "left")


def order_base(orders: DataFrame, customers: DataFrame, per_category: DataFrame) -> DataFrame:
    """One row per order: lifecycle to the microsecond, customer, item totals, primary category and month.

    An order without items has no totals, one without a customer no person; has_customer tells the latter from a
    customer without an identity.
    """
    people = customers.select("customer_id", *PERSON, F.lit(True).alias("has_customer"))
    whole = orders.join(item_profile(per_category), "order_id", "left").join(people, "customer_id", "left")
    return whole.select(
        "order_id", "customer_id", *PERSON, F.coalesce("has_customer", F.lit(False)).alias("has_customer"), "order_status",
        *LIFECYCLE, *ITEM_FACTS, m.purchase_month().alias(MONTH),
    )


def named_states(model: SalesModel) -> DataFrame:
    return model.states.select(F.col("state_code").alias("customer_state"), "state_name", "macro_region")


def measured_deliveries(model: SalesModel) -> DataFrame:
    """The orders with a measurable delivery, with its durations in microseconds and its lateness."""
    return model.order_deliveries.where(m.measurable_delivery()).select(
        "*",
        micros_between(m.PURCHASED, m.RECEIVED).alias("actual_micros"),
        micros_between(m.PURCHASED, m.PROMISED).alias("promised_micros"),
        m.days_past_promise().alias("days_vs_estimate"),
        m.arrived_late().alias("is_late"),
    )


# ------------------------------------------------------------------ order facts


def _days(start: str, end: str) -> Column:
    return micros_between(start, end).cast("double") / F.lit(float(MICROS_PER_DAY))


def _hours(start: str, end: str) -> Column:
    return micros_between(start, end).cast("double") / F.lit(float(MICROS_PER_HOUR))


STAGE_COLUMNS = ("approval_hours", "seller_handoff_days", "carrier_transit_days")
DELIVERY_COLUMNS = (
    "is_measurable_delivery", "is_late", "delivery_days", "estimated_days", "days_vs_estimate", "has_invalid_dates",
)
ITEM_COLUMNS = ("item_count", "product_value", "freight_value", "order_value", "revenue")


def order_facts(model: SalesModel, need: Collection[str] | None = None) -> DataFrame:
    """One row per order: totals, primary category, status flags, lateness and stage durations.

    Measures that do not apply are NULL, so averages skip them. Stage durations need only plausible dates, the
    delivery measures need a measurable delivery.

    `need` names the wanted columns; item totals, categories and lifecycle stages are only joined when asked for. Spark
    drops an unused left join by itself where the joined side is grouped by the key, but not one to stored aggregates.
    """
    wanted = set(need) if need is not None else None

    def asked(*columns: str) -> bool:
        return wanted is None or bool(wanted.intersection(columns))

    if asked(*STAGE_COLUMNS):
        orders = model.order_lifecycles
    else:
        orders = model.order_deliveries if asked(*DELIVERY_COLUMNS) else model.order_headers
    wide = model.placed(orders)
    if asked("state_name", "macro_region"):
        wide = wide.join(named_states(model), "customer_state", "left")
    if asked("primary_category") and model.facts is None:
        wide = wide.join(item_profile(category_profile(model.order_items, model.products)), "order_id", "left")
    elif asked(*ITEM_COLUMNS):
        wide = model.valued(wide, "left")
    earns, measurable, plausible = m.earns_revenue(), m.measurable_delivery(), ~F.col("has_invalid_dates")
    columns = {
        "order_id": F.col("order_id"),
        "customer_unique_id": F.col("customer_unique_id"),
        "customer_state": F.col("customer_state"),
        "state_name": F.col("state_name"),
        "macro_region": F.col("macro_region"),
        "order_status": F.col("order_status"),
        m.PURCHASED: F.col(m.PURCHASED),
        "order_purchase_date": F.to_date(m.PURCHASED),
        "order_month": m.purchase_month(),
        "in_trend_window": model.calendar.in_trend(),
        "primary_category": F.col("primary_category"),
        "item_count": F.coalesce("item_count", F.lit(0).cast("bigint")),
        "product_value": F.col("product_value"),
        "freight_value": F.col("freight_value"),
        "order_value": F.col("order_value"),
        "revenue": F.when(earns, F.col("order_value")),
        "is_revenue_order": earns,
        "is_canceled": m.has_status(m.CANCELED),
        "is_unavailable": m.has_status(m.UNAVAILABLE),
        "is_measurable_delivery": measurable,
        "is_late": F.when(measurable, m.arrived_late()),
        "delivery_days": F.when(measurable, _days(m.PURCHASED, m.RECEIVED)),
        "estimated_days": F.when(measurable, _days(m.PURCHASED, m.PROMISED)),
        "days_vs_estimate": F.when(measurable, m.days_past_promise()),
        "approval_hours": F.when(plausible, _hours(m.PURCHASED, m.APPROVED)),
        "seller_handoff_days": F.when(plausible, _days(m.APPROVED, m.HANDED_OVER)),
        "carrier_transit_days": F.when(plausible, _days(m.HANDED_OVER, m.RECEIVED)),
        "has_invalid_dates": F.col("has_invalid_dates"),
    }
    return wide.select(*[value.alias(name) for name, value in columns.items() if asked(name)])
