"""Sales metrics. Each function takes the model and returns one report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from merchlens.functions import metrics as m
from merchlens.functions.numbers import (
    WHOLE,
    cents,
    count_when,
    exact_ratio,
    mean_money,
    money,
    percent,
    sum_when,
)
from merchlens.functions.quantiles import exact_distribution, quantile_value
from merchlens.plans.model import SalesModel

# Global windows only ever run over reports already grouped to one row per month, category or state.


def _valued_orders(model: SalesModel) -> DataFrame:
    """Orders with items and their item totals."""
    return model.valued(model.order_headers)


def _revenue_orders(model: SalesModel) -> DataFrame:
    return _valued_orders(model).where(m.earns_revenue())


def _category_orders(model: SalesModel, period: Column | None = None) -> DataFrame:
    """One row per (revenue order, category)."""
    return model.category_orders(m.earns_revenue() if period is None else m.earns_revenue() & period)


def _category_revenue(model: SalesModel) -> DataFrame:
    return _category_orders(model).groupBy("product_category").agg(F.sum("value").alias("revenue"))


def total_revenue(model: SalesModel) -> DataFrame:
    """Revenue split into product and freight, next to the value of orders that never became revenue."""
    lost = m.not_fulfilled()
    return _valued_orders(model).agg(
        money(sum_when(m.earns_revenue(), F.col("order_value"))).alias("total_revenue"),
        money(sum_when(m.earns_revenue(), F.col("product_value"))).alias("product_revenue"),
        money(sum_when(m.earns_revenue(), F.col("freight_value"))).alias("freight_revenue"),
        money(sum_when(lost, F.col("order_value"))).alias("canceled_order_value"),
        money(F.sum("order_value")).alias("gross_order_value_all_statuses"),
    )


def total_orders(model: SalesModel) -> DataFrame:
    """Order and customer counts.

    Orders are first counted per customer id, so the join to customers meets one row per customer, and people
    are counted as groups instead of by a distinct aggregate over all orders.
    """
    per_customer = model.per_customer(
        model.valued(model.order_headers, "left"),
        F.count(F.lit(1)).alias("orders"),
        count_when(m.earns_revenue()).alias("revenue_orders"),
        count_when(m.has_status(m.DELIVERED)).alias("delivered"),
        count_when(F.col("item_count").isNull()).alias("bare"),
    )
    per_person = per_customer.groupBy("customer_unique_id").agg(
        *[F.sum(c).alias(c) for c in ("orders", "revenue_orders", "delivered", "bare")]
    )
    return per_person.agg(
        F.coalesce(F.sum("orders"), F.lit(0)).alias("total_orders"),
        F.coalesce(F.sum("revenue_orders"), F.lit(0)).alias("revenue_orders"),
        F.coalesce(F.sum("delivered"), F.lit(0)).alias("delivered_orders"),
        F.coalesce(F.sum("bare"), F.lit(0)).alias("orders_without_items"),
        F.count("customer_unique_id").alias("total_customers"),
    )


def _monthly(model: SalesModel) -> DataFrame:
    return (
        _revenue_orders(model)
        .where(model.in_trend())
        .groupBy(m.purchase_month().alias("order_month"))
        .agg(F.sum("order_value").alias("revenue"))
    )


def monthly_revenue(model: SalesModel) -> DataFrame:
    """Revenue per month of the trend window."""
    return _monthly(model).select("order_month", money(F.col("revenue")).alias("revenue")).orderBy("order_month")


def monthly_revenue_mom(model: SalesModel) -> DataFrame:
    """Monthly revenue against the month before it."""
    previous = F.lag("revenue").over(Window.orderBy("order_month"))
    change = F.col("revenue") - F.col("previous")
    return (
        _monthly(model)
        .withColumn("previous", previous)
        .select(
            "order_month",
            money(F.col("revenue")).alias("revenue"),
            money(F.col("previous")).alias("previous_month_revenue"),
            money(change).alias("revenue_change"),
            percent(cents(change), cents("previous")).alias("revenue_change_pct"),
        )
        .orderBy("order_month")
    )


def monthly_order_volume(model: SalesModel) -> DataFrame:
    """Orders placed per month, split by whether they became revenue."""
    return (
        model.order_headers.where(model.in_trend())
        .groupBy(m.purchase_month().alias("order_month"))
        .agg(
            F.count(F.lit(1)).alias("orders_placed"),
            count_when(m.earns_revenue()).alias("revenue_orders"),
            count_when(m.not_fulfilled()).alias("canceled_or_unavailable"),
        )
        .orderBy("order_month")
    )


def average_order_value(model: SalesModel) -> DataFrame:
    """Mean, exact median and range of revenue per order."""
    valued = _revenue_orders(model).select(cents("order_value").alias("value_cents"))
    spread = exact_distribution(valued, "value_cents", {"median": "1/2"})
    return spread.select(
        F.col("value_count").alias("orders"),
        mean_money(F.col("value_sum"), F.col("value_count")).alias("average_order_value"),
        quantile_value("median", "1/2", 100).alias("median_order_value"),
        mean_money(F.col("value_min"), F.lit(1)).alias("min_order_value"),
        mean_money(F.col("value_max"), F.lit(1)).alias("max_order_value"),
    )


def revenue_by_category(model: SalesModel) -> DataFrame:
    """Orders, items, revenue and mean item price per category."""
    return (
        _category_orders(model)
        .groupBy("product_category")
        .agg(
            F.count(F.lit(1)).alias("orders"),
            F.sum("items").alias("items_sold"),
            money(F.sum("value")).alias("revenue"),
            mean_money(cents(F.sum("product_value")), F.sum("priced_items")).alias("average_item_price"),
        )
        .orderBy(F.desc_nulls_first("revenue"), "product_category")
    )


def top_categories(model: SalesModel, places: int = 10) -> DataFrame:
    """Categories ranked up to `places`; ties share a place, so there may be more rows."""
    ranked = _category_revenue(model).withColumn(
        "revenue_rank", F.rank().over(Window.orderBy(F.desc_nulls_first("revenue")))
    )
    return (
        ranked.where(F.col("revenue_rank") <= places)
        .select("revenue_rank", "product_category", money(F.col("revenue")).alias("revenue"))
        .orderBy("revenue_rank", "product_category")
    )


def revenue_by_state(model: SalesModel) -> DataFrame:
    """Orders, people, revenue and revenue share per customer state."""
    per_customer = model.per_customer(
        _revenue_orders(model), F.count(F.lit(1)).alias("orders"), F.sum("order_value").alias("revenue")
    )
    per_state = (
        per_customer.groupBy("customer_state", "customer_unique_id")
        .agg(F.sum("orders").alias("orders"), F.sum("revenue").alias("revenue"))
        .groupBy("customer_state")
        .agg(
            F.sum("orders").alias("orders"),
            F.count("customer_unique_id").alias("customers"),
            F.sum("revenue").alias("revenue"),
        )
    )
    return per_state.select(
        "customer_state",
        "orders",
        "customers",
        money(F.col("revenue")).alias("revenue"),
        percent(cents("revenue"), cents(F.sum("revenue").over(Window.partitionBy()))).alias("revenue_share_pct"),
    ).orderBy(F.desc_nulls_first("revenue"), "customer_state")


def revenue_by_month_category(model: SalesModel) -> DataFrame:
    """Orders and revenue per month and category of the trend window."""
    return (
        _category_orders(model, model.in_trend())
        .groupBy(m.purchase_month().alias("order_month"), "product_category")
        .agg(F.count(F.lit(1)).alias("orders"), money(F.sum("value")).alias("revenue"))
        .orderBy("order_month", F.desc_nulls_first("revenue"), "product_category")
    )


def average_freight_cost(model: SalesModel) -> DataFrame:
    """Freight per item, per order and against product value."""
    freight = F.sum("freight_value")
    return _revenue_orders(model).agg(
        mean_money(cents(freight), F.sum("item_count")).alias("average_freight_per_item"),
        mean_money(cents(freight), F.count("freight_value")).alias("average_freight_per_order"),
        percent(cents(freight), cents(F.sum("product_value"))).alias("freight_as_pct_of_product_value"),
    )


def completed_order_revenue(model: SalesModel) -> DataFrame:
    """Revenue of delivered orders and its share."""
    completed = sum_when(m.has_status(m.DELIVERED), F.col("order_value"))
    return _revenue_orders(model).agg(
        money(completed).alias("completed_revenue"),
        money(sum_when(~m.has_status(m.DELIVERED), F.col("order_value"))).alias("in_progress_revenue"),
        percent(cents(completed), cents(F.sum("order_value"))).alias("completed_share_pct"),
    )


def cancellation_rate(model: SalesModel) -> DataFrame:
    """Canceled and unavailable orders against all orders."""
    everything = F.count(F.lit(1))
    return model.order_headers.agg(
        everything.alias("total_orders"),
        count_when(m.has_status(m.CANCELED)).alias("canceled_orders"),
        count_when(m.has_status(m.UNAVAILABLE)).alias("unavailable_orders"),
        percent(count_when(m.has_status(m.CANCELED)), everything).alias("cancellation_rate_pct"),
        percent(count_when(m.not_fulfilled()), everything).alias("canceled_or_unavailable_rate_pct"),
    )


def category_revenue_contribution(model: SalesModel) -> DataFrame:
    """Share and cumulative share of revenue per category; ties accumulate in name order."""
    descending = Window.orderBy(F.desc_nulls_first("revenue"))
    running = Window.orderBy(F.desc_nulls_first("revenue"), "product_category").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    grand_total = cents(F.sum("revenue").over(Window.partitionBy()))
    return (
        _category_revenue(model)
        .select(
            F.rank().over(descending).alias("revenue_rank"),
            "product_category",
            money(F.col("revenue")).alias("revenue"),
            percent(cents("revenue"), grand_total).alias("revenue_share_pct"),
            percent(cents(F.sum("revenue").over(running)), grand_total).alias("cumulative_share_pct"),
        )
        .orderBy("revenue_rank", "product_category")
    )


def category_trend_recent_vs_prior(model: SalesModel, min_orders: int = 50) -> DataFrame:
    """Category revenue of the recent period against the one before it.

    Shares are taken over all categories; small categories are dropped afterwards.
    """
    calendar = model.calendar
    whole_span = model.during(calendar.prior_start, calendar.recent_end)
    is_recent = F.col(m.PURCHASED) >= F.lit(calendar.recent_start).cast("timestamp_ntz")
    none = F.lit(0).cast("decimal(28,2)")
    by_category = (
        _category_orders(model, whole_span)
        .groupBy("product_category")
        .agg(
            F.count(F.lit(1)).alias("orders"),
            F.coalesce(sum_when(~is_recent, F.col("value")), none).alias("prior"),
            F.coalesce(sum_when(is_recent, F.col("value")), none).alias("recent"),
        )
        .select(
            "*",
            cents("prior").alias("p"),
            cents("recent").alias("r"),
            cents(F.sum("prior").over(Window.partitionBy())).alias("p_all"),
            cents(F.sum("recent").over(Window.partitionBy())).alias("r_all"),
        )
    )
    p, r, p_all, r_all = (F.col(c) for c in ("p", "r", "p_all", "r_all"))
    return (
        by_category.where(F.col("orders") >= min_orders)
        .select(
            "product_category",
            money(F.col("prior")).alias("prior_6m_revenue"),
            money(F.col("recent")).alias("recent_6m_revenue"),
            percent(r - p, p).alias("revenue_change_pct"),
            percent(p, p_all).alias("prior_share_pct"),
            percent(r, r_all).alias("recent_share_pct"),
            exact_ratio(((r * p_all - p * r_all) * 100).cast(WHOLE), r_all * p_all).alias("share_change_pp"),
        )
        .orderBy(F.asc_nulls_last("revenue_change_pct"), "product_category")
    )


REPORTS = {
    "total_revenue": total_revenue,
    "total_orders": total_orders,
    "monthly_revenue": monthly_revenue,
    "monthly_revenue_mom": monthly_revenue_mom,
    "monthly_order_volume": monthly_order_volume,
    "average_order_value": average_order_value,
    "revenue_by_category": revenue_by_category,
    "top_10_categories": top_categories,
    "revenue_by_state": revenue_by_state,
    "revenue_by_month_category": revenue_by_month_category,
    "average_freight_cost": average_freight_cost,
    "completed_order_revenue": completed_order_revenue,
    "cancellation_rate": cancellation_rate,
    "category_revenue_contribution": category_revenue_contribution,
    "category_trend_recent_vs_prior": category_trend_recent_vs_prior,
}
