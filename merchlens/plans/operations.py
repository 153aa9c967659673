"""Delivery, lateness, freight and fulfilment metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from merchlens.functions import metrics as m
from merchlens.functions.dates import micros_between
from merchlens.functions.numbers import (
    MICROS_PER_DAY,
    cents,
    count_when,
    exact_ratio,
    mean_days,
    mean_hours,
    mean_money,
    percent,
    sum_when,
)
from merchlens.functions.quantiles import exact_distribution, quantile_value
from merchlens.plans.model import SalesModel, measured_deliveries


def _mean(micros: str) -> Column:
    return mean_days(F.sum(micros), F.count(micros))


def delivery_time_summary(model: SalesModel) -> DataFrame:
    """Delivery days: mean, exact median and 90th percentile, range."""
    spread = exact_distribution(measured_deliveries(model), "actual_micros", {"p50": "1/2", "p90": "9/10"})
    return spread.select(
        F.col("value_count").alias("delivered_orders"),
        mean_days(F.col("value_sum"), F.col("value_count")).alias("avg_delivery_days"),
        quantile_value("p50", "1/2", MICROS_PER_DAY).alias("median_delivery_days"),
        quantile_value("p90", "9/10", MICROS_PER_DAY).alias("p90_delivery_days"),
        mean_days(F.col("value_min"), F.lit(1)).alias("min_delivery_days"),
        mean_days(F.col("value_max"), F.lit(1)).alias("max_delivery_days"),
    )


def estimated_vs_actual_delivery(model: SalesModel) -> DataFrame:
    """Promised against actual delivery time."""
    deliveries = measured_deliveries(model)
    gap = F.col("days_vs_estimate")
    means = deliveries.agg(
        _mean("promised_micros").alias("avg_estimated_days"),
        _mean("actual_micros").alias("avg_actual_days"),
        mean_days(
            F.sum(F.col("promised_micros") - F.col("actual_micros")), F.count("promised_micros")
        ).alias("avg_days_delivered_before_estimate"),
        exact_ratio(sum_when(gap > 0, gap), count_when(gap > 0)).alias("avg_days_late_when_late"),
    )
    middle = exact_distribution(deliveries, "days_vs_estimate", {"p50": "1/2"})
    return means.crossJoin(F.broadcast(middle)).select(
        "avg_estimated_days",
        "avg_actual_days",
        "avg_days_delivered_before_estimate",
        quantile_value("p50", "1/2", 1).alias("median_days_vs_estimate"),
        "avg_days_late_when_late",
    )


def delivery_timeliness_distribution(model: SalesModel) -> DataFrame:
    """Deliveries by distance from the promised day."""
    return (
        measured_deliveries(model)
        .groupBy(m.timeliness_label(F.col("days_vs_estimate")).alias("timeliness_bucket"))
        .agg(F.count(F.lit(1)).alias("orders"))
        .select(
            "timeliness_bucket",
            "orders",
            percent(F.col("orders"), F.sum("orders").over(Window.partitionBy())).alias("pct_of_delivered"),
        )
        .orderBy("timeliness_bucket")
    )


def _lateness() -> list[Column]:
    everything = F.count(F.lit(1))
    return [
        everything.alias("delivered_orders"),
        count_when(F.col("is_late")).alias("late_orders"),
        percent(count_when(F.col("is_late")), everything).alias("late_pct"),
    ]


def late_delivery_rate(model: SalesModel) -> DataFrame:
    """Deliveries on time and late."""
    everything, on_time = F.count(F.lit(1)), count_when(~F.col("is_late"))
    delivered, late, late_pct = _lateness()
    return measured_deliveries(model).agg(
        delivered,
        on_time.alias("on_time_orders"),
        late,
        percent(on_time, everything).alias("on_time_pct"),
        late_pct,
    )


def late_deliveries_by_month(model: SalesModel) -> DataFrame:
    """Lateness and durations by purchase month."""
    return (
        measured_deliveries(model)
        .where(model.in_trend())
        .groupBy(m.purchase_month().alias("order_month"))
        .agg(
            *_lateness(),
            _mean("actual_micros").alias("avg_delivery_days"),
            _mean("promised_micros").alias("avg_estimated_days"),
        )
        .orderBy("order_month")
    )


def late_deliveries_by_state(model: SalesModel) -> DataFrame:
    """Lateness by customer state, ranked on the unrounded late rate.

    Deliveries are totalled per customer before the customer join, so a customer with very many orders is one row.
    """
    per_customer = model.per_customer(
        measured_deliveries(model),
        F.count(F.lit(1)).alias("delivered"),
        count_when(F.col("is_late")).alias("late"),
        F.sum("actual_micros").alias("micros"),
    )
    per_state = per_customer.groupBy("customer_state").agg(
        F.sum("delivered").alias("delivered_orders"),
        F.sum("late").alias("late_orders"),
        F.sum("micros").alias("micros"),
    )
    # Ranked on 18 digits of the rate, not on the rounded percentage.
    rate = exact_ratio(F.col("late_orders"), F.col("delivered_orders"), 18)
    return per_state.select(
        "customer_state",
        "delivered_orders",
        "late_orders",
        percent(F.col("late_orders"), F.col("delivered_orders")).alias("late_pct"),
        mean_days(F.col("micros"), F.col("delivered_orders")).alias("avg_delivery_days"),
        F.rank().over(Window.orderBy(rate.desc())).alias("late_rate_rank"),
    ).orderBy(F.desc("late_pct"), "customer_state")


def late_deliveries_by_category(model: SalesModel, min_delivered: int = 100) -> DataFrame:
    """Lateness by each order's primary category; small categories are left out."""
    return (
        model.categorised(measured_deliveries(model))
        .groupBy("product_category")
        .agg(*_lateness(), _mean("actual_micros").alias("avg_delivery_days"))
        .where(F.col("delivered_orders") >= min_delivered)
        .orderBy(F.desc("late_pct"), "product_category")
    )


def freight_cost_summary(model: SalesModel) -> DataFrame:
    """Freight per item and order, and per order on time or late."""
    priced = model.valued(model.order_deliveries.where(m.earns_revenue())).select(
        (m.measurable_delivery() & m.arrived_late()).alias("late"),
        (m.measurable_delivery() & ~m.arrived_late()).alias("on_time"),
        F.col("freight_value").alias("freight"),
        F.col("item_count").alias("items"),
    )
    freight = F.col("freight")

    def mean_where(condition: Column) -> Column:
        return mean_money(cents(sum_when(condition, freight)), F.count(F.when(condition, freight)))

    return priced.agg(
        mean_money(cents(F.sum(freight)), F.sum("items")).alias("avg_freight_per_item"),
        mean_money(cents(F.sum(freight)), F.count(freight)).alias("avg_freight_per_order"),
        mean_where(F.col("on_time")).alias("avg_freight_on_time_orders"),
        mean_where(F.col("late")).alias("avg_freight_late_orders"),
    )


def cancellation_rate_by_month(model: SalesModel) -> DataFrame:
    """Canceled and unavailable orders by purchase month."""
    everything = F.count(F.lit(1))
    return (
        model.order_headers.where(model.in_trend())
        .groupBy(m.purchase_month().alias("order_month"))
        .agg(
            everything.alias("orders"),
            count_when(m.has_status(m.CANCELED)).alias("canceled_orders"),
            count_when(m.has_status(m.UNAVAILABLE)).alias("unavailable_orders"),
            percent(count_when(m.has_status(m.CANCELED)), everything).alias("cancellation_rate_pct"),
            percent(count_when(m.not_fulfilled()), everything).alias("canceled_or_unavailable_pct"),
        )
        .orderBy("order_month")
    )


def delivery_performance_by_status(model: SalesModel) -> DataFrame:
    """How far orders of each status got through fulfilment."""
    waited = micros_between(m.PURCHASED, m.APPROVED)
    grouped = model.order_lifecycles.groupBy("order_status").agg(
        F.count(F.lit(1)).alias("orders"),
        F.count(m.APPROVED).alias("approved"),
        F.count(m.HANDED_OVER).alias("handed_to_carrier"),
        F.count(m.RECEIVED).alias("delivered_to_customer"),
        mean_hours(F.sum(waited), F.count(waited)).alias("avg_hours_to_approval"),
    )
    return grouped.select(
        "order_status",
        "orders",
        percent(F.col("orders"), F.sum("orders").over(Window.partitionBy())).alias("pct_of_orders"),
        "approved",
        "handed_to_carrier",
        "delivered_to_customer",
        "avg_hours_to_approval",
    ).orderBy(F.desc("orders"), "order_status")


def fulfilment_stage_times(model: SalesModel) -> DataFrame:
    """Mean time per stage for late and on-time orders with every stage recorded."""
    staged = model.order_lifecycles.where(
        m.measurable_delivery() & F.col(m.APPROVED).isNotNull() & F.col(m.HANDED_OVER).isNotNull()
    ).select(
        F.when(m.arrived_late(), "late").otherwise("on_time").alias("delivery_outcome"),
        micros_between(m.PURCHASED, m.APPROVED).alias("approval"),
        micros_between(m.APPROVED, m.HANDED_OVER).alias("handoff"),
        micros_between(m.HANDED_OVER, m.RECEIVED).alias("transit"),
    )
    return (
        staged.groupBy("delivery_outcome")
        .agg(
            F.count(F.lit(1)).alias("delivered_orders"),
            _mean("approval").alias("avg_approval_days"),
            _mean("handoff").alias("avg_seller_handoff_days"),
            _mean("transit").alias("avg_carrier_transit_days"),
        )
        .orderBy("delivery_outcome")
    )


def _kpi_base(model: SalesModel) -> DataFrame:
    """One row per order with everything the KPI tables need."""
    measurable = F.coalesce(m.measurable_delivery(), F.lit(False))
    orders = model.valued(model.order_deliveries, "left")
    return orders.withColumns({
        "freight": F.col("freight_value"),
        "measurable": measurable,
        "late": F.when(measurable, m.arrived_late()),
        "actual_micros": F.when(measurable, micros_between(m.PURCHASED, m.RECEIVED)),
        "promised_micros": F.when(measurable, micros_between(m.PURCHASED, m.PROMISED)),
    })


def _kpis() -> dict[str, Column]:
    everything, measured = F.count(F.lit(1)), count_when(F.col("measurable"))
    earned = F.when(m.earns_revenue(), F.col("freight"))
    return {
        "orders": everything,
        "delivered_orders": measured,
        "avg_delivery_days": _mean("actual_micros"),
        "avg_estimated_days": _mean("promised_micros"),
        "late_delivery_pct": percent(count_when(F.col("late")), measured),
        "cancellation_pct": percent(count_when(m.has_status(m.CANCELED)), everything),
        "unavailable_pct": percent(count_when(m.has_status(m.UNAVAILABLE)), everything),
        "avg_freight_per_order": mean_money(cents(F.sum(earned)), F.count(earned)),
    }


def operations_kpis(model: SalesModel) -> DataFrame:
    """Headline operational KPIs in one row, from one pass over the orders plus the exact median."""
    kpis = _kpi_base(model).agg(*[column.alias(name) for name, column in _kpis().items()])
    middle = exact_distribution(measured_deliveries(model), "actual_micros", {"p50": "1/2"})
    return kpis.crossJoin(F.broadcast(middle)).select(
        F.col("orders").alias("total_orders"),
        "delivered_orders",
        "avg_delivery_days",
        quantile_value("p50", "1/2", MICROS_PER_DAY).alias("median_delivery_days"),
        "avg_estimated_days",
        "late_delivery_pct",
        "cancellation_pct",
        "unavailable_pct",
        "avg_freight_per_order",
    )


def operations_kpis_monthly(model: SalesModel) -> DataFrame:
    """Operational KPIs per month of the trend window."""
    kpis = _kpis()
    wanted = (
        "orders", "delivered_orders", "avg_delivery_days", "late_delivery_pct", "cancellation_pct",
        "avg_freight_per_order",
    )
    return (
        _kpi_base(model)
        .where(model.in_trend())
        .groupBy(m.purchase_month().alias("order_month"))
        .agg(*[kpis[name].alias(name) for name in wanted])
        .orderBy("order_month")
    )


REPORTS = {
    "delivery_time_summary": delivery_time_summary,
    "estimated_vs_actual_delivery": estimated_vs_actual_delivery,
    "delivery_timeliness_distribution": delivery_timeliness_distribution,
    "late_delivery_rate": late_delivery_rate,
    "late_deliveries_by_month": late_deliveries_by_month,
    "late_deliveries_by_state": late_deliveries_by_state,
    "late_deliveries_by_category": late_deliveries_by_category,
    "freight_cost_summary": freight_cost_summary,
    "cancellation_rate_by_month": cancellation_rate_by_month,
    "delivery_performance_by_status": delivery_performance_by_status,
    "fulfilment_stage_times": fulfilment_stage_times,
    "operations_kpis": operations_kpis,
    "operations_kpis_monthly": operations_kpis_monthly,
}
