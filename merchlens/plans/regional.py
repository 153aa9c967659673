"""State and macro-region metrics, all derived from one row of totals per state."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from merchlens.functions import metrics as m
from merchlens.functions.dates import micros_between
from merchlens.functions.numbers import (
    MICROS_PER_DAY,
    WHOLE,
    cents,
    count_when,
    exact_ratio,
    mean_days,
    mean_money,
    money,
    percent,
    sum_when,
)
from merchlens.functions.quantiles import with_twice_median
from merchlens.plans.model import SalesModel, named_states

SMALL_SAMPLE = 100

TOTALS = (
    "orders", "revenue_orders", "revenue", "valued_orders", "freight", "freight_orders",
    "delivered_orders", "late_orders", "micros", "late_revenue",
)


def state_totals(model: SalesModel) -> DataFrame:
    """One row per customer state.

    Orders are totalled per customer id, then per person, then per state: the customer join meets one row per
    customer however many orders they hold, and people are counted without a distinct aggregate.
    """
    measurable = m.measurable_delivery()
    late = measurable & m.arrived_late()
    earned, freight = (F.when(m.earns_revenue(), F.col(c)) for c in ("order_value", "freight_value"))
    per_customer = model.per_customer(
        model.valued(model.order_deliveries, "left"),
        F.count(F.lit(1)).alias("orders"),
        count_when(m.earns_revenue()).alias("revenue_orders"),
        F.sum(earned).alias("revenue"),
        F.count(earned).alias("valued_orders"),
        F.sum(freight).alias("freight"),
        F.count(freight).alias("freight_orders"),
        count_when(measurable).alias("delivered_orders"),
        count_when(late).alias("late_orders"),
        sum_when(measurable, micros_between(m.PURCHASED, m.RECEIVED)).alias("micros"),
        sum_when(late, F.col("order_value")).alias("late_revenue"),
    )
    sums = [F.sum(name).alias(name) for name in TOTALS]
    return (
        per_customer.groupBy("customer_state", "customer_unique_id")
        .agg(*sums)
        .groupBy("customer_state")
        .agg(*sums, F.count("customer_unique_id").alias("customers"))
    )


def _all(name: str) -> Column:
    return F.sum(name).over(Window.partitionBy())


def _late_vs_national() -> Column:
    """State late % minus national late %, both unrounded."""
    late, delivered = F.col("late_orders").cast(WHOLE), F.col("delivered_orders").cast(WHOLE)
    return exact_ratio(
        (late * _all("delivered_orders") - _all("late_orders") * delivered) * 100,
        delivered * _all("delivered_orders"),
    )


def _above_national() -> Column:
    """late / delivered > national late / national delivered, by cross-multiplication."""
    late, delivered = F.col("late_orders").cast(WHOLE), F.col("delivered_orders").cast(WHOLE)
    return (delivered > 0) & (late * _all("delivered_orders") > _all("late_orders") * delivered)


def _revenue_order() -> list[Column]:
    return [F.desc_nulls_first("revenue"), F.asc("customer_state")]


def state_performance(model: SalesModel, small_sample: int = SMALL_SAMPLE) -> DataFrame:
    """Sales and delivery per state against the national figures."""
    ranked = Window.orderBy(F.desc_nulls_first("revenue"))
    revenue, valued = cents("revenue"), F.col("valued_orders").cast(WHOLE)
    all_revenue, all_valued = cents(_all("revenue")), _all("valued_orders").cast(WHOLE)
    micros, measured = F.col("micros").cast(WHOLE), F.col("delivered_orders").cast(WHOLE)
    all_micros, all_measured = _all("micros").cast(WHOLE), _all("delivered_orders").cast(WHOLE)
    return (
        state_totals(model)
        .select(
            "customer_state",
            F.rank().over(ranked).alias("revenue_rank"),
            money(F.col("revenue")).alias("revenue"),
            percent(revenue, all_revenue).alias("revenue_share_pct"),
            "revenue_orders",
            "customers",
            mean_money(revenue, valued).alias("avg_order_value"),
            exact_ratio(revenue * all_valued - all_revenue * valued, valued * all_valued * 100).alias(
                "aov_vs_national"
            ),
            mean_money(cents("freight"), F.col("freight_orders")).alias("avg_freight_per_order"),
            "delivered_orders",
            "late_orders",
            percent(F.col("late_orders"), F.col("delivered_orders")).alias("late_pct"),
            _late_vs_national().alias("late_pct_vs_national_pp"),
            mean_days(micros, measured).alias("avg_delivery_days"),
            exact_ratio(
                micros * all_measured - all_micros * measured, measured * all_measured * F.lit(MICROS_PER_DAY)
            ).alias("delivery_days_vs_national"),
            money(F.coalesce("late_revenue", F.lit(0))).alias("late_order_revenue"),
            (F.col("delivered_orders") < small_sample).alias("small_sample"),
        )
        .orderBy(*_revenue_order())
    )


@dataclass(frozen=True)
class Tiers:
    """Labels of the two-way segmentation, over the window of all states."""

    revenue: Column
    delivery: Column
    segment: Column
    median_doubled: Column


def tiered_states(model: SalesModel) -> DataFrame:
    """The state totals with what `tiers` compares them with."""
    return with_twice_median(state_totals(model), cents("revenue"), "median_doubled")


def tiers() -> Tiers:
    """Revenue at or above the median state, and late rate above the national one; unknown counts as below.

    To be selected from `tiered_states`.
    """
    median_doubled = F.col("median_doubled")
    higher = cents("revenue") * 2 >= median_doubled
    # Tier and segment labels.
    revenue = F.when(higher, "Higher revenue").otherwise("Lower revenue")
    delivery = F.when(_above_national(), "Late rate above national").otherwise("Late rate at/below national")
    in_segment = F.when(_above_national(), "late rate above national").otherwise("late rate at/below national")
    return Tiers(revenue, delivery, F.concat(revenue, F.lit(" / "), in_segment), median_doubled)


def state_segments(model: SalesModel, small_sample: int = SMALL_SAMPLE) -> DataFrame:
    """Each state's revenue tier, delivery tier and segment."""
    tier = tiers()
    return (
        tiered_states(model)
        .select(
            "customer_state",
            money(F.col("revenue")).alias("revenue"),
            exact_ratio(tier.median_doubled, F.lit(200)).alias("median_state_revenue"),
            percent(F.col("late_orders"), F.col("delivered_orders")).alias("late_pct"),
            percent(_all("late_orders"), _all("delivered_orders")).alias("national_late_pct"),
            tier.revenue.alias("revenue_tier"),
            tier.delivery.alias("delivery_tier"),
            tier.segment.alias("segment"),
            (F.col("delivered_orders") < small_sample).alias("small_sample"),
        )
        .orderBy("segment", *_revenue_order())
    )


def segment_summary(model: SalesModel) -> DataFrame:
    """Revenue and late orders per segment; the state list is ordered by revenue."""
    listed = "listagg(customer_state, ', ') WITHIN GROUP (ORDER BY revenue DESC, customer_state)"
    grouped = (
        tiered_states(model)
        .select("*", tiers().segment.alias("segment"))
        .groupBy("segment")
        .agg(
            F.count(F.lit(1)).alias("states"),
            F.expr(listed).alias("state_list"),
            F.sum("revenue").alias("revenue"),
            F.sum("revenue_orders").alias("revenue_orders"),
            F.sum("late_orders").alias("late_orders"),
            F.sum("delivered_orders").alias("delivered_orders"),
        )
    )
    return grouped.select(
        "segment",
        "states",
        "state_list",
        money(F.col("revenue")).alias("revenue"),
        percent(cents("revenue"), cents(_all("revenue"))).alias("revenue_share_pct"),
        "revenue_orders",
        "late_orders",
        percent(F.col("late_orders"), _all("late_orders")).alias("share_of_all_late_orders_pct"),
        percent(F.col("late_orders"), F.col("delivered_orders")).alias("segment_late_pct"),
    ).orderBy(F.desc_nulls_first("revenue"), "segment")


def region_totals(model: SalesModel) -> DataFrame:
    """State totals added up per macro-region; states outside the reference have no region."""
    regions = named_states(model).select("customer_state", "macro_region")
    return (
        state_totals(model)
        .join(regions, "customer_state", "left")
        .groupBy("macro_region")
        .agg(*[F.sum(name).alias(name) for name in (*TOTALS, "customers")])
    )


def macro_region_performance(model: SalesModel) -> DataFrame:
    """Revenue, order value and delivery per macro-region."""
    return (
        region_totals(model)
        .select(
            "macro_region",
            money(F.col("revenue")).alias("revenue"),
            percent(cents("revenue"), cents(_all("revenue"))).alias("revenue_share_pct"),
            "revenue_orders",
            mean_money(cents("revenue"), F.col("valued_orders")).alias("avg_order_value"),
            percent(F.col("late_orders"), F.col("delivered_orders")).alias("late_pct"),
            mean_days(F.col("micros"), F.col("delivered_orders")).alias("avg_delivery_days"),
        )
        .orderBy(F.desc_nulls_first("revenue"), "macro_region")
    )


REPORTS = {
    "state_performance": state_performance,
    "state_segments": state_segments,
    "segment_summary": segment_summary,
    "macro_region_performance": macro_region_performance,
}
