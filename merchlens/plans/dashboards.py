"""Dashboard tables and the calculations made on top of them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from merchlens.functions import metrics as m
from merchlens.functions.numbers import cents, count_when, exact_ratio, mean_money, money, percent
from merchlens.functions.quantiles import with_twice_median
from merchlens.plans.model import CATEGORY, SalesModel, named_states, order_facts
from merchlens.plans.regional import SMALL_SAMPLE, _all, _late_vs_national, mean_days, tiered_states, tiers


# ------------------------------------------------------------------ dashboard tables


def sales_dashboard(model: SalesModel) -> DataFrame:
    """One row per order item, plus one row per order without items.

    Written as an inner join and an anti join instead of a left join from the orders: in a left join Spark cannot
    split an order that holds a large share of the items.
    """
    def headed(orders: DataFrame) -> DataFrame:
        return model.placed(orders).join(named_states(model), "customer_state", "left").select(
            "order_id",
            "customer_unique_id",
            "customer_state",
            "state_name",
            "macro_region",
            "order_status",
            F.to_date(m.PURCHASED).alias("order_purchase_date"),
            m.purchase_month().alias("order_month"),
            model.calendar.in_trend().alias("in_trend_window"),
            m.earns_revenue().alias("is_revenue_order"),
        )

    items = model.order_items.select("order_id", "order_item_id", "product_id", "price", "freight_value")
    catalogue = model.products.select("product_id", F.col(CATEGORY).alias("product_category"))
    sold = items.join(headed(model.order_headers), "order_id").join(catalogue, "product_id", "left")
    bare = headed(model.bare(model.order_headers))
    whole = sold.drop("product_id").unionByName(bare, allowMissingColumns=True)
    item_value = F.col("price") + F.col("freight_value")
    return whole.select(
        "order_id",
        "order_item_id",
        "customer_unique_id",
        "customer_state",
        "state_name",
        "macro_region",
        "order_status",
        "order_purchase_date",
        "order_month",
        "in_trend_window",
        "is_revenue_order",
        "product_category",
        "price",
        "freight_value",
        item_value.alias("item_value"),
        F.when(F.col("is_revenue_order"), item_value).alias("revenue"),
    )


def _two_decimals(name: str) -> Column:
    return F.round(F.col(name).cast("decimal(26,12)"), 2).cast("decimal(20,2)")


# The columns of the operations dashboard in order.
OPERATIONS_COLUMNS = (
    "order_id", "customer_unique_id", "customer_state", "state_name", "macro_region", "order_status",
    "order_purchase_date", "order_month", "in_trend_window", "primary_category", "item_count", "freight_value",
    "revenue", "is_revenue_order", "is_canceled", "is_unavailable", "is_measurable_delivery", "is_late",
    "delivery_outcome", "timeliness_bucket", "delivery_days", "estimated_days", "days_vs_estimate",
    "approval_hours", "seller_handoff_days", "carrier_transit_days", "has_invalid_dates",
)
# Columns of the dashboard that are derived from another column of the facts.
DERIVED_FROM = {"delivery_outcome": "is_late", "timeliness_bucket": "days_vs_estimate"}


def operations_dashboard(facts: DataFrame) -> DataFrame:
    """One row per order: outcome, timeliness, durations and freight, as far as the facts hold them."""
    outcome = F.when(F.col("is_late"), "Late").when(~F.col("is_late"), "On time")
    special = {
        "freight_value": money(F.col("freight_value")),
        "revenue": money(F.col("revenue")),
        "delivery_outcome": outcome,
        "timeliness_bucket": m.timeliness_label(F.col("days_vs_estimate")),
        **{
            name: _two_decimals(name)
            for name in (
                "delivery_days", "estimated_days", "approval_hours", "seller_handoff_days", "carrier_transit_days"
            )
        },
    }
    present = set(facts.columns)
    return facts.select(
        *[
            special.get(name, F.col(name)).alias(name)
            for name in OPERATIONS_COLUMNS
            if DERIVED_FROM.get(name, name) in present
        ]
    )


def operations_view(model: SalesModel, *columns: str) -> DataFrame:
    """Selected columns of the operations dashboard straight from the tables, joining only what they need."""
    view = operations_dashboard(order_facts(model, {DERIVED_FROM.get(name, name) for name in columns}))
    return view.select(*columns)


def regional_dashboard(model: SalesModel, small_sample: int = SMALL_SAMPLE) -> DataFrame:
    """One row per state: totals, national comparison and segment."""
    tier = tiers()
    return (
        tiered_states(model)
        .join(named_states(model), "customer_state", "left")
        .select(
            "customer_state",
            "state_name",
            "macro_region",
            money(F.col("revenue")).alias("revenue"),
            percent(cents("revenue"), cents(_all("revenue"))).alias("revenue_share_pct"),
            F.rank().over(Window.orderBy(F.desc_nulls_first("revenue"))).alias("revenue_rank"),
            "revenue_orders",
            "customers",
            mean_money(cents("revenue"), F.col("valued_orders")).alias("avg_order_value"),
            mean_money(cents("freight"), F.col("freight_orders")).alias("avg_freight_per_order"),
            "delivered_orders",
            "late_orders",
            percent(F.col("late_orders"), F.col("delivered_orders")).alias("late_pct"),
            percent(_all("late_orders"), _all("delivered_orders")).alias("national_late_pct"),
            _late_vs_national().alias("late_pct_vs_national_pp"),
            mean_days(F.col("micros"), F.col("delivered_orders")).alias("avg_delivery_days"),
            mean_days(_all("micros"), _all("delivered_orders")).alias("national_avg_delivery_days"),
            money(F.coalesce("late_revenue", F.lit(0))).alias("late_order_revenue"),
            tier.revenue.alias("revenue_tier"),
            tier.delivery.alias("delivery_tier"),
            tier.segment.alias("segment"),
            (F.col("delivered_orders") < small_sample).alias("small_sample"),
        )
    )


# ------------------------------------------------------------------ filters


@dataclass(frozen=True)
class DashboardFilter:
    """Viewer selections; an unset field filters nothing. Date bounds are inclusive."""

    first_date: str | None = None
    last_date: str | None = None
    states: Sequence[str] | None = None
    categories: Sequence[str] | None = None
    statuses: Sequence[str] | None = None
    trend_only: bool = False

    def apply(self, data: DataFrame) -> DataFrame:
        category = "product_category" if "product_category" in data.columns else "primary_category"
        if self.first_date is not None:
            data = data.where(F.col("order_purchase_date") >= F.lit(self.first_date).cast("date"))
        if self.last_date is not None:
            data = data.where(F.col("order_purchase_date") <= F.lit(self.last_date).cast("date"))
        for column, allowed in (
            ("state_name", self.states), (category, self.categories), ("order_status", self.statuses)
        ):
            if allowed is not None:
                data = data.where(F.col(column).isin(*allowed))
        return data.where(F.col("in_trend_window")) if self.trend_only else data


NO_FILTER = DashboardFilter()


# ------------------------------------------------------------------ sales calculations


def sales_kpis(
    dashboard: DataFrame, by: Sequence[str] = (), selection: DashboardFilter = NO_FILTER
) -> DataFrame:
    """Revenue, orders, revenue orders, average order value and customers for any grouping and filter.

    Items collapse to one row per order and then to one row per person, so no distinct aggregate has to expand
    the item rows.
    """
    keys = list(by)
    per_order = (
        selection.apply(dashboard)
        .groupBy(*keys, "order_id")
        .agg(F.sum("revenue").alias("revenue"), F.max("customer_unique_id").alias("person"))
    )
    per_person = per_order.groupBy(*keys, "person").agg(
        F.sum("revenue").alias("revenue"),
        F.count(F.lit(1)).alias("orders"),
        F.count("revenue").alias("revenue_orders"),
    )
    result = per_person.groupBy(*keys).agg(
        money(F.sum("revenue")).alias("total_revenue"),
        F.coalesce(F.sum("orders"), F.lit(0)).alias("total_orders"),
        F.coalesce(F.sum("revenue_orders"), F.lit(0)).alias("revenue_orders"),
        mean_money(cents(F.sum("revenue")), F.sum("revenue_orders")).alias("average_order_value"),
        F.count("person").alias("total_customers"),
    )
    return result.orderBy(*keys) if keys else result


def month_over_month(dashboard: DataFrame, selection: DashboardFilter = NO_FILTER) -> DataFrame:
    """Revenue per month with its change in percent of the absolute previous value."""
    monthly = selection.apply(dashboard).groupBy("order_month").agg(F.sum("revenue").alias("revenue"))
    previous = F.lag("revenue").over(Window.orderBy("order_month"))
    return (
        monthly.withColumn("previous", previous)
        .select(
            "order_month",
            money(F.col("revenue")).alias("revenue"),
            percent(cents(F.col("revenue") - F.col("previous")), F.abs(cents("previous"))).alias("mom_revenue_pct"),
        )
        .orderBy("order_month")
    )


def top_categories_by_revenue(
    dashboard: DataFrame, places: int = 10, selection: DashboardFilter = NO_FILTER
) -> DataFrame:
    """Exactly `places` categories by revenue with their share; ties go to the first name."""
    return category_shares(dashboard, selection).orderBy(F.desc_nulls_last("revenue"), "product_category").limit(places)


def category_shares(dashboard: DataFrame, selection: DashboardFilter = NO_FILTER) -> DataFrame:
    """Revenue and percent of total per category."""
    grouped = (
        selection.apply(dashboard)
        .where(F.col("product_category").isNotNull())
        .groupBy("product_category")
        .agg(F.sum("revenue").alias("revenue"))
    )
    return grouped.select(
        "product_category",
        money(F.col("revenue")).alias("revenue"),
        percent(cents("revenue"), cents(_all("revenue"))).alias("pct_of_total"),
    )


# ------------------------------------------------------------------ operations calculations


def _late_share() -> Column:
    return percent(count_when(F.col("is_late")), count_when(F.col("is_measurable_delivery")))


def _mean_two_decimals(name: str) -> Column:
    return exact_ratio(cents(F.sum(name)), F.count(name) * 100)


def operations_kpi_tiles(
    dashboard: DataFrame, by: Sequence[str] = (), selection: DashboardFilter = NO_FILTER
) -> DataFrame:
    """Orders, durations, late and cancellation rates and freight for any grouping and filter."""
    keys = list(by)
    freight = F.when(F.col("is_revenue_order"), F.col("freight_value"))
    result = selection.apply(dashboard).groupBy(*keys).agg(
        F.count("order_id").alias("orders"),
        _mean_two_decimals("delivery_days").alias("avg_delivery_days"),
        _mean_two_decimals("estimated_days").alias("avg_estimated_days"),
        _late_share().alias("late_delivery_pct"),
        percent(count_when(F.col("is_canceled")), F.count("order_id")).alias("cancellation_pct"),
        mean_money(cents(F.sum(freight)), F.count(freight)).alias("avg_freight_per_order"),
        count_when(F.col("is_measurable_delivery")).alias("delivered_orders"),
    )
    return result.orderBy(*keys) if keys else result


def late_rate_against_national(
    dashboard: DataFrame,
    by: str,
    selection: DashboardFilter = NO_FILTER,
    min_delivered: int = 0,
    places: int | None = None,
) -> DataFrame:
    """Late rate per group of the selection, next to the national rate of all orders.

    The national rate ignores the selection and is compared unrounded.
    """
    late, measured = count_when(F.col("is_late")), count_when(F.col("is_measurable_delivery"))
    national = dashboard.agg(late.alias("all_late"), measured.alias("all_measured"))
    grouped = (
        selection.apply(dashboard)
        .groupBy(by)
        .agg(measured.alias("delivered_orders"), late.alias("late_orders"))
        .where(F.col("delivered_orders") >= min_delivered)
    )
    compared = grouped.crossJoin(F.broadcast(national)).select(
        by,
        "delivered_orders",
        "late_orders",
        percent(F.col("late_orders"), F.col("delivered_orders")).alias("late_delivery_pct"),
        percent(F.col("all_late"), F.col("all_measured")).alias("national_late_pct"),
        (F.col("late_orders") * F.col("all_measured") > F.col("all_late") * F.col("delivered_orders")).alias(
            "above_national"
        ),
    )
    ordered = compared.orderBy(F.desc_nulls_last("late_delivery_pct"), by)
    return ordered.limit(places) if places is not None else ordered


def status_distribution(dashboard: DataFrame, selection: DashboardFilter = NO_FILTER) -> DataFrame:
    """Orders and percent of total per status."""
    grouped = selection.apply(dashboard).groupBy("order_status").agg(F.count(F.lit(1)).alias("orders"))
    return grouped.select(
        "order_status", "orders", percent(F.col("orders"), _all("orders")).alias("pct_of_orders")
    ).orderBy(F.desc("orders"), "order_status")


def timeliness_by_outcome(dashboard: DataFrame, selection: DashboardFilter = NO_FILTER) -> DataFrame:
    """Deliveries per timeliness bucket and outcome with percent of total."""
    grouped = (
        selection.apply(dashboard)
        .where(F.col("timeliness_bucket").isNotNull())
        .groupBy("timeliness_bucket", "delivery_outcome")
        .agg(F.count(F.lit(1)).alias("orders"))
    )
    return grouped.select(
        "timeliness_bucket",
        "delivery_outcome",
        "orders",
        percent(F.col("orders"), _all("orders")).alias("pct_of_delivered"),
    ).orderBy("timeliness_bucket")


# ------------------------------------------------------------------ regional and quality pages


def state_scorecard(regional: DataFrame) -> DataFrame:
    """State figures with the national reference lines and the median state revenue."""
    return with_twice_median(regional, cents("revenue"), "median_doubled").select(
        "customer_state",
        "state_name",
        "revenue",
        "revenue_orders",
        "late_pct",
        "avg_delivery_days",
        "delivery_tier",
        "segment",
        "small_sample",
        "national_late_pct",
        "national_avg_delivery_days",
        exact_ratio(F.col("median_doubled"), F.lit(200)).alias("median_state_revenue"),
    ).orderBy(F.desc_nulls_first("revenue"), "customer_state")


def quality_tiles(summary: DataFrame) -> DataFrame:
    """Data-quality headline tiles in one row."""
    status, category, severity = F.col("status"), F.col("check_category"), F.col("severity")
    failed = count_when(status == "FAIL")

    def records(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("record_count")))

    return summary.agg(
        count_when(status == "PASS").alias("checks_passed"),
        count_when(status == "WARNING").alias("warnings"),
        failed.alias("failed_checks"),
        records((category == "Missing values") & (severity != "info")).alias("missing_records"),
        records(category == "Duplicate records").alias("duplicate_records"),
        records(category.isin("Invalid values", "Invalid dates")).alias("invalid_records"),
        F.when(failed > 0, "FAILED").otherwise("PASSED").alias("validation_status"),
    )


def checks_by_category_and_status(summary: DataFrame) -> DataFrame:
    """Number of checks per category, one column per status."""
    statuses = ("PASS", "INFO", "WARNING", "FAIL")
    counted = summary.groupBy("check_category").pivot("status", list(statuses)).count()
    return counted.select(
        "check_category", *[F.coalesce(s, F.lit(0).cast("bigint")).alias(f"{s.lower()}_checks") for s in statuses]
    ).orderBy("check_category")


def check_detail(summary: DataFrame, with_passed: bool = False) -> DataFrame:
    """Check list, issues only unless the passed ones are asked for."""
    shown = summary if with_passed else summary.where(F.col("status") != "PASS")
    return shown.select(
        "check_category", "table_name", "check_name", "status", "record_count", "pct_of_records"
    ).orderBy("check_category", "table_name", "check_name")
