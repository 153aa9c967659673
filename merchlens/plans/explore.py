"""Exploratory and narrative metrics on top of the dashboards."""

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
from merchlens.plans.dashboards import operations_view
from merchlens.plans.model import SalesModel
from merchlens.plans.regional import region_totals, state_totals
from merchlens.plans.sales import _revenue_orders
from merchlens.sources.clean_store import row_counts


def table_row_counts(model: SalesModel) -> DataFrame:
    """Rows per table."""
    return row_counts(model.tables())


def coverage(model: SalesModel) -> DataFrame:
    """First and last purchase day, orders, people and revenue; orders collapse to people before the last step."""
    view = operations_view(model, "order_purchase_date", "customer_unique_id", "revenue")
    per_person = view.groupBy("customer_unique_id").agg(
        F.min("order_purchase_date").alias("first"),
        F.max("order_purchase_date").alias("last"),
        F.count(F.lit(1)).alias("orders"),
        F.sum("revenue").alias("revenue"),
    )
    return per_person.agg(
        F.min("first").alias("first_order"),
        F.max("last").alias("last_order"),
        F.coalesce(F.sum("orders"), F.lit(0)).alias("orders"),
        F.count("customer_unique_id").alias("customers"),
        money(F.sum("revenue")).alias("revenue"),
    )


def monthly_revenue_orders(model: SalesModel) -> DataFrame:
    """Revenue and orders with revenue per month of the trend window."""
    return (
        operations_view(model, "order_month", "in_trend_window", "revenue")
        .where("in_trend_window")
        .groupBy("order_month")
        .agg(money(F.sum("revenue")).alias("revenue"), F.count("revenue").alias("revenue_orders"))
        .orderBy("order_month")
    )


def peak_month(model: SalesModel) -> DataFrame:
    """The month with the most revenue; of equals the first."""
    monthly = monthly_revenue_orders(model)
    best = F.min_by(F.struct("order_month", "revenue", "revenue_orders"), F.struct(-F.col("revenue"), "order_month"))
    return monthly.agg(best.alias("best")).select("best.*")


def _compared_years(model: SalesModel) -> tuple[Column, Column]:
    calendar = model.calendar
    same_months = F.month("order_month") <= calendar.last_compared_month
    year = F.year("order_month")
    return same_months & (year == calendar.base_year), same_months & (year == calendar.compare_year)


def year_over_year(model: SalesModel) -> DataFrame:
    """Revenue, revenue orders and order value of the same months in two years, one row per metric."""
    base, compared = _compared_years(model)
    revenue, orders = cents("revenue"), F.col("revenue_orders").cast(WHOLE)
    sums = monthly_revenue_orders(model).agg(
        sum_when(base, revenue).alias("r0"),
        sum_when(compared, revenue).alias("r1"),
        sum_when(base, orders).alias("o0"),
        sum_when(compared, orders).alias("o1"),
    )
    r0, r1, o0, o1 = (F.col(c).cast(WHOLE) for c in ("r0", "r1", "o0", "o1"))

    def line(metric: str, before: Column, after: Column, change: Column) -> Column:
        return F.struct(
            F.lit(metric).alias("metric"),
            before.alias("base_period"),
            after.alias("compare_period"),
            change.alias("change_pct"),
        )

    one = F.lit(1)
    return sums.select(
        F.inline(
            F.array(
                line("revenue", mean_money(r0, one), mean_money(r1, one), percent(r1 - r0, r0)),
                line("revenue_orders", exact_ratio(o0, one), exact_ratio(o1, one), percent(o1 - o0, o0)),
                line("avg_order_value", mean_money(r0, o0), mean_money(r1, o1), percent(r1 * o0 - r0 * o1, r0 * o1)),
            )
        )
    )


def orders_year_over_year(model: SalesModel) -> DataFrame:
    """Orders placed in the same months of two years, every status."""
    base, compared = _compared_years(model)
    months = model.order_headers.select(m.purchase_month().alias("order_month"))
    return months.agg(count_when(base).alias("base_orders"), count_when(compared).alias("compare_orders")).select(
        "base_orders",
        "compare_orders",
        percent(F.col("compare_orders") - F.col("base_orders"), F.col("base_orders")).alias("change_pct"),
    )


def top_category_concentration(shares: DataFrame, places: int = 10) -> DataFrame:
    """Number of categories and the combined share of the largest ones."""
    place = F.row_number().over(Window.orderBy(F.desc_nulls_last("revenue"), "product_category"))
    return shares.withColumn("place", place).agg(
        F.count(F.lit(1)).alias("categories"),
        money(sum_when(F.col("place") <= places, F.col("revenue"))).alias("top_revenue"),
        percent(sum_when(F.col("place") <= places, cents("revenue")), F.sum(cents("revenue"))).alias("top_share_pct"),
    )


def top_states_share(regional: DataFrame, places: int = 3) -> DataFrame:
    """Combined revenue share of the largest states, from the rounded shares on the dashboard."""
    place = F.row_number().over(Window.orderBy(F.desc_nulls_first("revenue"), "customer_state"))
    top = regional.withColumn("place", place).where(F.col("place") <= places)
    return top.agg(
        F.expr("listagg(customer_state, ', ') WITHIN GROUP (ORDER BY place)").alias("states"),
        F.sum("revenue_share_pct").cast("decimal(20,2)").alias("revenue_share_pct"),
    )


def early_and_late_share(model: SalesModel) -> DataFrame:
    """Share of deliveries before the promised day and after it."""
    gap = F.col("days_vs_estimate")
    everything = F.count("days_vs_estimate")
    return operations_view(model, "days_vs_estimate").agg(
        everything.alias("delivered_orders"),
        percent(count_when(gap < 0), everything).alias("early_pct"),
        percent(count_when(gap > 0), everything).alias("late_pct"),
    )


def worst_months(late_by_month: DataFrame, places: int = 3) -> DataFrame:
    """Months with the highest late rate; of equals the first."""
    return (
        late_by_month.select("order_month", "delivered_orders", "late_pct")
        .orderBy(F.desc("late_pct"), "order_month")
        .limit(places)
    )


def stage_means_from_view(view: DataFrame) -> DataFrame:
    """Mean stage durations in days per outcome, taken over the dashboard's rounded values."""
    def mean(name: str, per_day: int) -> Column:
        return exact_ratio(cents(F.sum(name)), F.count(name) * (100 * per_day), 6)

    return (
        view.where("is_measurable_delivery")
        .groupBy("delivery_outcome")
        .agg(
            mean("approval_hours", 24).alias("approval_days"),
            mean("seller_handoff_days", 1).alias("seller_handoff_days"),
            mean("carrier_transit_days", 1).alias("carrier_transit_days"),
        )
        .orderBy("delivery_outcome")
    )


def segment_rollup(regional: DataFrame) -> DataFrame:
    """Segments of the regional dashboard with their share of revenue and of late orders."""
    listed = "listagg(customer_state, ', ') WITHIN GROUP (ORDER BY revenue DESC, customer_state)"
    grouped = regional.groupBy("segment").agg(
        F.count(F.lit(1)).alias("states"),
        F.expr(listed).alias("state_list"),
        F.sum("revenue_share_pct").cast("decimal(20,2)").alias("revenue_share_pct"),
        F.sum("late_orders").alias("late"),
    )
    return grouped.select(
        "segment",
        "states",
        "state_list",
        "revenue_share_pct",
        percent(F.col("late"), F.sum("late").over(Window.partitionBy())).alias("share_of_late_orders_pct"),
    ).orderBy(F.desc("revenue_share_pct"), "segment")


def repeat_customers(model: SalesModel) -> DataFrame:
    """People, and how many of them ordered more than once."""
    per_person = operations_view(model, "customer_unique_id").groupBy("customer_unique_id").agg(
        F.count(F.lit(1)).alias("orders")
    )
    everyone, repeaters = F.count(F.lit(1)), count_when(F.col("orders") > 1)
    return per_person.agg(
        everyone.alias("customers"),
        repeaters.alias("repeat_customers"),
        percent(repeaters, everyone).alias("repeat_pct"),
    )


# ------------------------------------------------------------------ figures of the written report


def best_day(model: SalesModel) -> DataFrame:
    """The day with the most revenue against the next best one."""
    daily = (
        _revenue_orders(model)
        .groupBy(F.to_date(m.PURCHASED).alias("day"))
        .agg(F.count(F.lit(1)).alias("orders"), F.sum("order_value").alias("revenue"))
    )
    ranking = Window.orderBy(F.desc("revenue"), "day")
    return (
        daily.select(
            "day",
            "orders",
            "revenue",
            F.row_number().over(ranking).alias("place"),
            F.lead("revenue").over(ranking).alias("next_revenue"),
        )
        .where(F.col("place") == 1)
        .select(
            "day",
            "orders",
            money(F.col("revenue")).alias("revenue"),
            exact_ratio(cents("revenue"), cents("next_revenue")).alias("times_next_best"),
        )
    )


def decline_from_peak(model: SalesModel) -> DataFrame:
    """Latest month of the compared year against that year's best month."""
    months = monthly_revenue_orders(model).where(F.year("order_month") == model.calendar.compare_year)
    first_best = F.struct((-F.col("revenue")).alias("v"), F.col("order_month").alias("at"))
    ends = months.agg(
        F.min_by("order_month", first_best).alias("peak_month"),
        F.max("revenue").alias("peak_revenue"),
        F.max("order_month").alias("latest_month"),
        F.max_by("revenue", "order_month").alias("latest_revenue"),
    )
    return ends.select(
        "peak_month",
        money(F.col("peak_revenue")).alias("peak_revenue"),
        "latest_month",
        money(F.col("latest_revenue")).alias("latest_revenue"),
        percent(cents("latest_revenue") - cents("peak_revenue"), cents("peak_revenue")).alias("change_pct"),
    )


def region_freight(model: SalesModel) -> DataFrame:
    """Freight per order and against revenue per macro-region."""
    return (
        region_totals(model)
        .select(
            "macro_region",
            mean_money(cents("freight"), F.col("freight_orders")).alias("avg_freight_per_order"),
            percent(cents("freight"), cents("revenue")).alias("freight_pct_of_revenue"),
        )
        .orderBy("macro_region")
    )


def revenue_exposed_to_lateness(model: SalesModel) -> DataFrame:
    """Revenue of late orders and its share of the revenue of measurable deliveries."""
    view = operations_view(model, "revenue", "is_late", "is_measurable_delivery")
    late = sum_when(F.col("is_late"), F.col("revenue"))
    return view.agg(
        money(late).alias("late_order_revenue"),
        percent(cents(late), cents(sum_when(F.col("is_measurable_delivery"), F.col("revenue")))).alias(
            "pct_of_delivered_revenue"
        ),
    )


def state_late_shares(model: SalesModel) -> DataFrame:
    """Each state's share of all late orders."""
    late = F.col("late_orders")
    return (
        state_totals(model)
        .select("customer_state", "late_orders", percent(late, F.sum(late).over(Window.partitionBy())).alias("share_pct"))
        .orderBy(F.desc("late_orders"), "customer_state")
    )


def region_value_premium(model: SalesModel, base_region: str = "Southeast") -> DataFrame:
    """Average order value of each macro-region against a base region, in percent."""
    regions = region_totals(model).select("macro_region", cents("revenue").alias("r"), "valued_orders")
    is_base = F.col("macro_region") == base_region
    # One row in any case; without the base region the premiums are NULL.
    base = regions.agg(F.max(F.when(is_base, F.col("r"))).alias("base_r"), F.max(F.when(is_base, F.col("valued_orders"))).alias("base_n"))
    n, base_n = F.col("valued_orders").cast(WHOLE), F.col("base_n").cast(WHOLE)
    return (
        regions.crossJoin(F.broadcast(base))
        .select(
            "macro_region",
            mean_money(F.col("r"), n).alias("avg_order_value"),
            percent(F.col("r") * base_n - F.col("base_r") * n, F.col("base_r") * n).alias("premium_pct"),
        )
        .orderBy("macro_region")
    )


def undelivered_in_latest_month(model: SalesModel) -> DataFrame:
    """Orders of the last trend month that are not delivered."""
    per_month = (
        model.order_headers.where(model.in_trend())
        .groupBy(m.purchase_month().alias("order_month"))
        .agg(
            F.count(F.lit(1)).alias("orders"),
            count_when(~m.has_status(m.DELIVERED)).alias("undelivered"),
        )
    )
    latest = per_month.agg(F.max_by(F.struct("*"), "order_month").alias("latest")).select("latest.*")
    return latest.select("*", percent(F.col("undelivered"), F.col("orders")).alias("undelivered_pct"))


def orders_across_categories(model: SalesModel) -> DataFrame:
    """Orders whose items belong to more than one category."""
    per_order = model.order_categories().groupBy("order_id").agg(
        F.count("product_category").alias("categories")
    )
    everything, mixed = F.count(F.lit(1)), count_when(F.col("categories") > 1)
    return per_order.agg(
        everything.alias("orders"), mixed.alias("multi_category_orders"), percent(mixed, everything).alias("pct")
    )
