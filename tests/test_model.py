"""Order facts, exact statistics and the figures that must agree with each other."""

from __future__ import annotations

import random
from decimal import Decimal

import pytest
from conftest import one
from pyspark.sql import functions as F

from merchlens.functions import metrics as m
from merchlens.functions.numbers import exact_ratio, percent
from merchlens.functions.quantiles import exact_distribution, quantile_value
from merchlens.operators.quality import data_quality_summary
from merchlens.plans import dashboards as d
from merchlens.plans import operations, regional, sales
from merchlens.plans.model import SalesModel, order_facts, primary_category
from merchlens.sources.schemas import CLEAN_SCHEMAS
from merchlens.sources.states import state_reference


def scalar(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


@pytest.mark.parametrize(
    ("num", "den", "expected"),
    [
        (1, 8, "0.13"), (-1, 8, "-0.13"), (1, -8, "-0.13"), (1, 3, "0.33"), (2, 3, "0.67"), (0, 5, "0.00"),
        (1005, 1000, "1.01"), (10**30, 3 * 10**20, "3333333333.33"), (5, 0, None),
    ],
)
def test_exact_ratio_rounds_once_half_away_from_zero(spark, num, den, expected):
    column = exact_ratio(F.lit(str(num)).cast("decimal(38,0)"), F.lit(str(den)).cast("decimal(38,0)"))
    assert scalar(spark, column) == (None if expected is None else Decimal(expected))


def test_percent_of_nothing_is_unknown(spark):
    assert scalar(spark, percent(F.lit(0), F.lit(0))) is None


@pytest.mark.parametrize(
    ("gap", "label"),
    [
        (-15, "1. More than 14 days early"), (-14, "2. 8-14 days early"), (-8, "2. 8-14 days early"),
        (-7, "3. 1-7 days early"), (-1, "3. 1-7 days early"), (0, "4. On estimated day"), (1, "5. 1-3 days late"),
        (3, "5. 1-3 days late"), (4, "6. 4-7 days late"), (7, "6. 4-7 days late"), (8, "7. More than 7 days late"),
        (None, None),
    ],
)
def test_timeliness_labels(spark, gap, label):
    assert scalar(spark, m.timeliness_label(F.lit(gap).cast("int"))) == label


@pytest.mark.parametrize("size", [0, 1, 2, 11, 1000])
def test_distribution_equals_sorting(spark, size):
    rng = random.Random(size)
    # Many repeated values next to values far apart, so that several coarse buckets are involved.
    values = [rng.choice([7, rng.randrange(-(2**40), 2**40), rng.randrange(100)]) for _ in range(size)]
    frame = spark.createDataFrame([(v,) for v in [*values, None]], "v bigint")
    row = exact_distribution(frame, "v", {"half": "1/2", "tenth9": "9/10", "low": "0", "high": "1"}).first()
    assert row.value_count == size
    if not size:
        assert (row.value_sum, row.half, row.tenth9) == (None, None, None)
        return
    ordered = sorted(values)
    assert (row.value_sum, row.value_min, row.value_max) == (sum(values), ordered[0], ordered[-1])

    def expected(num, den):
        whole, rest = divmod(num * (size - 1), den)
        return ordered[whole] * (den - rest) + ordered[min(whole + 1, size - 1)] * rest

    assert row.half == expected(1, 2)
    assert row.tenth9 == expected(9, 10)
    assert (row.low, row.high) == (ordered[0], ordered[-1])


def test_quantile_value_interpolates(spark):
    frame = spark.createDataFrame([(1,), (2,)], "v bigint")
    found = exact_distribution(frame, "v", {"p": "9/10"}).select(quantile_value("p", "9/10", 1).alias("q")).first().q
    assert found == Decimal("1.90")


def native(spark, clean, **tables) -> SalesModel:
    return SalesModel(**{**clean, **tables}, states=state_reference(spark))


def table(spark, name, *rows):
    columns = CLEAN_SCHEMAS[name].fieldNames()
    text = spark.createDataFrame([tuple(row) for row in rows], ", ".join(f"{c} string" for c in columns))
    return text.select([F.col(f.name).cast(f.dataType) for f in CLEAN_SCHEMAS[name]])


def test_order_facts_of_the_consistent_set(spark, clean):
    row = order_facts(native(spark, clean)).where("order_id = 'o1'").first()
    assert (row.customer_state, row.state_name, row.macro_region) == ("SC", "Santa Catarina", "South")
    assert (row.primary_category, row.item_count, row.revenue) == ("health_beauty", 2, Decimal("95.00"))
    assert row.is_measurable_delivery and row.is_late is False and row.in_trend_window
    assert row.delivery_days == pytest.approx(221 / 24)
    assert (row.days_vs_estimate, row.approval_hours) == (-7, 3.0)


def test_not_applicable_measures_are_unknown(spark, clean):
    date = "2018-01-{} 00:00:00".format
    orders = table(
        spark, "orders",
        ("o1", "c1", "shipped", date(10), None, date(12), date(18), date(25), "false"),
        ("o2", "c2", "delivered", date(10), date(11), date(9), date(26), date(25), "true"),
        ("o9", "c1", "canceled", date(10), date(11), None, None, date(25), "false"),
        ("o4", "nobody", "delivered", date(10), date(11), date(12), date(18), date(25), "false"),
    )
    found = {r.order_id: r for r in order_facts(native(spark, clean, orders=orders)).collect()}
    assert set(found) == {"o1", "o2", "o9"}  # an order without a customer has no place in the facts
    assert (found["o1"].is_late, found["o1"].delivery_days, found["o1"].approval_hours) == (None, None, None)
    assert found["o1"].carrier_transit_days == 6.0
    assert (found["o2"].is_measurable_delivery, found["o2"].seller_handoff_days) == (False, None)
    assert (found["o9"].revenue, found["o9"].item_count, found["o9"].order_value) == (None, 0, None)


def test_primary_category_ties_go_to_the_first_name(spark, clean):
    def line(order_id, number, product_id, price):
        return (order_id, number, product_id, "s", "2018-01-15 00:00:00", price, "0")

    items = table(
        spark, "order_items",
        line("o1", "1", "p2", "10"), line("o1", "2", "p1", "6"), line("o1", "3", "p1", "4"),
        line("o2", "1", "p1", "10"), line("o2", "2", "p2", "11"), line("o3", "1", "gone", "99"),
    )
    model = native(spark, clean, order_items=items)
    found = {r.order_id: r.product_category for r in primary_category(items, model.products).collect()}
    assert found == {"o1": "health_beauty", "o2": "stationery"}
    facts = order_facts(model, {"order_id", "primary_category", "order_value"})
    assert facts.where("order_id = 'o1'").first().order_value == 20


def test_small_selections_equal_the_full_facts(star):
    columns = ("order_id", "is_late", "revenue")
    narrow = order_facts(star, set(columns)).select(*columns)
    assert narrow.exceptAll(order_facts(star).select(*columns)).isEmpty()


# ------------------------------------------------------------------ reconciliation


def test_dashboard_revenue_equals_the_report(star):
    report = one(sales.total_revenue(star))["total_revenue"]
    assert d.sales_dashboard(star).agg(F.sum("revenue")).first()[0] == report
    regional_sum = regional.state_performance(star).agg(F.sum("revenue"), F.sum("revenue_share_pct")).first()
    assert regional_sum[0] == report
    assert abs(regional_sum[1] - 100) <= Decimal("0.1")


def test_dashboard_keeps_every_order(star):
    orders = star.order_headers.count()
    assert d.sales_dashboard(star).select("order_id").distinct().count() == orders
    assert one(sales.total_orders(star))["total_orders"] == orders


def test_late_orders_agree(star):
    report = one(operations.late_delivery_rate(star))
    view = d.operations_view(star, "is_late", "is_measurable_delivery").where("is_measurable_delivery")
    found = view.agg(F.count(F.lit(1)).alias("n"), F.count_if("is_late").alias("late")).first()
    assert (found.n, found.late) == (report["delivered_orders"], report["late_orders"])
    assert one(operations.operations_kpis(star))["delivered_orders"] == report["delivered_orders"]


def test_consistent_data_has_no_failed_check(spark, clean):
    assert data_quality_summary(clean, state_reference(spark)).where("status = 'FAIL'").isEmpty()


# ------------------------------------------------------------------ empty and tied inputs


def test_reports_on_empty_tables(spark):
    empty = {name: spark.createDataFrame([], schema) for name, schema in CLEAN_SCHEMAS.items()}
    model = SalesModel(**empty, states=state_reference(spark))
    assert one(sales.total_orders(model))["total_orders"] == 0
    assert one(sales.average_order_value(model))["median_order_value"] is None
    assert one(operations.operations_kpis(model))["late_delivery_pct"] is None
    assert sales.revenue_by_state(model).isEmpty()


def test_ties_share_a_place(spark, clean):
    items = clean["order_items"].withColumns({"price": F.lit(10).cast("decimal(10,2)")})
    items = items.withColumn("freight_value", F.lit(0).cast("decimal(10,2)"))
    ranked = sales.top_categories(native(spark, clean, order_items=items), places=2).collect()
    assert [r.revenue_rank for r in ranked] == [1, 2, 2]


def test_state_without_revenue_ranks_first(spark, clean):
    orders = clean["orders"].withColumn(
        "order_status", F.when(F.col("order_id") == "o2", "canceled").otherwise(F.col("order_status"))
    )
    found = {r.customer_state: r for r in regional.state_performance(native(spark, clean, orders=orders)).collect()}
    assert (found["PE"].revenue, found["PE"].revenue_rank, found["SC"].revenue_rank) == (None, 1, 2)
    segments = {r.customer_state: r for r in regional.state_segments(native(spark, clean, orders=orders)).collect()}
    assert segments["PE"].segment == "Lower revenue / late rate at/below national"
