"""Every operator as a query over the star tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.untidy import UntidyTables
from merchlens.operators import cleaning, profiling, quality, validation
from merchlens.plans import dashboards as d
from merchlens.plans import explore, operations, regional, sales
from merchlens.plans.model import SalesModel, category_base, category_totals, item_totals, order_base, order_facts, primary_category
from merchlens.sources.exports import flags_as_numbers, query, table_columns
from merchlens.sources.star_tables import star_model
from merchlens.sources.states import STATE_CODES, state_reference

Query = Callable[[SparkSession, str], DataFrame]

# Thresholds and selections that mean something on the star tables.
SMALL_SAMPLE = 250
BASE_REGION = "EUROPE"
SELECTION = d.DashboardFilter(
    first_date="1997-03-01",
    last_date="1999-10-31",
    states=("NATION_1", "NATION_3", "NATION_8", "NATION_13", "NATION_21"),
    categories=("ECONOMY", "LARGE", "MEDIUM", "SMALL"),
    statuses=("delivered", "shipped", "canceled"),
)
TREND = d.DashboardFilter(trend_only=True)
UNTIDY_DOMAINS = validation.Domains(states=tuple(f"NATION_{n}" for n in range(0, 25, 2)))


def plain(data: DataFrame) -> DataFrame:
    """Types every SQL engine prints alike: decimals as doubles, whole numbers as bigint, days and moments as text."""
    columns = []
    for field in data.schema:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, (T.IntegerType, T.ShortType)):
            column = column.cast("bigint")
        elif isinstance(field.dataType, T.DateType):
            column = F.date_format(column, "yyyy-MM-dd")
        elif isinstance(field.dataType, T.TimestampNTZType):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        columns.append(column.alias(field.name))
    return data.select(*columns)


def _model(report: Callable[[SalesModel], DataFrame], **settings) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return plain(report(star_model(spark, folder), **settings))

    return run


def _untidy(build: Callable[[Mapping[str, DataFrame]], DataFrame]) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return plain(build(UntidyTables(spark, folder)))

    return run


def _cleaned(build: Callable[[dict[str, cleaning.CleanTable]], DataFrame]) -> Query:
    return _untidy(lambda raw: build(cleaning.clean_all(raw)))


def _clean_data(build: Callable[[Mapping[str, DataFrame]], DataFrame]) -> Query:
    return _cleaned(lambda tables: build({name: table.data for name, table in tables.items()}))


def _operations(model: SalesModel) -> DataFrame:
    return d.operations_dashboard(order_facts(model))


def _quality(model: SalesModel) -> DataFrame:
    return quality.data_quality_summary(model.tables(), model.states)


def _monthly_revenue_sql(spark: SparkSession, folder: str) -> DataFrame:
    """The monthly revenue as a parametrised SELECT on views."""
    model = star_model(spark, folder)
    model.order_headers.createOrReplaceTempView("order_headers")
    item_totals(model.order_items).createOrReplaceTempView("order_values")
    text = """
        SELECT trunc(to_date(order_purchase_timestamp), 'MM') AS order_month, sum(order_value) AS revenue
        FROM order_headers JOIN order_values USING (order_id)
        WHERE order_status <> :first AND order_status <> :second
          AND order_purchase_timestamp >= CAST(:start AS TIMESTAMP_NTZ)
          AND order_purchase_timestamp < CAST(:end AS TIMESTAMP_NTZ)
        GROUP BY 1
    """
    calendar = model.calendar
    values = {"first": "canceled", "second": "unavailable", "start": calendar.trend_start, "end": calendar.trend_end}
    return plain(query(spark, text, values))


def _column_listing(spark: SparkSession, folder: str) -> DataFrame:
    """The columns of the order facts in order with their types, and how many rows fill each."""
    facts = order_facts(star_model(spark, folder))
    listed = [(i, name, kind) for i, (name, kind) in enumerate(table_columns(facts), 1)]
    filled = facts.agg(*[F.count(F.col(f"`{name}`")).alias(name) for _, name, _ in listed])
    rows = [F.struct(F.lit(i).alias("position"), F.lit(n).alias("column_name"), F.lit(k).alias("data_type"), F.col(n).alias("filled_rows")) for i, n, k in listed]
    return plain(filled.select(F.inline(F.array(*rows))))


def _customers_by_state(spark: SparkSession, folder: str) -> DataFrame:
    """Customers per state of the reference dimension, dealt to its codes by their number."""
    codes = F.array(*[F.lit(code) for code in STATE_CODES])
    coded = star_model(spark, folder).customers.select(
        F.element_at(codes, (F.col("customer_id") % len(STATE_CODES) + 1).cast("int")).alias("state_code")
    )
    counted = coded.groupBy("state_code").agg(F.count(F.lit(1)).alias("customers"))
    joined = state_reference(spark).join(counted, "state_code", "left")
    return plain(joined.select("state_code", "state_name", "macro_region", F.coalesce("customers", F.lit(0).cast("bigint")).alias("customers")))


def _order_base(model: SalesModel) -> DataFrame:
    """The stored facts: one row per order with customer, totals, category and month."""
    return order_base(model.orders, model.customers, category_base(model.order_items, model.products, model.order_deliveries))


def _column_profiles(raw: Mapping[str, DataFrame]) -> DataFrame:
    return profiling.profile_all(raw)[1]


def queries() -> dict[str, Query]:
    result: dict[str, Query] = {}
    for reports in (sales.REPORTS, operations.REPORTS):
        for name, report in reports.items():
            result[name] = _model(report)
    result["state_performance"] = _model(regional.state_performance, small_sample=SMALL_SAMPLE)
    result["state_segments"] = _model(regional.state_segments, small_sample=SMALL_SAMPLE)
    result["segment_summary"] = _model(regional.segment_summary)
    result["macro_region_performance"] = _model(regional.macro_region_performance)

    # Data model and dashboard tables
    result["state_reference"] = _model(lambda m: m.states)
    result["item_totals"] = _model(lambda m: item_totals(m.order_items))
    result["category_totals"] = _model(lambda m: category_totals(m.order_items, m.products))
    result["primary_category"] = _model(lambda m: primary_category(m.order_items, m.products))
    result["order_facts"] = _model(order_facts)
    result["sales_dashboard"] = _model(d.sales_dashboard)
    result["operations_dashboard"] = _model(_operations)
    result["regional_dashboard"] = _model(d.regional_dashboard, small_sample=SMALL_SAMPLE)
    result["dashboard_export"] = _model(lambda m: flags_as_numbers(_operations(m)))
    result["monthly_revenue_by_parameters"] = _monthly_revenue_sql
    result["order_facts_columns"] = _column_listing
    result["customers_by_reference_state"] = _customers_by_state
    result["order_base"] = _model(_order_base)
    result["category_base"] = _model(lambda m: category_base(m.order_items, m.products, m.order_deliveries))

    # Dashboard calculations
    result["sales_kpis"] = _model(lambda m: d.sales_kpis(d.sales_dashboard(m)))
    result["sales_kpis_by_state"] = _model(lambda m: d.sales_kpis(d.sales_dashboard(m), by=("customer_state",)))
    result["sales_kpis_selected"] = _model(
        lambda m: d.sales_kpis(d.sales_dashboard(m), by=("product_category",), selection=SELECTION)
    )
    result["month_over_month"] = _model(lambda m: d.month_over_month(d.sales_dashboard(m), TREND))
    result["top_categories_by_revenue"] = _model(
        lambda m: d.top_categories_by_revenue(d.sales_dashboard(m), places=4)
    )
    result["category_shares"] = _model(lambda m: d.category_shares(d.sales_dashboard(m)))
    result["operations_kpi_tiles"] = _model(lambda m: d.operations_kpi_tiles(_operations(m)))
    result["operations_kpi_tiles_by_month"] = _model(
        lambda m: d.operations_kpi_tiles(_operations(m), by=("order_month",), selection=TREND)
    )
    result["operations_kpi_tiles_selected"] = _model(
        lambda m: d.operations_kpi_tiles(_operations(m), by=("state_name",), selection=SELECTION)
    )
    result["late_rate_by_state"] = _model(
        lambda m: d.late_rate_against_national(_operations(m), "state_name", selection=SELECTION)
    )
    result["late_rate_by_category"] = _model(
        lambda m: d.late_rate_against_national(_operations(m), "primary_category", min_delivered=100, places=15)
    )
    result["order_status_share"] = _model(
        lambda m: d.status_distribution(d.operations_view(m, "order_status"))
    )
    result["timeliness_by_outcome"] = _model(
        lambda m: d.timeliness_by_outcome(d.operations_view(m, "timeliness_bucket", "delivery_outcome"))
    )
    result["state_scorecard"] = _model(
        lambda m: d.state_scorecard(d.regional_dashboard(m, small_sample=SMALL_SAMPLE))
    )

    # Data quality
    result["data_quality_summary"] = _model(_quality)
    result["data_quality_by_category"] = _model(lambda m: quality.data_quality_by_category(_quality(m)))
    result["quality_tiles"] = _model(lambda m: d.quality_tiles(_quality(m)))
    result["checks_by_category_and_status"] = _model(lambda m: d.checks_by_category_and_status(_quality(m)))
    result["check_detail"] = _model(lambda m: d.check_detail(_quality(m)))

    # Exploration and narrative
    result["table_row_counts"] = _model(explore.table_row_counts)
    result["coverage"] = _model(explore.coverage)
    result["monthly_revenue_orders"] = _model(explore.monthly_revenue_orders)
    result["peak_month"] = _model(explore.peak_month)
    result["year_over_year"] = _model(explore.year_over_year)
    result["orders_year_over_year"] = _model(explore.orders_year_over_year)
    result["top_category_concentration"] = _model(
        lambda m: explore.top_category_concentration(d.category_shares(d.sales_dashboard(m)), places=3)
    )
    result["top_states_share"] = _model(lambda m: explore.top_states_share(d.regional_dashboard(m)))
    result["early_and_late_share"] = _model(explore.early_and_late_share)
    result["worst_months"] = _model(lambda m: explore.worst_months(operations.late_deliveries_by_month(m)))
    result["stage_means_from_view"] = _model(
        lambda m: explore.stage_means_from_view(
            d.operations_view(
                m, "is_measurable_delivery", "delivery_outcome", "approval_hours", "seller_handoff_days",
                "carrier_transit_days",
            )
        )
    )
    result["segment_rollup"] = _model(lambda m: explore.segment_rollup(d.regional_dashboard(m)))
    result["repeat_customers"] = _model(explore.repeat_customers)
    result["best_day"] = _model(explore.best_day)
    result["decline_from_peak"] = _model(explore.decline_from_peak)
    result["region_freight"] = _model(explore.region_freight)
    result["revenue_exposed_to_lateness"] = _model(explore.revenue_exposed_to_lateness)
    result["state_late_shares"] = _model(explore.state_late_shares)
    result["region_value_premium"] = _model(explore.region_value_premium, base_region=BASE_REGION)
    result["undelivered_in_latest_month"] = _model(explore.undelivered_in_latest_month)
    result["orders_across_categories"] = _model(explore.orders_across_categories)

    # Profiling of raw text
    result["profile_datasets"] = _untidy(lambda raw: profiling.profile_all(raw)[0])
    result["profile_columns"] = _untidy(_column_profiles)
    result["profile_date_ranges"] = _untidy(lambda raw: profiling.date_ranges(_column_profiles(raw)))
    result["profile_missing_values"] = _untidy(lambda raw: profiling.missing_values(_column_profiles(raw)))
    result["raw_status_distribution"] = _untidy(lambda raw: profiling.status_distribution(raw["orders"]))
    result["missing_timestamps_by_status"] = _untidy(
        lambda raw: profiling.missing_timestamps_by_status(raw["orders"])
    )
    result["untranslated_categories"] = _untidy(
        lambda raw: profiling.untranslated_categories(raw["products"], raw["category_translation"])
    )
    result["raw_value_checks"] = _untidy(profiling.raw_value_checks)

    # Cleaning
    result["clean_customers"] = _untidy(lambda raw: cleaning.clean_customers(raw["customers"]).data)
    result["clean_orders"] = _untidy(lambda raw: cleaning.clean_orders(raw["orders"]).data)
    result["clean_order_items"] = _untidy(lambda raw: cleaning.clean_order_items(raw["order_items"]).data)
    result["clean_payments"] = _untidy(lambda raw: cleaning.clean_payments(raw["payments"]).data)
    result["clean_products"] = _untidy(
        lambda raw: cleaning.clean_products(raw["products"], raw["category_translation"]).data
    )
    result["cleaning_summary"] = _cleaned(cleaning.cleaning_summary)
    result["cleaning_actions"] = _cleaned(cleaning.cleaning_actions)
    result["missing_value_report"] = _clean_data(
        cleaning.missing_value_report
    )

    # Validation
    result["validation"] = _clean_data(lambda data: validation.validate(data, UNTIDY_DOMAINS))
    result["validation_summary"] = _clean_data(
        lambda data: validation.summarize(validation.validate(data, UNTIDY_DOMAINS))
    )
    result["publish_constraints"] = _clean_data(validation.check_constraints)
    return result
