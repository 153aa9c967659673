"""Plans and results when one key holds a third of all rows."""

from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from merchlens.functions.quantiles import exact_distribution, with_twice_median
from merchlens.operators import keys as k
from merchlens.operators.cleaning import clean_customers
from merchlens.plans import regional, sales
from merchlens.plans.dashboards import sales_dashboard
from merchlens.plans.model import SalesModel
from merchlens.sources.star_tables import star_model

ROWS = 30_000


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the items belong to one order, a third to one product, a third of the orders to one customer."""
    n = F.col("id")
    third = n % 3 == 0
    items = spark.range(ROWS).select(
        F.when(third, "hot").otherwise(F.concat(F.lit("o"), n % 1000)).alias("order_id"),
        n.cast("int").alias("order_item_id"),
        F.when(n % 3 == 1, "best").otherwise(F.concat(F.lit("p"), n % 50)).alias("product_id"),
        F.lit("s").alias("seller_id"),
        F.lit("2018-01-15").cast("timestamp_ntz").alias("shipping_limit_date"),
        F.lit(1).cast("decimal(10,2)").alias("price"),
        F.lit("0.5").cast("decimal(10,2)").alias("freight_value"),
    )
    order_ids = spark.range(1000).select(F.concat(F.lit("o"), n).alias("order_id"), n).union(
        spark.sql("SELECT 'hot' AS order_id, 0 AS id")
    )
    day = F.lit("2018-01-10").cast("timestamp_ntz")
    orders = order_ids.select(
        "order_id",
        F.when(third, "busy").otherwise(F.concat(F.lit("c"), n)).alias("customer_id"),
        F.lit("delivered").alias("order_status"),
        day.alias("order_purchase_timestamp"),
        day.alias("order_approved_at"),
        day.alias("order_delivered_carrier_date"),
        day.alias("order_delivered_customer_date"),
        day.alias("order_estimated_delivery_date"),
        F.lit(False).alias("has_invalid_dates"),
    )
    customers = orders.select("customer_id").distinct().select(
        "customer_id",
        F.col("customer_id").alias("customer_unique_id"),
        F.lit("01310").alias("customer_zip_code_prefix"),
        F.lit("x").alias("customer_city"),
        F.lit("SP").alias("customer_state"),
    )
    names = spark.range(50).select(F.concat(F.lit("p"), n).alias("product_id")).union(
        spark.sql("SELECT 'best' AS product_id")
    )
    products = names.select(
        "product_id",
        F.col("product_id").alias("product_category_name"),
        F.col("product_id").alias("product_category_name_english"),
    )
    states = spark.sql("SELECT 'SP' AS state_code, 'São Paulo' AS state_name, 'Southeast' AS macro_region")
    return SalesModel(customers, orders, items, products, orders, states)


def test_results_stay_whole(skewed):
    total = sales.total_revenue(skewed).first()
    assert total.total_revenue == Decimal("1.5") * ROWS
    categories = {r.product_category: r for r in sales.revenue_by_category(skewed).collect()}
    assert categories["best"].items_sold == ROWS // 3
    assert sum(r.items_sold for r in categories.values()) == ROWS
    state = regional.state_performance(skewed).first()
    assert (state.revenue, state.customers) == (total.total_revenue, skewed.customers.count())
    assert sales_dashboard(skewed).agg(F.sum("revenue")).first()[0] == total.total_revenue


def shuffled_rows(frame) -> list[int]:
    """Rows written by every shuffle of a finished query."""
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan()
    written = []

    def visit(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return visit(node.executedPlan())
        if name.endswith("QueryStageExec"):
            return visit(node.plan())
        if name == "ShuffleExchangeExec":
            written.append(node.metrics().apply("shuffleRecordsWritten").value())
        children = node.children()
        for i in range(children.size()):
            visit(children.apply(i))

    visit(plan)
    return written


def test_a_hot_key_is_added_up_before_the_shuffle(spark, skewed):
    census = k.census({"items": (skewed.order_items, "order_id"), "orders": (skewed.orders, "order_id")})
    keys, tasks = 1001, skewed.order_items.rdd.getNumPartitions()
    assert max(shuffled_rows(census)) <= 2 * keys * (tasks + 2)
    assert max(shuffled_rows(census)) < ROWS


def test_identical_rows_collapse_before_the_shuffle(spark):
    raw = spark.range(ROWS).select(
        *[F.lit("same").alias(c) for c in ("customer_id", "customer_unique_id", "customer_zip_code_prefix",
                                           "customer_city", "customer_state")]
    )
    table = clean_customers(raw)
    assert max(shuffled_rows(table.audit())) <= raw.rdd.getNumPartitions()
    audit = table.audit().first()
    assert (audit.rows_before, audit.rows_after) == (ROWS, 1)


def test_a_hot_product_is_split_when_its_side_cannot_be_broadcast(spark, skewed, tmp_path):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
    }
    items = skewed.order_items.withColumn("order_id", F.col("order_item_id").cast("string")).repartition(8)
    items.write.parquet(str(tmp_path / "items"))
    stored = spark.read.parquet(str(tmp_path / "items"))
    before = {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        from merchlens.plans.model import category_totals

        totals = category_totals(stored, skewed.products)
        found = {r.product_category: r.n for r in totals.groupBy("product_category").agg(F.count("*").alias("n")).collect()}
        totals.collect()
        plan = totals._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value) if value is not None else spark.conf.unset(name)
    assert found["best"] == ROWS // 3
    assert "skew=true" in plan


def test_filters_and_columns_reach_the_scan(spark):
    model = star_model(spark, "/root/testdata/sf0.001")
    plan = sales.monthly_revenue(model)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate,1996-01-01T00:00)" in plan
    assert "o_totalprice" not in plan
    items = plan[plan.index("l_orderkey") :]
    assert "l_partkey" not in items and "l_shipdate" not in items


def test_no_python_in_any_plan(spark):
    from checks.driver_queries import queries

    for name in ("order_facts", "validation", "profile_columns", "clean_products", "average_order_value"):
        plan = queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "InPandas" not in plan and "CartesianProduct" not in plan, name


@pytest.mark.parametrize("groups", [100_000, 99_999])
def test_median_of_many_groups(spark, groups):
    values = spark.range(groups).select((F.col("id") * 7919 % groups).alias("v"))
    found = with_twice_median(values, F.col("v"), "m").agg(F.min("m"), F.max("m"), F.count("m")).first()
    assert tuple(found) == (groups - 1, groups - 1, groups)


def test_median_ignores_null_groups(spark):
    values = spark.createDataFrame([(None,), (3,), (None,), (8,)], "v long")
    assert {row.m for row in with_twice_median(values, F.col("v"), "m").collect()} == {11}
    assert with_twice_median(values.where("v IS NULL"), F.col("v"), "m").first().m is None


@pytest.mark.parametrize("step", [1, 40_000_000_000])
def test_quantiles_within_and_across_buckets(spark, step):
    # Step 1 keeps all values in one coarse bucket, the other spreads them over many; negative ones included.
    values = spark.range(-30_000, 170_001).select((F.col("id") * step).alias("v"))
    found = exact_distribution(values, "v", {"half": "1/2", "most": "9/10", "first": "0/1"}).first()
    assert (found.value_count, found.half, found.most, found.first) == (200_001, 140_000 * step, 1_500_000 * step, -30_000 * step)
