"""A sample of the driver queries against their SQL; `python -m checks.compare` runs all of them."""

from __future__ import annotations

import pytest
from conftest import SMALL_STAR

from checks.compare import compare, connect
from checks.driver_queries import queries
from checks.oracle import statements


@pytest.fixture(scope="module")
def database():
    with connect(SMALL_STAR) as connection:
        yield connection


def test_every_query_has_its_sql():
    assert set(queries()) == set(statements())


@pytest.mark.parametrize(
    "name",
    [
        "monthly_revenue_mom", "average_order_value", "late_deliveries_by_category", "segment_summary", "order_facts",
        "sales_kpis_by_state", "data_quality_summary", "clean_products", "cleaning_actions",
    ],
)
def test_query_equals_its_sql(spark, database, name):
    assert compare(spark, database, SMALL_STAR, name) is None


def test_entry_has_rows(spark):
    import __spark_entry__ as driver

    found = driver.entry(spark)
    assert found.columns[0] == "customer_state"
    assert found.count() == 25
