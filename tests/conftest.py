"""Small hand-made datasets, all text with NULL for blank, and one shared session."""

from __future__ import annotations

import datetime as dt
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from merchlens.session import build_session  # noqa: E402
from merchlens.sources.schemas import CLEAN_SCHEMAS, RAW_COLUMNS  # noqa: E402

SMALL_STAR = "/root/testdata/sf0.001"
STAR = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "merchlens-tests",
        master="local[8]",
        **{
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": "2",
            # Compiling a stage takes longer than running it on a few rows.
            "spark.sql.codegen.wholeStage": "false",
            "spark.driver.memory": "4g",
            "spark.log.level": "ERROR",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    yield session
    session.stop()


def text_frame(spark, dataset: str, rows: list[dict]):
    """A raw dataset from dictionaries; absent columns are NULL."""
    columns = RAW_COLUMNS[dataset]
    schema = ", ".join(f"{c} string" for c in columns)
    return spark.createDataFrame([tuple(row.get(c) for c in columns) for row in rows], schema)


def customer(customer_id, unique_id="u1", zip_code="88015", city="florianopolis", state="SC") -> dict:
    return dict(zip(RAW_COLUMNS["customers"], (customer_id, unique_id, zip_code, city, state)))


PURCHASE = dt.datetime(2018, 3, 5, 7, 45)
# Hours from the purchase to each later step of an order without problems.
HOURS = {
    "order_approved_at": 3,
    "order_delivered_carrier_date": 50,
    "order_delivered_customer_date": 221,
    "order_estimated_delivery_date": 400,
}


def order(order_id, customer_id="c1", status="delivered", **dates) -> dict:
    steps = {step: str(PURCHASE + dt.timedelta(hours=hours)) for step, hours in HOURS.items()}
    keys = {"order_id": order_id, "customer_id": customer_id, "order_status": status}
    return {**keys, "order_purchase_timestamp": str(PURCHASE), **steps, **dates}


def item(order_id, item_id="1", product="p1", price="64.90", freight="8.35", limit="2018-03-08 12:00:00") -> dict:
    return dict(zip(RAW_COLUMNS["order_items"], (order_id, item_id, product, "s7", limit, price, freight)))


def payment(order_id, seq="1", kind="debit_card", installments="1", value="73.25") -> dict:
    return dict(zip(RAW_COLUMNS["payments"], (order_id, seq, kind, installments, value)))


def product(product_id, category, weight="310") -> dict:
    # Lengths of name and description, photos, then weight and three sides.
    return dict(zip(RAW_COLUMNS["products"], (product_id, category, "31", "190", "1", weight, "28", "6", "19")))


TRANSLATION = [
    dict(zip(RAW_COLUMNS["category_translation"], pair))
    for pair in (("beleza_saude", "health_beauty"), ("papelaria", "stationery"), ("cama_mesa_banho", "bed_bath_table"))
]

# Three orders; one holds two items and is paid in two parts, one customer ordered under two ids.
CONSISTENT = {
    "customers": [customer("c1"), customer("c2", "u2", "50030", "recife", "PE"), customer("c3", "u1")],
    "orders": [order("o1", "c1"), order("o2", "c2"), order("o3", "c3")],
    "order_items": [
        item("o1"), item("o1", "2", "p2", "20.10", "1.65"), item("o2", product="p3", price="41.00", freight="9.00"), item("o3"),
    ],
    "payments": [
        payment("o1", value="70.00"), payment("o1", "2", "voucher", value="25.00"),
        payment("o2", kind="boleto", value="50.00"), payment("o3", installments="4"),
    ],
    "products": [product("p1", "beleza_saude"), product("p2", "papelaria"), product("p3", "cama_mesa_banho", "1200")],
    "category_translation": TRANSLATION,
}


@pytest.fixture
def raw(spark):
    """A consistent raw set that passes every rule."""
    return {name: text_frame(spark, name, rows) for name, rows in CONSISTENT.items()}


@pytest.fixture
def translation(spark):
    return text_frame(spark, "category_translation", TRANSLATION)


@pytest.fixture
def clean(raw):
    from merchlens.operators.cleaning import clean_all

    return {
        name: table.data.select(*CLEAN_SCHEMAS[name].fieldNames()) for name, table in clean_all(raw).items()
    }


@pytest.fixture(scope="session")
def star(spark):
    from merchlens.sources.star_tables import star_model

    return star_model(spark, SMALL_STAR)


def one(frame) -> dict:
    rows = frame.collect()
    assert len(rows) == 1
    return rows[0].asDict()
