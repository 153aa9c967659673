from __future__ import annotations

from decimal import Decimal

from conftest import customer, item, one, order, payment, product, text_frame

from merchlens.operators import profiling as p


def test_column_profiles(spark):
    raw = text_frame(
        spark,
        "order_items",
        [
            item("o1", "1", price="10.50", freight="3"),
            item("o1", "2", price="1200", freight="-4", limit="soon"),
            item("o2", "1", price="7", freight=None),
        ],
    )
    found = {row.column_name: row for row in p.profile_columns("order_items", raw).collect()}
    assert [row.position for row in sorted(found.values(), key=lambda r: r.position)] == list(range(1, 8))
    price, freight, limit = found["price"], found["freight_value"], found["shipping_limit_date"]
    assert (price.inferred_type, price.min_value, price.max_value) == ("decimal", "7", "1,200")
    assert (freight.inferred_type, freight.missing, freight.unique) == ("integer", 1, 2)
    assert freight.missing_pct == Decimal("33.33")
    assert (limit.inferred_type, limit.unparseable, limit.max_value) == ("datetime", 1, "2018-03-08 12:00:00")
    assert found["order_id"].inferred_type == "text"
    assert found["order_id"].min_value is None


def test_code_columns_and_empty_columns_stay_text(spark):
    raw = text_frame(spark, "customers", [customer("c1", city=None), customer("c2", city=None)])
    found = {row.column_name: row for row in p.profile_columns("customers", raw).collect()}
    assert found["customer_zip_code_prefix"].inferred_type == "text"
    assert (found["customer_city"].inferred_type, found["customer_city"].missing_pct) == ("text", 100)


def test_empty_table(spark):
    raw = text_frame(spark, "customers", [])
    found = p.profile_columns("customers", raw).collect()
    assert len(found) == 5
    assert {(row.non_null, row.missing, row.unique, row.missing_pct) for row in found} == {(0, 0, 0, 0)}
    assert one(p.profile_dataset("customers", raw))["row_count"] == 0


def test_estimated_distinct_values_agree_on_small_data(spark, raw):
    exact = p.profile_columns("orders", raw["orders"]).orderBy("position").collect()
    estimated = p.profile_columns("orders", raw["orders"], exact_unique=False).orderBy("position").collect()
    assert exact == estimated


def test_dataset_profile(spark):
    same = customer("c1")
    rows = [same, same, customer("c1", city="other"), customer(None), customer(None, city="x")]
    assert one(p.profile_dataset("customers", text_frame(spark, "customers", rows))) == {
        "dataset": "customers", "row_count": 5, "column_count": 5, "duplicate_rows": 1,
        "primary_key": "customer_id", "missing_key_rows": 2, "duplicate_key_rows": 3,
    }


def test_status_reports(spark):
    raw = text_frame(
        spark,
        "orders",
        [order("o1"), order("o2"), order("o3", status=None), order("o4", status="shipped",
                                                                     order_delivered_customer_date=None)],
    )
    shares = [(row.order_status, row.orders, row.pct) for row in p.status_distribution(raw).collect()]
    assert shares == [("delivered", 2, 50), (None, 1, 25), ("shipped", 1, 25)]
    missing = p.missing_timestamps_by_status(raw).collect()
    assert [(row.order_status, row.order_delivered_customer_date) for row in missing] == [
        ("delivered", 0), ("shipped", 1),
    ]


def test_untranslated_categories(spark, translation):
    rows = [product("p1", "x"), product("p2", "x"), product("p3", None), product("p4", "beleza_saude")]
    found = p.untranslated_categories(text_frame(spark, "products", rows), translation).collect()
    assert [(row.product_category_name, row.products) for row in found] == [("x", 2)]


def test_value_checks(spark, raw):
    clean = p.raw_value_checks(raw).collect()
    assert len(clean) == 19
    # The sellers' shipping limits lie after the only purchase day of the set.
    assert {row.check: row.records for row in clean if row.records} == {
        "shipping_limit_date after latest purchase date": 4,
        "customer_unique_id linked to more than one customer_id": 1,
    }
    raw["order_items"] = text_frame(
        spark,
        "order_items",
        [item("o1", price="0", freight="-1"), item("o9", limit="2030-01-01 00:00:00"), item(None, product="p9")],
    )
    raw["payments"] = text_frame(spark, "payments", [payment("o1", kind="not_defined", installments="0", value="0")])
    raw["customers"] = text_frame(spark, "customers", [customer("c1"), customer("c2"), customer("c3", "u3")])
    found = {(row.dataset, row.check): row.records for row in p.raw_value_checks(raw).collect()}
    assert found["order_items", "price <= 0"] == 1
    assert found["order_items", "freight_value < 0"] == 1
    assert found["order_items", "shipping_limit_date after latest purchase date"] == 3
    assert found["order_items", "order_id not in orders"] == 2
    assert found["order_items", "product_id not in products"] == 1
    assert found["orders", "orders with no order_items"] == 2
    assert found["orders", "orders with no payments"] == 2
    assert found["payments", "payment_type = 'not_defined'"] == 1
    assert found["customers", "customer_unique_id linked to more than one customer_id"] == 1


def test_date_and_missing_reports(spark):
    raw = text_frame(spark, "orders", [order("o1", order_approved_at=None), order("o2", order_approved_at="?")])
    columns = p.profile_columns("orders", raw)
    dates = {row.column_name: row for row in p.date_ranges(columns).collect()}
    assert len(dates) == 5
    assert (dates["order_approved_at"].missing, dates["order_approved_at"].unparseable) == (1, 1)
    assert [row.column_name for row in p.missing_values(columns).collect()] == ["order_approved_at"]


def test_states_of_two_files_merge_into_the_profile_of_both(spark):
    rows = [item(f"o{i}", "1", price=f"{i}.5" if i % 2 else str(i), freight=None if i % 3 else "2", limit="soon" if i == 4 else "2018-03-08 12:00:00") for i in range(120)]
    names = list(rows[0])
    raw = text_frame(spark, "order_items", rows)
    parts = p.column_states(raw.withColumn("f", (raw.price.cast("double") < 40).cast("string")), "f")
    whole = p.column_states(raw.selectExpr("*", "'all' AS f"), "f")
    assert parts.count() == 2 * whole.count() == 2 * len(names)
    merged = p.merged_profile("order_items", names, parts).orderBy("position")
    assert merged.collect() == p.merged_profile("order_items", names, whole).orderBy("position").collect()
    exact = p.profile_columns("order_items", raw).orderBy("position")
    assert merged.drop("median_estimate").collect() == exact.collect()
    medians = {r.column_name: r.median_estimate for r in merged.collect()}
    assert 55 < medians["price"] < 64 and medians["order_id"] is None and medians["freight_value"] == 2.0


def test_estimates_of_many_values_stay_close(spark):
    raw = spark.range(60_000).selectExpr("cast(id as string) AS a", "cast(id % 7 as string) AS f")
    found = one(p.merged_profile("t", ["a"], p.column_states(raw, "f")))
    assert abs(found["unique"] - 60_000) < 2400 and abs(found["median_estimate"] - 30_000) < 1500
    assert (found["non_null"], found["min_value"], found["max_value"]) == (60_000, "0", "59,999")


def test_states_without_rows(spark):
    empty = text_frame(spark, "customers", []).selectExpr("*", "'x' AS f")
    names = [c for c in empty.columns if c != "f"]
    found = p.merged_profile("customers", names, p.column_states(empty, "f")).collect()
    assert len(found) == 5 and {(r.non_null, r.unique, r.inferred_type) for r in found} == {(0, 0, "text")}
