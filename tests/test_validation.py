from __future__ import annotations

import datetime as dt

import pytest
from conftest import one
from pyspark.sql import functions as F

from merchlens.operators import keys as k
from merchlens.operators import rules as r
from merchlens.operators import validation as v
from merchlens.operators.quality import data_quality_by_category, data_quality_summary
from merchlens.sources.states import state_reference


def results(data):
    return {(row.dataset, row.check): row for row in v.validate(data).collect()}


def replace_first(data, key, **values):
    """The same table with some columns of one row replaced."""
    column, wanted = key
    changed = {
        name: F.when(F.col(column) == wanted, F.lit(value).cast(data.schema[name].dataType)).otherwise(F.col(name))
        for name, value in values.items()
    }
    return data.withColumns(changed)


def test_consistent_data_passes_all_44_rules(clean):
    found = v.validate(clean).orderBy("position").collect()
    assert len(found) == 44
    assert {row.status for row in found} == {"PASS"}
    assert [row.position for row in found] == list(range(1, 45))
    assert one(v.summarize(v.validate(clean))) == {
        "passed": 44, "warnings": 0, "failed": 0, "checks": 44, "overall": "PASSED",
    }


def test_repeated_key_fails(clean):
    clean["orders"] = clean["orders"].unionByName(clean["orders"].where("order_id = 'o1'"))
    row = results(clean)["orders", "Primary key (order_id) is unique"]
    assert (row.status, row.record_count) == ("FAIL", 1)


def test_broken_reference_fails(clean):
    clean["order_items"] = replace_first(clean["order_items"], ("order_id", "o2"), order_id="missing_order")
    row = results(clean)["order_items", "order_items.order_id exists in orders.order_id"]
    assert (row.status, row.record_count) == ("FAIL", 1)


def test_missing_price_fails(clean):
    clean["order_items"] = replace_first(clean["order_items"], ("order_id", "o1"), price=None)
    assert results(clean)["order_items", "Required field price is not NULL"].status == "FAIL"


def test_delivery_before_purchase_fails(clean):
    early = dt.datetime(2017, 12, 31)
    clean["orders"] = replace_first(clean["orders"], ("order_id", "o1"), order_delivered_customer_date=early)
    assert results(clean)["orders", "Delivered to customer on/after purchase date"].status == "FAIL"


def test_unknown_state_only_warns(clean):
    clean["customers"] = replace_first(clean["customers"], ("customer_id", "c1"), customer_state="XX")
    found = results(clean)
    assert found["customers", "customer_state is a valid Brazilian state"].status == "WARNING"
    assert "FAIL" not in {row.status for row in found.values()}


def test_order_without_items_only_warns(clean):
    clean["order_items"] = clean["order_items"].where("order_id = 'o1'")
    found = results(clean)
    row = found["orders", "Orders without order items (orphan orders)"]
    assert (row.status, row.record_count) == ("WARNING", 2)
    assert "FAIL" not in {row.status for row in found.values()}


def test_gate_stops_on_critical_rules_only(clean):
    clean["payments"] = replace_first(clean["payments"], ("order_id", "o1"), payment_type="not_defined")
    warned = v.gate(v.validate(clean))
    assert warned.where("status = 'WARNING'").count() == 1
    clean["payments"] = replace_first(clean["payments"], ("order_id", "o1"), payment_value=-1)
    with pytest.raises(v.ValidationError, match="payment_value is not negative"):
        v.gate(v.validate(clean))


def test_publish_constraints_are_wider_than_the_rules(clean):
    assert {row.status for row in v.check_constraints(clean).collect()} == {"PASS"}
    clean["order_items"] = replace_first(clean["order_items"], ("order_id", "o1"), shipping_limit_date=None)
    assert {row.status for row in v.validate(clean).collect()} == {"PASS"}
    failed = v.check_constraints(clean).where("status = 'FAIL'").collect()
    assert [(row.dataset, row.check) for row in failed] == [("order_items", "shipping_limit_date is filled")]


def count(frame, column):
    return frame.agg(column.alias("n")).first().n


def test_row_measures(spark):
    frame = spark.createDataFrame([(1, None), (None, None), (3, 1)], "a int, b int")
    assert count(frame, r.missing("a")) == 1
    assert count(frame, r.missing("a", "b")) == 2
    words = spark.createDataFrame([("SP",), ("XX",), (None,)], "state string")
    assert count(words, r.outside("state", ["SP"])) == 1
    assert count(words, r.not_matching("state", "^SP$")) == 2
    dates = spark.sql(
        "SELECT timestamp_ntz'2018-01-10 00:00:00' AS s, e FROM VALUES "
        "(timestamp_ntz'2018-01-12 00:00:00'), (timestamp_ntz'2018-01-09 00:00:00'), (NULL) AS t(e)"
    )
    assert count(dates, r.recorded_before("e", "s")) == 1


def test_zip_pattern_takes_no_trailing_line_break(spark):
    zips = spark.createDataFrame([("01310",), ("01310\n",), ("0131",), (None,)], "z string")
    assert count(zips, r.not_matching("z", v.ZIP_PATTERN)) == 3


def test_key_measures(spark):
    compound = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), ("b", 1)], "k1 string, k2 int")
    assert count(k.profile(k.key_counts(compound, ["k1"])), k.extra_rows("n")) == 2
    assert count(k.profile(k.key_counts(compound, ["k1", "k2"])), k.extra_rows("n")) == 1

    child = spark.createDataFrame([("p1",), ("p2",), (None,), ("p9",)], "c string")
    parent = spark.createDataFrame([("p1",), ("p2",), ("p3",)], "p string")
    both = k.profile(k.census({"child": (child, "c"), "parent": (parent, "p")}))
    assert count(both, k.broken_references("n_child", "n_parent")) == 1
    assert count(both, k.unmatched_rows("n_child", "n_parent")) == 2
    assert count(both, k.unreferenced_rows("n_parent", "n_child")) == 1


def test_missing_keys_in_key_measures(spark):
    keys = spark.createDataFrame([("a",), (None,), (None,)], "c string")
    alone = k.profile(k.census({"t": (keys, "c")}))
    assert count(alone, k.extra_rows("n_t")) == 1  # missing keys equal each other
    assert count(alone, k.extra_rows_beyond_distinct("n_t")) == 2  # or are never distinct values
    both = k.profile(k.census({"parent": (keys, "c"), "child": (spark.createDataFrame([(None,)], "c string"), "c")}))
    assert count(both, k.unreferenced_rows("n_parent", "n_child")) == 1
    assert count(both, k.rows_without_match("n_parent", "n_child")) == 3


def test_every_scope_is_aggregated_once(spark, tmp_path):
    from merchlens.sources.schemas import CLEAN_SCHEMAS

    stored = {}
    for name, schema in CLEAN_SCHEMAS.items():
        spark.createDataFrame([], schema).write.parquet(str(tmp_path / name))
        stored[name] = spark.read.schema(schema).parquet(str(tmp_path / name))
    plan = v.validate(stored)._jdf.queryExecution().optimizedPlan().toString()
    # One aggregation per scope; five profiles over three censuses, and two counts of compound keys with two uses each.
    assert plan.count("Aggregate [") == 10 + 5 + 3 + 4
    # Every table is read for its own rules and for the censuses it takes part in, never once per rule.
    assert plan.count("Relation [") == 5 + 7 + 2


def test_quality_of_consistent_data(spark, clean):
    found = data_quality_summary(clean, state_reference(spark))
    rows = found.collect()
    assert len(rows) == 36
    # The sellers' shipping limits lie after the only purchase day of the set.
    assert [(row.check_name, row.record_count, row.status) for row in rows if row.status != "PASS"] == [
        ("Shipping limit after last purchase date in data", 4, "WARNING")
    ]
    by_category = {row.check_category: row.checks for row in data_quality_by_category(found).collect()}
    assert by_category == {
        "Duplicate records": 5, "Inconsistent categories": 5, "Invalid dates": 6, "Invalid values": 6,
        "Missing values": 6, "Orphan records": 4, "Unmatched foreign keys": 4,
    }


def test_quality_counts_missing_child_keys(spark, clean):
    clean["order_items"] = replace_first(clean["order_items"], ("order_id", "o2"), product_id=None)
    found = {(row.table_name, row.check_name): row for row in data_quality_summary(clean, state_reference(spark)).collect()}
    assert found["order_items", "product_id not in products"].record_count == 1
    assert results(clean)["order_items", "order_items.product_id exists in products.product_id"].record_count == 0


def test_quality_finds_category_spellings(spark, clean):
    clean["products"] = replace_first(clean["products"], ("product_id", "p2"), product_category_name=" Beleza_Saude")
    found = {row.check_name: row for row in data_quality_summary(clean, state_reference(spark)).collect()}
    row = found["Category name variants differing only by case/spacing"]
    assert (row.record_count, row.total_records, row.status) == (1, 3, "WARNING")


def test_rules_and_constraints_share_one_evaluation(clean):
    both = v.check_everything(clean)
    split = {flag: [tuple(x) for x in both.where(f"is_rule = {flag}").drop("is_rule").orderBy("position").collect()] for flag in ("true", "false")}
    rules, constraints = v.validate(clean), v.check_constraints(clean)
    assert split["true"] == [tuple(x) for x in rules.orderBy("position").collect()]
    assert split["false"] == [tuple(x) for x in constraints.orderBy("position").collect()]
    # The constraints add no scope to those of the rules.
    assert {rule.scope for rule in v.publish_constraints()} <= {rule.scope for rule in v.validation_rules()}


def test_repeated_states_count_once(clean):
    states = state_reference(clean["orders"].sparkSession)
    plain = data_quality_summary(clean, states).collect()
    assert data_quality_summary(clean, states.unionByName(states)).collect() == plain


def test_profiles_hold_a_row_per_combination_of_counts(spark, clean):
    profiles = k.key_profiles(clean)
    assert set(profiles) == set(k.PROFILES)
    orders = {(r.no_key, r.n_orders, r.n_order_items, r.n_payments): r["keys"] for r in profiles["order_keys"].collect()}
    plain = {}
    counts = [{r[0]: r[1] for r in clean[t].groupBy("order_id").count().collect()} for t in ("orders", "order_items", "payments")]
    for key in set().union(*counts):
        vector = (False, *(c.get(key, 0) for c in counts))
        plain[vector] = plain.get(vector, 0) + 1
    assert orders == plain
    # Rules, constraints and quality give the same from kept profiles.
    builds = (
        lambda p: v.validate(clean, profiles=p), lambda p: v.check_constraints(clean, p),
        lambda p: data_quality_summary(clean, state_reference(spark), p),
    )
    for build in builds:
        assert build(None).collect() == build(profiles).collect()


def test_rules_read_kept_profiles_instead_of_grouping_keys(spark, clean, tmp_path):
    for name, data in k.key_profiles(clean).items():
        data.write.parquet(f"{tmp_path}/{name}")
    kept = {name: spark.read.parquet(f"{tmp_path}/{name}") for name in k.PROFILES}
    for name, data in clean.items():
        data.write.parquet(f"{tmp_path}/clean_{name}")
    stored = {name: spark.read.parquet(f"{tmp_path}/clean_{name}") for name in clean}
    plan = v.validate(stored, profiles=kept)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan
