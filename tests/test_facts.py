"""Facts written once per publication: the same reports without joins, in months and buckets, expired in order."""

from __future__ import annotations

import dataclasses
import re
from decimal import Decimal

import pytest
from conftest import SMALL_STAR
from pyspark.sql import functions as F
from test_run import write_raw

from checks.raw_files import write_raw_files
from merchlens.plans import dashboards as d
from merchlens.plans import explore, operations, regional, sales
from merchlens.plans import run as r
from merchlens.plans.model import order_facts
from merchlens.sources import clean_store
from merchlens.sources.star_tables import STAR_CALENDAR

REPORTS = {**sales.REPORTS, **operations.REPORTS, **regional.REPORTS}
NO_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}


@pytest.fixture(scope="module")
def batch(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("facts")
    raw = write_raw_files(spark, SMALL_STAR, f"{folder}/raw")
    batch = r.Run(spark, raw, f"{folder}/work", calendar=STAR_CALENDAR, buckets=3)
    r.run(batch, ["clean_data", "validate_data", "load_tables"])
    return batch


@pytest.fixture(scope="module")
def stored(batch):
    return batch.model()


@pytest.fixture(scope="module")
def joined(stored):
    """The same publication without its facts, so that reports join the tables."""
    return dataclasses.replace(stored, facts=None, category_facts=None)


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def rows(frame):
    return [tuple(row) for row in frame.collect()]


@pytest.mark.parametrize("name", REPORTS)
def test_reports_from_the_facts_equal_those_from_the_tables(stored, joined, name):
    assert rows(REPORTS[name](stored)) == rows(REPORTS[name](joined))


def test_tables_from_the_facts_equal_those_from_the_tables(stored, joined):
    for build in (order_facts, d.sales_dashboard, d.regional_dashboard, explore.orders_across_categories):
        ours, theirs = build(stored), build(joined)
        assert ours.schema == theirs.schema
        assert ours.exceptAll(theirs).isEmpty() and theirs.exceptAll(ours).isEmpty(), build.__name__


@pytest.mark.parametrize("name", [n for n in REPORTS if n != "macro_region_performance"])
def test_no_report_joins_tables(stored, name):
    plan = plan_of(REPORTS[name](stored))
    # Quantiles join the buckets of their ranks; no join meets a key of the tables, and no plain table is read.
    assert not [line for line in plan.splitlines() if "Join" in line and ("order_id#" in line or "customer_id#" in line)]
    assert set(re.findall(r"merchlens_(order_base|category_base|order_items)_", plan)) <= {"order_base", "category_base"}
    assert "FileScan parquet [" not in plan and "FileScan parquet spark_catalog" in plan


def test_a_trend_report_reads_its_months_only(stored):
    plan = plan_of(sales.monthly_revenue(stored))
    assert "PartitionFilters: [isnotnull(order_month" in plan and "order_month#" in plan
    everything = stored.facts.select(F.input_file_name().alias("f")).distinct().count()
    trend = stored.facts.where(stored.in_trend()).select(F.input_file_name().alias("f")).distinct().count()
    assert 0 < trend < everything


def test_items_and_facts_join_where_they_lie(spark, stored, joined):
    before = {name: spark.conf.get(name, None) for name in NO_BROADCAST}
    try:
        for name, value in NO_BROADCAST.items():
            spark.conf.set(name, value)
        pair = stored.order_items.join(stored.facts.select("order_id", "customer_state"), "order_id")
        both = pair.join(stored.category_facts.groupBy("order_id").agg(F.sum("items").alias("n")), "order_id")
        plan = plan_of(both)
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert both.count() == joined.order_items.count()
        per_order = stored.order_items.groupBy("order_id").agg(F.sum("price"))
        assert "Exchange" not in plan_of(per_order)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value) if value is not None else spark.conf.unset(name)


def test_layout_of_the_files(batch, stored):
    read = stored.order_items.select("order_id", F.input_file_name().alias("file"))
    # One file per month and bucket.
    files = [row.file for row in read.distinct().select("file").distinct().collect()]
    places = {(f.split("order_month=")[1].split("/")[0], f.rpartition("_")[2]) for f in files}
    assert len(places) == len(files) and {p[1] for p in places} <= {f"0000{b}.c000.snappy.parquet" for b in range(3)}
    assert stored.order_items.columns == clean_store.CLEAN_SCHEMAS["order_items"].fieldNames()


def test_another_session_finds_tables_and_views(spark, batch, stored):
    batch.create_views()
    other = spark.newSession()
    there = clean_store.published(other, f"{batch.folder}/warehouse")
    assert there["order_base"].count() == stored.facts.count()
    assert "Exchange" not in plan_of(there["order_items"].groupBy("order_id").count())
    for name in r.VIEWS:
        assert other.table(name).count() == batch.views()[name].count() > 0
    assert not [t for t in other.catalog.listTables() if t.name in r.VIEWS and t.isTemporary]


def test_a_bucket_with_a_hot_order_is_not_relied_on(spark, clean, tmp_path, monkeypatch):
    monkeypatch.setattr(clean_store, "UNEVEN_ROWS", 3)
    monkeypatch.setattr(clean_store, "UNEVEN_TIMES", 2)
    batch = r.Run(spark, None, str(tmp_path), buckets=4)
    hot = clean["order_items"].where("order_id = 'o1'").limit(1).crossJoin(spark.range(10, 100))
    hot = hot.withColumn("order_item_id", F.col("id").cast("int")).drop("id")
    tables = {**clean, "order_items": clean["order_items"].unionByName(hot)}

    def place(items, written):
        months = r.order_months(written["orders"])
        return clean_store.LaidOut(items.join(months, "order_id", "left"), clean_store.Layout("order_month", "order_id", 4))

    counts = clean_store.publish(spark, tables, f"{batch.folder}/warehouse", {"order_items": place})
    found = clean_store.published(spark, f"{batch.folder}/warehouse")["order_items"]
    assert counts["order_items"] == found.count() == tables["order_items"].count()
    assert "Exchange" in plan_of(found.groupBy("order_id").count()) and "Bucketed: true" not in plan_of(found)


def test_old_sets_expire_and_the_newest_stay_readable(spark, tmp_path):
    steps = ["clean_data", "validate_data", "load_tables", "create_views"]
    batch = r.Run(spark, write_raw(tmp_path / "raw"), str(tmp_path / "work"), keep=2)
    r.run(batch, steps)
    root = f"{batch.folder}/warehouse"
    readers = {1: clean_store.published(spark, root)["customers"]}
    for number in (2, 3):
        with (tmp_path / "raw" / "customers.csv").open("a") as file:
            file.write(f"new{number},u,04000,recife,PE\n")
        r.run(batch, steps)
        readers[number] = clean_store.published(spark, root)["customers"]
    # The reader of the second set still has it, by its number too; the first is gone with its copies and views.
    assert [readers[n].count() for n in (2, 3)] == [4, 5]
    assert clean_store.published(spark, root, 2)["order_base"].count() == 3
    with pytest.raises(clean_store.PublishError, match="Publication 1 .* expired"):
        clean_store.published(spark, root, 1)
    with pytest.raises(clean_store.PublishError, match="No publication 9"):
        clean_store.published(spark, root, 9)
    left = sorted(p.name for p in (tmp_path / "work" / "warehouse").iterdir() if p.name.startswith("publication="))
    assert [n.split("-")[0] for n in left] == ["publication=2", "publication=3"]
    for kind in ("raw", "staged", "outcomes"):
        assert len(list((tmp_path / "work" / kind).iterdir())) == 2, kind
    views = [p for p in (tmp_path / "work" / "views").iterdir() if p.name.startswith("publication=")]
    assert len(views) == 2 and spark.table("sales_dashboard").count() == 4
    # What a failed run left before the oldest kept set goes as well, an unfinished newer one stays.
    (tmp_path / "work" / "warehouse" / "publication=1-lost").mkdir()
    (tmp_path / "work" / "warehouse" / "publication=4-begun").mkdir()
    gone = clean_store.expire(spark, root, 2)
    assert [g.rpartition("/")[2] for g in gone] == ["publication=1-lost"]
    with pytest.raises(ValueError):
        clean_store.expire(spark, root, 0)


def test_nothing_expires_without_a_number(spark, tmp_path):
    batch = r.Run(spark, write_raw(tmp_path / "raw"), str(tmp_path / "work"), keep=None)
    for _ in range(3):
        r.run(batch, ["clean_data", "load_tables"])
    assert clean_store.published(spark, f"{batch.folder}/warehouse", 1)["orders"].count() == 3


def test_a_changed_value_is_found_where_the_count_is_not(spark, clean, tmp_path):
    seen = clean_store.write_marked(spark, clean, str(tmp_path))
    assert clean_store.verify_content(spark, seen, clean_store.read_datasets(spark, str(tmp_path))) == {
        name: clean[name].count() for name in clean
    }
    more = (F.col("payment_value") + F.lit(Decimal("0.01"))).cast("decimal(10,2)")
    changed = clean["payments"].withColumn("payment_value", more)
    clean_store.write_dataset(changed, str(tmp_path), "payments")
    with pytest.raises(clean_store.PublishError, match="Content mismatch: rows of \\['payments'\\]"):
        clean_store.verify_content(spark, seen, clean_store.read_datasets(spark, str(tmp_path)))
    clean_store.write_dataset(clean["payments"].limit(1), str(tmp_path), "payments")
    with pytest.raises(clean_store.PublishError, match="Row count mismatch"):
        clean_store.verify_content(spark, seen, clean_store.read_datasets(spark, str(tmp_path)))


def test_repeated_rows_change_the_mark(spark):
    from merchlens.sources.jobs import marks

    one = spark.createDataFrame([(1, "a"), (2, None)], "n int, t string")
    found = marks(spark, {"one": one, "other": one.orderBy(F.desc("n")).select("t", "n"), "twice": one.unionAll(one), "none": one.limit(0)})
    assert found["one"] == found["other"] != found["twice"] and found["none"].rows == found["none"].content == 0


def test_quality_of_a_publication_groups_no_key_again(batch, stored):
    from merchlens.operators import quality

    profiles = batch.key_profiles()
    kept = quality.data_quality_summary(stored.tables(), stored.states, profiles)
    assert kept.collect() == quality.data_quality_summary(stored.tables(), stored.states).collect()
    plan = plan_of(kept)
    assert "hashpartitioning(order_id" not in plan and "hashpartitioning(key" not in plan and "hashpartitioning(product_id" not in plan
    assert all(p.count() < 200 for p in profiles.values())
