from __future__ import annotations

import json

import pytest
from conftest import CONSISTENT, item, order

from merchlens.operators.validation import ValidationError
from merchlens.plans import run as r
from merchlens.sources import clean_store
from merchlens.sources.raw_csv import RawFolder
from merchlens.sources.schemas import RAW_COLUMNS


def write_raw(folder, **changes):
    folder.mkdir()
    for name, rows in {**CONSISTENT, **changes}.items():
        lines = [",".join(RAW_COLUMNS[name])]
        lines += [",".join(row.get(c) or "" for c in RAW_COLUMNS[name]) for row in rows]
        (folder / f"{name}.csv").write_text("\n".join(lines) + "\n", "utf-8")
    return RawFolder(str(folder), {name: f"{name}.csv" for name in RAW_COLUMNS})


def test_whole_run(spark, tmp_path):
    raw = write_raw(tmp_path / "raw")
    batch = r.Run(spark, raw, str(tmp_path / "work"))
    report = r.run(batch)
    assert list(report) == list(r.STEPS)
    assert report["profile_data"] == {name: len(rows) for name, rows in CONSISTENT.items()}
    assert report["clean_data"]["orders"] == {"rows_after": 3, "rows_removed": 0, "rows_modified": 0}
    assert report["validate_data"] == {"PASS": 44}
    assert report["load_tables"]["payments"] == 4
    assert len(report["run_sales_analysis"]) == 15
    assert len(report["run_operations_analysis"]) == 13
    assert len(report["run_regional_analysis"]) == 4
    assert report["export_dashboards"] == {
        "sales_dashboard": 4, "operations_dashboard": 3, "regional_dashboard": 2, "data_quality_summary": 36,
    }
    written = json.loads(spark.read.text(f"{batch.folder}/summary").first().value)
    assert written["table_row_counts"]["order_items"] == 4
    assert written["headline_metrics"]["total_revenue"]["total_revenue"] == 218.25
    assert written["headline_metrics"]["operations_kpis"]["avg_delivery_days"] == 9.21
    profiled = {row.dataset: row for row in spark.read.json(f"{batch.folder}/profile/datasets").collect()}
    assert profiled["payments"].file_name == "payments.csv"
    assert profiled["payments"].columns == ", ".join(RAW_COLUMNS["payments"])
    assert spark.read.json(f"{batch.folder}/profile/date_ranges").count() == 6
    assert batch.run_report("total_revenue") == {"total_revenue": 1}
    with pytest.raises(ValueError, match="Unknown report"):
        batch.run_report("nothing")
    # Views stay usable as tables.
    assert spark.sql("SELECT sum(revenue) AS r FROM operations_dashboard").first().r == 218.25


def test_gate_stops_the_run_before_publication(spark, tmp_path):
    raw = write_raw(tmp_path / "raw", order_items=[item("o1"), item("nowhere")])
    batch = r.Run(spark, raw, str(tmp_path / "work"))
    with pytest.raises(ValidationError, match="order_id exists in orders"):
        r.run(batch)
    assert not (tmp_path / "work" / "warehouse").exists()


def test_constraints_stop_the_publication(spark, tmp_path):
    raw = write_raw(tmp_path / "raw", order_items=[item("o1", limit="soon"), item("o2", product="p2"), item("o3", product="p3")])
    batch = r.Run(spark, raw, str(tmp_path / "work"))
    r.run(batch, ["clean_data", "validate_data"])
    with pytest.raises(ValidationError, match="shipping_limit_date is filled"):
        r.run(batch, ["load_tables"])


def test_unknown_step(spark, tmp_path):
    with pytest.raises(ValueError, match="Unknown step"):
        r.run(r.Run(spark, RawFolder("x"), str(tmp_path)), ["fly"])


def test_shared_folder_comes_from_the_session():
    class Session:
        def __init__(self, **settings):
            self.conf = settings

    assert r.shared_folder(Session(**{"spark.checkpoint.dir": "/shared/work/"})) == "/shared/work/merchlens"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        r.shared_folder(Session())


def test_warnings_do_not_stop_the_run(spark, tmp_path):
    orders = [*CONSISTENT["orders"], order("o4", "c3", order_delivered_customer_date=None)]
    batch = r.Run(spark, write_raw(tmp_path / "raw", orders=orders), str(tmp_path / "work"))
    report = r.run(batch, ["clean_data", "validate_data", "load_tables"])
    assert report["validate_data"] == {"PASS": 41, "WARNING": 3}
    assert report["load_tables"]["orders"] == 4


def test_a_step_reads_the_files_as_they_are_now(spark, tmp_path):
    raw = write_raw(tmp_path / "raw")
    batch = r.Run(spark, raw, str(tmp_path / "work"))
    assert r.run(batch, ["clean_data"])["clean_data"]["customers"]["rows_after"] == 3
    with (tmp_path / "raw" / "customers.csv").open("a") as file:
        file.write("c9,u9,04000,recife,PE\n")
    assert batch.clean()["customers"].count() == 4
    assert r.run(batch, ["profile_data"])["profile_data"]["customers"] == 4


def test_views_change_as_a_whole(spark, tmp_path):
    batch = r.Run(spark, write_raw(tmp_path / "raw"), str(tmp_path / "work"))
    r.run(batch, ["validate_data", "load_tables", "create_views"])
    before = batch.views()
    assert set(before) == set(r.VIEWS)
    # A set without its pointer is not seen.
    number, folder = clean_store.new_folder(spark, f"{batch.folder}/views")
    clean_store.write_counted(spark, {"order_facts": before["order_facts"].limit(0)}, folder)
    assert number == 2
    assert batch.views()["order_facts"].count() == 3
