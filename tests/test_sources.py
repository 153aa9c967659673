from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from conftest import CONSISTENT

from merchlens.sources import clean_store, exports
from merchlens.sources.raw_csv import RawDataError, RawFolder
from merchlens.sources.schemas import CLEAN_SCHEMAS, RAW_COLUMNS
from merchlens.sources.states import state_reference


def write_file(folder, name, text, encoding="utf-8"):
    path = folder / name
    path.write_text(text, encoding=encoding)
    return path


def raw_folder(tmp_path, **texts) -> RawFolder:
    for name, columns in RAW_COLUMNS.items():
        text = texts.get(name, ",".join(columns) + "\n" + ",".join("1" for _ in columns) + "\n")
        if text is not None:
            write_file(tmp_path, f"{name}.csv", text)
    return RawFolder(str(tmp_path), {name: f"{name}.csv" for name in RAW_COLUMNS})


def test_every_column_is_text_and_only_empty_is_missing(spark, tmp_path):
    write_file(
        tmp_path,
        "customers.csv",
        'customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state\n'
        'c1,NA,01310,"são ""paulo"", sp",\n'
        'c2,"",null, x ,"two\nlines"\n',
    )
    rows = RawFolder(str(tmp_path), {"customers": "customers.csv"}, multiline=True).read(spark, "customers").collect()
    assert list(rows[0]) == ["c1", "NA", "01310", 'são "paulo", sp', None]
    assert list(rows[1]) == ["c2", None, "null", " x ", "two\nlines"]


def test_byte_order_mark_is_dropped(spark, tmp_path):
    write_file(tmp_path, "t.csv", "product_category_name,product_category_name_english\na,b\n", "utf-8-sig")
    data = RawFolder(str(tmp_path), {"category_translation": "t.csv"}).read(spark, "category_translation")
    assert data.columns == list(RAW_COLUMNS["category_translation"])


def test_columns_are_read_by_name(spark, tmp_path):
    write_file(tmp_path, "t.csv", "extra,product_category_name_english,product_category_name\n1,en,pt\n")
    row = RawFolder(str(tmp_path), {"category_translation": "t.csv"}).read(spark, "category_translation").first()
    assert (row.product_category_name, row.product_category_name_english, row.extra) == ("pt", "en", "1")


def test_a_folder_of_part_files_is_one_dataset(spark, tmp_path):
    (tmp_path / "t").mkdir()
    for part in ("a", "b"):
        write_file(tmp_path / "t", f"{part}.csv", f"product_category_name,product_category_name_english\n{part},x\n")
    folder = RawFolder(str(tmp_path), {"category_translation": "t"})
    assert sorted(row[0] for row in folder.read(spark, "category_translation").collect()) == ["a", "b"]


def test_check_reports_sizes(spark, tmp_path):
    folder = raw_folder(tmp_path)
    sizes = folder.check(spark)
    assert sizes == {name: (tmp_path / f"{name}.csv").stat().st_size for name in RAW_COLUMNS}
    assert list(folder.read_all(spark, ["orders"])) == ["orders"]


def test_check_lists_every_problem_at_once(spark, tmp_path):
    folder = raw_folder(tmp_path, customers=None, orders="", payments="order_id,payment_type\n1,2\n")
    with pytest.raises(RawDataError) as error:
        folder.check(spark)
    message = str(error.value)
    assert "customers: file not found" in message
    assert "orders: file is empty" in message
    assert "payments: missing expected columns ['payment_installments'," in message


def test_unknown_dataset(spark, tmp_path):
    with pytest.raises(KeyError, match="Unknown dataset"):
        RawFolder(str(tmp_path)).read(spark, "nothing")


def test_default_file_patterns(tmp_path):
    from fnmatch import fnmatch

    from merchlens.sources.schemas import RAW_FILES

    files = [
        "x_customers_dataset.csv", "x_orders_dataset.csv", "x_order_items_dataset.csv", "x_order_payments_dataset.csv",
        "x_products_dataset.csv", "product_category_name_translation.csv",
    ]
    found = {name: [f for f in files if fnmatch(f, pattern)] for name, pattern in RAW_FILES.items()}
    assert [len(matches) for matches in found.values()] == [1] * 6


def test_publish_replaces_the_set_as_a_whole(spark, clean, tmp_path):
    root = str(tmp_path / "warehouse")
    counts = clean_store.publish(spark, clean, root)
    assert counts == {name: len(CONSISTENT[name]) for name in CLEAN_SCHEMAS}
    published = clean_store.published(spark, root)
    assert {n: t.schema for n, t in published.items()} == {n: CLEAN_SCHEMAS[n] for n in published}
    row = published["order_items"].where("order_id = 'o2'").first()
    assert (row.price, row.shipping_limit_date) == (Decimal("41.00"), dt.datetime(2018, 3, 8, 12))

    fewer = {**clean, "payments": clean["payments"].where("order_id = 'o2'")}
    assert clean_store.publish(spark, fewer, root)["payments"] == 1
    assert clean_store.published(spark, root)["payments"].count() == 1


def test_failed_publication_leaves_the_old_set(spark, clean, tmp_path):
    root = str(tmp_path / "warehouse")
    clean_store.publish(spark, clean, root)
    broken = {**clean, "payments": clean["payments"].selectExpr("*").withColumn(
        "payment_value", clean["payments"].payment_type.cast("decimal(10,2)"))}
    with pytest.raises(Exception):
        clean_store.publish(spark, broken, root)
    assert clean_store.published(spark, root)["payments"].count() == 4


def test_load_contract(clean):
    with pytest.raises(clean_store.PublishError, match="missing datasets"):
        clean_store.check_load_contract({"customers": clean["customers"]})
    changed = {**clean, "customers": clean["customers"].withColumnRenamed("customer_city", "town")}
    with pytest.raises(clean_store.PublishError, match="has \\['customer_city'\\] not in data; data has \\['town'\\]"):
        clean_store.check_load_contract(changed)


def test_row_count_verification(clean):
    assert clean_store.verify_row_counts({"orders": 3}, {"orders": clean["orders"]}) == {"orders": 3}
    with pytest.raises(clean_store.PublishError, match="Row count mismatch"):
        clean_store.verify_row_counts({"orders": 4}, {"orders": clean["orders"]})


def test_nothing_published(spark, tmp_path):
    with pytest.raises(clean_store.PublishError, match="Nothing published"):
        clean_store.published(spark, str(tmp_path))


def csv_text(path) -> list[str]:
    return [line for part in sorted(path.glob("part-*.csv")) for line in part.read_text("utf-8").splitlines()]


def test_dashboard_export(spark, tmp_path):
    data = spark.sql(
        "SELECT * FROM VALUES (1, true, timestamp_ntz'2018-01-02 03:04:05', 'São'), (CAST(NULL AS INT), NULL, NULL, NULL)"
        " AS t(n, flag, at, name)"
    ).coalesce(1)
    assert exports.export_dashboards({"view": data}, str(tmp_path)) == {"view": 2}
    assert csv_text(tmp_path / "view") == ["n,flag,at,name", "1,1,2018-01-02 03:04:05,São", ",,,"]


def test_empty_views_are_refused(spark, tmp_path):
    with pytest.raises(exports.EmptyViewError, match="empty_view"):
        exports.export_dashboards({"empty_view": spark.range(0)}, str(tmp_path))


def test_query_takes_parameters(spark):
    assert exports.query(spark, "SELECT :a + :b AS total", {"a": 1, "b": 2}).first().total == 3
    assert exports.table_columns(spark.range(1)) == [("id", "bigint")]


def test_state_reference(spark):
    rows = state_reference(spark).collect()
    assert len(rows) == 27
    regions = {}
    for row in rows:
        regions[row.macro_region] = regions.get(row.macro_region, 0) + 1
    assert regions == {"North": 7, "Northeast": 9, "Center-West": 4, "Southeast": 4, "South": 3}


@pytest.mark.parametrize("multiline", [False, True])
def test_rows_with_a_wrong_number_of_fields_are_reported(spark, tmp_path, multiline):
    header = ",".join(RAW_COLUMNS["customers"])
    folder = raw_folder(
        tmp_path, customers=f"{header}\na,b,c,d,e,f\na,b\na,b,c,d,e\n", payments="order_id\n1\n",
    )
    with pytest.raises(RawDataError) as error:
        RawFolder(folder.path, folder.files, multiline).check(spark)
    assert "customers: 2 rows with too many or too few fields" in str(error.value)
    assert "payments: missing expected columns" in str(error.value)


def test_a_quoted_line_break_needs_the_multiline_mode(spark, tmp_path):
    header = ",".join(RAW_COLUMNS["customers"])
    folder = raw_folder(tmp_path, customers=f'{header}\na,b,c,"sao\npaulo",e\n')
    with pytest.raises(RawDataError, match="customers: 2 rows"):
        folder.check(spark)
    whole = RawFolder(folder.path, folder.files, multiline=True)
    assert whole.check(spark)["customers"] > 0
    assert whole.read(spark, "customers").first().customer_city == "sao\npaulo"


@pytest.mark.parametrize("long_part", ["a", "b"])
def test_the_last_translation_of_the_last_file_wins(spark, tmp_path, long_part):
    from merchlens.operators.cleaning import translation_lookup

    (tmp_path / "t").mkdir()
    for part in ("a", "b"):
        filler = "".join(f"name{i},x\n" for i in range(3000 if part == long_part else 1))
        text = f"product_category_name,product_category_name_english\npc,{part}1\n{filler}pc,{part}2\n"
        write_file(tmp_path / "t", f"{part}.csv", text)
    folder = RawFolder(str(tmp_path), {"category_translation": "t"})
    lookup = translation_lookup(folder.read(spark, "category_translation", ordered=True))
    assert lookup.where("category_key = 'pc'").first().english == "b2"
