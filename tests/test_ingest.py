"""Raw text parsed once: rejected rows kept with their reason, quoted line breaks in split files, figures of the staging."""

from __future__ import annotations

import random

import pytest
from conftest import CONSISTENT, customer, item, order, payment, product, text_frame
from test_run import write_raw

from merchlens.operators import cleaning as c
from merchlens.plans import run as r
from merchlens.sources.raw_csv import RawDataError, RawFolder
from merchlens.sources.schemas import RAW_COLUMNS

HEADER = ",".join(RAW_COLUMNS["customers"])


# ------------------------------------------------------------------ one parse


def count_parses(monkeypatch):
    parsed, calls = RawFolder.parsed, []
    monkeypatch.setattr(RawFolder, "parsed", lambda self, spark, dataset: calls.append(dataset) or parsed(self, spark, dataset))
    return calls


def test_rows_that_do_not_fit_are_listed_with_their_reason(spark, tmp_path, monkeypatch):
    raw = write_raw(tmp_path / "raw")
    with (tmp_path / "raw" / "customers.csv").open("a") as file:
        file.write('c7,u7,01310,"sao\npaulo",SP\nc8,u8\nc9,u9,01310,"a, ""b""",SP,more,"x,y"\n')
    with (tmp_path / "raw" / "payments.csv").open("a") as file:
        file.write("o1\n")
    (tmp_path / "raw" / "products.csv").write_text("product_id\n1\n")
    batch = r.Run(spark, raw, str(tmp_path / "work"))
    calls = count_parses(monkeypatch)
    with pytest.raises(RawDataError) as error:
        batch.check_raw_data()
    assert sorted(calls) == sorted(set(RAW_COLUMNS) - {"products"})
    message = str(error.value)
    assert "customers: 4 rows that do not fit the header: 2 (quoted line break), 1 (too few fields), 1 (too many fields)" in message
    assert "payments: 1 rows that do not fit the header: 1 (too few fields)" in message
    assert "products: missing expected columns" in message
    listed = spark.read.parquet(f"{batch.folder}/raw/{raw.fingerprint(spark)}/rejected").collect()
    assert {(x.dataset, x.reason, x.record) for x in listed} == {
        ("customers", "quoted line break", 'c7,u7,01310,"sao'), ("customers", "quoted line break", 'paulo",SP'),
        ("customers", "too few fields", "c8,u8"), ("customers", "too many fields", 'c9,u9,01310,"a, ""b""",SP,more,"x,y"'),
        ("payments", "too few fields", "o1"),
    }
    assert {x.file.rpartition("/")[2] for x in listed} == {"customers.csv", "payments.csv"}
    # Nothing was published from such files, and no later step takes the copy for complete.
    with pytest.raises(RawDataError):
        batch.clean_data()


def test_all_steps_parse_the_text_once(spark, tmp_path, monkeypatch):
    calls = count_parses(monkeypatch)
    batch = r.Run(spark, write_raw(tmp_path / "raw"), str(tmp_path / "work"))
    r.run(batch, ["check_raw_data", "profile_data", "clean_data"])
    assert sorted(calls) == sorted(RAW_COLUMNS)
    tables = batch.raw_tables()
    assert {n: tuple(t.columns) for n, t in tables.items()} == RAW_COLUMNS
    assert {n: t.count() for n, t in tables.items()} == {n: len(rows) for n, rows in CONSISTENT.items()}


# ------------------------------------------------------------------ quoted line breaks in split files


def both_ways(spark, path, size, name="customers"):
    """The rows with one task per file and with files cut into splits of `size` bytes."""
    files = {name: name}
    whole = RawFolder(str(path), files, multiline=True).read(spark, name).collect()
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    try:
        split = RawFolder(str(path), files, joined=True)
        data = split.read(spark, name, ordered=True)
        ordered = [tuple(x)[:-1] for x in sorted(data.collect(), key=lambda x: tuple(x[-1]))]
        return [tuple(x) for x in whole], ordered, split.read(spark, name).columns
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("size", [64, 333, 5000])
@pytest.mark.parametrize("ending", ["\n", "\r\n"])
def test_split_files_give_the_rows_of_whole_ones(spark, tmp_path, size, ending):
    rng = random.Random(size)
    (tmp_path / "customers").mkdir()
    for part in range(2):
        lines = [HEADER]
        for i in range(120):
            city = rng.choice(["rio", '"sao ""p"" , x"', '"two\nlines"', '"\n\nmany\n\n,lines\n"', '"' + "long\n" * 60 + '"', "", '""'])
            lines.append(f"c{part}-{i},u{i},{rng.randint(0, 9999)},{city},SP")
        if part:
            lines.insert(40, "")
        (tmp_path / "customers" / f"{part}.csv").write_bytes((ending.join(lines) + ending).encode("utf-8-sig" if part else "utf-8"))
    whole, split, columns = both_ways(spark, tmp_path, size)
    assert len(split) == 240 and sorted(split, key=str) == sorted(whole, key=str)
    assert [x[0] for x in split] == [f"c{part}-{i}" for part in range(2) for i in range(120)]
    assert columns == list(RAW_COLUMNS["customers"])


def test_a_quote_without_an_end_is_refused(spark, tmp_path):
    (tmp_path / "customers.csv").write_text(f'{HEADER}\nc1,u1,1,"rio,SP\nc2,u2,1,rio,SP\n')
    with pytest.raises(RawDataError, match="without an end in .*customers.csv"):
        RawFolder(str(tmp_path), {"customers": "customers.csv"}, joined=True).read(spark, "customers")


def test_every_part_file_must_have_the_header(spark, tmp_path):
    (tmp_path / "customers").mkdir()
    (tmp_path / "customers" / "a.csv").write_text(f"{HEADER}\nc1,u1,1,rio,SP\n")
    (tmp_path / "customers" / "b.csv").write_text(f"{HEADER},extra\nc1,u1,1,rio,SP,x\n")
    with pytest.raises(RawDataError, match="Columns other than"):
        RawFolder(str(tmp_path), {"customers": "customers"}, joined=True).read(spark, "customers")


def test_a_run_over_split_files_with_line_breaks(spark, tmp_path):
    raw = write_raw(tmp_path / "raw")
    with (tmp_path / "raw" / "customers.csv").open("a") as file:
        file.write('c7,u7,01310,"sao\npaulo",SP\nc8,u8\n')
    joined = RawFolder(raw.path, raw.files, joined=True)
    with pytest.raises(RawDataError, match="customers: 1 rows that do not fit the header: 1 .too few fields."):
        r.Run(spark, joined, str(tmp_path / "work")).check_raw_data()
    text = (tmp_path / "raw" / "customers.csv").read_text().replace("c8,u8\n", "")
    (tmp_path / "raw" / "customers.csv").write_text(text)
    batch = r.Run(spark, joined, str(tmp_path / "work"))
    assert r.run(batch, ["clean_data"])["clean_data"]["customers"]["rows_after"] == 4
    assert batch.clean()["customers"].where("customer_id = 'c7'").first().customer_city == "sao paulo"


# ------------------------------------------------------------------ figures of the staging


def messy(spark):
    return {
        "customers": text_frame(spark, "customers", [customer("c1", zip_code="1310", city="  Sao "), customer("c1", zip_code="1310", city="  Sao "), customer(None)]),
        "orders": text_frame(spark, "orders", [order("o1", "c1", order_approved_at="soon"), order("o2", "c1", order_delivered_customer_date="2001-01-01 00:00:00"), order("o3", "c1", order_delivered_carrier_date=None)]),
        "order_items": text_frame(spark, "order_items", [item("o1"), item("o1", price="-1"), item("o2", price="1.005"), item("o3", price="x")]),
        "payments": text_frame(spark, "payments", [payment("o1"), payment("o1"), payment("o2", installments="0")]),
        "products": text_frame(spark, "products", [product("p1", "x"), product("p2", None), product("p3", "pc_gamer", "0")]),
        "category_translation": text_frame(spark, "category_translation", []),
    }


def test_observed_figures_equal_the_aggregates(spark, tmp_path):
    lazy = c.clean_all(messy(spark))
    staged = {name: table.stage(f"{tmp_path}/{name}") for name, table in lazy.items()}
    read_back = {name: table.staged_at(f"{tmp_path}/{name}") for name, table in lazy.items()}
    for other in (lazy, read_back):
        assert sorted(c.cleaning_summary(staged).collect()) == sorted(c.cleaning_summary(other).collect())
        assert sorted(c.cleaning_actions(staged).collect()) == sorted(c.cleaning_actions(other).collect())
        assert c.missing_value_report(staged).collect() == c.missing_value_report(other).collect()
    assert c.missing_value_report(staged).collect() == c.missing_value_report({n: t.data for n, t in read_back.items()}).collect()
    figures = staged["customers"].figures
    assert (figures["rows_before"], figures["rows_after"], figures["rows_modified"]) == (3, 1, 1)
    for report in (c.cleaning_summary, c.cleaning_actions, c.missing_value_report):
        assert "FileScan" not in report(staged)._jdf.queryExecution().executedPlan().toString()


# ------------------------------------------------------------------ kept profile states


def test_only_new_files_are_profiled(spark, tmp_path, monkeypatch):
    from merchlens.operators import profiling

    (tmp_path / "customers").mkdir()

    def part(name, rows):
        (tmp_path / "customers" / f"{name}.csv").write_text("\n".join([HEADER, *rows]) + "\n")

    part("a", [f"a{i},u{i},0131{i % 10},rio,RJ" for i in range(30)])
    raw = RawFolder(str(tmp_path), {"customers": "customers"})
    batch = r.Run(spark, raw, str(tmp_path / "work"), exact_unique=False)
    measured = []
    states = profiling.column_states
    monkeypatch.setattr(profiling, "column_states", lambda rows, version: measured.append(rows.count()) or states(rows, version))

    def profile():
        folder = f"{batch.folder}/raw/{raw.fingerprint(spark)}"
        raw.ingest(spark, "customers", f"{folder}/customers")
        rows = raw.ingested(spark, "customers", f"{folder}/customers")
        merged = profiling.merged_profile("customers", rows.columns, batch.column_states("customers"))
        return merged.drop("median_estimate").orderBy("position").collect(), profiling.profile_columns("customers", rows).orderBy("position").collect()

    merged, exact = profile()
    assert merged == exact and measured == [30]
    part("b", [f"b{i},u{i},,sao,SP" for i in range(12)])
    merged, exact = profile()
    assert merged == exact and measured == [30, 12] and merged[0].non_null == 42
    # A file that changes is read again, one that is gone no longer counts.
    part("b", ["c1,u1,1,x,SP"])
    merged, exact = profile()
    assert merged == exact and measured == [30, 12, 1] and merged[0].non_null == 31


def test_a_run_with_estimates_profiles_like_one_without(spark, tmp_path):
    raw = write_raw(tmp_path / "raw")
    reports = []
    for exact in (True, False):
        batch = r.Run(spark, raw, str(tmp_path / f"work{exact}"), exact_unique=exact)
        r.run(batch, ["profile_data"])
        columns = ["dataset", "column_name", "inferred_type", "non_null", "missing", "unique", "min_value", "max_value"]
        reports.append(sorted(map(str, spark.read.json(f"{batch.folder}/profile/columns").select(columns).collect())))
    assert reports[0] == reports[1]
