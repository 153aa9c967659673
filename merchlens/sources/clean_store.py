"""Typed clean tables: staged, published as one set, and read back through a pointer.

A publication writes every table into a new folder, checks it, and only then appends one line to the pointer
table. Readers follow the newest pointer, so they see either the whole old set or the whole new one, and a failed
run leaves the old one in place. Old sets stay until they are expired, for readers that still use them.

Tables with a layout lie in one folder per month and, within it, in buckets by key. Spark joins such tables on the key
without moving their rows, and reads only the months a report asks for.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from merchlens.sources import files
from merchlens.sources.jobs import Mark, counted, marked, marks, side_by_side
from merchlens.sources.schemas import CLEAN_DATASETS, CLEAN_SCHEMAS

POINTER_SCHEMA = "publication bigint, folder string, tables string, layouts string"
# Buckets count as even up to so many times their mean, or so many rows.
UNEVEN_TIMES, UNEVEN_ROWS = 4, 1_000_000


class PublishError(Exception):
    """The set of tables is incomplete, has the wrong columns, or did not arrive whole."""


@dataclass(frozen=True)
class Layout:
    """A folder per value of `month`, buckets by `key` within; both are columns of the table."""

    month: str
    key: str
    buckets: int


@dataclass(frozen=True)
class LaidOut:
    """A table to be written in a layout."""

    data: DataFrame
    layout: Layout


def write_dataset(data: DataFrame, folder: str, dataset: str) -> None:
    """Write one typed dataset as Parquet."""
    data.write.mode("overwrite").parquet(f"{folder}/{dataset}")


def read_dataset(spark: SparkSession, folder: str, dataset: str) -> DataFrame:
    """Read one clean dataset under its declared schema."""
    return spark.read.schema(CLEAN_SCHEMAS[dataset]).parquet(f"{folder}/{dataset}")


def read_datasets(spark: SparkSession, folder: str, datasets: Iterable[str] = CLEAN_DATASETS) -> dict[str, DataFrame]:
    return {dataset: read_dataset(spark, folder, dataset) for dataset in datasets}


def check_load_contract(data: Mapping[str, DataFrame]) -> None:
    """Every table present, with exactly the declared columns; differences are listed both ways."""
    absent = [dataset for dataset in CLEAN_DATASETS if dataset not in data]
    if absent:
        raise PublishError(f"Cannot load: missing datasets {absent}")
    for dataset in CLEAN_DATASETS:
        declared, present = set(CLEAN_SCHEMAS[dataset].fieldNames()), set(data[dataset].columns)
        if declared != present:
            raise PublishError(
                f"Column mismatch for {dataset}: table has {sorted(declared - present)} not in data; "
                f"data has {sorted(present - declared)} not in table"
            )


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table: table_name, row_count."""
    counted = [
        data.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, data in tables.items()
    ]
    result = counted[0]
    for part in counted[1:]:
        result = result.unionByName(part)
    return result


def count_rows(tables: Mapping[str, DataFrame]) -> dict[str, int]:
    return {row.table_name: row.row_count for row in row_counts(tables).collect()}


def verify_row_counts(expected: Mapping[str, int], tables: Mapping[str, DataFrame]) -> dict[str, int]:
    actual = count_rows(tables)
    wrong = {name: (expected[name], actual.get(name)) for name in expected if actual.get(name) != expected[name]}
    if wrong:
        raise PublishError(f"Row count mismatch (expected, actual): {wrong}")
    return actual


def verify_content(spark: SparkSession, expected: Mapping[str, Mark], tables: Mapping[str, DataFrame]) -> dict[str, int]:
    """Compare rows and hashes of stored tables with those of the rows that were written; returns the row counts."""
    actual = marks(spark, {name: tables[name] for name in expected})
    counts = {name: (mark.rows, actual[name].rows) for name, mark in expected.items() if mark.rows != actual[name].rows}
    if counts:
        raise PublishError(f"Row count mismatch (expected, actual): {counts}")
    changed = sorted(name for name, mark in expected.items() if mark != actual[name])
    if changed:
        raise PublishError(f"Content mismatch: rows of {changed} are not those that were written")
    return {name: mark.rows for name, mark in actual.items()}


Tables = Mapping[str, DataFrame]
Step = Callable[[Tables], Mapping[str, DataFrame | LaidOut]]


def publish(
    spark: SparkSession, data: Tables, root: str, arrange: Mapping[str, Callable[[DataFrame, Tables], LaidOut]] | None = None,
    derive: Sequence[Step] = (),
) -> dict[str, int]:
    """Replace the published set by `data` as a whole; returns the verified row counts of the datasets.

    Datasets named in `arrange` are written in a layout, after the others and with these at hand. Each step of `derive`
    computes further tables from all written so far; they become part of the same publication. Every table's rows are
    counted and hashed by the tasks that write them and again in the written files.
    """
    check_load_contract(data)
    number, folder = new_folder(spark, root)
    typed = {name: _typed(data[name], name) for name in CLEAN_DATASETS}
    arranged = arrange or {}
    steps: list[Step] = [lambda _: {name: table for name, table in typed.items() if name not in arranged}]
    if arranged:
        steps.append(lambda tables: {name: place(typed[name], tables) for name, place in arranged.items()})
    written: dict[str, DataFrame] = {}
    layouts: dict[str, dict] = {}
    counts: dict[str, int] = {}
    for step in (*steps, *derive):
        made = step(written)
        seen = write_marked(spark, made, folder)
        stored = {name: spark.read.schema(_schema(table)).parquet(f"{folder}/{name}") for name, table in made.items()}
        counts |= verify_content(spark, seen, stored)
        layouts |= {name: _described(stored[name], table) for name, table in made.items() if isinstance(table, LaidOut)}
        written |= {name: _open(spark, folder, name, layouts) for name in made}
    point_to(spark, root, number, folder, list(written), layouts)
    return {name: counts[name] for name in CLEAN_DATASETS}


def new_folder(spark: SparkSession, root: str) -> tuple[int, str]:
    """The number and the folder of the next set; folders of runs at the same time differ."""
    number = _newest(spark, root)[0] + 1
    return number, f"{root}/publication={number}-{uuid.uuid4().hex[:8]}"


def write_marked(spark: SparkSession, tables: Mapping[str, DataFrame | LaidOut], folder: str) -> dict[str, Mark]:
    """Write the tables side by side; returns the mark of each, taken while writing."""

    def write(name: str) -> Mark:
        table = tables[name]
        if isinstance(table, LaidOut):
            layout = table.layout
            # A bucket is written by one task, whatever the plan before was, so that its folders hold one file each.
            placed = table.data.repartition(layout.buckets, layout.key)
            return marked(placed, lambda data: _write_laid_out(data, layout, folder, name))
        return marked(table, lambda data: write_dataset(data, folder, name))

    return dict(zip(tables, side_by_side(spark, write, tables)))


def write_counted(spark: SparkSession, tables: Tables, folder: str) -> dict[str, int]:
    """Write the tables side by side; returns the rows of each, counted while writing."""

    def write(name: str) -> int:
        return counted(tables[name], lambda data: write_dataset(data, folder, name))

    return dict(zip(tables, side_by_side(spark, write, tables)))


def point_to(
    spark: SparkSession, root: str, number: int, folder: str, names: Iterable[str], layouts: Mapping[str, dict] | None = None
) -> None:
    """Make a complete folder the newest set."""
    pointer = spark.createDataFrame([(number, folder, ",".join(names), json.dumps(layouts or {}))], POINTER_SCHEMA)
    pointer.coalesce(1).write.mode("append").parquet(f"{root}/pointer")


def published(spark: SparkSession, root: str, number: int | None = None) -> dict[str, DataFrame]:
    """The newest published set, or that of a number, derived tables included."""
    found, folder, names, layouts = _newest(spark, root, number)
    if found == 0:
        raise PublishError(f"Nothing published under {root}" if number is None else f"No publication {number} under {root}")
    if not files.exists(spark, folder):
        raise PublishError(f"Publication {found} under {root} has expired")
    return {name: _open(spark, folder, name, layouts) for name in names}


def expire(spark: SparkSession, root: str, keep: int) -> list[str]:
    """Delete all sets but the newest `keep`, and what failed runs left before these; returns the deleted folders."""
    if keep < 1:
        raise ValueError("the newest set cannot expire")
    numbers = sorted(_numbers(spark, root))
    oldest = numbers[-keep] if len(numbers) >= keep else 0
    gone = []
    for name in files.folders(spark, root):
        number = name.removeprefix("publication=").partition("-")[0]
        if name.startswith("publication=") and int(number) < oldest:
            folder = f"{root}/{name}"
            for table in files.folders(spark, folder):
                spark.sql(f"DROP TABLE IF EXISTS {_table_name(folder, table)}")
            files.remove(spark, folder)
            gone.append(folder)
    return gone


# ------------------------------------------------------------------ layouts


def _schema(table: DataFrame | LaidOut):
    """The columns as they are read back: the one that names folders comes last."""
    if not isinstance(table, LaidOut):
        return table.schema
    month = table.layout.month
    return table.data.select(*[c for c in table.data.columns if c != month], month).schema


def _write_laid_out(data: DataFrame, layout: Layout, folder: str, name: str) -> None:
    writer = data.write.mode("overwrite").format("parquet").partitionBy(layout.month)
    writer = writer.bucketBy(layout.buckets, layout.key).sortBy(layout.key)
    writer.option("path", f"{folder}/{name}").saveAsTable(_table_name(folder, name))


def _described(stored: DataFrame, table: LaidOut) -> dict:
    """What a reader needs to know of a layout; whether its buckets are even decides how the table is joined."""
    layout = table.layout
    sizes = stored.groupBy(F.pmod(F.hash(layout.key), F.lit(layout.buckets)).alias("bucket")).agg(F.count(F.lit(1)).alias("rows"))
    largest, total = sizes.agg(F.coalesce(F.max("rows"), F.lit(0)), F.coalesce(F.sum("rows"), F.lit(0))).first()
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in _schema(table).fields)
    even = largest <= max(UNEVEN_ROWS, UNEVEN_TIMES * total / layout.buckets)
    return {"month": layout.month, "key": layout.key, "buckets": layout.buckets, "columns": columns, "even": even}


def _table_name(folder: str, name: str) -> str:
    return f"merchlens_{name}_{zlib.crc32(folder.encode()):08x}_{folder.rpartition('-')[2]}"


def _open(spark: SparkSession, folder: str, name: str, layouts: Mapping[str, dict]) -> DataFrame:
    """A stored table; clean datasets have exactly their declared columns.

    Even buckets are made known to Spark, by an external table in the session's catalog over the files that are there.
    Where one key makes a bucket far larger than the others, the files are read without buckets, so that a join moves
    the rows and adaptive execution can split that key.
    """
    path, layout = f"{folder}/{name}", layouts.get(name)
    if layout is None:
        return read_dataset(spark, folder, name) if name in CLEAN_SCHEMAS else spark.read.parquet(path)
    if layout["even"]:
        table = _table_name(folder, name)
        if not spark.catalog.tableExists(table):
            place = path.replace("'", "\\'")
            spark.sql(
                f"CREATE TABLE IF NOT EXISTS {table} ({layout['columns']}) USING parquet PARTITIONED BY (`{layout['month']}`) "
                f"CLUSTERED BY (`{layout['key']}`) SORTED BY (`{layout['key']}`) INTO {layout['buckets']} BUCKETS LOCATION '{place}'"
            )
            spark.sql(f"MSCK REPAIR TABLE {table}")
        data = spark.table(table)
    else:
        data = spark.read.schema(layout["columns"]).parquet(path)
    return data.select(*CLEAN_SCHEMAS[name].fieldNames()) if name in CLEAN_SCHEMAS else data


def _typed(data: DataFrame, dataset: str) -> DataFrame:
    return data.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in CLEAN_SCHEMAS[dataset]])


# ------------------------------------------------------------------ pointers


def _pointers(spark: SparkSession, root: str) -> DataFrame | None:
    try:
        return spark.read.schema(POINTER_SCHEMA).parquet(f"{root}/pointer")
    except AnalysisException:
        return None


def _numbers(spark: SparkSession, root: str) -> list[int]:
    pointers = _pointers(spark, root)
    return [] if pointers is None else [r.publication for r in pointers.select("publication").distinct().collect()]


def _newest(spark: SparkSession, root: str, number: int | None = None) -> tuple[int, str, list[str], dict]:
    pointers = _pointers(spark, root)
    if pointers is not None and number is not None:
        pointers = pointers.where(F.col("publication") == number)
    newest = None if pointers is None else pointers.agg(F.max(F.struct("publication", "folder", "tables", "layouts")).alias("newest")).first().newest
    if newest is None:
        return 0, "", [], {}
    return newest.publication, newest.folder, newest.tables.split(","), json.loads(newest.layouts or "{}")
