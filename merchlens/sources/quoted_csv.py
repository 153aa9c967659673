"""CSV records with line breaks in quoted fields, from files that are split between tasks.

A line break ends a record only where the quotes before it are even in number. So each split counts its quotes, the
parities are added up over the splits of a file, and every line knows whether it starts inside a quoted field. Lines are
numbered by the records that start up to them, in their split and then in the file, and lines of the same number are
one record, across splits too. Splits that neither begin inside a field nor hold an odd line need no numbering.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

BYTE_ORDER_MARK = "\ufeff"


class RawDataError(Exception):
    """A raw dataset is missing, empty, lacks expected columns, or has rows that do not fit them."""


def _lines(spark: SparkSession, location: str) -> DataFrame:
    """(file, split, line, value, odd): all lines; `line` grows within a split."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return spark.read.option("lineSep", "\n").text(location).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("line"), "value", (quotes % 2).alias("odd"),
    )


def _splits(lines: DataFrame) -> DataFrame:
    """One row per split: file, split, and whether it begins inside a quoted field and whether its lines need numbers."""
    per_split = lines.groupBy("file", "split").agg((F.sum("odd") % 2).alias("parity"), F.max("odd").alias("any_odd"))
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("parity").over(earlier), F.lit(0)) % 2 == 1
    # The first split holds the header.
    return per_split.select("file", "split", "parity", inside.alias("inside"), (inside | (F.col("any_odd") == 1) | (F.col("split") == 0)).alias("numbered"))


def records(spark: SparkSession, location: str, header: Sequence[str]) -> DataFrame:
    """(file, number, record): the records of all files under a location but for their headers and empty records.

    `number` orders the records of a file. Raises where a file ends inside a quoted field, since all that follows the
    quote would be one value, and where a file has other columns.
    """
    lines = _lines(spark, location)
    splits = _splits(lines)
    torn = [r.file for r in splits.groupBy("file").agg((F.sum("parity") % 2).alias("open")).where("open = 1").select("file").limit(10).collect()]
    if torn:
        raise RawDataError(f"Quoted field without an end in {torn}")
    placed = lines.join(splits.drop("parity"), ["file", "split"])
    plain = placed.where("NOT numbered").select("file", "split", F.col("line").alias("nth"), F.col("value").alias("record"))

    # Within a split: quotes before each line, and how many lines up to it start a record, if the split begins outside
    # of a field and if it begins inside of one.
    along = Window.partitionBy("file", "split").orderBy("line")
    before = F.coalesce(F.sum("odd").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) % 2
    up_to = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = placed.where("numbered").withColumn("before", before)
    starts = F.when(F.col("inside"), F.col("before")).otherwise(1 - F.col("before"))
    counted = counted.withColumn("nth", F.sum(starts).over(up_to))
    # The last record of a split goes on in the next one's lines of number 0. Plain splits end with a record's end.
    ends = counted.groupBy("file", "split").agg(F.max("nth").alias("count"))
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ends.select("file", "split", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("offset"))
    numbered = counted.join(offsets, ["file", "split"]).withColumn("record_number", F.col("offset") + F.col("nth"))
    pieces = F.sort_array(F.collect_list(F.struct("split", "line", "value")))
    joined = numbered.groupBy("file", "record_number").agg(pieces.alias("pieces")).select(
        "file", F.col("pieces")[0]["split"].alias("split"), F.col("pieces")[0]["line"].alias("nth"),
        F.array_join(F.transform("pieces", lambda p: p["value"]), "\n").alias("record"), "record_number",
    )
    _check_headers(joined.where("record_number = 1"), header)
    whole = joined.where("record_number > 1").drop("record_number").unionByName(plain)
    record = F.regexp_replace("record", "\r$", "")
    # Lines of a split keep their order, and splits theirs.
    number = F.struct("split", "nth")
    return whole.select("file", number.alias("number"), record.alias("record")).where(F.trim("record") != "")


def _check_headers(first: DataFrame, header: Sequence[str]) -> None:
    names = F.from_csv(
        F.regexp_replace(F.regexp_replace("record", f"^{BYTE_ORDER_MARK}", ""), "\r$", ""),
        ", ".join(f"c{i} string" for i in range(len(header) + 1)), {"escape": '"', "mode": "PERMISSIVE"},
    )
    expected = F.array(*[F.lit(name) for name in header], F.lit(None).cast("string"))
    found = F.array(*[names[f"c{i}"] for i in range(len(header) + 1)])
    other = [r.file for r in first.where(~found.eqNullSafe(expected)).select("file").limit(10).collect()]
    if other:
        raise RawDataError(f"Columns other than {list(header)} in {other}")
