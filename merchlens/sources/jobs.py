"""Running, counting and fingerprinting independent write jobs."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from decimal import Decimal
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

Item = TypeVar("Item")
SIDE_BY_SIDE = 8


def side_by_side(spark: SparkSession, work: Callable[[str], Item], names: Iterable[str]) -> list[Item]:
    """Results of independent jobs in the order of `names`, submitted from a few driver threads."""
    with ThreadPoolExecutor(max_workers=SIDE_BY_SIDE) as pool:
        return list(pool.map(inheritable_thread_target(spark)(work), names))


def counted(data: DataFrame, write: Callable[[DataFrame], None]) -> int:
    """Run a write and return its number of rows, counted by the tasks that write them."""
    seen = Observation()
    write(data.observe(seen, F.count(F.lit(1)).alias("rows")))
    return seen.get["rows"]


@dataclass(frozen=True)
class Mark:
    """The number of rows of a table and the sum of their hashes, which no order of rows changes."""

    rows: int
    content: Decimal


def _mark_columns(data: DataFrame) -> list[Column]:
    # By name, since columns that become folders come back last. Sums of 64-bit hashes need more than 64 bits.
    values = [F.col(f"`{name}`") for name in sorted(data.columns)]
    content = F.sum(F.xxhash64(*values).cast("decimal(20,0)")).cast("decimal(38,0)")
    return [F.count(F.lit(1)).alias("rows"), F.coalesce(content, F.lit(0).cast("decimal(38,0)")).alias("content")]


def marked(data: DataFrame, write: Callable[[DataFrame], None]) -> Mark:
    """Run a write and return the mark of its rows, taken by the tasks that write them."""
    seen = Observation()
    write(data.observe(seen, *_mark_columns(data)))
    return Mark(seen.get["rows"], seen.get["content"])


def marks(spark: SparkSession, tables: Mapping[str, DataFrame]) -> dict[str, Mark]:
    """The marks of stored tables, one pass over each."""

    def read(name: str) -> Mark:
        return Mark(**tables[name].agg(*_mark_columns(tables[name])).first().asDict())

    return dict(zip(tables, side_by_side(spark, read, tables)))
