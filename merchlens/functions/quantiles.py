"""Exact interpolated quantiles without gathering all values in one task.

Spark's own exact percentile ships every distinct value to a single reducer. Here the values are first counted
(a normal shuffle with map-side combine), then located in three steps: a window over buckets of 2**32 consecutive
whole values finds the bucket that holds each wanted rank, a second one over the buckets of 2**16 values inside it
narrows that down, and a third runs over the distinct values that are left. For values spanning at most 2**48 (nine
years in microseconds, trillions in cents) no window partition holds more than 2**16 rows, however many rows the input
has.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from merchlens.functions.numbers import WHOLE, exact_ratio

# Widths of the buckets, in bits, from the first step to the second.
COARSE_BITS, FINE_BITS = 32, 16


def exact_distribution(values: DataFrame, value: str, points: dict[str, str]) -> DataFrame:
    """One row describing the whole-number column `value`: count, sum, min, max and exact quantiles.

    `points` maps an output name to a fraction such as '1/2' or '9/10'. A quantile column holds
    quantile * denominator of its fraction, a whole number; see `quantile_value`. NULLs are ignored, and with
    nothing left every output is NULL except `value_count`, which is 0.
    """
    wanted = {name: Fraction(point) for name, point in points.items()}
    counted = (
        values.select(F.col(value).cast("bigint").alias("v"))
        .where(F.col("v").isNotNull())
        .groupBy("v")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("bucket", F.shiftright("v", COARSE_BITS))
        .withColumn("sub_bucket", F.shiftright("v", FINE_BITS))
    )
    weighted = F.col("v").cast("decimal(19,0)") * F.col("n").cast("decimal(19,0)")
    coarse = counted.groupBy("bucket").agg(
        F.sum("n").alias("bucket_n"),
        F.sum(weighted).alias("bucket_sum"),
        F.min("v").alias("bucket_min"),
        F.max("v").alias("bucket_max"),
    )
    upward = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everything = Window.partitionBy()
    placed = coarse.select(
        F.col("bucket").alias("rank_bucket"),
        (F.sum("bucket_n").over(upward) - F.col("bucket_n")).alias("rows_below"),
        F.sum("bucket_n").over(upward).alias("rows_through"),
        F.sum("bucket_n").over(everything).alias("total"),
        F.sum("bucket_sum").over(everything).alias("value_sum"),
        F.min("bucket_min").over(everything).alias("value_min"),
        F.max("bucket_max").over(everything).alias("value_max"),
    )
    holds_rank = F.lit(False)
    for fraction in wanted.values():
        for rank in _ranks(fraction):
            holds_rank = holds_rank | ((rank >= F.col("rows_below")) & (rank < F.col("rows_through")))
    # At most two buckets per quantile remain after each step.
    chosen = placed.where(holds_rank)

    # Null-safe equality keeps all uses of the counted values identical, so their shuffle is run once.
    fine = counted.join(F.broadcast(chosen), F.col("bucket").eqNullSafe(F.col("rank_bucket")))
    totals = ("total", "value_sum", "value_min", "value_max")
    per_sub = fine.groupBy("bucket", "sub_bucket", "rows_below", *totals).agg(F.sum("n").alias("sub_n"))
    along = Window.partitionBy("bucket").orderBy("sub_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    through = F.col("rows_below") + F.sum("sub_n").over(along)
    narrowed = per_sub.select(
        F.col("sub_bucket").alias("rank_bucket"), *totals, (through - F.col("sub_n")).alias("rows_below"), through.alias("rows_through")
    ).where(holds_rank)

    finest = counted.join(F.broadcast(narrowed), F.col("sub_bucket").eqNullSafe(F.col("rank_bucket")))
    inside = Window.partitionBy("sub_bucket").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = finest.select(
        "v",
        *totals,
        (F.col("rows_below") + F.sum("n").over(inside) - F.col("n")).alias("first_rank"),
        (F.col("rows_below") + F.sum("n").over(inside)).alias("next_rank"),
    )
    outputs = [
        F.coalesce(F.max("total"), F.lit(0)).alias("value_count"),
        F.max("value_sum").alias("value_sum"),
        F.max("value_min").alias("value_min"),
        F.max("value_max").alias("value_max"),
    ]
    for name, fraction in wanted.items():
        low, high = (_value_at(rank) for rank in _ranks(fraction))
        rest = F.max(_remainder(fraction))
        outputs.append((low * (F.lit(fraction.denominator) - rest) + high * rest).cast(WHOLE).alias(name))
    return ranked.agg(*outputs)


def quantile_value(column: str, point: str, unit: int, digits: int = 2) -> Column:
    """Rounded quantile from a numerator of `exact_distribution`, in `unit`s of the counted value."""
    denominator = Fraction(point).denominator
    return exact_ratio(F.col(column), F.lit(denominator * unit).cast(WHOLE), digits)


def with_twice_median(groups: DataFrame, value: Column, name: str) -> DataFrame:
    """`groups` with one more column: twice the median of `value` over all rows, NULL where there is none.

    For already grouped results only (one row per state), which are ranked in one window. Memory and time grow with
    the groups, not with their square; `value` must be whole.
    """
    everything = Window.partitionBy()
    # Filled values take the first places.
    place = F.row_number().over(Window.orderBy(value.asc_nulls_last()))
    ranked = groups.select("*", place.alias("_place"), F.count(value).over(everything).alias("_filled"))
    low = F.when(F.col("_place") == F.ceil(F.col("_filled") / 2), value)
    high = F.when(F.col("_place") == F.floor(F.col("_filled") / 2) + 1, value)
    doubled = F.sum(low).over(everything) + F.sum(high).over(everything)
    return ranked.select("*", F.when(F.col("_filled") > 0, doubled).alias(name)).drop("_place", "_filled")


def _scaled_rank(fraction: Fraction) -> Column:
    return (F.col("total") - 1) * F.lit(fraction.numerator)


def _ranks(fraction: Fraction) -> tuple[Column, Column]:
    low = F.call_function("div", _scaled_rank(fraction), F.lit(fraction.denominator))
    return low, F.least(low + 1, F.col("total") - 1)


def _remainder(fraction: Fraction) -> Column:
    return F.pmod(_scaled_rank(fraction), F.lit(fraction.denominator))


def _value_at(rank: Column) -> Column:
    found = (rank >= F.col("first_rank")) & (rank < F.col("next_rank"))
    return F.max(F.when(found, F.col("v"))).cast(WHOLE)
