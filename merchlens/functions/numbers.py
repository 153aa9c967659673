"""Exact arithmetic for money, rates and averages.

Money is summed as decimals, so a total never depends on the order in which partitions arrive. Ratios are
rounded once, half away from zero, from whole numerators and denominators; a decimal division followed by a
second rounding could cross a half.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WHOLE = "decimal(38,0)"
MICROS_PER_DAY = 86_400_000_000
MICROS_PER_HOUR = 3_600_000_000


def cents(amount: Column | str) -> Column:
    """An amount with two decimals as a whole number of cents."""
    column = F.col(amount) if isinstance(amount, str) else amount
    return (column * 100).cast(WHOLE)


def exact_ratio(numerator: Column, denominator: Column, digits: int = 2) -> Column:
    """numerator / denominator rounded to `digits`, half away from zero; NULL when the denominator is 0.

    Both operands must be whole numbers (counts, cents, microseconds).
    """
    num = numerator.cast(WHOLE)
    den = F.nullif(denominator.cast(WHOLE), F.lit(0).cast(WHOLE))
    doubled = F.abs(num) * F.lit(2 * 10**digits).cast("decimal(20,0)") + F.abs(den)
    steps = F.call_function("div", doubled.cast(WHOLE), (F.abs(den) * 2).cast(WHOLE))
    sign = F.when((num < 0) != (den < 0), -1).otherwise(1)
    return ((steps * sign).cast("decimal(20,0)") / F.lit(10**digits)).cast(f"decimal({18 + digits},{digits})")


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """100 * part / whole, rounded exactly."""
    return exact_ratio(part.cast(WHOLE) * 100, whole, digits)


def money(amount: Column) -> Column:
    """A money result: two decimals, wide enough for any total."""
    return amount.cast("decimal(28,2)")


def mean_money(total_cents: Column, count: Column) -> Column:
    """Average amount from a total in cents and a row count, rounded to cents."""
    return exact_ratio(total_cents, count.cast(WHOLE) * 100)


def mean_days(total_micros: Column, count: Column) -> Column:
    """Average duration in days from a total in microseconds and a row count."""
    return exact_ratio(total_micros, count.cast(WHOLE) * F.lit(MICROS_PER_DAY).cast(WHOLE))


def mean_hours(total_micros: Column, count: Column) -> Column:
    """Average duration in hours from a total in microseconds and a row count."""
    return exact_ratio(total_micros, count.cast(WHOLE) * F.lit(MICROS_PER_HOUR).cast(WHOLE))


def sum_when(condition: Column, value: Column) -> Column:
    """Sum of `value` over the rows meeting `condition`; NULL when there are none."""
    return F.sum(F.when(condition, value))


def count_when(condition: Column) -> Column:
    """Rows meeting `condition`; NULL conditions do not count."""
    return F.count_if(condition)
