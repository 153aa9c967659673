"""Date arithmetic that never passes through the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def micros_between(start: str, end: str) -> Column:
    """Microseconds from `start` to `end`, as a decimal so that sums over many orders cannot overflow."""
    return F.timestamp_diff("MICROSECOND", F.col(start), F.col(end)).cast("decimal(18,0)")


def day_gap(later: str, earlier: str) -> Column:
    """Whole calendar days from `earlier` to `later`; negative when `later` comes first."""
    return F.date_diff(F.to_date(F.col(later)), F.to_date(F.col(earlier)))


def month_start(timestamp: str) -> Column:
    """First day of the month of a timestamp."""
    return F.trunc(F.to_date(F.col(timestamp)), "month")


def within(timestamp: str, start: str, end: str) -> Column:
    """start <= timestamp < end on the raw column, so the range reaches the file scan."""
    column = F.col(timestamp)
    return (column >= F.lit(start).cast("timestamp_ntz")) & (column < F.lit(end).cast("timestamp_ntz"))


def before(later: str, earlier: str) -> Column:
    """True when the later event is recorded first; a missing date is never a violation."""
    return F.coalesce(F.col(later) < F.col(earlier), F.lit(False))
