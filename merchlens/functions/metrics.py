"""Business definitions, each stated once as a column expression."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from merchlens.functions.dates import day_gap, month_start, within

# Order statuses that never count as revenue, and the status of a completed order.
CANCELED = "canceled"
UNAVAILABLE = "unavailable"
DELIVERED = "delivered"
NON_REVENUE_STATUSES = (CANCELED, UNAVAILABLE)

# Delivery timeliness labels with the largest day gap each one takes.
TIMELINESS_BUCKETS = (
    (-15, "1. More than 14 days early"),
    (-8, "2. 8-14 days early"),
    (-1, "3. 1-7 days early"),
    (0, "4. On estimated day"),
    (3, "5. 1-3 days late"),
    (7, "6. 4-7 days late"),
    (None, "7. More than 7 days late"),
)

PURCHASED = "order_purchase_timestamp"
APPROVED = "order_approved_at"
HANDED_OVER = "order_delivered_carrier_date"
RECEIVED = "order_delivered_customer_date"
PROMISED = "order_estimated_delivery_date"


@dataclass(frozen=True)
class Calendar:
    """Reporting periods; the defaults are the complete months of the source data."""

    trend_start: str = "2017-01-01"
    trend_end: str = "2018-09-01"
    prior_start: str = "2017-09-01"
    recent_start: str = "2018-03-01"
    recent_end: str = "2018-09-01"
    base_year: int = 2017
    compare_year: int = 2018
    last_compared_month: int = 8

    def in_trend(self) -> Column:
        return within(PURCHASED, self.trend_start, self.trend_end)


def earns_revenue() -> Column:
    return ~F.col("order_status").isin(*NON_REVENUE_STATUSES)


def not_fulfilled() -> Column:
    return F.col("order_status").isin(*NON_REVENUE_STATUSES)


def has_status(status: str) -> Column:
    return F.col("order_status") == F.lit(status)


def measurable_delivery() -> Column:
    """Delivered, with a delivery date, and with lifecycle dates in order."""
    return has_status(DELIVERED) & F.col(RECEIVED).isNotNull() & ~F.col("has_invalid_dates")


def days_past_promise() -> Column:
    return day_gap(RECEIVED, PROMISED)


def arrived_late() -> Column:
    """Later than the promised calendar day; arriving on the day itself is on time."""
    return F.to_date(F.col(RECEIVED)) > F.to_date(F.col(PROMISED))


def timeliness_label(gap: Column) -> Column:
    """Label for a day gap; NULL without a gap."""
    label = None
    for ceiling, text in TIMELINESS_BUCKETS[:-1]:
        condition = gap <= F.lit(ceiling)
        label = F.when(condition, text) if label is None else label.when(condition, text)
    return label.when(gap.isNotNull(), TIMELINESS_BUCKETS[-1][1])


def purchase_month() -> Column:
    return month_start(PURCHASED)
