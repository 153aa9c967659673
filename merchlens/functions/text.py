"""Text normalisation and strict parsing of source fields."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

SOURCE_TIMESTAMP_PATTERN = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"
BYTE_ORDER_MARK = "\ufeff"
# A plain or scientific number. Casting alone would also take '1d', '2f' or 'infinity'.
NUMBER_PATTERN = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def snake_case(name: str) -> str:
    """'Order ID', 'orderId' and 'ORDER_ID' all become 'order_id'."""
    cleaned = name.strip().lstrip(BYTE_ORDER_MARK).strip()
    words = re.findall(r"[A-Z]*[a-z0-9]+|[A-Z]+|[0-9]+", cleaned)
    return "_".join(words).lower()


def squeeze(column: str, case: str | None = "lower") -> Column:
    """Trim, collapse any Unicode whitespace to one space and fold the case; NULL stays NULL."""
    collapsed = F.trim(F.regexp_replace(F.col(column), r"(?U)\s+", " "))
    if case == "lower":
        return F.lower(collapsed)
    if case == "upper":
        return F.upper(collapsed)
    return collapsed


def strip(column: str) -> Column:
    """Remove leading and trailing Unicode whitespace only."""
    return F.regexp_replace(F.col(column), r"(?U)^\s+|\s+$", "")


def parse_timestamp(column: str) -> Column:
    """Strict timestamp without a zone; anything else becomes NULL."""
    text = F.col(column)
    # Cast straight to the zone-less type: a detour through a zoned one moves times in daylight-saving gaps.
    return F.when(text.rlike(SOURCE_TIMESTAMP_PATTERN), text.try_cast("timestamp_ntz"))


def is_number(column: str) -> Column:
    return F.col(column).rlike(NUMBER_PATTERN)


def parse_amount(column: str) -> Column:
    """The number as written, up to 20 digits before and 18 after the point; text that is not one becomes NULL.

    Signs and zeros are tested on this value: rounded to the column's two decimals, -0.004 would be neither.
    """
    trimmed = F.trim(F.regexp_replace(F.col(column), r"(?U)\s+", " "))
    return F.when(is_number(column), trimmed.try_cast("decimal(38,18)"))


def parse_whole(column: str) -> Column:
    """Whole number, halves rounded to even; text that is not a number becomes NULL."""
    trimmed = F.trim(F.regexp_replace(F.col(column), r"(?U)\s+", " "))
    return F.when(is_number(column), F.bround(trimmed.try_cast("double"), 0).try_cast("int"))


def pad_code(column: str, width: int = 5) -> Column:
    """Left-pad a short all-digit code with zeros after trimming it."""
    trimmed = strip(column)
    return F.when(trimmed.rlike(rf"^[0-9]{{1,{width - 1}}}$"), F.lpad(trimmed, width, "0")).otherwise(trimmed)
