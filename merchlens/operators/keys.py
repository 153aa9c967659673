"""Key censuses: how often each key value occurs in a parent table and in the tables that refer to it.

All tables are reduced to (key, counts) and grouped once. Occurrences are added up map-side before the shuffle, so
a key holding a third of all rows costs one row per task, and duplicate keys, broken references and unreferenced
parents all come out of the same pass.

Rules ask nothing of a key but its counts. So a census is kept as a profile: one row per combination of counts with the
number of keys that have it, a few rows whatever the number of keys. A run takes the profiles once, and validation,
publication and data quality read them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchlens.sources.schemas import KEYS


def census(sources: Mapping[str, tuple[DataFrame, str] | tuple[DataFrame, str, str]]) -> DataFrame:
    """One row per key value (NULL is a value): `key` and `n_<name>` for every source (table, column).

    A source that is already counted names its count column as well.
    """
    stacked = None
    for name, (data, column, *count) in sources.items():
        rows = F.col(count[0]) if count else F.lit(1)
        part = data.select(
            F.col(column).alias("key"),
            *[(rows if name == other else F.lit(0)).cast("bigint").alias(f"n_{other}") for other in sources],
        )
        stacked = part if stacked is None else stacked.unionByName(part)
    return stacked.groupBy("key").agg(*[F.sum(f"n_{name}").alias(f"n_{name}") for name in sources])


def key_counts(data: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row per value of a compound key with its number of rows `n`."""
    return data.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))


def profile(counted: DataFrame) -> DataFrame:
    """One row per combination of counts in a census: no_key (the key is NULL), the counts, and keys, how many have them.

    Compound keys have no such flag.
    """
    counts = [c for c in counted.columns if c == "n" or c.startswith("n_")]
    no_key = F.col("key").isNull() if "key" in counted.columns else F.lit(False)
    return counted.groupBy(no_key.alias("no_key"), *counts).agg(F.count(F.lit(1)).alias("keys"))


PROFILES = ("order_keys", "customer_keys", "product_keys", "item_keys", "payment_keys")


def key_profiles(data: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The profiles of all keys of the clean tables.

    Items and payments are counted by their compound keys, and these counts added up per order, so that each table is
    grouped once.
    """
    items, payments = (key_counts(data[name], KEYS[name]) for name in ("order_items", "payments"))
    return {
        "order_keys": profile(
            census({"orders": (data["orders"], "order_id"), "order_items": (items, "order_id", "n"), "payments": (payments, "order_id", "n")})
        ),
        "customer_keys": profile(census({name: (data[name], "customer_id") for name in ("customers", "orders")})),
        "product_keys": profile(census({name: (data[name], "product_id") for name in ("products", "order_items")})),
        "item_keys": profile(items),
        "payment_keys": profile(payments),
    }


# ------------------------------------------------------------------ measures over a profile


def rows_of(count: str) -> Column:
    """All rows of a table."""
    return F.sum(F.col(count) * F.col("keys"))


def extra_rows(count: str) -> Column:
    """Rows beyond the first per key; NULL keys equal each other."""
    return F.sum(F.greatest(F.col(count) - 1, F.lit(0)) * F.col("keys"))


def extra_rows_beyond_distinct(count: str) -> Column:
    """COUNT(*) - COUNT(DISTINCT key): every row with a NULL key is extra."""
    first = F.when(~F.col("no_key") & (F.col(count) > 0), 1).otherwise(0)
    return F.sum((F.col(count) - first) * F.col("keys"))


def _rows_where(condition: Column, count: str) -> Column:
    return F.sum(F.when(condition, F.col(count) * F.col("keys")).otherwise(0))


def broken_references(child: str, parent: str) -> Column:
    """Child rows with a key that no parent has; missing keys are not references."""
    return _rows_where(~F.col("no_key") & (F.col(parent) == 0), child)


def unmatched_rows(child: str, parent: str) -> Column:
    """Child rows without a parent, rows with a missing key included."""
    return _rows_where(F.col("no_key") | (F.col(parent) == 0), child)


def unreferenced_rows(parent: str, child: str) -> Column:
    """Parent rows that no child refers to; a missing key counts as referenced by a missing key."""
    return _rows_where(F.col(child) == 0, parent)


def rows_without_match(parent: str, child: str) -> Column:
    """Parent rows for which no child row exists; a missing key never matches."""
    return _rows_where(F.col("no_key") | (F.col(child) == 0), parent)
