"""Profiles of raw text tables before any cleaning."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchlens.functions.numbers import percent
from merchlens.functions.text import NUMBER_PATTERN, parse_amount, parse_timestamp
from merchlens.operators import keys as k
from merchlens.operators import rules as r
from merchlens.operators.rules import INFO, Rule
from merchlens.sources.schemas import KEYS

# Column names read as dates, and numeric-looking codes that stay text.
DATE_COLUMN_PATTERN = r"(date|timestamp|_at)$"
CODE_COLUMN_PATTERN = r"zip_code_prefix$"


def _number_text(value: Column) -> Column:
    whole = value == F.floor(value)
    return F.when(whole, F.format_number(value, 0)).otherwise(F.format_number(value, 2))


def profile_columns(dataset: str, raw: DataFrame, exact_unique: bool = True) -> DataFrame:
    """One row per column: inferred type, filled, missing, unique, unparseable, smallest and largest value.

    The columns are unpivoted to (column, value) and counted once, so repeated values collapse map-side before a
    single shuffle, whatever the number of columns; every statistic is then taken over distinct values with their
    counts. With `exact_unique=False` distinct values are estimated and nothing but sketches is shuffled.
    """
    names = raw.columns
    long = raw.select([F.col(c).cast("string").alias(c) for c in names]).unpivot([], names, "column_name", "value")
    if exact_unique:
        counted = long.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
        unique = F.count("value")
    else:
        counted = long.withColumn("n", F.lit(1).cast("bigint"))
        unique = F.approx_count_distinct("value")
    stats = _parsed(counted, names).groupBy("column_name").agg(unique.alias("unique"), *_measures())
    return _described(dataset, names, stats)


def _kinds(names: Sequence[str]) -> tuple[Column, Column]:
    """Whether a column's name lets its values be dates, and whether they are codes."""
    dates = [c for c in names if re.search(DATE_COLUMN_PATTERN, c)]
    codes = [c for c in names if re.search(CODE_COLUMN_PATTERN, c) and c not in dates]
    return F.col("column_name").isin(*dates), F.col("column_name").isin(*codes)


def _parsed(counted: DataFrame, names: Sequence[str], *more: str) -> DataFrame:
    """Values parsed once each, and only as what their column's name lets them be."""
    is_date, is_code = _kinds(names)
    value = F.col("value")
    return counted.select(
        *more,
        "column_name",
        "value",
        "n",
        F.when(is_date, parse_timestamp("value")).alias("moment"),
        F.when(~is_date & ~is_code & value.rlike(NUMBER_PATTERN), F.trim(value).try_cast("double")).alias("number"),
    )


def _measures() -> list[Column]:
    value, filled = F.col("value"), F.col("value").isNotNull()
    moment, number = F.col("moment"), F.col("number")
    return [
        F.sum("n").alias("rows"),
        F.coalesce(F.sum(F.when(filled, F.col("n"))), F.lit(0)).alias("non_null"),
        F.coalesce(F.sum(F.when(moment.isNotNull(), F.col("n"))), F.lit(0)).alias("dated"),
        F.min(moment).alias("first_moment"),
        F.max(moment).alias("last_moment"),
        F.bool_and(F.when(filled, number.isNotNull())).alias("all_numbers"),
        F.bool_or(value.contains(".")).alias("any_point"),
        F.min(number).alias("smallest"),
        F.max(number).alias("largest"),
    ]


def _described(dataset: str, names: Sequence[str], stats: DataFrame, *more: str) -> DataFrame:
    """The profile's columns from the measures, one row per name."""
    # An empty table still has a profile of its columns.
    listed = stats.sparkSession.createDataFrame(list(enumerate(names, 1)), "position int, column_name string")
    joined = listed.join(stats, "column_name", "left").fillna(0, ["rows", "non_null", "unique", "dated"])

    is_date, _ = _kinds(names)
    is_number = F.coalesce("all_numbers", F.lit(False))
    kind = (
        F.when(is_date, "datetime")
        .when(is_number & F.col("any_point"), "decimal")
        .when(is_number, "integer")
        .otherwise("text")
    )

    def bound(moment_column: str, number_column: str) -> Column:
        return F.when(is_date, F.date_format(moment_column, "yyyy-MM-dd HH:mm:ss")).when(
            is_number, _number_text(F.col(number_column))
        )

    absent = F.col("rows") - F.col("non_null")
    return joined.select(
        F.lit(dataset).alias("dataset"),
        "position",
        "column_name",
        kind.alias("inferred_type"),
        "non_null",
        absent.alias("missing"),
        F.coalesce(percent(absent, F.col("rows")), F.lit(0).cast("decimal(20,2)")).alias("missing_pct"),
        "unique",
        F.when(is_date, F.col("non_null") - F.col("dated")).otherwise(F.lit(0)).alias("unparseable"),
        bound("first_moment", "smallest").alias("min_value"),
        bound("last_moment", "largest").alias("max_value"),
        *more,
    )


# ------------------------------------------------------------------ profiles that merge


def column_states(raw: DataFrame, version: str) -> DataFrame:
    """One row per value of `version` (a column that tells files apart) and other column: what a profile is made of.

    Counts and bounds add up exactly; distinct values and the spread of numbers are kept as sketches of a few kilobytes,
    so the states of any files merge into the profile of all of them without reading these again.
    """
    names = [c for c in raw.columns if c != version]
    long = raw.select(F.col(version).alias("version"), *[F.col(c).cast("string").alias(c) for c in names]).unpivot(
        ["version"], names, "column_name", "value"
    )
    parsed = _parsed(long.withColumn("n", F.lit(1).cast("bigint")), names, "version")
    return parsed.groupBy("version", "column_name").agg(
        *_measures(), F.hll_sketch_agg("value").alias("distinct_state"), F.kll_sketch_agg_double("number").alias("number_state")
    )


def merged_profile(dataset: str, names: Sequence[str], states: DataFrame) -> DataFrame:
    """The profile of all rows whose states are given: the columns of `profile_columns`, and an estimated median.

    `unique` and `median_estimate` come from sketches; everything else is exact.
    """
    added = states.groupBy("column_name").agg(
        F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("distinct_state")), F.lit(0)).alias("unique"),
        *[F.sum(c).alias(c) for c in ("rows", "non_null", "dated")],
        F.min("first_moment").alias("first_moment"),
        F.max("last_moment").alias("last_moment"),
        F.bool_and("all_numbers").alias("all_numbers"),
        F.bool_or("any_point").alias("any_point"),
        F.min("smallest").alias("smallest"),
        F.max("largest").alias("largest"),
        F.kll_merge_agg_double("number_state").alias("number_state"),
    )
    middle = F.when(F.col("all_numbers"), F.kll_sketch_get_quantile_double("number_state", F.lit(0.5)))
    return _described(dataset, names, added.withColumn("median_estimate", middle), "median_estimate")


def profile_dataset(dataset: str, raw: DataFrame, key: Sequence[str] | None = None) -> DataFrame:
    """Rows, columns, exact duplicate rows, rows with a missing key and duplicate keys, in one row.

    Identical rows collapse first; their counts then give the key figures without reading the table again.
    """
    key = list(key or KEYS[dataset])
    distinct_rows = raw.groupBy(*raw.columns).agg(F.count(F.lit(1)).alias("_copies"))
    per_key = distinct_rows.groupBy(*key).agg(
        F.sum("_copies").alias("n"), F.count(F.lit(1)).alias("distinct_n")
    )
    no_key = F.lit(False)
    for column in key:
        no_key = no_key | F.col(column).isNull()
    zero = F.lit(0).cast("bigint")
    return per_key.agg(
        F.lit(dataset).alias("dataset"),
        F.coalesce(F.sum("n"), zero).alias("row_count"),
        F.lit(len(raw.columns)).alias("column_count"),
        F.coalesce(F.sum(F.col("n") - F.col("distinct_n")), zero).alias("duplicate_rows"),
        F.lit(", ".join(key)).alias("primary_key"),
        F.coalesce(F.sum(F.when(no_key, F.col("n"))), zero).alias("missing_key_rows"),
        F.coalesce(F.sum(F.col("n") - 1), zero).alias("duplicate_key_rows"),
    )


def profile_all(raw: Mapping[str, DataFrame], exact_unique: bool = True) -> tuple[DataFrame, DataFrame]:
    """Dataset profiles and column profiles of several tables; see `profile_columns` for `exact_unique`."""
    datasets, columns = None, None
    for name, data in raw.items():
        one, many = profile_dataset(name, data), profile_columns(name, data, exact_unique)
        datasets = one if datasets is None else datasets.unionByName(one)
        columns = many if columns is None else columns.unionByName(many)
    return datasets, columns


def date_ranges(columns: DataFrame) -> DataFrame:
    """Earliest, latest, missing and unparseable per date column."""
    return columns.where(F.col("inferred_type") == "datetime").select(
        "dataset",
        "column_name",
        F.col("min_value").alias("earliest"),
        F.col("max_value").alias("latest"),
        "missing",
        "unparseable",
    )


def missing_values(columns: DataFrame) -> DataFrame:
    """Columns with missing values."""
    return columns.where(F.col("missing") > 0).select("dataset", "column_name", "missing", "missing_pct")


def status_distribution(orders: DataFrame) -> DataFrame:
    """Orders per status with their share; a missing status is a group of its own."""
    grouped = orders.groupBy("order_status").agg(F.count(F.lit(1)).alias("orders"))
    # One row; raw status text may have any number of groups.
    total = grouped.agg(F.sum("orders").alias("all_orders"))
    return grouped.crossJoin(F.broadcast(total)).select(
        "order_status", "orders", percent(F.col("orders"), F.col("all_orders")).alias("pct")
    ).orderBy(F.desc("orders"), "order_status")


def missing_timestamps_by_status(orders: DataFrame) -> DataFrame:
    """Orders and missing lifecycle timestamps per known status."""
    stages = ("order_approved_at", "order_delivered_carrier_date", "order_delivered_customer_date")
    return (
        orders.where(F.col("order_status").isNotNull())
        .groupBy("order_status")
        .agg(F.count(F.lit(1)).alias("orders"), *[F.count_if(F.col(c).isNull()).alias(c) for c in stages])
        .orderBy(F.desc("orders"), "order_status")
    )


def untranslated_categories(products: DataFrame, translation: DataFrame) -> DataFrame:
    """Product categories without a translation, with their number of products.

    Products are counted per category before the join, so it only meets one row per category.
    """
    name = "product_category_name"
    per_category = products.where(F.col(name).isNotNull()).groupBy(name).agg(F.count(F.lit(1)).alias("products"))
    return per_category.join(translation.select(name), name, "left_anti").orderBy(F.desc("products"), name)


def raw_value_checks(raw: Mapping[str, DataFrame]) -> DataFrame:
    """19 observations on suspicious values and broken links, as (position, dataset, check, records)."""
    purchased, approved = "order_purchase_timestamp", "order_approved_at"
    carrier, received = "order_delivered_carrier_date", "order_delivered_customer_date"
    orders = raw["orders"].select(*[parse_timestamp(c).alias(c) for c in (purchased, approved, carrier, received)])
    last_purchase = orders.agg(F.max(purchased).alias("last_purchase"))
    items = raw["order_items"].select(
        parse_amount("price").alias("price"),
        parse_amount("freight_value").alias("freight_value"),
        parse_timestamp("shipping_limit_date").alias("shipping_limit_date"),
    )
    people = raw["customers"].groupBy("customer_unique_id").agg(
        F.min("customer_id").alias("first_id"), F.max("customer_id").alias("last_id")
    )
    scopes = {
        "order_items": items.crossJoin(F.broadcast(last_purchase)),
        "payments": raw["payments"].select(
            parse_amount("payment_value").alias("payment_value"),
            parse_amount("payment_installments").alias("payment_installments"),
            "payment_type",
        ),
        "products": raw["products"].select(parse_amount("product_weight_g").alias("product_weight_g")),
        "orders": orders,
        "order_keys": k.census({n: (raw[n], "order_id") for n in ("orders", "order_items", "payments")}),
        "customer_keys": k.census({n: (raw[n], "customer_id") for n in ("customers", "orders")}),
        "product_keys": k.census({n: (raw[n], "product_id") for n in ("products", "order_items")}),
        "people": people.where(F.col("customer_unique_id").isNotNull()),
    }

    def observe(dataset: str, check: str, count: Column, scope: str | None = None) -> Rule:
        return Rule(check, dataset, INFO, scope or dataset, count)

    def rows_absent_from(child: str, parent: str) -> Column:
        return F.sum(F.when(F.col(f"n_{parent}") == 0, F.col(f"n_{child}")).otherwise(0))

    def keys_without(child: str) -> Column:
        return F.count_if((F.col("n_orders") > 0) & (F.col(f"n_{child}") == 0))

    # Names of the observations, in report order.
    observations = [
        observe("order_items", "price <= 0", F.count_if(F.col("price") <= 0)),
        observe("order_items", "freight_value = 0", r.equal_to("freight_value", 0)),
        observe("order_items", "freight_value < 0", r.negative("freight_value")),
        observe("order_items", "shipping_limit_date after latest purchase date",
                F.count_if(F.col("shipping_limit_date") > F.col("last_purchase"))),
        observe("payments", "payment_value = 0", r.equal_to("payment_value", 0)),
        observe("payments", "payment_installments = 0", r.equal_to("payment_installments", 0)),
        observe("payments", "payment_type = 'not_defined'", r.equal_to("payment_type", "not_defined")),
        observe("products", "product_weight_g = 0", r.equal_to("product_weight_g", 0)),
        observe("orders", "approved before purchase", r.recorded_before(approved, purchased)),
        observe("orders", "handed to carrier before purchase", r.recorded_before(carrier, purchased)),
        observe("orders", "delivered to customer before purchase", r.recorded_before(received, purchased)),
        observe("orders", "delivered to customer before handed to carrier", r.recorded_before(received, carrier)),
        observe("orders", "orders with no order_items", keys_without("order_items"), "order_keys"),
        observe("orders", "orders with no payments", keys_without("payments"), "order_keys"),
        observe("order_items", "order_id not in orders", rows_absent_from("order_items", "orders"), "order_keys"),
        observe("order_items", "product_id not in products", rows_absent_from("order_items", "products"),
                "product_keys"),
        observe("payments", "order_id not in orders", rows_absent_from("payments", "orders"), "order_keys"),
        observe("orders", "customer_id not in customers", rows_absent_from("orders", "customers"), "customer_keys"),
        observe("customers", "customer_unique_id linked to more than one customer_id",
                F.count_if(F.col("first_id") < F.col("last_id")), "people"),
    ]
    return r.evaluate(observations, scopes).select(
        "position", "dataset", "check", F.col("record_count").alias("records")
    )
