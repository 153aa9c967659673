"""Declarative rules, each an aggregate over a scope; all rules of a scope share one aggregation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CRITICAL = "critical"
WARNING = "warning"
INFO = "info"


@dataclass(frozen=True)
class Rule:
    """`count` aggregates the violating records of `scope`; `total` the records they are measured against."""

    check: str
    dataset: str
    severity: str
    scope: str
    count: Column
    total: Column | None = None
    category: str | None = None


def evaluate(rules: Sequence[Rule], scopes: Mapping[str, DataFrame]) -> DataFrame:
    """One row per rule: position, category, dataset, check, severity, record_count, total_records.

    Every scope is scanned once, whatever the number of its rules; the wide one-row result of a scope is then
    turned into one row per rule.
    """
    by_scope: dict[str, list[tuple[int, Rule]]] = {}
    for position, rule in enumerate(rules, 1):
        by_scope.setdefault(rule.scope, []).append((position, rule))

    result = None
    for scope, members in by_scope.items():
        measures = []
        for position, rule in members:
            measures.append(F.coalesce(rule.count.cast("bigint"), F.lit(0).cast("bigint")).alias(f"count_{position}"))
            if rule.total is not None:
                measures.append(F.coalesce(rule.total.cast("bigint"), F.lit(0).cast("bigint")).alias(f"total_{position}"))
        rows = F.array(
            *[
                F.struct(
                    F.lit(position).alias("position"),
                    F.lit(rule.category).cast("string").alias("category"),
                    F.lit(rule.dataset).alias("dataset"),
                    F.lit(rule.check).alias("check"),
                    F.lit(rule.severity).alias("severity"),
                    F.col(f"count_{position}").alias("record_count"),
                    (F.col(f"total_{position}") if rule.total is not None else F.lit(None).cast("bigint")).alias(
                        "total_records"
                    ),
                )
                for position, rule in members
            ]
        )
        part = scopes[scope].agg(*measures).select(F.inline(rows))
        result = part if result is None else result.unionByName(part)
    return result


def status_for(record_count: Column, severity: Column) -> Column:
    """PASS without violations, else FAIL, WARNING or INFO by severity."""
    return (
        F.when(record_count == 0, "PASS")
        .when(severity == CRITICAL, "FAIL")
        .when(severity == WARNING, "WARNING")
        .otherwise("INFO")
    )


# ------------------------------------------------------------------ measures over table rows


def missing(*columns: str) -> Column:
    """Rows where any of the columns is NULL."""
    condition = F.lit(False)
    for column in columns:
        condition = condition | F.col(column).isNull()
    return F.count_if(condition)


def negative(column: str) -> Column:
    return F.count_if(F.col(column) < 0)


def equal_to(column: str, value: object) -> Column:
    return F.count_if(F.col(column) == F.lit(value))


def outside(column: str, allowed: Sequence[str]) -> Column:
    """Known values that are not in the allowed set."""
    return F.count_if(F.col(column).isNotNull() & ~F.col(column).isin(*allowed))


def recorded_before(later: str, earlier: str) -> Column:
    return F.count_if(F.col(later) < F.col(earlier))


def not_matching(column: str, pattern: str) -> Column:
    """Values that do not match; a missing value does not match either."""
    return F.count_if(~F.coalesce(F.col(column).rlike(pattern), F.lit(False)))


def rows() -> Column:
    return F.count(F.lit(1))
