"""Exports of results for people and dashboards."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from merchlens.sources.jobs import counted

TIMESTAMP_PATTERN = "yyyy-MM-dd HH:mm:ss"


class EmptyViewError(Exception):
    """A dashboard view has no rows."""


def query(spark: SparkSession, sql: str, params: Mapping[str, object] | None = None) -> DataFrame:
    """Run one SELECT with named parameters, written as :name."""
    return spark.sql(sql, args=dict(params or {}))


def table_columns(data: DataFrame) -> list[tuple[str, str]]:
    """Column names and types in order."""
    return [(field.name, field.dataType.simpleString()) for field in data.schema]


def write_csv(data: DataFrame, path: str) -> None:
    """CSV with a header; NULL is an empty field. Large results stay spread over part files."""
    (
        data.write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("timestampNTZFormat", TIMESTAMP_PATTERN)
        .csv(path)
    )


def export_results(results: Mapping[str, DataFrame], folder: str) -> dict[str, int]:
    """One CSV folder per named result; returns the rows of each.

    Results are reports of bounded size, so each is one ordered file.
    """
    return {
        name: counted(data, lambda rows, name=name: write_csv(rows.coalesce(1), f"{folder}/{name}"))
        for name, data in results.items()
    }


def flags_as_numbers(data: DataFrame) -> DataFrame:
    """Boolean columns as 1/0 so that dashboards can add them up; NULL stays NULL."""
    return data.select(
        [
            F.col(f.name).cast("int").alias(f.name) if isinstance(f.dataType, T.BooleanType) else F.col(f.name)
            for f in data.schema
        ]
    )


def require_rows(views: Mapping[str, DataFrame]) -> None:
    """Raise when a view is empty."""
    empty = [name for name, data in views.items() if data.isEmpty()]
    if empty:
        raise EmptyViewError(f"View(s) returned no rows: {', '.join(empty)}")


def export_dashboards(views: Mapping[str, DataFrame], folder: str) -> dict[str, int]:
    """Export every view with numeric flags; returns the rows written per view."""
    require_rows(views)
    return {
        name: counted(flags_as_numbers(data), lambda rows, name=name: write_csv(rows, f"{folder}/{name}"))
        for name, data in views.items()
    }


def write_json(data: DataFrame, path: str) -> None:
    """A small result set as JSON lines, NULL fields kept."""
    data.coalesce(1).write.mode("overwrite").option("ignoreNullFields", False).json(path)


def refresh_views(spark: SparkSession, folders: Mapping[str, str], database: str | None = None) -> list[str]:
    """Create or replace a view in the catalog per stored table, in the given order; other sessions see them too.

    A view names the files it reads, so it stays as it is until it is replaced, and needs nothing of this session.
    """
    for name, folder in folders.items():
        place = f"`{database}`.`{name}`" if database else f"`{name}`"
        path = folder.replace("`", "``")
        spark.sql(f"CREATE OR REPLACE VIEW {place} AS SELECT * FROM parquet.`{path}`")
    return list(folders)
