"""Runs driver queries and their SQL side by side: python -m checks.compare [folder] [name ...]."""

from __future__ import annotations

import sys
import time
from collections.abc import Iterable

import duckdb

from checks import driver_queries, oracle

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
)


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection


def _cell(value):
    return f"{value:.17g}" if isinstance(value, float) else value


def _rows(names: list[str], rows: Iterable) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(names)), key=names.__getitem__)
    table = [tuple(_cell(row[i]) for i in order) for row in rows]
    return [names[i] for i in order], sorted(table, key=lambda r: tuple((v is not None, str(v)) for v in r))


def compare(spark, connection, folder: str, name: str) -> str | None:
    """None when both sides agree, else what differs first."""
    frame = driver_queries.queries()[name](spark, folder)
    ours = _rows(frame.columns, frame.collect())
    result = connection.execute(oracle.statements()[name])
    theirs = _rows([c[0] for c in result.description], result.fetchall())
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} <> {theirs[0]}"
    if len(ours[1]) != len(theirs[1]):
        return f"{len(ours[1])} rows <> {len(theirs[1])}"
    for left, right in zip(ours[1], theirs[1]):
        if left != right:
            return "\n".join(
                f"  {c}: {a!r} <> {b!r}" for c, a, b in zip(ours[0], left, right) if a != b
            ) + f"\n  in {left}"
    return None


if __name__ == "__main__":
    from merchlens.session import build_session

    source = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    session = build_session(
        "compare",
        master="local[8]",
        **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8", "spark.log.level": "ERROR",
           "spark.driver.memory": "8g"},
    )
    database = connect(source)
    missing = set(driver_queries.queries()) ^ set(oracle.statements())
    print("without counterpart:", sorted(missing))
    failed = 0
    for query_name in sys.argv[2:] or driver_queries.queries():
        if query_name in missing:
            continue
        begun = time.time()
        try:
            difference = compare(session, database, source, query_name)
        except Exception as error:
            difference = f"error: {str(error)[:700]}"
        failed += difference is not None
        print(f"{'ok  ' if difference is None else 'DIFF'} {query_name} {time.time() - begun:.1f}s", flush=True)
        if difference:
            print(difference, flush=True)
    print("differences:", failed)
