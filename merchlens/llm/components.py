"""Connected components by alternating large-star and small-star steps over written edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchlens.llm.shared import written


def _canonical(edges: DataFrame) -> DataFrame:
    """Distinct edges from the larger node `u` to the smaller node `v`, without loops."""
    return edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    """Link each node's larger neighbours to the smallest of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    lowest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    # A join, not a window: a node holding a third of all edges is split by adaptive execution.
    return both.join(lowest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Link each node and its smaller neighbours to the smallest of them."""
    lowest = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(lowest.select("u", F.col("m").alias("v")))


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, first: str, second: str) -> DataFrame:
    """(node, root) for every node of the whole-number edges, root being the smallest node it can reach.

    Loops, repeated and reversed edges are allowed; an edge with a NULL end links nothing. No node gathers its
    neighbours in memory: each step groups and joins, is written to the shared folder, and edges end as stars. The
    number of steps grows with the logarithm of the longest path. Without edges the result is empty.
    """
    current = written(_canonical(edges.select(F.col(first).alias("u"), F.col(second).alias("v"))), "edges")
    state = _state(current)
    while state[0]:
        current = written(_canonical(_small_star(_canonical(_large_star(current)))), "edges")
        before, state = state, _state(current)
        if state == before:
            break
    roots = current.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
