"""Approximate nearest neighbours with a permutation index.

A vector is represented by the order of its nearest pivots. Each task posts the vectors it reads in one inverted file
per pivot, with the pivot's place in the vector's order. A query adds up, over the postings of its own nearest pivots,
how well the places agree, which orders the vectors by footrule distance of the permutations; the nearest share of
them is reranked with the true distance. Every vector is indexed where it is read, and only results move.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from merchlens.llm.shared import drawn, map_batches, record, written

VECTORS_PER_INDEX = 8192


@dataclass(frozen=True)
class Settings:
    """Number of pivots, pivots kept per vector, share of the vectors that is reranked, queries handled in one pass."""

    pivots: int = 512
    kept: int = 96
    reranked: float = 0.25
    queries: int = 4096
    seed: int = 3


def usable(embedding: str = "embedding") -> Column:
    """Whether a vector takes part: not NULL, not empty, only finite components, and not all of them zero."""
    vector = F.col(embedding)
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(vector.isNotNull() & ~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), size)


def _collect(frame: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    table = frame.toArrow().combine_chunks()
    ids = table.column("vec_id").to_numpy().astype(np.int64)
    return ids, _matrix(table.column("embedding").combine_chunks(), size) if len(ids) else np.zeros((0, size))


def _orders(vectors: np.ndarray, pivots: np.ndarray, kept: int) -> np.ndarray:
    """The nearest pivots of each vector, nearest first, ties by pivot number."""
    distance = (pivots**2).sum(axis=1) - 2 * vectors @ pivots.T
    return np.argsort(distance, axis=1, kind="stable")[:, :kept]


class Index:
    """Inverted files of one set of vectors: per pivot the vectors that keep it and its value, kept - place."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, pivots: np.ndarray, kept: int):
        self.ids, self.vectors, self.kept = ids, vectors, kept
        orders = _orders(vectors, pivots, kept)
        flat = orders.ravel()
        by_pivot = np.argsort(flat, kind="stable")
        self.members = by_pivot // kept
        self.values = (kept - by_pivot % kept).astype(np.float32)
        self.bounds = np.searchsorted(flat[by_pivot], np.arange(len(pivots) + 1))

    def footrule_gain(self, order: np.ndarray) -> np.ndarray:
        """By how much shared pivots lower the footrule distance to each vector from that of disjoint orders.

        With a place counted as `kept` where a pivot is missing, a pivot at places a and b lowers the sum by
        2 * (kept - max(a, b)); half of that is added here.
        """
        gain = np.zeros(len(self.ids), np.float32)
        for place, pivot in enumerate(order):
            posted = slice(self.bounds[pivot], self.bounds[pivot + 1])
            # A vector is posted once per pivot, so the indexed addition meets no vector twice.
            gain[self.members[posted]] += np.minimum(self.values[posted], self.kept - place)
        return gain

    def search(self, query_id: int, query: np.ndarray, order: np.ndarray, k: int, reranked: float) -> tuple[np.ndarray, np.ndarray]:
        """(ids, distances) of the k nearest among the candidates, nearest first, ties by id, an id once."""
        gain = self.footrule_gain(order)
        own = self.ids == query_id
        gain[own] = -1
        number = min(len(gain) - int(own.sum()), max(int(np.ceil(reranked * len(gain))), 8 * k))
        if number <= 0:
            return np.zeros(0, np.int64), np.zeros(0)
        least = np.partition(gain, len(gain) - number)[len(gain) - number]
        # All vectors as near as the last candidate are reranked too: ties are not broken by position.
        found = np.flatnonzero((gain >= least) & ~own)
        distance = np.sqrt(((self.vectors[found] - query) ** 2).sum(axis=1))
        return _nearest(self.ids[found], distance, k)


def _nearest(ids: np.ndarray, distance: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ids, distance))
    ids, distance = ids[order], distance[order]
    # Rows that repeat an id count once, with their smallest distance.
    _, first = np.unique(ids, return_index=True)
    first = np.sort(first)[:k]
    return ids[first], distance[first]


def search(embeddings: DataFrame, is_query: Column, k: int = 10, settings: Settings = Settings()) -> DataFrame:
    """(query_id, rank, vec_id, score): for every query row its k nearest other rows found, by Euclidean distance.

    `is_query` is a condition on vec_id. Vectors that are NULL, empty, zero or hold NULL or non-finite components take
    no part, nor do those of another length than the most frequent one (the shorter of equally frequent lengths), nor
    rows without vec_id. Rows with the query's own id are no candidates; other rows that share an id count once. The
    distance is taken on the original vectors in double precision; ties go to the smaller vec_id. Queries come in
    blocks of bounded size, one after the other, each block sent to all tasks; every row is a candidate for every query.
    """
    rows = embeddings.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")
    ).where(F.col("vec_id").isNotNull() & usable())
    spark = embeddings.sparkSession
    lengths = rows.groupBy(F.size("embedding").alias("size")).count().orderBy(F.col("count").desc(), "size").first()
    output = "query_id long, vec_id long, score double"
    if lengths is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    size = lengths.size
    rows = rows.where(F.size("embedding") == size)
    # About twice `pivots` rows are drawn by hash, whatever the number of rows; equal vectors are one pivot.
    share = 2 * settings.pivots / max(lengths["count"], 2 * settings.pivots)
    sample = rows.where(drawn("vec_id", "embedding") <= share)
    pivots = np.unique(_collect(sample.orderBy(F.xxhash64(F.lit(settings.seed), "vec_id"), "vec_id").limit(settings.pivots), size)[1], axis=0)
    kept = min(settings.kept, len(pivots))
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
    wanted = rows.where(is_query)
    blocks = max(1, -(-wanted.count() // settings.queries))
    found = None
    for number in range(blocks):
        block = wanted.where(F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(blocks)) == number)
        query_ids, queries = _collect(block, size)
        orders = _orders(queries, pivots, kept)

        def work(batches, query_ids=query_ids, queries=queries, orders=orders):
            best = [(np.zeros(0, np.int64), np.zeros(0)) for _ in query_ids]
            for ids, vectors in _parts(batches, size):
                index = Index(ids, vectors, pivots, kept)
                for i, query_id in enumerate(query_ids):
                    near, distance = index.search(query_id, queries[i], orders[i], k, settings.reranked)
                    best[i] = _nearest(np.append(best[i][0], near), np.append(best[i][1], distance), k)
            if len(query_ids):
                yield record(
                    schema, query_id=np.repeat(query_ids, [len(b[0]) for b in best]),
                    vec_id=np.concatenate([b[0] for b in best]), score=np.concatenate([b[1] for b in best]),
                )

        # One block after the other, so that the driver and the tasks hold one at a time.
        part = written(map_batches(rows, work, output), "neighbours") if blocks > 1 else map_batches(rows, work, output)
        found = part if found is None else found.unionByName(part)
    once = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _parts(batches, size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The rows of a task in sets of bounded size, one index each."""
    ids, vectors, held = [], [], 0
    for batch in batches:
        ids.append(batch.column(0).to_numpy(zero_copy_only=False))
        vectors.append(_matrix(batch.column(1), size))
        held += batch.num_rows
        if held >= VECTORS_PER_INDEX:
            yield np.concatenate(ids), np.concatenate(vectors)
            ids, vectors, held = [], [], 0
    if held:
        yield np.concatenate(ids), np.concatenate(vectors)
