"""Uniform shuffle into shards of exact sizes by a hypergeometric communication matrix.

The rows of the files are taken in blocks. How many rows of each block go to each shard is drawn exactly: the counts
of a uniform shuffle follow a multivariate hypergeometric law. Each block then permutes its rows, the rows are
exchanged, and each shard permutes what it received. Every row's shard and slot follow from its file, its place in
the file and the seed alone, so a task that runs again after a loss deals its rows alike.

The matrix is drawn in two steps, which gives the same law: a bounded number of groups of blocks on the driver, the
blocks of each group in Spark. So the driver never sees the blocks.
"""

from __future__ import annotations

import uuid
import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from merchlens.llm.shared import map_batches, work_folder, written

GROUPS = 256
MIX = np.array([0xBF58476D1CE4E5B9, 0x94D049BB133111EB], np.uint64)
# What each round of the permutation adds to its key.
TURNS = np.arange(1, 7, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Settings:
    """Number of shards, seed, and the rows of a file that are permuted together."""

    shards: int = 16
    seed: int = 42
    block: int = 1 << 18


# ------------------------------------------------------------------ draws


def hypergeometric(rng: np.random.Generator, good: int, bad: int, drawn: int) -> int:
    """How many good ones are among `drawn` of good + bad, by inversion from the most likely number outwards.

    Ratios of neighbouring probabilities are exact, and nothing limits the sizes; numbers more than 40 standard
    deviations off, whose chance no double can hold, are not listed.
    """
    total = good + bad
    low, high = max(0, drawn - bad), min(drawn, good)
    if low == high:
        return low
    mode = min(max((drawn + 1) * (good + 1) // (total + 2), low), high)
    spread = 40 * (int(np.sqrt(drawn * (good / total) * (bad / total) * ((total - drawn) / max(total - 1, 1)))) + 2)
    up = np.arange(mode, min(high, mode + spread), dtype=np.float64)
    down = np.arange(mode, max(low, mode - spread), -1, dtype=np.float64)
    rise = np.log((good - up) * (drawn - up)) - np.log((up + 1) * (bad - drawn + up + 1))
    fall = np.log(down * (bad - drawn + down)) - np.log((good - down + 1) * (drawn - down + 1))
    chances = np.exp(np.concatenate([np.cumsum(fall)[::-1], [0.0], np.cumsum(rise)]))
    sums = np.cumsum(chances)
    return mode - len(down) + int(min(np.searchsorted(sums, rng.random() * sums[-1], side="right"), len(sums) - 1))


def deal(rng: np.random.Generator, sizes: list[int], room: list[int]) -> np.ndarray:
    """The communication matrix: how many of each part's rows go to each shard when all rows are shuffled uniformly.

    Row sums are `sizes`, column sums are `room`; both add up to the same.
    """
    left = np.array(room, np.int64)
    matrix = np.zeros((len(sizes), len(room)), np.int64)
    for i, size in enumerate(sizes):
        others, open_rows = int(left.sum()), int(size)
        for j in range(len(room)):
            others -= int(left[j])
            matrix[i, j] = hypergeometric(rng, int(left[j]), others, open_rows)
            open_rows -= int(matrix[i, j])
        left -= matrix[i]
    return matrix


def permuted(places: np.ndarray, size: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Places 0 .. size - 1 under a keyed permutation of that range, each with its own size and key.

    The range turns by a keyed step, which makes every place equally likely. A Feistel network permutes the smallest
    even number of bits that holds the range, and places that land outside of it walk on until they are inside.
    """
    half = np.ones(len(places), np.uint64)
    for bits in range(1, 32):
        half += (size.astype(np.uint64) > np.uint64(1) << np.uint64(2 * bits)).astype(np.uint64)
    mask, size = (np.uint64(1) << half) - np.uint64(1), size.astype(np.uint64)
    turned = key * MIX[0]
    found = (places.astype(np.uint64) + (turned ^ turned >> np.uint64(31)) % size) % size
    walking = np.arange(len(places))
    while len(walking):
        left, right = found[walking] >> half[walking], found[walking] & mask[walking]
        for turn in TURNS:
            mixed = (right + key[walking] + turn) * MIX[0]
            mixed = (mixed ^ mixed >> np.uint64(29)) * MIX[1]
            left, right = right, (left ^ mixed >> np.uint64(32)) & mask[walking]
        found[walking] = left << half[walking] | right
        walking = walking[found[walking] >= size[walking]]
    return found.astype(np.int64)


# ------------------------------------------------------------------ the shuffle


def _places(spark: SparkSession, path: str, settings: Settings) -> DataFrame:
    """All rows of the Parquet files as one struct `row`, with file, block and place within the block."""
    data = spark.read.parquet(path)
    whole = F.struct(*[F.col(f"`{c.replace('`', '``')}`") for c in data.columns]) if data.columns else F.struct(F.lit(None).alias("nothing"))
    meta = data.metadataColumn("_metadata")
    return data.select(
        whole.alias("row"), meta["file_path"].alias("file"), F.floor(meta["row_index"] / settings.block).cast("long").alias("block"),
        (meta["row_index"] % settings.block).cast("int").alias("place"),
    )


def communication_matrix(blocks: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(file, block, size, begins, arrives): per block, where each shard's share of its permuted rows begins, and how
    many rows of blocks before it each shard receives. `blocks` is (file, block, size).
    """
    grouped = blocks.withColumn("group", F.pmod(F.xxhash64("file", "block"), F.lit(GROUPS)).cast("int"))
    # One row for each of at most 256 groups.
    sums = sorted((r.group, r.size) for r in grouped.groupBy("group").agg(F.sum("size").alias("size")).collect())
    total = sum(size for _, size in sums)
    room = [total // settings.shards + (j < total % settings.shards) for j in range(settings.shards)]
    shares = deal(np.random.default_rng(settings.seed), [size for _, size in sums], room)
    before = np.cumsum(shares, axis=0) - shares
    found = {group: (shares[i].tolist(), before[i].tolist()) for i, (group, _) in enumerate(sums)}

    def work(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        mine, earlier = found[int(key[0])]
        frame = frame.sort_values(["file", "block"], ignore_index=True)
        matrix = deal(np.random.default_rng([settings.seed, 1, int(key[0])]), frame["size"].tolist(), mine)
        return pd.DataFrame({
            "file": frame.file, "block": frame.block, "size": frame["size"], "begins": (np.cumsum(matrix, axis=1) - matrix).tolist(),
            "arrives": (np.cumsum(matrix, axis=0) - matrix + np.array(earlier)).tolist(),
        })

    return grouped.groupBy("group").applyInPandas(work, "file string, block long, size long, begins array<long>, arrives array<long>")


def _dealt(rows: DataFrame, matrix: DataFrame, room: np.ndarray, settings: Settings) -> DataFrame:
    """(row, shard, slot): blocks permute, and each shard permutes the rows in the order in which they arrive."""
    schema = T.StructType([rows.schema["row"], T.StructField("shard", T.IntegerType()), T.StructField("slot", T.LongType())])
    seed = settings.seed
    keys = np.random.default_rng([seed, 2]).integers(0, 1 << 63, settings.shards).astype(np.uint64)

    def work(batches):
        held, order = None, None
        for batch in batches:
            files, blocks = (batch.column(i).to_pylist() for i in (1, 2))
            places, sizes = (batch.column(i).to_numpy() for i in (3, 4))
            shard, slot = np.zeros(len(places), np.int32), np.zeros(len(places), np.int64)
            edges = [0, *(i for i in range(1, len(files)) if (files[i], blocks[i]) != (files[i - 1], blocks[i - 1])), len(files)]
            for a, b in zip(edges, edges[1:]):
                if a == b:
                    continue
                if held != (files[a], blocks[a]):
                    held = files[a], blocks[a]
                    order = np.random.default_rng([seed, 3, zlib.crc32(held[0].encode()), held[1]]).permutation(int(sizes[a])).astype(np.int32)
                begins, arrives = (np.array(batch.column(i)[a].as_py(), np.int64) for i in (5, 6))
                at = order[places[a:b]]
                shard[a:b] = np.searchsorted(begins, at, side="right") - 1
                slot[a:b] = arrives[shard[a:b]] + at - begins[shard[a:b]]
            slot = permuted(slot, room[shard], keys[shard])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(shard), pa.array(slot)], names=["row", "shard", "slot"])

    joined = rows.join(matrix, ["file", "block"]).select("row", "file", "block", "place", "size", "begins", "arrives")
    return map_batches(joined, work, schema)


def shuffle_files(spark: SparkSession, path: str, settings: Settings = Settings()) -> DataFrame:
    """All rows of Parquet files in shards: (shard int, slot long, row struct), written to and read from the work folder.

    The rows are a uniform shuffle: shards differ by one row at most, slots count from 0 without gaps in each shard,
    and files of a shard hold its slots in order. Rows travel whole, whatever their columns are called; NULLs, empty
    and repeated rows are rows like any other, and equal rows are dealt independently, so a group of copies spreads over
    all shards. No rows give no rows. The same files and seed give the same shuffle.
    """
    rows = _places(spark, path, settings)
    # Reads no column of the files.
    blocks = written(rows.groupBy("file", "block").agg(F.count(F.lit(1)).alias("size")), "blocks")
    total = blocks.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    n = settings.shards
    room = np.array([total // n + (j < total % n) for j in range(n)], np.int64)
    first = np.cumsum(room) - room
    matrix = written(communication_matrix(blocks, settings), "matrix")
    dealt = _dealt(rows, matrix, room, settings)
    # Equal stretches of the shards' rows, one a task; the number of tasks is the session's for a shuffle.
    tasks = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    offset = F.element_at(F.array(*[F.lit(int(f)).cast("long") for f in first]), F.col("shard") + 1) + F.col("slot")
    task = F.floor(offset / (F.lit(max(total, 1)) / F.lit(tasks))).cast("int")
    exchanged = dealt.repartitionById(tasks, F.least(task, F.lit(tasks - 1))).sortWithinPartitions("shard", "slot")
    folder = f"{work_folder(spark)}/merchlens-shards-{uuid.uuid4().hex}"
    exchanged.write.partitionBy("shard").parquet(folder)
    return spark.read.schema(T.StructType([*dealt.schema.fields])).parquet(folder).select("shard", "slot", "row")


def shuffle(data: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The same for the rows of any table, which are written first so that their places are fixed."""
    spark = data.sparkSession
    folder = f"{work_folder(spark)}/merchlens-rows-{uuid.uuid4().hex}"
    data.write.parquet(folder)
    return shuffle_files(spark, folder, settings)
