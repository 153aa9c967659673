"""Helpers of the text operators: work folder, written hand-overs, Arrow batches, words, bounded pieces."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Rows that a worker turns into Python objects at a time; Spark itself bounds the bytes of the Arrow batches they come in.
TEXTS_PER_BATCH = 256
DEFAULT_PER_BATCH = "10000"
PER_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
PIECE_BYTES = 1 << 20

Batches = Iterable[pa.RecordBatch]


def work_folder(spark: SparkSession) -> str:
    """The shared folder the cluster names in spark.checkpoint.dir.

    In local mode, where one machine holds everything, a folder under the warehouse serves where it is unset.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("Set spark.checkpoint.dir to a folder every executor can reach")
        folder = f"{spark.conf.get('spark.sql.warehouse.dir')}/checkpoints"
    return folder.rstrip("/")


@contextmanager
def short_batches(spark: SparkSession) -> Iterator[None]:
    """Arrow batches of few rows while a job of an operator starts, where the session has Spark's own default.

    The setting is read when the job is planned; afterwards the session has its own again.
    """
    if spark.conf.get(PER_BATCH) != DEFAULT_PER_BATCH:
        yield
        return
    spark.conf.set(PER_BATCH, str(TEXTS_PER_BATCH))
    try:
        yield
    finally:
        spark.conf.set(PER_BATCH, DEFAULT_PER_BATCH)


def written(data: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """The rows of `data`, computed once and read back from a new folder of the shared work folder.

    With `by`, rows of different values of that column lie apart, so that a filter on it reads only its own. Cuts the lineage like checkpoint() does, in compressed columns that later steps can prune. Survives the loss of
    executors because nothing of it is kept on them.
    """
    spark = data.sparkSession
    folder = f"{work_folder(spark)}/merchlens-{name}-{uuid.uuid4().hex}"
    with short_batches(spark):
        (data.write.partitionBy(by) if by else data.write).parquet(folder)
    return spark.read.schema(data.schema).parquet(folder)


def map_batches(data: DataFrame, work: Callable[[Batches], Iterator[pa.RecordBatch]], schema: str | T.StructType) -> DataFrame:
    """mapInArrow whose work sees short slices of the batches, since texts are long; the session's settings stay as they are."""

    def sliced(batches: Batches) -> Iterator[pa.RecordBatch]:
        return work(b.slice(begin, TEXTS_PER_BATCH) for b in batches for begin in range(0, b.num_rows, TEXTS_PER_BATCH))

    return data.mapInArrow(sliced, schema)


def remainder(column: str, modulus: int) -> Column:
    """crc32 of the id's decimal text modulo a number; NULL for a NULL id."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % F.lit(modulus)


def text_key(column: str = "text") -> Column:
    """A 64-bit hash of a text; NULL hashes differently from empty."""
    return F.when(F.col(column).isNull(), F.lit(-1).cast("long")).otherwise(F.xxhash64(F.col(column)))


def free_name(data: DataFrame, name: str = "key") -> str:
    """A column name that the table does not have."""
    taken = {c.lower() for c in data.columns}
    while name in taken:
        name += "_"
    return name


def row_key(doc_id: Column, key: Column) -> Column:
    """An id and a text hash as one value that is never NULL and tells a NULL id from every other."""
    number = doc_id.cast("long")
    return F.struct(number.isNull().alias("none"), F.coalesce(number, F.lit(0).cast("long")).alias("id"), key.alias("text"))


def drawn(*columns: str) -> Column:
    """A number in 0..1 fixed by the values of columns, spread evenly over different values."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 11) / F.lit(float(1 << 53))


def byte_pieces(data: bytes, size: int = PIECE_BYTES) -> Iterator[bytes]:
    """The bytes cut at ASCII white space into pieces of about `size`, so that splitting never holds a whole long text.

    A single word longer than `size` stays whole.
    """
    start, total = 0, len(data)
    while total - start > size:
        end = start + size
        while end < total and data[end] not in b" \t\n\v\f\r":
            end += 1
        yield data[start:end]
        start = end
    yield data[start:]


def word_pieces(text: str | None, size: int = PIECE_BYTES) -> Iterator[list[bytes]]:
    """Words `[^\\x20\\x09-\\x0D]+` of the whole text with A-Z lower-cased, as UTF-8, in lists of bounded length.

    bytes.lower and bytes.split touch ASCII only, which is exactly this definition. NULL gives no words.
    """
    data = (text or "").encode("utf-8", "surrogatepass")
    if len(data) <= size:
        yield data.lower().split()
    else:
        for piece in byte_pieces(data, size):
            yield piece.lower().split()


def record(schema: pa.Schema, **columns) -> pa.RecordBatch:
    """A batch from numpy arrays, lists or Arrow arrays by column name."""
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c := columns[f.name], (pa.Array, pa.ChunkedArray)) else pa.array(c, f.type) for f in schema], schema=schema
    )


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
