"""SimHash near-duplicates by multi-index hashing, with every link kept.

Fingerprints of whole texts are cut into segments. Two fingerprints within the allowed distance agree in at least one
segment up to a small radius (pigeonhole), so each fingerprint enumerates the small Hamming ball around each of its
segments, fetches the table entries with those segment values, and the complete distances are verified.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchlens.llm.components import components
from merchlens.llm.shared import free_name, map_batches, record, row_key, text_key, word_pieces, written

BITS = 64
SEED = 42
SPACE = 0x20
LOW_BITS = np.uint64(0x0101010101010101)


@dataclass(frozen=True)
class SimHash:
    """Parameters: words per shingle, linking distance, number of segments, entries a table row list may pair up."""

    words: int = 4
    distance: int = 4
    segments: int = 3
    bucket: int = 512

    def layout(self) -> list[tuple[int, int, int]]:
        """(shift, width, radius) per segment.

        With distance r and m segments, a pair further apart than the radius in every segment would differ in more
        than r bits when the first r - m * (r // m) + 1 segments use radius r // m and the others one less.
        """
        floor, rest = divmod(self.distance, self.segments)
        widths = [BITS // self.segments + (i < BITS % self.segments) for i in range(self.segments)]
        shifts = [sum(widths[:i]) for i in range(self.segments)]
        return [(s, w, floor if i <= rest else floor - 1) for i, (s, w) in enumerate(zip(shifts, widths))]


def fingerprint(text: str | None, words: int = 4) -> int:
    """Majority bits of the XXH64 hashes of all shingles, repeats included; 0 without words."""
    ones, total, carry = np.zeros(BITS, np.int64), 0, []
    for piece in word_pieces(text):
        sequence = carry + piece
        count = len(sequence) - words + 1
        if count > 0:
            joined = b" ".join([*sequence, b""])
            gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == SPACE)
            starts, digest = [0, *(gaps[: count - 1] + 1).tolist()], xxhash.xxh64_digest
            ones += _ones(b"".join([digest(joined[a:b], SEED) for a, b in zip(starts, gaps[words - 1 :].tolist())]))
            total += count
            carry = sequence[len(sequence) - words + 1 :]
        else:
            carry = sequence
    if not total and carry:
        ones, total = _ones(xxhash.xxh64_digest(b" ".join(carry), SEED)), 1
    return sum(1 << int(i) for i in np.flatnonzero(2 * ones > total)) if total else 0


def _ones(digests: bytes) -> np.ndarray:
    """How many of the 64-bit hashes, highest byte first, have each bit set; lowest bit first.

    Each byte of a masked word counts one bit of its own; 255 words can be added before a byte overflows.
    """
    values = np.frombuffer(digests, ">u8").astype("<u8")
    blocks = np.arange(0, len(values), 255)
    ones = np.empty((8, 8), np.int64)
    for shift in range(8):
        sums = np.add.reduceat((values >> np.uint64(shift)) & LOW_BITS, blocks)
        ones[:, shift] = sums.view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    return ones.ravel()


def fingerprints(documents: DataFrame, id_column: str = "doc_id", text: str = "text", words: int = 4) -> DataFrame:
    """(doc_id long, text_key long, fp long) per row of `documents`."""
    schema = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("fp", pa.int64())])

    def work(batches):
        for batch in batches:
            values = np.array([fingerprint(t, words) for t in batch.column(2).to_pylist()], np.uint64)
            yield record(schema, doc_id=batch.column(0), text_key=batch.column(1), fp=values.view(np.int64))

    rows = documents.select(F.col(id_column).cast("long").alias("doc_id"), text_key(text).alias("text_key"), F.col(text).cast("string").alias("text"))
    return map_batches(rows, work, "doc_id long, text_key long, fp long")


def _segment(shift: int, width: int) -> Column:
    return F.shiftrightunsigned("fp", shift).bitwiseAND(F.lit((1 << width) - 1).cast("long"))


def _table(fps: DataFrame, layout) -> DataFrame:
    entries = F.array(*[F.struct(F.lit(i).alias("segment"), _segment(s, w).alias("key")) for i, (s, w, _) in enumerate(layout)])
    return fps.select("fp", F.inline(entries))


def _probes(fps: DataFrame, layout) -> DataFrame:
    """Keys of the Hamming balls, each unordered pair of keys from one side only.

    Of two different keys the one with the lower value probes upwards, so half of each ball is enumerated.
    """
    balls = []
    for i, (shift, width, radius) in enumerate(layout):
        masks = [sum(1 << b for b in flips) for n in range(1, radius + 1) for flips in combinations(range(width), n)]
        key = _segment(shift, width)
        around = F.filter(
            F.transform(F.array(*[F.lit(m).cast("long") for m in (0, *masks)]), lambda m: key.bitwiseXOR(m)), lambda k: k >= key
        )
        balls.append(F.transform(around, lambda k: F.struct(F.lit(i).alias("segment"), k.alias("key"), (k == key).alias("same"))))
    return fps.select("fp", F.inline(F.flatten(F.array(*balls))))


def _near(a: str, b: str, distance: int) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= distance


def links(fps: DataFrame, settings: SimHash = SimHash()) -> DataFrame:
    """Pairs (a, b) that connect exactly the distinct fingerprints connected by distances within the limit.

    Buckets of up to `bucket` entries are paired up and verified, which finds each close pair. Where very many
    different fingerprints share a segment value, as in a large group of near copies, the pairs of a bucket grow
    with its square; the fingerprints that touch such buckets are linked through midpoints instead (see
    `_through_midpoints`), in rows proportional to their number, and lose no connection.
    """
    layout = settings.layout()
    table, probes = _table(fps, layout), _probes(fps, layout)
    full = written(table.groupBy("segment", "key").count().where(F.col("count") > settings.bucket).drop("count"), "full")
    dense = None
    if not full.isEmpty():
        touching = table.join(full, ["segment", "key"], "left_semi").select("fp").unionByName(
            probes.join(full, ["segment", "key"], "left_semi").select("fp")
        )
        dense = written(touching.distinct(), "dense")
        table = table.join(full, ["segment", "key"], "left_anti")
    other = table.withColumnRenamed("fp", "other")
    found = probes.join(
        other,
        (probes.segment == other.segment) & (probes.key == other.key)
        & (~F.col("same") | (F.col("fp") < F.col("other"))) & _near("fp", "other", settings.distance),
    ).select(F.col("fp").alias("a"), F.col("other").alias("b"))
    return found if dense is None else found.unionByName(_through_midpoints(dense, settings.distance))


def _through_midpoints(fps: DataFrame, distance: int) -> DataFrame:
    """Stars over shared midpoints: two values lie within `distance` exactly if balls of half the radius meet.

    Every value spreads to all values within distance // 2 (and the other side to the rest for odd distances); those
    that meet in a point are linked to the smallest one there. Connections are the same as those of all close pairs.
    """
    if distance % 2:
        raise ValueError("midpoints need an even distance")
    radius = distance // 2
    signed = lambda m: m - (1 << BITS) if m >> (BITS - 1) else m
    masks = np.array(
        [signed(sum(1 << b for b in flips)) for n in range(radius + 1) for flips in combinations(range(BITS), n)], np.int64
    )
    schema = pa.schema([("point", pa.int64()), ("fp", pa.int64())])

    def work(batches):
        for batch in batches:
            for value in batch.column(0).to_numpy():
                yield record(schema, point=value ^ masks, fp=np.full(len(masks), value))

    spread = map_batches(fps, work, "point long, fp long")
    smallest = spread.groupBy("point").agg(F.min("fp").alias("a"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return spread.join(smallest, "point").where("a < fp").select("a", F.col("fp").alias("b")).distinct()


def near_duplicates(documents: DataFrame, id_column: str = "doc_id", text: str = "text", settings: SimHash = SimHash()) -> DataFrame:
    """One row per row of `documents`: doc_id, text_key, fp, component_id.

    Texts with equal fingerprints or a chain of fingerprints within `distance` bits form a component, named after its
    smallest doc_id. NULL and empty texts have fingerprint 0 and are linked like any other. Equal fingerprints are
    one node, so copies cost a group, not pairs. A NULL doc_id never names a component unless all are NULL; repeated
    rows each get their row. Columns other than id and text are not read. No rows give no rows.
    """
    return _grouped(documents, id_column, text, settings).drop("root")


def _grouped(documents: DataFrame, id_column: str, text: str, settings: SimHash) -> DataFrame:
    """The rows of `near_duplicates` and root, the smallest fingerprint of the component, which no other shares."""
    rows = written(fingerprints(documents, id_column, text, settings.words), "fingerprints")
    distinct = written(rows.groupBy("fp").agg(F.min("doc_id").alias("lowest")), "distinct")
    parts = components(links(distinct.select("fp"), settings), "a", "b")
    rooted = distinct.join(parts.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = rooted.groupBy("root").agg(F.min("lowest").alias("component_id"))
    by_print = rooted.where("root <> fp").join(named, "root").select("fp", "component_id", "root")
    alone = rooted.where("root = fp").join(named, "root").select("fp", "component_id", "root")
    return rows.join(by_print.unionByName(alone), "fp").select("doc_id", "text_key", "fp", "component_id", "root")


def keep_one(documents: DataFrame, settings: SimHash = SimHash()) -> DataFrame:
    """The rows of `documents` without near-duplicates: of each component the row with the smallest doc_id stays.

    Between rows of that doc_id the smallest text hash wins, and of rows equal in both one stays. All columns are
    kept. Components without any doc_id keep one row, and different texts under one doc_id are components of their own.
    """
    return keep_first(documents, _grouped(documents, "doc_id", "text", settings))


def keep_first(documents: DataFrame, grouped: DataFrame) -> DataFrame:
    """The rows of `documents` that `keep_one` keeps of the components in `grouped` (doc_id, text_key, root)."""
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("text_key"))
    # Not by component_id, which is NULL without ids and equal where an id repeats with different texts.
    best = grouped.groupBy("root").agg(F.min(order).alias("first"))
    # Other columns of `documents` may have any name, so rows are met by one column under a name that none has.
    key = free_name(documents)
    first = best.select(row_key(F.col("first.doc_id"), F.col("first.text_key")).alias(key))
    copies = grouped.groupBy(row_key(F.col("doc_id"), F.col("text_key")).alias(key)).agg(F.count(F.lit(1)).alias("copies"))
    chosen = written(first.join(copies, key).select(key, "copies"), "kept")
    keyed = documents.withColumn(key, row_key(F.col("doc_id"), text_key()))
    once = keyed.join(chosen.where("copies = 1").select(key), key, "left_semi").drop(key)
    repeated = chosen.where("copies > 1").select(key)
    if repeated.isEmpty():
        return once
    return once.unionByName(keyed.join(repeated, key, "left_semi").dropDuplicates([key]).drop(key))
