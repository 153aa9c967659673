"""The uniform shuffle: exact sizes, the law of the draws, and the same deal however Spark cuts the files."""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from merchlens.llm import queries, sharding

FOLDER = "/root/testdata/sf0.001"


def layout(rows):
    """Slots per shard."""
    shards = {}
    for r in rows:
        shards.setdefault(r.shard, []).append(r.slot)
    return shards


def check_layout(rows, total, shards=16):
    slots = layout(rows)
    sizes = [len(slots.get(j, [])) for j in range(shards)]
    assert sum(sizes) == total == len(rows) and max(sizes) - min(sizes) <= 1 and set(slots) <= set(range(shards))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_the_query_against_its_table(spark):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    rows = queries.op12_sharding(spark, FOLDER).collect()
    check_layout(rows, len(documents))
    expected = Counter((d.doc_id, len((d.text or "").encode()) + 1, zlib.crc32((d.text or "").encode())) for d in documents)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == expected
    assert {(r.law, r.grown_shard) for r in rows} == {("rows", None)}


def test_awkward_rows_travel_whole(spark, tmp_path):
    rows = [(1, "a", 5, "m"), (1, "a", 5, "m"), (2, "", None, None), (3, None, 1, "m"), (None, "x" * 200_000, 1, "m"), *[(9, "copy", i, None) for i in range(95)]]
    data = spark.createDataFrame(rows, "doc_id long, text string, slot long, _metadata string")
    data = data.select("*", *[F.lit(7).alias(c) for c in ("shard", "file", "block", "place", "size", "row", "begins", "a.b", "c`d")])
    data.repartition(3).write.parquet(f"{tmp_path}/t")
    small = sharding.Settings(shards=7, block=8)
    for dealt in (sharding.shuffle_files(spark, f"{tmp_path}/t", small), sharding.shuffle(data, small)):
        found = dealt.collect()
        check_layout(found, 100, 7)
        assert Counter(tuple(r.row) for r in found) == Counter(tuple(r) for r in data.collect())
        assert found[0].row.__fields__ == data.columns


def test_files_of_a_shard_hold_its_slots_in_order(spark):
    dealt = sharding.shuffle_files(spark, f"{FOLDER}/documents.parquet", sharding.Settings(shards=3, block=10))
    lasts = dealt.select("shard", "slot", F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("at")).collect()
    by_file = {}
    for r in sorted(lasts, key=lambda r: r["at"]):
        by_file.setdefault(r.file, []).append((r.shard, r.slot))
    assert all(places == sorted(places) and len({s for s, _ in places}) == 1 for places in by_file.values())


@pytest.mark.parametrize("rows", [0, 1, 5])
def test_fewer_rows_than_shards(spark, rows):
    found = sharding.shuffle(spark.range(rows).withColumn("text", F.lit(None).cast("string"))).collect()
    check_layout(found, rows)


def test_the_same_deal_however_the_files_are_split(spark, tmp_path):
    spark.range(3000).repartition(4).write.parquet(f"{tmp_path}/t")
    settings = sharding.Settings(shards=5, block=64)

    def deal(settings=settings):
        return {r.row.id: (r.shard, r.slot) for r in sharding.shuffle_files(spark, f"{tmp_path}/t", settings).collect()}

    first = deal()
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.shuffle.partitions", "5")
    try:
        assert deal() == first
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.set("spark.sql.shuffle.partitions", "2")
    assert deal(sharding.Settings(shards=5, block=64, seed=1)) != first
    # Rows that were neighbours are not kept together, in shards nor in slots.
    together = np.mean([first[i][0] == first[i + 1][0] for i in range(2999)])
    assert abs(together - 0.2) < 0.04
    slots = np.array([first[i][1] for i in range(3000)])
    assert abs(np.corrcoef(np.arange(3000), slots)[0, 1]) < 0.08


@pytest.mark.parametrize(("good", "bad", "drawn"), [(5, 7, 4), (40, 3, 41), (1000, 3000, 600), (1, 1, 1)])
def test_draws_follow_the_hypergeometric_law(good, bad, drawn):
    rng = np.random.default_rng(3)
    ours = Counter(sharding.hypergeometric(rng, good, bad, drawn) for _ in range(6000))
    theirs = Counter(rng.hypergeometric(good, bad, drawn, 60_000).tolist())
    both = sorted(set(ours) | set(theirs))
    # Largest gap of the distribution functions; 0.03 is beyond the 0.1 % quantile for these sample sizes.
    gap = np.abs(np.cumsum([ours[k] / 6000 - theirs[k] / 60_000 for k in both])).max()
    assert gap < 0.03 and min(ours) >= max(0, drawn - bad) and max(ours) <= min(good, drawn)


def test_draws_from_more_than_a_billion():
    rng = np.random.default_rng(4)
    found = np.array([sharding.hypergeometric(rng, 10**10, 15 * 10**10, 10**8) for _ in range(300)], float)
    expected, spread = 10**8 / 16, np.sqrt(10**8 * 15 / 256)
    assert abs(found.mean() - expected) < 4 * spread / np.sqrt(300) and 0.8 < found.std() / spread < 1.2
    assert sharding.hypergeometric(rng, 0, 5, 3) == 0 and sharding.hypergeometric(rng, 5, 0, 3) == 3


def test_matrix_sums_and_law_over_two_steps(spark):
    sizes = [3, 0, 10, 1, 25, 11]
    matrix = sharding.deal(np.random.default_rng(1), sizes, [20, 20, 10])
    assert matrix.sum(axis=1).tolist() == sizes and matrix.sum(axis=0).tolist() == [20, 20, 10] and (matrix >= 0).all()
    blocks = spark.createDataFrame([(f"f{i}", b, 40) for i in range(30) for b in range(10)], "file string, block long, size long")
    rows = sharding.communication_matrix(blocks, sharding.Settings(shards=4)).collect()
    shares = np.array([np.diff([*r.begins, r["size"]]) for r in rows])
    assert shares.sum(axis=0).tolist() == [3000] * 4 and (shares.sum(axis=1) == 40).all()
    # 40 rows over 4 shards vary as 40 * 1/4 * 3/4, but for the finite table.
    assert 6 < shares.var() < 9
    arrives = sorted((r.arrives[2], int(s)) for r, s in zip(rows, shares[:, 2]))
    assert [a for a, _ in arrives if a is not None][0] == 0
    assert all(a + s == b for (a, s), (b, _) in zip(arrives, arrives[1:]) if s)


def test_keyed_permutations():
    for size in (1, 2, 3, 4, 5, 17, 64, 65, 5000):
        places = np.arange(size)
        key = np.full(size, 12345, np.uint64)
        found = sharding.permuted(places, np.full(size, size), key)
        assert sorted(found.tolist()) == places.tolist()
    other = sharding.permuted(places, np.full(size, size), key + np.uint64(1))
    assert (found != other).mean() > 0.9 and (found != places).mean() > 0.9
    # Over many keys every place goes everywhere equally often.
    keys = np.random.default_rng(2).integers(0, 1 << 63, 20_000).astype(np.uint64)
    for place in (0, 4):
        hits = np.bincount(sharding.permuted(np.full(20_000, place), np.full(20_000, 5), keys), minlength=5)
        assert ((hits - 4000) ** 2 / 4000).sum() < 18.5
