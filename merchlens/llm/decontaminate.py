"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

An alignment of a given score cannot avoid a number of the item's word pairs within a stretch of words, whatever its
edits are. While documents are cut to the passages where an item reaches that number, it is counted in how many documents
each pair occurs. Of P pairs of an item of which h cannot be avoided, every passage has one of any P - h + 1: the rarest
ones are the item's seeds. Passages are joined with the items by these seeds, and aligned word by word. So frequent
pairs join nothing, and no copy is lost, however many copies of an item there are.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchlens.llm.shared import free_name, map_batches, record, row_key, text_key, written

PIECE_CHARS = 1 << 20
# In texts of Latin letters and ASCII, letters and digits are kept and other characters separate words.
APART = bytes(c if c > 127 or chr(c).isalnum() else 0x20 for c in range(256))
OTHER = re.compile("[^\x00-\x7f\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]")
# Scripts written without spaces, each character of which is a word: Thai to Myanmar, Khmer, kana and bopomofo, CJK.
UNSPACED = "\u0e00-\u109f\u1780-\u17ff\u3040-\u312f\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U000323af"
WORD = re.compile(f"[{UNSPACED}]|[^\\W_{UNSPACED}]+")
# Where a text can be cut without cutting a word.
GAP = re.compile(f"[\\W_{UNSPACED}]")
FACTOR = np.uint64(0x9E3779B97F4A7C15)
# Words whose hits are looked up together.
STRETCH = 4096


@dataclass(frozen=True)
class Settings:
    """Words per n-gram, least normalised alignment score, and the most bytes of item text handled in one pass; larger
    benchmarks take several passes over the corpus.
    """

    words: int = 2
    score: float = 0.5
    block_bytes: int = 8 << 20

    def least_hits(self, length: int) -> int:
        """N-grams of an item of `length` words that every passage of the least score shares with it.

        A passage with m matches and e errors scores m - e and has its matches in e + 1 runs at most, so it shares
        m - (words - 1) * (e + 1) n-grams at least. With two words that is the least score less one, whatever e is;
        with more words e counts, which is at most the length less the least score.
        """
        least = math.ceil(self.score * length - 1e-9)
        return max(1, least - (self.words - 2) * (length - least) - (self.words - 1))

    def span(self, length: int) -> int:
        """Words of the longest passage of the least score: the item with a word inserted per match above it."""
        return length + max(0, length - math.ceil(self.score * length - 1e-9))


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased words as UTF-8; NULL has none.

    Runs of letters and digits of any script are words, and each character of a script without spaces is one;
    punctuation of any kind separates words.
    """
    lowered = (text or "").lower()
    if OTHER.search(lowered) is None:
        return lowered.encode("utf-8", "surrogatepass").translate(APART).split()
    return [w.encode("utf-8", "surrogatepass") for w in WORD.findall(lowered)]


def _pieces(text: str | None) -> Iterator[list[bytes]]:
    """Words of the whole text in bounded lists, cut between words."""
    text, start = text or "", 0
    while start < len(text):
        end = len(text)
        if end - start > PIECE_CHARS:
            gap = GAP.search(text, start + PIECE_CHARS)
            end = gap.start() if gap else end
        yield words_of(text[start:end])
        start = end


class Grams:
    """Finds the n-grams of a bounded set of items in texts.

    Words of the items are numbered from 1; an n-gram is the 64-bit mix of its numbers.
    """

    def __init__(self, items: list[str], words: int, settings: Settings = Settings()):
        self.words, self.numbers, self.of_item, lengths = words, {}, [], []
        for item in items:
            ids = np.array([self.numbers.setdefault(w, len(self.numbers) + 1) for w in words_of(item)], np.uint64)
            self.of_item.append(self.mix(ids))
            lengths.append(len(ids))
        found = [np.unique(keys) for keys in self.of_item]
        every = np.concatenate(found) if found else np.zeros(0, np.uint64)
        self.keys, counts = np.unique(every, return_counts=True)
        # Items of key k are owners[begins[k] : begins[k + 1]].
        owners = np.repeat(np.arange(len(items)), [len(f) for f in found])
        self.owners, self.begins = owners[np.argsort(every, kind="stable")], np.concatenate([[0], np.cumsum(counts)])
        self.needed = np.array([settings.least_hits(n) for n in lengths], np.int64)
        self.spans = np.array([settings.span(n) for n in lengths], np.int64)
        self.reach = int(max(self.spans, default=0))

    def seeds(self, documents: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(keys, items): each item's seeds, given the number of documents that hold each key.

        By places in the item: of P places of which any passage shares at least h, the P - h + 1 whose n-grams are rarest.
        """
        keys, items = [], []
        for i, of_item in enumerate(self.of_item):
            often = documents[np.searchsorted(self.keys, of_item)]
            rarest = np.lexsort((of_item, often))[: len(of_item) - self.needed[i] + 1]
            found = np.unique(of_item[rarest])
            keys.append(found)
            items.append(np.full(len(found), i))
        none = np.zeros(0, np.int64)
        return (np.concatenate(keys), np.concatenate(items)) if keys else (none.astype(np.uint64), none)

    def mix(self, ids: np.ndarray) -> np.ndarray:
        """Keys of all n-grams of a sequence of word numbers."""
        count = len(ids) - self.words + 1
        if count < 1:
            return np.zeros(0, np.uint64)
        keys = np.zeros(count, np.uint64)
        for k in range(self.words):
            keys = (keys ^ ids[k : k + count]) * FACTOR
            keys ^= keys >> np.uint64(29)
        return keys

    def find(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(positions, places in `keys`) of the n-grams of a word list that items have."""
        ids = np.fromiter(map(self.numbers.get, words, repeat(0)), np.uint64, len(words))
        count = len(ids) - self.words + 1
        if count < 1 or not len(self.keys):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        all_known = np.ones(count, bool)
        for k in range(self.words):
            all_known &= ids[k : k + count] > 0
        at = np.flatnonzero(all_known)
        mixed = np.zeros(len(at), np.uint64)
        for k in range(self.words):
            mixed = (mixed ^ ids[at + k]) * FACTOR
            mixed ^= mixed >> np.uint64(29)
        places = np.minimum(np.searchsorted(self.keys, mixed), len(self.keys) - 1)
        hit = self.keys[places] == mixed
        return at[hit], places[hit]

    def anchors(self, at: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions, item numbers), by position, from which an item has as many hits within its span as it needs.

        `at` are the ascending positions of hits in a word list and `places` those of their keys.
        """
        found = []
        low = 0
        while low < len(at):
            # Hits from `low` to `high` start windows; those up to `end` complete them.
            high = max(low + 1, int(np.searchsorted(at, at[low] + STRETCH)))
            end = int(np.searchsorted(at, at[high - 1] + self.reach))
            part = places[low:end]
            many = self.begins[part + 1] - self.begins[part]
            nth = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            items = self.owners[np.repeat(self.begins[part], many) + nth]
            where = np.repeat(at[low:end], many)
            order = np.argsort(items, kind="stable")
            items, where = items[order], where[order]
            last = np.arange(len(items)) + self.needed[items] - 1
            inside = np.minimum(last, len(items) - 1)
            enough = (last < len(items)) & (items[inside] == items) & (where[inside] - where < self.spans[items])
            enough &= where <= at[high - 1]
            found.append((where[enough], items[enough]))
            low = high
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        where, items = (np.concatenate(f) for f in zip(*found))
        order = np.argsort(where, kind="stable")
        return where[order], items[order]


def align(passage: list[bytes], item: list[bytes]) -> tuple[float, int, int]:
    """Best local alignment of word lists: (score / item length, first word, end) within the passage.

    A match counts 1, a mismatch, an extra and a missing word each -1. One row per item word, vectorised over the
    passage; runs of extra words are a running maximum, since each extra word costs the same.
    """
    if not passage or not item:
        return 0.0, 0, 0
    numbers = {}
    p = np.array([numbers.setdefault(w, len(numbers)) for w in passage], np.int64)
    q = [numbers.get(w, -1) for w in item]
    along = np.arange(len(p) + 1)
    row, origin = np.zeros(len(p) + 1, np.int64), along.copy()
    best, where = 0, (0, 0)
    for word in q:
        diagonal = row[:-1] + np.where(p == word, 1, -1)
        fresh = np.maximum(row - 1, 0)
        begin = np.where(row - 1 > 0, origin, along)
        take = diagonal > fresh[1:]
        fresh[1:] = np.where(take, diagonal, fresh[1:])
        begin[1:] = np.where(take, origin[:-1], begin[1:])
        # H[j] = max over k <= j of fresh[k] - (j - k); the origin follows the k that wins.
        lifted = fresh + along
        top = np.maximum.accumulate(lifted)
        winner = np.maximum.accumulate(np.where(lifted == top, along, 0))
        row, origin = top - along, begin[winner]
        origin = np.where(row > 0, origin, along)
        row = np.maximum(row, 0)
        end = int(np.argmax(row))
        if row[end] > best:
            best, where = int(row[end]), (int(origin[end]), end)
    return best / len(item), *where


def _item_blocks(benchmark: DataFrame, settings: Settings) -> Iterator[DataFrame]:
    """(item_id, text) in blocks of about `block_bytes`, dealt by hash; a block may be sent to every task."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where(
        "item_id IS NOT NULL AND text IS NOT NULL"
    ).distinct()
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-size // settings.block_bytes))
    for i in range(blocks):
        yield items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == i)


def contaminated(documents: DataFrame, benchmark: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(doc_id, text_key, item_id, score, first_word, end_word): the best passage of each document and test item.

    score is the alignment score divided by the item's length; pairs from `score` upwards are returned. Items of fewer
    words than an n-gram, and NULL items or ids of items, match nothing; NULL and empty documents contain nothing, and
    no documents or items give no rows. Documents are told apart by id and text, so repeated rows share one result. Of
    equally good passages the first counts. Columns other than doc_id and text (item_id and text) are not read.
    """
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("text_key"), F.col("text").cast("string").alias("text"))
    result = None
    for block in _item_blocks(benchmark, settings):
        part = _block(rows, block, settings)
        result = part if result is None else result.unionByName(part)
    return result


def _block(rows: DataFrame, block: DataFrame, settings: Settings) -> DataFrame:
    spark = rows.sparkSession
    # Bounded by block_bytes, as are their n-grams.
    items = sorted((r.item_id, r.text) for r in block.collect())
    grams = Grams([text for _, text in items], settings.words, settings)
    found = written(_passages(rows, grams), "passages")
    often = np.zeros(len(grams.keys), np.int64)
    counts = found.where("place IS NOT NULL").groupBy("place").agg(F.sum("n").alias("n")).toArrow()
    often[counts.column("place").to_numpy()] = counts.column("n").to_numpy()
    keys, owners = grams.seeds(often)
    places = np.searchsorted(grams.keys, keys)
    postings = spark.createDataFrame(pa.table({"seed": pa.array(places, pa.int64()), "item": pa.array(owners, pa.int64())}))
    passages = found.where("passage IS NOT NULL").withColumn("pid", F.monotonically_increasing_id())
    passages = written(passages.select("pid", "doc_id", "text_key", "first", "passage", "grams"), "numbered")
    # The join moves numbers; each passage is sent once, with the items that one of its seeds belongs to.
    met = passages.select("pid", F.explode("grams").alias("seed")).join(postings, "seed")
    candidates = met.groupBy("pid").agg(F.collect_set("item").alias("items"))
    aligned = _align(passages.drop("grams").join(candidates, "pid"), items, grams, settings)
    order = F.struct((-F.col("score")).alias("s"), F.col("first_word").alias("f"), F.col("end_word").alias("e"))
    best = aligned.where(F.col("score") >= settings.score).groupBy("doc_id", "text_key", "item_id").agg(F.min(order).alias("best"))
    return best.select(
        "doc_id", "text_key", "item_id", (-F.col("best.s")).alias("score"),
        F.col("best.f").alias("first_word"), F.col("best.e").alias("end_word"),
    )


def _stretches(at: np.ndarray, spans: np.ndarray, words: int) -> Iterator[tuple[int, int]]:
    """Ranges of words around anchors of items with these spans, each holding any copy that one of its anchors is of.

    Anchors of items of about the same length share a range if they are up to a span apart, and it extends as far to
    both sides, so a short item's passage does not grow with the longest item's. Long ranges are cut into overlapping
    parts that hold a whole copy each.
    """
    classes = np.frexp(spans)[1]
    for size in np.unique(classes):
        mine, reach = at[classes == size], int(spans[classes == size].max())
        step = max(1, 8 * reach)
        for group in np.split(mine, np.flatnonzero(np.diff(mine) > reach) + 1):
            low, high = int(group[0]) - reach, int(group[-1]) + reach + words
            while True:
                yield low, min(high, low + step + 3 * reach)
                if low + step + 3 * reach >= high:
                    break
                low += step


def _passages(rows: DataFrame, grams: Grams) -> DataFrame:
    """Rows of two kinds: passages where an item may have a copy, with the places of the n-grams in them, and for places
    the number of a task's documents that hold the n-gram.
    """
    reach = grams.reach
    schema = pa.schema([
        ("doc_id", pa.int64()), ("text_key", pa.int64()), ("first", pa.int64()), ("passage", pa.string()), ("grams", pa.list_(pa.int64())),
        ("place", pa.int64()), ("n", pa.int64()),
    ])

    def work(batches):
        documents = np.zeros(len(grams.keys), np.int64)
        for batch in batches:
            out = {name: [] for name in schema.names[:5]}
            for doc, key, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                offset, carry, met = 0, [], []
                for words in _pieces(text):
                    # The carry overlaps pieces of very long texts by more than a passage's reach on both sides.
                    sequence = carry + words
                    hits, places = grams.find(sequence)
                    met.append(np.unique(places))
                    at, found = grams.anchors(hits, places)
                    for low, high in _stretches(at, grams.spans[found], grams.words) if len(at) else ():
                        low = max(0, low)
                        inside = places[np.searchsorted(hits, low) : np.searchsorted(hits, high)]
                        out["doc_id"].append(doc)
                        out["text_key"].append(key)
                        out["first"].append(offset + low)
                        out["passage"].append(b" ".join(sequence[low:high]).decode("utf-8", "surrogatepass"))
                        out["grams"].append(np.unique(inside))
                    carry = sequence[-4 * reach :] if reach else []
                    offset += len(sequence) - len(carry)
                if met:
                    documents[met[0] if len(met) == 1 else np.unique(np.concatenate(met))] += 1
            size = len(out["first"])
            if size:
                yield record(schema, **out, place=pa.nulls(size, pa.int64()), n=pa.nulls(size, pa.int64()))
        held = np.flatnonzero(documents)
        nothing = {f.name: pa.nulls(len(held), f.type) for f in schema}
        yield record(schema, **nothing | {"place": pa.array(held), "n": pa.array(documents[held])})

    return map_batches(rows, work, "doc_id long, text_key long, first long, passage string, grams array<long>, place long, n long")


def _align(passages: DataFrame, items: list[tuple[int, str]], grams: Grams, settings: Settings) -> DataFrame:
    """Alignments of passages with their candidate items, leaving out those that share too few n-grams for the score."""
    schema = pa.schema([
        ("doc_id", pa.int64()), ("text_key", pa.int64()), ("item_id", pa.int64()),
        ("score", pa.float64()), ("first_word", pa.int64()), ("end_word", pa.int64()),
    ])

    def work(batches):
        words = [words_of(text) for _, text in items]
        own = [np.unique(np.searchsorted(grams.keys, keys)) for keys in grams.of_item]
        for batch in batches:
            out = {name: [] for name in schema.names}
            for doc, key, first, passage, candidates in zip(*(batch.column(i).to_pylist() for i in range(5))):
                sequence = passage.encode("utf-8", "surrogatepass").split()
                _, places = grams.find(sequence)
                for i in candidates:
                    if np.isin(places, own[i]).sum() < grams.needed[i]:
                        continue
                    score, begin, end = align(sequence, words[i])
                    if score >= settings.score:
                        for name, value in zip(schema.names, (doc, key, items[i][0], score, first + begin, first + end)):
                            out[name].append(value)
            yield record(schema, **out)

    rows = passages.select("doc_id", "text_key", "first", "passage", "items")
    return map_batches(rows, work, "doc_id long, text_key long, item_id long, score double, first_word long, end_word long")


def remove(documents: DataFrame, benchmark: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The rows of `documents` that hold no copy of a test item, all columns unchanged, whatever their names.

    Rows that repeat an id and text go or stay together; NULL and empty texts stay, and so do all rows without items.
    """
    key = free_name(documents)
    found = contaminated(documents, benchmark, settings).select(row_key(F.col("doc_id"), F.col("text_key")).alias(key)).distinct()
    keyed = documents.withColumn(key, row_key(F.col("doc_id"), text_key()))
    return keyed.join(written(found, "contaminated"), key, "left_anti").drop(key)
