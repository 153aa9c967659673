"""Groups of spelling variants by a relational trie frontier.

The vocabulary is a trie kept as a distributed table of edges (parent node, character, child node), a node being a
prefix, known by its hash. States (word, position, node, edits) are joined with the edges of one level after the
other: without an edit a word stays on its own path, at one place it takes another edge or skips a character, and
from then on it must follow its remaining characters. States that end on a word after one edit are neighbours.

Two words one edit apart agree in the first half or in the last half of the walking word. So there is a trie of the
words and one of the reversed words, every word starts in both at the node of its first half, and only the second
half can hold the edit: the crowded top of the tries is never entered. Of each pair the longer word, or at equal
length the one with the smaller character, does the walking.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchlens.llm.shared import map_batches, record, written

PIECE_CHARS = 1 << 20
COUNTED_AT_ONCE = 300_000
LETTER = "A-Za-zÀ-ÿ"
PRIMES = (2147483647, 2147483629)
BASES = (1000003, 754974721)


@dataclass(frozen=True)
class Settings:
    """Least code points and occurrences of a word, and how many times as frequent a form is at least.

    `altered`: a run loses one character where this number divides its hash, None for never. Words of more than
    `trie_length` code points are matched by their deletions instead, which needs no step per character.
    """

    least_length: int = 5
    least_count: int = 3
    ratio: int = 2
    altered: int | None = 97
    trie_length: int = 64


def _pieces(text: str, size: int = PIECE_CHARS) -> Iterator[str]:
    """The text in pieces of about `size`, cut where no run is cut."""
    start, gap = 0, re.compile(f"[^{LETTER}]")
    while len(text) - start > size:
        found = gap.search(text, start + size)
        if found is None:
            break
        yield text[start : found.start()]
        start = found.start()
    yield text[start:]


def count_words(documents: DataFrame, settings: Settings = Settings(), id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(word string, n long): the words of all whole texts with A-Z lower-cased, and their occurrences.

    Runs of letters are maximal. With `altered`, the unsigned crc32 h of `<id>:<run>` takes the code point at place
    h % length from a run where the number divides h. Words below the least length or number of occurrences are left
    out. NULL and empty texts have no words; a NULL id counts as an empty one; repeated rows each count. Other columns
    are not read.
    """
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])
    least, altered = settings.least_length, settings.altered

    def work(batches):
        find = re.compile(f"[{LETTER}]{{{least},}}").findall
        counts: dict[str, int] = {}

        def flush():
            batch = record(schema, word=list(counts), n=list(counts.values()))
            counts.clear()
            return batch

        for batch in batches:
            for doc, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                begun = zlib.crc32(b"" if doc is None else b"%d" % doc)
                begun = zlib.crc32(b":", begun)
                for piece in _pieces(value or ""):
                    # bytes.lower touches A-Z only.
                    lowered = piece.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
                    for run, times in Counter(find(lowered)).items():
                        if altered:
                            h = zlib.crc32(run.encode(), begun)
                            if h % altered == 0:
                                at = h % len(run)
                                run = run[:at] + run[at + 1 :]
                                if len(run) < least:
                                    continue
                        counts[run] = counts.get(run, 0) + times
                    if len(counts) > COUNTED_AT_ONCE:
                        yield flush()
        yield flush()

    rows = documents.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    parts = map_batches(rows, work, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= settings.least_count)


# ------------------------------------------------------------------ the tries


def _prefix(length: Column | int) -> Column:
    return F.col("letters").substr(F.lit(1), F.lit(length) if isinstance(length, int) else length)


def _character(at: Column) -> Column:
    """The character at a place counted from 0."""
    return F.col("letters").substr(at + 1, F.lit(1))


def _node(prefix: Column) -> Column:
    return F.xxhash64("backward", prefix)


def _both_ways(words: DataFrame) -> DataFrame:
    """(backward, letters, n, size, start): every word and its reverse, with the places of the halves that may differ."""
    size = F.length("word")
    ways = F.array(
        F.struct(F.lit(False).alias("backward"), F.col("word").alias("letters"), F.floor(size / 2).cast("int").alias("start")),
        F.struct(F.lit(True).alias("backward"), F.reverse("word").alias("letters"), F.ceil(size / 2).cast("int").alias("start")),
    )
    return words.select("n", size.alias("size"), F.inline(ways)).select("backward", "letters", "n", "size", "start")


def _edges(ways: DataFrame) -> DataFrame:
    """(depth, parent, letter, child), once each, from the depth where walking words can meet them."""
    each = ways.select("backward", "letters", F.explode(F.sequence("start", F.col("size") - 1)).alias("depth"))
    at = F.col("depth")
    return each.select("depth", _node(_prefix(at)).alias("parent"), _character(at).alias("letter"), _node(_prefix(at + 1)).alias("child")).distinct()


def _trie_pairs(words: DataFrame) -> DataFrame:
    """(a, n_a, b, n_b): pairs of words one edit apart, some of them twice; one table of states a level."""
    spark = words.sparkSession
    ways = written(_both_ways(words), "ways")
    deepest = ways.agg(F.min("start").alias("low"), F.max("size").alias("high")).first()
    if deepest.high is None:
        return words.select(F.col("word").alias("a"), F.col("n").alias("n_a"), F.col("word").alias("b"), F.col("n").alias("n_b")).limit(0)
    edges = written(_edges(ways), "edges", "depth")
    state = ("backward", "letters", "n", "size", "at", "node")
    # Words that skip their last character have ended without another step.
    last = F.col("size") - 1
    ended = ways.select("backward", "letters", "n", "size", F.col("size").alias("at"), _node(_prefix(last)).alias("node"))
    waiting = None
    for depth in range(deepest.low, deepest.high):
        unchanged = ways.where((F.col("start") <= depth) & (F.col("size") > depth)).withColumn("node", _node(_prefix(depth)))
        # Still on its own path, or having skipped the character of this level.
        choices = F.array(
            F.struct(F.lit(0).alias("edits"), F.lit(depth).alias("at")), F.struct(F.lit(1).alias("edits"), F.lit(depth + 1).alias("at"))
        )
        states = unchanged.select("backward", "letters", "n", "size", "node", F.inline(choices)).where("at < size").select(*state, "edits")
        if waiting is not None:
            states = states.unionByName(waiting.where("at < size").select(*state, F.lit(1).alias("edits")))
        level = edges.where(F.col("depth") == depth).select("parent", "letter", "child")
        own = _character(F.col("at"))
        follows = F.when(F.col("edits") == 0, F.col("letter") > own).otherwise(F.col("letter") == own)
        moved = states.join(level, (F.col("node") == F.col("parent")) & follows)
        waiting = written(moved.select("backward", "letters", "n", "size", (F.col("at") + 1).alias("at"), F.col("child").alias("node")), "frontier")
        ended = ended.unionByName(waiting.where("at = size"))
    whole = ways.select(_node(F.col("letters")).alias("node"), F.col("letters").alias("other"), F.col("n").alias("n_b"))
    word = lambda c: F.when(F.col("backward"), F.reverse(c)).otherwise(F.col(c))
    return ended.join(whole, "node").select(word("letters").alias("a"), F.col("n").alias("n_a"), word("other").alias("b"), "n_b")


# ------------------------------------------------------------------ long words


def deletion_keys(word: str) -> tuple[int, np.ndarray]:
    """(key of the word, keys of the word without its character at each place), alike for equal strings."""
    codes = np.frombuffer(word.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64) + np.uint64(1)
    key, keys = 0, np.zeros(len(codes), np.uint64)
    for prime, base in zip(PRIMES, BASES):
        p = np.uint64(prime)
        powers = np.ones(1, np.uint64)
        while len(powers) < len(codes):
            powers = np.concatenate([powers, powers * np.uint64(pow(base, len(powers), prime)) % p])
        # Character j weighs base ** j; behind a deleted place all weights fall by one power.
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(codes % p * powers[: len(codes)] % p)])
        behind = (sums[-1] - sums[1:]) % p * np.uint64(pow(base, -1, prime)) % p
        key = key << 31 | int(sums[-1]) % prime
        keys = keys << np.uint64(31) | (sums[:-1] + behind) % p
    return key, keys


def _long_pairs(words: DataFrame, longest: int) -> DataFrame:
    """(a, n_a, b, n_b): pairs one edit apart of which at least one word has more than `longest` code points.

    Words that differ in one character agree without it; a word with one character more agrees with the other without
    that. Rows grow with the characters, and words share a key and place only if they are neighbours.
    """
    schema = pa.schema([("id", pa.int64()), ("place", pa.int32()), ("key", pa.int64())])

    def work(batches):
        for batch in batches:
            for id, word in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                key, keys = deletion_keys(word)
                if len(word) == longest:
                    keys = keys[:0]
                places = np.arange(-1, len(keys), dtype=np.int32)
                yield record(schema, id=np.full(len(places), id), place=places, key=np.append(np.uint64(key), keys).view(np.int64))

    long = words.where(F.length("word") >= longest).select(F.xxhash64("word").alias("id"), "word", "n")
    keys = written(map_batches(long.select("id", "word"), work, "id long, place int, key long"), "deletions")
    other = keys.select(F.col("id").alias("id_b"), F.col("place").alias("place_b"), "key")
    whole, same = F.col("place_b") == -1, (F.col("place") == F.col("place_b")) & (F.col("id") < F.col("id_b"))
    met = keys.where("place >= 0").join(other, "key").where(whole | same).select("id", "id_b").distinct()
    a, b = (long.select(F.col("id").alias(i), F.col("word").alias(w), F.col("n").alias(n)) for i, w, n in (("id", "a", "n_a"), ("id_b", "b", "n_b")))
    return met.join(a, "id").join(b, "id_b").select("a", "n_a", "b", "n_b")


# ------------------------------------------------------------------ forms and roots


def neighbours(words: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(a, n_a, b, n_b): every pair of different words (word, n) one inserted, deleted or replaced code point apart, once."""
    size = F.length("word")
    pairs = _trie_pairs(words.where(size <= settings.trie_length))
    if not words.where(size > settings.trie_length).isEmpty():
        pairs = pairs.unionByName(_long_pairs(words, settings.trie_length))
    # Nodes are known by hashes, so the few pairs found are checked in full.
    exact = F.levenshtein("a", "b", 1) == 1
    low = F.col("a") < F.col("b")
    order = [F.when(low, F.col(x)).otherwise(F.col(y)).alias(z) for x, y, z in (("a", "b", "a"), ("n_a", "n_b", "n_a"), ("b", "a", "b"), ("n_b", "n_a", "n_b"))]
    return pairs.where(exact).select(*order).distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) for the words that have a form: where following forms ends.

    A form is at least `ratio` times as frequent, so no path turns back. Each step doubles the length followed.
    """
    current = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = current.select(F.col("word").alias("root"), F.col("root").alias("next"))
        stepped = written(current.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        current = stepped.select("word", "root")
        if stepped.where("moved").isEmpty():
            return current


def group_variants(words: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """word, form, root, n, n_near, form_n for every row of `words` (word, n), whose words are distinct.

    A word's form is its neighbour of largest n, ties going to the smallest in code-point order, if that has at least
    `ratio` times the word's n, else NULL with form_n. root is the last word reached by following forms, the word
    itself without one. n_near counts the neighbours, 0 if none. No words give no rows.
    """
    if settings.ratio < 2:
        raise ValueError("forms must be more frequent than their variants")
    words = written(words.select("word", F.col("n").cast("long").alias("n")), "vocabulary")
    pairs = written(neighbours(words, settings), "neighbours")
    both = pairs.select(F.inline(F.array(
        F.struct(F.col("a").alias("word"), F.col("n_b").alias("m"), F.col("b").alias("other")),
        F.struct(F.col("b").alias("word"), F.col("n_a").alias("m"), F.col("a").alias("other")),
    )))
    near = both.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("m")).alias("m"), "other")).alias("best")
    )
    frequent = -F.col("best.m") >= settings.ratio * F.col("n")
    known = written(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(frequent, F.col("best.other")).alias("form"), F.when(frequent, -F.col("best.m")).alias("form_n"),
    ), "forms")
    rooted = known.join(_roots(known.where("form IS NOT NULL")), "word", "left")
    return rooted.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
