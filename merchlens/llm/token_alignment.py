"""Alignment of two tokenizers' tokens by the places where both end.

Token ends are byte offsets, two ascending lists a text. The ends of the shorter list are looked up in the longer one
by galloping: steps that double from a guessed place until they pass the end, then a binary search of the last step.
Ends in both lists cut the tokens into groups, and the ranks of the shorter list's ends in the longer one are the
ranges of tokens that overlap. All ends of a batch of texts are searched at once.

Texts are tokenized and aligned once. What the counts over the corpus add, each text's different pairs of tokens, is
written with the rest and looked up when all texts have been counted: the most frequent pairs in a list of bounded
length that every task holds, the others by a join.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchlens.llm.shared import map_batches, record, written

SPACE = "▁"
PAIRS_AT_ONCE = 1 << 21
# How byte-level vocabularies of this family cut a text before merging, a fixed value.
CUTS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@dataclass(frozen=True)
class Settings:
    """Tokenizer files, the bytes of text handled at once, and how many pairs every task may hold."""

    bytes_file: str = "/opt/tokenizers/byte_bpe_50k.json"
    pieces_file: str = "/opt/tokenizers/piece_bpe_32k.model"
    at_once: int = 1 << 18
    head: int = 1 << 18


# ------------------------------------------------------------------ tokens


def _byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in byte-level vocabularies: printable bytes for themselves, the others from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def _in_merge_order(file: dict) -> bool:
    """Whether a tokenizer file is plain byte-level merging, by the usual cuts, with numbers in the order of the merges.

    Then its numbers are the ranks of the merges, and any program that merges by rank gives the same tokens.
    """
    model, before = file["model"], file.get("pre_tokenizer") or {}
    options = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "fuse_unk", "byte_fallback", "ignore_merges")
    if model.get("type", "BPE") != "BPE" or file.get("normalizer") or any(model.get(o) for o in options):
        return False
    if before.get("type") != "ByteLevel" or before.get("add_prefix_space") or not before.get("use_regex", True):
        return False
    pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
    return all(model["vocab"].get(a + b) == 256 + i for i, (a, b) in enumerate(pairs))


class Tokenizers:
    """Both tokenizers and the bytes of each of their tokens; special tokens are plain text."""

    def __init__(self, settings: Settings):
        from sentencepiece import SentencePieceProcessor

        self.b = SentencePieceProcessor(model_file=settings.pieces_file)
        self.bytes_b = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode()
            for i, p in ((i, self.b.id_to_piece(i)) for i in range(self.b.get_piece_size()))
        ]
        with open(settings.bytes_file, encoding="utf-8") as source:
            file = json.load(source)
        vocabulary = file["model"]["vocab"] | {t["content"]: t["id"] for t in file.get("added_tokens", ())}
        letters = _byte_letters()
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for entry, number in vocabulary.items():
            known = all(c in letters for c in entry)
            self.bytes_a[number] = bytes(letters[c] for c in entry) if known else entry.encode()
        self.by_rank = _in_merge_order(file)
        if self.by_rank:
            import tiktoken

            special = {t["id"] for t in file.get("added_tokens", ())}
            ranks = {self.bytes_a[n]: n for n in file["model"]["vocab"].values() if n not in special}
            self.a = tiktoken.Encoding("a", pat_str=CUTS, mergeable_ranks=ranks, special_tokens={})
        else:
            os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
            from tokenizers import Tokenizer

            self.a = Tokenizer.from_file(settings.bytes_file)
            self.a.encode_special_tokens = True
        self.lengths = tuple(np.array([len(t) for t in tokens], np.int64) for tokens in (self.bytes_a, self.bytes_b))

    def _first(self, texts: list[str]) -> list[np.ndarray]:
        if self.by_rank:
            return [self.a.encode_to_numpy(t, disallowed_special=()) for t in texts]
        return [np.array(e.ids, np.uint32) for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[str | None]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Numbers of both tokenizers; none for a NULL or empty text, nor where tokens do not spell a space and the text."""
        none = np.zeros(0, np.uint32)
        found = [none] * len(texts), [none] * len(texts)
        full = [i for i, t in enumerate(texts) if t]
        spaced = [" " + texts[i] for i in full]
        second = self.b.encode([texts[i] for i in full], num_threads=1) if full else []
        for i, text, one, two in zip(full, spaced, self._first(spaced), second):
            data = text.encode()
            # Merging by rank starts from the bytes and cannot change them.
            if b"".join(map(self.bytes_b.__getitem__, two)) == data and (self.by_rank or b"".join(map(self.bytes_a.__getitem__, one.tolist())) == data):
                found[0][i], found[1][i] = one, np.array(two, np.uint32)
        return found


def _bounded(batch: pa.RecordBatch, column: int, size: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of about `size` bytes in a column, of one row at least."""
    values = batch.column(column)
    lengths = [len(v.as_buffer()) if v.is_valid else 0 for v in values]
    begin, held = 0, 0
    for i, length in enumerate(lengths):
        if held and held + length > size:
            yield batch.slice(begin, i - begin)
            begin, held = i, 0
        held += length
    if begin < batch.num_rows:
        yield batch.slice(begin)


# ------------------------------------------------------------------ alignment


def gallop(shorter: np.ndarray, longer: np.ndarray, guess: np.ndarray) -> np.ndarray:
    """For each value the first place of the ascending `longer` list that is not below it.

    From the guessed place the step doubles, to either side, until the value is between two places; the rest is a
    binary search. Places that are found leave the search.
    """
    last = len(longer) - 1
    low, high = np.full(len(shorter), -1), np.full(len(shorter), len(longer))
    at, step = np.clip(guess, 0, max(last, 0)), np.ones(len(shorter), np.int64)
    open_ = np.arange(len(shorter)) if len(longer) else np.zeros(0, np.int64)
    # longer[low] < value <= longer[high], the ends of the list standing for no bound.
    while len(open_):
        place = at[open_]
        below = longer[place] < shorter[open_]
        low[open_[below]], high[open_[~below]] = place[below], place[~below]
        bracket = (low[open_] >= 0) & (high[open_] < len(longer)) | (below & (place == last)) | (~below & (place == 0))
        open_, below, place = open_[~bracket], below[~bracket], place[~bracket]
        at[open_] = np.clip(np.where(below, place + step[open_], place - step[open_]), 0, max(last, 0))
        step[open_] *= 2
    open_ = np.flatnonzero(high - low > 1)
    while len(open_):
        middle = (low[open_] + high[open_]) >> 1
        below = longer[middle] < shorter[open_]
        low[open_[below]], high[open_[~below]] = middle[below], middle[~below]
        open_ = open_[high[open_] - low[open_] > 1]
    return high


@dataclass
class Aligned:
    """The alignment of a batch of texts: token numbers and their texts, whether a group ends with a token, and links."""

    a: np.ndarray
    b: np.ndarray
    text_a: np.ndarray
    text_b: np.ndarray
    closes_a: np.ndarray
    closes_b: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray


def align(a: list[np.ndarray], b: list[np.ndarray], lengths_a: np.ndarray, lengths_b: np.ndarray) -> Aligned:
    """Groups and links of texts whose two token lists spell the same bytes; links are places in the joined lists."""
    flat_a, text_a, ends_a, begin_a, count_a = _joined(a, lengths_a)
    flat_b, text_b, ends_b, begin_b, count_b = _joined(b, lengths_b)
    first_is_shorter = count_a <= count_b
    # One list of the shorter sides and one of the longer, text by text; ends go on from text to text.
    short, short_at = _chosen(ends_a, ends_b, text_a, text_b, first_is_shorter)
    long, long_at = _chosen(ends_b, ends_a, text_b, text_a, first_is_shorter)
    few, many = np.minimum(count_a, count_b), np.maximum(count_a, count_b)
    texts = np.repeat(np.arange(len(few)), few)
    begin_many = np.cumsum(many) - many
    # A text's tokens are about equally long, so an end lies as far along the list as along the bytes.
    last = np.cumsum(few) - 1
    bytes_before = np.concatenate([[0], np.where(few > 0, short[last] if len(short) else 0, 0)])
    bytes_before = np.maximum.accumulate(bytes_before)
    size = np.maximum(np.diff(bytes_before), 1)
    rank = gallop(short, long, begin_many[texts] + (short - bytes_before[texts]) * many[texts] // size[texts] - 1)
    common = long[rank] == short if len(short) else np.zeros(0, bool)
    # A token of the shorter list meets the other's tokens from the one behind its start to the one holding its end.
    start = np.concatenate([[0], rank[:-1] + common[:-1]])[: len(rank)]
    times = rank - start + 1
    link_short = np.repeat(np.arange(len(short)), times)
    link_long = np.arange(len(link_short)) - np.repeat(np.cumsum(times) - times, times) + np.repeat(start, times)
    swapped = ~first_is_shorter[texts[link_short]] if len(link_short) else np.zeros(0, bool)
    one, two = short_at[link_short], long_at[link_long]
    closes = [np.zeros(len(flat_a), bool), np.zeros(len(flat_b), bool)]
    owner = first_is_shorter[texts[common]]
    one_end, two_end = short_at[common], long_at[rank[common]]
    closes[0][np.where(owner, one_end, two_end)] = True
    closes[1][np.where(owner, two_end, one_end)] = True
    return Aligned(flat_a, flat_b, text_a, text_b, *closes, np.where(swapped, two, one), np.where(swapped, one, two))


def _joined(lists: list[np.ndarray], lengths: np.ndarray):
    counts = np.array([len(x) for x in lists], np.int64)
    flat = np.concatenate(lists).astype(np.int64) if lists else np.zeros(0, np.int64)
    return flat, np.repeat(np.arange(len(lists)), counts), np.cumsum(lengths[flat]), np.cumsum(counts) - counts, counts


def _chosen(ends_one, ends_two, text_one, text_two, use_one):
    """(ends, places in their own list) of list one where `use_one` holds for the text, else of list two."""
    mine, other = np.flatnonzero(use_one[text_one]), np.flatnonzero(~use_one[text_two])
    places = np.concatenate([mine, other])
    order = np.argsort(np.concatenate([text_one[mine], text_two[other]]), kind="stable")
    return np.concatenate([ends_one[mine], ends_two[other]])[order], places[order]


class Spelled:
    """Writes groups as text, `a1,a2|b1;a3|b2,b3`."""

    def __init__(self, size_a: int, size_b: int):
        self.base = 2 * size_a
        words = [b"%d%s" % (i // 2, (b",", b"|")[i % 2]) for i in range(2 * size_a)]
        words += [b"%d%s" % (i // 2, (b",", b";")[i % 2]) for i in range(2 * size_b)]
        # One row of bytes a word, filled up with zeros, which no word holds.
        self.words = np.array(words)
        self.lengths = np.char.str_len(self.words).astype(np.int64)

    def digests(self, found: Aligned, texts: int) -> list[str]:
        """sha256 of each text's groups; empty without tokens."""
        ca, cb = found.closes_a, found.closes_b
        # A token comes behind all of the other list's tokens of earlier groups; B's also behind A's of their own group.
        group_a, group_b = np.cumsum(ca) - ca, np.cumsum(cb) - cb
        ends_a, ends_b = np.flatnonzero(ca) + 1, np.flatnonzero(cb) + 1
        words = np.empty(len(ca) + len(cb), np.int64)
        words[np.arange(len(ca)) + np.concatenate([[0], ends_b])[group_a]] = 2 * found.a + ca
        words[np.arange(len(cb)) + (ends_a[group_b] if len(cb) else 0)] = self.base + 2 * found.b + cb
        cuts = np.concatenate([[0], np.cumsum(np.bincount(found.text_a, minlength=texts) + np.bincount(found.text_b, minlength=texts))])
        places = np.concatenate([[0], np.cumsum(self.lengths[words])])[cuts]
        spelled = self.words[words].view(np.uint8)
        spelled = spelled[spelled != 0].tobytes()
        return [hashlib.sha256(spelled[x : y - 1]).hexdigest() if y > x else "" for x, y in zip(places.tolist(), places[1:].tolist())]


# ------------------------------------------------------------------ the corpus


def groups(documents: DataFrame, settings: Settings = Settings(), id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, a, b, groups): both lists of token numbers, and per group how many of each it takes.

    One row for every row of `documents`; without tokens (see `align_tokenizers`) the lists are empty.
    """
    schema = pa.schema([
        ("doc_id", pa.int64()), ("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32())),
        ("groups", pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))),
    ])

    def work(batches):
        both = Tokenizers(settings)
        for batch in batches:
            for part in _bounded(batch, 1, settings.at_once):
                a, b = both.encode(part.column(1).to_pylist())
                found = align(a, b, *both.lengths)
                out = []
                for i in range(part.num_rows):
                    ends = [np.flatnonzero(c[t == i]) for c, t in ((found.closes_a, found.text_a), (found.closes_b, found.text_b))]
                    sizes = [np.diff(e, prepend=-1).tolist() for e in ends]
                    out.append([{"a": x, "b": y} for x, y in zip(*sizes)])
                yield record(schema, doc_id=part.column(0), a=[x.tolist() for x in a], b=[x.tolist() for x in b], groups=out)

    rows = documents.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return map_batches(rows, work, "doc_id long, a array<int>, b array<int>, groups array<struct<a:int,b:int>>")


class Counts:
    """Adds up how often pairs are linked, in bounded memory."""

    def __init__(self):
        self.keys, self.times, self.held = [], [], 0

    def add(self, keys: np.ndarray, times: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Add counts; gives back what has been added up when it becomes too much to hold."""
        self.keys.append(keys)
        self.times.append(times)
        self.held += len(keys)
        if self.held > PAIRS_AT_ONCE:
            keys, times = self.take()
            if len(keys) > PAIRS_AT_ONCE // 2:
                yield keys, times
            else:
                self.keys, self.times, self.held = [keys], [times], len(keys)

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        """Different pairs in order and their counts; nothing is held afterwards."""
        keys = np.concatenate(self.keys) if self.keys else np.zeros(0, np.int64)
        times = np.concatenate(self.times) if self.times else np.zeros(0, np.int64)
        self.keys, self.times, self.held = [], [], 0
        order = np.argsort(keys)
        keys, times = keys[order], times[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
        return keys[first], np.add.reduceat(times, first) if len(first) else times


RESULT = ("row", "doc_id", "n_a", "n_b", "n_groups", "n_links")
NUMBERS = ", ".join(f"{name} long" for name in RESULT)


def _aligned(documents: DataFrame, settings: Settings, id_column: str, text: str) -> DataFrame:
    """Rows of two kinds: a text's numbers, digest and different pairs with their times, or a pair and its count in a task.

    Pairs are 64-bit little-endian words in a binary column, times 32-bit ones.
    """
    schema = pa.schema([
        *((name, pa.int64()) for name in RESULT), ("groups_sha256", pa.string()), ("pairs", pa.binary()), ("times", pa.binary()),
        ("pair", pa.int64()), ("n", pa.int64()),
    ])

    def counted(keys: np.ndarray, times: np.ndarray) -> pa.RecordBatch:
        empty = {f.name: pa.nulls(len(keys), f.type) for f in schema}
        return record(schema, **empty | {"pair": pa.array(keys), "n": pa.array(times)})

    def work(batches):
        both = Tokenizers(settings)
        spelled, wide, counts = Spelled(len(both.bytes_a), len(both.bytes_b)), len(both.bytes_b), Counts()
        for batch in batches:
            for part in _bounded(batch, 2, settings.at_once):
                rows = part.num_rows
                f = align(*both.encode(part.column(2).to_pylist()), *both.lengths)
                texts = f.text_a[f.link_a]
                # Texts come first in the order, so the pairs of a text lie together.
                keys, times = np.unique(texts << 40 | (f.a[f.link_a] * wide + f.b[f.link_b]), return_counts=True)
                cuts = np.searchsorted(keys >> 40, np.arange(1, rows))
                keys &= (1 << 40) - 1
                for summed in counts.add(keys, times):
                    yield counted(*summed)
                yield record(
                    schema, row=part.column(0), doc_id=part.column(1), n_a=np.bincount(f.text_a, minlength=rows),
                    n_b=np.bincount(f.text_b, minlength=rows), n_groups=np.bincount(f.text_a[f.closes_a], minlength=rows),
                    n_links=np.bincount(texts, minlength=rows), groups_sha256=spelled.digests(f, rows),
                    pairs=[k.astype("<u8").tobytes() for k in np.split(keys, cuts)],
                    times=[t.astype("<u4").tobytes() for t in np.split(times, cuts)],
                    pair=pa.nulls(rows, pa.int64()), n=pa.nulls(rows, pa.int64()),
                )
        yield counted(*counts.take())

    rows = documents.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_column).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")
    )
    return map_batches(rows, work, f"{NUMBERS}, groups_sha256 string, pairs binary, times binary, pair long, n long")


def _head(counts: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(pairs in order, counts, whether best) above a frequency found from a short histogram, at most `most` of them."""
    step = F.floor(F.log2("n") * 8)
    histogram = {r.step: r.pairs for r in counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("pairs")).collect()}
    lowest, held = None, 0
    for at in sorted(histogram, reverse=True):
        held += histogram[at]
        if held > most:
            break
        lowest = at
    if lowest is None:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
    table = counts.where(step >= lowest).select("pair", "n", "best").toArrow().sort_by("pair")
    return tuple(table.column(i).to_numpy() for i in range(3))


def align_tokenizers(documents: DataFrame, settings: Settings = Settings(), id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 for every row of `documents`.

    Groups are cut where tokens of both tokenizers end; links are the pairs of tokens that share a byte. A pair of
    numbers counts once for each of its links in the whole corpus: n_best are the links whose pair is the most frequent
    of its second number, ties included, and count_sum adds up the counts over the links. NULL and empty texts and texts
    that one of the tokenizers changes have no tokens: zeros and an empty digest. Repeated rows each count and have
    their own rows; columns other than id and text are not read; no rows give no rows. A text is tokenized as one value,
    so a task needs memory for its longest text.
    """
    once = written(_aligned(documents, settings, id_column, text), "aligned")
    found = written(once.where("pair IS NOT NULL").groupBy("pair").agg(F.sum("n").alias("n")), "pairs")
    wide = len(Tokenizers(settings).bytes_b)
    # One row for each number of the second vocabulary.
    highest = found.groupBy(F.pmod("pair", F.lit(wide)).alias("second")).agg(F.max("n").alias("most"))
    counts = written(
        found.join(F.broadcast(highest), F.pmod("pair", F.lit(wide)) == F.col("second")).select("pair", "n", (F.col("n") == F.col("most")).alias("best")),
        "counts",
    )
    head, head_n, head_best = _head(counts, settings.head)
    schema = pa.schema([
        *((name, pa.int64()) for name in RESULT), ("groups_sha256", pa.string()), ("n_best", pa.int64()), ("count_sum", pa.int64()),
        ("rest", pa.list_(pa.int64())), ("rest_times", pa.list_(pa.int64())),
    ])

    def work(batches):
        for batch in batches:
            rows, names = batch.num_rows, batch.schema.names
            pairs, times = ([np.frombuffer(v, d) for v in batch.column(names.index(c)).to_pylist()] for c, d in (("pairs", "<u8"), ("times", "<u4")))
            owner = np.repeat(np.arange(rows), [len(x) for x in pairs])
            keys, often = np.concatenate(pairs).astype(np.int64), np.concatenate(times).astype(np.int64)
            at = np.minimum(np.searchsorted(head, keys), max(len(head) - 1, 0))
            known = head[at] == keys if len(head) else np.zeros(len(keys), bool)
            sums, best = np.zeros(rows, np.int64), np.zeros(rows, np.int64)
            np.add.at(sums, owner[known], head_n[at[known]] * often[known])
            np.add.at(best, owner[known], head_best[at[known]] * often[known])
            cuts = np.searchsorted(owner[~known], np.arange(1, rows))
            yield record(
                schema, **{c: batch.column(names.index(c)) for c in (*RESULT, "groups_sha256")}, n_best=best, count_sum=sums,
                rest=np.split(keys[~known], cuts), rest_times=np.split(often[~known], cuts),
            )

    texts = once.where("row IS NOT NULL").drop("pair", "n")
    looked_up = written(
        map_batches(texts, work, f"{NUMBERS}, groups_sha256 string, n_best long, count_sum long, rest array<long>, rest_times array<long>"), "looked-up"
    )
    rest = looked_up.select("row", F.inline(F.arrays_zip(F.col("rest").alias("pair"), F.col("rest_times").alias("times"))))
    added = rest.join(counts, "pair").groupBy("row").agg(
        F.sum(F.col("times") * F.col("n")).alias("more_sum"), F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best")
    )
    whole = looked_up.drop("rest", "rest_times").join(added, "row", "left").na.fill(0, ["more_sum", "more_best"])
    return whole.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", (F.col("n_best") + F.col("more_best")).alias("n_best"),
        (F.col("count_sum") + F.col("more_sum")).alias("count_sum"), "groups_sha256",
    )
