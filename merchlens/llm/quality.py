"""Quality classifier on supervised subword embeddings.

A text is the mean of learned vectors of its words and character n-grams, each looked up by hash; a softmax layer over
the mean gives the class. Vectors and layer are trained together by stochastic gradient descent in numpy, on groups that
all labelled rows are dealt to. As the layer is linear, a trained model scores a text from one number per hash bucket,
and the models of the groups are averaged, weighted by their rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from merchlens.llm.shared import map_batches, record, remainder, text_key

# Characters of words whose n-grams are taken at once; a longer word is taken in overlapping parts.
CHARS_AT_ONCE = 1 << 20
# Longer words are not remembered, so that few endless ones do not fill the memory.
LONGEST_CACHED = 64
CACHED_WORDS = 200_000
WORDS_AT_ONCE = 100_000
PIECE_CHARS = 1 << 20
SPACE = re.compile(r"\s")
HASH_FACTOR = np.uint64(0x9E3779B97F4A7C15)
# Bytes of features after which a group is trained, however few rows it has.
GROUP_BYTES = 1 << 28
SLICE = 1024
# Texts that a group's task may read for each that teaches; where labels are rarer, the others are dropped beforehand.
TEXTS_PER_ROW = 8


@dataclass(frozen=True)
class Settings:
    """Hash buckets, vector length, n-gram lengths, rows of a group and passes, learning rate, decision threshold.

    All labelled rows are dealt to groups of `rows` on average, each trained in one task; a row has at most one entry of
    four bytes, or six where a count needs them, per bucket, of which there are 65,536 at most, so a task's memory is
    bounded however long texts are.
    """

    buckets: int = 1 << 16
    size: int = 8
    shortest: int = 2
    longest: int = 4
    rows: int = 2000
    passes: int = 8
    rate: float = 0.5
    threshold: float = 0.3
    seed: int = 7


@dataclass(frozen=True)
class Model:
    """What scoring needs: the logit difference of each bucket's vector, and that of an empty text."""

    buckets: np.ndarray
    bias: float
    settings: Settings


def _word_lists(text: str | None) -> Iterator[list[str]]:
    """All words of a text, case kept, in bounded lists; a single word stays whole."""
    text, start = text or "", 0
    while start < len(text):
        end = len(text)
        if end - start > PIECE_CHARS:
            gap = SPACE.search(text, start + PIECE_CHARS)
            end = gap.start() if gap else end
        yield text[start:end].split()
        start = end


def subwords(words: list[str], settings: Settings) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(buckets, owners) in bounded parts: the bucket of every word and of its character n-grams with marked ends, and
    the word's index.
    """
    begin = held = 0
    for i, word in enumerate(words):
        if held and held + len(word) > CHARS_AT_ONCE:
            yield _grams(words[begin:i], begin, settings)
            begin, held = i, 0
        if len(word) > CHARS_AT_ONCE:
            yield from _grams_of_long(word, i, settings)
            begin, held = i + 1, 0
        else:
            held += len(word)
    if begin < len(words):
        yield _grams(words[begin:], begin, settings)


def _word_bucket(marked: str, settings: Settings) -> int:
    return zlib.crc32(marked.encode("utf-8", "surrogatepass")) % settings.buckets


def _rolled(points: np.ndarray, settings: Settings) -> Iterator[tuple[int, np.ndarray]]:
    """(length, buckets of all n-grams of that length) of a sequence of code points."""
    rolled = points * HASH_FACTOR
    for n in range(2, settings.longest + 1):
        rolled = (rolled[:-1] ^ points[n - 1 :]) * HASH_FACTOR
        if n >= settings.shortest:
            yield n, ((rolled >> np.uint64(29)) % np.uint64(settings.buckets)).astype(np.int64)


def _points(marked: str) -> np.ndarray:
    return np.frombuffer(marked.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


def _grams(words: list[str], first: int, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    marked = [f"<{w}>" for w in words]
    points = _points("".join(marked))
    lengths = np.fromiter(map(len, marked), np.int64, len(marked))
    left = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(points))
    owner = np.repeat(np.arange(len(words)), lengths)
    buckets = [np.array([_word_bucket(m, settings) for m in marked], np.int64)]
    owners = [np.arange(len(words))]
    for n, found in _rolled(points, settings):
        inside = left[: len(found)] >= n
        buckets.append(found[inside])
        owners.append(owner[: len(found)][inside])
    return np.concatenate(buckets), np.concatenate(owners) + first


def _grams_of_long(word: str, owner: int, settings: Settings) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The same for one word, whose parts overlap so that every n-gram is met once, in the part it starts in."""
    marked = f"<{word}>"
    yield np.array([_word_bucket(marked, settings)], np.int64), np.array([owner])
    for begin in range(0, len(marked), CHARS_AT_ONCE):
        points = _points(marked[begin : begin + CHARS_AT_ONCE + settings.longest - 1])
        found = [b[:CHARS_AT_ONCE] for _, b in _rolled(points, settings)]
        if found:
            buckets = np.concatenate(found)
            yield buckets, np.full(len(buckets), owner)


def features(text: str | None, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text and how often each occurs, in words of two bytes where these hold every count."""
    counts = np.zeros(settings.buckets)
    for words in _word_lists(text):
        if words:
            distinct = Counter(words)
            often = np.fromiter(distinct.values(), np.float64, len(distinct))
            for buckets, owners in subwords(list(distinct), settings):
                counts += np.bincount(buckets, often[owners], settings.buckets)
    found = np.flatnonzero(counts)
    return found.astype(np.uint16), counts[found].astype(np.uint16 if counts.max(initial=0) <= 0xFFFF else np.uint32)


def train(rows: list[tuple[np.ndarray, np.ndarray, int]], settings: Settings) -> Model:
    """Gradient descent, one text at a time, with a rate falling to zero. Without rows every score is one half."""
    rng = np.random.default_rng(settings.seed)
    vectors = (rng.random((settings.buckets, settings.size), np.float32) - 0.5) / settings.size
    layer, bias = np.zeros((settings.size, 2), np.float32), np.zeros(2, np.float32)
    step, steps = 0, settings.passes * max(1, len(rows))
    for _ in range(settings.passes):
        for i in rng.permutation(len(rows)):
            ids, counts, label = rows[i]
            counts = counts.astype(np.float32)
            rate = settings.rate * (1 - step / steps)
            step += 1
            shares = counts / max(1.0, counts.sum())
            mean = shares @ vectors[ids] if len(ids) else np.zeros(settings.size, np.float32)
            logits = mean @ layer + bias
            wrong = np.exp(logits - logits.max())
            wrong /= wrong.sum()
            wrong[label] -= 1
            pull = layer @ wrong
            layer -= rate * np.outer(mean, wrong)
            bias -= rate * 0.1 * wrong
            if len(ids):
                # Shares of a bucket in a long text are small; scaling by the share alone would hardly move it.
                vectors[ids] -= (rate * np.sqrt(shares / shares.max()) * 0.2)[:, None] * pull
    towards = layer[:, 1] - layer[:, 0]
    return Model((vectors @ towards).astype(np.float32), float(bias[1] - bias[0]), settings)


class _Slots(dict):
    """Numbers words in the order they are first asked for."""

    def __missing__(self, word: str) -> int:
        slot = self[word] = len(self)
        return slot


class Scorer:
    """Scores lists of texts; remembers a bounded number of words with the sum and number of their buckets."""

    def __init__(self, model: Model):
        self.model = model
        self._forget()

    def _forget(self) -> None:
        self.slots, self.sums, self.grams = _Slots(), np.zeros(0), np.zeros(0)

    def _measured(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The sum of the buckets of each word and their number."""
        sums, grams = np.zeros(len(words)), np.zeros(len(words))
        for buckets, owners in subwords(words, self.model.settings):
            sums += np.bincount(owners, self.model.buckets[buckets], len(words))
            grams += np.bincount(owners, minlength=len(words))
        return sums, grams

    def _add(self, texts: list[int], words: list[list[str]], totals: np.ndarray) -> None:
        """Add the sums and numbers of buckets of word lists to the totals of their texts."""
        if len(self.slots) > CACHED_WORDS:
            self._forget()
        known = len(self.slots)
        found = np.fromiter(map(self.slots.__getitem__, chain.from_iterable(words)), np.int64)
        if len(self.slots) > known:
            fresh = list(islice(self.slots, known, None))
            sums, grams = self._measured(fresh)
            self.sums, self.grams = np.append(self.sums, sums), np.append(self.grams, grams)
        owner = np.repeat(texts, [len(w) for w in words])
        totals[0] += np.bincount(owner, self.sums[found], totals.shape[1])
        totals[1] += np.bincount(owner, self.grams[found], totals.shape[1])

    def __call__(self, texts: list[str | None]) -> np.ndarray:
        totals = np.zeros((2, len(texts)))
        owners, waiting, held = [], [], 0
        for i, text in enumerate(texts):
            for words in _word_lists(text):
                if max(map(len, words), default=0) > LONGEST_CACHED:
                    long = [w for w in words if len(w) > LONGEST_CACHED]
                    sums, grams = self._measured(long)
                    totals[:, i] += sums.sum(), grams.sum()
                    words = [w for w in words if len(w) <= LONGEST_CACHED]
                owners.append(i)
                waiting.append(words)
                held += len(words)
                if held >= WORDS_AT_ONCE:
                    self._add(owners, waiting, totals)
                    owners, waiting, held = [], [], 0
        if held:
            self._add(owners, waiting, totals)
        means = np.divide(totals[0], totals[1], out=np.zeros(len(texts)), where=totals[1] > 0)
        return 1 / (1 + np.exp(-np.clip(means + self.model.bias, -50, 50)))


def fit(documents: DataFrame, labels: DataFrame, settings: Settings = Settings(), learn: Column | None = None) -> Model:
    """A model from documents (doc_id, text) and labels (doc_id, quality 0/1).

    `learn` is a condition on doc_id for the rows that may be used. All of them teach: their rows are dealt by a hash
    of id and text to groups of `rows` on average, of which each trains a model of its own, and the average of these,
    weighted by rows, is the model. Up to `rows` rows are one group. No task or driver sees all; the driver receives one
    number per bucket. Texts are shuffled once, to their groups; where fewer than one in `TEXTS_PER_ROW` teaches, those
    that do once more. Labels that are NULL or not 0/1 and ids that are NULL teach nothing; of contradicting labels of
    one id the lower counts, and rows that repeat an id all teach.
    """
    usable = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
    texts = documents.where(F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("key"), F.col("text").cast("string").alias("text")
    )
    if learn is not None:
        usable, texts = usable.where(learn), texts.where(learn)
    known = usable.groupBy("doc_id").agg(F.min("quality").cast("int").alias("label"))
    rows = texts.select("doc_id").join(known, "doc_id").count()
    if not rows:
        return train([], settings)
    # The label of each pair of id and text hash goes to the group of its texts. A join would change the number of groups.
    named = texts.select("doc_id", "key").join(known, "doc_id").groupBy("doc_id", "key").agg(F.min("label").alias("label"))
    if texts.count() > TEXTS_PER_ROW * rows:
        texts = texts.join(named, ["doc_id", "key"], "left_semi")
    met = texts.unionByName(named, allowMissingColumns=True).repartition(-(-rows // settings.rows), "doc_id", "key")
    taught = met.withColumn("of_key", F.max("label").over(Window.partitionBy("doc_id", "key"))).where("label IS NULL AND of_key IS NOT NULL")
    dealt = taught.sortWithinPartitions(F.xxhash64("doc_id"), "doc_id", "key")
    schema = pa.schema([("rows", pa.int64()), ("slice", pa.int64()), ("numbers", pa.list_(pa.float64()))])

    def work(batches):
        group, held = [], 0

        def trained():
            model = train(group, settings)
            numbers = np.append(model.buckets.astype(np.float64), model.bias) * len(group)
            slices = [numbers[i : i + SLICE] for i in range(0, len(numbers), SLICE)]
            return record(schema, rows=[len(group)] * len(slices), slice=np.arange(len(slices)), numbers=slices)

        for batch in batches:
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids, counts = features(text, settings)
                group.append((ids, counts, label))
                held += ids.nbytes + counts.nbytes
                # Only many equal rows or very long texts get here; the rest of them is a group as well.
                if len(group) >= 2 * settings.rows or held >= GROUP_BYTES:
                    yield trained()
                    group, held = [], 0
        if group:
            yield trained()

    parts = map_batches(dealt.select("of_key", "text"), work, "rows long, slice long, numbers array<double>")
    numbers = parts.select("rows", "slice", F.posexplode("numbers").alias("i", "x")).groupBy("slice", "i")
    found = numbers.agg((F.sum("x") / F.sum("rows")).alias("x")).toPandas().sort_values(["slice", "i"]).x.to_numpy(np.float64)
    return Model(found[:-1].astype(np.float32), float(found[-1]), settings)


def score(documents: DataFrame, model: Model, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score, predicted) for every row: score in 0..1, higher for good texts, and whether it is accepted.

    Only the text enters the score. NULL counts as empty; empty texts get the score of the trained bias. Repeated rows
    get equal scores. Other columns, whatever their names, are not read.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("predicted", pa.int32())])

    def work(batches):
        scorer = Scorer(model)
        for batch in batches:
            values = scorer(batch.column(1).to_pylist())
            yield record(schema, doc_id=batch.column(0), score=values, predicted=(values >= model.settings.threshold).astype(np.int32))

    rows = documents.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return map_batches(rows, work, "doc_id long, score double, predicted int")


def keep_good(documents: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows of `documents` that the model accepts, all columns unchanged, whatever their names.

    NULL and empty texts are accepted if the trained bias is, repeated rows are judged alike, and no rows give no rows.
    """
    position = documents.columns.index(text)

    def work(batches):
        scorer = Scorer(model)
        for batch in batches:
            kept = scorer(batch.column(position).to_pylist()) >= model.settings.threshold
            yield batch.filter(pa.array(kept))

    return map_batches(documents, work, documents.schema)


def training_rows(modulus: int = 5, held_out: int = 0) -> Column:
    """Condition that excludes the held-out fold; NULL ids belong to no fold and teach nothing."""
    return remainder("doc_id", modulus) != held_out

