"""Scoring texts with a hashed maximum-entropy language model.

The next word is predicted in two softmax steps, first its class, then the word within the class. Classes are stretches
of words by their endings, so every word has one. The class step has hashed features of the words before: the last
word, the last two, and over a long skip the class that is most frequent among the last words. The word step has a feature for each frequent word together with that most frequent class; every other
word of a class is told apart by its smoothed frequency. So each word, also a new one, has a probability, and those of
all words add up to one.

Word counts cover all training texts and never leave Spark as a whole: a bounded list of the most frequent words goes
to the tasks, and the rest is joined. Weights are trained by gradient updates over disjoint shares of the training
texts: every task adds up what is observed and what the common weights expect, the sums of all tasks are added up in a
tree, and one step follows. What a task has read does not matter, so the model is the same for any partitioning.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchlens.llm.shared import drawn, map_batches, record, remainder, short_batches, word_pieces, written

SEED = 42
ENDINGS = 1 << 16
MARKS = b".,;:!?|*#$%&\"')"
IS_MARK = np.isin(np.arange(256), list(MARKS))
FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)
# Logits up to this size need no shift before they are exponentiated in single precision.
LARGEST = 80.0
# Of the type of the counts, since adding another type at places takes many times as long.
ONE = np.int32(1)
SLICE = 1 << 17
COUNTED_AT_ONCE = 300_000
TOKENS_AT_ONCE = 1 << 16
# Places that are not those of frequent words.
OTHER, END = -1, -2


@dataclass(frozen=True)
class Settings:
    """Sizes and training.

    `classes` of words, `head` frequent words with features of their own, `rows` of hashed features, `window` words of
    the long skip; `rounds` updates, each over its own `share` of the training texts, together all of them. A weight
    moves by `rate` times twice the gradient over observed + expected + `prior`; those of words have their own values.
    """

    classes: int = 24
    head: int = 1 << 16
    rows: int = 1 << 14
    window: int = 64
    rounds: int = 2
    share: float = 0.5
    rate: float = 0.5
    prior: float = 5.0
    word_rate: float = 1.3
    word_prior: float = 10.0
    batch: int = 1 << 13
    smoothing: float = 0.5


@dataclass
class Vocabulary:
    """Counts of the whole training corpus, and what tasks need to number words.

    `head` maps the most frequent words to their place; the other arrays go by place, ending or class. Class 0 is the
    end of a text.
    """

    tokens: int
    distinct: int
    texts: int
    head: dict[bytes, int]
    head_count: np.ndarray
    head_class: np.ndarray
    ending_class: np.ndarray
    class_tokens: np.ndarray
    class_words: np.ndarray
    settings: Settings


def endings(words: list[bytes]) -> np.ndarray:
    """A number for the last two bytes before trailing punctuation of each word; words of nothing else end as they are."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    data = np.frombuffer(b"".join(words), np.uint8)
    begin = np.cumsum(lengths) - lengths
    whole = begin + lengths - 1
    last, open_ = whole.copy(), np.arange(len(words))
    while len(open_):
        open_ = open_[IS_MARK[data[last[open_]]]]
        last[open_] -= 1
        open_ = open_[last[open_] >= begin[open_]]
    last = np.where(last < begin, whole, last)
    before = np.where(last > begin, data[np.maximum(last - 1, 0)], 0) if len(words) else last
    return data[last].astype(np.int64) * 256 + before


def count_words(documents: DataFrame) -> DataFrame:
    """(word binary, ending int, n long) over the whole texts; the text ends are one NULL word."""
    schema = pa.schema([("word", pa.binary()), ("ending", pa.int32()), ("n", pa.int64())])

    def work(batches):
        counts, texts = Counter(), 0

        def flush():
            words = list(counts)
            batch = record(schema, word=words, ending=endings(words).astype(np.int32), n=list(counts.values()))
            counts.clear()
            return batch

        for batch in batches:
            for text in batch.column(0).to_pylist():
                texts += 1
                for words in word_pieces(text):
                    counts.update(words)
                    if len(counts) > COUNTED_AT_ONCE:
                        yield flush()
        yield flush()
        yield record(schema, word=[None], ending=[0], n=[texts])

    parts = map_batches(documents.select(F.col("text").cast("string").alias("text")), work, "word binary, ending int, n long")
    return parts.groupBy("word", "ending").agg(F.sum("n").alias("n"))


def vocabulary(counts: DataFrame, settings: Settings = Settings()) -> Vocabulary:
    """Numbers for words from their counts; the driver receives `head` words and one row per ending (65,536 at most)."""
    totals = counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("tokens"),
        F.count(F.when(F.col("word").isNotNull(), 1)).alias("words"),
        F.coalesce(F.sum(F.when(F.col("word").isNull(), F.col("n"))), F.lit(0)).alias("texts"),
    ).first()
    words = counts.where("word IS NOT NULL")
    top = _frequent(words, settings.head)
    head = {bytes(r.word): i for i, r in enumerate(top)}
    # Endings share the classes behind the first in stretches of equal mass.
    masses, kinds = np.zeros(ENDINGS), np.zeros(ENDINGS, np.int64)
    for r in words.groupBy("ending").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("k")).collect():
        masses[r.ending], kinds[r.ending] = r.n, r.k
    shared = settings.classes - 1
    middle = np.cumsum(masses) - masses / 2
    ending_class = 1 + np.minimum((middle / max(masses.sum(), 1) * shared).astype(np.int64), shared - 1)
    class_tokens = np.bincount(ending_class, masses, settings.classes)
    class_words = np.bincount(ending_class, kinds, settings.classes)
    class_tokens[0], class_words[0] = totals.texts, 1
    return Vocabulary(
        int(totals.tokens), int(totals.words) + (totals.texts > 0), int(totals.texts), head, np.array([r.n for r in top], np.float64),
        ending_class[endings(list(head))], ending_class, class_tokens, class_words, settings,
    )


def _frequent(words: DataFrame, most: int) -> list:
    """(word, n) of the words above a frequency, chosen so that there are at most `most`; most frequent first.

    The frequency comes from a short histogram, eight steps per doubling, so no task or driver ranks all words.
    """
    step = F.floor(F.log2("n") * 8)
    histogram = {r.step: r.words for r in words.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("words")).collect()}
    lowest, held = None, 0
    for at in sorted(histogram, reverse=True):
        held += histogram[at]
        if held > most:
            break
        lowest = at
    if lowest is None:
        return []
    found = words.where(step >= lowest).select("word", "n").collect()
    return sorted(found, key=lambda r: (-r.n, bytes(r.word)))


@dataclass
class Weights:
    """Biases and feature rows of the class step, features of frequent words by the long skip, and log10 of the mass of
    each class by the long skip, which its words' probabilities are divided by.
    """

    bias: np.ndarray
    rows: np.ndarray
    words: np.ndarray
    mass: np.ndarray

    def __post_init__(self):
        # Three rows and the bias add up to a logit.
        self.steep = 3 * np.abs(self.rows).max(initial=0.0) + np.abs(self.bias).max() > LARGEST

    @staticmethod
    def initial(v: Vocabulary) -> Weights:
        """Biases that reproduce the smoothed frequencies of the classes, and no features."""
        s = v.settings
        smoothed = v.class_tokens + 1.0
        mass = np.repeat(np.log10(_class_mass(v))[:, None], s.classes + 1, axis=1)
        return Weights(
            np.log(smoothed / smoothed.sum()).astype(np.float32), np.zeros((s.rows + s.classes + 1, s.classes), np.float32),
            np.zeros((len(v.head), s.classes + 1), np.float32), mass,
        )


def _class_mass(v: Vocabulary) -> np.ndarray:
    """Smoothed counts of all words of each class and of one unknown word."""
    return np.maximum(v.class_tokens + v.settings.smoothing * (v.class_words + 1), 1e-9)


@dataclass
class Tokens:
    """A run of tokens: the two words before each, last first, its class, the place of a frequent word, the most frequent class of the
    words before (`classes` without any), and the number of its text.
    """

    before: np.ndarray
    classes: np.ndarray
    places: np.ndarray
    skip: np.ndarray
    texts: np.ndarray


class Reader:
    """Turns texts into tokens, in bounded runs."""

    def __init__(self, v: Vocabulary):
        self.v, self.get = v, v.head.get
        self.start = len(v.head) + v.settings.classes

    def _numbers(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
        """(ids as context, classes, places, other words) of a word list."""
        places = np.fromiter(map(self.get, words, repeat(OTHER)), np.int64, len(words))
        rare = np.flatnonzero(places < 0)
        others = [words[i] for i in rare.tolist()]
        classes = self.v.head_class[places] if len(self.v.head) else np.zeros(len(words), np.int64)
        if others:
            classes[rare] = self.v.ending_class[endings(others)]
        return np.where(places < 0, len(self.v.head) + classes, places), classes, places, others

    def runs(self, texts: list[str | None], seen=None) -> Iterator[Tokens]:
        """All tokens of the texts, each text's words and its end; `seen` gets each text's number and other words."""
        waiting, held, window = [], 0, self.v.settings.window
        for i, text in enumerate(texts):
            ids_before, classes_before = np.full(2, self.start, np.int64), np.zeros(0, np.int64)
            pieces = word_pieces(text, 1 << 18)
            words, more = next(pieces), True
            while more:
                # Only the last list of a text ends with its end.
                following = next(pieces, None)
                more = following is not None
                ids, classes, places, others = self._numbers(words)
                if seen is not None:
                    seen(i, others)
                if not more:
                    classes, places, ids = np.append(classes, 0), np.append(places, END), np.append(ids, 0)
                ids = np.concatenate([ids_before, ids])
                waiting.append((ids, classes, places, classes_before, i))
                held += len(classes)
                ids_before, classes_before = ids[-2:], np.concatenate([classes_before, classes])[-window:]
                if held > TOKENS_AT_ONCE:
                    yield self._join(waiting)
                    waiting, held = [], 0
                words = following
        if waiting:
            yield self._join(waiting)

    def _join(self, waiting) -> Tokens:
        sizes = [len(c) for _, c, _, _, _ in waiting]
        before = np.concatenate([np.stack([ids[1:-1], ids[:-2]], axis=1) for ids, *_ in waiting])
        classes = np.concatenate([c for _, c, _, _, _ in waiting])
        places = np.concatenate([p for _, _, p, _, _ in waiting])
        return Tokens(before, classes, places, self._skips(waiting), np.repeat([i for *_, i in waiting], sizes))

    def _skips(self, waiting) -> np.ndarray:
        """The most frequent class of up to `window` words before each token, the first of equally frequent ones."""
        s = self.v.settings
        row = np.concatenate([x for _, c, _, b, _ in waiting for x in (b, c)])
        lengths = np.array([(len(b), len(c)) for _, c, _, b, _ in waiting], np.int64)
        begins = np.cumsum(lengths.sum(axis=1)) - lengths.sum(axis=1)
        firsts = begins + lengths[:, 0]
        at = np.arange(lengths[:, 1].sum()) + np.repeat(firsts - (np.cumsum(lengths[:, 1]) - lengths[:, 1]), lengths[:, 1])
        low = np.maximum(at - s.window, np.repeat(begins, lengths[:, 1]))
        # Running sums may wrap around, since only differences of at most `window` are taken.
        sums = np.zeros((len(row) + 1, s.classes), np.uint8 if s.window < 256 else np.int64)
        sums[np.arange(1, len(row) + 1), row] = 1
        np.cumsum(sums, axis=0, out=sums, dtype=sums.dtype)
        found = (sums[at] - sums[low]).argmax(axis=1)
        found[at == low] = s.classes
        return found


def features(t: Tokens, s: Settings) -> np.ndarray:
    """Three feature rows per token: last word, last two, and the long skip."""
    one, two = (t.before[:, i].astype(np.uint64) + np.uint64(1) for i in range(2))
    mixed = np.stack([one * FACTORS[0], (one * FACTORS[1]) ^ (two * FACTORS[2])], axis=1)
    mixed ^= mixed >> np.uint64(31)
    mixed *= FACTORS[0]
    hashed = (mixed >> np.uint64(20)) % np.uint64(s.rows)
    rows = np.concatenate([hashed, (s.rows + t.skip.astype(np.uint64))[:, None]], axis=1)
    # Two bytes are sorted by counting, far faster than eight.
    return rows.astype(np.uint16 if s.rows + s.classes < 1 << 16 else np.int64)


def class_probabilities(w: Weights, rows: np.ndarray) -> np.ndarray:
    """The softmax over classes for each token's feature rows."""
    logits = w.rows[rows[:, 0]]
    for k in range(1, rows.shape[1]):
        logits += w.rows[rows[:, k]]
    logits += w.bias
    if w.steep:
        logits -= logits.max(axis=1, keepdims=True)
    np.exp(logits, out=logits)
    logits /= logits.sum(axis=1, keepdims=True)
    return logits


def _changes(values: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    return np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))


def _add_rows(table: np.ndarray, places: np.ndarray, rows: np.ndarray) -> None:
    """Add each row to the table's row at its place; rows of one place are added up first."""
    order = np.argsort(places, kind="stable")
    sorted_ = places[order]
    first = _changes(sorted_)
    table[sorted_[first]] += np.add.reduceat(rows[order], first, axis=0)


class Sums:
    """Observed and expected numbers of features and outcomes, added up over tokens.

    `observed` and `expected` go by feature row and class, `words` by frequent word and long skip, `skips` by class and
    long skip.
    """

    def __init__(self, w: Weights):
        self.w = w
        # A task's counts fit four bytes, since it reads less than 2 ** 31 tokens.
        self.observed, self.expected = np.zeros(w.rows.size, np.int32), np.zeros(w.rows.shape)
        self.words, self.skips = np.zeros(w.words.size, np.int32), np.zeros(w.mass.size, np.int32)

    def add(self, t: Tokens, s: Settings) -> None:
        rows = features(t, s)
        # Short sums in single precision, long ones in double.
        expected = np.zeros(self.expected.shape, np.float32)
        for begin in range(0, len(rows), s.batch):
            part = rows[begin : begin + s.batch]
            p = class_probabilities(self.w, part)
            *hashed, skip = part.T
            for column in hashed:
                _add_rows(expected, column, p)
            # The long skip changes seldom from token to token.
            first = _changes(skip)
            _add_rows(expected, skip[first], np.add.reduceat(p, first, axis=0))
        self.expected += expected
        np.add.at(self.observed, (rows.astype(np.int64) * s.classes + t.classes[:, None]).ravel(), ONE)
        frequent = t.places >= 0
        np.add.at(self.words, t.places[frequent] * (s.classes + 1) + t.skip[frequent], ONE)
        np.add.at(self.skips, t.classes * (s.classes + 1) + t.skip, ONE)

    def slices(self) -> Iterator[tuple[int, str, bytes]]:
        """(number, type, values): counts as whole numbers, then expectations, in slices of bounded length."""
        counts = np.concatenate([self.observed, self.words, self.skips])
        kinds = ((counts, "<i4"), (self.expected.ravel(), "<f4"))
        number = 0
        for values, kind in kinds:
            for begin in range(0, len(values), SLICE):
                yield number, kind, values[begin : begin + SLICE].astype(kind).tobytes()
                number += 1


def _add_up(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
    wide = "<f8" if frame.kind.iloc[0].startswith("<f") else "<i8"
    total = sum(np.frombuffer(d, k).astype(wide) for k, d in zip(frame.kind, frame.data))
    return pd.DataFrame({"slice": [key[0]], "kind": [wide], "data": [total.tobytes()]})


def sums_over(documents: DataFrame, v: Vocabulary, w: Weights) -> Sums:
    """The sums of `Sums` over all texts under common weights.

    Tasks send slices of their sums, which are added up in a tree of two levels, each as wide as the square root of the
    number of tasks; the driver receives one of each slice.
    """
    s = v.settings
    schema = pa.schema([("slice", pa.int32()), ("salt", pa.int32()), ("kind", pa.string()), ("data", pa.binary())])

    def work(batches):
        reader, sums, salt = Reader(v), Sums(w), None
        for batch in batches:
            salt = batch.column(1)[0].as_py() if salt is None and batch.num_rows else salt
            for tokens in reader.runs(batch.column(0).to_pylist()):
                sums.add(tokens, s)
        if salt is not None:
            for number, kind, data in sums.slices():
                yield record(schema, slice=[number], salt=[salt], kind=[kind], data=[data])

    salts = max(1, round(documents.rdd.getNumPartitions() ** 0.5))
    rows = documents.select(F.col("text").cast("string").alias("text"), F.pmod(F.spark_partition_id(), F.lit(salts)).alias("salt"))
    parts = map_batches(rows, work, "slice int, salt int, kind string, data binary")
    out = "slice int, kind string, data binary"
    with short_batches(documents.sparkSession):
        found = parts.groupBy("slice", "salt").applyInPandas(_add_up, out).groupBy("slice").applyInPandas(_add_up, out).collect()
    total = Sums(w)
    if found:
        flat = {kind: np.concatenate([np.frombuffer(r.data, kind) for r in sorted(found, key=lambda r: r.slice) if r.kind == kind]) for kind in ("<i8", "<f8")}
        sizes = np.cumsum([total.observed.size, total.words.size])
        total.observed, total.words, total.skips = (part.astype(np.float64) for part in np.split(flat["<i8"], sizes))
        total.expected = flat["<f8"].reshape(total.expected.shape)
    return total


def train(documents: DataFrame, v: Vocabulary, place: Column) -> Weights:
    """Weights after `rounds` updates over disjoint shares of the documents.

    `place` is a number in 0..1 per row that deals the rows to the rounds. The gradient of the log probability is
    observed less expected; each weight's step is scaled by how often its feature and outcome were met or expected.
    """
    s, w = v.settings, Weights.initial(v)
    words, skips = np.zeros(w.words.shape), np.zeros(w.mass.shape)
    for number in range(s.rounds):
        sums = sums_over(documents.where((place >= number * s.share) & (place < (number + 1) * s.share)), v, w)
        observed = sums.observed.reshape(w.rows.shape)
        step = s.rate * 2 * (observed - sums.expected) / (observed + sums.expected + s.prior)
        w = Weights(w.bias, w.rows + step.astype(np.float32), w.words, w.mass)
        words += sums.words.reshape(words.shape)
        skips += sums.skips.reshape(skips.shape)
    return Weights(w.bias, w.rows, *word_step(v, words, skips))


def word_step(v: Vocabulary, observed: np.ndarray, skips: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(weights, log10 masses) after one update of the word step from no features, for the pairs that occur.

    `observed` counts frequent words by long skip and `skips` classes by long skip, over all training texts. Without
    features a word's share of its class is that of its smoothed count, whatever the skip.
    """
    s, mass = v.settings, _class_mass(v)
    smoothed = v.head_count + s.smoothing
    expected = skips[v.head_class] * (smoothed / mass[v.head_class])[:, None] if len(smoothed) else observed
    step = s.word_rate * 2 * (observed - expected) / (observed + expected + s.word_prior)
    weights = np.where(observed > 0, step, 0.0).astype(np.float32)
    by_class = np.repeat(mass[:, None], s.classes + 1, axis=1)
    np.add.at(by_class, v.head_class, smoothed[:, None] * np.expm1(weights.astype(np.float64)))
    return weights, np.log10(np.maximum(by_class, 1e-9))


def log_probabilities(v: Vocabulary, w: Weights, t: Tokens) -> np.ndarray:
    """log10 probability of each token after its context; of words that are not frequent without their smoothed count."""
    s, found = v.settings, np.empty(len(t.classes))
    rows = features(t, s)
    for begin in range(0, len(rows), s.batch):
        part = slice(begin, begin + s.batch)
        p = class_probabilities(w, rows[part])
        found[part] = np.log10(np.maximum(p[np.arange(len(p)), t.classes[part]], 1e-30))
    words = t.places != END
    found[words] -= w.mass[t.classes[words], t.skip[words]]
    frequent = t.places >= 0
    at = t.places[frequent]
    found[frequent] += np.log10(v.head_count[at] + s.smoothing) + w.words[at, t.skip[frequent]] / np.log(10)
    return found


def score(documents: DataFrame, learn: Column, settings: Settings = Settings(), id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Train on the rows where `learn` holds and score all rows.

    Returns doc_id, n_tokens, n_known, train_tokens, base_score and score per row: words plus one end, those among them
    that occur in training, the number of training tokens, and the log10 probabilities of the whole text under smoothed
    word frequencies and under the model. NULL and empty texts consist of their end. Without training rows every token
    is unknown. A row whose `learn` is NULL is scored only. Repeated rows each count and are scored alike; columns
    other than id and text are not read. No rows give no rows.
    """
    rows = documents.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"), learn.alias("learn"))
    training = rows.where("learn").select("doc_id", "text")
    counts = written(count_words(training), "words")
    v = vocabulary(counts, settings)
    # Rows are dealt by id and text, whatever their order.
    w = train(training, v, drawn("doc_id", "text"))
    scored = written(_score_frequent(rows.select("doc_id", "text"), v, w).withColumn("row", F.monotonically_increasing_id()), "scored")

    smoothing = settings.smoothing
    known = counts.where("word IS NOT NULL").select(F.xxhash64("word").alias("h"), F.col("n").alias("c"))
    rare = scored.select("row", F.inline(F.arrays_zip("h", "times")))
    count = F.coalesce(F.col("c"), F.lit(0))
    added = rare.join(known, "h", "left").groupBy("row").agg(
        F.sum(F.col("times") * F.log10(count + smoothing)).alias("rare_sum"), F.sum(F.when(count > 0, F.col("times")).otherwise(0)).alias("rare_known")
    )
    whole = scored.drop("h", "times").join(added, "row", "left").na.fill(0, ["rare_sum", "rare_known"])
    base = float(np.log10(v.tokens + smoothing * (v.distinct + 1)))
    return whole.select(
        "doc_id", "n_tokens", (F.col("n_known") + F.col("rare_known")).alias("n_known"), F.lit(v.tokens).cast("long").alias("train_tokens"),
        (F.col("head_sum") + F.col("rare_sum") - F.col("n_tokens") * F.lit(base)).alias("base_score"),
        (F.col("model_sum") + F.col("rare_sum")).alias("score"),
    )


def _score_frequent(rows: DataFrame, v: Vocabulary, w: Weights) -> DataFrame:
    """Per row all that needs no word beside the frequent ones, and its other words as hashes with their numbers.

    head_sum adds log10(count + smoothing) over frequent words and the end; model_sum adds the log probabilities but for
    the log10(count + smoothing) of other words.
    """
    s = v.settings
    counts = np.log10(v.head_count + s.smoothing)
    end = float(np.log10(v.texts + s.smoothing))
    schema = pa.schema([
        ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("head_sum", pa.float64()),
        ("model_sum", pa.float64()), ("h", pa.list_(pa.int64())), ("times", pa.list_(pa.int64())),
    ])

    def work(batches):
        reader = Reader(v)
        digest = xxhash.xxh64_intdigest
        for batch in batches:
            texts = batch.column(1).to_pylist()
            tokens, known = np.zeros(len(texts), np.int64), np.full(len(texts), int(v.texts > 0), np.int64)
            head, model = np.full(len(texts), end), np.zeros(len(texts))
            rare = [Counter() for _ in texts]
            for t in reader.runs(texts, lambda i, others: rare[i].update(others)):
                frequent = t.places >= 0
                tokens += np.bincount(t.texts, minlength=len(texts))
                known += np.bincount(t.texts[frequent], minlength=len(texts))
                head += np.bincount(t.texts[frequent], counts[t.places[frequent]], len(texts))
                model += np.bincount(t.texts, log_probabilities(v, w, t), len(texts))
            yield record(
                schema, doc_id=batch.column(0), n_tokens=tokens, n_known=known, head_sum=head, model_sum=model,
                h=[np.fromiter(map(digest, c, repeat(SEED)), np.uint64, len(c)).view(np.int64) for c in rare],
                times=[list(c.values()) for c in rare],
            )

    return map_batches(
        rows, work, "doc_id long, n_tokens long, n_known long, head_sum double, model_sum double, h array<long>, times array<long>"
    )


def training_rows(modulus: int = 5, held_out: int = 1) -> Column:
    """Condition that excludes the held-out fold; NULL ids belong to no fold and teach nothing."""
    return remainder("doc_id", modulus) != held_out
