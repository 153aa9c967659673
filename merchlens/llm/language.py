"""Language identification with hyperdimensional profiles.

Each letter of any script has a fixed random vector of +1 and -1, drawn from its code point. An n-gram is bound by multiplying the vectors of its letters, each
rotated by its position; a text is the bundle (sum) of its n-gram vectors. A language prototype is the bundle of its
training texts, each scaled to length one, and a text belongs to the prototype with the largest cosine.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from merchlens.llm.shared import free_name, map_batches, record, remainder, written

UNKNOWN = "und"
CACHED_GRAMS = 50_000
CACHED_LETTERS = 8192
PIECE_CHARS = 1 << 18
POINTS = 0x110000
# Characters of the cut texts that limits are measured on.
LENGTHS = (5, 10, 20, 40, 80, 160, 320, 640)
# Cosines are counted in bins first; as they have four bytes, a bin holds a few thousand different ones.
BINS = 1 << 16


@dataclass(frozen=True)
class Settings:
    """Vector length and seed of the letter vectors. Up to `languages` prototypes go to the tasks at once; more take
    several passes.
    """

    size: int = 1024
    seed: int = 11
    languages: int = 2000


@dataclass(frozen=True)
class Model:
    """Languages in order with one prototype each; where there are more than a task may hold, they are in `stored`
    (lang, block, prototype array), numbered by blocks that one may hold.
    """

    languages: list[str]
    prototypes: np.ndarray
    settings: Settings
    stored: DataFrame | None = None
    blocks: int = 1

    def block(self, number: int) -> Model:
        """The model of one block of the languages."""
        if self.stored is None:
            return self
        rows = sorted(self.stored.where(F.col("block") == number).collect(), key=lambda r: r.lang)
        vectors = np.array([r.prototype for r in rows], np.float32).reshape(len(rows), self.settings.size)
        return Model([r.lang for r in rows], vectors, self.settings)


class Letters:
    """Code points of texts as letters: 0 for anything else, lower-cased."""

    def __init__(self):
        # 0 is not known yet, 1 a letter, 2 none.
        self.kinds = np.zeros(POINTS, np.uint8)

    def _letters(self, points: np.ndarray) -> np.ndarray:
        kinds = self.kinds[points]
        if not kinds.all():
            fresh = np.unique(points[kinds == 0])
            self.kinds[fresh] = [1 if chr(c).isalpha() else 2 for c in fresh.tolist()]
            kinds = self.kinds[points]
        return np.where(kinds == 1, points, 0)

    def trigrams(self, text: str | None) -> Iterator[np.ndarray]:
        """Keys of all trigrams of the whole text, in bounded arrays; none without a letter.

        A text has a 0 at either end and one 0 for each run of anything but letters.
        """
        lowered = (text or "").lower()
        last = np.zeros(1, np.int64)
        for start in range(0, len(lowered), PIECE_CHARS):
            points = np.frombuffer(lowered[start : start + PIECE_CHARS].encode("utf-32-le", "surrogatepass"), np.uint32)
            codes = self._letters(points).astype(np.int64)
            if start + PIECE_CHARS >= len(lowered):
                codes = np.append(codes, 0)
            # The codes before go on, so that no trigram is lost or added at the cut.
            codes = np.concatenate([last, codes])
            codes = codes[np.append(True, (codes[1:] != 0) | (codes[:-1] != 0))]
            if len(codes) > 2:
                yield (codes[:-2] * POINTS + codes[1:-1]) * POINTS + codes[2:]
            last = codes[-2:]


class Encoder:
    """Bundles texts; remembers the vectors of a bounded number of letters and trigrams."""

    def __init__(self, settings: Settings):
        self.size, self.seed, self.letters = settings.size, settings.seed, Letters()
        self.trigrams = 0
        self._forget_letters()
        self._forget_grams()

    def _forget_letters(self) -> None:
        self.places = np.full(POINTS, -1, np.int32)
        # A letter's vector, rotated for each of the three positions.
        self.rotated = np.empty((3, 64, self.size), np.int8)
        self.known = 0

    def _forget_grams(self) -> None:
        self.keys, self.rows = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.vectors = np.empty((CACHED_GRAMS, self.size), np.int8)

    def _learn_letters(self, points: np.ndarray) -> None:
        fresh = np.unique(points[self.places[points] < 0])
        if self.known + len(fresh) > CACHED_LETTERS:
            self._forget_letters()
            fresh = np.unique(points)
        while self.known + len(fresh) > self.rotated.shape[1]:
            self.rotated = np.concatenate([self.rotated, np.empty_like(self.rotated)], axis=1)
        for point in fresh.tolist():
            letter = np.random.default_rng([self.seed, point]).integers(0, 2, self.size, np.int8) * 2 - 1
            for i in range(3):
                self.rotated[i, self.known] = np.roll(letter, 2 - i)
            self.places[point] = self.known
            self.known += 1

    def _vectors(self, grams: np.ndarray) -> np.ndarray:
        """The vectors of different trigrams in order."""
        at = np.searchsorted(self.keys, grams)
        held = np.append(self.keys, -1)[at] == grams
        new = grams[~held]
        if len(new):
            if len(self.keys) + len(new) > CACHED_GRAMS:
                if len(grams) > CACHED_GRAMS:
                    return self._bind(grams)
                self._forget_grams()
                new = grams
            begin = len(self.keys)
            self.vectors[begin : begin + len(new)] = self._bind(new)
            where = np.searchsorted(self.keys, new)
            self.keys = np.insert(self.keys, where, new)
            self.rows = np.insert(self.rows, where, np.arange(begin, begin + len(new)))
            at = np.searchsorted(self.keys, grams)
        return self.vectors[self.rows[at]]

    def _bind(self, grams: np.ndarray) -> np.ndarray:
        bound = np.empty((len(grams), self.size), np.int8)
        # So few trigrams at once that their letters can all be held.
        for begin in range(0, len(grams), CACHED_LETTERS // 4):
            part = grams[begin : begin + CACHED_LETTERS // 4]
            points = np.stack([part // POINTS**2, part // POINTS % POINTS, part % POINTS])
            self._learn_letters(points.ravel())
            first, second, third = self.places[points]
            bound[begin : begin + len(part)] = self.rotated[0, first] * self.rotated[1, second] * self.rotated[2, third]
        return bound

    def __call__(self, text: str | None) -> np.ndarray | None:
        """The bundle of all trigrams of the whole text, counted in `trigrams`; None without any letter."""
        total, self.trigrams, lettered = np.zeros(self.size, np.float32), 0, False
        for keys in self.letters.trigrams(text):
            lettered = lettered or bool(keys.any())
            self.trigrams += len(keys)
            grams, counts = np.unique(keys, return_counts=True)
            for begin in range(0, len(grams), CACHED_GRAMS):
                part = slice(begin, begin + CACHED_GRAMS)
                total = total + counts[part].astype(np.float32) @ self._vectors(grams[part]).astype(np.float32)
        return total if lettered else None

    def together(self, texts: list[str], remember: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(bundle, number of trigrams, whether there is a letter) of each of a few short texts.

        Trigrams of random strings hardly come back; without `remember` they do not push others out.
        """
        keys = [np.concatenate([np.zeros(0, np.int64), *self.letters.trigrams(t)]) for t in texts]
        lengths = np.array(list(map(len, keys)))
        grams, places = np.unique(np.concatenate(keys), return_inverse=True)
        cells = np.repeat(np.arange(len(texts)) * len(grams), lengths) + places
        counts = np.bincount(cells, minlength=len(texts) * len(grams)).reshape(len(texts), len(grams)).astype(np.float32)
        vectors = self._vectors(grams) if remember else self._bind(grams)
        return counts @ vectors.astype(np.float32), lengths, np.array([bool(k.any()) for k in keys])


def _unit(vector: np.ndarray) -> np.ndarray:
    return vector / max(float(np.linalg.norm(vector)), 1e-12)


class Predictor:
    def __init__(self, model: Model):
        self.model, self.encoder = model, Encoder(model.settings)

    def __call__(self, text: str | None) -> tuple[str, float]:
        bundle = self.encoder(text)
        if bundle is None or not self.model.languages:
            return UNKNOWN, 0.0
        cosines = self.model.prototypes @ _unit(bundle)
        best = int(np.argmax(cosines))
        return self.model.languages[best], float(min(1.0, max(0.0, cosines[best])))

    def scores(self, texts: list[str], remember: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """(score, number of trigrams) of each of a few short texts."""
        bundles, trigrams, lettered = self.encoder.together(texts, remember)
        units = bundles / np.maximum(np.linalg.norm(bundles, axis=1, keepdims=True), np.float32(1e-12))
        return np.where(lettered, np.clip((units @ self.model.prototypes.T).max(axis=1), 0, 1), 0), trigrams


def fit(documents: DataFrame, settings: Settings = Settings(), learn: Column | None = None) -> Model:
    """Prototypes from the text and language of documents (doc_id, text, lang).

    `learn` is a condition on the documents that may be used, all of which teach; rows without language or without a
    letter teach nothing. Bundles are added up in the tasks and then by Spark; the driver receives one vector per
    language, or, with more languages than `languages`, none: then the prototypes stay in a table.
    """
    usable = documents.select("doc_id", "text", "lang").where("lang IS NOT NULL AND text IS NOT NULL")
    if learn is not None:
        usable = usable.where(learn)
    known = usable.select("lang").distinct().limit(settings.languages + 1).count()
    if not known:
        return Model([], np.zeros((0, settings.size), np.float32), settings)
    many = known > settings.languages
    schema = pa.schema([("lang", pa.string()), ("bundle", pa.list_(pa.float64()))])

    def work(batches):
        encoder, sums = Encoder(settings), {}

        def flush():
            batch = record(schema, lang=list(sums), bundle=list(sums.values()))
            sums.clear()
            return batch

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                bundle = encoder(text)
                if bundle is not None:
                    sums[lang] = sums.get(lang, 0.0) + _unit(bundle.astype(np.float64))
            if len(sums) > settings.languages:
                yield flush()
        yield flush()

    parts = map_batches(usable.select("lang", "text"), work, "lang string, bundle array<double>")
    added = parts.select("lang", F.posexplode("bundle").alias("i", "x")).groupBy("lang", "i").agg(F.sum("x").alias("x"))
    if many:
        return _stored(added, settings)
    found = added.toPandas().sort_values(["lang", "i"])
    languages = sorted(found.lang.unique().tolist())
    prototypes = found.x.to_numpy(np.float64).reshape(len(languages), settings.size)
    return Model(languages, np.array([_unit(p) for p in prototypes], np.float32).reshape(len(languages), settings.size), settings)


def _stored(added: DataFrame, settings: Settings) -> Model:
    """A model whose prototypes, of length one, stay in a table in blocks of about half of what a task may hold."""
    vectors = added.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("i", "x"))).alias("v"))
    length = F.greatest(F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, e: s + e["x"] * e["x"])), F.lit(1e-12))
    unit = vectors.select("lang", F.transform("v", lambda e: (e["x"] / length).cast("float")).alias("prototype"))
    stored = written(unit, "prototypes")
    blocks = max(1, -(-2 * stored.count() // settings.languages))
    numbered = written(stored.withColumn("block", F.pmod(F.xxhash64("lang"), F.lit(blocks))), "prototype-blocks", "block")
    return Model([], np.zeros((0, settings.size), np.float32), settings, numbered, blocks)


def predict(documents: DataFrame, model: Model, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) for every row: the nearest prototype and its cosine, cut to 0..1.

    Texts that are NULL, empty or without any letter are `und` with score 0, and so is every text when nothing was
    learned. Of equally near prototypes the first by name wins. Other columns are not read.
    """
    rows = documents.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    if model.stored is None:
        return _nearest(rows, model, "doc_id").drop("trigrams")
    return nearest_of_all(rows.withColumn("row", F.monotonically_increasing_id()), model).select("doc_id", "lang_pred", "score")


def _nearest(rows: DataFrame, model: Model, id_column: str) -> DataFrame:
    """(id, lang_pred, score, trigrams) of rows (id, text) among the languages of one model that a task can hold."""
    schema = pa.schema([(id_column, pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()), ("trigrams", pa.int64())])

    def work(batches):
        predictor = Predictor(model)
        for batch in batches:
            found = [(*predictor(t), predictor.encoder.trigrams) for t in batch.column(1).to_pylist()]
            columns = dict(zip(schema.names[1:], map(list, zip(*found)))) if found else {n: [] for n in schema.names[1:]}
            yield record(schema, **{id_column: batch.column(0)}, **columns)

    return map_batches(rows.select(id_column, "text"), work, f"{id_column} long, lang_pred string, score double, trigrams long")


def nearest_of_all(rows: DataFrame, model: Model) -> DataFrame:
    """The columns of `rows` (row, text, ...) but the text, with lang_pred, score and trigrams, over all blocks of a
    model. Rows are written once and each block of prototypes passes over them.
    """
    rows = written(rows, "texts")
    found = None
    for number in range(model.blocks):
        part = written(_nearest(rows.select("row", "text"), model.block(number), "row"), "nearest")
        found = part if found is None else found.unionByName(part)
    # The largest cosine, of equal ones the first language; `und` only where every block says so.
    best = F.min(F.struct((F.col("lang_pred") == UNKNOWN).alias("none"), (-F.col("score")).alias("s"), "lang_pred", "trigrams")).alias("best")
    merged = found.groupBy("row").agg(best).select("row", "best.lang_pred", (-F.col("best.s")).alias("score"), "best.trigrams")
    return rows.drop("text").join(merged, "row")


@dataclass(frozen=True)
class Limits:
    """Least cosine by the number of trigrams, measured at `trigrams` (ascending) and interpolated by its logarithm."""

    trigrams: np.ndarray
    cosines: np.ndarray

    def __call__(self, trigrams: int) -> float:
        return float(np.interp(np.log(max(1, trigrams)), self.trigrams, self.cosines))


def limits(documents: DataFrame, model: Model, held_out: Column, lost: float = 0.02) -> Limits | None:
    """The cosines that tell learned languages from chance, from rows of `documents` that taught nothing.

    The texts of all rows in a learned language where `held_out` holds are cut to several lengths, and beside each cut a
    string of as many random letters of the same text is made. At each length the limit is what all but the share
    `lost` of the random strings stay below, in the language where they come nearest, but no more than what all but that
    share of the clean cuts reach, in the language where these lie lowest: very short texts are not told apart from
    chance at the expense of clean ones. NULL texts and texts of fewer than two letters at their beginning, as far as
    the longest cut needs it, measure nothing, repeated rows count alike. None without such rows.
    """
    usable = documents.select("lang", "text").where("text IS NOT NULL AND lang IS NOT NULL").where(held_out)
    if model.stored is None:
        usable = usable.where(F.col("lang").isin(model.languages))
    else:
        usable = usable.join(model.stored.select("lang"), "lang", "left_semi")
    measured = written(_measured(usable.select("lang", "text"), model).where("trigrams > 0"), "measured")
    by_language = percentiles(measured, ["length", "lang"], {"trigrams": 0.5, "clean": lost, "random": 1 - lost})
    # One row per length.
    found = by_language.groupBy("length").agg(
        F.avg("trigrams").alias("trigrams"), F.least(F.min("clean"), F.max("random")).alias("limit")
    ).orderBy("trigrams").collect()
    return Limits(np.log([max(1.0, r.trigrams) for r in found]), np.array([r.limit for r in found])) if found else None


def _cuts(text: str) -> list[tuple[int, str, str]]:
    """(length, cut, string of as many random letters of the text) for each length that the text reaches."""
    letters = sorted(c for c in set(text[: 2 * LENGTHS[-1]].lower()) if c.isalpha())
    if len(letters) < 2:
        return []
    rng = np.random.default_rng(len(text))
    choices = len(letters) * 6 // 5 + 1
    points = np.array([*map(ord, letters), *[ord(" ")] * (choices - len(letters))], "<u4")
    lengths = [n for n in LENGTHS if n <= len(text)]
    return [(n, text[:n], points[rng.integers(0, choices, n)].tobytes().decode("utf-32-le", "surrogatepass")) for n in lengths]


def _measured(rows: DataFrame, model: Model) -> DataFrame:
    """(lang, length, trigrams, clean, random) for every cut of texts (lang, text): its trigrams, its cosine and that of
    the random string beside it.
    """
    if model.stored is not None:
        return _measured_of_all(rows, model)
    schema = pa.schema([("lang", pa.string()), ("length", pa.int64()), ("trigrams", pa.int64()), ("clean", pa.float64()), ("random", pa.float64())])

    def work(batches):
        predictor = Predictor(model)
        for batch in batches:
            out = []
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if cuts := _cuts(text):
                    lengths, clean, random = zip(*cuts)
                    scores, trigrams = predictor.scores(clean)
                    chance, _ = predictor.scores(random, remember=False)
                    out += zip([lang] * len(cuts), lengths, trigrams.tolist(), scores.tolist(), chance.tolist())
            yield record(schema, **(dict(zip(schema.names, map(list, zip(*out)))) if out else {n: [] for n in schema.names}))

    return map_batches(rows, work, "lang string, length long, trigrams long, clean double, random double")


def _measured_of_all(rows: DataFrame, model: Model) -> DataFrame:
    """The same over all blocks of a model: cuts are numbered and written, so that both cosines find each other."""
    schema = pa.schema([("lang", pa.string()), ("length", pa.int64()), ("clean", pa.string()), ("random", pa.string())])

    def work(batches):
        for batch in batches:
            out = [(lang, *cut) for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for cut in _cuts(text)]
            yield record(schema, **(dict(zip(schema.names, map(list, zip(*out)))) if out else {n: [] for n in schema.names}))

    cuts = map_batches(rows, work, "lang string, length long, clean string, random string")
    cuts = written(cuts.withColumn("cut", F.monotonically_increasing_id()), "cuts")
    both = F.explode(F.create_map(F.lit(False), "clean", F.lit(True), "random")).alias("is_random", "text")
    texts = cuts.select("lang", "length", "cut", both).withColumn("row", F.monotonically_increasing_id())
    return nearest_of_all(texts, model).groupBy("cut", "length", "lang").agg(
        F.max(F.when(~F.col("is_random"), F.col("trigrams"))).alias("trigrams"),
        F.max(F.when(~F.col("is_random"), F.col("score"))).alias("clean"), F.max(F.when(F.col("is_random"), F.col("score"))).alias("random"),
    ).drop("cut")


def percentiles(rows: DataFrame, by: list[str], shares: dict[str, float]) -> DataFrame:
    """One row per group with the exact percentile of each column of `shares`, interpolated like percentile().

    The values of a group never meet in one task: they are counted in bins, and only the different values of the one or
    two bins where the percentile lies are put in order. Values are whole numbers or in 0..1; rows are read twice. Rows
    with a NULL in `by` are left out.
    """
    pairs = [F.struct(F.lit(n).alias("of"), F.lit(p).alias("share"), F.col(n).cast("double").alias("value")) for n, p in shares.items()]
    values = rows.select(*by, F.inline(F.array(*pairs))).withColumn("bin", F.floor(F.col("value") * BINS))
    group = [*by, "of"]
    binned = values.groupBy(*group, "share", "bin").agg(F.count(F.lit(1)).alias("n"))
    running = Window.partitionBy(*group).orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = binned.withColumn("upto", F.sum("n").over(running)).withColumn("place", F.col("share") * (F.sum("n").over(Window.partitionBy(*group)) - 1))
    low, high = F.floor("place"), F.ceil("place")
    chosen = placed.where((F.col("upto") > low) & (F.col("upto") - F.col("n") <= high)).select(*group, "bin", "place", (F.col("upto") - F.col("n")).alias("below"))
    inside = values.join(chosen, [*group, "bin"]).groupBy(*group, "place", "below", "value").agg(F.count(F.lit(1)).alias("n"))
    # `below` counts the values of all lower bins.
    upto = F.col("below") + F.sum("n").over(Window.partitionBy(*group, "below").orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ends = inside.withColumn("upto", upto).groupBy(*group, "place").agg(
        F.min(F.when(F.col("upto") > low, F.col("value"))).alias("low"), F.min(F.when(F.col("upto") > high, F.col("value"))).alias("high")
    )
    between = F.when(F.col("low") == F.col("high"), F.col("low")).otherwise((high - F.col("place")) * F.col("low") + (F.col("place") - low) * F.col("high"))
    return ends.groupBy(*by).agg(*[F.max(F.when(F.col("of") == n, between)).alias(n) for n in shares])


def keep_known(documents: DataFrame, model: Model, least: float = 0.02, text: str = "text", limits: Limits | None = None) -> DataFrame:
    """The rows of `documents` in a learned language, all columns unchanged.

    Rejected are texts without a letter and texts whose cosine to every prototype is under the limit of their length.
    Without `limits` it is `least` for all; as the largest of several chance cosines (about 0.03 each between random
    vectors of length 1024) is tested, so low a limit rejects hardly any text with letters. NULL and empty texts go,
    repeated rows are judged alike, and no rows give no rows.
    """

    def known(lang: str, score: float, trigrams: int) -> bool:
        return lang != UNKNOWN and score >= (least if limits is None else limits(trigrams))

    if model.stored is not None:
        return _keep_known_of_all(documents, model, known, text)
    position = documents.columns.index(text)

    def work(batches):
        predictor = Predictor(model)
        for batch in batches:
            kept = [known(*predictor(t), predictor.encoder.trigrams) for t in batch.column(position).to_pylist()]
            yield batch.filter(pa.array(kept, pa.bool_()))

    return map_batches(documents, work, documents.schema)


def _keep_known_of_all(documents: DataFrame, model: Model, known, text: str) -> DataFrame:
    """The same over all blocks of a model: rows are numbered and written, so that verdicts find them again."""
    number = free_name(documents, "row")
    rows = written(documents.withColumn(number, F.monotonically_increasing_id()), "numbered")
    found = nearest_of_all(rows.select(F.col(number).alias("row"), F.col(text).cast("string").alias("text")), model)

    def work(batches):
        for batch in batches:
            kept = [known(*values) for values in zip(*(batch.column(i).to_pylist() for i in range(1, 4)))]
            yield batch.filter(pa.array(kept, pa.bool_())).select([0])

    kept = map_batches(found.select("row", "lang_pred", "score", "trigrams"), work, "row long").withColumnRenamed("row", number)
    return rows.join(kept, number, "left_semi").drop(number)


def training_rows(modulus: int = 3, held_out: int = 1) -> Column:
    """Condition that excludes the held-out fold; NULL ids belong to no fold and teach nothing."""
    return remainder("doc_id", modulus) != held_out

