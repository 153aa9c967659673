"""Text operators against brute force and held-out rows, with the awkward inputs of real tables."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from itertools import pairwise

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from merchlens.llm import decontaminate as dc
from merchlens.llm import language, language_model, mixing, quality, simhash
from merchlens.llm.components import components

FOLDER = "/root/testdata/sf0.001"
# Columns whose names clash with those the operators use inside.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, fp string, row long, label int"
LONG = " ".join(f"w{i % 997}" for i in range(300_000))


def frame(spark, rows):
    """(doc_id, text, lang, source) tuples as a table with clashing extra columns."""
    return spark.createDataFrame([(*r, None, 0.5, "x", 1, 2) for r in rows], SCHEMA)


def awkward(spark):
    return frame(spark, [
        (1, "The quick brown fox jumps", "en", "a"), (1, "The quick brown fox jumps", "en", "a"), (2, "", "en", "a"),
        (3, None, None, None), (None, "der die das und", "de", "b"), (5, LONG, "en", "b"), (6, "1234 !!", "en", None),
    ])


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


# ------------------------------------------------------------------ components and SimHash


def reachable(nodes, near):
    lowest = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a in nodes:
            best = min([lowest[a], *(lowest[b] for b in nodes if near(a, b))])
            changed |= best < lowest[a]
            lowest[a] = best
    return lowest


def test_components_of_a_path_a_star_and_loops(spark):
    edges = [*pairwise(range(40)), *((100, i) for i in range(101, 160)), (200, 200), (300, 301), (301, 300), (None, 5)]
    found = components(spark.createDataFrame(edges, "x long, y long"), "x", "y").collect()
    roots = {r.node: r.root for r in found}
    assert len(found) == len(roots)
    assert roots == {**{i: 0 for i in range(40)}, **{i: 100 for i in range(100, 160)}, 300: 300, 301: 300}
    assert components(spark.createDataFrame([], "x long, y long"), "x", "y").count() == 0


def plain_fingerprint(text, words=4):
    tokens = [t for t in (text or "").encode().lower().split() if t]
    shingles = [b" ".join(tokens[i : i + words]) for i in range(len(tokens) - words + 1)] or ([b" ".join(tokens)] if tokens else [])
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64)) if hashes else 0


@pytest.mark.parametrize("text", [None, "", "One", "a b c d", "A\tb\x0bc\nd e É é x  y", " ".join(f"w{i}" for i in range(700))])
def test_fingerprint_is_the_majority_of_shingle_hashes(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_fingerprint_of_a_text_in_pieces(monkeypatch):
    monkeypatch.setattr(simhash, "word_pieces", lambda text: ([w] for w in text.encode().lower().split()))
    assert simhash.fingerprint("a b c d e f g") == plain_fingerprint("a b c d e f g")


@pytest.mark.parametrize("bucket", [1, 512])
def test_links_connect_what_close_pairs_connect(spark, bucket):
    rng = np.random.default_rng(5)
    values = {0, 1, 0b11111, (1 << 64) - 1}
    for _ in range(12):
        at = int(rng.integers(0, 1 << 63))
        for _ in range(9):
            values.add(at)
            for bit in rng.choice(64, rng.integers(1, 6), replace=False):
                at ^= 1 << int(bit)
    values = sorted(values)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    pairs = simhash.links(spark.createDataFrame([(v,) for v in signed], "fp long"), simhash.SimHash(bucket=bucket))
    roots = {r.node: r.root for r in components(pairs, "a", "b").collect()}
    near = lambda a, b: bin((a ^ b) & (1 << 64) - 1).count("1") <= 4
    assert {v: roots.get(v, v) for v in signed} == reachable(signed, near)


def test_near_duplicates_of_awkward_rows(spark):
    found = simhash.near_duplicates(awkward(spark)).collect()
    by_id = {}
    for r in found:
        by_id.setdefault(r.doc_id, []).append((r.fp, r.component_id))
    assert len(found) == 7 and by_id[1][0] == by_id[1][1] and by_id[1][0][1] == 1
    assert by_id[2] == by_id[3] == [(0, 2)]
    assert by_id[None][0][1] is None
    assert simhash.near_duplicates(awkward(spark).limit(0)).count() == 0
    kept = simhash.keep_one(awkward(spark))
    assert kept.columns == awkward(spark).columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 2, 5, 6]


def test_different_texts_under_one_id_are_all_kept(spark):
    first, second = " ".join(f"a{i}" for i in range(80)), " ".join(f"b{i}" for i in range(80))
    rows = frame(spark, [
        (1, first, "en", "a"), (1, second, "en", "a"), (2, first, "en", "a"), (3, second, "en", "b"), (None, "lone words here", "en", "b"),
        (None, "other words there", "en", "b"),
    ])
    kept = simhash.keep_one(rows)
    assert kept.columns == rows.columns
    assert sorted((r.doc_id or 0, r.text[:2]) for r in kept.collect()) == [(0, "lo"), (0, "ot"), (1, "a0"), (1, "b0")]


# ------------------------------------------------------------------ classifiers


def test_quality_on_held_out_rows(spark):
    documents, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{n}.parquet") for n in ("documents", "labels"))
    model = quality.fit(documents, labels, learn=quality.training_rows())
    rows = quality.score(documents, model).join(labels, "doc_id").collect()
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert len(held) > 50
    assert np.mean([r.predicted == r.quality for r in held]) > 0.9
    assert np.mean([r.predicted for r in rows if r.quality == 1]) > 0.98
    kept = quality.keep_good(documents, model)
    assert kept.schema == documents.schema
    assert kept.count() == quality.score(documents, model).where("predicted = 1").count()


def test_quality_of_awkward_rows(spark):
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 1), (5, 1), (None, 1), (7, None)], "doc_id long, quality int")
    model = quality.fit(awkward(spark), labels)
    found = quality.score(awkward(spark), model).collect()
    assert len(found) == 7 and all(0 <= r.score <= 1 for r in found)
    assert len({r.score for r in found if r.doc_id in (2, 3)}) == 1
    untaught = quality.fit(awkward(spark).limit(0), labels.limit(0))
    assert {r.score for r in quality.score(awkward(spark), untaught).collect()} == {0.5}
    assert quality.score(awkward(spark).limit(0), model).count() == 0


def plain_counts(text, settings):
    """Buckets of every word and n-gram, one at a time."""
    counts, cut = Counter(), (1 << 64) - 1
    for word in text.split():
        marked = f"<{word}>"
        counts[zlib.crc32(marked.encode()) % settings.buckets] += 1
        for n in range(settings.shortest, settings.longest + 1):
            for i in range(len(marked) - n + 1):
                rolled = ord(marked[i]) * int(quality.HASH_FACTOR) & cut
                for c in marked[i + 1 : i + n]:
                    rolled = (rolled ^ ord(c)) * int(quality.HASH_FACTOR) & cut
                counts[(rolled >> 29) % settings.buckets] += 1
    return counts


@pytest.mark.parametrize("at_once", [5, 64, 1 << 20])
def test_quality_scores_equal_the_mean_over_all_subwords(monkeypatch, at_once):
    monkeypatch.setattr(quality, "CHARS_AT_ONCE", at_once)
    settings = quality.Settings(buckets=64)
    model = quality.Model(np.arange(64, dtype=np.float32) / 64, 0.25, settings)
    texts = ["Some words, some  more wordsé " + "xyz" * 70, "a", "one " + "longword" * 20 + " one", None]
    for text in texts[:3]:
        ids, counts = quality.features(text, settings)
        assert dict(zip(ids.tolist(), counts.tolist())) == plain_counts(text, settings)
    expected = []
    for text in texts:
        found = plain_counts(text or "", settings)
        mean = sum(n * float(model.buckets[b]) for b, n in found.items()) / max(1, sum(found.values()))
        expected.append(1 / (1 + np.exp(-mean - 0.25)))
    assert quality.Scorer(model)(texts) == pytest.approx(expected)


def test_quality_counts_more_than_two_bytes_hold(spark):
    settings = quality.Settings(buckets=1 << 16)
    ids, counts = quality.features("ab " * 70_000, settings)
    assert counts.max() == 70_000 and counts.dtype == np.uint32
    rows = frame(spark, [(1, "ab " * 70_000, "en", "a"), (2, "cd ef", "en", "a")])
    model = quality.fit(rows, spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int"))
    scores = {r.doc_id: r.score for r in quality.score(rows, model).collect()}
    assert scores[1] > scores[2]


def test_quality_learns_from_every_labelled_row(spark):
    rng = np.random.default_rng(8)
    rows = [(i, "".join(chr(c) for c in rng.integers(0x4E00, 0x9FA5, 4)), "zh", "a") for i in range(3000)]
    labels = spark.createDataFrame([(i, int(rng.integers(0, 2))) for i in range(3000)], "doc_id long, quality int")
    data = frame(spark, rows)
    model = quality.fit(data, labels)
    scores = quality.score(data, model).join(labels, "doc_id").collect()
    # Each text has n-grams of its own, so a row that teaches nothing is right by chance only.
    assert np.mean([(r.score > 0.5) == (r.quality == 1) for r in scores]) > 0.97
    equal = frame(spark, [(1, "ab cd", "en", "a")] * 70 + [(2, "ef gh", "en", "a")] * 3)
    few = quality.fit(equal, spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int"), quality.Settings(rows=10))
    found = {r.doc_id: r.score for r in quality.score(equal, few).collect()}
    assert found[1] > found[2]


def captured(monkeypatch):
    """The rows that quality.fit deals to its groups, as often as it is called."""
    dealt, work = [], quality.map_batches
    monkeypatch.setattr(quality, "map_batches", lambda data, *rest: dealt.append(data) or work(data, *rest))
    return dealt


@pytest.mark.parametrize("broadcast", ["-1", "10m"])
def test_quality_training_shuffles_texts_once(spark, monkeypatch, broadcast):
    dealt = captured(monkeypatch)
    data = frame(spark, [(i, f"word{i} good" if i % 2 else f"word{i} bad", "en", "a") for i in range(60)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(0, 60, 3)], "doc_id long, quality int")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        quality.fit(data, labels, quality.Settings(rows=20), quality.training_rows())
        plan = spark._jvm.PythonSQLUtils.explainString(dealt[0]._jdf.queryExecution(), "formatted")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(re.findall(r"\) Exchange\nInput \[\d+\]: \[[^]]*\btext#", plan)) == 1
    assert dealt[0].count() == sum(zlib.crc32(str(i).encode()) % 5 != 0 for i in range(0, 60, 3))


@pytest.mark.parametrize("texts_per_row", [0, 8, 10**9])
@pytest.mark.parametrize("partitions", ["2", "7"])
def test_quality_groups_hold_the_labelled_rows(spark, monkeypatch, texts_per_row, partitions):
    """Whatever the labels' share and the session's partitions, each row teaches as often as it comes, in groups by a hash."""
    monkeypatch.setattr(quality, "TEXTS_PER_ROW", texts_per_row, raising=False)
    dealt, settings = captured(monkeypatch), quality.Settings(rows=10)
    kinds = [(i % 12, (None, "", "good words", f"bad {i}")[i % 4], "en", "a") for i in range(60)]
    data = frame(spark, [*kinds, *kinds[:9], (None, "good words", "en", "a"), (77, None, "en", "a")])
    labels = spark.createDataFrame([(i, i % 2) for i in range(8)] + [(3, 0), (None, 1), (9, None), (500, 1)], "doc_id long, quality int")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        quality.fit(data, labels, settings)
        found = dealt[0].toDF("label", "text").withColumn("group", F.spark_partition_id()).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    known = {i: i % 2 for i in range(8)} | {3: 0}
    expected = [(known[i], text) for i, text, *_ in [*kinds, *kinds[:9]] if i in known]
    assert Counter((r.label, r.text) for r in found) == Counter(expected)
    keyed = data.where("doc_id < 8").withColumn("key", quality.text_key())
    places = keyed.select(F.pmod(F.hash("doc_id", "key"), F.lit(-(-len(expected) // 10))).alias("group"), "doc_id", "text").collect()
    assert Counter((r.group, r.text) for r in found) == Counter((r.group, r.text) for r in places)


def test_language_on_held_out_rows(spark):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language.fit(documents, learn=language.training_rows())
    rows = language.predict(documents, model).join(documents.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert np.mean([r.lang == r.lang_pred for r in held]) > 0.97
    assert language.keep_known(documents, model).count() > 0.99 * len(rows)


def test_language_of_awkward_rows(spark):
    model = language.fit(awkward(spark))
    assert model.languages == ["de", "en"]
    found = language.predict(awkward(spark), model).collect()
    assert Counter(r.lang_pred for r in found if r.doc_id in (2, 3, 6)) == {"und": 3}
    assert [r.lang_pred for r in found if r.doc_id is None] == ["de"]
    assert {r.doc_id for r in language.keep_known(awkward(spark), model).collect()} == {1, 5, None}
    nothing = language.fit(awkward(spark).limit(0))
    assert {r.lang_pred for r in language.predict(awkward(spark), nothing).collect()} == {"und"}


def plain_bundle(text, settings):
    """Sum over trigrams of products of rotated letter vectors, one at a time."""
    codes = [0]
    for c in text.lower() + " ":
        code = ord(c) if c.isalpha() else 0
        if code or codes[-1]:
            codes.append(code)
    letter = {c: np.random.default_rng([settings.seed, c]).integers(0, 2, settings.size, np.int8).astype(int) * 2 - 1 for c in set(codes)}
    grams = Counter(zip(codes, codes[1:], codes[2:]))
    return sum(n * np.prod([np.roll(letter[c], 2 - i) for i, c in enumerate(g)], axis=0) for g, n in grams.items())


@pytest.mark.parametrize("text", ["abc dé ", "a", "x y", "1ab2", "ſß Ωσς", "中文 한글 кириллица", "\U0001d400\U00010400a"])
def test_bundles_equal_brute_force(text):
    settings = language.Settings(size=64)
    assert (language.Encoder(settings)(text) == plain_bundle(text, settings)).all()


@pytest.mark.parametrize("piece", [3, 5, 1 << 18])
def test_long_texts_are_bundled_whole(monkeypatch, piece):
    settings = language.Settings(size=64)
    text = "abc dé  -- ΑΣ xyz" * 90
    expected = plain_bundle(text, settings)
    monkeypatch.setattr(language, "PIECE_CHARS", piece)
    encoder = language.Encoder(settings)
    assert (encoder(text) == expected).all() and encoder.trigrams == len(np.concatenate(list(encoder.letters.trigrams(text))))


def test_letters_do_not_share_vectors_and_caches_are_bounded(monkeypatch):
    settings = language.Settings(size=64)
    rng = np.random.default_rng(3)
    texts = ["".join(chr(c) for c in rng.integers(0x4E00, 0x9FA5, 60)) for _ in range(30)] + ["".join(map(chr, range(0x430, 0x450)))]
    monkeypatch.setattr(language, "CACHED_LETTERS", 300)
    monkeypatch.setattr(language, "CACHED_GRAMS", 100)
    encoder = language.Encoder(settings)
    assert all((encoder(t) == plain_bundle(t, settings)).all() for t in texts) and encoder.known <= 300
    alone = [language.Encoder(settings)(c) for c in "àÿèćòđабвгд"]
    assert len({v.tobytes() for v in alone}) == len(alone)


def test_prototypes_equal_brute_force(spark):
    rows = [(1, "der die das", "de", "a"), (2, "und oder", "de", "a"), (3, "the of", "en", "a"), (4, "123", "en", "a"), (5, "the", None, "a")]
    settings = language.Settings(size=128)
    model = language.fit(frame(spark, rows), settings)
    unit = lambda v: v / np.linalg.norm(v)
    for lang, prototype in zip(model.languages, model.prototypes):
        expected = unit(sum(unit(plain_bundle(t, settings)) for _, t, x, _ in rows if x == lang and t != "123"))
        assert np.abs(prototype - expected).max() < 1e-6


def test_every_row_teaches_its_language(spark):
    rng = np.random.default_rng(9)
    words = ["".join(rng.choice(list("abcdefghij"), 6)) for _ in range(300)]
    settings = language.Settings(size=64)
    texts = [words[i] for i in rng.integers(0, 300, 12_000)]
    model = language.fit(spark.createDataFrame([(i, t, "xx") for i, t in enumerate(texts)], "doc_id long, text string, lang string"), settings)
    unit = lambda v: v / np.linalg.norm(v)
    expected = unit(sum(n * unit(plain_bundle(t, settings)) for t, n in Counter(texts).items()))
    assert np.abs(model.prototypes[0] - expected).max() < 1e-6


def plain_limits(rows, model, lost):
    """Limits with one cut at a time and all values of a language in one list."""
    predictor, found = language.Predictor(model), {}
    for lang, text in rows:
        letters = sorted({c for c in (text or "")[:1280].lower() if c.isalpha()})
        if lang not in model.languages or len(letters) < 2:
            continue
        rng = np.random.default_rng(len(text))
        for length in (n for n in language.LENGTHS if n <= len(text)):
            places = rng.integers(0, len(letters) * 6 // 5 + 1, length)
            clean = predictor(text[:length])[1]
            trigrams = predictor.encoder.trigrams
            random = predictor("".join(letters[i] if i < len(letters) else " " for i in places))[1]
            if trigrams:
                found.setdefault(length, {}).setdefault(lang, []).append((trigrams, clean, random))
    by_length = []
    for languages in found.values():
        at = [np.percentile(np.array(v), 100 * q, axis=0)[i] for v in languages.values() for i, q in ((0, 0.5), (1, lost), (2, 1 - lost))]
        by_length.append((np.mean(at[::3]), min(min(at[1::3]), max(at[2::3]))))
    return np.array(sorted(by_length)).T


def test_limits_are_measured_on_every_held_out_row(spark):
    rng = np.random.default_rng(10)
    letters = {"aa": "abcdefghijkl", "bb": "mnopqrstuvwx"}
    rows = [(i, "".join(rng.choice(list(letters[x] + " "), int(rng.integers(1, 60)))), x, "a") for i in range(600) for x in ("aa", "bb")]
    rows += [(700, None, "aa", "a"), (701, "12 34 56", "bb", "a"), (None, "abc def", "aa", "a"), (702, "abcdefgh", None, "a"), (703, "abcdefgh", "cc", "a")]
    rows += [(704, "abc def ghi jkl", "aa", "a")] * 40
    model = language.fit(frame(spark, [r for r in rows if r[2] != "cc"]), language.Settings(size=128))
    for lost in (0.02, 0.31):
        found = language.limits(frame(spark, rows), model, F.lit(True), lost=lost)
        trigrams, cosines = plain_limits([(r[2], r[1]) for r in rows], model, lost)
        assert np.allclose(found.trigrams, np.log(trigrams)) and np.allclose(found.cosines, cosines, atol=1e-6)
    assert language.limits(frame(spark, rows[:0]), model, F.lit(True)) is None


def test_percentiles_equal_those_of_one_sorted_list(spark):
    rng = np.random.default_rng(12)
    values = [*rng.random(40).tolist(), *([0.25] * 30), *(0.5 + rng.random(30) * 2e-6).tolist(), 0.0, 1.0]
    rows = [("a", v, int(v * 9)) for v in values] + [("b", 0.75, 3)] + [(None, 0.1, 1), (None, 0.2, 4)]
    for share in (0.0, 0.02, 0.33, 0.5, 0.6, 0.98, 1.0):
        found = language.percentiles(spark.createDataFrame(rows, "g string, x double, n long"), ["g"], {"x": share, "n": 1 - share}).collect()
        assert {r.g for r in found} == {"a", "b"}
        for r in found:
            mine = [v[1:] for v in rows if v[0] == r.g]
            assert np.allclose((r.x, r.n), (np.percentile([m[0] for m in mine], 100 * share), np.percentile([m[1] for m in mine], 100 - 100 * share)), atol=1e-12)


def test_more_languages_than_a_task_may_hold(spark):
    rng = np.random.default_rng(6)
    words = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 12)) for _ in range(41)]
    rows = [(i, f"{w} {w[::-1]}", f"l{i:02}", "a") for i, w in enumerate(words)] + [(100, None, "l00", "a"), (101, "123", "l01", "a"), (None, words[0], None, "a")]
    data = frame(spark, rows)
    whole = language.fit(data, language.Settings(size=256))
    many = language.fit(data, language.Settings(size=256, languages=10))
    assert many.stored is not None and many.blocks > 4 and many.languages == []
    found = [sorted((r.doc_id or -1, r.lang_pred, round(r.score, 5)) for r in language.predict(data, m).collect()) for m in (whole, many)]
    assert found[0] == found[1] and ("l40" in {r[1] for r in found[1]}) and (100, "und", 0.0) in found[1]
    measured = [language.limits(data, m, F.lit(True)) for m in (whole, many)]
    assert np.allclose(measured[0].cosines, measured[1].cosines, atol=1e-5) and (measured[0].trigrams == measured[1].trigrams).all()
    kept = [sorted((r.doc_id or -1) for r in language.keep_known(data, m, limits=measured[0]).collect()) for m in (whole, many)]
    assert kept[0] == kept[1] and language.keep_known(data, many).columns == data.columns


# ------------------------------------------------------------------ language model


SMALL = language_model.Settings(head=50, classes=8, rows=256, window=5)


def test_base_score_and_counts_equal_brute_force(spark, documents):
    rows = {r.doc_id: r for r in language_model.score(documents, language_model.training_rows(), SMALL).collect()}
    texts = {r.doc_id: r.text.encode().lower().split() for r in documents.collect()}
    counts = Counter()
    for i, words in texts.items():
        if zlib.crc32(str(i).encode()) % 5 != 1:
            counts.update([*words, None])
    total, distinct = sum(counts.values()), len(counts)
    for i, words in texts.items():
        tokens = [*words, None]
        base = sum(np.log10((counts.get(w, 0) + 0.5) / (total + 0.5 * (distinct + 1))) for w in tokens)
        assert rows[i].base_score == pytest.approx(base, rel=1e-9)
        assert (rows[i].n_tokens, rows[i].n_known) == (len(tokens), sum(w in counts for w in tokens))
        assert rows[i].train_tokens == total
    assert sum(r.score for r in rows.values()) > sum(r.base_score for r in rows.values())


def plain_tokens(words, v):
    """(context ids, class, word or None, most frequent class before) of each token, one at a time."""
    s = v.settings

    def class_of(word):
        stem = word.rstrip(language_model.MARKS) or word
        return int(v.ending_class[stem[-1] * 256 + (stem[-2] if len(stem) > 1 else 0)])

    classes = [class_of(w) for w in words]
    ids = [v.head.get(w, len(v.head) + c) for w, c in zip(words, classes)]
    start = len(v.head) + s.classes
    for i, word in enumerate([*words, None]):
        last = Counter(classes[max(0, i - s.window) : i])
        skip = min(last, key=lambda c: (-last[c], c)) if last else s.classes
        yield [ids[i - k] if i >= k else start for k in (1, 2)], 0 if word is None else classes[i], word, skip


def plain_rows(before, skip, s):
    one, two = before[0] + 1, before[1] + 1
    cut = (1 << 64) - 1
    factors = [int(f) for f in language_model.FACTORS]
    mixed = [one * factors[0] & cut, (one * factors[1] & cut) ^ (two * factors[2] & cut)]
    return [((m ^ m >> 31) * factors[0] & cut) >> 20 for m in mixed], s.rows + skip


def plain_class_step(w, before, skip, s):
    hashed, last = plain_rows(before, skip, s)
    rows = [h % s.rows for h in hashed] + [last]
    logits = w.bias.astype(float) + sum(w.rows[r].astype(float) for r in rows)
    p = np.exp(logits - logits.max())
    return rows, p / p.sum()


def test_scores_equal_brute_force_over_the_whole_vocabulary(spark):
    rng = np.random.default_rng(8)
    texts = [" ".join(rng.choice(["the", "tha!", "one", "on", "e", "x", "...", "über"], rng.integers(0, 40), p=[0.3, 0.2, 0.2, 0.1, 0.1, 0.04, 0.03, 0.03])) for _ in range(40)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    settings = language_model.Settings(head=4, classes=5, rows=64, window=3, word_prior=1.0)
    learn = F.col("doc_id") < 30
    counts = Counter(w for t in texts[:30] for w in t.encode().split())
    v = language_model.vocabulary(language_model.count_words(rows.where(learn)), settings)
    w = language_model.train(rows.where(learn), v, language_model.drawn("doc_id", "text"))
    assert np.abs(w.words).max() > 0 and np.abs(w.rows).max() > 0
    found = {r.doc_id: r.score for r in language_model.score(rows, learn, settings).collect()}

    def weight(word, skip):
        feature = w.words[v.head[word], skip] if word in v.head else 0.0
        return (counts.get(word, 0) + 0.5) * np.exp(feature)

    for i, text in enumerate(texts):
        total = 0.0
        for before, target, word, skip in plain_tokens(text.encode().split(), v):
            _, p = plain_class_step(w, before, skip, settings)
            total += np.log10(p[target])
            if word is not None:
                members = [x for x in counts if next(plain_tokens([x], v))[1] == target]
                total += np.log10(weight(word, skip) / (sum(weight(x, skip) for x in members) + 0.5))
        assert found[i] == pytest.approx(total, rel=1e-5)


def test_sums_equal_brute_force_and_do_not_depend_on_partitions(spark, documents):
    training = documents.select("doc_id", "text")
    v = language_model.vocabulary(language_model.count_words(training), SMALL)
    w = language_model.train(training, v, F.lit(0.1))
    texts = [r.text.encode().lower().split() for r in training.limit(20).collect()]
    sums = language_model.sums_over(training.limit(20), v, w)
    observed, expected = np.zeros(w.rows.shape), np.zeros(w.rows.shape)
    words, skips = np.zeros(w.words.shape), np.zeros(w.mass.shape)
    for text in texts:
        for before, target, word, skip in plain_tokens(text, v):
            rows, p = plain_class_step(w, before, skip, SMALL)
            for r in rows:
                observed[r, target] += 1
                expected[r] += p
            skips[target, skip] += 1
            if word in v.head:
                words[v.head[word], skip] += 1
    assert (sums.observed.reshape(observed.shape) == observed).all() and np.allclose(sums.expected, expected, rtol=1e-4, atol=1e-3)
    assert (sums.words.reshape(words.shape) == words).all() and (sums.skips.reshape(skips.shape) == skips).all()
    one, many = (
        {r.doc_id: r.score for r in language_model.score(documents.repartition(n, "doc_id"), language_model.training_rows(), SMALL).collect()} for n in (1, 32)
    )
    assert all(one[i] == pytest.approx(many[i], rel=1e-6) for i in one)


def test_long_texts_carry_their_context_over_pieces(spark, monkeypatch):
    words = [f"w{i % 7}{i % 3}" for i in range(400)]
    v = language_model.vocabulary(language_model.count_words(spark.createDataFrame([(" ".join(words),)], "text string")), SMALL)

    def all_of(reader):
        runs = list(reader.runs([" ".join(words), None, "w1"]))
        return [np.concatenate([getattr(t, name) for t in runs]) for name in ("before", "classes", "places", "skip", "texts")]

    whole = all_of(language_model.Reader(v))
    cut = lambda text, size: iter([words[i : i + 3] for i in range(0, 400, 3)] if text and len(text) > 5 else [(text or "").encode().split()])
    monkeypatch.setattr(language_model, "word_pieces", cut)
    monkeypatch.setattr(language_model, "TOKENS_AT_ONCE", 10)
    words = [w.encode() for w in words]
    reader = language_model.Reader(v)
    pieces = list(reader.runs([b" ".join(words).decode(), None, "w1"]))
    joined = [np.concatenate([getattr(t, name) for t in pieces]) for name in ("before", "classes", "places", "skip", "texts")]
    assert len(pieces) > 20 and all((a == b).all() for a, b in zip(whole, joined))


def test_endings_of_words():
    words = [b"word", b"a", b"ends...", b"...", b".", b"x!", "é".encode(), b"b,"]

    def plain(word):
        stem = word.rstrip(language_model.MARKS) or word
        return stem[-1] * 256 + (stem[-2] if len(stem) > 1 else 0)

    assert language_model.endings(words).tolist() == [plain(w) for w in words] and len(language_model.endings([])) == 0


def test_language_model_of_awkward_rows(spark):
    rows = awkward(spark)
    found = language_model.score(rows, language_model.training_rows()).collect()
    assert len(found) == 7 and all(np.isfinite(r.score) for r in found)
    assert {r.n_tokens for r in found if r.doc_id in (2, 3)} == {1}
    assert {r.n_tokens for r in found if r.doc_id == 5} == {300_001}
    untaught = language_model.score(rows.where("doc_id <> 5"), F.lit(False)).collect()
    assert {(r.n_known, r.train_tokens) for r in untaught} == {(0, 0)}
    assert language_model.score(rows.limit(0), language_model.training_rows()).count() == 0


# ------------------------------------------------------------------ decontamination and mixing


def plain_alignment(passage, item):
    table = np.zeros((len(item) + 1, len(passage) + 1), int)
    for i, a in enumerate(item, 1):
        for j, b in enumerate(passage, 1):
            table[i, j] = max(0, table[i - 1, j - 1] + (1 if a == b else -1), table[i - 1, j] - 1, table[i, j - 1] - 1)
    return table.max() / len(item)


def test_alignment_equals_the_full_table():
    rng = np.random.default_rng(2)
    for _ in range(60):
        item = [b"%d" % x for x in rng.integers(0, 6, rng.integers(1, 12))]
        passage = [b"%d" % x for x in rng.integers(0, 6, rng.integers(1, 40))]
        score, first, end = dc.align(passage, item)
        assert score == plain_alignment(passage, item)
        assert score == 0 or plain_alignment(passage[first:end], item) == score


def test_exact_and_edited_copies_are_found_and_others_are_not(spark, documents):
    benchmark = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    items = {r.item_id: dc.words_of(r.text) for r in benchmark.collect()}
    texts = {r.doc_id: dc.words_of(r.text) for r in documents.collect()}
    joined = {i: b" %s " % b" ".join(w) for i, w in texts.items()}
    exact = {(i, k) for i, t in joined.items() for k, w in items.items() if b" %s " % b" ".join(w) in t}
    item = [w.decode() for w in items[0]]
    edited = [w if n % 7 else w + "x" for n, w in enumerate(item)]
    cut = item[: len(item) // 4]
    extra = frame(spark, [
        (-1, "Some words before: " + ", ".join(edited).upper() + " and after", "en", "a"), (-2, " ".join(cut), "en", "a"),
        (-3, None, "en", "a"), (-4, "", "en", "a"), (None, LONG + " " + " ".join(item), "en", "a"),
    ])
    both = documents.unionByName(extra.select(*documents.columns))
    odd = spark.createDataFrame([(900, "of"), (901, None), (None, "one two three four"), (902, "")], "item_id long, text string")
    found = dc.contaminated(both, benchmark.unionByName(odd)).collect()
    assert {(r.doc_id, r.item_id) for r in found} == exact | {(-1, 0), (None, 0)}
    assert all(r.score == plain_alignment(texts[r.doc_id][r.first_word : r.end_word], items[r.item_id]) for r in found if r.doc_id in texts)
    place = next(r for r in found if r.doc_id is None)
    assert (place.first_word, place.end_word) == (300_000, 300_000 + len(item))
    kept = dc.remove(both, benchmark)
    assert kept.count() == both.count() - len({i for i, _ in exact}) - 2
    in_blocks = dc.contaminated(both, benchmark, dc.Settings(block_bytes=2000)).collect()
    assert {(r.doc_id, r.item_id) for r in in_blocks} == exact | {(-1, 0), (None, 0)}
    assert dc.contaminated(both, benchmark.limit(0)).count() == 0


def test_exponent_meets_entropy_and_repetition(spark):
    sources = spark.createDataFrame([("a", 9000, 9), ("b", 900, 9), ("c", 100, 9), ("d", 0, 1)], "source string, tokens long, rows long")
    shares = np.array([9000, 900, 100])

    def mix_at(x):
        p = shares**x / (shares**x).sum()
        return p, -(p * np.log(p)).sum() / np.log(3)

    wanted = mixing.exponent(sources, mixing.Settings(entropy=0.8, repetitions=None))
    assert mix_at(wanted)[1] == pytest.approx(0.8, abs=1e-6)
    limited = mixing.exponent(sources, mixing.Settings(entropy=0.99, repetitions=3.0))
    assert mix_at(limited)[0][2] * 10000 / 100 == pytest.approx(3, abs=1e-5)
    assert mixing.exponent(sources, mixing.Settings(entropy=None, repetitions=0.5)) == 1.0


def test_mix_reads_whole_passes_and_the_rest_of_each_budget(spark):
    rows = [(i, "w " * (1 + i % 5), "en", "big" if i % 10 else "small") for i in range(400)]
    settings = mixing.Settings(entropy=1.0, repetitions=8.0, block_rows=16)
    found = mixing.mix(frame(spark, rows), settings).collect()
    tokens = {i: 1 + i % 5 for i in range(400)}
    plan = {r.source: r for r in mixing.weights(
        spark.createDataFrame([(s, sum(tokens[i] for i, _, _, t in rows if t == s), 1) for s in ("big", "small")], "source string, tokens long, rows long"), settings
    ).collect()}
    for source, planned in plan.items():
        mine = [r for r in found if r.source == source]
        by_pass = {n: [r for r in mine if r["pass"] == n] for n in {r["pass"] for r in mine}}
        size = sum(tokens[i] for i, _, _, s in rows if s == source)
        whole = planned.budget // size
        assert all(sum(r.tokens for r in by_pass[n]) == size for n in range(whole))
        assert 0 <= sum(r.tokens for r in mine) - planned.budget < 5
        assert len({(r.doc_id, r["pass"]) for r in mine}) == len(mine)
        begins = sorted(round(r.place * planned.budget) for r in mine)
        ends = sorted(round(r.place * planned.budget) + r.tokens for r in mine)
        assert begins[0] == 0 and begins[1:] == ends[:-1]


def test_mix_of_awkward_rows(spark):
    found = mixing.mix(awkward(spark), mixing.Settings(entropy=None, repetitions=None)).collect()
    assert Counter(r.doc_id for r in found)[1] == 2
    assert {r.doc_id for r in found} == {1, None, 5, 6}
    assert mixing.mix(awkward(spark).limit(0)).count() == 0


# ------------------------------------------------------------------ near-duplicate stage of the pipeline


def test_pipeline_removes_near_duplicates_by_fingerprint(spark):
    import corpus_pipeline

    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(words), " ".join(words).upper(), " ".join("x" if i == 200 else w for i, w in enumerate(words)), " ".join(rng.permutation(words)), "", None]
    prints = [simhash.fingerprint(t) for t in texts]
    near = lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 4
    rows = frame(spark, [(i, t, "en", "a") for i, t in enumerate(texts)])
    kept = corpus_pipeline.keep_one_of_each_group(spark, rows, FOLDER)
    assert kept.columns == rows.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(reachable(range(len(texts)), near).values()))


CLASHING = (
    "key", "key_", "_doc", "_key", "_copies", "_d", "_k", "root", "first", "copies", "doc", "text_key", "fp", "component_id", "item_id", "item", "passage", "pid",
    "seed", "seeds", "items", "score", "row", "label", "predicted", "u", "v", "n", "position", "best", "tokens", "place", "number", "found", "none", "id", "shard",
)


def clashing(spark, rows):
    data = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int")
    return data.select("*", *[F.lit("clash").alias(c) for c in CLASHING])


def test_stages_with_any_other_columns(spark):
    import corpus_pipeline

    folder = "/root/testdata/sf0.001"
    given = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").limit(80).collect()]
    docs = clashing(spark, [*given, given[0], (None, "words without an id " * 30, "en", "s", 1), (5000, "", "en", "s", 0), (5001, None, None, None, None)])
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == columns, name
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        assert docs.count() > 40, name
    assert corpus_pipeline.mix_sources(spark, docs, folder).count() >= docs.count()


def test_stages_without_documents(spark):
    import corpus_pipeline

    docs = clashing(spark, []).limit(0)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, docs, FOLDER)
        assert found.columns == docs.columns and found.count() == 0, name
    assert corpus_pipeline.mix_sources(spark, docs, FOLDER).count() == 0


# ------------------------------------------------------------------ edited copies beside exact ones


@pytest.mark.parametrize("every", [4, 5, 6])
def test_edited_copies_are_found_beside_exact_ones(spark, every):
    benchmark = spark.read.parquet(f"{FOLDER}/benchmark.parquet").limit(40)
    items = {r.item_id: dc.words_of(r.text) for r in benchmark.collect()}
    rows, wanted = [], set()
    for i, words in items.items():
        plain = [w.decode() for w in words]
        replaced = [f"q{n}" if n % every == every - 1 else w for n, w in enumerate(plain)]
        added = [x for n, w in enumerate(plain) for x in ((w, f"q{n}") if n % every == every - 1 else (w,))]
        for k, text in enumerate([plain, replaced, added, [w for n, w in enumerate(plain) if n % every]]):
            rows.append((4 * i + k, f"zz before {' '.join(text)} after zz", "en", "a"))
            if plain_alignment([w.encode() for w in text], words) >= 0.5:
                wanted.add((4 * i + k, i))
    found = {(r.doc_id, r.item_id) for r in dc.contaminated(frame(spark, rows), benchmark).collect()}
    assert wanted <= found and len(wanted) >= 3 * len(items)


def test_any_passage_of_the_least_score_has_the_hits_it_needs():
    rng = np.random.default_rng(7)
    reached = 0
    for _ in range(3000):
        item = [b"%d" % x for x in rng.integers(0, 40, rng.integers(3, 24))]
        passage = []
        for w in item:
            kind = rng.integers(0, 8)
            passage += [[w], [w], [w], [w], [w], [b"x"], [], [w, b"y"]][kind]
        passage = [b"a"] * 5 + passage + [b"b"] * 5
        if plain_alignment(passage, item) >= 0.5:
            reached += 1
            grams = dc.Grams([b" ".join(item).decode()], 2)
            hits, places = grams.find(passage)
            at, items = grams.anchors(hits, places)
            assert len(at) and set(items.tolist()) == {0}
            # One of the seeds is there whichever n-grams are rare.
            seeds, _ = grams.seeds(rng.integers(0, 9, len(grams.keys)))
            assert np.isin(grams.keys[places], seeds).any()
    assert reached > 1000


def test_words_of_any_script():
    assert dc.words_of("Hello, it's_me-2!") == [b"hello", b"it", b"s", b"me", b"2"]
    assert dc.words_of("“Hello”—‘x’ a\u00a0b") == dc.words_of('"Hello" - x a b')
    assert dc.words_of("中文a1 カタ") == ["中".encode(), "文".encode(), b"a1", "カ".encode(), "タ".encode()]
    assert dc.words_of("Größe Øl") == ["größe".encode(), "øl".encode()] and dc.words_of(None) == []
    text = "中文字" * 40 + " latin words " * 5
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(dc, "PIECE_CHARS", 7)
        assert [w for p in dc._pieces(text) for w in p] == dc.words_of(text)


def test_long_and_short_items_other_scripts_and_quotes(spark):
    rng = np.random.default_rng(9)
    long_item = " ".join(f"l{x}" for x in rng.integers(0, 900, 5000))
    chinese = "".join(chr(x) for x in rng.integers(0x4E00, 0x9FA5, 30))
    quoted = 'He said: "never mind the weather" and left it at that'
    short = "eight small words make one very short item"
    benchmark = spark.createDataFrame([(1, long_item), (2, chinese), (3, quoted), (4, short)], "item_id long, text string")
    filler = " ".join(f"f{i}" for i in range(400))
    edited = "".join(c if i % 6 else "x" for i, c in enumerate(chinese))
    rows = frame(spark, [
        (10, f"{filler} {long_item} {filler}", "en", "a"), (11, f"{filler} {short} {filler}", "en", "a"), (12, f"前{chinese}后", "zh", "a"),
        (13, f"前{edited}后", "zh", "a"), (14, "x “He said”: ‘never mind the weather’ — and left it at that…", "en", "a"), (15, filler, "en", "a"), (16, "中文" * 50, "zh", "a"),
    ])
    found = {(r.doc_id, r.item_id): (r.score, r.first_word, r.end_word) for r in dc.contaminated(rows, benchmark).collect()}
    assert set(found) == {(10, 1), (11, 4), (12, 2), (13, 2), (14, 3)}
    assert found[10, 1] == (1.0, 400, 5400) and found[11, 4] == (1.0, 400, 408) and found[14, 3][0] == 1.0 and found[13, 2][0] < 1
    # A short item's passage is cut by its own length, not by the longest item's.
    grams = dc.Grams([long_item, short], 2)
    hits, places = grams.find(dc.words_of(f"{filler} {short} {filler}"))
    at, items = grams.anchors(hits, places)
    low, high = next(dc._stretches(at, grams.spans[items], 2))
    assert high - low < 50
    assert dc.contaminated(rows.limit(0), benchmark).count() == 0 and dc.remove(rows.limit(0), benchmark).count() == 0
    assert dc.remove(rows, benchmark.limit(0)).count() == 7


def test_seeds_are_the_rarest_places_of_an_item():
    grams = dc.Grams(["a b c d e f g h i j"], 2)
    often = np.arange(len(grams.keys))
    seeds, owners = grams.seeds(often)
    assert set(seeds.tolist()) == set(grams.keys[:6].tolist()) and grams.needed[0] == 4 and set(owners.tolist()) == {0}


# ------------------------------------------------------------------ limits of the language stage


def test_language_stage_rejects_gibberish_and_unlearned_scripts(spark):
    import corpus_pipeline

    folder = "/root/testdata/sf0.01"
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    rng = np.random.default_rng(4)
    scripts = {"latin": "abcdefghijklmnopqrstuvwxyz", "cyrillic": "".join(map(chr, range(0x430, 0x450))), "cjk": "".join(map(chr, range(0x4E00, 0x9FA5)))}
    foreign = [
        ("".join(rng.choice([*letters, *" " * (len(letters) // 6)], int(n)))) for letters in scripts.values() for n in rng.integers(60, 900, 80)
    ]
    whole = [r.text for r in documents.where("lang = 'en' AND length(text) > 400").limit(60).collect()]
    clean = [*whole, *(t[:60] for t in whole)]
    rows = spark.createDataFrame([(-1 - i, t, None, "s", 0) for i, t in enumerate([*foreign, *clean])], documents.schema)
    kept = corpus_pipeline.keep_known_languages(spark, documents.unionByName(rows), folder)
    ids = {r.doc_id for r in kept.select("doc_id").collect()}
    lost = sum(-1 - i not in ids for i in range(len(foreign)))
    assert lost >= 0.95 * len(foreign)
    assert sum(-1 - len(foreign) - i in ids for i in range(len(clean))) >= 0.95 * len(clean)
    given = documents.where("text IS NOT NULL AND length(text) > 0")
    assert len([i for i in ids if i >= 0]) >= 0.97 * given.count()


# ------------------------------------------------------------------ training rows of the language model


@pytest.mark.parametrize("place", [0.25, 0.55, 0.999999])
def test_every_training_text_updates_the_weights(spark, place):
    rows = frame(spark, [(1, "a b a b a c a b", "en", "a"), (2, "b a b a b a", "en", "a")]).select("doc_id", "text")
    v = language_model.vocabulary(language_model.count_words(rows))
    trained = language_model.train(rows, v, F.lit(place))
    assert (trained.rows != language_model.Weights.initial(v).rows).any()
