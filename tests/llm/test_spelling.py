"""Spelling variants against brute force over all pairs of words that share a wildcard."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from merchlens.llm import spelling

FOLDER = "/root/testdata/sf0.001"
RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def brute_counts(rows):
    counts = Counter()
    for doc, text in rows:
        for run in RUN.findall(text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    a, b = sorted((a, b), key=len)
    at = next((i for i, c in enumerate(a) if c != b[i]), len(a))
    return a[at + 1 :] == b[at + 1 :] if len(a) == len(b) else a[at:] == b[at + 1 :]


def brute_groups(counts):
    by_wildcard = {}
    for w in counts:
        for i in range(len(w)):
            by_wildcard.setdefault(w[:i] + "*" + w[i + 1 :], set()).add(w)
            by_wildcard.setdefault(w[:i] + w[i + 1 :], set()).add(w)
        by_wildcard.setdefault(w, set()).add(w)
    near = {w: set() for w in counts}
    for words in by_wildcard.values():
        for a in words:
            near[a].update(b for b in words if one_edit(a, b))
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-counts[o], o), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * counts[w] else None
    rows = set()
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        rows.add((w, form[w], root, n, len(near[w]), counts.get(form[w])))
    return rows


def found(words, settings=spelling.Settings()):
    rows = [tuple(r) for r in spelling.group_variants(words, settings).select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("trie_length", [64, 7, 1])
def test_the_documents_like_brute_force(spark, trie_length):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    settings = spelling.Settings(trie_length=trie_length)
    counts = brute_counts([tuple(r) for r in documents.collect()])
    words = spelling.count_words(documents, settings)
    assert {r.word: r.n for r in words.collect()} == counts
    assert found(words, settings) == brute_groups(counts)


def test_few_letters_make_many_neighbours_ties_and_chains(spark):
    rng = np.random.default_rng(5)
    drawn = ["".join(rng.choice(list("abÿ"), rng.integers(5, 9))) for _ in range(900)]
    counts = {w: int(rng.integers(3, 60)) for w in drawn}
    # A path of forms, each twice as frequent, ends in one root.
    counts |= {"zzzzz" + "z" * i: 3 * 2**i for i in range(12)}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    expected = brute_groups(counts)
    assert found(words) == expected
    assert found(words, spelling.Settings(trie_length=6)) == expected
    assert {r[2] for r in expected if r[0].startswith("zzzzz")} == {"z" * 16}


def test_long_words_at_the_border_of_the_trie(spark):
    base = "abcdefgh" * 8
    words = [base, base[:-1], base + "x", base + "xy", "q" + base[1:], base[:30] + base[31:], base + "y", base * 500, base * 500 + "z", base * 499]
    words += [(base * 500)[:9000] + "ü" + (base * 500)[9001:], base[:40] + "ÿ" + base[41:]]
    counts = {w: 3 + i for i, w in enumerate(words)}
    expected = {(w, sum(one_edit(w, o) for o in words)) for w in words}
    rows = found(spark.createDataFrame(list(counts.items()), "word string, n long"))
    assert {(r[0], r[4]) for r in rows} == expected


def test_awkward_documents(spark):
    rows = [
        (1, "Hällo hÄllo HÄLLO HäLLO", 1, "x"), (1, "Hällo hÄllo HÄLLO HäLLO", 1, "x"), (2, "", 1, "x"), (3, None, 1, "x"),
        (None, "größe größe größe grösse grösse grösse", 1, "x"), (4, "a×b÷cde " * 4, 1, "x"), (5, "wordy" * 30_000, 1, "x"), (6, "12 .. ab", 1, "x"),
        (7, "lengthy words here " * 90_000, 1, "x"),
    ]
    documents = spark.createDataFrame(rows, "doc_id long, text string, n long, word string")
    counts = brute_counts([r[:2] for r in rows])
    words = spelling.count_words(documents)
    assert {r.word: r.n for r in words.collect()} == counts and "größe" in counts
    assert found(words) == brute_groups(counts)
    # Without alterations every run counts as it is.
    plain = {r.word: r.n for r in spelling.count_words(documents, spelling.Settings(altered=None)).collect()}
    assert plain["lengthy"] == 90_000 and plain["größe"] == 3


def test_pieces_cut_no_run():
    text = "abc déf " * 50 + "x" * 300 + " end"
    pieces = list(spelling._pieces(text, 37))
    assert "".join(pieces) == text and len(pieces) > 5
    assert [r for p in pieces for r in RUN.findall(p)] == RUN.findall(text)


def test_no_words(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert found(spelling.count_words(empty)) == set()


def test_keys_of_deletions():
    word = "abcabcÿÿx"
    key, keys = spelling.deletion_keys(word)
    for i in range(len(word)):
        assert spelling.deletion_keys(word[:i] + word[i + 1 :])[0] == int(keys[i])
    assert key not in keys.tolist() and len(set(keys.tolist())) == 8
