"""Token alignment against the owners of every single byte."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

from merchlens.llm import token_alignment as ta

FOLDER = "/root/testdata/sf0.001"
PLAIN = Tokenizer.from_file(ta.Settings().bytes_file)
PLAIN.encode_special_tokens = True
COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.fixture(scope="module")
def both():
    return ta.Tokenizers(ta.Settings())


def owners(numbers, spelled):
    return np.repeat(np.arange(len(numbers)), [len(spelled[n]) for n in numbers])


def brute_force(both, documents):
    """Each document's row, links from the pairs of tokens that own a byte."""
    read = []
    for doc, text in documents:
        a = PLAIN.encode(" " + text, add_special_tokens=False).ids if text else []
        b = both.b.encode(text) if text else []
        data = (" " + text).encode() if text else b""
        if b"".join(both.bytes_a[i] for i in a) != data or b"".join(both.bytes_b[i] for i in b) != data:
            a, b = [], []
        links = sorted(set(zip(owners(a, both.bytes_a).tolist(), owners(b, both.bytes_b).tolist())))
        read.append((doc, a, b, links))
    counts = Counter((a[i], b[j]) for _, a, b, links in read for i, j in links)
    highest = {}
    for (_, second), n in counts.items():
        highest[second] = max(n, highest.get(second, 0))
    rows = []
    for doc, a, b, links in read:
        ends = [np.cumsum([len(s[i]) for i in x]).tolist() for x, s in ((a, both.bytes_a), (b, both.bytes_b))]
        groups, i, j = [], 0, 0
        for end in sorted(set(ends[0]) & set(ends[1])):
            k, m = ends[0].index(end) + 1, ends[1].index(end) + 1
            groups.append(",".join(map(str, a[i:k])) + "|" + ",".join(map(str, b[j:m])))
            i, j = k, m
        times = [counts[a[x], b[y]] for x, y in links]
        best = sum(n == highest[b[y]] for n, (_, y) in zip(times, links))
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""
        rows.append((doc, len(a), len(b), len(groups), len(links), best, sum(times), digest))
    return Counter(rows)


def found(documents, settings=ta.Settings()):
    return Counter(tuple(r[c] for c in COLUMNS) for r in ta.align_tokenizers(documents, settings).collect())


@pytest.mark.parametrize("head", [1 << 18, 100, 0])
def test_the_documents_like_brute_force(spark, both, head):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").limit(60)
    rows = [tuple(r) for r in documents.collect()]
    assert found(spark.createDataFrame(rows, "doc_id long, text string"), ta.Settings(head=head, at_once=5000)) == brute_force(both, rows)


def test_awkward_texts(spark, both):
    texts = [
        None, "", " ", "  two  spaces ", "a", "Ünïcödé ﬁ ½ İ", "日本語のテキスト", "😀👩‍👩‍👧", "tab\tand\nline\r\n", "▁ ▁", "<|endoftext|> </s><s><unk>", "<0x41>",
        "  　", "é", "x" * 70_000, "word " * 30_000, "  leading", "nul\0byte", "Hello world", "Hello world",
    ]
    rows = [(i if i % 3 else None, t) for i, t in enumerate(texts)]
    expected = brute_force(both, rows)
    schema = "doc_id long, text string, row long, pair long, n long, a binary, b string"
    data = spark.createDataFrame([(*r, 1, 2, 3, b"x", "y") for r in rows], schema)
    assert found(data) == expected
    zeros = {r[0] for r in expected if r[1] == 0}
    # Tokens spell most of these texts; those without tokens are empty or changed by a tokenizer.
    assert 1 in zeros and 4 not in zeros and 10 not in zeros


def test_no_documents(spark):
    assert not found(spark.createDataFrame([], "doc_id long, text string"))


def test_galloping_from_any_guess():
    rng = np.random.default_rng(1)
    for size in (1, 2, 3, 50, 4000):
        longer = np.cumsum(rng.integers(1, 5, size))
        values = np.sort(rng.integers(0, longer[-1] + 4, 300))
        for guess in (np.zeros(300, np.int64), np.full(300, size - 1), rng.integers(-3, size + 3, 300), np.arange(300) * size // 300):
            assert (ta.gallop(values, longer, guess) == np.searchsorted(longer, values)).all()
    assert len(ta.gallop(np.zeros(0, np.int64), longer, np.zeros(0, np.int64))) == 0


def test_lists_of_either_length_and_texts_without_tokens():
    lengths = np.array([1, 2, 3, 7])
    a = [np.array(x, "<u4") for x in ([0, 1, 3], [], [3, 3], [1])]
    b = [np.array(x, "<u4") for x in ([3, 1, 0], [], [0, 0, 0, 0, 1, 0, 0, 2, 2], [1])]
    f = ta.align(a, b, lengths, lengths)
    links = set(zip(f.link_a.tolist(), f.link_b.tolist()))
    expected, base_a, base_b = set(), 0, 0
    for x, y in zip(a, b):
        one, two = np.repeat(np.arange(len(x)), lengths[x]), np.repeat(np.arange(len(y)), lengths[y])
        expected |= {(base_a + i, base_b + j) for i, j in zip(one.tolist(), two.tolist())}
        base_a, base_b = base_a + len(x), base_b + len(y)
    assert links == expected and len(f.link_a) == len(links)
    assert f.closes_a.tolist() == [False, False, True, True, True, True]
    assert np.flatnonzero(f.closes_b).tolist() == [2, 8, 11, 12]


def test_small_pieces_flush_and_merge_counts(spark, both, monkeypatch):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").limit(25).collect()]
    monkeypatch.setattr(ta, "PAIRS_AT_ONCE", 500)
    assert found(spark.createDataFrame(rows, "doc_id long, text string"), ta.Settings(at_once=2000)) == brute_force(both, rows)


def test_tokens_by_rank_are_those_of_the_file_for_every_character(both):
    assert both.by_rank
    texts = [f" a{chr(c)}b {chr(c)}1{chr(c)}{chr(c)} .{chr(c)}  {chr(c)} " for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for begin in range(0, len(texts), 20_000):
        part = texts[begin : begin + 20_000]
        for ours, theirs in zip(both._first(part), PLAIN.encode_batch_fast(part, add_special_tokens=False)):
            assert ours.tolist() == theirs.ids


def test_other_files_are_read_by_their_library(tmp_path):
    import json

    file = json.loads(open(ta.Settings().bytes_file, encoding="utf-8").read())
    file["pre_tokenizer"]["add_prefix_space"] = True
    (tmp_path / "t.json").write_text(json.dumps(file))
    other = ta.Tokenizers(ta.Settings(bytes_file=str(tmp_path / "t.json")))
    assert not other.by_rank
    assert other._first(["word again"])[0].tolist() == PLAIN.encode(" word again", add_special_tokens=False).ids


def test_groups_are_returned_with_their_tokens(spark, both):
    rows = [(1, "Some wörds align"), (2, None), (3, "")]
    found = {r.doc_id: r for r in ta.groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    one = found[1]
    assert (sum(g.a for g in one.groups), sum(g.b for g in one.groups)) == (len(one.a), len(one.b))
    i = j = 0
    for g in one.groups:
        assert b"".join(both.bytes_a[x] for x in one.a[i : i + g.a]) == b"".join(both.bytes_b[x] for x in one.b[j : j + g.b])
        i, j = i + g.a, j + g.b
    assert all(found[d].a == found[d].b == found[d].groups == [] for d in (2, 3))
