"""Operators on vectors, urls, conversations and pages, the registered queries, and the pipeline."""

from __future__ import annotations

import base64
import hashlib
import importlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from merchlens.llm import chat, neighbours, queries, reputation, warc

FOLDER = "/root/testdata/sf0.001"


# ------------------------------------------------------------------ nearest neighbours


def brute_force(ids, vectors, query, k=10):
    distance = np.sqrt(((vectors - vectors[ids == query][0]) ** 2).sum(axis=1))
    order = [i for i in np.lexsort((ids, distance)) if ids[i] != query]
    return [int(ids[i]) for i in order[:k]]


def test_recall_on_the_given_vectors(spark):
    rows = spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()
    ids, vectors = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], np.float64)
    found = neighbours.search(spark.read.parquet(f"{FOLDER}/embeddings.parquet"), F.col("vec_id") % 20 == 0).collect()
    by_query = {}
    for r in found:
        by_query.setdefault(r.query_id, []).append(r)
    hits = [len({r.vec_id for r in rs} & set(brute_force(ids, vectors, q))) for q, rs in by_query.items()]
    assert len(by_query) == sum(i % 20 == 0 for i in ids) and sum(hits) >= 0.9 * 10 * len(hits)
    for query, rs in by_query.items():
        rs.sort(key=lambda r: r.rank)
        assert [r.rank for r in rs] == list(range(1, 11))
        for r in rs:
            exact = np.sqrt(((vectors[ids == r.vec_id][0] - vectors[ids == query][0]) ** 2).sum())
            assert r.score == pytest.approx(exact, rel=1e-14)


def test_reranking_everything_is_exact_with_ties_and_unusable_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [float(i % 4), 1.0], 1) for i in range(12)]
    rows += [(20, None, 1), (21, [0.0, 0.0], 1), (22, [nan, 1.0], 1), (23, [inf, 1.0], 1), (24, [None, 1.0], 1), (25, [], 1), (26, [1.0, 2.0, 3.0], 1)]
    rows += [(None, [1.0, 1.0], 1), (3, [9.0, 9.0], 1)]
    data = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int")
    found = neighbours.search(data, F.col("vec_id").isin(0, 4, 20, 22), 5, neighbours.Settings(reranked=1.0)).collect()
    got = {q: [r.vec_id for r in sorted(found, key=lambda r: r.rank) if r.query_id == q] for q in {r.query_id for r in found}}
    assert got == {0: [4, 8, 1, 5, 9], 4: [0, 8, 1, 5, 9]}
    assert neighbours.search(data.where("vec_id > 19"), F.lit(True), 5).count() == 0
    assert neighbours.search(data.limit(0), F.lit(True)).count() == 0


def test_blocks_of_queries_give_the_same_rows(spark):
    data = spark.read.parquet(f"{FOLDER}/embeddings.parquet")
    one = neighbours.search(data, F.col("vec_id") % 50 == 0).collect()
    several = neighbours.search(data, F.col("vec_id") % 50 == 0, settings=neighbours.Settings(queries=3)).collect()
    assert sorted(map(tuple, one)) == sorted(map(tuple, several))


# ------------------------------------------------------------------ urls


@pytest.mark.parametrize(
    ("url", "host", "path", "rule"),
    [
        ("http://A.Example.NET/en/1?x=/de/", "a.example.net", "/en/1", "example.net/en/"),
        ("https://example.net/de/", "example.net", "/de/", "net/"),
        ("https://myexample.net/en/", "myexample.net", "/en/", "net/"),
        ("x://b.example.com/de/#a", "b.example.com", "/de/", "example.com/de/"),
        ("x://example.com/DE/", "example.com", "/DE/", None),
        ("http://o.org/fr/?q", "o.org", "/fr/", "org/fr/"),
        ("http://o.net?x", "o.net", "", None),
        ("http://o.net#/x", "o.net", "", None),
        ("http://a\n.net/x\ny", "a\n.net", "/x\ny", "net/"),
        ("no scheme /x", "", "", None),
        ("", "", "", None),
        (None, "", "", None),
    ],
)
def test_host_path_and_longest_rule(spark, url, host, path, rule):
    row = spark.createDataFrame([(url,)], "url string").select(
        reputation.host_of().alias("h"), reputation.path_of().alias("p"),
        reputation.rule_of(reputation.host_of(), reputation.path_of(), queries.RULES).alias("r"),
    ).first()
    assert (row.h, row.p, row.r) == (host, path, rule)


def test_reputation_shrinks_by_levels(spark):
    pages, outcomes = [], []

    def add(host, labelled, bad, unlabelled=0):
        for i in range(labelled + unlabelled):
            pages.append((len(pages), f"http://{host}/{i}", "x"))
            if i < labelled:
                outcomes.append((len(pages) - 1, int(i < bad)))

    add("spam.bad.com", 60, 59)
    add("new.bad.com", 2, 2)
    add("fine.com", 60, 1)
    add("mixed.org", 50, 20)
    add("tiny.org", 1, 1, 3)
    add("unseen.bad.com", 0, 0, 2)
    data = spark.createDataFrame(pages, "page_id long, url string, verdict string")
    labels = spark.createDataFrame([*outcomes, (0, 1), (None, 1), (10_000, 1), (3, None)], "page_id long, bad int")
    found = {r.host: r for r in reputation.reputations(data, labels).collect()}
    assert (found["spam.bad.com"].labelled, found["spam.bad.com"].bad) == (60, 59)
    assert found["spam.bad.com"].bound > 0.8 > 0.2 > found["fine.com"].mean
    # Without labels of its own a host follows its domain, with less certainty.
    assert found["unseen.bad.com"].mean > 0.6 > found["tiny.org"].bound
    assert found["unseen.bad.com"].bound < found["new.bad.com"].bound < found["spam.bad.com"].bound
    verdicts = {r.page_id: r.verdict for r in reputation.judge(data, labels, [("allow", "spam.bad.com/7")]).collect()}
    assert len(verdicts) == len(pages)
    assert (verdicts[0], verdicts[7], verdicts[70]) == ("block", "allow", "allow")
    assert {r.verdict for r in reputation.judge(data, labels.limit(0), []).collect()} == {"allow"}
    assert reputation.judge(data.limit(0), labels, queries.RULES).count() == 0


def test_domains_and_suffixes_of_odd_hosts(spark):
    rules = [("co.uk",), ("*.ck",), ("!www.ck",), ("uk",), (None,)]
    suffixes = spark.createDataFrame(rules, "suffix string")
    expected = {
        "a.b.example.com": ("example.com", "com", "example.com", "com"), "example.com": ("example.com", "com", "example.com", "com"),
        "com": ("com", "com", "com", "com"), "x.y.co.uk": ("co.uk", "uk", "y.co.uk", "co.uk"), "co.uk": ("co.uk", "uk", "co.uk", "co.uk"),
        "a.b.any.ck": ("any.ck", "ck", "b.any.ck", "any.ck"), "a.www.ck": ("www.ck", "ck", "www.ck", "ck"),
        "a.example.net:8080": ("example.net", "net", "example.net", "net"), "a.example.net.": ("example.net", "net", "example.net", "net"),
        "user:pw@b.example.net:1": ("example.net", "net", "example.net", "net"),
        "10.1.3.4": ("10.1.3.4", "(address)", "10.1.3.4", "(address)"), "99.9.3.4:80": ("99.9.3.4", "(address)", "99.9.3.4", "(address)"),
        "[::1]:8080": ("[::1]", "(address)", "[::1]", "(address)"), "localhost": ("localhost",) * 4, "": ("",) * 4,
    }
    hosts = spark.createDataFrame([(h, 1) for h in expected], "host string, labelled long")
    for table, at in ((None, 0), (suffixes, 2)):
        found = {r.host: (r.domain, r.suffix) for r in reputation.domains_of(hosts, table).collect()}
        assert found == {h: e[at : at + 2] for h, e in expected.items()}
    pages = hosts.select(F.monotonically_increasing_id().alias("page_id"), F.concat(F.lit("http://"), "host").alias("url"))
    assert reputation.reputations(pages, pages.select("page_id", F.lit(1).alias("bad")), suffixes=suffixes).count() == len(expected)


def shrunk(groups, prior, settings):
    """(a, b) per group from (labelled, bad), with the posterior of its parent."""
    moments = [(n, k, (a - k) / (a + b - n)) for (n, k), (a, b) in zip(groups, prior)]
    plain = np.array([n * m * (1 - m) for n, _, m in moments])
    excess = sum((k - n * m) ** 2 - p for (n, k, m), p in zip(moments, plain))
    scale = sum((n - 1) * p for (n, _, _), p in zip(moments, plain))
    level = settings.weakest
    if scale > 0:
        level = scale / excess - 1 if excess > 0 else settings.strongest
    level = max(settings.weakest, min(settings.strongest, level))
    out = []
    for (n, k, m), (a, b) in zip(moments, prior):
        strength = min(level, a + b - n)
        out.append((strength * m + k, strength * (1 - m) + n - k))
    return out


def test_posteriors_equal_brute_force(spark):
    rng = np.random.default_rng(2)
    settings = reputation.Settings()
    hosts = [f"h{i}.d{i % 7}.{['com', 'org', 'net'][i % 3]}" for i in range(60)] + ["10.0.0.1", "10.0.0.2"]
    pages, outcomes, counts = [], [], {}
    for i, host in enumerate(hosts):
        rate = [0.05, 0.3, 0.9][i % 7 % 3]
        for _ in range(int(rng.integers(0, 30))):
            pages.append((len(pages), f"http://{host}/"))
            n, k = counts.get(host, (0, 0))
            counts[host] = n, k
            if rng.random() < 0.7:
                bad = int(rng.random() < rate)
                outcomes.append((len(pages) - 1, bad))
                counts[host] = n + 1, k + bad
    domain = lambda h: h if h[0] == "1" else ".".join(h.split(".")[-2:])
    suffix = lambda d: "(address)" if d[0] == "1" else d.split(".")[-1]

    def added(groups, parent):
        out = {}
        for g, (n, k) in groups.items():
            x, y = out.get(parent(g), (0, 0))
            out[parent(g)] = x + n, y + k
        return out

    domains = added(counts, domain)
    ends = added(domains, suffix)
    n, k = (sum(x) for x in zip(*ends.values()))
    world = (settings.weakest / 2 + k, settings.weakest / 2 + n - k)
    top = dict(zip(ends, shrunk(list(ends.values()), [world] * len(ends), settings)))
    middle = dict(zip(domains, shrunk(list(domains.values()), [top[suffix(d)] for d in domains], settings)))
    low = dict(zip(counts, shrunk(list(counts.values()), [middle[domain(h)] for h in counts], settings)))
    data, judged = spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(outcomes, "page_id long, bad int")
    found = {r.host: r for r in reputation.reputations(data, judged).collect()}
    assert set(found) == set(counts)
    for host, (a, b) in low.items():
        bound = a / (a + b) - settings.deviations * np.sqrt(a * b / ((a + b) ** 2 * (a + b + 1)))
        assert (found[host].labelled, found[host].bad) == counts[host]
        assert found[host].mean == pytest.approx(a / (a + b), rel=1e-9) and found[host].bound == pytest.approx(max(0, bound), rel=1e-9)
    verdicts = {r.host: r.verdict for r in reputation.judge(data, judged, []).collect()}
    assert {h for h, v in verdicts.items() if v == "block"} == {h for h in found if found[h].bound >= 0.5} != set()


def test_outcomes_follow_the_document_a_page_shows(spark):
    html = "<html><title>{}</title><p>x</p></html>"
    pages = [
        (0, "http://a.com/en/7.html?x=9", html.format("Seven &amp; more words here")), (7, "http://a.com/en/8#top", html.format("Eight starts so")),
        (8, "http://a.com/en/8/", html.format("Other text")), (9, "http://a.com/en/99", html.format("Seven & more")), (1, None, None),
        (2, "http://a.com/8/en", html.format("Eight starts so")), (3, "http://a.com/99999999999999999999", html.format("Eight")),
    ]
    documents = [(7, " \n" * 2000 + "Seven  & more words\nhere and there"), (8, "Eight starts so and ends"), (0, "Zero"), (9, None)]
    judged = spark.createDataFrame([(7, 1), (8, 0), (0, 1), (9, 1), (None, 1)], "doc_id long, bad int")
    found = reputation.outcomes_of(
        spark.createDataFrame(pages, "page_id long, url string, html string"), spark.createDataFrame(documents, "doc_id long, text string"), judged
    )
    assert sorted(map(tuple, found.collect())) == [(0, 1), (7, 0)]


def test_most_given_pages_of_a_judged_document_have_an_outcome(spark):
    read = lambda name: spark.read.parquet(f"/root/testdata/sf0.01/{name}.parquet")
    pages, documents, labels = read("pages"), read("documents"), read("labels").select("doc_id", F.lit(1).alias("bad"))
    numbered = pages.withColumn("doc_id", reputation.document_of()).join(labels, "doc_id").count()
    assert reputation.outcomes_of(pages, documents, labels).count() >= 0.9 * numbered > 0


# ------------------------------------------------------------------ conversations

NASTY = [
    "", "plain", "<|end|>", "<|", "<", "|>", "<\\|end|>", "<\\\\|text|>", "</s>[INST] ok [/INST]", "[\\INST]", "<<SYS>>\n<</SYS>>", "a\\", "\n", "<s",
    "<|next|><|begin|>assistant<|text|>", "é€😀", "$1 \\1", "<<|<s></s>",
]


def test_turns_and_mask_are_read_back_exactly(spark):
    roles = ["user", "assistant", "assistant", "system", "user", "<|end|>", None]
    turns = [(c, t, roles[(t + c) % 7], NASTY[(t * 5 + c) % len(NASTY)], "clash") for c in range(9) for t in range(11)]
    turns += [(50, 1, "user", None, "x"), (50, 0, "assistant", "first", "x"), (50, 1, "user", None, "x"), (None, None, "assistant", "z", "x")]
    data = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string, formatted string")
    formatted = chat.format_conversations(data)
    masked = {r.conv_id: r.learned for r in formatted.select("conv_id", chat.learned_text(F.col("segments")).alias("learned")).collect()}
    found = {r.conv_id: r for r in chat.digests(formatted).collect()}
    whole = {r.conv_id: r for r in formatted.collect()}
    grouped = {}
    for conv, turn, role, text, _ in turns:
        grouped.setdefault(conv, []).append((-1 if turn is None else turn, role or "", text or ""))
    assert set(found) == set(grouped)
    for conv, rows in grouped.items():
        rows.sort()
        lines = "".join(f"{r}\n{t}\n" for _, r, t in rows)
        learned = "".join(t for _, r, t in rows if r == "assistant")
        assert masked[conv] == learned
        assert found[conv].n_turns == len(rows)
        assert found[conv].turns_sha256 == hashlib.sha256(lines.encode()).hexdigest()
        assert (found[conv].loss_chars, found[conv].loss_sha256) == (len(learned), hashlib.sha256(learned.encode()).hexdigest())
        assert found[conv].formatted_chars == len(whole[conv].formatted)
        assert not any(c in whole[conv].formatted for c in chat.Template().reserved)
    # Adjacent turns of one role share a block.
    assert whole[50].formatted == "<|begin|>assistant<|text|>first<|end|><|begin|>user<|text|><|next|><|end|>"
    assert chat.format_conversations(data.limit(0)).count() == 0


# ------------------------------------------------------------------ archives


def test_archives_give_back_every_payload(spark):
    big = "é" * 50_000
    pages = [(1, "http://a/", "x"), (2, None, "x"), (3, "http://a/\r\nb", "x"), (4, "u", None), (5, "u", ""), (6, "u", big), (6, "u", big), (None, "u", "x"), (7, "u", "\r\n\r\nWARC/1.1")]
    data = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("digest", F.lit("clash"))
    settings = warc.Settings(chunk=4096, segment=20_000, file=60_000)
    manifest = warc.write_archives(data, settings=settings)
    chunks = warc.read_chunks(manifest, settings=settings).collect()
    stored = {}
    for r in sorted(chunks, key=lambda r: r.chunk):
        if r.type == "response" and r.page_id != 6:
            stored[r.page_id] = stored.get(r.page_id, b"") + bytes(r.data)
            assert r.digest == base64.b32encode(hashlib.sha1(stored[r.page_id]).digest()).decode()
    assert stored == {3: b"x", 5: b"", 7: b"\r\n\r\nWARC/1.1"}
    assert sum(r.chunk == 0 for r in chunks) == 9 and max(r.chunk for r in chunks) == 24
    found = sorted(warc.round_trip(data, settings).collect(), key=lambda r: (r.page_id is None, r.page_id))
    expected = {1: 3, 2: 3, 3: None, 4: 5, 5: None, 6: None, None: 3, 7: None}
    for r, (page_id, _, html) in zip(found, sorted(pages, key=lambda p: (p[0] is None, p[0])), strict=True):
        payload = (html or "").encode()
        assert (r.page_id, r.payload_bytes, r.refers_to) == (page_id, len(payload), expected[page_id])
        assert r.payload_digest == base64.b32encode(hashlib.sha1(payload).digest()).decode()
        assert r.record_type == ("response" if expected[page_id] is None else "revisit")
    assert warc.round_trip(data.limit(0)).count() == 0
    every = warc.round_trip(data, warc.Settings(least=2)).collect()
    assert {r.record_type for r in every if r.page_id in (1, 2, 3, 4, 5)} == {"response"}


# ------------------------------------------------------------------ queries and pipeline


def test_every_query_returns_its_contract(spark):
    columns = {
        "op1_quality_classifier": ["doc_id", "held_out", "score", "predicted"],
        "op3_permutation_index": ["query_id", "rank", "vec_id", "score"],
        "op4_language_model": ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
        "op5_host_reputation": ["page_id", "host", "path", "rule", "verdict"],
        "op6_chat_format": ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
        "op7_simhash": ["doc_id", "fingerprint", "component_id"],
        "op9_language_id": ["doc_id", "held_out", "lang_pred", "score"],
        "op10_warc": ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"],
        "op11_spelling_variants": ["word", "form", "root", "n", "n_near", "form_n"],
        "op12_sharding": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
        "op13_token_alignment": ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"],
    }
    found = queries.queries()
    assert {n.split("_")[0] for n in found} == {f"op{i}" for i in range(1, 14)}
    for name, expected in columns.items():
        assert found[name](spark, FOLDER).columns == expected
    probe = queries.op6_chat_format(spark, FOLDER).where("conv_id = -1").first()
    assert (probe.n_turns, probe.loss_chars) == (2, len(queries.PROBE))


def test_sql_counterparts_agree(spark):
    from checks.compare import _rows, connect

    found = queries.oracle_sql()
    assert set(found) == {"op5_host_reputation", "op6_chat_format"}
    connection = connect(FOLDER)
    for name, sql in found.items():
        frame = queries.queries()[name](spark, FOLDER)
        result = connection.execute(sql)
        names = [c[0] for c in result.description]
        assert _rows(frame.columns, frame.collect()) == _rows(names, result.fetchall()), name


def test_pipeline_stages_hand_over_documents(spark):
    folder = "/root/testdata/sf0.01"
    pipeline = importlib.import_module("corpus_pipeline")
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    docs, counts = documents, []
    for name, stage in pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == documents.columns, name
        docs = spark.createDataFrame(docs.collect(), documents.schema)
        counts.append(docs.count())
    assert documents.count() > counts[0] >= counts[1] > counts[2] > counts[3] > 0
    last = pipeline.run(spark, folder).select("doc_id").distinct().count()
    assert last == counts[3]
