"""Operators against brute force, round trips and held-out accuracy."""

import functools
import hashlib
import math
import random
import time
import zlib
from collections import Counter
from itertools import product
from pathlib import Path

import duckdb
import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import tiktoken
from pyspark.sql import functions as F

from pitchlake.llm import byte_bpe, chat_format, components, decontaminate, katz, license_scan, near_dup, quality, queries, token_counts, url_filter, vector_dedup

RANKS = Path(queries.RANKS).read_bytes()


def rows_of(sf_dir, table):
    return pq.read_table(f"{sf_dir}/{table}.parquet").to_pylist()


# 1. Token counts


def greedy(pieces, symbols):
    at, n, most = 0, 0, max(map(len, pieces), default=0)
    while at < len(symbols):
        end = next((e for e in range(min(len(symbols), at + most), at, -1) if tuple(symbols[at:e]) in pieces), None)
        if end is None:
            return 1
        at, n = end, n + 1
    return n


def test_longest_match_is_greedy():
    r = random.Random(1)
    for _ in range(300):
        pieces = {tuple(r.choice("abc") for _ in range(r.randrange(1, 5))) for _ in range(r.randrange(1, 12))}
        pieces = {tuple(map(ord, p)) for p in pieces}
        match = token_counts.LongestMatch(pieces)
        for _ in range(30):
            word = [ord(r.choice("abc")) for _ in range(r.randrange(0, 12))]
            assert match.length(word) == greedy(pieces, word)


def test_longest_match_with_continuations():
    code = lambda s: tuple(map(ord, s))
    match = token_counts.LongestMatch({code("un"), code("a")}, {code("aff"), code("able"), code("a"), code("b")})
    assert match.length(code("unaffable")) == 3
    assert match.length(code("aab")) == 3
    assert match.length(code("unx")) == 1 and match.length(code("ba")) == 1


def test_token_counts(spark, docs):
    vocab = Path(queries.PIECES).read_bytes()
    got = token_counts.token_counts(docs, vocab).collect()
    assert len(got) == docs.count()
    pieces, words = token_counts.vocabulary(vocab), token_counts.regex.compile(token_counts.WORDS)
    want = Counter()
    for r in docs.collect():
        found = words.findall(token_counts.unicodedata.normalize("NFC", r["text"] or "").lower())
        want[r["doc_id"], len(found), sum(greedy(pieces, [*w.encode(), token_counts.END]) for w in found)] += 1
    assert Counter(map(tuple, got)) == want


def test_token_counts_of_separators_and_long_texts(spark):
    vocab = Path(queries.PIECES).read_bytes()
    texts = ["a\x1cb", "\x1c\x1d a\x1e", "x\x85y\xa0z", "", None, "word " * 100_000, "a" * 100_000]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, n_words int")
    got = {r["doc_id"]: (r["n_words"], r["n_tokens"]) for r in token_counts.token_counts(df, vocab).collect()}
    pieces, words = token_counts.vocabulary(vocab), token_counts.regex.compile(token_counts.WORDS)
    for i, t in enumerate(texts[:5]):
        found = words.findall((t or "").lower())
        assert got[i] == (len(found), sum(greedy(pieces, [*w.encode(), token_counts.END]) for w in found))
    assert got[5] == (100_000, 100_000) and got[6][0] == 1
    assert token_counts.token_counts(df.limit(0), vocab).count() == 0


# 2. Language model


def brute_scores(rows, order):
    """Katz backoff from the definition, in dictionaries."""
    tokens = lambda t: [b"<s>"] * (order - 1) + [*(t or "").encode().lower().split(), b" end"]
    train = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 10 != 0
    grams, after = [Counter() for _ in range(order + 1)], [Counter() for _ in range(order)]
    for i, t in rows:
        s = tokens(t)
        for at in range(order - 1, len(s) if train(i) else 0):
            for k in range(1, order + 1):
                grams[k][tuple(s[at - k + 1 : at + 1])] += 1
                after[k - 1][tuple(s[at - k + 1 : at])] += 1
    d = [None, *(katz.discounts([Counter(c.values())[r] for r in range(1, katz.LOW + 2)]) for c in grams[1:])]
    less = lambda c, k: c - katz.REST if c > katz.LOW else c * d[k][c - 1]
    total = after[0][()]
    rest = 1 - sum(less(c, 1) for c in grams[1].values()) / total
    follow = {}
    for k in range(2, order + 1):
        for g in grams[k]:
            follow.setdefault(g[:-1], []).append(g[-1])

    def p(h, w):
        k = len(h) + 1
        if k == 1:
            return less(grams[1][w,], 1) / total if grams[1][w,] else rest
        if grams[k][(*h, w)]:
            return less(grams[k][(*h, w)], k) / after[k - 1][h]
        return weight(h) * p(h[1:], w)

    @functools.cache
    def weight(h):
        if h not in follow:
            return 1.0
        return (1 - sum(p(h, w) for w in follow[h])) / (1 - sum(p(h[1:], w) for w in follow[h]))

    for h in list(follow)[:: max(1, len(follow) // 20)]:  # the probabilities after a history sum to 1
        assert math.isclose(sum(p(h, w[0]) for w in grams[1]) + p(h, b" never"), 1, abs_tol=1e-9)
    out, vocabulary = [], len(grams[1])
    for i, t in rows:
        s = tokens(t)
        score = sum(math.log10(p(tuple(s[at - order + 1 : at]), s[at])) for at in range(order - 1, len(s)))
        c = [grams[1][w,] for w in s[order - 1 :]]
        base = sum(math.log10((x + 0.1) / (total + 0.1 * (vocabulary + 1))) for x in c)
        out.append((i, not train(i), len(c), sum(x > 0 for x in c), total, round(base, 6), round(score, 6)))
    return out


@pytest.mark.parametrize(("order", "flush", "spread"), [(3, katz.FLUSH, katz.SPREAD), (3, 50, 4), (2, 200, 10), (1, 40, 4), (4, 300, 6)])
def test_katz(spark, docs, sf_dir, monkeypatch, order, flush, spread):
    """Small flushes cut texts into pieces, a small spread deals histories over buckets."""
    monkeypatch.setattr(katz, "FLUSH", flush)
    monkeypatch.setattr(katz, "SPREAD", spread)
    more = [(r["doc_id"] + 100, r["text"]) for r in rows_of(sf_dir, "documents")[:12]]
    df = docs.select("doc_id", "text").union(spark.createDataFrame(more, "doc_id long, text string")).repartition(3).cache()
    wide = df.withColumns({"score": F.lit(1), "train": F.lit("x"), "doc": F.lit(2), "flush": F.lit(3)})
    got = katz.scored(wide, order).select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score").collect()
    want = brute_scores([(r["doc_id"], r["text"]) for r in df.collect()], order)
    assert Counter((*r[:5], round(r[5], 6), round(r[6], 6)) for r in got) == Counter(want)


def test_katz_of_a_very_long_text(spark):
    text = " ".join(f"w{k * k % 97}" for k in range(60_000))
    got = katz.scored(spark.createDataFrame([(1, text), (10, text), (None, "a b")], "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["n_tokens"] for r in got} == {1: 60_001, 10: 60_001, None: 3} and all(r["score"] < 0 for r in got)


def test_katz_without_rows(spark, docs):
    assert katz.scored(docs.limit(0)).count() == 0


# 3. Byte-level BPE


@pytest.fixture(scope="module")
def coder():
    return byte_bpe.bpe(RANKS, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def reference(coder):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=coder.ranks, special_tokens={})


def test_encoding_equals_the_library(coder, reference, sf_dir):
    r = random.Random(2)
    texts = [x["text"] for x in rows_of(sf_dir, "documents")]
    letters = ["ab  c\n\r\t '", "éàü日本語한국🎉 1x2", "\x1c\x85\xa0 a\n​　", "aAb's'll 'RE"]
    texts += ["".join(r.choice(r.choice(letters)) for _ in range(r.randrange(60))) for _ in range(2000)] + ["a" * 20_000, " " * 999]
    for t in texts:
        ids = coder.encode(t)
        assert ids == np.array(reference.encode_ordinary(t), "<u4").tobytes()
        assert coder.decode(ids).decode() == t


def test_other_patterns_are_matched_whole(coder):
    pattern = r"\w+ \w+|\s|\S"
    own = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=coder.ranks, special_tokens={})
    other = byte_bpe.bpe(RANKS, pattern)
    for t in ("one two three four", "a b", " x  y z\n"):
        assert other.encode(t) == np.array(own.encode_ordinary(t), "<u4").tobytes()


def test_digests_without_rows(spark, docs):
    assert byte_bpe.digests(docs.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0


def test_tables_extend_and_survive_edits(coder):
    r = random.Random(3)
    word = bytes(r.choice(b"the and of in er") for _ in range(300))
    table = coder.prefixes(word)
    assert coder.prefixes(word, coder.prefixes(word[:200])) == table
    for _ in range(40):
        a = r.randrange(len(word))
        b = min(len(word), a + r.randrange(5))
        new, edited = coder.edited(word, table, a, b, bytes(r.choice(b"aeth ") for _ in range(r.randrange(4))))
        assert edited == coder.prefixes(new)


def test_digests(spark, docs, reference):
    got = byte_bpe.digests(docs, RANKS, public_tokenizers.PATTERN).collect()
    want = Counter()
    for r in docs.collect():
        ids = np.array(reference.encode_ordinary(r["text"] or ""), "<u4")
        want[r["doc_id"], len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((r["text"] or "").encode()).hexdigest()] += 1
    assert Counter(map(tuple, got)) == want
    again = byte_bpe.decode(byte_bpe.encode(docs, RANKS, public_tokenizers.PATTERN), RANKS).collect()
    assert all(r["decoded"] == (r["text"] or "").encode() for r in again)


# 4. Vectors


def test_vectors(spark, monkeypatch):
    monkeypatch.setattr(vector_dedup, "SHARDS", 3)
    make = np.random.default_rng(1)
    base = make.standard_normal((60, 8))
    x = [*base, *(base[:20] + 0.05 * make.standard_normal((20, 8))), *base[:5], *np.repeat(base[:1], 30, axis=0), *(base[7] + 0.02 * make.standard_normal((80, 8)))]
    rows = [(i, [float(v) for v in e], i) for i, e in enumerate(x)]
    bad = [(900, None, 1), (901, [0.0] * 8, 1), (902, [float("nan")] * 8, 1), (903, [None] * 8, 1), (904, [], 1), (905, [1.0] * 4, 1), (906, [float("inf")] * 8, 1)]
    got = {r[0]: tuple(r)[1:] for r in vector_dedup.link(spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>, n_links int")).collect()}
    u = np.array(x) / np.linalg.norm(x, axis=1, keepdims=True)
    near = u @ u.T >= 0.95
    root = np.arange(len(x))
    while not (new := np.array([root[n].min() for n in near])).tolist() == root.tolist():
        root = new
    for i in range(len(x)):
        assert got[i] == (near[i].sum() - 1, root[i], root[i] == i)
    assert all(got[i[0]] == (0, i[0], True) for i in bad)


def test_recall_is_measured_where_links_are_rare(monkeypatch):
    """8,000 vectors of which almost none link: the planted ones tell of a graph that is too
    thin, and the search goes on to the whole shard."""
    r = np.random.default_rng(8)
    x = r.standard_normal((8000, 48))
    pairs = [(k, k + 4000) for k in range(0, 4000, 200)]
    for a, b in pairs:
        x[b] = 0.96 * x[a] / np.linalg.norm(x[a]) + 0.28 * (t := r.standard_normal(48)) / np.linalg.norm(t)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    truth = {(int(i), int(j)) for i, j in zip(*np.nonzero(x @ x.T >= 0.95), strict=True) if i != j}
    graph = vector_dedup.SmallWorld(x)
    found = lambda: {(int(a), int(b)) for i, j in graph.links(x, 0.95) for a, b in zip(i, j, strict=True) if a != b}
    assert truth and len(truth & found()) >= 0.97 * len(truth)
    got, want = graph.found_again(graph.planted(0.95), np.float32(0.9499), vector_dedup.BEAM)
    assert want >= vector_dedup.PLANTED and got >= 0.9 * want
    graph.near = [np.full_like(layer, -1) for layer in graph.near]  # no way leads anywhere
    assert graph.found_again(graph.planted(0.95), np.float32(0.9499), vector_dedup.BEAM)[0] < 0.1 * want
    assert truth <= found() and graph.measured == (vector_dedup.PLANTED, vector_dedup.PLANTED)


def test_vectors_with_null_and_repeated_ids(spark):
    """Null ids name no component; ties fall to the least id."""
    a, b = [1.0, 0.0, 0.5], [0.0, 1.0, 0.0]
    rows = [(None, a), (3, a), (3, a), (2, a), (None, b), (None, None), (7, None)]
    df = spark.createDataFrame([(i, v, 0, 1) for i, v in rows], "vec_id long, embedding array<double>, node int, v int")
    got = Counter((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in vector_dedup.link(df).collect())
    assert got == Counter([(None, 3, 2, False), (3, 3, 2, False), (3, 3, 2, False), (2, 3, 2, True), (None, 0, None, True), (None, 0, None, True), (7, 0, 7, True)])
    assert vector_dedup.link(df.limit(0)).count() == 0


# 5. Quality


def test_isotonic_pools_violators():
    x, y = quality.isotonic(np.arange(4.0), np.array([0.0, 2.0, 0.0, 1.0]), np.array([1.0, 2.0, 1.0, 1.0]))
    assert np.allclose(y, [0, 2 / 3, 1]) and np.allclose(x, [0, 4 / 3, 3])


def test_quality(spark, sf_dir, docs):
    sf = sf_dir.replace("0.001", "0.01")
    got = {r["doc_id"]: r for r in quality.classify(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")).collect()}
    held = [r for r in rows_of(sf, "labels") if got[r["doc_id"]]["held_out"]]
    assert np.mean([got[r["doc_id"]]["predicted"] == r["quality"] for r in held]) > 0.93
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got.values())
    none = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, quality int")
    assert quality.classify(docs, none).count() == docs.count()
    assert quality.accepted(docs, none).columns == docs.columns


def plain_scores(docs, labels):
    """The classifier by least squares on stacked rows and the min-max formula of isotonic regression."""
    crc = lambda i, salt="": zlib.crc32((salt + ("" if i is None else str(i))).encode())
    x = np.array([quality.statistics(t) for _, t in docs])
    wanted = [(k, q) for k, (i, _) in enumerate(docs) for j, q in labels if i is not None and i == j and q in (0, 1) and crc(i) % 3 != 1]
    at, y = np.array([k for k, _ in wanted]), np.array([q for _, q in wanted], float)
    aside = np.array([crc(docs[k][0], "aside") % 5 == 0 for k in at])
    mean, scale = x[at].mean(axis=0), np.maximum(x[at].std(axis=0), 1e-6)
    make = np.random.default_rng(quality.SEED)
    turn = make.standard_normal((x.shape[1], quality.FEATURES)) / (quality.WIDTH * np.sqrt(x.shape[1]))
    shift = make.uniform(0, 2 * np.pi, quality.FEATURES)
    z = np.sqrt(2 / quality.FEATURES) * np.cos(np.clip((x - mean) / scale, -6, 6) @ turn + shift)
    z = np.hstack([z, np.ones((len(z), 1))])
    mine = z[at[~aside]]
    pull = np.sqrt(quality.RIDGE * len(mine)) * np.eye(z.shape[1])
    ridge = z @ np.linalg.lstsq(np.vstack([mine, pull]), np.r_[y[~aside], np.zeros(len(pull))], rcond=None)[0]
    bins = np.floor((np.clip(ridge[at[aside]], -0.5, 1.5) + 0.5) * quality.BINS / 2)
    b = np.unique(bins)
    n, total = (np.array([f(bins == v) for v in b]) for f in (np.sum, lambda m: y[aside][m].sum()))
    level = [max(min(total[p : q + 1].sum() / n[p : q + 1].sum() for q in range(i, len(b))) for p in range(i + 1)) for i in range(len(b))]
    place = (b + 0.5) / (quality.BINS / 2) - 0.5
    knots = [(np.average(place[m], weights=n[m]), v) for v in np.unique(np.round(level, 12)) for m in [np.isclose(level, v)]]
    return np.clip(np.interp(ridge, *np.array(knots).T), 0, 1)


def test_quality_equals_a_plain_fit(spark, sf_dir):
    sf = sf_dir.replace("0.001", "0.01")
    docs = [(r["doc_id"], r["text"]) for r in rows_of(sf, "documents")]
    labels = [(r["doc_id"], r["quality"]) for r in rows_of(sf, "labels")]
    want = plain_scores(docs, labels)
    got = {r["doc_id"]: r["score"] for r in quality.classify(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")).collect()}
    assert np.allclose([got[i] for i, _ in docs], want, atol=1e-6)


def test_quality_of_odd_rows(spark):
    rows = [(1, None), (1, ""), (None, "a b c"), (2, "word " * 200_000), (3, "\x00\ud7ff")]
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, score int, x int")
    labels = spark.createDataFrame([(1, 1, 0), (2, None, 0), (None, 1, 0), (3, 7, 0)], "doc_id long, quality int, text int")
    got = quality.classify(docs, labels).collect()
    assert len(got) == 5 and all(0 <= r["score"] <= 1 for r in got)
    assert quality.classify(docs.limit(0), labels).count() == 0 == quality.accepted(docs.limit(0), labels).count()
    assert quality.accepted(docs, labels).columns == docs.columns


# 6 to 8, against SQL


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_oracle(spark, sf_dir, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    df, found = queries.QUERIES[name](spark, sf_dir), con.sql(queries.ORACLE[name])
    cols = sorted(df.columns)
    assert cols == sorted(found.columns)
    assert Counter(map(tuple, df.select(*cols).collect())) == Counter(con.sql(f"SELECT {', '.join(cols)} FROM ({queries.ORACLE[name]})").fetchall())


def test_urls_and_links(spark):
    page = lambda i, url, html="": (i, url, html, "x")
    rows = [
        page(1, "https://A.Example.ORG/en/19?x"), page(2, "http://b.org"), page(3, None), page(4, "no scheme"), page(5, "https://x.com/de/"),
        page(6, "https://bad.net/", '<a href="https://x.com/de/">x</a>'), page(7, "https://good.net/a"), page(8, "https://b.org/", "<a href='//good.net/a'>y</a>"),
    ]
    got = {r["page_id"]: r for r in url_filter.filter_urls(spark.createDataFrame(rows, "page_id long, url string, html string, rule string")).collect()}
    assert tuple(got[1])[1:5] == ("a.example.org", "/en/19", "example.org/en/1", "block")
    assert (got[2]["host"], got[2]["path"], got[2]["rule"]) == ("b.org", "", None)
    assert (got[3]["host"], got[3]["path"], got[3]["verdict"]) == ("", "", "allow") and got[4]["host"] == ""
    assert got[5]["rule"] == "com/de/" and got[6]["verdict"] == "block" and got[7]["verdict"] == "allow"


def test_distrust_runs_along_a_chain(spark):
    """Twelve hosts, each linking to the next; the last one is blocked."""
    rows = [(i, f"https://h{i}.net/", f'<a href="https://h{i + 1}.net/">x</a>') for i in range(12)]
    rows += [(12, "https://h12.net/", '<a href="https://bad.com/de/">x</a>'), (13, "https://bad.com/de/", ""), (14, "https://fine.net/", None), (14, "https://fine.net/", None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = url_filter.filter_urls(df).collect()
    assert len(got) == 16 and {r["page_id"]: r["verdict"] for r in got} == {i: "allow" if i == 14 else "block" for i in range(15)}
    assert url_filter.filter_urls(df.limit(0)).count() == 0
    clashing = df.selectExpr("*", *(f"page_id AS {c}" for c in ("host", "path", "rule", "verdict", "trust", "distrust", "a", "b", "n", "src", "dst", "score", "source")))
    assert sorted(map(tuple, url_filter.filter_urls(clashing).collect())) == sorted(map(tuple, got))
    long = spark.createDataFrame([(1, "https://x.net/" + "a" * 300_000, "<p>" * 300_000)], "page_id long, url string, html string")
    assert len(url_filter.filter_urls(long).first()["path"]) == 300_001


@pytest.mark.parametrize("local", [url_filter.LOCAL, 0])
def test_scores_equal_a_dense_solution(spark, monkeypatch, local):
    monkeypatch.setattr(url_filter, "LOCAL", local)
    r = random.Random(14)
    edges = {(f"n{r.randrange(8)}", f"n{r.randrange(8)}") for _ in range(20)}
    edges = {(a, b) for a, b in edges if a != b}
    names = sorted({x for e in edges for x in e} | {"alone"})
    out, seeds = {}, {"trust": {names[0]: 1.0}, "distrust": {names[-2]: 0.5, "alone": 0.5}}
    rows = []
    for kind in seeds:
        use = edges if kind == "trust" else {(b, a) for a, b in edges}
        degree = Counter(a for a, _ in use)
        w = np.zeros((len(names), len(names)))
        for a, b in use:
            rows.append((kind, a, b, 1 / degree[a]))
            w[names.index(b), names.index(a)] = 1 / degree[a]
        s = np.array([seeds[kind].get(n, 0.0) for n in names])
        w[:, w.sum(axis=0) == 0] = s[:, None]  # without edges: back to the seeds
        out[kind] = np.linalg.solve(np.eye(len(names)) - 0.85 * w, 0.15 * s)
    e = spark.createDataFrame(rows, "kind string, src string, dst string, w double")
    s = spark.createDataFrame([(k, h, x) for k, hs in seeds.items() for h, x in hs.items()], "kind string, host string, seed double")
    got = {r["host"]: (r["trust"], r["distrust"]) for r in url_filter.standing(e, s).collect()}
    for i, n in enumerate(names):
        assert np.allclose(got.get(n, (0, 0)), (out["trust"][i], out["distrust"][i]), atol=2 * url_filter.TOLERANCE)


def test_a_large_graph_is_walked_by_all_tasks_alike(spark, monkeypatch):
    """Half a million links in either kind between 50,000 hosts, some of them very hot."""
    hosts = 50_000
    links = spark.range(500_000).selectExpr(f"pmod(xxhash64(id, 1), {hosts}) AS a", f"CAST(floor(pow(pmod(xxhash64(id, 2), 1000000) / 1e6, 3) * {hosts}) AS LONG) AS b").where("a <> b").distinct()
    both = links.selectExpr("'trust' AS kind", "a AS src", "b AS dst").unionByName(links.selectExpr("'distrust' AS kind", "b AS src", "a AS dst"))
    out = both.groupBy("kind", "src").count()
    edges = both.join(out, ["kind", "src"]).selectExpr("kind", "'h' || src AS src", "'h' || dst AS dst", "1 / count AS w").cache()
    assert edges.count() > 900_000
    seeds = spark.createDataFrame([("trust", "h1", 0.5), ("trust", "h2", 0.5), ("distrust", "h7", 1.0)], "kind string, host string, seed double")
    scores = []
    for local in (10**9, 0):
        monkeypatch.setattr(url_filter, "LOCAL", local)
        got = url_filter.standing(edges, seeds, rounds=8)
        scores.append({r["host"]: (r["trust"], r["distrust"]) for r in got.collect()})
    edges.unpersist()
    assert scores[0].keys() == scores[1].keys() and len(scores[0]) > 40_000
    assert all(np.allclose(scores[0][h], scores[1][h], rtol=1e-9, atol=1e-15) for h in scores[0])


def test_licenses(spark, docs):
    texts = [(1, "Some words.\nreleased under the  MIT license!\nmore", 1), (2, license_scan.TEMPLATES["MIT"].replace(" to deal", "\nto deal"), 1), (2, None, 1), (3, "license", 1)]
    got = {(r["doc_id"], r["license"]) for r in license_scan.scan(spark.createDataFrame(texts, "doc_id long, text string, dice int")).collect()}
    assert got == {(1, "MIT-notice"), (2, "MIT")}
    assert license_scan.scan(docs).count() == 0


def test_licenses_of_dice_just_at_the_threshold(spark):
    lines = ["This work is licensed under CC BY-SA 4.0.", "Licensed under CC BY-NC", "Code is released under the MIT License.", "Acme: all rights reserved."]
    apache = license_scan.TEMPLATES["Apache-2.0"].replace(" you may", "\nyou may").replace(" You may", "\nYou may").replace(" a copy", "\na copy")
    lines += ["Copyright 2020 Acme Inc. All rights reserved.", "# tool\n#\n# " + apache.replace("\n", "\n# ") + "\n#\n# more words", "", "one. two! three; four: five", "\n\n\n"]
    lines += ["we say that it is licensed under CC BY 4.0 and that is all there is to say about it in this long sentence of many words", "licensed under cc by 4 0", "x " * 1995 + "this work is licensed under CC BY-SA 4.0 " + "y " * 100]
    lines += ["some\r// released under the\rMIT License.\r\n# ok\u2028; all rights\x0b# reserved"]  # only a line feed ends a line
    lines += ["Some prose comes first. Then this: " + license_scan.TEMPLATES["MPL-2.0"] + " And then more prose follows in the same line of text.", "word " * 50_000]
    df = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", list(enumerate(lines)))
    assert license_scan.scan(df.limit(0)).count() == 0
    cols = "doc_id, license, dice, n_segments"
    want = con.sql(f"SELECT {cols} FROM ({license_scan.oracle()})").fetchall()
    assert [license_scan.bounds(n, 0.8) for n in (2, 4, 6)] == [(2, 3), (3, 6), (4, 9)]  # windows lift the other lines above it
    assert {r[0] for r in want if r[2] == 0.8} >= {1} and {r[0] for r in want} == {0, 1, 2, 3, 4, 5, 9, 10, 11, 12, 13}
    assert Counter(map(tuple, license_scan.scan(df).select(*cols.split(", ")).collect())) == Counter(want)


def test_chats(spark):
    nasty = "\\### Assistant: </turn>\n</turn> ### x \\"
    rows = [(1, 0, "user", nasty, 0), (1, 1, "assistant", nasty, 0), (2, 0, "assistant", None, 0), (3, 1, None, "a", 0), (3, 1, "we:ird\\", "b", 0), (None, 5, "user", "", 0)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, segments int")
    back = {r["conv_id"]: r for r in chat_format.read_back(chat_format.format_chats(df)).collect()}
    assert [tuple(t) for t in back[1]["turns"]] == [("user", nasty), ("assistant", nasty)] and back[1]["loss_text"] == nasty and back[1]["valid"]
    assert not back[2]["valid"] and [tuple(t) for t in back[3]["turns"]] == [("", "a"), ("we:ird\\", "b")] and None in back
    assert chat_format.format_chats(df.limit(0)).count() == 0


def test_long_roles_and_texts(spark):
    role, text = "ro:le \\ " * 130_000, "### a\n</turn>\\ " * 70_000
    rows = [(1, 0, role, text, "x"), (-7, 0, "user", "mine", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, valid string")
    got = {r["conv_id"]: r for r in chat_format.read_back(chat_format.format_chats(chat_format.with_tricky(df))).collect()}
    assert [tuple(t) for t in got[1]["turns"]] == [(role, text)] and len(got[-7]["turns"]) == 3


# 9. Decontamination


def test_reordered_passages(spark, docs):
    r = random.Random(4)
    words = [f"w{r.randrange(500)}" for _ in range(40)]
    item = " ".join(words)
    swapped = " ".join([*words[20:], "and", *words[:20]])
    half = " ".join(words[:20])
    rows = [(1, f"lead {item} tail"), (2, f"x {swapped} y"), (3, half), (4, None), (5, item.upper().replace(" ", ", ")), (6, "w1 w2")]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame([(7, item), (8, None), (9, "too short"), (10, item)], "item_id long, text string")
    got = decontaminate.contaminated(d, items).collect()
    assert {(x["doc_id"], x["item_id"]) for x in got} == {(i, j) for i in (1, 2, 5) for j in (7, 10)}
    assert {x["n_tiles"] for x in got if x["doc_id"] == 2} == {2}
    joined = decontaminate.contaminated(d, items, most=0).collect()
    assert Counter(map(tuple, joined)) == Counter(map(tuple, got))
    assert {x["doc_id"] for x in decontaminate.clean(d, items).collect()} == {3, 4, 6}
    assert decontaminate.clean(docs, items).columns == docs.columns and decontaminate.clean(docs, items).count() == docs.count()
    assert decontaminate.contaminated(d, items.limit(0)).count() == 0


def test_null_and_repeated_ids(spark):
    """Both ways judge row by row."""
    item = " ".join(f"w{i}" for i in range(30))
    d = spark.createDataFrame([(None, item), (None, "fine"), (1, item), (1, "fine too"), (1, item)], "doc_id long, text string")
    items = spark.createDataFrame([(None, item), (2, item), (2, item)], "item_id long, text string")
    got = [Counter(map(tuple, decontaminate.contaminated(d, items, most=m).collect())) for m in (decontaminate.MOST_CHARS, 0)]
    assert got[0] == got[1] and sum(got[0].values()) == 9
    for m in (decontaminate.MOST_CHARS, 0):
        assert Counter(map(tuple, decontaminate.clean(d, items, most=m).collect())) == Counter([(None, "fine"), (1, "fine too")])


def greedy_tiles(a, b, least=5):
    """Greedy string tiling by trying every place."""
    on_a, on_b, out = [False] * len(a), [False] * len(b), []
    while True:
        best = (0, 0, 0)
        for i in range(len(a)):
            for j in range(len(b)):
                n = 0
                while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n] and not on_a[i + n] and not on_b[j + n]:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if n < least:
            return out
        on_a[i : i + n] = on_b[j : j + n] = [True] * n
        out.append((i, j, n))


def brute_hits(docs, items, threshold=0.8):
    out = Counter()
    for doc_id, text in docs:
        d = decontaminate.tokens(text)
        for item_id, passage in items:
            p = decontaminate.tokens(passage)
            if 0 < len(p) < 5:
                n = len(p)
                if d == p or (n >= 3 and any(d[k : k + n] == p for k in range(len(d) - n + 1))):
                    out[doc_id, item_id, 1.0, 1, n] += 1
            elif p:
                tiles = greedy_tiles(p, d)
                covered = sum(n for _, _, n in tiles)
                if covered >= threshold * len(p):
                    out[doc_id, item_id, round(covered / len(p), 9), len(tiles), tiles[0][2]] += 1
    return out


def test_tiles_equal_brute_force():
    r = random.Random(11)
    for k in range(250):
        item = [r.randrange(1, 3 + k % 5) for _ in range(r.randrange(5, 40))]
        doc = [r.randrange(1, 3 + k % 5) for _ in range(r.randrange(5, 60))]
        doc[3:3] = item[r.randrange(len(item)) :]
        want = greedy_tiles(item, doc)
        a, b = np.array(item, np.uint64), np.array(doc, np.uint64)
        h, g = decontaminate.rolling(a), decontaminate.rolling(b)
        assert decontaminate.tiling(a, b, np.nonzero(h[:, None] == g[None, :])) == want
        assert decontaminate.crowded(a, b) == want


def test_decontamination_equals_brute_force(spark):
    """Both ways, with nulls, repeats, short items, empty texts, long repeats and clashing columns."""
    r = random.Random(12)
    word = lambda: f"w{r.randrange(60)}"
    items = [(i if i else None, " ".join(word() for _ in range(r.choice([1, 2, 3, 4, 5, 12, 30])))) for i in range(25)] + [(90, None), (91, ""), (92, "a " * 60), (92, "a " * 60)]
    docs = [(k, " ".join(word() for _ in range(30))) for k in range(15)] + [(None, None), (50, ""), (51, "a " * 300)]
    for k, (_, text) in enumerate(items[:25] * 2):
        words = text.split()
        cut = r.randrange(len(words) + 1)
        docs.append((100 + k // 2 if k % 5 else None, " ".join([word(), *words[cut:], word(), *words[:cut], word()]) if k < 25 else text))
    want = brute_hits(docs, items)
    d = spark.createDataFrame([(i, t, 1, 2, 3) for i, t in docs], "doc_id long, text string, item_id int, row int, n int")
    b = spark.createDataFrame([(i, t, 1, 2) for i, t in items], "item_id long, text string, doc_id int, whole int")
    gone = Counter()
    for (doc_id, text) in docs:
        gone[doc_id, text] += not brute_hits([(0, text)], items)
    for most in (decontaminate.MOST_CHARS, 0):
        got = decontaminate.contaminated(d, b, most=most).collect()
        assert Counter((*x[:2], round(x[2], 9), *x[3:]) for x in got) == want
        assert Counter((x["doc_id"], x["text"]) for x in decontaminate.clean(d, b, most=most).collect()) == +gone
        assert decontaminate.contaminated(d.limit(0), b, most=most).count() == 0 == decontaminate.contaminated(d, b.limit(0), most=most).count()


def test_a_shared_prompt_makes_no_pairs(spark):
    r = random.Random(12)
    words = lambda n: " ".join(f"w{r.randrange(10**6)}" for _ in range(n))
    prompt = "read the text and answer the question that follows"
    items = [(k, f"{prompt} {words(25)}") for k in range(400)]
    rows = [(k, f"{words(20)} {prompt} {words(30)}") for k in range(400)] + [(1000 + k, f"{words(9)} {items[k][1]} {words(9)}") for k in range(5)]
    docs, bench = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contaminated(docs, bench, most=0).collect()
    assert sorted((x["doc_id"], x["item_id"], x["coverage"]) for x in got) == [(1000 + k, k, 1.0) for k in range(5)]
    assert sorted(map(tuple, got)) == sorted(map(tuple, decontaminate.contaminated(docs, bench).collect()))
    shared = {" ".join(prompt.split()[k : k + 5]) for k in range(5)}
    first = items[0][1].split()
    seeds = [" ".join(first[k : k + 5]) for k in range(len(first) - 4)]
    kept = decontaminate.few_seeds([405 if x in shared else 1 for x in seeds], list(range(len(seeds))), len(first), 0.8)
    assert kept and not shared & {seeds[k] for k in kept}  # so the prompt is no key of the join


def test_every_hit_holds_a_rare_seed():
    r = random.Random(13)
    for _ in range(300):
        n = r.randrange(5, 40)
        often = [r.choice([1, 1, 2, 50, 900]) for _ in range(n - 4)]
        kept = set(decontaminate.few_seeds(often, list(range(n - 4)), n, 0.8))
        for _ in range(20):
            found = {p for p in range(n - 4) if r.random() < r.choice([0.3, 0.6, 0.9])}
            covered = len({x for p in found for x in range(p, p + 5)})
            assert covered < 0.8 * n or found & kept


def test_long_repeats_take_little_memory():
    import tracemalloc

    index = decontaminate.Index([(1, "a " * 1000)], 0.8)
    tracemalloc.start()
    assert index.hits("a " * 20_000) == [(1, 1.0, 1, 1000)]
    assert tracemalloc.get_traced_memory()[1] < 60_000_000
    tracemalloc.stop()


# 10. Near duplicates


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        old, row[0] = row[:], i
        for j, y in enumerate(b, 1):
            row[j] = min(old[j] + 1, row[j - 1] + 1, old[j - 1] + (x != y))
    return row[-1]


def test_alignment():
    r = random.Random(5)
    for _ in range(1500):
        a = [r.choice("abcd") for _ in range(r.randrange(1, 30))]
        b = list(a)
        for _ in range(r.randrange(8)):
            k = r.randrange(len(b) + 1)
            b[k : k + r.randrange(2)] = [r.choice("abcde")] * r.randrange(2)
        true = distance(a, b)
        assert near_dup.edits_within(a, b, 6) == (true if true <= 6 else None)
        assert near_dup.similar(a, b) == (true <= int(0.2 * max(len(a), len(b)) + 1e-9))


@pytest.mark.parametrize("local", [components.LOCAL, 20])
def test_components(spark, monkeypatch, local):
    """In one task and by rounds, against a search."""
    monkeypatch.setattr(components, "LOCAL", local)
    r = random.Random(15)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(170)] + [(1000 + k, 1001 + k) for k in range(60)] + [(2000, 2000 + k) for k in range(80)] + [(5, 5)] * 3
    root = {x: x for e in edges for x in e}
    for _ in root:
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    got = components.components(spark.createDataFrame(edges, "a long, b long").repartition(4)).collect()
    alone = {x for x in root if all(a == b for a, b in edges if x in (a, b))}
    assert Counter(map(tuple, got)) == Counter((x, y) for x, y in root.items() if x not in alone)


def test_near_duplicates(spark, docs):
    r = random.Random(6)
    rows, want = [], {}
    for g in range(12):
        words = [f"t{r.randrange(3000)}" for _ in range(120)]
        for k in range(1 + g):
            mine = list(words)
            for _ in range(3 if k else 0):
                mine[r.randrange(120)] = "new"
            rows.append((100 * g + k, " ".join(mine), k))
            want[100 * g + k] = 100 * g
    df = spark.createDataFrame(rows, "doc_id long, text string, n int").repartition(5)
    assert {x["doc_id"]: x["class_id"] for x in near_dup.classes(df).collect()} == want
    assert {x["doc_id"] for x in near_dup.one_of_each(df).collect()} == set(want.values())
    got = Counter((x["doc_id"], x["class_id"]) for x in near_dup.classes(docs).collect())
    assert got == Counter({(1, 1): 1, (2, 2): 1, (3, 3): 1, (None, None): 1, (4, 4): 1, (5, 1): 2, (6, 6): 1, (7, 7): 1, (8, 1): 1})
    assert near_dup.one_of_each(docs).columns == docs.columns
    assert near_dup.classes(docs.limit(0)).count() == 0


@pytest.mark.parametrize("rows, block", [(near_dup.SLICE, near_dup.BLOCK), (3, 10)])
def test_a_family_of_edits_stays_together(spark, monkeypatch, rows, block):
    """All pairs of a bucket count, however far the texts are from its first and
    however the bucket is dealt."""
    monkeypatch.setattr(near_dup, "SLICE", rows)
    monkeypatch.setattr(near_dup, "BLOCK", block)
    r = random.Random(7)
    base = [f"b{r.randrange(5000)}" for _ in range(400)]
    texts = [[f"e{r.randrange(10**6)}" if k and r.random() < 0.13 else w for w in base] for k in range(90)]
    r.shuffle(texts)
    maker, root = near_dup.Sketcher(), list(range(len(texts)))
    sketch = [set(maker.sketch(maker.ids(t)).tolist()) for t in texts]

    def top(i):
        return i if root[i] == i else top(root[i])

    for i in range(len(texts)):
        for j in range(i):
            if sketch[i] & sketch[j] and near_dup.similar(texts[i], texts[j]):
                p, q = sorted((top(i), top(j)))
                root[q] = p
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    assert {x["doc_id"]: x["class_id"] for x in near_dup.classes(df).collect()} == {i: top(i) for i in range(len(texts))}


def blocks_of(r, sizes):
    """Rows of blocks as ``near_dup.between`` deals them, block by block."""
    rows = []
    for bucket, size in enumerate(sizes):
        for k in range(size):
            bag, root = bytearray(near_dup.BINS), r.randrange(4)
            n = r.choice([1, 5, 20, 21, 25, 26, 300])
            for _ in range(n):
                bag[r.randrange(3)] += 1
            for side in (0, 1) if root else (1,):
                held = np.array([bucket, *r.sample(range(bucket, bucket + 40), 2)])
                rows.append((bucket, 0, k % 2 if size > 9 else 0, side, 1000 * bucket + k, root, 0, n, bytes(bag), held))
    rows = pd.DataFrame(rows, columns=["bucket", "i", "j", "side", "node", "root", "main", "n", "bag", "held"])
    return rows.sort_values(["bucket", "i", "j"], kind="stable", ignore_index=True)


@pytest.mark.parametrize(("together", "chunk"), [(5000, 50_000), (40, 7), (1, 1)])
def test_pairs_of_many_blocks(monkeypatch, together, chunk):
    """Blocks looked through together give what each gives, pair by pair."""
    monkeypatch.setattr(near_dup, "TOGETHER", together)
    monkeypatch.setattr(near_dup, "CHUNK", chunk)
    r = random.Random(11)
    rows = blocks_of(r, [r.choice([2, 2, 3, 5, 30]) for _ in range(120)])
    want = []
    for _, block in rows.groupby(["bucket", "i", "j"]):
        for x, y in product(block.itertuples(), repeat=2):
            if (x.side, y.side) == (0, 1) and x.root != y.root and (y.root == y.main or y.node > x.node):
                longer, away = max(x.n, y.n), sum(abs(p - q) for p, q in zip(x.bag, y.bag, strict=True))
                least = min(set(x.held.tolist()) & set(y.held.tolist()))
                if min(x.n, y.n) >= 0.8 * longer - 1e-9 and away <= 2 * int(0.2 * longer + 1e-9) and least == x.bucket:
                    want.append((x.bucket, x.j, x.node, y.node))
    got, n = [], 0
    for some in near_dup.whole_blocks(iter([rows[k : k + 7] for k in range(0, len(rows), 7)])):
        n += len(some)
        for x, y in near_dup.opposed(some, 0.8):
            assert some.loc[x, ["bucket", "i", "j"]].to_numpy().tolist() == some.loc[y, ["bucket", "i", "j"]].to_numpy().tolist()
            got += zip(*(some.loc[at, c].tolist() for at, c in ((x, "bucket"), (x, "j"), (x, "node"), (y, "node"))), strict=True)
    assert n == len(rows) and len(want) > 100 and Counter(got) == Counter(want)


def test_small_blocks_cost_little():
    """Thousands of small blocks are not gone through one by one."""
    rows = blocks_of(random.Random(12), [2] * 2000)
    one = rows[rows["bucket"] < 50]
    start = time.process_time()
    for _, block in one.groupby(["bucket", "i", "j"]):
        list(near_dup.opposed(block.reset_index(drop=True), 0.8))
    middle = time.process_time()
    for some in near_dup.whole_blocks(iter([rows])):
        list(near_dup.opposed(some, 0.8))
    assert time.process_time() - middle < 0.5 * 40 * (middle - start)


def edited(words, share, r):
    """Scattered substitutions, insertions and deletions, ``share`` of the words in all."""
    out = list(words)
    for at in sorted(r.sample(range(len(words)), int(share * len(words))), reverse=True):
        kind = r.random()
        out[at : at + 1] = [] if kind < 0.1 else [f"n{r.randrange(10**6)}"] if kind < 0.9 else [out[at], f"n{r.randrange(10**6)}"]
    return out


@pytest.mark.parametrize(("length", "share"), [(200, 0.1), (200, 0.15), (200, 0.19), (1000, 0.19), (60, 0.19), (24, 0.15), (10, 0.1)])
def test_recall_of_sketches(length, share):
    """Of the pairs that alignment accepts, at least 9 in 10 share a bucket."""
    r, maker, met, all_pairs = random.Random(8), near_dup.Sketcher(), 0, 0
    for _ in range(300):
        a = [f"w{r.randrange(5000)}" for _ in range(length)]
        b = edited(a, share, r)
        if near_dup.similar(a, b):
            all_pairs += 1
            met += bool(set(maker.sketch(maker.ids(a)).tolist()) & set(maker.sketch(maker.ids(b)).tolist()))
    assert all_pairs > 100 and met >= 0.9 * all_pairs


def test_classes_equal_brute_force(spark, sf_dir):
    """All pairs of the table's documents, aligned."""
    rows = [(r["doc_id"], r["text"]) for r in rows_of(sf_dir, "documents")]
    words = [near_dup.words_of(t) for _, t in rows]
    root = list(range(len(rows)))

    def top(i):
        return i if root[i] == i else top(root[i])

    for i in range(len(rows)):
        for j in range(i):
            n, m = len(words[i]), len(words[j])
            if min(n, m) and min(n, m) >= 0.8 * max(n, m) - 1e-9 and top(i) != top(j) and near_dup.similar(words[i], words[j]):
                root[max(top(i), top(j))] = min(top(i), top(j))
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        least[top(i)] = min(doc_id, least.get(top(i), doc_id))
    got = {r["doc_id"]: r["class_id"] for r in near_dup.classes(spark.read.parquet(f"{sf_dir}/documents.parquet")).collect()}
    assert got == {doc_id: least[top(i)] for i, (doc_id, _) in enumerate(rows)}


def test_near_duplicates_without_ids(spark):
    """Several null ids make no row more than once."""
    r = random.Random(9)
    base = [f"b{r.randrange(5000)}" for _ in range(80)]
    rows = [(None if k % 2 else k, " ".join(edited(base, 0.04, r))) for k in range(30)] + [(None, "x y z")] * 2
    got = near_dup.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter((x["doc_id"], x["class_id"]) for x in got) == Counter([(None if k % 2 else k, 0) for k in range(30)] + [(None, None)] * 2)
    left = near_dup.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter(x["doc_id"] for x in left) == Counter({0: 1, None: 2})


def test_a_very_long_text(spark):
    r = random.Random(13)
    long = [f"w{r.randrange(9973)}" for _ in range(200_000)]
    rows = [(1, " ".join(long)), (2, " ".join([*long[:1000], "other", *long[1000:]])), (3, " ".join(long[::-1]))]
    got = near_dup.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {x["doc_id"]: x["class_id"] for x in got} == {1: 1, 2: 1, 3: 3}


def test_one_of_each_with_null_and_repeated_ids(spark):
    text = lambda n: " ".join(f"{n}w{i}" for i in range(40))
    rows = [(1, text("a")), (2, text("a")), (2, text("b")), (None, text("a")), (None, text("c")), (None, text("c") + " end"), (None, None)]
    got = Counter(map(tuple, near_dup.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()))
    ends = [Counter([(1, text("a")), (2, text("b")), (None, c), (None, None)]) for c in (text("c"), text("c") + " end")]
    assert got in ends


# The pipeline


def test_pipeline_equals_plain_python(spark, sf_dir, tmp_path, reference):
    """Nulls, repeated rows and ids, empty texts, copies, a benchmark passage and clashing columns, through all stages."""
    import corpus_pipeline

    docs = [(r["doc_id"], r["text"]) for r in rows_of(sf_dir, "documents")]
    good = [t for _, t in docs if t and len(t.split()) > 60][:12]
    passage = " ".join(good[3].split()[:25])
    docs += [(None, good[0]), (None, good[1]), (None, good[1]), (docs[0][0], good[2]), (docs[1][0], docs[1][1]), (None, None), (900, None), (901, ""), (902, good[4] + " end")]
    docs += [(903, good[5] + " " + passage), (None, passage)]
    labels = [(r["doc_id"], r["quality"]) for r in rows_of(sf_dir, "labels")] + [(None, 1), (5, None)]
    items = [(1, passage), (None, "never seen words here at all"), (2, None), (3, "")]
    put = lambda name, rows, schema: spark.createDataFrame(rows, schema).repartition(3).write.parquet(str(tmp_path / f"{name}.parquet"))
    put("documents", [(i, t, 1, 2, 3, 4) for i, t in docs], "doc_id long, text string, score int, key int, row int, hits int")
    put("labels", labels, "doc_id long, quality int")
    put("benchmark", items, "item_id long, text string")
    sf = str(tmp_path)
    left = [d for d, s in zip(docs, plain_scores(docs, labels), strict=True) if s >= 0.5]
    words, root = [near_dup.words_of(t) for _, t in left], list(range(len(left)))

    def top(i):
        return i if root[i] == i else top(root[i])

    for i in range(len(left)):
        for j in range(i):
            if words[i] and words[j] and near_dup.similar(words[i], words[j]):
                root[max(top(i), top(j))] = min(top(i), top(j))
    kept = []
    for i, (doc_id, text) in enumerate(left):
        class_ = [k for k in range(len(left)) if top(k) == top(i)]
        ids = [left[k][0] for k in class_ if left[k][0] is not None]
        least = min(near_dup.key_of(words[k]) for k in class_) if words[i] else None
        if not words[i] or (doc_id == min(ids) if ids else near_dup.key_of(words[i]) == least):
            kept.append((doc_id, text))
    kept = [(i, t) for i, t in kept if not brute_hits([(0, t)], [x for x in items if x[1]])]
    want = Counter()
    for i, t in kept:
        ids = np.array(reference.encode_ordinary(t or ""), "<u4").tobytes()
        want[i, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()] += 1
    assert Counter(map(tuple, corpus_pipeline.run(spark, sf).collect())) == want and len(want) > 20
    spark.read.parquet(f"{sf}/documents.parquet").limit(0).write.parquet(f"{sf}/none/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{sf}/{name}.parquet").write.parquet(f"{sf}/none/{name}.parquet")
    assert corpus_pipeline.run(spark, f"{sf}/none").count() == 0


def test_pipeline(spark, sf_dir):
    import corpus_pipeline

    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    text = {r["doc_id"]: r["text"] for r in rows_of(sf_dir, "documents")}
    docs, columns = documents, documents.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir).cache()
        assert out.columns == columns and set(map(tuple, out.collect())) <= set(map(tuple, docs.collect())), name
        docs = out
    final = corpus_pipeline.run(spark, sf_dir).collect()
    assert {r["doc_id"] for r in final} == {r["doc_id"] for r in docs.collect()}
    assert all(r["decoded_sha256"] == hashlib.sha256(text[r["doc_id"]].encode()).hexdigest() for r in final)
