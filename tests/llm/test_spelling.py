"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter, defaultdict

from pitchlake.llm import spelling


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_vocabulary(rows):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            n[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 199 == 0 else run] += 1
    return {w: k for w, k in n.items() if len(w) >= 6 and k >= 5}


def brute_groups(n):
    """By the words that are left when one code point is taken out."""
    spots = defaultdict(set)
    for w in n:
        spots[w].add(w)
        for i in range(len(w)):
            spots[w[:i] + w[i + 1 :]].add(w)
    out, form = {}, {}
    for w in n:
        near = {x for k in [w, *(w[:i] + w[i + 1 :] for i in range(len(w)))] for x in spots[k] if one_edit(w, x)}
        best = min(near, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None
        out[w] = len(near)
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        yield w, form[w], root, n[w], out[w], n[form[w]] if form[w] is not None else None


def test_pairs_equal_brute_force():
    r = random.Random(3)
    for _ in range(60):
        words = sorted({"xy" + "".join(r.choice("abc") for _ in range(r.randrange(0, 7))) for _ in range(r.randrange(1, 60))})
        asked = sorted({"xy" + "".join(r.choice("abc") for _ in range(r.randrange(0, 7))) for _ in range(r.randrange(1, 60))})
        a, b = spelling.near_pairs(words, asked, 2)
        want = sorted((x, y) for x in words for y in asked if one_edit(x, y))
        assert sorted((words[p], asked[q]) for p, q in zip(a, b, strict=True)) == want


def test_near_words_in_blocks(spark):
    r = random.Random(4)
    n = {"".join(r.choice("abé") for _ in range(r.randrange(2, 9))): r.randrange(1, 900) for _ in range(500)}
    df = spark.createDataFrame(list(n.items()), "word string, n long")
    near = {w: [x for x in n if one_edit(w, x)] for w in n}
    want = {(w, len(xs), max(n[x] for x in xs), min(xs, key=lambda x: (-n[x], x))) for w, xs in near.items() if xs}
    for most in (4096, 7):
        assert set(map(tuple, spelling.near_words(df, most).collect())) == want


def test_odd_rows(spark):
    rows = [
        (1, "Colour colour COLOUR " * 9 + "colours " * 9, 0), (2, "colour, colr. côlour " * 6, 1), (None, "colour " * 5, 2), (3, None, 3), (4, "", 4),
        (5, "ÉCOLES écoles Écoles école× Straße straße " * 3, 5), (5, "ÉCOLES écoles Écoles école× Straße straße " * 3, 5), (6, "a" * 30_000 + " " + ("z" * 3000 + " ") * 6, 6),
        (7, "z" * 2999 + "y " + ("z" * 2999 + "y ") * 40, 7), (8, " ".join(["colour"] * 200_000), 8), (9, "word_word 12345 😀 abc-def", 9),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, n int").selectExpr("*", "n AS word", "n AS form", "n AS key")
    got = [tuple(x) for x in spelling.variants(df).collect()]
    want = list(brute_groups(brute_vocabulary((a, b) for a, b, _ in rows)))
    assert len(got) == len(want) > 5 and set(got) == set(want)
    assert spelling.variants(df.limit(0)).count() == 0 and spelling.variants(df).columns == ["word", "form", "root", "n", "n_near", "form_n"]


def test_roots_follow_chains(spark):
    chain = [(f"w{i}", f"w{i + 1}") for i in range(13)] + [("x", "w5"), ("y", "z")]
    got = dict(map(tuple, spelling.roots(spark.createDataFrame(chain, "word string, form string")).collect()))
    assert got == {w: "z" if w == "y" else "w13" for w, _ in chain}


def test_variants_equal_brute_force(spark, sf_dir):
    import pyarrow.parquet as pq

    from pitchlake.llm import queries

    rows = [(r["doc_id"], r["text"]) for r in pq.read_table(f"{sf_dir}/documents.parquet").to_pylist()]
    got = [tuple(x) for x in queries.op13_spelling(spark, sf_dir).collect()]
    want = list(brute_groups(brute_vocabulary(rows)))
    assert len(got) == len(want) > 100 and set(got) == set(want) and any(x[1] for x in want)
