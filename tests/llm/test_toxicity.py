"""Toxicity against brute force and held-out labels."""

import random

import pytest
from pyspark.sql import functions as F

from pitchlake.llm import queries, toxicity
from pitchlake.llm.toxicity import Lexicon


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(last + (x != y), row[j] + 1, row[j - 1] + 1)
    return row[-1]


def brute(terms, word):
    """(weight, edits) of what a word is: a term, else begins with the longest stem, else misspelled."""
    ends = [(distance(t, word), -w) for t, stem, w, m in terms if not stem and distance(t, word) <= (toxicity.fuzz(t) if m >= toxicity.LEAST else 0)]
    stems = [(len(t), w) for t, stem, w, _ in terms if stem and word.startswith(t) and word != t]
    best = min(ends, default=None)
    if best and not best[0]:
        return -best[1], 0
    if stems:
        return max(stems)[1], 0
    return (-best[1], best[0]) if best else None


@pytest.mark.parametrize("states", [50_000, 3])
def test_automaton_equals_brute_force(monkeypatch, states):
    monkeypatch.setattr(toxicity, "STATES", states)
    r = random.Random(states)
    for _ in range(40):
        made = {("".join(r.choice("abc") for _ in range(r.randrange(2, 12))), r.random() < 0.2): r.random() for _ in range(r.randrange(1, 15))}
        terms = [(t, s, w, r.choice([0.0, 0.8 * w + 0.1])) for (t, s), w in made.items()]
        lexicon = Lexicon(terms)
        for _ in range(80):
            word = "".join(r.choice("abcd") for _ in range(r.randrange(0, 13)))
            hit = lexicon.find(word)
            assert (None if hit is None else (terms[hit[0]][2], hit[1])) == brute(terms, word)


def test_contexts():
    lexicon = Lexicon([("moron", False, 2.0, 1.6), ("worthless", False, 3.0, 2.4), ("scum", False, 2.0, 1.6), ("achlich", True, 2.0, 0.0)])
    kinds = lambda text: [(lexicon.terms[k][0], e, c) for k, e, c in lexicon.hits(text)[0]]
    assert kinds("What a M0RON, a wortless one, plain scun") == [("moron", 1, "plain"), ("worthless", 1, "plain")]
    assert kinds('A "moron", and the word moron. Filler goes on for a while here, moron.') == [("moron", 0, "quoted"), ("moron", 0, "quoted"), ("moron", 0, "plain")]
    assert kinds("you are scum") == [("scum", 0, "addressed")] and kinds("„scum“ «scum»\n> old scum\nscum") == [("scum", 0, "quoted")] * 3 + [("scum", 0, "plain")]
    assert kinds("achlichen achlich mor*n") == [("achlich", 0, "plain"), ("moron", 1, "plain")] and kinds(None) == kinds("") == []
    heavy = lambda text: lexicon.statistics(text)[0][1]
    assert heavy("the moron spoke") > heavy("the mroon moran spoke") > heavy('they said "moron" there') > heavy("they spoke") == 0


def test_odd_rows(spark, docs):
    labels = spark.createDataFrame([(1, 0), (5, 1), (6, None), (7, 3), (None, 1), (8, 0), (8, 0)], "doc_id long, toxic int").withColumn("text", F.lit("x"))
    got = toxicity.classify(docs, labels).collect()
    assert len(got) == docs.count() and all(0 <= r["score"] <= 1 for r in got) and {r["predicted"] for r in got} == {0}
    assert toxicity.classify(docs.limit(0), labels).count() == 0
    none = toxicity.classify(docs, labels.limit(0)).collect()
    assert {(r["score"], r["n_hits"]) for r in none} == {(0.5, 0)}
    assert {r["score"] for r in toxicity.classify(docs, labels.where("doc_id is not null").withColumn("toxic", F.lit(1))).collect()} == {1.0}


def test_long_texts():
    lexicon = Lexicon([("moron", False, 2.0, 1.6)])
    x, n, misspelled, _ = lexicon.statistics("moran word " * 100_000 + "q" * 1_000_000)
    assert n == misspelled == 100_000 and x[2] == 1.6


def test_held_out(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = queries.op11_toxicity(spark, sf)
    assert got.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    judged = got.join(labels.where("toxic is not null"), "doc_id").join(docs.where("length(text) > 0").select("doc_id", "lang"), "doc_id")
    held = judged.where("held_out").groupBy("toxic", (F.col("lang") == "en").alias("en")).agg(F.avg("predicted").alias("p")).collect()
    share = {(r["toxic"], r["en"]): r["p"] for r in held}
    assert share[1, True] > 0.9 and share[1, False] > 0.5 and share[0, True] < 0.01 and share[0, False] < 0.02


def test_misspelled_terms_are_caught_and_quotations_are_not(spark):
    r = random.Random(9)
    filler = ["river", "table", "window", "garden", "letter", "music", "paper", "summer", "bridge", "stone", "cloud", "forest"]
    rows, labels = [], []
    for i in range(900):
        words = r.choices(filler, k=40)
        if toxic := i % 5 == 0:
            for t in r.sample(["disgusting", "worthless", "stupid", "pathetic"], 3):
                words.insert(r.randrange(30), t)
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    plain = " ".join(r.choices(filler, k=30))
    rows += [(1000, plain + " stupit worthles disgustng"), (1001, plain + ' "stupid" "worthless"'), (1002, plain)]
    got = toxicity.classify(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")).where("doc_id >= 1000").collect()
    by = {x["doc_id"]: x for x in got}
    assert by[1000]["predicted"] == 1 and by[1000]["n_misspelled"] == 3
    assert by[1001]["predicted"] == 0 and by[1001]["n_quoted"] == 2 and by[1002]["score"] <= by[1001]["score"] < by[1000]["score"]
