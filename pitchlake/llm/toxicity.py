"""Operator 11: toxicity, by Levenshtein automata run over a lexicon trie.

The lexicon is learned from labels: words, and stems that other words begin with,
which toxic texts hold more often than clean ones, by a margin that chance does not
explain.  The trie of the lexicon and the Levenshtein automata of its terms (one edit
from ``SHORT`` code points on, two from ``LONG``) are intersected into one automaton,
made deterministic state by state as texts ask for it.  It tells of each word whether it is a
term, begins with a stem, or is a misspelled term; most words leave it after a
few letters.

A hit weighs what its term's odds say, less if misspelled, and by its context: inside
quotation marks or after words of reporting within ``WINDOW`` words it is most likely a
quotation and counts little, next to words of address it counts more.  What misspelled hits of a
term are worth is learned too, so a term near common words loses them.  A
logistic regression over sum, largest, density and number of hits gives the score.

Lexicon and regression are fitted on at most about ``SAMPLE`` labelled texts of each
class, chosen by the hash of the id and without exact copies, two thirds for the lexicon
and a third for the regression.  Every text is scored, whole, without a shuffle.

Defined results: a null text counts as empty, and an empty text is scored as one
without hits; null labels and others than 0 and 1 are left out; null ids are scored and
never learned from; repeated rows are scored row by row; without both labels or
without a lexicon every score is the share of label 1 (0.5 if there is none); extra columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchlake.llm.common import crc_mod, cut, small_batches

SAMPLE, TERMS = 12_000, 4096
#: A term needs so many toxic texts, log odds and standard errors; stems are so long.
TEXTS, ODDS, ERRORS, STEM = 3, 0.7, 2.0, 4
SHORT, LONG, STATES = 5, 9, 50_000
MISSPELLED, LEAST, QUOTED, ADDRESSED, WINDOW = 0.8, 0.1, 0.2, 1.25, 6
RIDGE, LIMIT = 0.5, 0.7
#: Words, with marks that stand for letters inside them.
WORD = re.compile(r"\w+(?:[*@$!]+\w+)*")
QUOTATION = re.compile(r"\"[^\"\n]{1,400}\"|“[^”\n]{1,400}”|„[^“”\n]{1,400}[“”]|«[^»\n]{1,400}»|‘[^’\n]{1,400}’|(?m:^>.*$)")
#: Words of reporting and of address in four languages.
REPORTING = frozenset("said says say called calls calling wrote writes quote quoted quotes word term sagte sagt nannte nennt schrieb zitat wort dit appelé écrit cite mot terme dijo dice llamó escribió cita palabra".split())
ADDRESS = frozenset("you your you're u du dich dir dein deine ihr euch tu te toi ton vous votre tú ti usted ustedes vosotros".split())


def fuzz(term: str) -> int:
    return (len(term) >= SHORT) + (len(term) >= LONG)


@dataclass
class Lexicon:
    """terms: (text, is a stem, weight, weight if misspelled).  Stems, and terms that
    are worth nothing misspelled, are found as they are only."""

    terms: list[tuple[str, bool, float, float]]
    children: list[dict[str, int]] = field(default_factory=lambda: [{}])
    word: dict[int, int] = field(default_factory=dict)
    stem: dict[int, int] = field(default_factory=dict)
    most: list[int] = field(default_factory=lambda: [0])
    edits: list[int] = field(default_factory=list)

    def __post_init__(self):
        for k, (text, is_stem, _, misspelled) in enumerate(self.terms):
            node, edits = 0, 0 if is_stem or misspelled < LEAST else fuzz(text)
            self.edits.append(edits)
            self.most[0] = max(self.most[0], edits)
            for c in text:
                if (to := self.children[node].get(c)) is None:
                    to = self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.most.append(0)
                node = to
                self.most[node] = max(self.most[node], edits)
            (self.stem if is_stem else self.word)[node] = k
        self._restart()

    def _restart(self) -> None:
        self.states: dict = {}
        self.start = self._state({0: 0}, None)

    def _state(self, at: dict[int, int], deep: int | None) -> dict:
        """A state: least edits by node, and the longest stem passed.  Terms' code
        points may be left out at any node, which needs no letter."""
        todo = list(at)
        while todo:
            node = todo.pop()
            if (edits := at[node] + 1) <= self.most[node]:
                for to in self.children[node].values():
                    if edits <= self.most[to] and edits < at.get(to, 9):
                        at[to] = edits
                        todo.append(to)
        key = (frozenset(at.items()), deep)
        if (state := self.states.get(key)) is None:
            ends = [(e, -self.terms[k][2], k) for node, e in at.items() if (k := self.word.get(node)) is not None and e <= self.edits[k]]
            best = min(ends, default=None)
            if best and not best[0] or best and deep is None:
                result = best[2], best[0]
            else:
                result = None if deep is None else (deep, 0)
            # What follows is found by letter; under the empty text, the result if the word ends here.
            state = self.states[key] = {"": result, None: (at, deep)} if at or deep is not None else {"": None}
        return state

    def _step(self, state: dict, c: str) -> dict:
        at, deep = state[None]
        to: dict[int, int] = {}
        for node, edits in at.items():
            if edits == 0 and node in self.stem:
                deep = self.stem[node]
            if (child := self.children[node].get(c)) is not None and edits < to.get(child, 9):
                to[child] = edits
            if edits < self.most[node]:
                if edits + 1 < to.get(node, 9):
                    to[node] = edits + 1
                for child in self.children[node].values():
                    if edits + 1 <= self.most[child] and edits + 1 < to.get(child, 9):
                        to[child] = edits + 1
        return self._state(to, deep)

    def find(self, word: str) -> tuple[int, int] | None:
        """(term, edits), or None."""
        state = self.start
        for c in word:
            if (to := state.get(c)) is None:
                if None not in state:
                    return state[""]
                if len(self.states) > STATES:  # begin anew rather than grow without end
                    at, deep = state[None]
                    self._restart()
                    state = self._state(dict(at), deep)
                to = state[c] = self._step(state, c)
            state = to
        return state[""]

    def hits(self, text: str | None) -> tuple[list[tuple[int, int, str]], int]:
        """((term, edits, context), number of words) of a text."""
        text = (text or "").lower()
        words = WORD.findall(text)
        found = {w: hit for w in set(words) if (hit := self.find(w)) is not None}
        if not found:
            return [], len(words)
        quoted = [m.span() for m in QUOTATION.finditer(text)] if re.search("[\"“„«‘>]", text) else []
        out, next_quote = [], 0
        for i, m in enumerate(WORD.finditer(text)):
            if (hit := found.get(m[0])) is None:
                continue
            while next_quote < len(quoted) and quoted[next_quote][1] <= m.start():
                next_quote += 1
            inside = next_quote < len(quoted) and quoted[next_quote][0] <= m.start()
            before, around = words[max(0, i - WINDOW) : i], words[max(0, i - WINDOW // 2) : i + WINDOW // 2 + 1]
            context = "quoted" if inside or not REPORTING.isdisjoint(before) else "addressed" if not ADDRESS.isdisjoint(around) else "plain"
            out.append((*hit, context))
        return out, len(words)

    def statistics(self, text: str | None) -> tuple[np.ndarray, int, int, int]:
        """What the regression reads, and hits: all, misspelled, quoted.  A term counts
        once, at its heaviest."""
        found, n = self.hits(text)
        worth: dict[int, float] = {}
        for k, edits, context in found:
            w = self.terms[k][3] if edits else self.terms[k][2]
            w *= {"quoted": QUOTED, "addressed": ADDRESSED}.get(context, 1.0)
            worth[k] = max(worth.get(k, 0.0), w)
        total = sum(worth.values())
        strong = sum(w >= ODDS for w in worth.values())
        x = np.array([1.0, np.log1p(total), max(worth.values(), default=0.0), np.log1p(100 * total / (n + 20)), np.log1p(strong)])
        return x, len(found), sum(e > 0 for _, e, _ in found), sum(c == "quoted" for *_, c in found)


#: The automaton of the last lexicon asked for, kept by a worker from task to task.
_last: dict[int, Lexicon] = {}


def automaton(terms: list[tuple[str, bool, float, float]]) -> Lexicon:
    key = hash(tuple(terms))
    if key not in _last:
        _last.clear()
        _last[key] = Lexicon(terms)
    return _last[key]


@dataclass
class Model:
    lexicon: Lexicon
    weights: np.ndarray | None
    share: float

    def score(self, x: np.ndarray) -> float:
        return self.share if self.weights is None else float(1 / (1 + np.exp(-np.clip(x @ self.weights, -30, 30))))


def sample(docs: DataFrame, labels: DataFrame, learn: Column) -> DataFrame:
    """text, y, aside of the labelled texts that are learned from.  The chosen labels
    are bounded (about ``SAMPLE`` a class), so they are broadcast and no text is shuffled
    but the chosen ones."""
    known = labels.select("doc_id", F.col("toxic").cast("int").alias("y")).where(F.col("y").isin(0, 1) & F.col("doc_id").isNotNull() & learn).distinct()
    known = known.withColumn("place", F.pmod(F.xxhash64(F.lit("toxic"), "doc_id"), F.lit(1 << 20)))
    count = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    below = {y: int((1 << 20) * min(1.0, SAMPLE / n)) for y, n in count.items()}
    chosen = known.where(F.col("place") < F.when(F.col("y") == 1, below.get(1, 0)).otherwise(below.get(0, 0)))
    aside = F.crc32(F.concat(F.lit("aside"), F.col("doc_id").cast("string")).cast("binary")) % 3 == 0
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen.drop("place")), "doc_id").select(F.coalesce("text", F.lit("")).alias("text"), "y", aside.alias("aside"))
    return cut(texts.withColumn("hash", F.xxhash64("text")).dropDuplicates(["hash", "y"]).drop("hash"))


def _pieces(text: str) -> set[str]:
    """Words of a text, and with a star the stems they begin with."""
    words = set(WORD.findall(text.lower()))
    return words | {f"{w[:k]}*" for w in words for k in range(STEM, min(len(w), 24))}


def learn_lexicon(texts: DataFrame) -> tuple[Lexicon, int, int]:
    """Lexicon, numbers of toxic and clean texts.  texts: text, y."""

    def count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = {0: Counter(), 1: Counter()}
        out = lambda: pd.concat([pd.DataFrame({"piece": list(c), "y": y, "n": list(c.values())}) for y, c in held.items()])
        for part in parts:
            for text, y in zip(part["text"], part["y"], strict=True):
                held[y].update(_pieces(text))
                if len(held[0]) + len(held[1]) > 300_000:
                    yield out()
                    held[0].clear(), held[1].clear()
        yield out()

    size = {r["y"]: r["n"] for r in texts.groupBy("y").agg(F.count("*").alias("n")).collect()}
    toxic, clean = size.get(1, 0), size.get(0, 0)
    if not toxic or not clean:
        return Lexicon([]), toxic, clean
    n = lambda y: F.sum(F.when(F.col("y") == y, F.col("n")).otherwise(0))
    pieces = texts.select("text", "y").mapInPandas(count, "piece string, y int, n long").groupBy("piece").agg(n(1).alias("a"), n(0).alias("b")).where(F.col("a") >= TEXTS)
    a, b = F.col("a") + 0.5, F.col("b") + 0.5
    odds = F.log(a / (toxic + 1)) - F.log(b / (clean + 1)) - ERRORS * F.sqrt(1 / a + 1 / b)
    best = pieces.withColumn("w", odds).where(F.col("w") >= ODDS).orderBy(F.desc(F.col("w") * F.col("a")), "piece").limit(TERMS).collect()
    # Of a stem and what it says of the same texts, the longer is the term.
    found, longer = [], {}
    for r in sorted(best, key=lambda r: (-len(r["piece"].rstrip("*")), r["piece"])):
        text, counts = r["piece"].rstrip("*"), (r["a"], r["b"])
        is_stem = r["piece"].endswith("*")
        if not (is_stem and any(x.startswith(text) for x in longer.get(counts, ()))):
            longer.setdefault(counts, []).append(text)
            found.append((text, is_stem, r["w"], MISSPELLED * r["w"]))
    return Lexicon(found), toxic, clean


def weigh_misspelled(texts: DataFrame, lexicon: Lexicon, toxic: int, clean: int) -> Lexicon:
    """The lexicon with weights for misspelled hits: a share of the term's, and no
    more than the odds of the texts that have such hits."""
    terms = lexicon.terms

    def count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, own = Counter(), automaton(terms)
        for part in parts:
            for text, y in zip(part["text"], part["y"], strict=True):
                held.update((k, y) for k in {k for k, edits, _ in own.hits(text)[0] if edits})
        yield pd.DataFrame([(k, y, n) for (k, y), n in held.items()], columns=["k", "y", "n"])

    seen = {(r["k"], r["y"]): r["n"] for r in texts.select("text", "y").mapInPandas(count, "k int, y int, n long").groupBy("k", "y").agg(F.sum("n").alias("n")).collect()}
    odds = lambda k: np.log((seen.get((k, 1), 0) + 1) / (toxic + 1)) - np.log((seen.get((k, 0), 0) + 0.2) / (clean + 1))
    return Lexicon([(text, is_stem, w, float(np.clip(odds(k), 0.0, MISSPELLED * w))) for k, (text, is_stem, w, _) in enumerate(terms)])


def regression(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Ridge logistic regression by Newton steps; the constant is not shrunk."""
    w, shrink = np.zeros(x.shape[1]), RIDGE * np.diag([0.0, *np.ones(x.shape[1] - 1)])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + shrink + 1e-9 * np.eye(len(w)), x.T @ (y - p) - shrink @ w)
        w += np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, learn: Column) -> Model:
    """docs: doc_id, text.  labels: doc_id, toxic; of those ``learn`` is true for."""
    small_batches(docs.sparkSession)
    texts = sample(docs, labels, learn)
    lexicon, toxic, clean = learn_lexicon(texts.where("not aside"))
    row = texts.agg(F.coalesce(F.avg("y"), F.lit(0.5))).first()
    if not lexicon.terms:
        return Model(lexicon, None, row[0])
    lexicon = weigh_misspelled(texts.where("not aside"), lexicon, toxic, clean)
    terms = lexicon.terms

    @F.pandas_udf("array<double>")
    def statistics(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = automaton(terms)
        for part in parts:
            yield pd.Series([own.statistics(t)[0].tolist() for t in part], dtype=object)

    rows = texts.where("aside").select(statistics("text").alias("x"), "y").collect()  # the bounded sample's five numbers each
    y = np.array([r["y"] for r in rows], float)
    if not 0 < y.sum() < len(y):
        return Model(lexicon, None, row[0])
    return Model(lexicon, regression(np.array([r["x"] for r in rows]), y), row[0])


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, n_hits, n_misspelled, n_quoted; labels are learned
    only from rows whose crc32(doc_id as text) mod 3 is not 1."""
    fold = crc_mod(F.col("doc_id"), 3)
    model = fit(docs, labels, fold != 1)
    terms, weights, share = model.lexicon.terms, model.weights, model.share

    @F.pandas_udf("score double, n_hits long, n_misspelled long, n_quoted long")
    def judge(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = Model(automaton(terms), weights, share)
        for part in parts:
            rows = [(own.score(x), *n) for x, *n in map(own.lexicon.statistics, part)]
            yield pd.DataFrame(rows, columns=["score", "n_hits", "n_misspelled", "n_quoted"])

    judged = docs.select("doc_id", (fold == 1).alias("held_out"), judge("text").alias("j"))
    return judged.select("doc_id", "held_out", "j.score", F.when(F.col("j.score") >= LIMIT, 1).otherwise(0).alias("predicted"), "j.n_hits", "j.n_misspelled", "j.n_quoted")
