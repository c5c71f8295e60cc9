"""Operator 5: quality classifier on random Fourier features.

Each text is summed up in a few dozen statistics.  Random cosines of the
standardised statistics approximate a Gaussian kernel; ridge regression on them
is fitted from normal equations that every partition sums for itself and Spark
adds up.  Held-back training rows then give an isotonic map from ridge score to
the probability of label 1.

Texts are read once, in parallel; of all later steps only sums of a fixed size
(moments, normal equations, score bins) reach the driver.

Defined results: a null text counts as empty and is scored like any other; null
labels and labels other than 0 and 1 are left out; a doc_id with several labels
or several texts counts once for each pair; without both labels every score is
the share of label 1 (0.5 if there is none); null ids and repeated rows are
scored row by row; extra columns are ignored; an empty table gives an empty
result.  Texts are read whole.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchlake.llm.common import crc_mod, cut, small_batches

FEATURES, RIDGE, WIDTH, SEED = 192, 1e-3, 1.5, 5
BINS = 1024
MARKS = b"#%*&$!|.,;:?-_()[]{}<>=+/\\@~^'\""


def statistics(text: str | None) -> list[float]:
    """Statistics of one text; no words of any language are among them."""
    text = text or ""
    raw = np.bincount(np.frombuffer(text.encode("utf-8", "replace"), np.uint8), minlength=256)
    size = max(1, int(raw.sum()))
    words, lines = text.split(), text.split("\n")
    n = max(1, len(words))
    often = Counter(words)
    filled = [x for x in lines if x.strip()]
    upper, lower, digits = int(raw[65:91].sum()), int(raw[97:123].sum()), int(raw[48:58].sum())
    marks = raw[list(MARKS)]
    return [
        np.log1p(len(text)),
        np.log1p(len(words)),
        len(text) / n if words else 0.0,
        len(often) / n,
        max(often.values(), default=0) / n,
        sum(c for c in often.values() if c > 1) / n,
        np.log1p(len(lines)),
        len(filled) and 1 - len(set(filled)) / len(filled),
        len(filled) and max(Counter(filled).values()) / len(filled),
        len(filled) and sum(x.rstrip()[-1] in ".!?\"'" for x in filled) / len(filled),
        np.log1p(len(text) / max(1, len(filled))),
        upper / max(1, upper + lower),
        digits / size,
        int(raw[128:].sum()) / size,
        int(raw[:32].sum()) / size,
        *np.sqrt(marks / n).tolist(),
        float(np.sqrt(marks.sum() / n)),
    ]


N_STATISTICS = len(statistics(""))


def _statistics(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in parts:
        yield pd.Series([statistics(t) for t in texts], dtype=object)


def with_statistics(docs: DataFrame) -> DataFrame:
    """doc_id and ``x``, the statistics of the text."""
    small_batches(docs.sparkSession)
    return docs.select("doc_id", F.pandas_udf(_statistics, "array<double>")("text").alias("x"))


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray | None
    knots: np.ndarray
    levels: np.ndarray

    def cosines(self, x: np.ndarray) -> np.ndarray:
        """Random features of rows of statistics, and a constant."""
        make = np.random.default_rng(SEED)
        turn = make.standard_normal((N_STATISTICS, FEATURES)) / (WIDTH * np.sqrt(N_STATISTICS))
        shift = make.uniform(0, 2 * np.pi, FEATURES)
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        return np.hstack([np.sqrt(2 / FEATURES) * np.cos(z @ turn + shift), np.ones((len(x), 1))])

    def ridge(self, x: np.ndarray) -> np.ndarray:
        return self.cosines(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None or not len(self.knots):
            return np.full(len(x), self.levels[0])
        return np.clip(np.interp(self.ridge(x), self.knots, self.levels), 0.0, 1.0)


def _moments(train: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    parts = [f(F.col("x")[i]).alias(f"{n}{i}") for i in range(N_STATISTICS) for n, f in (("m", F.avg), ("s", F.stddev_pop))]
    row = train.agg(*parts).first()
    mean = np.array([row[f"m{i}"] or 0.0 for i in range(N_STATISTICS)])
    return mean, np.array([max(row[f"s{i}"] or 0.0, 1e-6) for i in range(N_STATISTICS)])


def _normal_equations(train: DataFrame, model: Model) -> np.ndarray:
    """Z'[Z y] over all rows: each partition adds up its own, Spark adds those."""
    size = FEATURES + 1

    def sums(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((size, size + 1))
        for part in parts:
            z = model.cosines(np.vstack(part["x"].to_numpy()))
            total += z.T @ np.hstack([z, part["y"].to_numpy(float)[:, None]])
        if total.any():
            yield pd.DataFrame({"row": np.arange(size), "cells": list(total)})

    rows = train.select("x", "y").mapInPandas(sums, "row int, cells array<double>")
    cells = rows.select("row", F.posexplode("cells").alias("col", "v")).groupBy("row", "col").agg(F.sum("v").alias("v"))
    out = np.zeros((size, size + 1))
    for r in cells.collect():  # (FEATURES + 1) x (FEATURES + 2) numbers, whatever the input
        out[r["row"], r["col"]] = r["v"]
    return out


def isotonic(x: np.ndarray, total: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: weighted places and levels of the blocks."""
    blocks: list[list[float]] = []
    for a, t, w in zip(x, total, weight, strict=True):
        blocks.append([a * w, t, w])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [p + q for p, q in zip(blocks[-1], last, strict=True)]
    place, level, w = np.array(blocks).T if blocks else np.zeros((3, 0))
    return place / w, level / w


def fit(stats: DataFrame, labels: DataFrame, learn: Column | None = None) -> Model:
    """stats: doc_id, x.  labels: doc_id, quality.  learn: which rows may be
    learned from; a fifth of those only set the isotonic map."""
    wanted = labels.select("doc_id", F.col("quality").cast("double").alias("y")).where("y in (0.0, 1.0)")
    train = stats.select("doc_id", "x").join(wanted, "doc_id")
    if learn is not None:
        train = train.where(learn)
    train = cut(train.withColumn("aside", F.crc32(F.concat(F.lit("aside"), F.col("doc_id").cast("string")).cast("binary")) % 5 == 0))
    first = train.agg(F.count("y"), F.coalesce(F.avg("y"), F.lit(0.5))).first()
    mean, scale = _moments(train)
    model = Model(mean, scale, None, np.zeros(0), np.array([first[1]]))
    if first[1] in (0.0, 1.0) or first[0] < 10:
        return model
    sums = _normal_equations(train.where("not aside"), model)
    count = max(1.0, sums[-1, -2])
    model.weights = np.linalg.solve(sums[:, :-1] + RIDGE * count * np.eye(FEATURES + 1), sums[:, -1])

    @F.pandas_udf("double")
    def ridge(x: pd.Series) -> pd.Series:
        return pd.Series(model.ridge(np.vstack(x.to_numpy())) if len(x) else [], dtype=float)

    at = F.floor((F.least(F.greatest(ridge("x"), F.lit(-0.5)), F.lit(1.5)) + 0.5) * (BINS / 2)).cast("int")
    bins = train.where("aside").groupBy(at.alias("bin")).agg(F.sum("y").alias("y"), F.count("y").alias("n")).orderBy("bin").collect()
    if bins:
        x, y, n = np.array([[(r["bin"] + 0.5) / (BINS / 2) - 0.5, r["y"], r["n"]] for r in bins]).T
        model.knots, model.levels = isotonic(x, y, n)
    return model


def score(model: Model, x: Column) -> Column:
    """The probability of label 1."""

    @F.pandas_udf("double")
    def scores(x: pd.Series) -> pd.Series:
        return pd.Series(model.score(np.vstack(x.to_numpy())) if len(x) else [], dtype=float)

    return scores(x)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted; labels are learned only from rows whose
    crc32(doc_id as text) mod 3 is not 1."""
    stats = cut(with_statistics(docs))
    fold = crc_mod(F.col("doc_id"), 3)
    scored = stats.select("doc_id", (fold == 1).alias("held_out"), score(fit(stats, labels, fold != 1), F.col("x")).alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the classifier accepts, all columns kept.  The
    statistics are worked out again for the decision: that costs less than to
    shuffle all texts to meet their scores."""
    model = fit(cut(with_statistics(docs)), labels, crc_mod(F.col("doc_id"), 3) != 1)
    both = docs.select(F.struct("*").alias("doc"), score(model, F.pandas_udf(_statistics, "array<double>")("text")).alias("score"))
    return both.where("score >= 0.5").select("doc.*")
