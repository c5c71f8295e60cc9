"""Operator 13: spelling variants, by dynamic programming over sorted word lists.

The vocabulary is counted in the tasks first and added up by Spark.  Two words
one edit apart share their first or their last half, so each word goes to the lists of
its halves: those of its own length and those of words one shorter.  A list is sorted
and scanned once for all its words as queries.  The scan keeps the rows of the
edit matrices, three cells wide, for every prefix of the current word; the next word
goes on from the rows of the prefix that it shares with it, and once no query is
within one edit of a prefix, all words that begin with it are skipped.

Lists of more than ``LIST`` words are dealt into blocks and each pair of blocks is
scanned, so a task never holds more than two blocks; no pair is lost and each is
found in one list only.  A word's form is the most frequent near word, if that is
``TIMES`` as frequent; roots follow forms by pointer jumping.

Defined results: a null text holds no words; a null doc_id counts as the empty text
in the damage; repeated rows count each time; extra columns are ignored; texts are
read whole; an empty table gives an empty result; of equally frequent near words the
least in code-point order is the form.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchlake.llm.common import cut, small_batches

RUNS = re.compile("[A-Za-zÀ-ÿ]+")
LENGTH, OCCURRENCES, TIMES = 6, 5, 5
#: Of the words of a document, one in so many loses a code point.
DAMAGE = 199
#: Words in a block of a list, and words that a task counts before it hands them on.
LIST, HELD = 4096, 200_000


def lower(text: str) -> str:
    """A-Z in lower case, all else as it is."""
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def damaged_words(doc_id, text: str | None) -> Iterator[tuple[str, int]]:
    """(word, times) of a document, runs chosen by their hash one code point shorter."""
    name = "" if doc_id is None else str(doc_id)
    for run, times in Counter(RUNS.findall(lower(text or ""))).items():
        if len(run) < LENGTH:
            continue
        h = zlib.crc32(f"{name}:{run}".encode())
        if h % DAMAGE == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
        if len(run) >= LENGTH:
            yield run, times


def vocabulary(docs: DataFrame, words: Callable[[object, str | None], Iterator[tuple[str, int]]], least: int = OCCURRENCES) -> DataFrame:
    """(word, n) of the words that occur ``least`` times; ``words`` gives those of a document."""
    small_batches(docs.sparkSession)

    def count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: Counter[str] = Counter()
        out = lambda: pd.DataFrame({"word": list(held), "n": list(held.values())})
        for part in parts:
            for doc_id, text in zip(part["doc_id"], part["text"], strict=True):
                for word, times in words(None if pd.isna(doc_id) else int(doc_id), text):
                    held[word] += times
                if len(held) > HELD:
                    yield out()
                    held.clear()
        yield out()

    counted = docs.select("doc_id", "text").mapInPandas(count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def near_pairs(words: list[str], queries: list[str], shared: int) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``words`` and ``queries`` of the pairs exactly one edit apart.  Both
    are sorted, and all begin with the same ``shared`` code points, one at least."""
    codes = lambda ws, width: np.array([np.frombuffer(w.ljust(width, "\0").encode("utf-32-le"), np.uint32) for w in ws])
    width = max(map(len, [*words, *queries])) + 2
    listed, asked = codes(words, width), codes(queries, width)
    n, size, sizes = len(words), [len(w) for w in words], np.array([len(q) for q in queries])
    same = np.cumprod(listed[1:] == listed[:-1], axis=1, dtype=np.int64).sum(axis=1) if n > 1 else []
    lcp = [shared, *np.minimum(same, np.minimum(size[1:], size[:-1])).tolist()] if n > 1 else [shared]
    everyone = np.arange(len(queries))
    one, zero = np.ones(len(queries), np.int8), np.zeros(len(queries), np.int8)
    # rows[d]: queries within one edit of the word's first d code points, and their cells on
    # the diagonals -1, 0 and 1.
    rows: list[tuple[np.ndarray, ...]] = [(everyone, one, zero, one)] * (shared + 1)
    left, right, at = [], [], 0
    while at < n:
        word = listed[at]
        del rows[lcp[at] + 1 :]
        for d in range(len(rows) - 1, size[at]):
            who, low, mid, high = rows[d]
            differ = (asked[who, d - 1 : d + 2].T != word[d]).astype(np.int8)
            low = np.minimum(low + differ[0], mid + 1)
            mid = np.minimum(np.minimum(mid + differ[1], high + 1), low + 1)
            high = np.minimum(high + differ[2], mid + 1)
            alive = np.minimum(np.minimum(low, mid), high) <= 1
            if not alive.any():
                break
            rows.append((who[alive], low[alive], mid[alive], high[alive]))
        else:
            who, low, mid, high = rows[size[at]]
            step = sizes[who] - size[at]
            found = who[np.select([step == -1, step == 0, step == 1], [low, mid, high], 9) == 1]
            left.append(np.full(len(found), at))
            right.append(found)
            at += 1
            continue
        at += 1
        while at < n and lcp[at] > d:  # begins with what is too far from every query
            at += 1
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *left]), np.concatenate([none, *right])


def _found(words: list[str], counts: list[int], blocks: list[int], key: str, i: int, j: int) -> Iterator[tuple]:
    """(word, near words, occurrences of the most frequent, that word) of one list:
    its shortest words are looked up among all."""
    back, shortest = key[0] == "b", int(key[1 : key.index(":")])
    half = shortest // 2
    turn = (lambda w: w[::-1]) if back else (lambda w: w)
    sides = {b: sorted((turn(w), n) for w, n, x in zip(words, counts, blocks, strict=True) if x == b) for b in (i, j)}
    best: dict[str, list] = {}
    for one, two in dict.fromkeys([(i, j), (j, i)]):
        first, second = [x for x in sides[one] if len(x[0]) == shortest], sides[two]
        if not first or not second:
            continue
        found = near_pairs([w for w, _ in first], [w for w, _ in second], half)
        for p, q in zip(*(f.tolist() for f in found), strict=True):
            (x, n), (y, m) = first[p], second[q]
            if len(y) == shortest and y < x:  # comes the other way round too
                continue
            x, y = turn(x), turn(y)
            if back and x[:half] == y[:half]:  # is found by the first half
                continue
            for mine, other, times in ((x, y, m), (y, x, n)):
                row = best.setdefault(mine, [0, 0, ""])
                row[0] += 1
                if times > row[1] or times == row[1] and other < row[2]:
                    row[1:] = times, other
    for word, (near, n, form) in best.items():
        yield word, near, n, form


def near_words(vocab: DataFrame, most: int = LIST) -> DataFrame:
    """word, n_near, form_n and form (the most frequent near word) of the words that
    have one.  vocab: word, n; every word once, none shorter than two code points."""
    small_batches(vocab.sparkSession)
    size = F.length("word")
    lists = []
    for shortest in (size, size - 1):
        half = F.floor(shortest / 2).cast("int")
        lists += [F.concat(F.lit(side), shortest.cast("string"), F.lit(":"), part) for side, part in (("f", F.substring("word", F.lit(1), half)), ("b", F.right("word", half)))]
    dealt = vocab.select("word", "n", F.explode(F.array(*lists)).alias("key"))
    large = dealt.groupBy("key").agg(F.count("*").alias("size")).where(F.col("size") > most)
    dealt = dealt.join(large, "key", "left").withColumn("of", F.coalesce(F.ceil(F.col("size") / most), F.lit(1)).cast("int"))
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("word"), "of").cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("of") - 1))
    dealt = dealt.select("key", "word", "n", "block", other.alias("other"))
    i, j = F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")
    groups = dealt.groupBy("key", i, j).agg(F.collect_list(F.struct("word", "n", "block")).alias("of"), F.min(size).alias("least"))
    groups = groups.where((F.size("of") > 1) & F.startswith("key", F.concat(F.substring("key", 1, 1), F.col("least").cast("string"), F.lit(":"))))

    def scan(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = (r for g in part.itertuples(index=False) for r in _found(list(g.words), list(g.counts), list(g.blocks), g.key, g.i, g.j))
            yield pd.DataFrame(rows, columns=["word", "n_near", "form_n", "form"])

    flat = groups.select("key", "i", "j", F.col("of.word").alias("words"), F.col("of.n").alias("counts"), F.col("of.block").alias("blocks"))
    found = flat.mapInPandas(scan, "word string, n_near long, form_n long, form string")
    best = F.min(F.struct((-F.col("form_n")).alias("less"), "form")).alias("best")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select("word", "n_near", (-F.col("best.less")).alias("form_n"), "best.form")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): the end of each chain of (word, form).  A round doubles the length
    of the chains it follows; chains are short, as counts grow ``TIMES`` at each step."""
    now = cut(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("ahead"))
        now = cut(now.join(ahead, "root", "left").select("word", F.coalesce("ahead", "root").alias("root"), F.col("ahead").isNotNull().alias("moved")))
        if now.where("moved").isEmpty():
            return now.drop("moved")


def grouped(vocab: DataFrame, times: int = TIMES) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of a vocabulary (word, n)."""
    vocab = cut(vocab)
    judged = vocab.join(near_words(vocab), "word", "left").withColumn("has", F.col("form_n") >= times * F.col("n"))
    judged = cut(judged.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), *(F.when(F.col("has"), F.col(c)).alias(c) for c in ("form", "form_n"))))
    ends = roots(judged.where("form is not null"))
    return judged.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def variants(docs: DataFrame) -> DataFrame:
    """Spelling groups of the words of ``docs``, some of them damaged."""
    return grouped(vocabulary(docs, damaged_words))
