"""Operator 9: benchmark decontamination by greedy string tiling.

Tokens are lower-cased words.  Runs of five tokens of each benchmark item are
seeds, found in documents by a rolling Karp-Rabin hash.  Seeds that follow each
other on one diagonal make a match; the longest match is marked on both sides as
a tile, then the longest that is left unmarked, and so on down to five tokens.
Tiles may stand in another order than in the item, so a reordered passage is
caught.  A document is contaminated if tiles cover at least ``threshold`` of an
item's tokens.

Where texts repeat themselves so much that equal seeds are more than ``MANY``
pairs, matches are searched by length instead, in memory linear in both texts.

A benchmark of at most ``MOST_CHARS`` characters (checked) goes to all executors
and documents are read once, without a shuffle.  A larger one is joined on seed
hashes instead, by a number given to each row of either table and written once;
only documents that share one of an item's rarest seeds, of which every hit holds one, meet its
text.  Both ways give the same rows.

Defined results: null and empty texts and items match nothing; an item of three
or four tokens is matched whole, one of fewer only by a document of just these
tokens; equal items are reported each; ties between equally long matches go to the first place in the item, then
in the document; null ids and repeated rows are reported and removed row by row;
extra columns are ignored; empty tables give an empty result.  Documents are read whole.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchlake.llm.common import Memo, cut, small_batches

LEAST, THRESHOLD = 5, 0.8
#: Pairs of equal seeds that are held in memory at once.
MANY = 1_000_000
#: Characters of benchmark text that may be sent to every executor.
MOST_CHARS = 20_000_000
#: Shorter items are found only in documents of the same tokens.
SHORTEST = 3
HIT = "item_id long, coverage double, n_tiles int, longest int"
BASE = np.uint64(0x9E3779B97F4A7C15)
_word = re.compile(r"\w+")


def tokens(text: str | None) -> list[str]:
    return _word.findall(text.lower()) if text else []


def rolling(ids: np.ndarray, width: int = LEAST) -> np.ndarray:
    """Karp-Rabin hashes of all runs of ``width`` ids, modulo 2^64."""
    n = len(ids) - width + 1
    out = np.zeros(max(n, 0), np.uint64)
    for k in range(width if n > 0 else 0):
        out *= BASE
        out += ids[k : k + n]
    return out


def tiling(item: np.ndarray, doc: np.ndarray, pairs: tuple[np.ndarray, np.ndarray], least: int = LEAST) -> list[tuple[int, int, int]]:
    """Tiles (item position, document position, length), longest first.  pairs:
    positions of equal seeds in the item and in the document."""
    p, q = pairs
    same = np.ones(len(p), bool)
    for k in range(least):  # equal hashes are held against the tokens
        same &= item[p + k] == doc[q + k]
    p, q = p[same], q[same]
    if not len(p):
        return []
    order = np.lexsort((p, q - p))
    p, d = p[order], (q - p)[order]
    starts = np.flatnonzero(np.r_[True, (np.diff(d) != 0) | (np.diff(p) != 1)])
    lengths = np.diff(np.r_[starts, len(p)]) + least - 1
    heap = [(-n, a, a + s) for n, a, s in zip(lengths.tolist(), p[starts].tolist(), d[starts].tolist(), strict=True)]
    heapq.heapify(heap)
    on_item, on_doc, found = np.zeros(len(item), bool), np.zeros(len(doc), bool), []
    while heap:
        n, a, b = heapq.heappop(heap)
        n = -n
        taken = on_item[a : a + n] | on_doc[b : b + n]
        if not taken.any():
            on_item[a : a + n] = on_doc[b : b + n] = True
            found.append((a, b, n))
            continue
        edges = np.flatnonzero(np.diff(np.r_[True, taken, True].astype(np.int8)))
        for s, e in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            if e - s >= least:
                heapq.heappush(heap, (s - e, a + s, b + s))
    return found


def crowded(item: np.ndarray, doc: np.ndarray, least: int = LEAST) -> list[tuple[int, int, int]]:
    """The same tiles without a list of seed pairs: the greatest length that any
    unmarked run of both has is found by bisection on running hashes, its first
    place is marked, and so on."""
    sides = [item.astype(np.uint64), doc.astype(np.uint64)]
    n = max(map(len, sides))
    powers = np.cumprod(np.r_[np.uint64(1), np.full(n, BASE)])
    heads = []
    for x in sides:
        h = np.zeros(len(x) + 1, np.uint64)
        for i, v in enumerate(x.tolist()):
            h[i + 1] = (int(h[i]) * int(BASE) + v) & 0xFFFFFFFFFFFFFFFF
        heads.append(h)
    taken = [np.zeros(len(x), bool) for x in sides]

    def free(k: int, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts and hashes of the unmarked runs of one side."""
        sums = np.r_[0, np.cumsum(taken[k])]
        at = np.flatnonzero(sums[size:] == sums[:-size]) if size <= len(sides[k]) else np.zeros(0, np.int64)
        return at, heads[k][at + size] - heads[k][at] * powers[size]

    def first(size: int) -> tuple[int, int] | None:
        (p, h), (q, g) = free(0, size), free(1, size)
        known, where = np.unique(g, return_index=True)
        for i in np.flatnonzero(np.isin(h, known)).tolist():
            a, b = int(p[i]), int(q[where[np.searchsorted(known, h[i])]])
            if (sides[0][a : a + size] == sides[1][b : b + size]).all():
                return a, b
        return None

    found, most = [], min(map(len, sides))
    while most >= least:
        low, high, best = least, most, None
        while low <= high:
            size = (low + high) // 2
            if hit := first(size):
                best, low = (size, *hit), size + 1
            else:
                high = size - 1
        if best is None:
            break
        most, a, b = best
        taken[0][a : a + most] = taken[1][b : b + most] = True
        found.append((a, b, most))
    return found


class Index:
    """Seeds of a benchmark."""

    def __init__(self, items: list[tuple[int, str]], threshold: float):
        self.vocab: dict[str, int] = {}
        self.threshold = threshold
        self.items: list[tuple[int, np.ndarray]] = []
        self.short: dict[int, list[tuple[int, np.ndarray]]] = {}
        hashes, owners, places = [], [], []
        for item_id, text in items:
            ids = np.array([self.vocab.setdefault(w, len(self.vocab) + 1) for w in tokens(text)], np.uint64)
            if len(ids) >= LEAST:
                h = rolling(ids)
                hashes.append(h)
                owners.append(np.full(len(h), len(self.items)))
                places.append(np.arange(len(h)))
                self.items.append((item_id, ids))
            elif len(ids):
                self.short.setdefault(len(ids), []).append((item_id, ids))
        h = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        order = np.argsort(h, kind="stable")
        self.hashes = h[order]
        self.owner = (np.concatenate(owners) if hashes else np.zeros(0, int))[order]
        self.place = (np.concatenate(places) if hashes else np.zeros(0, int))[order]

    def hits(self, text: str | None) -> list[tuple[int, float, int, int]]:
        words = tokens(text)
        get = self.vocab.get
        ids = np.fromiter((get(w, 0) for w in words), np.uint64, len(words))
        return self._whole(ids) + self._tiled(ids)

    def _whole(self, ids: np.ndarray) -> list[tuple[int, float, int, int]]:
        """Items too short for a seed."""
        out = []
        for width, items in self.short.items():
            if len(ids) == width or (width >= SHORTEST and len(ids) > width):
                runs = np.lib.stride_tricks.sliding_window_view(ids, width)
                out += [(item_id, 1.0, 1, width) for item_id, item in items if (runs == item).all(axis=1).any()]
        return out

    def _tiled(self, ids: np.ndarray) -> list[tuple[int, float, int, int]]:
        if len(ids) < LEAST or not len(self.hashes):
            return []
        zeros = np.r_[0, np.cumsum(ids == 0)]
        at = np.flatnonzero(zeros[LEAST:] == zeros[:-LEAST])  # runs of known words only
        if not len(at):
            return []
        run = ids[at].copy()
        for k in range(1, LEAST):
            run *= BASE
            run += ids[at + k]
        lo, hi = np.searchsorted(self.hashes, run, "left"), np.searchsorted(self.hashes, run, "right")
        found = np.flatnonzero(hi > lo)
        if not len(found):
            return []
        lo, hi, at = lo[found], hi[found], at[found]
        many = hi - lo
        # Seeds that stand in the text, each once, and with them the items that may.
        _, once = np.unique(lo, return_index=True)
        met = _spans(lo[once], hi[once])
        owner, place = self.owner[met], self.place[met]
        order = np.argsort(owner, kind="stable")
        owner, place = owner[order], place[order]
        hopeful = [(i, p) for i, p in zip(*_groups(owner, place), strict=True) if self._may(i, p)]
        if not hopeful:
            return []
        few = many.sum() <= MANY
        if few:
            entry = _spans(lo, hi)
            doc_at, owner, place = np.repeat(at, many), self.owner[entry], self.place[entry]
            keep = np.isin(owner, [i for i, _ in hopeful])
            order = np.flatnonzero(keep)[np.argsort(owner[keep], kind="stable")]
            pairs = dict(zip(*_groups(owner[order], order), strict=True))
        out = []
        for i, _ in hopeful:
            item_id, item = self.items[i]
            tiles = tiling(item, ids, (place[pairs[i]], doc_at[pairs[i]])) if few else crowded(item, ids)
            covered = sum(n for _, _, n in tiles)
            if covered >= self.threshold * len(item):
                out.append((item_id, covered / len(item), len(tiles), tiles[0][2]))
        return out

    def _may(self, i: int, places: np.ndarray) -> bool:
        """Whether all seeds together cover enough: a bound of what tiles can."""
        n = len(self.items[i][1])
        bound = np.zeros(n, bool)
        for k in range(LEAST):
            bound[places + k] = True
        return bound.sum() >= self.threshold * n


def _spans(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """All numbers from lo to hi - 1, span by span."""
    many = hi - lo
    return np.repeat(lo, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)


def _groups(keys: np.ndarray, values: np.ndarray) -> tuple[list[int], list[np.ndarray]]:
    """Values by key; the keys are in order."""
    start = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[start].tolist(), np.split(values, start[1:])


NAMES = [x.split()[0] for x in HIT.split(", ")]
_ready: dict[int, Index] = {}


def hits(items: DataFrame, text: Column, threshold: float = THRESHOLD) -> Column:
    """Array of struct (item_id, coverage, n_tiles, longest) for a text.  Only
    for a benchmark of a checked size."""
    small_batches(items.sparkSession)
    rows = [(r[0], r[1]) for r in items.select("item_id", "text").where("text is not null").collect()]
    sent = items.sparkSession.sparkContext.broadcast(rows)
    key = hash((threshold, tuple(rows)))

    @F.pandas_udf(f"array<struct<{HIT.replace(', ', ',').replace(' ', ':')}>>")
    def found(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        if key not in _ready:
            _ready.clear()
            _ready[key] = Index(sent.value, threshold)
        index = _ready[key]
        for texts in parts:
            yield pd.Series([[dict(zip(NAMES, h, strict=True)) for h in index.hits(t)] for t in texts], dtype=object)

    return found(text)


def is_small(items: DataFrame, most: int = MOST_CHARS) -> bool:
    return (items.agg(F.sum(F.length("text") + 16)).first()[0] or 0) <= most


def contaminated(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, most: int = MOST_CHARS) -> DataFrame:
    """doc_id, item_id, coverage, n_tiles, longest for each contaminated pair."""
    docs, items = docs.select("doc_id", "text"), items.select("item_id", "text")
    if is_small(items, most):
        return docs.select("doc_id", F.explode(hits(items, F.col("text"), threshold)).alias("h")).select("doc_id", "h.*")
    docs, items = numbered(docs), numbered(items)
    found = _joined(docs, items, threshold).withColumnRenamed("item", "of")
    names = items.select(F.col("row").alias("of"), F.col("whole.item_id").alias("item_id"))
    return docs.select("row", F.col("whole.doc_id").alias("doc_id")).join(found, "row").join(names, "of").select("doc_id", *NAMES)


def clean(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, most: int = MOST_CHARS) -> DataFrame:
    """The rows of ``docs`` that no item contaminates, all columns kept."""
    if is_small(items, most):
        both = docs.select(F.struct("*").alias("doc"), hits(items, F.col("text"), threshold).alias("hits"))
        return both.where(F.size("hits") == 0).select("doc.*")
    docs = numbered(docs)
    found = _joined(docs, numbered(items.select("item_id", "text")), threshold)
    return docs.join(found.select("row").distinct(), "row", "left_anti").select("whole.*")


def numbered(df: DataFrame) -> DataFrame:
    """row, whole: the rows with a number each, written so that it stays."""
    return cut(df.select(F.monotonically_increasing_id().alias("row"), F.struct("*").alias("whole")))


def few_seeds(frequency: list[int], places: list[int], n: int, threshold: float, width: int = LEAST) -> list[int]:
    """Which of an item's seeds (by position in the lists) any hit must hold one of: the most
    frequent are left out as long as they alone can't cover the threshold of its ``n``
    tokens."""
    covered, kept = bytearray(n), []
    free = threshold * n - 1e-9
    total = 0
    for k in sorted(range(len(places)), key=lambda k: (-frequency[k], places[k])):
        window = [x for x in range(places[k], min(n, places[k] + width)) if not covered[x]]
        if total + len(window) < free:
            total += len(window)
            for x in window:
                covered[x] = 1
        else:
            kept.append(k)
    return kept


def _joined(docs: DataFrame, items: DataFrame, threshold: float) -> DataFrame:
    """The way for a benchmark of any size: join on seed hashes, then tile the
    pairs.  An item is looked up only by its rarest seeds: of the places where a hit's
    tiles start seeds, some must be among those, as the others don't cover
    enough.  So a passage that many items and documents share makes no pairs unless it
    is most of an item.  Both tables numbered; row, item (its row), coverage,
    n_tiles, longest."""
    docs = docs.select("row", F.col("whole.text").alias("text"))
    items = items.select(F.col("row").alias("item"), F.col("whole.text").alias("text"))
    small_batches(docs.sparkSession)
    ids = Memo(xxhash.xxh3_64_intdigest)

    def hashed(text):
        words = tokens(text)
        return np.fromiter(map(ids.__getitem__, words), np.uint64, len(words))

    def runs(found: np.ndarray, width: int) -> np.ndarray:
        return (rolling(found, width) + np.uint64(width * 0x9E3779B9)).view(np.int64)

    def of_items(parts):
        for part in parts:
            for item, text in zip(part["item"], part["text"], strict=True):
                found = hashed(text)
                if len(found):
                    seed = runs(found, min(len(found), LEAST))
                    yield pd.DataFrame({"item": item, "seed": seed, "place": np.arange(len(seed)), "n": len(found)})

    right = cut(items.mapInPandas(of_items, "item long, seed long, place long, n long"))
    # Widths of items, five at most.
    widths = sorted(r[0] for r in right.select(F.least("n", F.lit(LEAST))).distinct().collect())

    def of_docs(parts):
        for part in parts:
            for row, text in zip(part["row"], part["text"], strict=True):
                found = hashed(text)
                use = [w for w in widths if len(found) == w or (w >= SHORTEST and len(found) > w)]
                if use:
                    yield pd.DataFrame({"row": row, "seed": np.unique(np.concatenate([runs(found, w) for w in use]))})

    # Seeds of documents that some item has, and how many documents have them.
    left = cut(docs.mapInPandas(of_docs, "row long, seed long").join(right.select("seed").distinct(), "seed", "left_semi"))
    there = right.join(left.groupBy("seed").agg(F.count("*").alias("often")), "seed")
    lists = there.groupBy("item", "n").agg(F.collect_list(F.struct("seed", "place", "often")).alias("s")).select("item", "n", "s.seed", "s.place", "s.often")

    def rarest(parts):
        for part in parts:
            for item, n, seed, place, often in part.itertuples(index=False):
                kept = few_seeds(list(often), list(place), n, threshold) if n >= LEAST else range(len(seed))
                yield pd.DataFrame({"item": item, "seed": sorted({seed[k] for k in kept})}).astype("int64")

    pairs = left.join(lists.mapInPandas(rarest, "item long, seed long"), "seed").select("row", "item").distinct()
    texts = pairs.join(docs.withColumnRenamed("text", "doc"), "row").join(items.withColumnRenamed("text", "passage"), "item")

    def tile(parts):
        lately: dict[int, Index] = {}
        for part in parts:
            out = []
            for row, item, doc, passage in zip(part["row"], part["item"], part["doc"], part["passage"], strict=True):
                if item not in lately:
                    if len(lately) > 100:
                        lately.clear()
                    lately[item] = Index([(item, passage)], threshold)
                out += [(row, item, *hit) for _, *hit in lately[item].hits(doc)]
            yield pd.DataFrame(out, columns=["row", "item", *NAMES[1:]])

    return texts.mapInPandas(tile, "row long, item long, " + HIT.split(", ", 1)[1])
