"""Operator 10: near-duplicate texts by Order MinHash and banded alignment.

A text's words are cut into runs of five.  Each run carries the number of its
occurrence, so repeated runs differ.  A sketch is the few labelled runs that are
least under one random order, kept in the order of the text; equal sketches
therefore speak for a small edit distance and not only for shared words.  There
are sketches of two runs, and some of one run for heavily edited texts; texts of
at most ``SHORT`` words also have some of shorter runs, of which an edit spoils
fewer.  Texts that agree in one sketch (a bucket) are candidates.

Every text of a bucket is first held against the bucket's least text, which unites
most copies in pairs linear in the rows.  Buckets that still hold several classes
go on: their text of most accepted pairs is held against the others, and in the
end all pairs of different classes are, in blocks, so that every two texts of a
bucket are in one class or were compared.  There, counts of words (128 bins of
them) bound the edits from below, and pairs never leave their block.  A candidate pair
is accepted if a banded alignment of its words needs at most (1 - similarity)
edits for each word of the longer text.  Components of accepted pairs are the
classes.

Copies (equal words, whatever the white space and case) are one node throughout.
A large bucket is dealt over several tasks: least texts and counts are added up
before the shuffle, and what is known of a bucket is sent to as many tasks as its
rows are dealt to.  All-pairs blocks stay quadratic in a bucket of many
texts that are unlike each other.

Defined results: null and empty texts, and texts of white space, are a class of
their own each; texts shorter than a run count as one run; a null doc_id never
names a class unless all of the class have none; repeated rows are kept and share
a class; ties fall to the least doc_id; extra columns are ignored; an empty table
gives an empty result.  Texts are read and aligned whole.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchlake.llm.common import cut, delete_folder, shared_folder, small_batches
from pitchlake.llm.components import components

RUN, SIMILARITY = 5, 0.8
#: Sketches of so many runs each; those of short texts are of runs of two words.
PAIRS, SINGLES, SHORT, SHORT_RUN, SHORT_SINGLES = 24, 8, 30, 2, 12
#: Rows of a bucket that one task compares at once.
BLOCK = 500
#: A block's key.
BLOCK_KEY = ["bucket", "i", "j"]
#: Rows of small blocks that a task looks through at once, and pairs of them.
TOGETHER, CHUNK = 5000, 50_000
#: Rows of a bucket that one task of a join takes.
SLICE = 2000
#: Bins of a text's counts of words.
BINS = 128
#: Tasks over which the rows of one class are dealt when it is named.
SALT = 32
MIX = np.uint64(0x9E3779B97F4A7C15)


def scrambled(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads all bits."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def hashes(words: list[str]) -> np.ndarray:
    """A 64-bit number of each word.  To hash a word takes less time than to look
    it up among many."""
    return np.frombuffer(b"".join(map(xxhash.xxh3_64_digest, words)), ">u8").astype(np.uint64)


class Sketcher:
    def __init__(self):
        make = np.random.default_rng(10)
        n = PAIRS + SINGLES + SHORT_SINGLES
        self.turns = make.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.names = make.integers(0, 1 << 63, n, dtype=np.uint64)

    @staticmethod
    def ids(words: list[str]) -> np.ndarray:
        return hashes(words)

    @staticmethod
    def runs(ids: np.ndarray, run: int = RUN) -> np.ndarray:
        """Hashes of the labelled runs of words, in the order of the text."""
        width = min(run, len(ids))
        n = len(ids) - width + 1
        h = np.zeros(n, np.uint64)
        for k in range(width):
            h = (h ^ ids[k : k + n]) * MIX
            h ^= h >> np.uint64(29)
        s = np.sort(h)
        if (s[1:] == s[:-1]).any():
            order = np.argsort(h, kind="stable")
            first = np.r_[True, s[1:] != s[:-1]]
            start = np.maximum.accumulate(np.where(first, np.arange(n), 0))
            label = np.empty(n, np.uint64)
            label[order] = (np.arange(n) - start).astype(np.uint64)
            h = h + label * np.uint64(0xD6E8FEB86659FD93)
        return scrambled(h)

    @staticmethod
    def bag(ids: np.ndarray) -> bytes:
        """Counts of words in bins, 255 at most.  One edit changes the sum of
        the differences of two bags by two at most."""
        counts = np.bincount((scrambled(ids) % np.uint64(BINS)).astype(np.int64), minlength=BINS)
        return np.minimum(counts, 255).astype(np.uint8).tobytes()

    def least(self, runs: np.ndarray, at: slice, size: int) -> np.ndarray:
        """Sketches: names of the ``size`` (1 or 2) least runs, in their order."""
        turns, out = self.turns[at], self.names[at].copy()
        step = max(1, 2_000_000 // len(runs))
        for k in range(0, len(turns), step):
            ranks = turns[k : k + step, None] * runs[None, :]
            places = [ranks.argmin(axis=1)]
            if size > 1 and len(runs) > 1:
                ranks[np.arange(len(ranks)), places[0]] = np.iinfo(np.uint64).max
                p, q = places[0], ranks.argmin(axis=1)
                places = [np.minimum(p, q), np.maximum(p, q)]
            h = out[k : k + step]
            for p in places:
                h[:] = (h ^ runs[p]) * MIX
                h ^= h >> np.uint64(31)
        return out

    def sketch(self, ids: np.ndarray) -> np.ndarray:
        runs = self.runs(ids)
        found = [self.least(runs, slice(PAIRS), 2), self.least(runs, slice(PAIRS, PAIRS + SINGLES), 1)]
        if len(ids) <= SHORT:
            found.append(self.least(self.runs(ids, SHORT_RUN), slice(PAIRS + SINGLES, None), 1))
        return np.concatenate(found)


def words_of(text: str | None) -> list[str]:
    return text.lower().split() if text else []


def key_of(words: list[str]) -> bytes:
    return xxhash.xxh3_128_digest(" ".join(words))


def edits_within(a: list, b: list, most: int) -> int | None:
    """Edit distance of two sequences if it is at most ``most``.  A column of the
    band, ``most`` places to either side of the diagonal, is a number with one bit
    for each place, whose differences to its neighbours are worked out at once.
    The distance is followed down the band's lower edge, then along the last row."""
    n, m = len(a), len(b)
    if abs(n - m) > most:
        return None
    if n <= most:
        return _by_rows(a, b, most)
    width = 2 * most + 1
    full, bottom = (1 << width) - 1, 1 << 2 * most
    where: dict = {}  # of a value, its places in the band as bits, and for which column
    for row in range(most):
        bits, since = where.get(a[row], (0, -most))
        where[a[row]] = bits | 1 << (row + most), since
    up, down, distance = full >> most << most, 0, most
    for j, x in enumerate(b):
        start = j - most
        if (row := j + most) < n:
            bits, since = where.get(a[row], (0, start))
            where[a[row]] = bits >> (start - since) | bottom, start
        bits, since = where.get(x, (0, start))
        equal = bits >> (start - since)
        level = ((((equal & up) + up) ^ up) | equal | down) & full
        right, left = (down | ~(level | up)) & full, level & up
        if row < n:
            distance += not level & bottom
            rest = m - n + most
        else:
            last = 1 << (n - 1 - start)
            distance += bool(right & last) - bool(left & last)
            rest = m - 1 - j
        if distance - rest > most:
            return None
        up, down = (left | ~(level >> 1 | right)) & full, level >> 1 & right
    return distance if distance <= most else None


def _by_rows(a: list, b: list, most: int) -> int | None:
    """The same for sequences shorter than the band."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        old, row[0] = row[:], i
        for j, y in enumerate(b, 1):
            row[j] = min(old[j] + 1, row[j - 1] + 1, old[j - 1] + (x != y))
    return row[-1] if row[-1] <= most else None


class Sequence:
    """A text's words as numbers, with what alignment needs of it worked out once."""

    def __init__(self, ids: np.ndarray):
        self.ids = ids
        self.words, self.often = np.unique(ids, return_counts=True)
        self._once: tuple[np.ndarray, np.ndarray] | None = None

    def once(self) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the pairs of neighbouring words that stand once, and where."""
        if self._once is None:
            x = self.ids
            twos = x[:-1].astype(np.uint64) * MIX ^ (x[1:].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
            value, first, count = np.unique(twos, return_index=True, return_counts=True)
            self._once = value[count == 1], first[count == 1]
        return self._once


def _same(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of equal values in two sorted arrays without repeats."""
    if not len(a) or not len(b):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    j = np.minimum(np.searchsorted(b, a), len(b) - 1)
    i = np.flatnonzero(b[j] == a)
    return i, j[i]


def anchored(x: Sequence, y: Sequence, most: int) -> int:
    """Edits of an alignment through pairs of words that either text holds once,
    inside the band: an upper bound of the edit distance.  Gaps of one length are
    aligned word by word, others replaced whole."""
    p, q = x.ids, y.ids
    n, m = len(p), len(q)
    (v, first), (w, second) = x.once(), y.once()
    i, j = _same(v, w)
    i, j = first[i], second[j]
    order = np.argsort(i)
    i, j = i[order], j[order]
    inside = np.abs(j - i) <= most
    i, j = i[inside], j[inside]
    rising = j == np.maximum.accumulate(j) if len(j) else np.zeros(0, bool)
    i, j = i[rising], j[rising]
    # Equal hashes are held against the words.
    same = (p[i] == q[j]) if len(i) else np.zeros(0, bool)
    i, j = np.r_[-1, i[same], n], np.r_[-1, j[same], m]
    across, down = np.diff(i) - 1, np.diff(j) - 1
    shift = np.repeat((j - i)[:-1], np.diff(i))[1:] if n else np.zeros(0, np.int64)
    differ = p != q[np.minimum(np.arange(n) + shift, max(m - 1, 0))] if m else np.ones(n, bool)
    sums = np.r_[0, np.cumsum(differ)]
    inner = sums[np.maximum(i[1:], 0)] - sums[np.minimum(i[:-1] + 1, n)]
    return int(np.where(across == down, inner, np.maximum(across, down)).sum())


def similar(a: list[str], b: list[str], least: float = SIMILARITY) -> bool:
    """Whether 1 - edits / words of the longer reaches ``least``."""
    number: dict[str, int] = {}
    p, q = (np.fromiter((number.setdefault(w, len(number)) for w in x), np.int64, len(x)) for x in (a, b))
    return aligned(Sequence(p), Sequence(q), least)


def aligned(x: Sequence, y: Sequence, least: float = SIMILARITY) -> bool:
    """The same for word numbers.  Bounds from below and above decide most pairs;
    the others are aligned."""
    longer = max(len(x.ids), len(y.ids))
    most = int((1 - least) * longer + 1e-9)
    if abs(len(x.ids) - len(y.ids)) > most:
        return False
    i, j = _same(x.words, y.words)
    if longer - int(np.minimum(x.often[i], y.often[j]).sum()) > most:
        return False  # words that one side lacks
    return anchored(x, y, most) <= most or edits_within(x.ids.tolist(), y.ids.tolist(), most) is not None


def text_key(text: Column) -> Column:
    """Key of a text's words; null for a text without words."""

    @F.pandas_udf("binary")
    def keys(texts: pd.Series) -> pd.Series:
        return pd.Series([key_of(w) if (w := words_of(t)) else None for t in texts], dtype=object)

    return keys(text)


def sketches(texts: DataFrame) -> DataFrame:
    """doc_id (least), key, n (words), bag, sketch: a row for each different text."""
    small_batches(texts.sparkSession)

    def rows(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        maker, lately = Sketcher(), set()
        for part in parts:
            out = []
            for doc_id, text in zip(part["id"], part["text"], strict=True):
                if words := words_of(text):
                    key, made = key_of(words), (0, None, None)
                    if key not in lately:  # copies near each other are sketched once
                        ids = maker.ids(words)
                        made = len(words), maker.bag(ids), maker.sketch(ids).view(np.int64)
                        lately.add(key)
                    out.append((doc_id, key, *made))
            if len(lately) > 200_000:
                lately.clear()
            yield pd.DataFrame(out, columns=["id", "key", "n", "bag", "sketch"])

    # Whole numbers with nulls among them would become floats in pandas.
    ids = texts.select(F.col("doc_id").cast("string").alias("id"), "text")
    made = ids.mapInPandas(rows, "id string, key binary, n long, bag binary, sketch array<long>")
    return made.groupBy("key").agg(
        F.min(F.col("id").cast("long")).alias("doc_id"), F.max("n").alias("n"), F.first("bag", True).alias("bag"), F.first("sketch", True).alias("sketch")
    )


def buckets(nodes: DataFrame, folder: str) -> DataFrame:
    """bucket, rows (in it), first (its least node), node: buckets of several
    nodes, as a written table."""
    rows = nodes.select("node", F.explode("sketch").alias("bucket"))
    shared = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("rows"), F.min("node").alias("first")).where("rows > 1")
    rows.join(cut(shared), "bucket").write.parquet(f"{folder}/buckets")
    return nodes.sparkSession.read.parquet(f"{folder}/buckets")


def fitting(pairs: DataFrame, nodes: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) whose lengths allow the similarity."""
    sized = lambda c: nodes.select(F.col("node").alias(c), F.col("n").alias(f"n_{c}"))
    both = pairs.join(sized("a"), "a").join(sized("b"), "b")
    return both.where(F.least("n_a", "n_b") >= F.greatest("n_a", "n_b") * least - 1e-9).select("a", "b")


def rooted(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """rows (node, ...) with root, a node's own number where it has no other."""
    return rows.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def told(rows: DataFrame, about: DataFrame, how: str = "inner") -> DataFrame:
    """rows (bucket, rows, node, ...) joined with what is known ``about`` their buckets
    (bucket, rows, ...; one row each).  The rows of a bucket are dealt over one task for
    every ``SLICE`` of them, and each gets its bucket's row."""
    slices = F.greatest(F.ceil(F.col("rows") / SLICE), F.lit(1)).cast("long")
    dealt = rows.withColumn("slice", F.pmod(F.xxhash64("node", F.lit(2)), slices))
    sent = about.withColumn("slice", F.explode(F.sequence(F.lit(0).cast("long"), slices - 1))).drop("rows")
    return dealt.join(sent, ["bucket", "slice"], how).drop("slice")


def unsettled(inside: DataFrame, firsts: DataFrame, roots: DataFrame, nodes: DataFrame) -> DataFrame:
    """bucket, rows, node, root, n, bag of the buckets that hold several classes.
    firsts: (a, b), distinct, of a bucket's first node and another of it."""
    of_first = rooted(firsts.withColumnRenamed("a", "node"), roots).select(F.col("node").alias("first"), F.col("b").alias("node"), F.col("root").alias("of"))
    apart = rooted(of_first, roots).where("root <> of").select("first", "node")
    several = inside.join(apart, ["first", "node"], "left_semi").select("bucket", "rows").distinct()
    left = told(inside, several, "left_semi").select("bucket", "rows", "node")
    return cut(rooted(left.join(nodes.select("node", "n", "bag"), "node"), roots))


def still_apart(left: DataFrame, roots: DataFrame) -> DataFrame:
    """The rows of ``left``, with new roots, of buckets that hold several classes."""
    now = cut(rooted(left.drop("root"), roots))
    several = now.groupBy("bucket").agg(F.first("rows").alias("rows"), F.min("root").alias("p"), F.max("root").alias("q")).where("p < q")
    return told(now, several.select("bucket", "rows"), "left_semi")


def to_hubs(left: DataFrame, found: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """Distinct pairs of a bucket's text of most accepted pairs (``found``) and
    its texts of other classes."""
    degree = found.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("degree"))
    hub = left.join(degree, "node").groupBy("bucket").agg(F.first("rows").alias("rows"), F.max(F.struct("degree", "node", "root", "n")).alias("hub"))
    fits = F.least("n", "hub.n") >= F.greatest("n", "hub.n") * least - 1e-9
    met = told(left, hub).where(F.col("root") != F.col("hub.root")).where(fits)
    return met.select(F.least("node", "hub.node").alias("a"), F.greatest("node", "hub.node").alias("b")).distinct()


def whole_blocks(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The rows of ``parts``, which come by block, in frames of about ``TOGETHER``
    rows or one block."""
    held, count = [], 0
    for part in parts:
        held.append(part)
        count += len(part)
        if count >= TOGETHER:
            rows = pd.concat(held, ignore_index=True)
            end = int(np.flatnonzero(_starts(rows))[-1])
            if end:
                yield rows[:end].reset_index(drop=True)
            held, count = [rows[end:]], len(rows) - end
    if count:
        yield pd.concat(held, ignore_index=True)


def _starts(rows: pd.DataFrame) -> np.ndarray:
    """Whether a row is the first of its block."""
    of = rows[BLOCK_KEY].to_numpy()
    return np.r_[True, (of[1:] != of[:-1]).any(axis=1)]


def apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sums of the differences of bags, row by row."""
    differ = np.maximum(a, b) - np.minimum(a, b)
    return differ.sum(axis=1, dtype=np.uint16)


def opposed(rows: pd.DataFrame, least: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Of blocks, each with its rows together, the pairs (places x, y) of an asking
    row (side 0) and an asked row (side 1) of the same block and of other classes
    whose lengths and bags allow the similarity.  A pair is left to the least
    bucket that both are in and, if both ask, to the lower node.  Many small blocks
    are one matter of arrays."""
    node, root, n, side, bucket, held = (rows[c].to_numpy() for c in ("node", "root", "n", "side", "bucket", "held"))
    asks, sets = root != rows["main"].to_numpy(), {}
    bag = np.frombuffer(b"".join(rows["bag"]), np.uint8).reshape(len(rows), BINS)
    width = int(n.max()) + 1
    base = (np.cumsum(_starts(rows)) - 1) * width  # so that lengths of one block lie between those of its neighbours
    here, there = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    there = there[np.argsort((base + n)[there], kind="stable")]
    low = np.searchsorted((base + n)[there], base[here] + np.ceil(n[here] * least - 1e-9).astype(np.int64))
    high = np.searchsorted((base + n)[there], base[here] + np.minimum(np.floor(n[here] / least + 1e-9), width - 1).astype(np.int64), "right")
    count = high - low
    ends = np.cumsum(count)

    def buckets_of(k: int) -> set[int]:
        if k not in sets:
            sets[k] = set(held[k].tolist())
        return sets[k]

    for some in np.split(np.arange(len(here)), np.flatnonzero(np.diff(ends // CHUNK)) + 1):
        x = np.repeat(here[some], count[some])
        nth = np.arange(len(x)) - np.repeat(np.cumsum(count[some]) - count[some], count[some])
        y = there[np.repeat(low[some], count[some]) + nth]
        fits = (root[y] != root[x]) & (~asks[y] | (node[y] > node[x]))
        x, y = x[fits], y[fits]
        fits = apart(bag[x], bag[y]) <= 2 * ((1 - least) * np.maximum(n[y], n[x]) + 1e-9).astype(np.int64)
        x, y = x[fits], y[fits]
        fits = np.fromiter((min(buckets_of(p) & buckets_of(q)) == b for p, q, b in zip(x.tolist(), y.tolist(), bucket[x].tolist(), strict=True)), bool, len(x))
        if fits.any():
            yield x[fits], y[fits]


def between(left: DataFrame, texts: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """Accepted pairs (a, b), a < b, that unite the classes of each bucket: all of
    its texts of different classes are compared, but for those whose lengths or
    bags need too many edits and those that pairs before have united.  The texts of
    a bucket outside its largest class are held against all of it, in blocks of
    both: each row is copied once for each block of the other side.  Pairs never
    leave a block: first the rows that have any are kept, then these get their
    texts and the block sends on links that unite, fewer than its rows."""
    small_batches(left.sparkSession)
    sizes = left.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("n"))
    main = sizes.groupBy("bucket").agg(F.max(F.struct("n", "root")).alias("main"), F.sum("n").alias("rows"))
    shape = main.select("bucket", "rows", F.col("main.root").alias("main"), _blocks(F.col("rows")).alias("alls"), _blocks(F.col("rows") - F.col("main.n")).alias("others"))
    held = left.groupBy("node").agg(F.collect_set("bucket").alias("held"))  # a node has a few dozen buckets at most
    dealt = told(left, shape).join(held, "node")
    every = lambda c: F.explode(F.sequence(F.lit(0).cast("long"), F.col(c) - 1))
    own = lambda c: F.pmod(F.xxhash64("node"), F.col(c))
    columns = [*BLOCK_KEY, "side", "node", "root", "main", "n", "bag", "held"]
    asking = dealt.where("root <> main").withColumns({"i": own("others"), "j": every("alls"), "side": F.lit(0)}).select(*columns)
    asked = dealt.withColumns({"j": own("alls"), "i": every("others"), "side": F.lit(1)}).select(*columns)
    partitions = _partitions(left)

    def hopeful(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in whole_blocks(parts):
            has = np.zeros(len(rows), bool)
            for x, y in opposed(rows, least):
                has[x] = has[y] = True
            yield rows[has]

    def compared(rows: pd.DataFrame) -> pd.DataFrame:
        press = zstandard.ZstdDecompressor()
        node, root, data, known = rows["node"].to_numpy(), rows["root"].tolist(), rows["data"].tolist(), {}
        up = {r: r for r in root}

        def top(r: int) -> int:
            while (parent := up[r]) != r:
                up[r] = r = up[parent]
            return r

        def words(k: int) -> Sequence:
            if k not in known:
                known[k] = unpacked(data[k], press)
            return known[k]

        out = []
        for xs, ys in opposed(rows, least):
            for x, y in zip(xs.tolist(), ys.tolist(), strict=True):
                p, q = top(root[x]), top(root[y])
                if p != q and aligned(words(x), words(y), least):
                    up[p] = q
                    out.append((min(node[x], node[y]), max(node[x], node[y])))
        return pd.DataFrame(out, columns=["a", "b"], dtype=np.int64)

    # Little to read but much to compare: by a number of partitions that stays.
    shape = "bucket long, i long, j long, side int, node long, root long, main long, n long, bag binary, held array<long>"
    kept = asking.unionByName(asked).repartition(partitions, *BLOCK_KEY).sortWithinPartitions(*BLOCK_KEY).mapInPandas(hopeful, shape)
    return kept.join(texts, "node").repartition(partitions, *BLOCK_KEY).groupBy(*BLOCK_KEY).applyInPandas(compared, "a long, b long").distinct()


def _blocks(rows: Column) -> Column:
    """Blocks of at most about BLOCK rows; one at least."""
    return F.greatest(F.ceil(rows / BLOCK), F.lit(1)).cast("long")


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def packed_texts(docs: DataFrame, nodes: DataFrame, folder: str) -> DataFrame:
    """node, data (the words, compressed), as a written table: one row for each of
    ``nodes`` (node, key), whatever the copies."""
    small_batches(docs.sparkSession)

    def rows(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        press, lately = zstandard.ZstdCompressor(level=3), set()
        for part in parts:
            out = []
            for text in part["text"]:
                if (words := words_of(text)) and (key := key_of(words)) not in lately:
                    lately.add(key)
                    out.append((key, press.compress(" ".join(words).encode("utf-8", "surrogatepass"))))
            if len(lately) > 200_000:
                lately.clear()
            yield pd.DataFrame(out, columns=["key", "data"])

    once = docs.select("text").mapInPandas(rows, "key binary, data binary").groupBy("key").agg(F.first("data").alias("data"))
    once.join(nodes.select("node", "key"), "key").select("node", "data").write.parquet(f"{folder}/texts")
    return docs.sparkSession.read.parquet(f"{folder}/texts")


def unpacked(data: bytes, press: zstandard.ZstdDecompressor) -> Sequence:
    return Sequence(hashes(press.decompress(data).decode("utf-8", "surrogatepass").split(" ")))


def accepted(pairs: DataFrame, texts: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """The pairs whose words align."""
    small_batches(pairs.sparkSession)
    side = lambda c: texts.select(F.col("node").alias(c), F.col("data").alias(f"of_{c}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")

    def align(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        press = zstandard.ZstdDecompressor()
        lately: dict[int, Sequence] = {}

        def known(node: int, data: bytes) -> Sequence:
            """Word hashes of a node's text."""
            if node not in lately:
                if len(lately) > 200:
                    lately.clear()
                lately[node] = unpacked(data, press)
            return lately[node]

        for part in parts:
            kept = [(a, b) for a, b, x, y in zip(part["a"], part["b"], part["of_a"], part["of_b"], strict=True) if aligned(known(a, x), known(b, y), least)]
            yield pd.DataFrame(kept, columns=["a", "b"], dtype=np.int64)

    return both.mapInPandas(align, "a long, b long")


def united(nodes: DataFrame, docs: DataFrame, folder: str, least: float = SIMILARITY) -> DataFrame:
    """(node, root) of nodes in classes of several."""
    inside = buckets(nodes, folder)
    firsts = cut(inside.where("node <> first").select(F.col("first").alias("a"), F.col("node").alias("b")).distinct())
    tried = cut(fitting(firsts, nodes, least))
    wanted = inside.select("node").distinct()
    texts = packed_texts(docs, nodes.select("node", "key").join(wanted, "node", "left_semi"), folder)
    found = cut(accepted(tried, texts, least))
    roots = cut(components(found))
    left = unsettled(inside, firsts, roots, nodes)
    if left.isEmpty():
        return roots
    hubs = cut(to_hubs(left, found, least).join(tried, ["a", "b"], "left_anti"))
    found = cut(found.unionByName(accepted(hubs, texts, least)))
    roots = cut(components(found))
    links = cut(between(still_apart(left, roots), texts, least))
    return roots if links.isEmpty() else cut(components(found.unionByName(links)))


def classes(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """doc_id, class_id (least doc_id of its class), kept (doc_id = class_id)."""
    return _classes(docs, least).select("doc_id", "class_id", "kept")


def _classes(docs: DataFrame, least: float) -> DataFrame:
    """The same with key and root, the class's node."""
    spark, docs = docs.sparkSession, docs.select("doc_id", "text")
    folder = f"{shared_folder(spark)}/near-{uuid.uuid4().hex}"
    nodes = cut(sketches(docs).withColumn("node", F.monotonically_increasing_id()))
    roots = united(nodes, docs, folder, least)
    # Only classes of several texts are looked up by root; one may hold a third of
    # all texts, so its name goes to SALT tasks.
    some = cut(nodes.select("key", "doc_id", "node").join(roots, "node").withColumn("salt", F.pmod("node", F.lit(SALT))))
    names = some.groupBy("root").agg(F.min("doc_id").alias("class_id")).withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALT - 1).cast("long"))))
    by_root = some.join(names, ["root", "salt"]).select("key", "root", "class_id")
    alone = nodes.select("key", "doc_id", "node").join(roots, "node", "left_anti").select("key", F.col("node").alias("root"), F.col("doc_id").alias("class_id"))
    by_key = cut(by_root.unionByName(alone))
    delete_folder(spark, folder)
    ids = docs.select("doc_id", text_key(F.col("text")).alias("key"))
    return ids.join(by_key, "key", "left").select(
        "doc_id", "key", "root",
        F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
    ).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("class_id")))


def one_of_each(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """One document of each class, all columns kept.  Repeated rows of the kept
    doc_id are one document and stay together; another text of a dropped doc_id
    is judged by its own class.  Of a class without any doc_id the least text
    key stays."""
    found = cut(_classes(docs, least))
    named = found.where("key is not null")
    nameless = named.where("class_id is null").groupBy("root").agg(F.min("key").alias("key"))
    gone = named.where("not kept").select("doc_id", "key").unionByName(
        named.where("class_id is null").join(nameless, ["root", "key"], "left_anti").select("doc_id", "key")
    )
    gone = gone.select(F.col("doc_id").alias("gone"), F.col("key").alias("gone_key")).distinct()
    rows = docs.select(F.struct("*").alias("whole"), text_key(F.col("text")).alias("key"))
    same = F.col("whole.doc_id").eqNullSafe(F.col("gone")) & (F.col("key") == F.col("gone_key"))
    return rows.join(gone, same, "left_anti").select("whole.*")
