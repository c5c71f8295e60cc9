"""Operator 2: language-model scores by Katz backoff, of any order.

Counts of n-grams are discounted by Good-Turing estimates up to ``LOW``; larger
counts give up ``REST`` of one count.  An n-gram that was never seen falls back to
the next shorter one, by the weight of its history that makes the probabilities
after that history sum to 1 exactly; a word that was never seen has what the
known words leave.  Weights are quotients of sums of given-up counts, which are
positive as soon as a history has been seen, so none is rounded or floored.

Spark does it level by level.  1. Texts are cut into flushes of about ``FLUSH``
tokens, each with its own numbering of words, written once.  2. At each level a
flush sends its distinct n-grams, by the names that level 1 gave their words, with
how often it saw each; equal ones were added up before, so the most frequent
n-gram is one entry of a flush.  Entries are dealt over buckets by history, and
those of a history of more than ``SPREAD`` tokens over as many buckets as that
takes.  A bucket adds up the entries (at level 1 it also names the words, frequent
ones by small numbers) and answers every flush in the order of its entries; with those that nobody trained on it sends the
sums that make the history's weight.  Sums of spread histories are added up by
Spark and joined with those who ask.  Answers are the tables of the next level.
3. Each flush works out the probabilities of its tokens recursively from the
answers and adds them up by text.  All lists travel packed, in blocks.

Defined results: a null text counts as empty and scores its end token; a null
doc_id is hashed as the empty text; repeated rows count and are scored row by
row; without training texts every token is unknown and scores 0 (there is one
unknown word, of probability 1), and so does the base; extra columns are ignored;
an empty table gives an empty result.  Texts are read whole; one of more than
``FLUSH`` tokens is scored in pieces that know the words before them.  Words are
told apart by 63 bits of a hash.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchlake.llm.common import crc_mod, cut, delete_folder, free_shuffles, shared_folder, small_batches

ORDER, LOW, REST = 3, 5, 0.01
FLUSH, KEYS, SPREAD = 1 << 20, 500_000, 1 << 16
END, START = b" end", b" start"  # no word holds a space
#: Sums of a history: how many n-grams have each count up to LOW, how many more
#: than that, the same for what they fall back to, and the counts of the latter.
TALLY = 2 * (LOW + 1) + 1
FLUSHED = "kind string, flush long, data binary, docs array<string>, tokens long, texts long, words long"
ANSWER = "kind string, flush long, level int, bucket long, data binary, h string, tally array<long>"


def words_of(text: str | None) -> list[bytes]:
    """Words between white space (bytes 9 to 13 and 32), A-Z in lower case."""
    return text.encode("utf-8", "replace").lower().split() if text else []


def discounts(n: list[float], low: int = LOW) -> list[float]:
    """Katz's factors for counts 1 to ``LOW``, from the numbers n[0..LOW] of events
    seen once, twice and so on; counts that Good-Turing can't estimate keep the
    factor of larger ones."""
    rest = [(r - REST) / r for r in range(1, LOW + 1)]
    for k in range(low, 0, -1):
        if any(x <= 0 for x in n[: k + 1]):
            continue
        cut_off = (k + 1) * n[k] / n[0]
        found = [((r + 1) * n[r] / (r * n[r - 1]) - cut_off) / (1 - cut_off) if cut_off < 1 else 0 for r in range(1, k + 1)]
        if all(0 < d < 1 for d in found):
            return found + rest[k:]
    return [0.5, *rest[1:]]


def given_up(d: list[float]) -> np.ndarray:
    """What one n-gram gives up: for counts 1 to ``LOW``, and for larger ones."""
    return np.array([*(r * (1 - x) for r, x in enumerate(d, 1)), REST])


def mixed(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def packed(*arrays: np.ndarray) -> bytes:
    """Lists of whole numbers from 0, each as planes of bytes, compressed."""
    head, body = [len(arrays)], []
    for a in arrays:
        a = np.ascontiguousarray(a, "<i8")
        width = max(1, (int(a.max(initial=0)).bit_length() + 7) // 8)
        head += [len(a), width]
        body.append(a.view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes())
    return zstandard.ZstdCompressor(level=2).compress(np.array(head, "<i8").tobytes() + b"".join(body))


def unpacked(data: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    n = int(np.frombuffer(raw, "<i8", 1)[0])
    sizes, at, out = np.frombuffer(raw, "<i8", 2 * n, 8).reshape(-1, 2).tolist(), 8 + 16 * n, []
    for size, width in sizes:
        whole = np.zeros((size, 8), np.uint8)
        whole[:, :width] = np.frombuffer(raw, np.uint8, size * width, at).reshape(width, size).T
        out.append(whole.view("<i8").ravel())
        at += size * width
    return out


class Numbers(dict):
    """Numbers words as they come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def flushes(docs: DataFrame, order: int) -> DataFrame:
    """docs (doc, text, train) as flushes of about ``FLUSH`` tokens, two rows each:
    of kind ``keys`` with its words (keys in the order of their buckets, and how
    often each was seen in training), of kind ``body`` with tokens of all pieces,
    ``order`` - 1 tokens before each (words numbered by frequency; numbers of their
    texts, sizes, training flags; places of the words among the keys), doc ids and
    sums over it."""
    before = order - 1

    def cut_up(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first, flush, text_no = TaskContext.get().partitionId() << 32, 0, 0
        pieces: list[tuple] = []
        size, number = 0, Numbers({START: 0})

        def packed_up() -> pd.DataFrame:
            docs, texts, sizes, train, begins, tokens = zip(*pieces, strict=True)
            tok, whole, train = np.concatenate(tokens), np.array(sizes), np.array(train)
            event = np.concatenate([np.arange(n + before) >= before for n in sizes])
            often = np.bincount(tok[event], minlength=len(number))[1:]
            rank = np.argsort(-often, kind="stable")
            name = np.empty(len(number), np.int64)
            name[0], name[1 + rank] = 0, np.arange(1, len(number))
            keys = np.fromiter(map(xxhash.xxh3_64_intdigest, number), np.uint64, len(number))[1:][rank] >> np.uint64(1)
            by = np.argsort(mixed(keys))
            place = np.empty(len(by), np.int64)
            place[by] = np.arange(len(by))
            trained = np.bincount(name[tok[event & np.repeat(train, whole + before)]], minlength=len(number))[1:]
            base = first >> 32 << 40
            data = packed(keys[by].astype(np.int64), trained[by]), packed(name[tok], np.array(texts) + base, whole, train, place)
            return pd.DataFrame({
                "kind": ["keys", "body"], "flush": first + flush, "data": data, "docs": [None, list(docs)],
                "tokens": [0, int(whole[train].sum())], "texts": [0, int((train & np.array(begins)).sum())], "words": [0, len(rank)],
            })

        for part in parts:
            for doc, text, train in zip(part["doc"], part["text"], part["train"], strict=True):
                tokens = [*[START] * before, *words_of(text), END]
                for at in range(0, len(tokens) - before, FLUSH):
                    piece = tokens[at : at + FLUSH + before]
                    pieces.append((doc, text_no, len(piece) - before, bool(train), at == 0, np.fromiter(map(number.__getitem__, piece), np.int64, len(piece))))
                    size += len(piece)
                    if size >= FLUSH:
                        yield packed_up()
                        pieces, size, number, flush = [], 0, Numbers({START: 0}), flush + 1
                text_no += 1
        if pieces:
            yield packed_up()

    return docs.mapInPandas(cut_up, FLUSHED)


def dealt(spot: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of entries by bucket, and where each bucket begins in it."""
    order = np.argsort(spot.astype(np.uint16 if buckets < 1 << 16 else np.uint64), kind="stable")
    return order, np.searchsorted(spot[order], np.arange(buckets + 1))


def ranged(keys: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of each word; in the order of their mixed keys, so is this."""
    return ((mixed(keys) >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def label(h: np.ndarray) -> str:
    """A history as text."""
    return " ".join(map(str, h.tolist()))


def runs_of(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of equal columns begin, and the number of each entry's run."""
    new = np.r_[True, (h[:, 1:] != h[:, :-1]).any(axis=0)][: h.shape[1]]
    return np.flatnonzero(new), np.cumsum(new) - 1


class Flush:
    """The tokens of a flush and what is known of their n-grams so far: for each
    level and place a local number of the n-gram that ends there and its count in
    training; for each place the name of the word (-1: unknown)."""

    def __init__(self, body: bytes, order: int, total: int, texts: int, buckets: dict[int, int], spread: int):
        self.order, self.total, self.texts, self.buckets, self.spread = order, total, texts, buckets, spread
        self.tok, self.text, self.sizes, self.train, self.place = unpacked(body)
        whole = self.sizes + order - 1
        self.piece = np.repeat(np.arange(len(whole)), whole)
        self.at = np.arange(len(self.tok)) - np.repeat(np.cumsum(whole) - whole, whole)
        self.event = self.at >= order - 1
        self.local, self.count, self.alpha = {}, {}, {}

    def words(self, blocks: list[bytes]) -> None:
        """Takes the answers of level 1."""
        c, name = np.zeros(len(self.place) + 1, np.int64), np.full(len(self.place) + 1, -1)
        c[0], name[0] = self.texts, 0
        found = [unpacked(b) for b in blocks]
        if found:
            c[1:], name[1:] = (np.concatenate([f[i] for f in found])[self.place] for i in (0, 1))
        name[c == 0] = -1
        self.local[1], self.count[1], self.name = self.tok, c[self.tok], name[self.tok]

    def entries(self, k: int) -> None:
        """Distinct n-grams of level k whose history is known, in the order of the buckets."""
        use = (self.at >= k - 1) & (self.tok > 0) & np.r_[False, self.count[k - 1][:-1] > 0]
        self.p = p = np.flatnonzero(use if k < self.order else use & self.event)
        word = np.where(self.count[1][p] > 0, self.tok[p], len(self.place) + 1)
        _, inv = np.unique(self.local[k - 1][p - 1] << 32 | word, return_inverse=True)
        n = int(inv.max(initial=-1)) + 1
        some = np.empty(n, np.int64)
        some[inv] = p
        self.h, self.w, self.low = np.stack([self.name[some - j] for j in range(k - 1, 0, -1)]), self.name[some] + 1, self.count[k - 1][some]
        self.c = np.bincount(inv, self.train[self.piece[p]] * self.event[p], n).astype(np.int64)
        parts = -(-self.count[k - 1][some - 1] // self.spread)
        self.wide = parts > 1
        spread = np.where(self.wide, mixed(self.w) % np.maximum(parts, 1).astype(np.uint64) + np.uint64(1), np.uint64(0))
        whole = np.zeros(n, np.uint64)
        for h in self.h:
            whole = mixed(whole + h.astype(np.uint64))
        spot = mixed(whole + spread) % np.uint64(self.buckets[k])
        self.order_of, self.edges = dealt(spot, self.buckets[k])
        self.inv = inv

    def requests(self) -> list[tuple[int, bytes]]:
        out = []
        for b, (s, e) in enumerate(zip(self.edges[:-1].tolist(), self.edges[1:].tolist(), strict=True)):
            if e > s:
                at = self.order_of[s:e]
                h = self.h[:, at]
                start, _ = runs_of(h)
                out.append((b, packed(np.diff(np.r_[start, len(at)]), self.wide[at][start], self.w[at], self.c[at], self.low[at], *h[:, start])))
        return out

    def answers(self, k: int, blocks: list[bytes], sums: dict[str, np.ndarray], give: np.ndarray, below: np.ndarray) -> None:
        """Takes the answers of level k.  give, below: what counts give up at this
        level and at the one below."""
        n, c = len(self.w), np.zeros(len(self.w), np.int64)
        alpha = np.ones(n)
        found, at = [unpacked(b) for b in blocks], self.order_of
        if found:
            c[at] = np.concatenate([f[0] for f in found])
            # Sums for the runs of histories that were asked for, block by block.
            block = np.repeat(np.arange(len(found)), [len(f[0]) for f in found])
            _, run = runs_of(np.vstack([self.h[:, at], block]))
            asked = c[at] == 0
            tally = np.concatenate([f[1].reshape(TALLY, -1) for f in found], axis=1).T
            _, nth = np.unique(run[asked], return_inverse=True)
            e, t = at[asked], tally[nth]
            for i in np.flatnonzero(self.wide[e]).tolist():
                t[i] = sums[label(self.h[:, e[i]])]
            some = np.empty(n, np.int64)
            some[self.inv] = self.p
            total = self.count[k - 2][some[e] - 1] if k > 2 else np.full(len(e), self.total)
            mine, theirs, count = t[:, : LOW + 1], t[:, LOW + 1 : 2 * LOW + 2], t[:, -1]
            kept = mine @ give / np.maximum(self.count[k - 1][some[e] - 1], 1)
            left = (total - count) + theirs @ below
            alpha[e] = kept / np.where(left > 0, left, 1) * total
        size = len(self.tok)
        self.count[k], self.local[k] = np.zeros(size, np.int64), np.zeros(size, np.int64)
        self.alpha[k] = np.ones(size)
        start = (self.tok == 0) & (self.at >= k - 1)
        self.count[k][start] = self.texts
        self.count[k][self.p], self.local[k][self.p] = c[self.inv], self.inv + 1
        self.alpha[k][self.p] = alpha[self.inv]

    def scores(self, gives: list[np.ndarray], rest: float) -> np.ndarray:
        """log10 of each token's probability; gives: by level, from 1."""
        p = np.flatnonzero(self.event)
        out, todo = np.zeros(len(p)), np.ones(len(p), bool)
        for k in range(self.order, 0, -1):
            c = self.count[k][p]
            seen = c > 0
            history = self.count[k - 1][p - 1] if k > 1 else np.full(len(p), self.total)
            give = np.r_[0.0, gives[k - 1]][np.minimum(c, LOW + 1)]
            value = np.log10(np.where(seen, c - give, 1.0)) - np.log10(np.maximum(history, 1))
            back = np.log10(self.alpha[k][p]) if k > 1 else np.full(len(p), np.log10(rest))
            out += np.where(todo, np.where(seen, value, back), 0.0)
            todo &= ~seen
        return out


def merge(level: int, buckets: int):
    """A bucket's work: adds up the entries of all flushes and answers them."""

    def counted(key, rows: pd.DataFrame) -> pd.DataFrame:
        bucket, got = int(key[0]), [unpacked(x) for x in rows["data"]]
        if level == 1:
            sizes = [len(g[0]) for g in got]
            w, c = (np.concatenate([g[i] for g in got]) for i in (0, 1))
            h, wide, low = np.zeros((0, len(w)), np.int64), np.zeros(len(w), bool), np.zeros(len(w), np.int64)
        else:
            sizes = [len(g[2]) for g in got]
            h = np.concatenate([np.repeat(np.stack(g[5:]), g[0], axis=1) for g in got], axis=1)
            wide = np.concatenate([np.repeat(g[1], g[0]) for g in got]) > 0
            w, c, low = (np.concatenate([g[i] for g in got]) for i in (2, 3, 4))
        order = np.lexsort((w, *h[::-1]))
        h, w = h[:, order], w[order]
        start, group = runs_of(np.vstack([h, w]))
        n, gh, glow = np.add.reduceat(c[order], start), h[:, start], low[order][start]
        place = np.empty(len(order), np.int64)
        place[order] = group
        out = []
        put = lambda kind, **x: out.append({"kind": kind, "flush": None, "level": level, "bucket": bucket, "data": None, "h": None, "tally": None} | x)
        classes = np.arange(1, LOW + 2)
        if level == 1:
            names, known = np.zeros(len(n), np.int64), np.flatnonzero(n)
            names[known[np.argsort(-n[known], kind="stable")]] = np.arange(len(known)) * buckets + bucket + 1
        else:
            run, run_of = runs_of(gh)
            kinds = [np.minimum(x, LOW + 1) * (n > 0) for x in (n, glow)]
            tally = np.stack([*(np.add.reduceat((x == r).astype(np.int64), run) for x in kinds for r in classes), np.add.reduceat(glow * (n > 0), run)])
            is_wide = np.zeros(len(run), bool)
            is_wide[run_of[place[wide]]] = True
            for i in np.flatnonzero(is_wide).tolist():
                put("sum", h=label(gh[:, run[i]]), tally=tally[:, i].tolist())
        edges = np.cumsum([0, *sizes])
        for flush, s, e in zip(rows["flush"].tolist(), edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            g = place[s:e]
            if level == 1:
                extra = names[g]
            else:
                asked = run_of[g[n[g] == 0]]
                asked = asked[np.r_[True, asked[1:] != asked[:-1]][: len(asked)]]
                extra = tally[:, asked].ravel()
                for i in asked[is_wide[asked]].tolist():
                    put("ask", flush=flush, h=label(gh[:, run[i]]))
            put("answer", flush=flush, data=packed(n[g], extra))
        put("stat", tally=np.bincount(np.minimum(n, LOW + 2), minlength=LOW + 3)[1:].tolist())
        return pd.DataFrame(out, columns=[x.split()[0] for x in ANSWER.split(", ")]).astype({"flush": "Int64"})

    return counted


def score(docs: DataFrame, learn, order: int = ORDER) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score.  learn: a
    condition on doc_id that picks the training rows."""
    spark, kind = docs.sparkSession, docs.schema["doc_id"].dataType
    small_batches(spark)
    folder = f"{shared_folder(spark)}/katz-{uuid.uuid4().hex}"
    # Whole numbers with nulls among them would become floats in pandas.
    docs = docs.select(F.col("doc_id").cast("string").alias("doc"), "text", F.coalesce(learn, F.lit(False)).alias("train"))
    flushes(docs, order).write.partitionBy("kind").parquet(f"{folder}/flushes")
    flushed = spark.read.schema(FLUSHED).parquet(f"{folder}/flushes")
    state = flushed.where("kind = 'body'").select("flush", "data", "docs", "tokens", "texts", "words")
    total, texts, words = state.agg(*(F.coalesce(F.sum(c), F.lit(0)) for c in ("tokens", "texts", "words"))).first()
    buckets = {1: max(8, -(-words // KEYS))} | {k: max(8, -(-total // KEYS)) for k in range(2, order + 1)}
    gives: list[np.ndarray] = []
    replies: dict[int, DataFrame] = {}
    sums_of = F.array(*(F.sum(F.col("tally")[i]) for i in range(TALLY))).alias("tally")

    def ready(row, answers: pd.DataFrame, upto: int) -> Flush:
        """A flush with the answers up to a level."""
        flush = Flush(row["data"], order, total, texts, buckets, SPREAD)
        answers = answers.sort_values(["level", "bucket"])
        for k in range(1, upto + 1):
            mine = answers[answers["level"] == k]
            blocks = mine.loc[mine["kind"] == "answer", "data"].tolist()
            if k == 1:
                flush.words(blocks)
                continue
            extra = mine[mine["kind"] == "ask"]
            flush.entries(k)
            flush.answers(k, blocks, dict(zip(extra["h"], map(np.array, extra["tally"]), strict=True)), gives[k - 1], gives[k - 2])
        return flush

    def first(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for flush, data in zip(part["flush"], part["data"], strict=True):
                keys, seen = unpacked(data)
                edges = np.searchsorted(ranged(keys, buckets[1]), np.arange(buckets[1] + 1))
                out = [(b, flush, packed(keys[s:e], seen[s:e])) for b, (s, e) in enumerate(zip(edges[:-1], edges[1:], strict=True)) if e > s]
                yield pd.DataFrame(out, columns=["bucket", "flush", "data"])

    def asking(k: int):
        def ask(key, rows: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
            out = []
            for _, row in rows.iterrows():
                flush = ready(row, answers, k - 1)
                flush.entries(k)
                out += [(b, row["flush"], data) for b, data in flush.requests()]
            return pd.DataFrame(out, columns=["bucket", "flush", "data"])

        return ask

    def told(upto: int):
        frames = [replies[k] for k in range(1, upto + 1)]
        every = frames[0]
        for more in frames[1:]:
            every = every.unionByName(more)
        return state.select("flush", "data", "docs").groupBy("flush").cogroup(every.groupBy("flush"))

    request = "bucket long, flush long, data binary"
    distinct = 0
    for k in range(1, order + 1):
        asked = flushed.where("kind = 'keys'").select("flush", "data").mapInPandas(first, request) if k == 1 else told(k - 1).applyInPandas(asking(k), request)
        asked.groupBy("bucket").applyInPandas(merge(k, buckets[k]), ANSWER).write.partitionBy("kind").parquet(f"{folder}/{k}")
        table = spark.read.schema(ANSWER).parquet(f"{folder}/{k}")
        stat = table.where("kind = 'stat'").agg(*(F.coalesce(F.sum(F.col("tally")[i]), F.lit(0)) for i in range(LOW + 2))).first()
        gives.append(given_up(discounts(list(stat[:-1]))))
        del asked
        free_shuffles(spark)
        if k == 1:
            delete_folder(spark, f"{folder}/flushes/kind=keys")
        if k == 1:
            distinct = sum(stat)
            rest = float(np.array(stat) @ np.r_[gives[0], REST]) / total if total else 1.0
        wide = table.where("kind = 'ask'").select("kind", "flush", "level", "bucket", "data", "h").distinct()
        sums = table.where("kind = 'sum'").groupBy("h").agg(sums_of)
        replies[k] = table.where("kind = 'answer'").select("kind", "flush", "level", "bucket", "data", "h", "tally").unionByName(wide.join(sums, "h"))

    def judge(key, rows: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        frames = []
        for _, row in rows.iterrows():
            f = ready(row, answers, order)
            p = np.flatnonzero(f.event)
            piece, c = f.piece[p], f.count[1][p]
            base = np.log10((c + 0.1) / (total + 0.1 * (distinct + 1)))
            n = len(f.sizes)
            frames.append(pd.DataFrame({
                "text": f.text, "doc": list(row["docs"]), "n_tokens": f.sizes, "n_known": np.bincount(piece, c > 0, n).astype(np.int64),
                "base_score": np.bincount(piece, base, n), "score": np.bincount(piece, f.scores(gives, rest), n),
            }))
        return pd.concat(frames)

    pieces = told(order).applyInPandas(judge, "text long, doc string, n_tokens long, n_known long, base_score double, score double")
    sums = [F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_score", "score")]
    done = pieces.groupBy("text").agg(F.first("doc").cast(kind).alias("doc_id"), *sums)
    done = cut(done.select("doc_id", "n_tokens", "n_known", F.lit(int(total)).cast("long").alias("train_tokens"), "base_score", "score"))
    delete_folder(spark, folder)
    return done


def scored(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """The scores of all rows, learned from those of nine folds in ten."""
    fold = crc_mod(F.col("doc_id"), 10)
    return score(docs, fold != 0, order).withColumn("held_out", fold == 0)
