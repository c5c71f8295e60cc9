"""Operator 3: byte-level BPE by prefix dynamic programming.

For every prefix of a byte string its BPE encoding has one last token, so a table
of last tokens, one for each prefix, holds the encoding of all prefixes at once.
The last token of a prefix is the only token that ends there, whose start has a
last token beside which it survives the merges.  Appending extends the table;
an edit keeps the table before it and meets the old one again shortly after.

Defined results: a null text counts as empty and has 0 tokens; special tokens
are never made, their strings are ordinary text; null ids, ties and repeated
rows pass through row by row; extra columns are ignored; an empty table gives an
empty result.  Texts are encoded whole, in time linear in their length.  Texts
are cut at single spaces only under a pattern that is known to end every match
there (``SPACED``); under any other pattern they are matched whole.
"""

from __future__ import annotations

import base64
import functools
import hashlib
from collections.abc import Iterator
from struct import pack

import ahocorasick
import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchlake.llm.common import Memo, small_batches

#: White space as the tokenizer library's patterns know it.
SPACE = r"\t-\r \x85\xa0  -     　"


#: Patterns under which, between two visible characters, every match
#: ends before a single space.
SPACED = (r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""",)


def read_ranks(content: bytes) -> dict[bytes, int]:
    return {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, content.splitlines())}


class Unsure(Exception):
    """White space meets a space: the text needs the slower way."""


class Bpe:
    """Encoder and decoder over a rank file's tokens."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.words: dict[int, bytes] = {rank: word for word, rank in ranks.items()}
        self.longest = max(map(len, ranks))
        self.halves: dict[int, tuple[int, int]] = {}
        self.merged: dict[tuple[int, int], int] = {}
        self.beside = Memo(lambda key: self.apart(key >> 20, key & 0xFFFFF), 200_000)
        self.spaced = pattern in SPACED
        for word, rank in sorted(ranks.items(), key=lambda x: x[1]):
            if len(word) > 1 and (pair := self._halves(word, rank)):
                self.halves[rank], self.merged[pair] = pair, rank
        #: Tokens that merges can make; others appear only as a whole match.
        self.made = {rank for word, rank in ranks.items() if len(word) == 1} | set(self.halves)
        self.pattern = regex.compile(pattern.replace(r"[^\s", "[^" + SPACE).replace(r"\S", f"[^{SPACE}]").replace(r"\s", f"[{SPACE}]"))
        self.found = ahocorasick.Automaton()
        for token in self.made:
            self.found.add_word(self.words[token].decode("latin-1"), (len(self.words[token]), token))
        self.found.make_automaton()
        self.length = [len(self.words.get(token, b"")) for token in range(max(self.words) + 1)]
        self.spelt = np.empty(len(self.length), object)
        self.spelt[:] = [self.words.get(token) for token in range(len(self.length))]
        self.pieces = Memo(self._piece, 50_000)
        self.chunks = Memo(self._chunk, 250_000)

    def _halves(self, word: bytes, rank: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes the token."""
        for cut in range(len(word) - 1, 0, -1):
            left, right = self.ranks.get(word[:cut], rank), self.ranks.get(word[cut:], rank)
            if left < rank and right < rank and self._reached(left) and self._reached(right) and self.apart(left, right):
                return left, right
        return None

    def _reached(self, token: int) -> bool:
        return token in self.halves or len(self.words[token]) == 1

    def apart(self, left: int, right: int) -> bool:
        """Whether the two stay two tokens when their bytes are encoded as one
        string: undoing the later merge first, no step may have had a better
        merge across the seam than the one that was taken."""
        before = 1 << 60
        while True:
            across = self.merged.get((left, right))
            if across is not None and across < before:
                return False
            # The merge made last, seen from the seam, is undone; at equal ranks
            # the left one was made first.
            can_left, can_right = left in self.halves, right in self.halves
            if can_left and (left > right or not can_right):
                before, left = left, self.halves[left][1]
            elif can_right:
                before, right = right + 1, self.halves[right][0]
            else:
                return True

    def prefixes(self, word: bytes, last: list[int] | None = None, upto: int | None = None) -> list[int]:
        """Last tokens of all prefixes; ``last`` holds those of a known start,
        which is extended to ``upto`` bytes."""
        last = [] if last is None else last
        end, upto, beside = len(last), len(word) if upto is None else upto, self.beside
        start = max(0, end - self.longest)
        for at, (length, token) in self.found.iter(word[start:upto].decode("latin-1")):
            at += start
            if at < end:
                continue  # the one token that ends here is found
            before = at - length
            if before < 0 or beside[last[before] << 20 | token]:
                last.append(token)
                end += 1
        if end != upto:
            raise ValueError(f"no token for byte {word[end]}: the vocabulary lacks single bytes")
        return last

    def tokens(self, last: list[int]) -> list[int]:
        found, end = [], len(last)
        while end:
            found.append(token := last[end - 1])
            end -= self.length[token]
        return found[::-1]

    def edited(self, old: bytes, last: list[int], start: int, end: int, new: bytes) -> tuple[bytes, list[int]]:
        """The string with bytes start to end replaced, and its table.  The table
        before the edit is kept; after it only as much is worked out as differs:
        where ``longest`` entries in a row equal the old ones, so do all later."""
        word = old[:start] + new + old[end:]
        table, shift = last[:start], len(word) - len(old)
        same = 0
        for at in range(start, len(word)):
            self.prefixes(word, table, at + 1)
            before = at - shift
            same = same + 1 if at >= start + len(new) and 0 <= before < len(last) and last[before] == table[at] else 0
            if same >= self.longest:
                return word, table + last[before + 1 :]
        return word, table

    def _piece(self, piece: bytes) -> bytes:
        if (whole := self.ranks.get(piece)) is not None:
            return pack("<I", whole)
        found = self.tokens(self.prefixes(piece))
        return pack(f"<{len(found)}I", *found)

    def _split(self, text: str) -> bytes:
        return b"".join([self.pieces[x.encode()] for x in self.pattern.findall(text)])

    def _chunk(self, part: str) -> bytes:
        """What follows a space.  Between two visible characters every match
        ends before a single space, so the parts can be encoded one by one."""
        if not part or part[0].isspace() or part[-1].isspace():
            raise Unsure
        return self._split(" " + part)

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if not self.spaced:
            return self._split(text)
        first, *rest = text.split(" ")
        if first and not first[-1].isspace():
            try:
                return self._split(first) + b"".join(map(self.chunks.__getitem__, rest))
            except Unsure:
                pass
        joined, out = first, []
        for part in rest:
            if part and joined and not part[0].isspace() and not joined[-1].isspace():
                out.append(joined)
                joined = " " + part
            else:
                joined += " " + part
        return b"".join([self._split(x) for x in [*out, joined]])

    def decode(self, ids: bytes) -> bytes:
        """The bytes that the ids stand for."""
        return b"".join(self.spelt[np.frombuffer(ids, "<u4")].tolist())


_ready: dict[tuple[int, str], Bpe] = {}


def bpe(content: bytes, pattern: str) -> Bpe:
    """One encoder for each worker process and rank file."""
    key = (hash(content), pattern)
    if key not in _ready:
        _ready[key] = Bpe(read_ranks(content), pattern)
    return _ready[key]


@functools.cache
def spelt(content: bytes) -> np.ndarray:
    """The bytes of each token; once for each worker process and rank file."""
    found = read_ranks(content)
    words = np.empty(max(found.values()) + 1, object)
    words[list(found.values())] = list(found)
    return words


def encode(docs: DataFrame, ranks: bytes, pattern: str, text_col: str = "text", out_col: str = "ids") -> DataFrame:
    """Adds ``out_col``: token ids as a binary of little-endian 32-bit integers.
    ranks: content of the rank file, of fixed size (about 1 MB), shipped once."""
    small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(ranks)

    @F.pandas_udf("binary")
    def ids(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        coder = bpe(sent.value, pattern)
        for texts in parts:
            yield pd.Series([coder.encode(t) for t in texts], dtype=object)

    return docs.withColumn(out_col, ids(F.col(text_col)))


def decode(encoded: DataFrame, ranks: bytes, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """Adds ``out_col``: the bytes that the ids stand for (null ids: empty)."""
    small_batches(encoded.sparkSession)
    sent = encoded.sparkSession.sparkContext.broadcast(ranks)

    @F.pandas_udf("binary")
    def texts(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        words = spelt(sent.value)
        for ids in parts:
            yield pd.Series([b"".join(words[np.frombuffer(x or b"", "<u4")].tolist()) for x in ids], dtype=object)

    return encoded.withColumn(out_col, texts(F.col(ids_col)))


def digests(docs: DataFrame, ranks: bytes, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: encoded, then decoded, in one
    pass, so that neither ids nor bytes leave the worker."""
    small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(ranks)

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def both(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        coder, named = bpe(sent.value, pattern), lambda x: hashlib.sha256(x).hexdigest()
        for texts in parts:
            ids = [coder.encode(t) for t in texts]
            yield pd.DataFrame({
                "n_tokens": [len(x) // 4 for x in ids], "ids_sha256": [named(x) for x in ids], "decoded_sha256": [named(coder.decode(x)) for x in ids],
            })

    return docs.select(id_col, both(F.col(text_col)).alias("r")).select(id_col, "r.*")
