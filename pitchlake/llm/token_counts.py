"""Operator 1: word-piece counts by a linear longest-match automaton.

The vocabulary is a trie.  Each node has a failure link, the node reached after
the pieces that greedy longest match would emit there are popped, and the number
of those pieces.  One walk over a word then gives its greedy length in time
linear in the word, and no piece is ever built.

Defined results: a null text counts as empty, an empty text has 0 words and 0
tokens; a word that no sequence of pieces covers counts as one unknown token;
null ids, repeated rows and ties pass through row by row; extra columns of the
input are ignored; an empty table gives an empty result.  Texts of any length
are read whole, in time linear in their length.
"""

from __future__ import annotations

import json
import unicodedata
from collections import deque
from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchlake.llm.common import Memo, small_batches

#: Words of a lower-cased text: contractions, letters, single digits, other marks.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"
#: The symbol that stands for the end of a word; bytes are 0 to 255.
END = 256


class LongestMatch:
    """The automaton over sequences of small integers.

    initial: pieces allowed at the start of a word; continuation: those allowed
    after it.  Equal sets share one trie.
    """

    def __init__(self, initial: set[tuple[int, ...]], continuation: set[tuple[int, ...]] | None = None):
        self.step: dict[int, int] = {}  # node * 512 + symbol -> node
        ends, self.size = set(), 1
        self.later = 0
        self._grow(0, initial, ends)
        if continuation is not None and continuation != initial:
            self.later, self.size = self.size, self.size + 1
            self._grow(self.later, continuation, ends)
        self.moves = Moves(self._move)
        self.fail: list[int] = [-1] * self.size
        self.popped: list[int] = [0] * self.size
        below: dict[int, list[tuple[int, int]]] = {}
        for key, node in self.step.items():
            below.setdefault(key >> 9, []).append((key & 511, node))
        todo = deque({0, self.later})
        while todo:
            parent = todo.popleft()
            for symbol, node in below.get(parent, ()):
                todo.append(node)
                if node in ends:
                    self.fail[node], self.popped[node] = self.later, 1
                    continue
                at, count = self.fail[parent], self.popped[parent]
                while at >= 0 and (at << 9 | symbol) not in self.step:
                    count += self.popped[at]
                    at = self.fail[at]
                if at >= 0:
                    self.fail[node], self.popped[node] = self.step[at << 9 | symbol], count

    def _grow(self, root: int, pieces, ends: set[int]) -> None:
        for piece in pieces:
            node = root
            for symbol in piece:
                node = self.step.setdefault(node << 9 | symbol, self.size)
                self.size += node == self.size
            if piece:
                ends.add(node)

    def _move(self, key: int) -> int:
        """Where a symbol leads from a node after as many failures as it takes,
        and the pieces popped on the way: node << 20 | pops, -1 if it can't be."""
        node, symbol, count = key >> 9, key & 511, 0
        while (to := self.step.get(node << 9 | symbol)) is None:
            count += self.popped[node]
            node = self.fail[node]
            if node < 0:
                return -1
        return to << 20 | count

    def length(self, symbols) -> int:
        """Number of greedy pieces; 1 (unknown) where there is no full match."""
        moves = self.moves
        node = count = 0
        for symbol in symbols:
            to = moves[node << 9 | symbol]
            if to < 0:
                return 1
            node = to >> 20
            count += to & 0xFFFFF
        while node != self.later:
            count += self.popped[node]
            node = self.fail[node]
            if node < 0:
                return 1 if symbols else 0
        return count


class Moves(dict):
    """Transitions of the automaton, worked out when first taken."""

    def __init__(self, move, most: int = 1_000_000):
        super().__init__()
        self.move, self.most = move, most

    def __missing__(self, key: int) -> int:
        if len(self) >= self.most:
            self.clear()
        self[key] = to = self.move(key)
        return to


def byte_alphabet() -> dict[str, int]:
    """The printable stand-ins that byte-level vocabulary files use for bytes:
    visible Latin-1 characters stand for themselves, the others follow from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def vocabulary(content: bytes) -> set[tuple[int, ...]]:
    """Pieces of a word_bpe JSON vocabulary as symbols; ``</w>`` becomes END."""
    model, letters = json.loads(content)["model"], byte_alphabet()
    mark = model.get("end_of_word_suffix") or ""
    pieces = set()
    for token in model["vocab"]:
        word = token[: -len(mark)] if mark and token.endswith(mark) else token
        if all(c in letters for c in word):
            pieces.add(tuple(letters[c] for c in word) + ((END,) if word != token else ()))
    return pieces


class Counter:
    """Words and tokens of texts; chunks between white space are remembered."""

    def __init__(self, pieces: set[tuple[int, ...]]):
        self.match = LongestMatch(pieces)
        self.words = regex.compile(WORDS)
        self.chunks = Memo(self._chunk)

    def _chunk(self, chunk: str) -> int:
        found = self.words.findall(chunk)
        total = len(found) << 40
        for word in found:
            total += self.match.length([*word.encode(), END])
        return total

    def count(self, text: str | None) -> tuple[int, int]:
        text = text or ""
        if not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        text = text.lower()
        # str.split also cuts at the four separators, which the pattern takes for marks.
        plain = not any(c in text for c in "\x1c\x1d\x1e\x1f")
        total = sum(map(self.chunks.__getitem__, text.split() if plain else regex.split(r"\s+", text)))
        return total >> 40, total & (1 << 40) - 1


_ready: dict[int, Counter] = {}


def token_counts(docs: DataFrame, vocab: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """n_words and n_tokens of every row.  vocab: content of the vocabulary file,
    of fixed size (about 2 MB), shipped once to each executor."""
    small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(vocab)
    key = hash(vocab)

    @F.pandas_udf("n_words long, n_tokens long")
    def counts(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        if key not in _ready:
            _ready[key] = Counter(vocabulary(sent.value))
        counter = _ready[key]
        for texts in parts:
            yield pd.DataFrame([counter.count(t) for t in texts], columns=["n_words", "n_tokens"])

    return docs.select(F.col(id_col), counts(F.col(text_col)).alias("r")).select(id_col, "r.*")
