"""Lengths in greedy word pieces, by one linear pass of a longest-match automaton that builds no pieces.

The vocabulary is a trie whose nodes carry a failure link and a number.  When the walk cannot go on from a node, the
longest-match pieces that the node's text must start with are final: they are *popped*, and the failure link leads
to the node of what is left.  As only lengths are asked for, each node keeps just the number of popped pieces, so a
word costs one step per character plus one per failure link, and every link pops at least one piece.

Words are runs of characters that are no blanks; punctuation characters stand alone.  A word that cannot be cut
into pieces counts as one unknown piece.  NULL and empty texts have length 0.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from mastlight.llm.common import slices

#: Ends a word in the vocabulary (fixed by the file format).
WORD_END = "</w>"
#: Words that a task keeps the lengths of, and the longest of them: some 20 MB.
KEPT, LONG_WORD = 100_000, 64
WORDS = re.compile(r"[^\W_]+|[^\w\s]|_").findall


class LengthAutomaton:
    """Trie with failure links over pieces given as byte strings; the last symbol of a word's last piece is marked."""

    def __init__(self, pieces: Iterable[tuple[int, ...]]):
        self.children: list[dict[int, int]] = [{}]
        self.final = [False]
        for piece in pieces:
            node = 0
            for symbol in piece:
                step = self.children[node].get(symbol)
                if step is None:
                    step = self.children[node][symbol] = len(self.children)
                    self.children.append({})
                    self.final.append(False)
                node = step
            self.final[node] = True
        self._link()

    def _link(self) -> None:
        """Failure links and popped counts, level by level.

        The text of a node v is u's text plus a symbol.  If v is a piece, all of it pops as one piece and the link
        leads to the root.  Else what u pops comes first; from u's link the symbol is tried, following further
        links (each popping more) until it fits; -1 means that the text cannot be cut.
        """
        size = len(self.children)
        self.link, self.popped = [-1] * size, [0] * size
        level = [0]
        while level:
            below = []
            for u in level:
                for symbol, v in self.children[u].items():
                    below.append(v)
                    if self.final[v]:
                        self.link[v], self.popped[v] = 0, 1
                        continue
                    at, count = self.link[u], self.popped[u]
                    while at >= 0 and symbol not in self.children[at]:
                        count += self.popped[at]
                        at = self.link[at]
                    if at >= 0:
                        self.link[v], self.popped[v] = self.children[at][symbol], count
            level = below

    def length(self, symbols: Iterable[int]) -> int:
        """Pieces of a word by greedy longest match; 1 (unknown) where it cannot be cut, 0 for an empty word."""
        children, link, popped = self.children, self.link, self.popped
        node = count = 0
        for symbol in symbols:
            while symbol not in children[node]:
                count += popped[node]
                node = link[node]
                if node < 0:
                    return 1
            node = children[node][symbol]
        while node > 0:
            count += popped[node]
            node = link[node]
        return count if node == 0 else 1


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in byte-level vocabularies: printable Latin-1 as itself, the rest from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def vocabulary_bytes(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


@lru_cache(maxsize=1)
def automaton_of(data: bytes) -> LengthAutomaton:
    """Built once per worker from a byte-level vocabulary file with word ends; a byte that ends a word is 256 higher."""
    letters = byte_letters()
    pieces = []
    for piece in json.loads(data)["model"]["vocab"]:
        ends = piece.endswith(WORD_END)
        body = piece[: -len(WORD_END)] if ends else piece
        if body and all(c in letters for c in body):
            symbols = [letters[c] for c in body]
            if ends:
                symbols[-1] += 256
            pieces.append(tuple(symbols))
    return LengthAutomaton(pieces)


class _WordLengths(dict):
    """Lengths by word, bounded."""

    def __init__(self, automaton: LengthAutomaton):
        super().__init__()
        self.automaton = automaton

    def __missing__(self, word: str) -> int:
        raw = word.encode("utf-8", "replace")
        length = self.automaton.length([*raw[:-1], raw[-1] + 256])
        if len(word) <= LONG_WORD:
            if len(self) >= KEPT:
                self.clear()
            self[word] = length
        return length


def token_counts(docs: DataFrame, vocabulary: Broadcast, text: str = "text") -> DataFrame:
    """Adds ``n_words`` and ``n_tokens`` to the rows of ``docs`` (columns of these names are replaced); no shuffle."""
    kept = docs.drop("n_words", "n_tokens")
    schema = T.StructType([*kept.schema.fields, T.StructField("n_words", T.LongType()),
                           T.StructField("n_tokens", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = _WordLengths(automaton_of(vocabulary.value)).__getitem__
        for batch, texts in slices(batches, text):
            words = [WORDS(t.decode("utf-8", "replace").lower()) for t in texts]
            counts = [pa.array(list(map(len, words)), pa.int64()),
                      pa.array([sum(map(lengths, w)) for w in words], pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *counts], names=[f.name for f in schema.fields])

    return kept.mapInArrow(run, schema)
