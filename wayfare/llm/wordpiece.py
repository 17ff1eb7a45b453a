"""Token counts by greedy longest match, in time linear in the text.

The vocabulary is a trie. Each node has a failure link to the node from which matching goes on
after the pieces that are then settled have been popped, and the number of those pieces. Counting
follows one transition or one link per step and never looks back, and no piece is ever built.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from wayfare.llm import bpe, texts
from wayfare.llm.texts import WordCache, pieces

NOWHERE = -1


class LongestMatch:
    """Counts the pieces of a word: the longest of ``first`` that begins it, then always the
    longest of ``following`` that begins the rest."""

    def __init__(self, first: Iterable[bytes], following: Iterable[bytes] | None = None):
        self.steps: list[dict[int, int]] = [{}]
        self.final = [False]
        self.begin = self.resume = 0
        for piece in first:
            self._insert(self.begin, piece)
        if following is not None:
            self.resume = self._node()
            for piece in following:
                self._insert(self.resume, piece)
        self._link()

    def _node(self) -> int:
        self.steps.append({})
        self.final.append(False)
        return len(self.steps) - 1

    def _insert(self, node: int, piece: bytes) -> None:
        if not piece:
            return
        for byte in piece:
            node = self.steps[node].setdefault(byte, 0) or self._grow(node, byte)
        self.final[node] = True

    def _grow(self, node: int, byte: int) -> int:
        self.steps[node][byte] = new = self._node()
        return new

    def _link(self) -> None:
        """Links and counts of popped pieces, for shallow nodes first."""
        self.link = [NOWHERE] * len(self.steps)
        self.popped = [0] * len(self.steps)
        layer = list(dict.fromkeys([self.begin, self.resume]))
        while layer:
            deeper = []
            for node in layer:
                for byte, child in self.steps[node].items():
                    deeper.append(child)
                    if self.final[child]:
                        self.link[child], self.popped[child] = self.resume, 1
                        continue
                    to, popped = self.link[node], self.popped[node]
                    while to != NOWHERE and byte not in self.steps[to]:
                        popped += self.popped[to]
                        to = self.link[to]
                    if to != NOWHERE:
                        self.link[child], self.popped[child] = self.steps[to][byte], popped
            layer = deeper

    def count(self, word: bytes) -> int:
        """The number of pieces; 0 for the empty word, -1 if the vocabulary can't make the word."""
        steps, link, popped = self.steps, self.link, self.popped
        node, total = self.begin, 0
        for byte in word:
            to = steps[node].get(byte)
            while to is None:
                total += popped[node]
                node = link[node]
                if node == NOWHERE:
                    return -1
                to = steps[node].get(byte)
            node = to
        while node != self.resume and node != self.begin:
            total += popped[node]
            node = link[node]
            if node == NOWHERE:
                return -1
        return total

    def __call__(self, words: list[str]) -> tuple[list[int], np.ndarray]:
        return [self.count(w.encode("utf-8", "replace")) for w in words], np.ones(len(words), np.int32)


@lru_cache(maxsize=2)
def _counter(content: str) -> WordCache:
    return WordCache(LongestMatch(p for p in bpe.vocabulary(content).pieces if p), np.int32)


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_words``, ``n_tokens``, ``n_unknown`` of each whole text.

    Words are those of the byte-level pattern; each is covered greedily with the pieces of the
    vocabulary file at ``path``. A word that can't be covered counts as one token and as unknown.
    Null and empty texts have zeros, repeated rows are counted one by one, other columns ignored.
    """
    content = docs.sparkSession.sparkContext.broadcast(bpe.read_vocabulary(path))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, specials = _counter(content.value), bpe.vocabulary(content.value).special_pattern
        for piece in pieces(batches, text_col):
            found = texts.of_arrow(piece.column(text_col))
            starts, lens, n_words = bpe.split(found, specials)
            words = cache.numbers(found.points, starts, lens)
            counts = cache.values[cache.starts[words]]
            edges = np.concatenate([[0], np.cumsum(n_words)])
            yield pa.RecordBatch.from_arrays([
                piece.column(id_col), pa.array(n_words, pa.int64()),
                pa.array(texts.segment_sums(np.abs(counts), edges), pa.int64()),
                pa.array(texts.segment_sums(counts < 0, edges), pa.int64()),
            ], ["doc_id", "n_words", "n_tokens", "n_unknown"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(
        count, f"doc_id {kind}, n_words bigint, n_tokens bigint, n_unknown bigint")
