"""Byte-level BPE: splitting, merging and decoding.

A text is split into words (a run of letters, numbers or other signs with one space before it,
contractions, white space); each distinct word is merged once and its ids are kept in a bounded
cache. Short words are merged with a contiguous rank array: all words that now have n parts form
the rows of one matrix of part ids and one of the ranks of adjacent parts; scan each row for its
minimum, delete that boundary, refresh the ranks beside it, and the row has n - 1 parts. Words of
more than ``SHORT`` bytes take a heap of ranks over linked parts, so that their time is not
quadratic.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from wayfare.llm import texts
from wayfare.llm.texts import SPACE, Texts, WordCache, expand, pieces

SHORT = 96
NEVER = np.int32(2**31 - 1)


class Vocabulary:
    """What a tokenizer file (JSON, byte-level BPE) says. It is small: its size is the file's."""

    def __init__(self, content: str):
        told = json.loads(content)
        model, byte_of = told["model"], {c: b for b, c in byte_signs().items()}
        self.specials = {x["content"]: x["id"] for x in told["added_tokens"]}
        pieces_ = {i: bytes(byte_of[c] for c in piece) for piece, i in model["vocab"].items()}
        pieces_ |= {i: content.encode() for content, i in self.specials.items()}
        self.size = max(pieces_) + 1
        self.pieces = [pieces_.get(i, b"") for i in range(self.size)]
        ids = model["vocab"]
        self.byte_ids = np.array([ids[c] for _, c in sorted(byte_signs().items())], np.int32)
        self.pairs: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.pairs.setdefault((ids[left], ids[right]), (rank, ids[left + right]))

    @property
    def special_pattern(self) -> re.Pattern | None:
        return re.compile("|".join(map(re.escape, sorted(self.specials, key=len, reverse=True)))) \
            if self.specials else None


def byte_signs() -> dict[int, str]:
    """The printable sign that stands for each byte in byte-level vocabularies: itself for visible
    Latin-1 signs, the next free code point from 256 on for the others."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {b: chr(b) for b in visible} | {b: chr(256 + i) for i, b in enumerate(hidden)}


# ---- splitting

def split(docs: Texts, specials: re.Pattern | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and lengths of all words, and the number of words of each document.

    The words are those of the byte-level pattern: contractions, an optional space before a run of
    letters, of numbers or of other signs, white space apart from the last one before a word.
    Texts of special tokens are words of their own.
    """
    c, n = docs.points, len(docs.points)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(docs), np.int64)
    kind = texts.classes()[c]
    alone = np.zeros(n + 1, bool)  # a new segment begins here
    alone[docs.starts] = True
    if specials is not None:
        _mark_specials(docs, specials, kind, alone)
    alone = alone[:n]
    begins = alone.copy()
    begins[1:] |= kind[1:] != kind[:-1]
    runs = begins.copy()
    after_space = np.flatnonzero(runs[1:] & ~alone[1:] & (kind[1:] != SPACE) & (kind[:-1] == SPACE)) + 1
    begins[after_space - 1] = True
    begins[after_space[c[after_space - 1] == 32]] = False

    quote = np.flatnonzero((c == 39) & begins & runs)
    quote = quote[quote + 1 < n]
    quote = quote[~alone[quote + 1]]
    one = quote[np.isin(c[quote + 1], [115, 116, 109, 100])]  # 's 't 'm 'd
    two = quote[quote + 2 < n]
    two = two[~alone[two + 2]]
    follow = c[two + 1].astype(np.int64) << 21 | c[two + 2]
    two = two[np.isin(follow, [ord(a) << 21 | ord(b) for a, b in ("re", "ve", "ll")])]
    for found, size in ((one, 2), (two, 3)):
        begins[found + 1] = False
        ends = found + size
        begins[ends[ends < n]] = True

    starts = np.flatnonzero(begins)
    lens = np.diff(starts, append=n)
    return starts, lens, np.diff(np.searchsorted(starts, docs.starts))


def _mark_specials(docs: Texts, specials: re.Pattern, kind: np.ndarray, alone: np.ndarray) -> None:
    firsts = np.unique([ord(s[0]) for s in re.sub(r"\\(.)", r"\1", specials.pattern).split("|") if s])
    if not np.isin(docs.points, firsts.astype(np.uint32)).any():
        return
    for i in range(len(docs)):
        begin, end = docs.starts[i], docs.starts[i + 1]
        text = docs.points[begin:end].tobytes().decode("utf-32-le", "surrogatepass")
        for m in specials.finditer(text):
            kind[begin + m.start():begin + m.end()] = texts.SPECIAL
            alone[begin + m.start()] = alone[begin + m.end()] = True


# ---- merging

class Merger:
    """Ids of words."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        pairs = vocabulary.pairs
        keys = np.array([a << 32 | b for a, b in pairs], np.uint64)
        order = np.argsort(keys)
        self.keys = keys[order]
        self.ranks, self.merged = np.array(list(pairs.values()), np.int32).reshape(-1, 2)[order].T

    def rank(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rank of each pair and what it merges to; ``NEVER`` if it doesn't."""
        keys = left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        hit = self.keys[at] == keys
        return np.where(hit, self.ranks[at], NEVER), self.merged[at]

    def __call__(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids on end, and the number of ids of each word."""
        raw = [w.encode("utf-8", "replace") for w in words]
        special = self.vocabulary.specials
        sizes = np.array([0 if w in special else len(r) for w, r in zip(words, raw)])
        found: list[np.ndarray | None] = [None] * len(words)
        for i in np.flatnonzero(sizes == 0):
            found[i] = np.array([special[words[i]]] if words[i] in special else [], np.int32)
        for i in np.flatnonzero(sizes > SHORT):
            found[i] = self.long(raw[i])
        parts = ranks = merged = rows = None  # the words that have n parts now
        for n in range(min(SHORT, sizes.max(initial=0)), 0, -1):
            own = np.flatnonzero(sizes == n)
            if len(own):
                fresh = np.frombuffer(b"".join(raw[i] for i in own), np.uint8).reshape(-1, n)
                fresh = self.vocabulary.byte_ids[fresh]
                new_ranks, new_merged = self.rank(fresh[:, :-1], fresh[:, 1:])
                if rows is None:
                    parts, ranks, merged, rows = fresh, new_ranks, new_merged, own
                else:
                    parts, rows = np.concatenate([parts, fresh]), np.concatenate([rows, own])
                    ranks = np.concatenate([ranks, new_ranks])
                    merged = np.concatenate([merged, new_merged])
            if rows is None:
                continue
            at = ranks.argmin(1) if n > 1 else np.zeros(len(rows), np.int64)
            each = np.arange(len(rows))
            ready = ranks[each, at] == NEVER if n > 1 else np.ones(len(rows), bool)
            for i, ids in zip(rows[ready], parts[ready]):
                found[i] = ids
            if ready.all():
                parts = ranks = merged = rows = None
                continue
            go = ~ready
            parts, ranks, merged, rows, at = parts[go], ranks[go], merged[go], rows[go], at[go]
            each = np.arange(len(rows))
            parts[each, at] = merged[each, at]
            keep = np.ones(parts.shape, bool)
            keep[each, at + 1] = False
            parts = parts[keep].reshape(len(rows), n - 1)
            keep = keep[:, 1:]  # boundary at + 1 goes; the ranks on both sides of it are refreshed
            ranks, merged = ranks[keep].reshape(len(rows), n - 2), merged[keep].reshape(len(rows), n - 2)
            for side in (at - 1, at):
                in_ = np.flatnonzero((side >= 0) & (side < n - 2))
                ranks[in_, side[in_]], merged[in_, side[in_]] = self.rank(
                    parts[in_, side[in_]], parts[in_, side[in_] + 1])
        counts = np.array([len(x) for x in found], np.int32)
        return np.concatenate(found) if found else np.empty(0, np.int32), counts

    def long(self, raw: bytes) -> np.ndarray:
        """The same merges for a long word, by a heap of ranks and linked parts."""
        ids = self.vocabulary.byte_ids[np.frombuffer(raw, np.uint8)].tolist()
        pairs, n = self.vocabulary.pairs, len(ids)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(*pairs[p], i, p) for i, p in enumerate(zip(ids, ids[1:])) if p in pairs]
        heap = [(rank, i, new, p) for rank, new, i, p in heap]
        heapq.heapify(heap)
        while heap:
            _, i, new, pair = heapq.heappop(heap)
            j = after[i] if ids[i] >= 0 else n
            if j >= n or (ids[i], ids[j]) != pair:
                continue
            ids[i], ids[j], after[i] = new, -1, after[j]
            if after[j] < n:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n and (p := (ids[a], ids[b])) in pairs:
                    heapq.heappush(heap, (pairs[p][0], a, pairs[p][1], p))
        return np.array([x for x in ids if x >= 0], np.int32)


class Encoder:
    """Ids of documents, through a cache of words."""

    def __init__(self, vocabulary: Vocabulary, work=None):
        self.specials = vocabulary.special_pattern
        self.cache = WordCache(work or Merger(vocabulary), np.int32)

    def __call__(self, docs: Texts) -> tuple[np.ndarray, np.ndarray]:
        """All ids on end, and where each document's begin (one entry more at the end)."""
        starts, lens, per_doc = split(docs, self.specials)
        words = self.cache.numbers(docs.points, starts, lens)
        counts = self.cache.lens[words]
        ids = self.cache.values[expand(self.cache.starts[words], counts)]
        ends = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
        return ids, ends[np.concatenate([[0], np.cumsum(per_doc)])]


class Decoder:
    """Bytes of ids."""

    def __init__(self, vocabulary: Vocabulary):
        self.lens = np.array([len(p) for p in vocabulary.pieces], np.int64)
        self.starts = np.cumsum(self.lens) - self.lens
        self.flat = np.frombuffer(b"".join(vocabulary.pieces), np.uint8)

    def __call__(self, ids: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All bytes on end, and where each document's begin (one entry more at the end)."""
        lens = self.lens[ids]
        ends = np.concatenate([[0], np.cumsum(lens)])
        return self.flat[expand(self.starts[ids], lens)], ends[starts]


@lru_cache(maxsize=2)
def vocabulary(content: str) -> Vocabulary:
    return Vocabulary(content)


@lru_cache(maxsize=2)
def _encoder(content: str) -> Encoder:
    return Encoder(vocabulary(content))


@lru_cache(maxsize=2)
def _decoder(content: str) -> Decoder:
    return Decoder(vocabulary(content))


# ---- on Spark

def read_vocabulary(path: str) -> str:
    """The tokenizer file, read on the driver; a few MB at most, checked."""
    with open(path, encoding="utf-8") as file:
        content = file.read()
    if len(content) > 64 << 20:
        raise ValueError(f"{path} is no vocabulary file: {len(content)} characters")
    return content


def list_column(ids: np.ndarray, starts: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(ids, kind))


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """``doc_id``, ``ids`` (array of int): each whole text as token ids.

    Special tokens written out in a text become their ids. Null and empty texts have no ids,
    repeated rows are encoded one by one, other columns are ignored.
    """
    content = docs.sparkSession.sparkContext.broadcast(read_vocabulary(path))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(content.value)
        for piece in pieces(batches, text_col):
            ids, starts = encoder(texts.of_arrow(piece.column(text_col)))
            yield pa.RecordBatch.from_arrays(
                [piece.column(id_col), list_column(ids, starts, pa.int32())], ["doc_id", "ids"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(encode, f"doc_id {kind}, ids array<int>")


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id``, ``text``: the texts of ``ids``; bytes that are no UTF-8 become U+FFFD.

    Null for null ``ids``; ids outside the vocabulary fail the job.
    """
    content = encoded.sparkSession.sparkContext.broadcast(read_vocabulary(path))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = _decoder(content.value)
        for batch in batches:
            for i in range(0, batch.num_rows, 16):
                few = batch.slice(i, 16)
                column = few.column("ids")
                ids = column.flatten().to_numpy(zero_copy_only=False)
                lens = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                raw, starts = decoder(ids, np.concatenate([[0], np.cumsum(lens)]))
                raw = raw.tobytes()
                found = [raw[a:b].decode("utf-8", "replace") if known else None for a, b, known in zip(
                    starts, starts[1:], column.is_valid().to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [few.column("doc_id"), pa.array(found, pa.string())], ["doc_id", "text"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(decode, f"doc_id {kind}, text string")


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids_sha256``, ``decoded_sha256`` of each whole text.

    Encodes and decodes in one pass, without writing ids; the digests are of the ids as
    little-endian unsigned 32-bit integers and of the decoded text in UTF-8. Null counts as empty.
    """
    content = docs.sparkSession.sparkContext.broadcast(read_vocabulary(path))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = _encoder(content.value), _decoder(content.value)
        for piece in pieces(batches, text_col):
            ids, starts = encoder(texts.of_arrow(piece.column(text_col)))
            raw, ends = decoder(ids, starts)
            raw, ids = raw.tobytes(), ids.astype("<u4").tobytes()
            yield pa.RecordBatch.from_arrays([
                piece.column(id_col), pa.array(np.diff(starts), pa.int64()),
                pa.array([hashlib.sha256(ids[4 * a:4 * b]).hexdigest() for a, b in zip(starts, starts[1:])]),
                pa.array([hashlib.sha256(raw[a:b].decode("utf-8", "replace").encode()).hexdigest()
                          for a, b in zip(ends, ends[1:])]),
            ], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(
        digest, f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
