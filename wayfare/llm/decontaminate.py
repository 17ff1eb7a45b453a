"""Benchmark decontamination: size-partitioned MinHash containment search.

A test item is short and a document may be long, so their Jaccard similarity says little. Documents
are therefore cut into overlapping windows, and items are partitioned by size: an item of m shingles
is looked up in windows of at most 4 m, in one of which it lies whole wherever it stands. The
least Jaccard similarity that the wanted containment leaves in such a window is 0.19, so that among
``HASHES`` minima at least one is equal but for a chance of about one in a million. For items of fewer
than ``FEW`` shingles, or that mostly repeat themselves, a window is a single shingle, and each of
theirs is looked up. Every
candidate is then verified: the item's shingles are sought in the whole document, word by word.

Items go to the tasks in blocks of bounded size; the documents are read once for each block.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.llm import texts
from wayfare.llm.texts import pieces
from wayfare.session import settle

WIDTH, CONTAINMENT, HASHES = 5, 0.8, 64
BLOCK_BYTES = 32 << 20  # and so many bytes of their texts
BLOCK_ITEMS = 20_000
SMALLEST = 16  # shingles: step of the finest windows
FEW = 8


def words_of(docs: texts.Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, lengths and first word (one entry more at the end) per document of all runs of letters
    and numbers."""
    kind = texts.classes()[docs.points] if len(docs.points) else np.empty(0, np.uint8)
    inside = np.zeros(len(kind) + 1, bool)
    inside[:-1] = (kind == texts.LETTER) | (kind == texts.NUMBER)
    before = np.zeros(len(kind) + 1, bool)
    before[1:] = inside[:-1]
    before[docs.starts] = False  # a word does not go on in the next document
    starts = np.flatnonzero(inside & ~before)
    after = np.zeros(len(kind) + 1, bool)
    after[1:] = inside[:-1]
    edge = np.zeros(len(kind) + 1, bool)
    edge[docs.starts] = True
    ends = np.flatnonzero(after & (~inside | edge))
    return starts, ends - starts, np.searchsorted(starts, docs.starts)


def shingle_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """A hash of each ``width`` words in a row, from the words' hashes; also over document ends."""
    n = max(0, len(words) - width + 1)
    total = np.zeros(n, np.uint64)
    for i, factor in enumerate(texts.mixed_values(77, width)):
        total += (words[i:i + n] ^ (words[i:i + n] >> np.uint64(31))) * (factor | np.uint64(1))
    total ^= total >> np.uint64(32)
    return total * np.uint64(0x9E3779B97F4A7C15)


class Words:
    """The words of some texts and their hashes."""

    def __init__(self, strings: list[str | None]):
        self.docs = texts.of_strings([(s or "").lower() for s in strings])
        self.starts, self.lens, self.first = words_of(self.docs)
        self.hashes = texts.word_hashes(self.docs.points, self.starts, self.lens, seeds=(1,))[0]

    def word(self, i: int) -> bytes:
        return self.docs.points[self.starts[i]:self.starts[i] + self.lens[i]].tobytes()


FACTORS = (texts.mixed_values(5, HASHES) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


def _folded(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(32)).astype(np.uint32)


class Items:
    """A block of test items, prepared for search."""

    def __init__(self, ids: list, strings: list[str]):
        self.words = Words(strings)
        classes: dict[tuple, list[int]] = defaultdict(list)
        first = self.words.first
        for i in range(len(strings)):
            sequence = tuple(self.words.word(k) for k in range(first[i], first[i + 1]))
            if sequence:
                classes[sequence].append(i)
        self.ids, self.sequences, self.shingles = [], [], []
        parts: dict[tuple[int, int], list[int]] = defaultdict(list)
        for sequence, members in classes.items():
            i, width = members[0], min(WIDTH, len(sequence))
            own = shingle_hashes(self.words.hashes[first[i]:first[i + 1]], width)
            distinct = len(np.unique(own))
            step = max(SMALLEST, 1 << (len(own) - 1).bit_length())
            parts[width, step if distinct >= max(FEW, step // 2) else 0].append(len(self.ids))
            self.ids.append(min(ids[m] for m in members))
            self.sequences.append(sequence)
            self.shingles.append(np.unique(own, return_index=True))
        self.parts = {key: (_Part if key[1] else _Few)(members, [self.shingles[m][0] for m in members])
                      for key, members in sorted(parts.items())}

    def search(self, strings: list[str | None], containment: float) -> Iterator[tuple[int, int, int, int]]:
        """Text number, item number, number of the item's shingles, how many of them the text holds."""
        text = Words(strings)
        pairs: set[tuple[int, int]] = set()
        for width in sorted({w for w, _ in self.parts}):
            own = [(step, part) for (w, step), part in self.parts.items() if w == width]
            pairs |= _candidates(text, width, own)
        by_text: dict[int, list[int]] = defaultdict(list)
        for t, i in sorted(pairs):
            by_text[t].append(i)
        for t, found in by_text.items():
            begin, end = text.first[t], text.first[t + 1]
            held: dict[int, tuple] = {}
            for i in found:
                sequence = self.sequences[i]
                width = min(WIDTH, len(sequence))
                if width not in held:
                    hashes = shingle_hashes(text.hashes[begin:end], width)
                    order = np.argsort(hashes, kind="stable")
                    held[width] = order, hashes[order]
                order, hashes = held[width]
                wanted, at = self.shingles[i]
                place = np.minimum(np.searchsorted(hashes, wanted), len(hashes) - 1)
                shared = sum(all(text.word(begin + p + k) == sequence[a + k] for k in range(width))
                             for p, a, hit in zip(order[place], at, hashes[place] == wanted) if hit)
                if shared >= containment * len(wanted) - 1e-9:
                    yield t, i, len(wanted), shared


class _Few:
    """All shingles of the items that have few."""

    def __init__(self, members: list[int], shingles: list[np.ndarray]):
        keys = np.concatenate(shingles)
        order = np.argsort(keys, kind="stable")
        self.keys, self.items = keys[order], np.repeat(np.array(members), [len(s) for s in shingles])[order]
        self.seen = np.zeros(1 << 16, bool)
        self.seen[self.keys >> np.uint64(48)] = True

    def held(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of hashes that are an item's, and the items."""
        at = np.flatnonzero(self.seen[hashes >> np.uint64(48)])
        from_, to = np.searchsorted(self.keys, hashes[at]), np.searchsorted(self.keys, hashes[at], "right")
        return np.repeat(at, to - from_), self.items[texts.expand(from_, to - from_)]


class _Part:
    """The minima of the items of one size class: a table that lets few other values through, and
    the exact keys."""

    def __init__(self, members: list[int], shingles: list[np.ndarray]):
        values = np.array([(_folded(s)[None, :] * FACTORS[:, None]).min(axis=1) for s in shingles])
        keys = (np.arange(HASHES, dtype=np.uint64)[None, :] << np.uint64(32) | values).ravel()
        order = np.argsort(keys, kind="stable")
        self.keys, self.items = keys[order], np.repeat(np.array(members), HASHES)[order]
        bits = min(25, max(16, int(len(keys)).bit_length() + 7))
        self.shift = np.uint32(32 - bits)
        self.seen = np.zeros(1 << bits, bool)
        self.seen[(values.ravel() * np.uint32(0x9E3779B1)) >> self.shift] = True


def _candidates(text: Words, width: int, parts: list[tuple[int, _Part]]) -> set[tuple[int, int]]:
    """Pairs of a text and an item that share a minimum in one of the windows."""
    sizes = np.maximum(np.diff(text.first) - width + 1, 0)
    holders = np.flatnonzero(sizes)
    if not len(holders):
        return set()
    sizes = sizes[holders]
    hashes = shingle_hashes(text.hashes, width)
    found: set[tuple[int, int]] = set()
    for _, part in [x for x in parts if x[0] == 0]:
        at, items = part.held(hashes)
        owner = np.searchsorted(text.first, at, "right") - 1
        inside = at + width <= text.first[owner + 1]  # not over the end of a text
        found |= set(zip(owner[inside].tolist(), items[inside].tolist()))
    parts = sorted((x for x in parts if x[0]), key=lambda x: x[0])
    if not parts:
        return found
    hashes = _folded(hashes)
    blocks = -(-sizes // SMALLEST)
    ends = np.cumsum(blocks)
    begins = ends - blocks
    owner = np.repeat(np.arange(len(holders)), blocks)
    place = np.arange(SMALLEST)[:, None] + (np.arange(ends[-1]) - begins[owner])[None, :] * SMALLEST
    place = np.minimum(place, sizes[owner] - 1) + text.first[holders][owner]
    grid = hashes[place]  # one column for each block of shingles; the last ones of a text are repeated
    least = np.empty((HASHES, ends[-1]), np.uint32)
    for k, factor in enumerate(FACTORS):
        np.min(grid * factor, axis=0, out=least[k])
    last, reach = ends[owner] - 1, 1  # least: minima of the windows of ``reach`` blocks from each block on
    for step, part in parts:
        while reach < 2 * step // SMALLEST:
            least = np.minimum(least, least[:, np.minimum(np.arange(ends[-1]) + reach, last)])
            reach *= 2
        windows = np.flatnonzero((np.arange(ends[-1]) - begins[owner]) % (step // SMALLEST) == 0)
        values = least[:, windows]
        k, w = np.nonzero(part.seen[(values * np.uint32(0x9E3779B1)) >> part.shift])
        keys = k.astype(np.uint64) << np.uint64(32) | values[k, w]
        from_, to = np.searchsorted(part.keys, keys), np.searchsorted(part.keys, keys, "right")
        items = part.items[texts.expand(from_, to - from_)]
        holder = holders[owner[windows[np.repeat(w, to - from_)]]]
        both = np.unique(np.stack([holder, items], axis=1), axis=0) if len(items) else []
        found |= {(int(t), int(i)) for t, i in both}
    return found


def _sequence_hashes(items: DataFrame) -> DataFrame:
    """``id``, ``text`` and ``words``, a hash of the text's sequence of words."""
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh64_intdigest

        for piece in pieces(batches, "text"):
            own = Words(piece.column("text").to_pylist())
            found = [xxh64_intdigest(own.hashes[begin:end].tobytes()) for begin, end in zip(own.first, own.first[1:])]
            yield pa.RecordBatch.from_arrays(
                [*piece.columns, pa.array(np.array(found, np.uint64).view(np.int64))], ["id", "text", "words"])

    kind = items.schema["id"].dataType.simpleString()
    return items.mapInArrow(hashed, f"id {kind}, text string, words bigint")


def item_blocks(items: DataFrame, id_col: str, text_col: str, size: int,
                size_bytes: int = BLOCK_BYTES) -> Iterator[tuple[list, list]]:
    """The items in blocks of at most ``size`` rows and ``size_bytes`` bytes of text (or one item), one after the
    other on the driver. Items of the same words are one, named by the smallest id, before any is
    sent to the driver."""
    items = items.where(F.col(text_col).isNotNull() & F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    least = F.min(F.struct("id", "text")).alias("least")
    merged = settle(_sequence_hashes(items).groupBy("words").agg(least).select("least.*"), "items")
    ids, strings, used = [], [], 0
    for row in merged.toLocalIterator():
        more = len(row["text"].encode("utf-8", "replace"))
        if ids and (len(ids) >= size or used + more > size_bytes):
            yield ids, strings
            ids, strings, used = [], [], 0
        ids.append(row["id"])
        strings.append(row["text"])
        used += more
    yield ids, strings


def contaminated(docs: DataFrame, items: DataFrame, containment: float = CONTAINMENT, id_col: str = "doc_id",
                 text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text",
                 block_items: int = BLOCK_ITEMS) -> DataFrame:
    """``doc_id``, ``item_id``, ``n_item``, ``n_shared``, ``containment``: documents that hold at least
    this share of an item's distinct shingles of five words.

    Words are runs of letters and numbers in lower case. An item of fewer than five words is one
    shingle of all its words; one without words, or without id, is never found. Items of the same
    words are one item, named by the smallest id. Null and empty texts hold nothing; repeated rows
    are reported one by one; other columns are ignored.
    """
    found = None
    for ids, strings in item_blocks(items, item_id_col, item_text_col, block_items):
        part = _search(docs, ids, strings, containment, id_col, text_col, items.schema[item_id_col].dataType)
        found = part if found is None else found.unionByName(part)
    return found


def _search(docs: DataFrame, ids: list, strings: list, containment: float, id_col: str, text_col: str,
            item_kind) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast((ids, strings))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = Items(*shared.value)
        for piece in pieces(batches, text_col):
            rows = list(items.search(piece.column(text_col).to_pylist(), containment))
            if rows:
                yield pa.RecordBatch.from_arrays([
                    piece.column(id_col).take(pa.array([r[0] for r in rows])),
                    pa.array([items.ids[r[1]] for r in rows]),
                    pa.array([r[2] for r in rows], pa.int64()), pa.array([r[3] for r in rows], pa.int64()),
                    pa.array([r[3] / r[2] for r in rows]),
                ], ["doc_id", "item_id", "n_item", "n_shared", "containment"])

    return docs.select(id_col, text_col).mapInArrow(
        search, f"doc_id {docs.schema[id_col].dataType.simpleString()}, item_id {item_kind.simpleString()}, "
                "n_item bigint, n_shared bigint, containment double")


def without_contaminated(docs: DataFrame, items: DataFrame, containment: float = CONTAINMENT,
                         item_id_col: str = "item_id", item_text_col: str = "text",
                         block_items: int = BLOCK_ITEMS) -> DataFrame:
    """The rows of ``docs`` that hold none of the items, with all their columns."""
    for ids, strings in item_blocks(items, item_id_col, item_text_col, block_items):
        docs = _keep(docs, ids, strings, containment)
    return docs


def _keep(docs: DataFrame, ids: list, strings: list, containment: float) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast((ids, strings))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = Items(*shared.value)
        for piece in pieces(batches, "text"):
            stay = np.ones(piece.num_rows, bool)
            stay[[r[0] for r in items.search(piece.column("text").to_pylist(), containment)]] = False
            yield piece.filter(pa.array(stay))

    return docs.mapInArrow(keep, docs.schema)
