"""Texts of Arrow batches as arrays of code points, in pieces of bounded size."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE_BYTES = 1 << 20

SPACE, LETTER, NUMBER, OTHER, SPECIAL = 0, 1, 2, 3, 4

# White space as Unicode defines it (property White_Space). Fixed values.
WHITE_SPACE = [9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029,
               0x202F, 0x205F, 0x3000]


@dataclass
class Texts:
    """Documents on end: the code points of document i are ``points[starts[i]:starts[i + 1]]``."""

    points: np.ndarray
    starts: np.ndarray

    def __len__(self) -> int:
        return len(self.starts) - 1


def of_strings(strings: Iterable[str | None]) -> Texts:
    """Null counts as empty."""
    strings = [s or "" for s in strings]
    starts = np.zeros(len(strings) + 1, np.int64)
    np.cumsum([len(s) for s in strings], out=starts[1:])
    joined = "".join(strings).encode("utf-32-le", "surrogatepass")
    return Texts(np.frombuffer(joined, np.uint32), starts)


def of_arrow(column: pa.Array) -> Texts:
    """Null counts as empty; bytes that are no UTF-8 are replaced by U+FFFD."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    if not len(column) or offsets[-1] == offsets[0]:
        return Texts(np.empty(0, np.uint32), np.zeros(len(column) + 1, np.int64))
    raw = memoryview(column.buffers()[2])[offsets[0]:offsets[-1]]
    try:
        points = np.frombuffer(str(raw, "utf-8").encode("utf-32-le"), np.uint32)
    except UnicodeDecodeError:
        offsets = offsets - offsets[0]
        return of_strings(str(raw[a:b], "utf-8", "replace") for a, b in zip(offsets, offsets[1:]))
    leading = (np.frombuffer(raw, np.uint8) & 0xC0) != 0x80
    before = np.zeros(len(leading) + 1, np.int64)
    np.cumsum(leading, out=before[1:])
    return Texts(points, before[offsets - offsets[0]])


def pieces(batches: Iterable[pa.RecordBatch], text_col: str,
           limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that a piece has at most ``limit`` bytes of text, or is a single row."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text_col)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes)
        begin, n = 0, batch.num_rows
        while begin < n:
            used = ends[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(ends, used + limit, "right")))
            yield batch.slice(begin, end - begin)
            begin = end


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """For each code point whether it is a letter, a number, white space or something else."""
    import unicodedata

    kinds = {"L": LETTER, "N": NUMBER}
    table = np.array([kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)], np.uint8)
    table[WHITE_SPACE] = SPACE
    return table


def expand(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """The indices of all the slices ``[start, start + len)``, on end."""
    ends = np.cumsum(lens)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - lens), lens) + np.arange(total)


def segment_sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of ``values[starts[i]:starts[i + 1]]``, 0 for empty slices."""
    total = np.zeros(len(values) + 1, np.int64 if values.dtype.kind in "biu" else np.float64)
    np.cumsum(values, out=total[1:])
    return total[starts[1:]] - total[starts[:-1]]


def mixed_values(seed: int, n: int) -> np.ndarray:
    """n well-mixed 64-bit values (the splitmix64 sequence)."""
    with np.errstate(over="ignore"):
        z = np.uint64(seed) + np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


LONG_WORD = 256


@lru_cache(maxsize=2)
def _factors(seed: int) -> tuple[np.ndarray, np.ndarray]:
    return mixed_values(seed, 0x110000), mixed_values(~seed & 0xFFFF, LONG_WORD) | np.uint64(1)


def word_hashes(points: np.ndarray, starts: np.ndarray, lens: np.ndarray,
                seeds: tuple[int, ...] = (1, 2)) -> list[np.ndarray]:
    """Independent 64-bit hashes of each word; two of them together stand for the word."""
    import hashlib

    if not len(starts):
        return [np.empty(0, np.uint64) for _ in seeds]
    if len(points) and (lens.sum() != len(points) or starts[0] != 0):
        points = points[expand(starts, lens)]
    own = np.cumsum(lens) - lens
    place = np.arange(len(points)) - np.repeat(own, lens)
    place &= LONG_WORD - 1
    found = []
    for seed in seeds:
        chars, places = _factors(seed)
        found.append(np.add.reduceat(chars[points] * places[place], own) + lens.astype(np.uint64))
    for i in np.flatnonzero(lens > LONG_WORD):
        digest = hashlib.blake2b(points[own[i]:own[i] + lens[i]].tobytes(), digest_size=16).digest()
        for own_hash, seed in zip(found, seeds):
            own_hash[i] = np.frombuffer(digest, np.uint64)[seed - 1]
    return found


class Growing:
    """An array that grows at its end."""

    def __init__(self, dtype):
        self.room, self.used = np.empty(1024, dtype), 0

    def append(self, values: np.ndarray) -> None:
        end = self.used + len(values)
        if end > len(self.room):
            room = np.empty(2 * end, self.room.dtype)
            room[:self.used] = self.room[:self.used]
            self.room = room
        self.room[self.used:end] = values
        self.used = end

    def __array__(self, dtype=None, copy=None) -> np.ndarray:
        return self.room[:self.used]


class WordIndex:
    """A number for each distinct word, by its two hashes: an open-addressing table of arrays."""

    def __init__(self, bits: int = 16):
        self.bits = bits
        self.slots = np.full(1 << bits, -1, np.int32)
        self._first, self._second = Growing(np.uint64), Growing(np.uint64)

    def __len__(self) -> int:
        return self._first.used

    @property
    def first(self) -> np.ndarray:
        return np.asarray(self._first)

    @property
    def second(self) -> np.ndarray:
        return np.asarray(self._second)

    def find(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """The words' numbers, -1 where unknown."""
        mask = (1 << self.bits) - 1
        slot = (first >> np.uint64(64 - self.bits)).astype(np.int64)
        found = self.slots[slot]
        if not len(self):
            return np.full(len(first), -1, np.int32)
        keys, others = self.first, self.second
        known = np.maximum(found, 0)
        open_ = np.flatnonzero((found >= 0) & ((keys[known] != first) | (others[known] != second)))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & mask
            at = self.slots[slot[open_]]
            found[open_] = at
            open_ = open_[(at >= 0) & ((keys[at] != first[open_]) | (others[at] != second[open_]))]
        return found

    def add(self, first: np.ndarray, second: np.ndarray) -> None:
        """Number new, distinct words."""
        begin = len(self)
        self._first.append(first)
        self._second.append(second)
        if 2 * len(self) > len(self.slots):
            while 2 * len(self) > 1 << self.bits:
                self.bits += 1
            self.slots = np.full(1 << self.bits, -1, np.int32)
            begin = 0
        mask = (1 << self.bits) - 1
        numbers = np.arange(begin, len(self), dtype=np.int32)
        slot = (self.first[begin:] >> np.uint64(64 - self.bits)).astype(np.int64)
        while len(numbers):
            free = self.slots[slot] < 0
            self.slots[slot[free]] = numbers[free]
            left = self.slots[slot] != numbers
            numbers, slot = numbers[left], (slot[left] + 1) & mask


class WordCache:
    """What was worked out for each distinct word, kept over many pieces of text.

    ``work`` gets a list of words and returns a flat array and the number of its entries that each
    word has. At ``most`` words the cache starts anew, so it stays bounded.
    """

    def __init__(self, work, dtype, most: int = 1 << 19):
        self.work, self.dtype, self.most = work, dtype, most
        self._clear()

    def _clear(self) -> None:
        self.index = WordIndex()
        self._values, self._lens = Growing(self.dtype), Growing(np.int32)
        self._starts = Growing(np.int64)

    @property
    def values(self) -> np.ndarray:
        return np.asarray(self._values)

    @property
    def lens(self) -> np.ndarray:
        return np.asarray(self._lens)

    @property
    def starts(self) -> np.ndarray:
        """Word ``i`` has ``values[starts[i]:starts[i] + lens[i]]``."""
        return np.asarray(self._starts)

    def numbers(self, points: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
        """Numbers of the words; those not known are worked out."""
        first, second = word_hashes(points, starts, lens)
        found = self.index.find(first, second)
        if len(self.index) > self.most and (found < 0).any():
            self._clear()
            found[:] = -1
        missing = np.flatnonzero(found < 0)
        while len(missing):
            _, new = np.unique(first[missing], return_index=True)
            new = missing[new]
            self.index.add(first[new], second[new])
            words = [points[s:s + n].tobytes().decode("utf-32-le", "surrogatepass")
                     for s, n in zip(starts[new].tolist(), lens[new].tolist())]
            values, counts = self.work(words)
            counts = np.asarray(counts, np.int32)
            self._starts.append(self._values.used + np.cumsum(counts, dtype=np.int64) - counts)
            self._lens.append(counts)
            self._values.append(np.asarray(values, self.dtype))
            found[missing] = self.index.find(first[missing], second[missing])
            missing = np.flatnonzero(found < 0)
        return found
