"""Spelling variants: words one edit apart, found by probing Bloom filters with generated edits.

The vocabulary lies in blocked Bloom filters, one for each word length: a block of 512 bits has eight
lanes, and a word sets one bit in each lane of one block. Tasks generate the edits of their words and
probe the filter of the edit's length; of each pair of words one is generated from the other (a
deletion from the longer word, a replacement by a later letter from the word with the earlier one).
Only what the filters let through is shuffled, to an exact join with the vocabulary.

Hashes are sums of a value for each (place, letter), so an edit's hash takes two additions. The filters
are numbered as one row of blocks, which is sent in ranges of at most ``BLOCKS``; a larger
vocabulary takes several ranges, each probed by all words.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.llm.texts import pieces
from wayfare.session import release, settle, ship

RUN = r"[a-zÀ-ÿ]"  # after A-Z are lowered
DROP = 31  # one run in so many loses a letter
LEAST_LENGTH, LEAST_COUNT, RATIO = 7, 2, 10
POOLED = 256  # words from this length on share one filter
WORD_BITS, LANES = 16, 8
BLOCKS = 1 << 19  # 64 bytes each: 32 MB at most are sent at a time
CELLS = 1 << 20  # edits generated at a time
HELD = 1 << 17  # words counted at a time in a task


# ---- words

def altered(run: str, doc_id: object) -> str:
    """The run without the letter that the checksum of id and run chooses, or the run itself."""
    return _altered(run, crc32(f"{'' if doc_id is None else doc_id}:".encode()))


def _altered(run: str, before: int) -> str:
    h = crc32(run.encode(), before)
    if h % DROP:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def word_counts(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word``, ``n``: the altered runs of whole texts that have the length and the number of occurrences.

    Null texts hold no words, a null id counts as an empty one, repeated rows count each time. Counts are
    summed up in the tasks before they are shuffled.
    """
    ship(docs.sparkSession)
    runs = re.compile(f"{RUN}{{{least_length},}}")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pool: Counter[str] = Counter()

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(pool), pa.string()),
                                               pa.array(list(pool.values()), pa.int64())], ["word", "n"])

        for piece in pieces(batches, "text"):
            for doc_id, raw in zip(piece.column("id").to_pylist(), piece.column("text").to_pylist()):
                before = crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for run, times in Counter(runs.findall((raw or b"").lower().decode("utf-8", "replace"))).items():
                    word = _altered(run, before)
                    if len(word) >= least_length:
                        pool[word] += times
            if len(pool) > HELD:
                yield rows()
                pool.clear()
        yield rows()

    found = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("binary").alias("text"))
    return (found.mapInArrow(counted, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= least_count))


# ---- hashes and filters

def _mixed(z: np.ndarray) -> np.ndarray:
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def letter_values(places: np.ndarray, letters: np.ndarray) -> np.ndarray:
    """A 64-bit value for each (place, letter); letters are below 256."""
    at = places.astype(np.uint64) << np.uint64(8) | letters.astype(np.uint64)
    return _mixed((at + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))


def finished(sums: np.ndarray, length: int) -> np.ndarray:
    return _mixed(sums ^ np.uint64(length * 0x632BE59BD9B4E019 % (1 << 64)))


def by_length(words: list[str]) -> Iterator[tuple[int, np.ndarray]]:
    """Words of one length as numbers of the list, at most ``CELLS`` letters or one word at a time."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    for length in np.unique(lengths).tolist():
        own = np.flatnonzero(lengths == length)
        step = max(1, CELLS // (length * 64))
        for begin in range(0, len(own), step):
            yield length, own[begin:begin + step]


def letters_of(words: list[str], length: int) -> np.ndarray:
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(-1, length)


def block_of(hashes: np.ndarray, blocks: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(blocks) >> np.uint64(32)).astype(np.int64)


def lane_bits(hashes: np.ndarray, lane: int) -> np.ndarray:
    """The bit that a word sets in a lane: six bits of a product with the lane's odd factor."""
    factor = np.uint32(0x47B6137B + 0x9E3779B2 * lane & 0xFFFFFFFF)
    return np.uint64(1) << ((hashes.astype(np.uint32) * factor) >> np.uint32(26)).astype(np.uint64)


class Shards:
    """Where the filter of each length begins in the row of blocks, and how many blocks it has."""

    def __init__(self, counts: dict[int, int]):
        self.sizes = {shard: max(1, -(-n * WORD_BITS // (64 * LANES))) for shard, n in sorted(counts.items())}
        self.counts, self.firsts, self.total = counts, {}, 0
        for shard, size in self.sizes.items():
            self.firsts[shard] = self.total
            self.total += size

    def blocks(self, hashes: np.ndarray, length: int) -> np.ndarray:
        shard = min(length, POOLED)
        return self.firsts[shard] + block_of(hashes, self.sizes[shard])


def _filter_rows(words: DataFrame, shards: Shards) -> DataFrame:
    """``block`` and its lanes."""
    names = [f"lane{i}" for i in range(LANES)]

    def set_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            strings = batch.column("word").to_pylist()
            for length, own in by_length(strings):
                letters = letters_of([strings[i] for i in own], length)
                hashes = finished(letter_values(np.arange(length), letters).sum(1, dtype=np.uint64), length)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shards.blocks(hashes, length)),
                     *(pa.array(lane_bits(hashes, i).view(np.int64)) for i in range(LANES))], ["block", *names])

    rows = words.select("word").mapInArrow(set_bits, "block bigint, " + ", ".join(f"{n} bigint" for n in names))
    return rows.groupBy("block").agg(*(F.bit_or(n).alias(n) for n in names))


class Filter:
    """A range of the row of blocks."""

    def __init__(self, first: int, lanes: np.ndarray):
        self.first, self.lanes = first, lanes

    def holds(self, hashes: np.ndarray, blocks: np.ndarray) -> np.ndarray:
        """The places of hashes that may belong to a word."""
        at = blocks - self.first
        open_ = np.flatnonzero((at >= 0) & (at < len(self.lanes)))
        for lane in range(LANES):
            if not len(open_):
                break
            bits = lane_bits(hashes[open_], lane)
            open_ = open_[self.lanes[at[open_], lane] & bits != 0]
        return open_


def near_candidates(words: list[str], length: int, alphabet: np.ndarray, shards: Shards,
                    part: Filter) -> Iterator[tuple[int, str]]:
    """Number of a word (all have the length) and an edit of it that the filter lets through."""
    letters = letters_of(words, length)
    places = np.arange(length)
    values = letter_values(places, letters)
    total = values.sum(1, dtype=np.uint64)
    if min(length - 1, POOLED) in shards.firsts:
        moved = letter_values(np.maximum(places - 1, 0), letters)
        before = np.cumsum(values, axis=1, dtype=np.uint64) - values
        after = moved.sum(1, dtype=np.uint64)[:, None] - np.cumsum(moved, axis=1, dtype=np.uint64)
        new = np.ones(letters.shape, bool)  # of equal letters side by side one is deleted
        new[:, 1:] = letters[:, 1:] != letters[:, :-1]
        rows, at = np.nonzero(new)
        hashes = finished((before + after)[rows, at], length - 1)
        for i in part.holds(hashes, shards.blocks(hashes, length - 1)).tolist():
            word, p = words[rows[i]], int(at[i])
            yield int(rows[i]), word[:p] + word[p + 1:]
    if shards.counts.get(min(length, POOLED), 0) < 2:
        return
    step = max(1, CELLS // (len(words) * max(1, len(alphabet))))
    for begin in range(0, length, step):
        own = places[begin:begin + step]
        later = alphabet[None, None, :] > letters[:, own, None]
        fresh = letter_values(own[:, None], alphabet[None, :])
        sums = (total[:, None] - values[:, own])[:, :, None] + fresh[None, :, :]
        rows, at, which = np.nonzero(later)
        hashes = finished(sums[rows, at, which], length)
        for i in part.holds(hashes, shards.blocks(hashes, length)).tolist():
            word, p = words[rows[i]], int(own[at[i]])
            yield int(rows[i]), word[:p] + chr(alphabet[which[i]]) + word[p + 1:]


# ---- on Spark

def near_words(words: DataFrame, blocks: int = BLOCKS) -> DataFrame:
    """``word``, ``n``, ``near``, ``near_n``: each two of the ``words`` (``word``, ``n``; distinct, of a-z and
    U+00C0 to U+00FF) that differ by one inserted, deleted or replaced letter, once."""
    spark = ship(words.sparkSession)
    length = F.least(F.char_length("word"), F.lit(POOLED)).alias("shard")
    shards = Shards({r["shard"]: r["count"] for r in words.groupBy(length).count().collect()})  # POOLED at most
    letters = words.select(F.explode(F.array_distinct(F.split("word", ""))).alias("letter")).distinct()
    alphabet = np.array(sorted(ord(r["letter"]) for r in letters.collect() if r["letter"]), np.uint8)  # 90 at most
    rows = settle(_filter_rows(words, shards), "filter-blocks")

    def probe(part) -> DataFrame:
        def edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                strings, counts = batch.column("word").to_pylist(), batch.column("n").to_numpy()
                found: list[tuple[int, str]] = []
                for size, own in by_length(strings):
                    found += [(own[i], edit) for i, edit in near_candidates(
                        [strings[i] for i in own], size, alphabet, shards, part.value)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([strings[i] for i, _ in found], pa.string()),
                     pa.array([int(counts[i]) for i, _ in found], pa.int64()),
                     pa.array([edit for _, edit in found], pa.string())], ["word", "n", "near"])

        return words.select("word", "n").mapInArrow(edits, "word string, n bigint, near string")

    parts = []
    for first in range(0, shards.total, blocks):
        size = min(blocks, shards.total - first)
        own = rows.where((F.col("block") >= first) & (F.col("block") < first + size)).toArrow()
        lanes = np.zeros((size, LANES), np.uint64)
        at = own.column("block").to_numpy() - first
        for lane in range(LANES):
            lanes[at, lane] = own.column(f"lane{lane}").to_numpy().view(np.uint64)
        parts.append(probe(spark.sparkContext.broadcast(Filter(first, lanes))))
    if not parts:
        return words.select("word", "n", F.col("word").alias("near"), F.col("n").alias("near_n"))
    exact = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    return reduce(DataFrame.union, parts).join(exact, "near").select("word", "n", "near", "near_n")


def roots(forms: DataFrame) -> DataFrame:
    """``word``, ``root``: where the forms (``word``, ``form``, without circles) lead to. Each step doubles the
    way, so a chain of n forms takes about log2(n) steps."""
    now = settle(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        further = settle(now.join(ahead, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        release(now)
        now = further
        if now.where("moved").isEmpty():
            return now.select("word", "root")
        now = now.drop("moved")
        now.settled_at = further.settled_at


def spelling_variants(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT,
                      ratio: int = RATIO, blocks: int = BLOCKS, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n`` of each word of the texts.

    A word's form is its most frequent near word (of equal ones the first in code-point order) if that
    is at least ``ratio`` times as frequent, else null; its root is where the forms lead to, itself without
    a form. Frequencies grow along a chain of forms, so it has no circle and few steps. Null and empty texts
    hold no words; an empty table gives no rows; other columns are ignored.
    """
    words = settle(word_counts(docs, least_length, least_count, id_col, text_col), "words")
    found = settle(near_words(words, blocks), "near-words")
    both = found.union(found.select("near", "near_n", "word", "n"))
    best = both.groupBy("word").agg(F.count("*").alias("n_near"),
                                    F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    named = settle(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(-F.col("best.less") >= F.lit(ratio) * F.col("n"), F.col("best")).alias("best")).select(
        "word", "n", "n_near", F.col("best.near").alias("form"), (-F.col("best.less")).alias("form_n")), "forms")
    led = roots(named.where("form is not null").select("word", "form"))
    return named.join(led, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
