"""Token ids in compressed files: static range asymmetric numeral systems in interleaved blocks.

One frequency table, counted over all ids, serves all blocks. A block holds whole documents of
one stretch of the order, its ids dealt over lanes; all lanes take a step at once. Every
``SEGMENT`` steps a checkpoint keeps the lanes' states and the place in the stream, so that the
segments of a block are decoded side by side, or alone. Two checksums guard a block: one of its
bytes, one of its ids.

Files are Parquet tables, so that writing commits as a whole and any store that Spark reaches can
hold them: ``blocks`` with one row for each block, the index of its documents in plain columns and
the coded ids in ``payload``; ``table`` with the frequencies.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wayfare.llm import bpe, texts
from wayfare.llm.texts import pieces
from wayfare.session import remove_path, scratch_path

MAGIC = b"RNS1"
HEADER = struct.Struct("<4s6I")  # magic, ids, lanes, segments, steps in a segment, crc of ids, crc of table
LOW = np.uint64(1 << 31)  # states stay in [2^31, 2^63)
WORD = np.uint64(32)
BLOCK_IDS, LANES, SEGMENT = 1 << 18, 1024, 128


class Table:
    """Frequencies that sum to a power of two, at least 1 for every id that occurs."""

    def __init__(self, frequencies: np.ndarray):
        self.frequencies = np.asarray(frequencies, np.uint32)
        self.bits = int(self.frequencies.sum(dtype=np.int64)).bit_length() - 1
        if self.frequencies.sum(dtype=np.int64) != 1 << self.bits:
            raise ValueError("frequencies must sum to a power of two")
        self.freq = self.frequencies.astype(np.uint64)
        self.below = np.cumsum(self.freq) - self.freq
        self.crc = zlib.crc32(self.frequencies.astype("<u4").tobytes())
        self.most_common = int(self.frequencies.argmax())

    @classmethod
    def of_counts(cls, counts: np.ndarray) -> "Table":
        counts = np.asarray(counts, np.int64)
        seen = np.flatnonzero(counts)
        if not len(seen):
            return cls(np.array([1], np.uint32))
        bits = max(12, int(len(seen)).bit_length() + 2)
        freq = np.zeros(len(counts), np.int64)
        freq[seen] = np.maximum(1, (counts[seen].astype(np.float64) * (1 << bits) / counts.sum()).astype(np.int64))
        over = int(freq.sum()) - (1 << bits)
        if over < 0:
            freq[seen[np.argmax(freq[seen])]] -= over
        for i in sorted(seen, key=lambda i: -freq[i]) if over > 0 else []:
            cut = min(over, int(freq[i]) // 2)
            freq[i] -= cut
            over -= cut
            if not over:
                break
        return cls(freq)

    @property
    def id_at(self) -> np.ndarray:
        """The id of each slot."""
        if not hasattr(self, "_id_at"):
            self._id_at = np.repeat(np.arange(len(self.freq), dtype=np.uint32), self.frequencies)
        return self._id_at


def encode(ids: np.ndarray, table: Table) -> bytes:
    """One block."""
    n = len(ids)
    lanes = max(1, min(LANES, n // 64))
    steps = -(-n // lanes)
    segments = max(1, -(-steps // SEGMENT))
    grid = np.full(steps * lanes, table.most_common, np.int64)
    grid[:n] = ids
    if n and (grid.min() < 0 or grid.max() >= len(table.freq) or not table.frequencies[grid].all()):
        raise ValueError("an id that the table does not know")
    grid = grid.reshape(steps, lanes)
    bits, room = np.uint64(table.bits), np.uint64(63 - table.bits)
    state = np.full(lanes, LOW, np.uint64)
    words: list[np.ndarray] = []
    states = np.empty((segments, lanes), np.uint64)
    sizes = np.zeros(segments, np.int64)
    states[:] = LOW
    for step in range(steps - 1, -1, -1):
        f = table.freq[grid[step]]
        full = state >= f << room
        out = state[full]
        words.append((out & np.uint64(0xFFFFFFFF)).astype("<u4"))
        state[full] = out >> WORD
        whole = state // f
        state = (whole << bits) + table.below[grid[step]] + (state - whole * f)
        sizes[step // SEGMENT] += len(out)
        if step % SEGMENT == 0:
            states[step // SEGMENT] = state
    head = HEADER.pack(MAGIC, n, lanes, segments, SEGMENT, zlib.crc32(ids.astype("<u4").tobytes()), table.crc)
    body = b"".join([head, sizes.astype("<u4").tobytes(), states.astype("<u8").tobytes(),
                     *(w.tobytes() for w in reversed(words))])
    return body + struct.pack("<I", zlib.crc32(body))


def decode(block: bytes, table: Table, only: int | None = None) -> np.ndarray:
    """The ids of a block, or of one of its segments; damage raises ValueError."""
    if len(block) < HEADER.size + 4 or zlib.crc32(block[:-4]) != struct.unpack("<I", block[-4:])[0]:
        raise ValueError("the block is damaged: its bytes do not match their checksum")
    magic, n, lanes, segments, segment, crc, table_crc = HEADER.unpack_from(block)
    if magic != MAGIC or table_crc != table.crc:
        raise ValueError("the block was written with another format or table")
    at = HEADER.size
    sizes = np.frombuffer(block, "<u4", segments, at).astype(np.int64)
    states = np.frombuffer(block, "<u8", segments * lanes, at + 4 * segments).reshape(segments, lanes)
    at += 4 * segments + 8 * segments * lanes
    words = np.frombuffer(block, "<u4", (len(block) - 4 - at) // 4, at).astype(np.uint64)
    place = np.cumsum(sizes) - sizes
    steps = -(-n // lanes)
    chosen = np.arange(segments) if only is None else np.array([only])
    state, place = states[chosen].copy(), place[chosen]
    lasts = np.minimum(steps - chosen * segment, segment)  # all the same but for the last segment
    ids = np.zeros((len(chosen), segment, lanes), np.uint32)
    bits, mask = np.uint64(table.bits), np.uint64((1 << table.bits) - 1)
    id_at = table.id_at
    for step in range(int(lasts.max(initial=0))):
        k = int((lasts > step).sum())
        x = state[:k]
        slot = x & mask
        found = id_at[slot]
        ids[:k, step] = found
        x = table.freq[found] * (x >> bits) + slot - table.below[found]
        low = x < LOW
        ranks = np.cumsum(low, axis=1)
        taken = (place[:k, None] + ranks - 1)[low]
        x[low] = x[low] << WORD | words[taken]
        place[:k] += ranks[:, -1]
        state[:k] = x
    if only is not None:
        first = only * segment * lanes
        return ids.reshape(-1)[:max(0, min(n - first, int(lasts[0]) * lanes))]
    ids = ids.reshape(-1)[:n]
    if zlib.crc32(ids.astype("<u4").tobytes()) != crc:
        raise ValueError("the block is damaged: its ids do not match their checksum")
    return ids


# ---- on Spark

class _Library:
    """Ids of distinct words by the model of the tokenizers library, which takes words as byte signs."""

    def __init__(self, content: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallel part
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_str(content).model
        self.signs = bpe.byte_signs()
        self.specials = bpe.vocabulary(content).specials

    def ids(self, word: str) -> list[int]:
        if word in self.specials:
            return [self.specials[word]]
        signs = word.encode("utf-8", "replace").decode("latin-1").translate(self.signs)
        return [token.id for token in self.model.tokenize(signs)]

    def __call__(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [self.ids(word) for word in words]
        counts = np.array([len(x) for x in found], np.int32)
        return np.fromiter((i for x in found for i in x), np.int32, int(counts.sum())), counts


@lru_cache(maxsize=2)
def _library_encoder(content: str) -> bpe.Encoder:
    return bpe.Encoder(bpe.vocabulary(content), _Library(content))


ROWS = "part int, nth bigint, doc_id {kind}, n int, ids binary"
BLOCKS = ("part int, nth bigint, doc_ids array<{kind}>, lengths array<int>, n_ids bigint, payload binary")


def ordered_ids(docs: DataFrame, tokenizer: str, end_id: int = 0, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """Each document's ids and the end id, in the order of ``doc_id`` (nulls first; equal ids in
    the order of a hash of the text): ``part`` and ``nth`` count the places in that order."""
    spark = docs.sparkSession
    content = spark.sparkContext.broadcast(bpe.read_vocabulary(tokenizer))
    kind = docs.schema[id_col].dataType.simpleString()

    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, nth = _library_encoder(content.value), TaskContext.get().partitionId(), 0
        for piece in pieces(batches, "text"):
            ids, starts = encoder(texts.of_arrow(piece.column("text")))
            n = piece.num_rows
            ids = np.insert(ids, starts[1:], end_id).astype("<u4")
            starts = 4 * (starts + np.arange(n + 1))
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(n, part), pa.int32()), pa.array(np.arange(nth, nth + n), pa.int64()),
                piece.column("doc_id"), pa.array(np.diff(starts) // 4, pa.int32()),
                pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(starts.astype(np.int32)),
                                                       pa.py_buffer(ids)]),
            ], ["part", "nth", "doc_id", "n", "ids"])
            nth += n

    key = [F.col("doc_id"), F.xxhash64("text")]
    return (docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
            .repartitionByRange(*key).sortWithinPartitions(*key)
            .mapInArrow(tokenize, ROWS.format(kind=kind)))


def count_ids(rows: DataFrame) -> np.ndarray:
    """How often each id occurs in all rows. Its size is the vocabulary's."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            ids = np.concatenate([np.frombuffer(x.as_buffer(), "<u4") for x in batch.column("ids")])
            found = np.bincount(ids)
            if len(found) > len(total):
                total, found = found, total
            total[:len(found)] += found
        seen = np.flatnonzero(total)
        if len(seen):
            yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(total[seen], pa.int64())],
                                             ["id", "n"])

    found = rows.select("ids").mapInArrow(count, "id int, n bigint").groupBy("id").agg(
        F.sum("n").alias("n")).toPandas()
    counts = np.zeros(int(found["id"].max()) + 1 if len(found) else 1, np.int64)
    counts[found["id"].to_numpy(np.int64)] = found["n"].to_numpy(np.int64)
    return counts


def write_ids(docs: DataFrame, path: str, tokenizer: str, end_id: int = 0, id_col: str = "doc_id",
              text_col: str = "text") -> None:
    """Write all documents' ids below ``path`` in ascending ``doc_id`` order.

    Null texts count as empty, repeated rows are written one by one, a null id comes first, an
    empty table gives files without blocks; other columns are ignored. A document longer than a
    block has a block of its own.
    """
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    stored = scratch_path(spark, "ordered-ids")
    ordered_ids(docs, tokenizer, end_id, id_col, text_col).write.option(
        "compression", "zstd").parquet(stored)
    rows = spark.read.schema(ROWS.format(kind=kind)).parquet(stored)
    table = Table.of_counts(count_ids(rows))
    shared = spark.sparkContext.broadcast(table.frequencies)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Table(shared.value)
        held: list[tuple] = []
        size = 0

        def block() -> pa.RecordBatch:
            ids = np.concatenate([np.frombuffer(row[4], "<u4") for row in held])
            return pa.RecordBatch.from_pydict({
                "part": pa.array([held[0][0]], pa.int32()), "nth": pa.array([held[0][1]], pa.int64()),
                "doc_ids": pa.array([[row[2] for row in held]], pa.list_(kind_of["type"])),
                "lengths": pa.array([[row[3] for row in held]], pa.list_(pa.int32())),
                "n_ids": pa.array([len(ids)], pa.int64()), "payload": pa.array([encode(ids, own)], pa.binary())})

        kind_of: dict = {}
        for batch in batches:
            kind_of["type"] = batch.schema.field("doc_id").type
            columns = [batch.column(k).to_pylist() for k in ("part", "nth", "doc_id", "n")]
            for *row, ids in zip(*columns, batch.column("ids")):
                after = held and (row[0], row[1]) != (held[-1][0], held[-1][1] + 1)
                if held and (after or size + row[3] > BLOCK_IDS):
                    yield block()
                    held, size = [], 0
                held.append((*row, ids.as_buffer()))
                size += row[3]
        if held:
            yield block()

    coded = rows.mapInArrow(blocks, BLOCKS.format(kind=kind))
    coded.write.option("compression", "none").parquet(f"{path}/blocks")
    remove_path(spark, stored)
    spark.createDataFrame([(table.frequencies.astype("<u4").tobytes(),)], "frequencies binary").coalesce(
        1).write.parquet(f"{path}/table")


def read_blocks(spark: SparkSession, path: str) -> tuple[DataFrame, np.ndarray]:
    row = spark.read.schema("frequencies binary").parquet(f"{path}/table").first()
    return spark.read.parquet(f"{path}/blocks"), np.frombuffer(row["frequencies"], "<u4")


def read_ids(spark: SparkSession, path: str, crc_only: bool = False) -> DataFrame:
    """From files of ``write_ids``: ``doc_id``, ``start`` (ids of all documents before it),
    ``n_tokens`` and ``ids`` (or, to spare their transfer, their ``ids_crc32``). Damaged files fail."""
    blocks, frequencies = read_blocks(spark, path)
    shared = spark.sparkContext.broadcast(frequencies)
    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Table(shared.value)
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                ids = decode(one.column("payload")[0].as_py(), table)
                lengths = one.column("lengths").flatten().to_numpy()
                ends = np.cumsum(lengths, dtype=np.int64)
                if ends[-1] != len(ids):
                    raise ValueError("the block is damaged: its index does not match its ids")
                n = len(lengths)
                if crc_only:
                    raw = memoryview(ids.astype("<u4").tobytes())
                    last = pa.array([zlib.crc32(raw[4 * (b - k):4 * b]) for b, k in zip(ends.tolist(), lengths.tolist())],
                                    pa.int64())
                else:
                    last = bpe.list_column(ids.astype(np.int32), np.concatenate([[0], ends]), pa.int32())
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(n, one.column("part")[0].as_py()), pa.int32()),
                    pa.array(np.full(n, one.column("nth")[0].as_py()), pa.int64()),
                    one.column("doc_ids").flatten(), pa.array(ends - lengths, pa.int64()),
                    pa.array(lengths, pa.int64()), last,
                ], ["part", "nth", "doc_id", "inside", "n_tokens", "last"])

    ids = blocks.select("part", "nth", "doc_ids", "lengths", "payload").mapInArrow(
        documents, f"part int, nth bigint, doc_id {kind}, inside bigint, n_tokens bigint, "
                   f"last {'bigint' if crc_only else 'array<int>'}")
    return (ids.join(block_starts(blocks), ["part", "nth"])
            .select("doc_id", (F.col("before") + F.col("inside")).alias("start"), "n_tokens",
                    F.col("last").alias("ids_crc32" if crc_only else "ids")))


def block_starts(blocks: DataFrame) -> DataFrame:
    """``before``: the ids in front of each block; reads the index columns only. Sums run over the
    blocks of a part and over the parts, of which there are as many as tasks wrote."""
    inside = Window.partitionBy("part").orderBy("nth").rowsBetween(Window.unboundedPreceding, -1)
    parts = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))
    line = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(line), F.lit(0)).alias("ahead"))
    return (blocks.select("part", "nth", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)).alias("sum"))
            .join(parts, "part").select("part", "nth", (F.col("ahead") + F.col("sum")).alias("before")))
