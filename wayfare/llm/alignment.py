"""Alignment of the tokens of two tokenizers over the same texts.

Equal texts are brought together by a shuffle on the full text; each distinct text is tokenised and
aligned once and counts as often as it occurs. Both tokenizers' tokens are spans of the same bytes: each
span between two neighbouring token ends belongs to one token of either side, which is a link, and
places where both have an end cut the text into groups.

How many documents hold a pair of ids linked is added up over the distinct texts. The most frequent pairs
(at most ``COMMON``) are sent to all tasks, which look up the links of their texts; only links of rarer
pairs are shuffled to their counts and back.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.llm import bpe, texts
from wayfare.llm.texts import expand, pieces, segment_sums
from wayfare.session import settle, ship

COMMON = 1 << 20  # pairs sent to all tasks, 17 bytes each
HOT = 1000  # texts that make up more than one row in so many are at most so many: sent, too

MEASURES = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]


# ---- tokenizers as ids and the bytes of ids

class ByteTokens:
    """Ids of the byte-level vocabulary; texts of special tokens are plain text."""

    def __init__(self, content: str):
        own = bpe.vocabulary(content)
        self.encoder, self.pieces = bpe.Encoder(own), own.pieces
        self.encoder.specials = None

    def __call__(self, strings: list[str]) -> list[np.ndarray]:
        ids, starts = self.encoder(texts.of_strings(strings))
        return np.split(ids, starts[1:-1])


class PieceTokens:
    """Ids of a sentence-piece model, which puts a space before the text itself."""

    def __init__(self, content: bytes):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor()
        self.model.LoadFromSerializedProto(content)
        self.pieces = [self._bytes(i) for i in range(self.model.get_piece_size())]

    def _bytes(self, i: int) -> bytes:
        piece = self.model.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.replace("▁", " ").encode()

    def __call__(self, strings: list[str]) -> list[np.ndarray]:
        return [np.array(ids, np.int32) for ids in self.model.encode(strings, num_threads=1)]


class PieceBytes:
    """The bytes of ids, and the ids written out."""

    def __init__(self, pieces_: list[bytes]):
        self.lens = np.array([len(p) for p in pieces_], np.int64)
        self.starts = np.cumsum(self.lens) - self.lens
        self.flat = np.frombuffer(b"".join(pieces_), np.uint8)
        self.names = [str(i) for i in range(len(pieces_))]

    def joined(self, ids: np.ndarray) -> bytes:
        return self.flat[expand(self.starts[ids], self.lens[ids])].tobytes()


class Aligned:
    """One text's groups and links. ``pairs`` has ``a << 32 | b`` of each link."""

    def __init__(self, a: np.ndarray, b: np.ndarray, a_ends: np.ndarray, b_ends: np.ndarray):
        self.a, self.b = a, b
        ends = np.union1d(a_ends, b_ends)
        self.pairs = (a[np.searchsorted(a_ends, ends)].astype(np.int64) << 32
                      | b[np.searchsorted(b_ends, ends)].astype(np.int64))
        both = np.intersect1d(a_ends, b_ends, assume_unique=True)
        self.a_cuts = np.searchsorted(a_ends, both) + 1
        self.b_cuts = np.searchsorted(b_ends, both) + 1

    def written(self, a_names: list[str], b_names: list[str]) -> str:
        a, b = [a_names[i] for i in self.a.tolist()], [b_names[i] for i in self.b.tolist()]
        parts, i, k = [], 0, 0
        for j, m in zip(self.a_cuts.tolist(), self.b_cuts.tolist()):
            left = a[i] if j == i + 1 else ",".join(a[i:j])
            parts.append(f"{left}|{b[k] if m == k + 1 else ','.join(b[k:m])}")
            i, k = j, m
        return ";".join(parts)


class Aligner:
    def __init__(self, byte_vocabulary: str, piece_model: bytes):
        self.first, self.second = ByteTokens(byte_vocabulary), PieceTokens(piece_model)
        self.a, self.b = PieceBytes(self.first.pieces), PieceBytes(self.second.pieces)

    def __call__(self, strings: list[str | None]) -> list[Aligned | None]:
        """None for texts without tokens: null, empty, or not the bytes of the tokens."""
        own = [i for i, s in enumerate(strings) if s]
        found: list[Aligned | None] = [None] * len(strings)
        spaced = [" " + strings[i] for i in own]
        for i, text, a, b in zip(own, spaced, self.first(spaced), self.second([strings[i] for i in own])):
            raw = text.encode("utf-8", "surrogatepass")
            a_ends, b_ends = np.cumsum(self.a.lens[a]), np.cumsum(self.b.lens[b])
            if len(a) and len(b) and a_ends[-1] == b_ends[-1] == len(raw) and self.a.joined(a) == raw == self.b.joined(b):
                found[i] = Aligned(a, b, a_ends, b_ends)
        return found


@lru_cache(maxsize=2)
def _aligner(byte_vocabulary: str, piece_model: bytes) -> Aligner:
    return Aligner(byte_vocabulary, piece_model)


def read_model(path: str) -> bytes:
    """The model file, read on the driver; its size is checked."""
    with open(path, "rb") as file:
        content = file.read()
    if len(content) > 64 << 20:
        raise ValueError(f"{path} is no model file: {len(content)} bytes")
    return content


# ---- on Spark

def _lists(values: np.ndarray, lens: list[int], kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *lens]), pa.int32()), pa.array(values, kind))


def aligned_texts(distinct: DataFrame, byte_path: str, piece_path: str) -> DataFrame:
    """``key``, ``times``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``groups_sha256``, ``pairs`` and ``held`` (how
    often the text holds the pair) of texts (``key``, ``times``, ``text``)."""
    context = ship(distinct.sparkSession).sparkContext
    shared = context.broadcast((bpe.read_vocabulary(byte_path), read_model(piece_path)))

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(*shared.value)
        for piece in pieces(batches, "text"):
            counts, digests, pairs, held = [], [], [], []
            for found in aligner([None if raw is None else raw.decode("utf-8", "replace")
                                  for raw in piece.column("text").to_pylist()]):
                if found is None:
                    counts.append((0, 0, 0, 0))
                    digests.append("")
                    own, times = np.empty(0, np.int64), np.empty(0, np.int64)
                else:
                    counts.append((len(found.a), len(found.b), len(found.a_cuts), len(found.pairs)))
                    written = found.written(aligner.a.names, aligner.b.names)
                    digests.append(hashlib.sha256(written.encode()).hexdigest())
                    own, times = np.unique(found.pairs, return_counts=True)
                pairs.append(own)
                held.append(times)
            lens = [len(p) for p in pairs]
            yield pa.RecordBatch.from_arrays(
                [piece.column("key"), piece.column("times"),
                 *(pa.array(list(x), pa.int64()) for x in zip(*counts)), pa.array(digests),
                 _lists(np.concatenate(pairs), lens, pa.int64()), _lists(np.concatenate(held), lens, pa.int32())],
                ["key", "times", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "held"])

    return distinct.mapInArrow(
        align, "key binary, times bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
               "groups_sha256 string, pairs array<bigint>, held array<int>")


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``pair``, ``n`` (documents that hold it linked), ``best`` (no pair of its first id has more)."""
    counts = aligned.select("times", F.explode("pairs").alias("pair")).groupBy("pair").agg(F.sum("times").alias("n"))
    first = F.shiftright("pair", 32)
    most = counts.groupBy(first.alias("a")).agg(F.max("n").alias("most"))
    return (counts.withColumn("a", first).join(most, "a")
            .select("pair", "n", (F.col("n") == F.col("most")).alias("best")))


def common_pairs(counts: DataFrame, most: int = COMMON) -> DataFrame:
    """The most frequent pairs, at most ``most``: all from a number of documents on."""
    level = F.when(F.col("n") < 64, F.col("n")).otherwise(F.floor(64 * F.log2(F.col("n"))).cast("bigint"))
    levels = counts.groupBy(level.alias("level")).agg(F.count("*").alias("pairs")).orderBy(F.desc("level")).collect()
    least, total = None, 0  # some thousand levels at most: 64 up to 64, then 64 for each doubling
    for row in levels:
        total += row["pairs"]
        if total > most:
            break
        least = row["level"]
    return counts.where(F.lit(False) if least is None else level >= least)


def pair_measures(aligned: DataFrame, counts: DataFrame, most: int = COMMON) -> DataFrame:
    """``key``, ``n_best``, ``count_sum`` of each aligned text."""
    common = common_pairs(counts, most)
    sent = common.orderBy("pair").toArrow()
    shared = counts.sparkSession.sparkContext.broadcast(
        (sent.column("pair").to_numpy(), sent.column("n").to_numpy(), sent.column("best").to_numpy()))

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, n, best = shared.value
        for batch in batches:
            lens = batch.column("pairs").value_lengths().to_numpy(zero_copy_only=False)
            pairs = batch.column("pairs").flatten().to_numpy()
            held = batch.column("held").flatten().to_numpy().astype(np.int64)
            starts = np.concatenate([[0], np.cumsum(lens)])
            at = np.minimum(np.searchsorted(known, pairs), max(0, len(known) - 1))
            hit = known[at] == pairs if len(known) else np.zeros(len(pairs), bool)
            found = np.zeros((2, len(pairs)), np.int64)
            if len(known):
                found[0] = np.where(hit & best[at], held, 0)
                found[1] = np.where(hit, held * n[at], 0)
            left = segment_sums(~hit, starts)
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(segment_sums(found[0], starts)), pa.array(segment_sums(found[1], starts)),
                 _lists(pairs[~hit], left.tolist(), pa.int64()), _lists(held[~hit], left.tolist(), pa.int32())],
                ["key", "n_best", "count_sum", "pairs", "held"])

    own = aligned.select("key", "pairs", "held").mapInArrow(
        look_up, "key binary, n_best bigint, count_sum bigint, pairs array<bigint>, held array<int>")
    if common.count() == counts.count():
        return own.drop("pairs", "held")
    own = settle(own, "common-links")
    rare = own.select("key", F.explode(F.arrays_zip("pairs", "held")).alias("x")).select("key", "x.pairs", "x.held")
    rare = (rare.join(counts.withColumnRenamed("pair", "pairs"), "pairs")
            .select("key", F.when(F.col("best"), F.col("held")).otherwise(0).cast("bigint").alias("n_best"),
                    (F.col("held") * F.col("n")).alias("count_sum")))
    return own.select("key", "n_best", "count_sum").union(rare).groupBy("key").agg(
        F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def align_documents(docs: DataFrame, byte_path: str, piece_path: str, most: int = COMMON, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum``, ``groups_sha256``, a row for each
    row of ``docs``.

    A is the byte-level tokenizer of ``byte_path`` over a space and the text, B the sentence-piece model of
    ``piece_path`` over the text. ``n_best`` are the links whose pair of ids is held by as many documents as
    the A id's most widespread pair, ``count_sum`` adds up the documents of all links' pairs. Null and
    empty texts, and those whose tokens are not the bytes of a space and the text, have zeros and an empty
    ``groups_sha256``. Repeated rows count each time, a null id is kept, an empty table gives no rows, other
    columns are ignored.
    """
    raw = F.col(text_col).cast("binary")
    own = docs.select(F.col(id_col).alias("doc_id"), raw.alias("text"))
    distinct = own.where(F.length("text") > 0).groupBy("text").agg(F.count("*").alias("times")).select(
        F.unhex(F.sha2("text", 256)).alias("key"), "times", "text")
    aligned = settle(aligned_texts(distinct, byte_path, piece_path), "aligned")
    counts = settle(pair_counts(aligned), "pair-counts")
    measures = aligned.drop("pairs", "held").join(pair_measures(aligned, counts, most), "key")
    measures = settle(measures.select("key", "times", *MEASURES, "groups_sha256"), "measures")
    keyed = own.select("doc_id", F.when(F.length("text") > 0, F.unhex(F.sha2("text", 256))).alias("key"))
    # rows of the few texts that have a share of all rows meet their measures in place
    rows = measures.agg(F.sum("times")).first()[0] or 0
    hot = measures.where(F.col("times") > F.lit(rows / HOT))
    names = [*MEASURES, "groups_sha256"]
    near = hot.select(F.col("key").alias("hot_key"), F.struct(*names).alias("near"))
    met = keyed.join(F.broadcast(near), F.col("key") == F.col("hot_key"), "left")
    rest = measures.where(F.col("times") <= F.lit(rows / HOT)).select("key", F.struct(*names).alias("far"))
    # rows that have their measures, or no tokens, get a key of their own that nothing has, so they spread
    alone = F.monotonically_increasing_id().cast("string").cast("binary")
    met = met.select("doc_id", "near", F.when(F.col("near").isNull(), F.col("key")).alias("key"))
    found = met.withColumn("key", F.coalesce("key", alone)).join(rest, "key", "left").select(
        "doc_id", F.coalesce("near", "far").alias("found"))
    zero = {"groups_sha256": F.lit("")}
    return found.select("doc_id", *(
        F.coalesce(F.col(f"found.{name}"), zero.get(name, F.lit(0).cast("bigint"))).alias(name) for name in names))
