"""Near-duplicates by SimHash, compared in bit slices.

A fingerprint has 64 bits, each set if most shingles of the text have it in their hash. Fingerprints
that differ in at most ``radius`` bits agree on ``radius`` blocks fewer than there are; with two
blocks more than the radius, each pair within it meets in a bucket of two whole blocks. Within a bucket the
fingerprints lie as bit planes; a shift by d places compares each with its d-th neighbour, 64 at a
time, and carry-save adders count the differing bits. Words of 64 comparisons that are all beyond
the radius are abandoned after the first planes.

Copies share one fingerprint and are compared once. A bucket of very many fingerprints is cut into
chunks, and each pair of chunks is a bucket of its own; only links that join something new
within a task are passed on, never all pairs of a bucket.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import reduce
from itertools import combinations
from random import Random

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.llm.components import components
from wayfare.llm.texts import pieces
from wayfare.session import release, settle, ship

SEED = 42
CHUNK = 2048  # fingerprints of a bucket in one piece
SENT_BUCKETS = 100_000  # at most so many large buckets are sent to all tasks
ROUND = 32  # masks searched at a time, so that the disk holds the rows of so many
BINS = 512  # bytes of the sketch that refuses pairs within a bucket
MARGIN = 0.06  # so far below the similarity, more than three standard deviations of the sketch
AT_ONCE = 4096  # rows of whole buckets compared at a time where pairs are kept
KEPT = 4096  # shingles of a set, its least, that are sent to the buckets where links were refused


# ---- fingerprints

def shingle_hashes(text: str | None, width: int, seed: int = SEED) -> list[int]:
    """XXH64 of each shingle: ``width`` words (whitespace-separated, A-Z lowered), joined by
    spaces; a shorter text is one shingle, one without words none."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return []
    if len(words) < width:
        return [xxh64_intdigest(b" ".join(words), seed)]
    joined = b" ".join(words)
    lens = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lens + 1) - 1
    starts = (ends - lens)[:len(words) - width + 1].tolist()
    return [xxh64_intdigest(joined[s:e], seed) for s, e in zip(starts, ends[width - 1:].tolist())]


def mixed(hashes: np.ndarray, word: int) -> np.ndarray:
    """For further words of a fingerprint: independent hashes made from the first."""
    if not word:
        return hashes
    z = (hashes ^ np.uint64(word)) * np.uint64(0x9E3779B97F4A7C15)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return z ^ (z >> np.uint64(29))


def majority(hashes: np.ndarray, starts: np.ndarray, ties: bool = False) -> np.ndarray:
    """For each slice of hashes the bits that are set in more than half of them; with ``ties``, where
    just half have it, the bit of a hash made from the smallest."""
    found = np.zeros(len(starts) - 1, np.uint64)
    lens = np.diff(starts)
    full = np.flatnonzero(lens)
    if len(full):
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts = np.add.reduceat(bits, starts[full], axis=0, dtype=np.int32)
        most = np.packbits(2 * counts > lens[full, None], axis=1, bitorder="little")
        found[full] = np.ascontiguousarray(most).view("<u8").ravel()
        if ties:
            even = np.packbits(2 * counts == lens[full, None], axis=1, bitorder="little")
            least = mixed(np.minimum.reduceat(hashes, starts[full]), 1 << 32)
            found[full] |= np.ascontiguousarray(even).view("<u8").ravel() & least
    return found


def sketch(hashes: np.ndarray) -> bytes:
    """The hashes (sorted, distinct) dealt to ``BINS`` bins; a byte, never 0, of the least one in each bin."""
    found = np.zeros(BINS, np.uint8)
    bins, first = np.unique(hashes >> np.uint64(64 - BINS.bit_length() + 1), return_index=True)
    found[bins.astype(np.int64)] = (hashes[first] >> np.uint64(16)) % np.uint64(255) + np.uint64(1)
    return found.tobytes()


def sketch_likeness(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """The Jaccard similarity that rows of sketches tell, without the share of bytes that are equal by chance."""
    found = np.empty(len(one))
    for i in range(0, len(one), 1 << 14):
        a, b = one[i:i + (1 << 14)], other[i:i + (1 << 14)]
        used = (a | b).astype(bool).sum(1)
        equal = ((a == b) & (a != 0)).sum(1) / np.maximum(used, 1)
        found[i:i + (1 << 14)] = np.where(used == 0, 1.0, (equal * 255 - 1) / 254)
    return found


def fingerprints(docs: DataFrame, width: int = 4, words: int = 1, seed: int = SEED, repeats: bool = True,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``fp`` (the fingerprint's 64-bit words as signed longs), ``node`` (the first word),
    ``text_hash``. Without ``repeats`` each different shingle of a text counts once, ties are broken by
    a hash bit, so that short texts do not crowd at few fingerprints, ``node`` is a hash of the
    text's set of shingles, and ``sketch`` is its sketch.

    Null texts and texts without words have fingerprint 0. Whole texts; other columns are ignored.
    """

    def fingerprint(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh64_intdigest

        for piece in pieces(batches, "text"):
            hashes = [np.array(shingle_hashes(t, width, seed), np.uint64)
                      for t in piece.column("text").to_pylist()]
            if not repeats:
                hashes = [np.unique(h) for h in hashes]
                nodes = np.array([xxh64_intdigest(h.tobytes(), seed) for h in hashes], np.uint64)
                sketches = [sketch(h) for h in hashes]
            starts = np.concatenate([[0], np.cumsum([len(h) for h in hashes])])
            hashes = np.concatenate(hashes)
            found = np.stack([majority(mixed(hashes, w), starts, not repeats) for w in range(words)], axis=1)
            if repeats:
                nodes = found[:, 0]
            edges = pa.array(np.arange(0, found.size + 1, words), pa.int32())
            columns = {"doc_id": piece.column("doc_id"),
                       "fp": pa.ListArray.from_arrays(edges, pa.array(found.view(np.int64).ravel())),
                       "node": pa.array(nodes.view(np.int64)), "text_hash": piece.column("text_hash")}
            if not repeats:
                columns["sketch"] = pa.array(sketches, pa.binary())
            yield pa.RecordBatch.from_pydict(columns)

    ship(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("text_hash"),
    ).mapInArrow(fingerprint, f"doc_id {kind}, fp array<bigint>, node bigint, text_hash bigint"
                 + ("" if repeats else ", sketch binary"))


# ---- bit-sliced comparison

def to_planes(fps: np.ndarray) -> np.ndarray:
    """A row for each bit; bit i of row b is bit b of fingerprint i (a row of 64-bit words)."""
    bits = np.unpackbits(fps.astype("<u8").view(np.uint8).reshape(len(fps), -1), axis=1, bitorder="little")
    return _packed(np.ascontiguousarray(bits.T))


def _packed(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as rows of 64-bit words."""
    room = -bits.shape[1] % 64
    if room:
        bits = np.pad(bits, ((0, 0), (0, room)))
    return np.packbits(bits, axis=1, bitorder="little").view("<u8")


def shifted(planes: np.ndarray, by: int) -> np.ndarray:
    """All lanes moved down by so many places; zeros come in at the end."""
    skip, bits = divmod(by, 64)
    out = np.zeros_like(planes)
    kept = planes.shape[1] - skip
    if kept <= 0:
        return out
    out[:, :kept] = planes[:, skip:]
    if bits:
        out >>= np.uint64(bits)
        out[:, :kept - 1] |= planes[:, skip + 1:] << np.uint64(64 - bits)
    return out


def bit_counts(planes: np.ndarray, start: list[np.ndarray] = ()) -> list[np.ndarray]:
    """How many planes have each lane's bit set, as the planes of a binary number, by carry-save
    adders: three planes of one weight become one of it and one of twice it."""
    found, waiting = [], [planes]
    level = 0
    while waiting or level < len(start):
        rows = np.concatenate(waiting + ([start[level][None]] if level < len(start) else []))
        waiting = []
        while len(rows) > 1:
            third = max(1, len(rows) // 3)
            if len(rows) == 2:
                a, b = rows[:1], rows[1:]
                waiting.append(a & b)
                rows = a ^ b
                continue
            a, b, c = rows[:third], rows[third:2 * third], rows[2 * third:3 * third]
            ab = a ^ b
            waiting.append((a & b) | (ab & c))
            rows = np.concatenate([ab ^ c, rows[3 * third:]])
        found.append(rows[0])
        level += 1
    return found


def beyond(counts: list[np.ndarray], radius: int) -> np.ndarray:
    """Lanes whose count is above the radius."""
    above = np.zeros_like(counts[0])
    equal = ~above
    for level in range(max(len(counts), radius.bit_length()) - 1, -1, -1):
        plane = counts[level] if level < len(counts) else np.zeros_like(above)
        if radius >> level & 1:
            equal &= plane
        else:
            above |= equal & plane
            equal &= ~plane
    return above


def near_neighbours(planes: np.ndarray, by: int, open_: np.ndarray, radius: int) -> np.ndarray:
    """Lanes among the packed ``open_`` ones that are within the radius of the lane ``by`` places on."""
    words = np.flatnonzero(open_)
    if not len(words):
        return np.empty(0, np.int64)
    first = 3 * len(planes) // 8
    counts = bit_counts(planes[:first, words] ^ shifted(planes[:first], by)[:, words])
    left = open_[words] & ~beyond(counts, radius)
    go_on = left != 0  # words with no comparison left inside the radius are abandoned
    if not go_on.any():
        return np.empty(0, np.int64)
    words, left = words[go_on], left[go_on]
    counts = bit_counts(planes[first:, words] ^ shifted(planes[first:], by)[:, words],
                        [c[go_on] for c in counts])
    left &= ~beyond(counts, radius)
    lanes = np.flatnonzero(np.unpackbits(left.astype("<u8").view(np.uint8), bitorder="little"))
    return words[lanes // 64] * 64 + lanes % 64


def close_pairs(buckets: np.ndarray, fps: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of rows of one bucket within the radius, some at a time. ``buckets`` is sorted, ``fps`` has
    rows of words."""
    own = np.arange(len(fps))  # rows that still have a neighbour in their bucket
    planes, by = None, 1
    while True:
        same = buckets[own][by:] == buckets[own][:-by] if len(own) > by else np.empty(0, bool)
        if not same.any():
            return
        if planes is None or 2 * same.sum() < len(own) - by:
            sizes = np.unique(buckets[own], return_inverse=True, return_counts=True)
            keep = sizes[2][sizes[1]] > by
            if planes is None or not keep.all():
                own = own[keep]
                planes = to_planes(fps[own])
                same = buckets[own][by:] == buckets[own][:-by]
        open_ = np.zeros(planes.shape[1] * 64, np.uint8)
        open_[:len(same)] = same
        lanes = near_neighbours(planes, by, np.packbits(open_, bitorder="little").view("<u8"), radius)
        yield own[lanes], own[lanes + by]
        by += 1


def links_in_buckets(buckets: np.ndarray, fps: np.ndarray, radius: int,
                     tight: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Both ends of links of at most ``tight`` bits within each bucket, so many that they span their groups,
    and the rows that are within ``radius`` of a row of another group."""
    root = np.arange(len(fps))
    ones, others = [], []
    wide = [np.empty((2, 0), np.int64)]

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for left, right in close_pairs(buckets, fps, radius):
        new = root[left] != root[right]
        if tight < radius:
            far = np.bitwise_count(fps[left] ^ fps[right]).sum(1) > tight
            if (new & far).any():
                wide.append(np.stack([left[new & far], right[new & far]]))
            new &= ~far
        joined = False
        for i, j in zip(left[new].tolist(), right[new].tolist()):
            a, b = find(i), find(j)
            if a != b:
                root[max(a, b)] = min(a, b)
                ones.append(i)
                others.append(j)
                joined = True
        while joined and (root[root] != root).any():
            root = root[root]
    apart = np.concatenate(wide, axis=1)
    open_ = np.unique(apart[:, root[apart[0]] != root[apart[1]]])
    return np.array(ones, np.int64), np.array(others, np.int64), open_


def alike(one: np.ndarray, other: np.ndarray, similarity: float) -> bool:
    """Whether two sets have the similarity, known by at most their ``KEPT`` least members; by so many it is told
    to within 0.02 (three standard deviations), and what is within that passes."""
    if max(len(one), len(other)) < KEPT:
        shared = len(np.intersect1d(one, other, assume_unique=True))
        return shared >= similarity * (len(one) + len(other) - shared) - 1e-9
    whole = np.union1d(one, other)[:KEPT]
    shared = np.isin(whole, np.intersect1d(one, other, assume_unique=True), assume_unique=True).sum()
    return shared >= (similarity - 0.02) * len(whole)


def best_links(buckets: np.ndarray, nodes: np.ndarray, roots: np.ndarray, fps: np.ndarray, sketches: np.ndarray,
               radius: int, similarity: float, refused: set[tuple[int, int, int]] = frozenset(),
               sets: np.ndarray | None = None, forests: int = 1) -> np.ndarray:
    """Pairs of rows worth a comparison: of those within the radius, with different roots, a likeness of the
    sketches of at most ``MARGIN`` below the similarity, not refused and, if ``sets`` are given, alike by these,
    the likest that span all that hang together so. Of further ones, left out by the first, ``forests``
    times in all."""
    least = similarity - MARGIN
    found = [np.empty((2, 0), np.int64)]
    likely = [np.empty(0)]
    for left, right in close_pairs(buckets, fps, radius):
        apart = roots[left] != roots[right]
        left, right = left[apart], right[apart]
        like = sketch_likeness(sketches[left], sketches[right])
        found.append(np.stack([left, right])[:, like >= least])
        likely.append(like[like >= least])
    pairs, like = np.concatenate(found, axis=1), np.concatenate(likely)
    if refused and len(like):
        ends = np.sort(nodes[pairs], axis=0)
        open_ = [key not in refused for key in zip(buckets[pairs[0]].tolist(), *ends.tolist())]
        pairs, like = pairs[:, open_], like[open_]
    left = pairs[:, np.lexsort((nodes[pairs].max(0), nodes[pairs].min(0), -like))].T.tolist()
    group = np.unique(np.stack([buckets, roots]), axis=1, return_inverse=True)[1].ravel().tolist()
    chosen = []
    for _ in range(forests):
        parent, over = list(range(len(buckets))), []
        for i, j in left:
            a, b = group[i], group[j]
            while parent[a] != a:
                parent[a] = a = parent[parent[a]]
            while parent[b] != b:
                parent[b] = b = parent[parent[b]]
            if a == b:
                over.append((i, j))
            elif sets is None or alike(sets[i], sets[j], similarity):
                parent[max(a, b)] = min(a, b)
                chosen.append((i, j))
        if len(over) == len(left):
            break
        left = over
    return np.array(chosen, np.int64).reshape(-1, 2).T


# ---- on Spark

def block_masks(radius: int) -> list[tuple[int, ...]]:
    """Two of ``radius + 2`` blocks of the 64 bits, in all ways: any two fingerprints within the radius
    agree under one of the masks."""
    blocks = radius + 2
    edges = [64 * i // blocks for i in range(blocks + 1)]
    block = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:])]
    return [(x | y,) for x, y in combinations(block, 2)]


def sampled_masks(words: int, bits: int, tables: int) -> list[tuple[int, ...]]:
    """Masks of so many bits drawn at random. A pair that differs in a share d of its bits agrees
    under a mask with probability (1 - d) ** bits."""
    rng = Random(words * 1000 + bits)
    drawn = [rng.sample(range(64 * words), bits) for _ in range(tables)]
    return [tuple(sum(1 << b % 64 for b in own if b // 64 == w) for w in range(words)) for own in drawn]


def mask_bits(n: int) -> int:
    """So many bits that a bucket has at most one or two hundred of ``n`` fingerprints. Narrower buckets would need
    more masks, and each mask is one more row of every fingerprint; up to a million 12 bits will do."""
    return min(48, max(12, n.bit_length() - 8))


def search_masks(n: int, words: int, share: float, radius: int, miss: float) -> list[tuple[int, ...]]:
    """Masks for ``n`` fingerprints: as many as it takes that of the pairs which differ in ``share`` of
    their bits on average, and in at most ``radius``, no more than ``miss`` agree under none."""
    size, bits = 64 * words, mask_bits(n)
    cases = [(math.comb(size, h) * share ** h * (1 - share) ** (size - h),
              math.comb(size - h, bits) / math.comb(size, bits)) for h in range(radius + 1)]
    allowed = miss * sum(weight for weight, _ in cases)
    tables = 1
    while sum(weight * (1 - agree) ** tables for weight, agree in cases) > allowed:
        tables += 1
    return sampled_masks(words, bits, tables)


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


@contextmanager
def _freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """What is written meanwhile leaves no shuffle files behind."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def linked(groups: DataFrame, masks: list[tuple[int, ...]], radius: int, chunk: int = CHUNK) -> DataFrame:
    """``a``, ``b``: links between nodes whose fingerprints agree under a mask and differ in at most ``radius``
    bits, enough of them to connect all that are connected so."""
    return searched(groups, masks, radius, radius, chunk).select("a", "b")


def searched(groups: DataFrame, masks: list[tuple[int, ...]], radius: int, tight: int,
             chunk: int = CHUNK) -> DataFrame:
    """``a``, ``b``, ``bucket``: links (without bucket) as ``linked`` finds them within ``tight`` bits, and in each
    bucket the nodes ``a`` (without ``b``) that are within ``radius`` of a node which such links of the bucket do not
    connect them with. More than ``ROUND`` masks are searched in several rounds."""
    rounds = -(-len(masks) // ROUND)
    if rounds == 1:
        return _searched(groups, masks, radius, tight, chunk)
    with _freed_shuffles(groups.sparkSession):
        parts = [settle(_searched(groups, masks[i::rounds], radius, tight, chunk).distinct(), "round")
                 for i in range(rounds)]
    return reduce(DataFrame.unionByName, parts)


def _whole_buckets(batches: Iterator[pa.RecordBatch], columns: Callable[[pa.RecordBatch], list[np.ndarray]],
                   at_once: int) -> Iterator[list[np.ndarray]]:
    """The columns (the first is the bucket; sorted) of about so many rows, cut between buckets."""
    waiting: list[list[np.ndarray]] = []
    size = 0
    for batch in batches:
        waiting.append(columns(batch))
        size += batch.num_rows
        if size >= at_once:
            held = [np.concatenate(x) for x in zip(*waiting)]
            end = int(np.searchsorted(held[0], held[0][-1]))  # the last bucket may go on
            if end:
                yield [h[:end] for h in held]
            waiting = [[h[end:] for h in held]]
            size = len(held[0]) - end if end else 0  # a longer one is looked at again when twice as long
    if waiting:
        yield [np.concatenate(x) for x in zip(*waiting)]


def _searched(groups: DataFrame, masks: list[tuple[int, ...]], radius: int, tight: int, chunk: int) -> DataFrame:
    words = len(masks[0])
    keys = [F.xxhash64(F.lit(i), *(F.col("fp")[w].bitwiseAND(F.lit(_signed(m)).cast("bigint"))
                                   for w, m in enumerate(mask))) for i, mask in enumerate(masks)]
    rows = groups.select(F.explode(F.array(*keys)).alias("bucket"), "node", "fp")
    large = settle(rows.groupBy("bucket").count().where(F.col("count") > chunk), "large-buckets")
    if large.count() <= SENT_BUCKETS:  # else it is joined like any table
        large = F.broadcast(large)
    one = F.lit(None).cast("bigint")
    rows = (rows.join(large, "bucket", "left").withColumn("chunks", F.ceil(F.col("count") / chunk))
            .withColumn("own", F.pmod(F.xxhash64("node", F.lit(3)), "chunks"))
            .withColumn("other", F.explode(F.when(F.col("chunks").isNull(), F.array(one)).otherwise(
                F.sequence(F.lit(0).cast("bigint"), F.col("chunks") - 1))))
            .withColumn("bucket", F.when(F.col("other").isNull(), F.col("bucket")).otherwise(
                F.xxhash64("bucket", F.least("own", "other"), F.greatest("own", "other"))))
            .select("bucket", "node", "fp"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def columns(batch: pa.RecordBatch) -> list[np.ndarray]:
            return [batch.column("bucket").to_numpy(), batch.column("node").to_numpy(),
                    batch.column("fp").flatten().to_numpy().reshape(-1, words).view(np.uint64)]

        for buckets, nodes, fps in _whole_buckets(batches, columns, 1 << 16):
            i, j, open_ = links_in_buckets(buckets, fps, radius, tight)
            none = pa.nulls(len(i), pa.int64()), pa.nulls(len(open_), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([np.minimum(nodes[i], nodes[j]), nodes[open_]])),
                 pa.concat_arrays([pa.array(np.maximum(nodes[i], nodes[j])), none[1]]),
                 pa.concat_arrays([none[0], pa.array(buckets[open_])])], ["a", "b", "bucket"])

    return rows.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(
        compare, "a bigint, b bigint, bucket bigint")


def candidates(rows: DataFrame, words: int, radius: int, similarity: float, refused: DataFrame | None = None,
               forests: int = 1) -> DataFrame:
    """``bucket``, ``a``, ``b``: what ``best_links`` passes on of ``rows`` (``bucket``, ``node``, ``root``, ``fp``, ``sketch``, and
    ``kept``, a set's least members, or null); ``refused`` are such links that have proved wrong."""
    none = F.lit(None).cast("bigint")
    given = rows.select("bucket", "node", "root", "fp", "sketch", "kept", none.alias("other"))
    if refused is not None:
        given = given.unionByName(refused.select(
            "bucket", F.col("a").alias("node"), none.alias("root"), F.lit(None).cast("array<bigint>").alias("fp"),
            F.lit(None).cast("binary").alias("sketch"), F.lit(None).cast("array<bigint>").alias("kept"),
            F.col("b").alias("other")))

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def columns(batch: pa.RecordBatch) -> list[np.ndarray]:
            real = batch.column("other").is_null().to_numpy(zero_copy_only=False)
            fps, sketches = np.zeros((len(real), words), np.uint64), np.zeros((len(real), BINS), np.uint8)
            fps[real] = batch.column("fp").flatten().to_numpy().reshape(-1, words).view(np.uint64)
            sketches[real] = np.frombuffer(b"".join(x for x in batch.column("sketch").to_pylist() if x is not None),
                                           np.uint8).reshape(-1, BINS)
            filled = [batch.column(n).fill_null(0).to_numpy() for n in ("bucket", "node", "root", "other")]
            kept = np.empty(len(real), object)
            lens = batch.column("kept").value_lengths().fill_null(0).to_numpy()
            members = batch.column("kept").flatten().to_numpy().view(np.uint64)
            kept[:] = np.split(members, np.cumsum(lens)[:-1]) if len(lens) > 1 else [members]
            return [*filled, real, fps, sketches, kept]

        for buckets, nodes, roots, others, real, fps, sketches, kept in _whole_buckets(batches, columns, AT_ONCE):
            wrong = set(zip(buckets[~real].tolist(), nodes[~real].tolist(), others[~real].tolist()))
            buckets, nodes, roots, fps, sketches, kept = (x[real] for x in (buckets, nodes, roots, fps, sketches, kept))
            i, j = best_links(buckets, nodes, roots, fps, sketches, radius, similarity, wrong,
                              kept if any(map(len, kept)) else None, forests)
            yield pa.RecordBatch.from_arrays(
                [pa.array(buckets[i]), pa.array(np.minimum(nodes[i], nodes[j])), pa.array(np.maximum(nodes[i], nodes[j]))],
                ["bucket", "a", "b"])

    return given.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(
        choose, "bucket bigint, a bigint, b bigint")


def _clusters(rows: DataFrame, links: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``node``, ``cluster``, ``component_id`` of each node; ``links`` finds ``a``, ``b`` for ``node``, ``fp``."""
    groups = settle(rows.groupBy("node").agg(F.min("doc_id").alias("least"), F.any_value("fp").alias("fp")),
                    "distinct-fingerprints")
    roots = components(links(groups.select("node", "fp")))
    named = groups.select("node", "least").join(roots, "node", "left")
    # a linked cluster's smallest id; fingerprints without a link keep their own
    whole = F.coalesce("root", "node").alias("cluster")
    loose = named.where("root is null").join(
        roots.select(F.col("root").alias("node")).distinct(), "node", "left_anti")
    bound = named.join(loose.select("node"), "node", "left_anti").select("node", "least", whole)
    least = bound.groupBy("cluster").agg(F.min("least").alias("component_id"))
    return settle(loose.select("node", F.col("node").alias("cluster"), F.col("least").alias("component_id"))
                  .unionByName(bound.join(least, "cluster").select("node", "cluster", "component_id")), "clusters")


def near_duplicates(docs: DataFrame, width: int = 4, radius: int = 4, seed: int = SEED,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits), ``component_id``, ``cluster``, ``text_hash``.

    Documents whose 64-bit fingerprints differ in at most ``radius`` bits are linked, without
    exception; ``component_id`` is the smallest ``doc_id`` reachable over links, itself included, and
    ``cluster`` a fingerprint that names the component. Texts without words (null, empty) have
    fingerprint 0 and are linked like any other. Rows without an id take part; a component without
    any id has a null ``component_id``. An empty table gives no rows.
    """
    rows = settle(fingerprints(docs, width, 1, seed, True, id_col, text_col), "fingerprints")
    named = _clusters(rows.withColumn("fp", F.col("node")),
                      lambda groups: linked(groups.withColumn("fp", F.array("node")), block_masks(radius), radius))
    return rows.join(named, "node").select(
        "doc_id", F.lower(F.lpad(F.hex("node"), 16, "0")).alias("fingerprint"), "component_id", "cluster",
        "text_hash")


def shingle_sets(docs: DataFrame, rows: DataFrame, nodes: DataFrame, width: int, seed: int = SEED,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``node``, ``shingles``: the set of shingle hashes of each of the ``nodes``, from one text of each.
    ``rows`` are the fingerprints of ``docs``."""
    first = F.min(F.struct("doc_id", "text_hash")).alias("first")
    chosen = rows.join(nodes, "node", "left_semi").groupBy("node").agg(first).select(
        "node", F.col("first.doc_id").alias("first_id"), F.col("first.text_hash").alias("first_hash"))
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                      F.xxhash64(text_col).alias("text_hash"))
    match = own["doc_id"].eqNullSafe(chosen["first_id"]) & (own["text_hash"] == chosen["first_hash"])

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            hashes = [np.unique(np.array(shingle_hashes(t, width, seed), np.uint64))
                      for t in piece.column("text").to_pylist()]
            edges = pa.array(np.concatenate([[0], np.cumsum([len(h) for h in hashes])]), pa.int32())
            yield pa.RecordBatch.from_arrays([piece.column("node"), pa.ListArray.from_arrays(
                edges, pa.array(np.concatenate(hashes).view(np.int64)))], ["node", "shingles"])

    found = own.join(chosen, match).select("node", "text").mapInArrow(sets, "node bigint, shingles array<bigint>")
    return found.groupBy("node").agg(F.any_value("shingles").alias("shingles"))  # rows may be repeated


def compared(links: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The links with ``same``: whether their sets have this Jaccard similarity or more."""
    both = links.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("one")), "a").join(
        sets.select(F.col("node").alias("b"), F.col("shingles").alias("other")), "b")
    shared = F.size(F.array_intersect("one", "other"))
    whole = F.size("one") + F.size("other") - shared
    return both.select("a", "b", (shared >= similarity * whole - 1e-9).alias("same"))


def verified(groups: DataFrame, masks: list[tuple[int, ...]], radius: int, tight: int,
             sets_of: Callable[[DataFrame], DataFrame], sketches_of: Callable[[DataFrame], DataFrame],
             similarity: float) -> DataFrame:
    """``a``, ``b``: links within the radius whose shingle sets have the similarity, enough of them to connect all
    that are connected so.

    Links of at most ``tight`` bits are hardly ever wrong; those that span the groups of a bucket are compared
    by their sets first. Other nodes only leave a mark in their buckets. Then, in rounds, each bucket
    whose marked nodes have not all come together passes on the likeliest links that would bring them together,
    by the nodes' sketches; their sets are compared, and the buckets of refused links go on, with the sets
    of their nodes at hand, so that hardly any further link is refused. A round has fewer links than marks
    (four times as many each round from the third on). Where a tight link is wrong, its whole group
    leaves marks instead.
    """
    spark, words = groups.sparkSession, len(masks[0])

    def compare(links: DataFrame) -> DataFrame:
        with _freed_shuffles(spark):
            sets = settle(sets_of(links.select(F.explode(F.array("a", "b")).alias("node")).distinct()), "shingles")
            checked = settle(compared(links, sets, similarity), "compared")
        release(sets)
        return checked

    found = settle(searched(groups, masks, radius, tight).distinct(), "found")
    checked = compare(found.where("bucket is null").select("a", "b"))
    links = checked.where("same").select("a", "b")
    marks = found.where("bucket is not null").select("bucket", F.col("a").alias("node"))
    if not checked.where("not same").isEmpty():
        roots = components(checked)
        hit = checked.where("not same").select(F.col("a").alias("node")).join(roots, "node", "left").select(
            F.coalesce("root", "node").alias("root")).distinct()
        nodes = roots.join(hit, "root").select("node").union(hit)
        again = searched(settle(groups.join(nodes, "node", "left_semi"), "again"), masks, radius, tight=-1)
        marks = marks.union(again.select("bucket", F.col("a").alias("node")))
    marks = settle(marks.distinct(), "marks")
    release(found)
    marked = marks.select("node").distinct()
    nodes = settle(groups.join(marked, "node").join(sketches_of(marked), "node"), "marked-nodes")
    refused, forests = None, 1
    while True:
        named = marks.join(components(links), "node", "left").select(
            "bucket", "node", F.coalesce("root", "node").alias("root"))
        open_ = named.groupBy("bucket").agg(F.min("root").alias("a"), F.max("root").alias("b")).where("a < b")
        with _freed_shuffles(spark):
            named = settle(named.join(open_.select("bucket"), "bucket"), "open")
            given, sets = named.join(nodes, "node"), None
            if refused is None:
                given = given.withColumn("kept", F.lit(None).cast("array<bigint>"))
            else:
                sets = settle(sets_of(named.select("node").distinct()).select(
                    "node", F.slice("shingles", 1, KEPT).alias("kept")), "shingles")
                given = given.join(sets, "node")
            passed = settle(candidates(given, words, radius, similarity, refused, forests), "candidates")
            release(*([sets] if sets is not None else []))
        release(named)
        new = passed.select("a", "b").distinct()
        if new.isEmpty():
            break
        if refused is not None:  # it may have been refused in another bucket
            new = new.join(refused.select("a", "b").distinct(), ["a", "b"], "left_anti")
        checked = compare(new)
        right = checked.where("same").select("a", "b")
        links = links.unionByName(right)
        wrong = settle(passed.join(right, ["a", "b"], "left_anti").select("bucket", "a", "b"), "refused")
        release(passed)
        if wrong.isEmpty():
            break
        forests *= 1 if refused is None else 4
        refused = wrong if refused is None else settle(refused.unionByName(wrong), "all-refused")
        marks = settle(marks.join(wrong.select("bucket").distinct(), "bucket", "left_semi"), "marks")
    release(nodes)
    return links


def similar(docs: DataFrame, similarity: float = 0.8, width: int = 5, words: int = 4, miss: float = 0.005,
            seed: int = SEED, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``component_id``, ``cluster``, ``text_hash``: documents are linked if their sets of
    shingles have this Jaccard similarity or more.

    Fingerprints find the candidates, the sets of shingles decide, so no link is below the similarity.
    Sketches of the sets (``MARGIN`` below the similarity, 3 in 10 000 pairs of the similarity) refuse most others.
    Two sets of similarity s differ in about arccos(2 s / (1 + s)) / pi of the bits. Candidates are
    documents within that share plus three standard deviations, 999 in 1000 pairs of similarity 0.8
    and practically all of 0.85. At this distance
    blocks would be too narrow to tell anything, so candidates agree under one of many random masks.
    Beyond a million fingerprints the masks have more bits the more there are, so that a bucket has one or two
    hundred of them, and there are the more masks for it: of the pairs of this similarity within the
    distance they miss ``miss`` whatever the size of the table, of more similar ones fewer.
    """
    share = math.acos(2 * similarity / (1 + similarity)) / math.pi
    spread = 3 * math.sqrt(64 * words * share * (1 - share))
    radius, tight = round(64 * words * share + spread), max(0, round(64 * words * share - spread))
    rows = settle(fingerprints(docs, width, words, seed, False, id_col, text_col), "fingerprints")
    n = rows.select(F.approx_count_distinct("node")).first()[0]
    masks = search_masks(n, words, share, radius, miss)
    named = _clusters(rows, lambda groups: verified(
        groups, masks, radius, tight, lambda nodes: shingle_sets(docs, rows, nodes, width, seed, id_col, text_col),
        lambda nodes: rows.join(nodes, "node", "left_semi").groupBy("node").agg(F.any_value("sketch").alias("sketch")),
        similarity))
    return rows.join(named, "node").select("doc_id", "component_id", "cluster", "text_hash")


def one_of_each(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The rows of ``docs`` without those that repeat another one of their cluster: of each cluster
    the row of the smallest ``doc_id`` stays (of the same id, that of the smallest text hash)."""
    mark = "_"
    while any(name.startswith(mark) for name in docs.columns):
        mark += "_"
    hash_, kept_id, kept_hash = (f"{mark}{name}" for name in ("hash", "kept_id", "kept_hash"))
    first = F.min(F.struct("doc_id", "text_hash")).alias("first")
    kept = found.groupBy("cluster").agg(first).select("first.*").distinct().select(
        F.col("doc_id").alias(kept_id), F.col("text_hash").alias(kept_hash))
    own = docs.withColumn(hash_, F.xxhash64("text"))
    match = own["doc_id"].eqNullSafe(kept[kept_id]) & (own[hash_] == kept[kept_hash])
    return own.join(kept, match, "left_semi").dropDuplicates(["doc_id", hash_]).select(*docs.columns)
