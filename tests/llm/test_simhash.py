"""Fingerprints and components against plain loops over all pairs."""

from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from wayfare.llm import simhash
from wayfare.llm.components import components


def plain_fingerprint(text, width=4):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    shingles = [b" ".join(words[i:i + width]) for i in range(max(1, len(words) - width + 1))] if words else []
    hashes = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(keys, fps, radius=4):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    least = {}
    for i, k in enumerate(keys):
        if k is not None:
            r = find(i)
            least[r] = min(k, least.get(r, k))
    return [least.get(find(i)) for i in range(len(fps))]


def some_texts(seed, n=150):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdeÄé") for _ in range(rng.randint(1, 5))) for _ in range(300)]
    texts = [None, "", " \t\n", "one", "One", "one two", "a b c d", "a b c d e", "Ä b\x0bc\x0cd\x1ce", "0 0"]
    while len(texts) < n:
        words = [rng.choice(vocabulary) for _ in range(rng.choice([3, 30, 200, 600]))]
        texts.append(" ".join(words))
        for _ in range(rng.choice([0, 0, 1, 4])):
            changed = list(words)
            for _ in range(rng.choice([0, 1, 2, 8])):
                changed[rng.randrange(len(words))] = rng.choice(vocabulary)
            texts.append("  ".join(changed))
    return texts[:n]


@pytest.mark.parametrize("seed", [1, 2])
def test_documents(spark, seed):
    texts = some_texts(seed)
    keys = random.Random(seed).sample(range(10_000), len(texts))
    rows = [(k, t, "x", "y") for k, t in zip(keys, texts)] + [(None, texts[40], "x", "y"), (None, "no id here", "", "")]
    rows += [rows[30], rows[31], (keys[50], "same id, other text", "x", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fingerprint string, cluster string")
    fps = [plain_fingerprint(t) for _, t, _, _ in rows]
    want = sorted(zip(map(str, (r[0] for r in rows)), (f"{f:016x}" for f in fps),
                      map(str, plain_components([r[0] for r in rows], fps))))
    got = sorted((str(r.doc_id), r.fingerprint, str(r.component_id))
                 for r in simhash.near_duplicates(docs.repartition(5)).collect())
    assert got == want


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(none).collect() == []
    assert simhash.one_of_each(none, simhash.similar(none)).collect() == []


@pytest.mark.parametrize("words", [1, 2])
@pytest.mark.parametrize("n", [1, 2, 63, 64, 65, 130, 700])
def test_bit_slices(n, words):
    rng = np.random.default_rng(n)
    fps = rng.integers(0, 1 << 63, (n, words), dtype=np.uint64)
    for i in range(1, n, 2):  # neighbours at small distances
        fps[i] = fps[rng.integers(0, i)]
        fps[i, 0] ^= np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 64, rng.integers(1, 9), dtype=np.uint64))
    planes = simhash.to_planes(fps)
    for by in (1, 2, 63, 64, 65, 128):
        if by >= n:
            continue
        distance = np.bitwise_count(fps[by:] ^ fps[:-by]).sum(1)
        open_ = np.zeros(planes.shape[1] * 64, np.uint8)
        open_[:n - by] = rng.integers(0, 5, n - by) > 0
        packed = np.packbits(open_, bitorder="little").view("<u8")
        for radius in (0, 1, 3, 4, 5, 20):
            got = simhash.near_neighbours(planes, by, packed, radius)
            assert got.tolist() == np.flatnonzero((distance <= radius) & (open_[:n - by] > 0)).tolist()


def test_masks_miss_no_pair():
    rng = random.Random(1)
    for radius in (1, 4, 6):
        masks = simhash.block_masks(radius)
        for _ in range(300):
            bits = sum(1 << b for b in rng.sample(range(64), radius))
            assert any(not bits & m for m, in masks)


def test_large_bucket_is_cut(spark):
    base = 0x0123456789ABCDEF
    fps = sorted({base ^ (1 << i) ^ (1 << j) for i in range(64) for j in range(i)} | {base ^ (63 << k) for k in range(9)})
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    groups = spark.createDataFrame([(f, [f]) for f in signed], "node long, fp array<long>")
    for chunk in (50, 300, 10_000):
        roots = components(simhash.linked(groups, simhash.block_masks(4), 4, chunk)).collect()
        assert len({r.root for r in roots}) == 1 and len(roots) == len(fps) - 1


@pytest.mark.parametrize("in_one_task", [1 << 18, 300, 0])
def test_components(spark, in_one_task):
    rng = random.Random(7)
    links = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 900)]
    links += [(rng.randrange(2000, 2400), rng.randrange(2000, 2400)) for _ in range(220)] + [(7, 7)]
    parent = {x: x for link in links for x in link}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    want = {x: find(x) for x in parent if find(x) != x}
    links += [(b, a) for a, b in links[::3]] + [(None, 7), (8, None)]
    got = components(spark.createDataFrame(links, "a long, b long"), in_one_task).collect()
    assert len(got) == len(want)
    assert {r.node: r.root for r in got} == want


def test_components_without_links(spark):
    assert components(spark.createDataFrame([(5, 5)], "a long, b long"), 0).count() == 0


def test_similar_documents(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    rows, copies = [], []
    for i in range(120):
        words = [word() for _ in range(200)]
        rows.append((10 * i, " ".join(words), "x"))
        if i % 2:
            words[100] = words[20] = word()  # similarity about 0.9
            rows.append((10 * i + 1, " ".join(words), "x"))
            copies.append(10 * i + 1)
    rows += [rows[5], rows[5], (1210, None, "x"), (1211, "", "x"), (None, "alone without id " * 3, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _hash string")
    kept = simhash.one_of_each(docs, simhash.similar(docs))
    assert kept.columns == docs.columns
    found = sorted(str(r.doc_id) for r in kept.collect())
    assert len([c for c in copies if str(c) in found]) <= 1
    clean = [str(r[0]) for r in rows if r[0] not in copies]
    assert set(clean) - set(found) == {"1211"} and len(set(found)) == len(found)


def some_bits(seed, n, words=4):
    return np.random.default_rng(seed).integers(0, 1 << 63, (n, words), np.uint64) * np.uint64(2)


def pair_of(rng, size, shared):
    """Two sets of hashes of this size with so many in common."""
    hashes = rng.integers(0, 1 << 63, 2 * size - shared, np.uint64) * np.uint64(2) + np.uint64(1)
    hashes ^= rng.integers(0, 2, len(hashes), np.uint64)
    return hashes[:size], hashes[size - shared:]


@pytest.mark.parametrize("n", [10**3, 10**5, 10**7, 10**8])
def test_recall_is_the_same_for_any_number_of_texts(n):
    rng = np.random.default_rng(n)
    share, radius = np.arccos(1.6 / 1.8) / np.pi, 47
    masks = np.array(simhash.search_masks(n, 4, share, radius, 0.005), np.uint64)
    assert 2 ** np.bitwise_count(masks).sum(1).max() * 16 <= max(n, 16 * 2 ** 12)
    pairs = [pair_of(rng, 180, 160) for _ in range(2000)]  # similarity 0.8
    hashes = np.concatenate([h for pair in pairs for h in pair])
    starts = np.arange(0, len(hashes) + 1, 180)
    fps = np.stack([simhash.majority(simhash.mixed(hashes, w), starts, True) for w in range(4)], axis=1)
    differ = fps[::2] ^ fps[1::2]
    differ = differ[np.bitwise_count(differ).sum(1) <= radius]
    assert len(differ) > 1700
    found = ((differ[:, None, :] & masks[None]) == 0).all(2).any(1)
    assert found.mean() > 0.98


def test_rows_of_a_text_do_not_grow_up_to_a_million_texts():
    share, radius = np.arccos(1.6 / 1.8) / np.pi, 56
    small, *more = (simhash.search_masks(n, 4, share, radius, 0.005) for n in (35_825, 179_316, 10**6))
    assert all(masks == small for masks in more)
    for n in (10**7, 10**8):
        masks = simhash.search_masks(n, 4, share, radius, 0.005)
        assert len(masks) <= len(small) * (n / 10**6) ** 0.4
        assert n <= 2 ** simhash.mask_bits(n) * 256 <= simhash.CHUNK / 4 * 2 ** simhash.mask_bits(n)


def test_ties_set_as_many_bits_as_not():
    hashes = some_bits(5, 4000, 1).ravel()
    found = simhash.majority(hashes, np.arange(0, 4001, 2), True)
    bits = np.bitwise_count(found >> np.uint64(1)).mean() / 63  # the lowest is 0 in all hashes
    assert abs(bits - 0.5) < 0.02
    assert abs(np.bitwise_count(simhash.majority(hashes, np.arange(0, 4001, 2))).mean() / 63 - 0.25) < 0.02


def test_rounds_of_masks(spark, monkeypatch):
    fps = some_bits(9, 40).view(np.int64)
    rows = [(2 * i, f.tolist()) for i, f in enumerate(fps)] + [(2 * i + 1, [int(f[0]) ^ 5, *f[1:].tolist()])
                                                               for i, f in enumerate(fps)]
    groups = spark.createDataFrame(rows, "node long, fp array<long>")
    monkeypatch.setattr(simhash, "ROUND", 7)
    links = simhash.linked(groups, simhash.sampled_masks(4, 12, 20), 47).collect()
    assert {(min(r.a, r.b), max(r.a, r.b)) for r in links} == {(2 * i, 2 * i + 1) for i in range(40)}


def family(seed, shares, n=200):
    """A text of ``n`` words and copies, each with the last words replaced to have about this similarity."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    base = [word() for _ in range(n)]
    made = [base]
    for s in shares:
        keep = round(2 * s / (1 + s) * (n - 4)) + 4
        made.append(base[:keep] + [word() for _ in range(n - keep)])
    return [" ".join(m) for m in made]


def plain_groups(texts, similarity=0.8, width=5):
    sets = [{tuple(w[k:k + width]) for k in range(max(1, len(w) - width + 1))} for w in map(str.split, texts)]
    root = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if root[i] != root[j] and len(sets[i] & sets[j]) >= similarity * len(sets[i] | sets[j]):
                old, new = max(root[i], root[j]), min(root[i], root[j])
                root = [new if r == old else r for r in root]
    return root


@pytest.mark.parametrize("tight", [None, 47])
def test_links_are_of_the_similarity(spark, monkeypatch, tight):
    texts = [t for i in range(12) for t in family(i, [0.76, 0.7, 0.74, 0.65, 0.78, 0.9, 0.95])]
    texts += [t for i in range(50, 53) for t in family(i, [0.86, 0.88, 0.9, 0.92] * 5)]
    texts += ["a b c d e", "a b c d e f", "a b c d e f g", "a b"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    if tight:  # many links are taken for sure that are not: what they stood for is compared again
        plain = simhash.verified
        monkeypatch.setattr(simhash, "verified", lambda g, m, r, t, *more: plain(g, m, r, tight, *more))
    found = {r.doc_id: r.component_id for r in simhash.similar(docs).collect()}
    assert [found[i] for i in range(len(texts))] == plain_groups(texts)


def test_equal_fingerprints_of_unlike_texts_stay_apart(spark, monkeypatch):
    own = simhash.fingerprints
    zero = F.array(*[F.lit(0).cast("long")] * 4)
    monkeypatch.setattr(simhash, "fingerprints", lambda *given: own(*given).withColumn("fp", zero))
    texts = ["a b c d e f", "A  b c d e f", "q r s t u v w x", None, ""]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in simhash.similar(rows).collect()}
    assert found == {0: 0, 1: 0, 2: 2, 3: 3, 4: 3}


def test_many_near_copies_need_few_links():
    rng = np.random.default_rng(2)
    fps = np.repeat(some_bits(2, 1), 600, axis=0)
    for i in range(1, 600):
        fps[i, rng.integers(0, 4)] ^= np.uint64(1) << rng.integers(0, 64, dtype=np.uint64)
    buckets = np.zeros(600, np.int64)
    i, j, open_ = simhash.links_in_buckets(buckets, fps, 56, 22)
    assert len(i) == 599 and not len(open_)
    i, j, open_ = simhash.links_in_buckets(buckets, fps, 56, -1)
    assert not len(i) and len(open_) == 600
    nodes, sketches = np.arange(600), np.ones((600, simhash.BINS), np.uint8)
    for roots, n in ((nodes, 599), (nodes // 2, 299), (buckets, 0)):
        assert simhash.best_links(buckets, nodes, roots, fps, sketches, 56, 0.7).shape == (2, n)
    first = simhash.best_links(buckets, nodes, nodes, fps, sketches, 56, 0.7)
    wrong = {(0, *sorted(p)) for p in first.T.tolist()}
    again = simhash.best_links(buckets, nodes, nodes, fps, sketches, 56, 0.7, wrong, None, 4)
    assert 599 < again.shape[1] <= 4 * 599 and not wrong & {(0, *sorted(p)) for p in again.T.tolist()}


@pytest.mark.parametrize("size", [50, 6000])
def test_sets_at_hand_decide(size):
    rng = np.random.default_rng(size)
    for shared, want in ((0.9, True), (0.87, False)):  # similarities 0.82 and 0.77
        one, other = (np.unique(h)[:simhash.KEPT] for h in pair_of(rng, size, round(shared * size)))
        assert simhash.alike(one, other, 0.8) == want
    one, other = pair_of(rng, 90, 80)
    assert simhash.alike(np.unique(one), np.unique(other), 0.8) and not simhash.alike(np.unique(one), np.unique(other), 0.801)


@pytest.mark.parametrize("size", [20, 150, 800, 5000])
def test_sketches_tell_the_similarity(size):
    rng = np.random.default_rng(size)
    for shared in (0.98, 8 / 9, 0.75, 0.5, 0.0):
        pairs = [pair_of(rng, size, round(shared * size)) for _ in range(200)]
        true = round(shared * size) / (2 * size - round(shared * size))
        a, b = (np.stack([np.frombuffer(simhash.sketch(np.unique(p[k])), np.uint8) for p in pairs]) for k in (0, 1))
        found = simhash.sketch_likeness(a, b)
        assert abs(found.mean() - true) < 0.01 and (true < 0.8 or (true - found).max() < simhash.MARGIN)


def test_rows_grow_with_the_group_not_its_square(spark):
    made = {}
    for n in (100, 400):
        texts = family(1, [], 300)
        rng, base = random.Random(4), texts[0].split()
        while len(texts) < n:
            own = list(base)
            for at in rng.sample(range(300), 5):  # about 0.72 to each other, 0.84 to the first
                own[at] = f"w{rng.randrange(10**6)}"
            texts.append(" ".join(own))
        rows = simhash.fingerprints(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), 5, 4, 42, False)
        masks = simhash.sampled_masks(4, 12, 20)
        found = simhash.searched(rows.select("node", "fp"), masks, 56, 22).cache()
        marks = found.where("bucket is not null").select("bucket", F.col("a").alias("node"))
        given = marks.join(rows.select("node", "fp", "sketch", F.col("node").alias("root"),
                                       F.lit(None).cast("array<bigint>").alias("kept")), "node")
        passed = simhash.candidates(given, 4, 56, 0.8)
        made[n] = found.count(), passed.count()
        assert made[n][0] <= 20 * n and made[n][1] < marks.count()
        found = [r.component_id for r in simhash.similar(rows.sparkSession.createDataFrame(
            list(enumerate(texts)), "doc_id long, text string")).collect()]
        assert found.count(0) >= 0.98 * n  # masks miss about one pair in a hundred at this similarity
    assert made[400][0] < 6 * made[100][0] and made[400][1] < 8 * made[100][1]
