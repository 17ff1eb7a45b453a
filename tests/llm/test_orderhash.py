"""Order MinHash against plain loops."""

from __future__ import annotations

import hashlib
import struct
from collections import Counter
from random import Random

import pytest
from xxhash import xxh64_intdigest

from wayfare.llm import orderhash

SCHEMA = "doc_id bigint, text string, part string, last string, line string, own string, _ string"
NAMES = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
PLACES = (1 << 30) - 1


def signed(h):
    return h - (1 << 64) if h >> 63 else h


def sketches(text, k=8, size=2, count=64):
    raw = text.encode("utf-32-be")
    seen, elements = Counter(), []
    for at in range(0, max(len(raw) - 4 * k, 0) + 1, 4) if text else ():
        h = signed(xxh64_intdigest(raw[at:at + 4 * k], 42))
        key = h >> 30
        if seen[key]:
            h = signed(xxh64_intdigest(struct.pack("<i", seen[key]), xxh64_intdigest(struct.pack("<q", key), 42)))
        seen[key] += 1
        elements.append((h & ~PLACES) | at + 1)
    found = [0] * count
    shift = 64 - (count.bit_length() - 1)
    for bucket in range(count):
        own = sorted(x for x in elements if (x >> shift) + count // 2 == bucket)[:size]
        if own:
            h = 42
            for x in sorted(own, key=lambda x: x & PLACES):
                h = xxh64_intdigest(struct.pack("<q", (x & (1 << 64) - 1) >> 30), h)
            found[bucket] = signed(h) % 65535 + 1
    return found


def likeness(a, b):
    used = sum(bool(x or y) for x, y in zip(a, b))
    return sum(x == y != 0 for x, y in zip(a, b)) / used if used else 1.0


def line(text):
    return xxh64_intdigest(text.encode(), 42)


def plain(rows):
    rows = sorted(((r[0], r[1] or "") for r in rows),
                  key=lambda r: (r[0] is not None, r[0] or 0, line(r[1]) >> 11, signed(line(r[1]))))
    found = []
    for (doc_id, text), (_, after) in zip(rows, rows[1:] + rows[:1]):
        n = len(text)
        edited = text[:n - n // 4] + after[:n // 4]
        own, changed, follows = sketches(text), sketches(edited), sketches(after)
        hexed = ["".join(f"{x:04x}" for x in s) for s in (own, changed)]
        found.append((doc_id, n, hashlib.sha256(edited.encode()).hexdigest(), *hexed,
                      likeness(own, changed), likeness(own, follows)))
    return sorted(found, key=repr)


def result(df):
    assert df.columns == NAMES
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def rows():
    rng = Random(2)
    letters = "abcdefgh éü日🙂\n"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 400))) for _ in range(60)]
    texts += ["", None, "a", "abc", "abcdefg", "abcdefgh", "🙂" * 50, "ab" * 3000, "a" * 20_000, "line of text\n" * 30]
    texts += [texts[0]] * 20
    rows = [(i * 7 - 100, t) for i, t in enumerate(texts)]
    rows += [(None, t) for t in texts[:30]] + [(5, t) for t in texts[:40]] + [(5, texts[1])] * 3
    rng.shuffle(rows)
    return [(i, t, "p", "l", "n", "o", "u") for i, t in rows]


@pytest.mark.parametrize("ranges", [1, 2, 16])
def test_same_as_plain_loops(spark, rows, ranges):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert result(orderhash.edit_likeness(docs, ranges)) == plain(rows)


def test_small_tables(spark):
    for rows in ([], [(1, "hello there, you")], [(1, None)], [(None, "x")], [(None, "aaaa"), (3, "bbbbbbbb")]):
        docs = spark.createDataFrame(rows, "doc_id bigint, text string")
        assert result(orderhash.edit_likeness(docs, 4)) == plain(rows)


def test_other_names_and_sizes(spark, rows):
    docs = spark.createDataFrame([(r[0], r[1]) for r in rows[:40]], "key bigint, body string")
    got = orderhash.fingerprints(docs, 5, 3, 16, id_col="key", text_col="body").collect()
    want = sorted([(r[0], sketches(r[1] or "", 5, 3, 16)) for r in rows[:40]], key=repr)
    assert sorted([tuple(r) for r in got], key=repr) == want
    with pytest.raises(ValueError):
        orderhash.fingerprints(docs, sketches=48, id_col="key", text_col="body")


def test_likeness_follows_edits(spark):
    rng = Random(4)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(4000)]
    base = " ".join(rng.choice(words) for _ in range(800))
    parts = base.split(" ")
    few, many = parts[:], parts[:]
    for own, n in ((few, 8), (many, 200)):
        for _ in range(n):
            own[rng.randrange(len(own))] = rng.choice(words)
    turned = parts[400:] + parts[:400]
    other = " ".join(rng.choice(words) for _ in range(800))
    texts = [base, " ".join(few), " ".join(many), " ".join(turned), other]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = dict(orderhash.fingerprints(docs).collect())
    near = [likeness(found[0], found[i]) for i in range(5)]
    assert near[0] == 1 and near[1] > 0.7 > near[2] > 0.1 and near[4] < 0.05
    assert near[3] < 0.7  # the same words in another order: tuples across the cut are turned round


def test_a_table_of_one_id_is_spread(spark):
    docs = spark.createDataFrame([(1, f"text number {i}") for i in range(400)], "doc_id bigint, text string")
    rows = orderhash.in_ranges(docs, 8).where("not last").groupBy("part").count().collect()
    assert len(rows) >= 7 and max(r["count"] for r in rows) < 100


def test_no_python_in_the_plan(spark):
    docs = spark.createDataFrame([(1, "a text")], "doc_id bigint, text string")
    plan = orderhash.edit_likeness(docs, 4)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "MapIn" not in plan
