"""Spelling variants against a plain comparison of all words."""

from __future__ import annotations

import re
from collections import Counter
from random import Random
from zlib import crc32

import numpy as np
import pytest

from wayfare.llm import variants

SCHEMA = "doc_id bigint, text string, word string, n string, near string"


def plain(rows, least_length=7, least_count=2, ratio=10):
    counts = Counter()
    for doc_id, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            if len(run) >= least_length:
                counts[run] += 1
    words = {w: n for w, n in counts.items() if n >= least_count}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) - len(a) == 1 and any(a == b[:i] + b[i + 1:] for i in range(len(b)))

    found, forms = {}, {}
    for w, n in words.items():
        others = [o for o in words if near(w, o)]
        best = min(others, key=lambda o: (-words[o], o), default=None)
        forms[w] = best if best and words[best] >= ratio * n else None
        found[w] = len(others)
    rows = set()
    for w, n in words.items():
        root = w
        while forms[root]:
            root = forms[root]
        rows.add((w, forms[w], root, n, found[w], words[forms[w]] if forms[w] else None))
    return rows


def result(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def edited(rng, word):
    at, letter = rng.randrange(len(word)), rng.choice("abcéü")
    return rng.choice([word[:at] + word[at + 1:], word[:at] + letter + word[at:], word[:at] + letter + word[at + 1:]])


@pytest.fixture(scope="module")
def rows():
    rng = Random(3)
    stems = ["".join(rng.choice("abcdeéü") for _ in range(rng.randint(7, 11))) for _ in range(25)]
    rows = []
    for i in range(120):
        words = []
        for _ in range(60):
            word = rng.choice(stems[:1 + i % len(stems)])
            for _ in range(rng.choice([0, 0, 0, 0, 0, 0, 1, 1, 2])):
                word = edited(rng, word)
            words.append(word.upper() if rng.random() < 0.1 else word)
        rows.append((i, rng.choice([" ", ", ", "9", "\n"]).join(words), "x", "y", "z"))
    long_ = "".join(rng.choice("abc") for _ in range(20_000))
    rows += [(500, f"{long_} {long_}", None, None, None), (501, f"{long_[:-1]} {long_[:-1]} {long_[1:]}", None, None, None),
             (502, None, None, None, None), (503, "", None, None, None), (None, "Strasse strasses strasse STRASSES", None, None, None),
             (7, rows[7][1], None, None, None), (504, "aaaaaaaa aaaaaaa aaaaaaaa aaaaaaa ÀÿÀÿÀÿ× ÀÿÀÿÀÿ×", None, None, None)]
    return rows


def test_same_as_plain_comparison(spark, rows):
    want = plain(rows)
    assert any(form for _, form, *_ in want) and any(root not in (w, form) for w, form, root, *_ in want)
    assert any(len(w) > 10_000 and near for w, _, _, _, near, _ in want)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert result(variants.spelling_variants(docs)) == want


def test_any_number_of_filter_ranges_and_thresholds(spark, rows):
    few = rows[:40]
    docs = spark.createDataFrame(few, SCHEMA)
    assert result(variants.spelling_variants(docs, 5, 1, 3, blocks=2)) == plain(few, 5, 1, 3)


def test_hot_words_and_ties(spark):
    rows = [(i, "abcdefgh " * 50 + "abcdefgi " * 50 + ("abcdefg " if i % 2 else "abcdefgx"), "", "", "") for i in range(40)]
    got = result(variants.spelling_variants(spark.createDataFrame(rows, SCHEMA)))
    assert got == plain(rows)


def test_empty_table_and_other_names(spark):
    assert result(variants.spelling_variants(spark.createDataFrame([], SCHEMA))) == set()
    docs = spark.createDataFrame([("a", "Strasse"), ("b", "Strasse"), (None, "x")], "key string, body string")
    assert result(variants.spelling_variants(docs, id_col="key", text_col="body")) == {("strasse", None, "strasse", 2, 0, None)}


def test_chain_of_forms_leads_to_its_end(spark):
    chain = [(f"w{i}", f"w{i + 1}") for i in range(20)] + [("x", "w3")]
    found = dict(variants.roots(spark.createDataFrame(chain, "word string, form string")).collect())
    assert found == {**{f"w{i}": "w20" for i in range(20)}, "x": "w20"}


def test_filter_keeps_all_words_and_few_others():
    rng = np.random.default_rng(1)
    words = sorted({"".join(map(chr, rng.integers(97, 123, 9))) for _ in range(20_000)})
    known, other = words[::2], words[1::2]
    shards = variants.Shards({9: len(known)})

    def hashes(own):
        return variants.finished(
            variants.letter_values(np.arange(9), variants.letters_of(own, 9)).sum(1, dtype=np.uint64), 9)

    lanes = np.zeros((shards.total, variants.LANES), np.uint64)
    h = hashes(known)
    for lane in range(variants.LANES):
        np.bitwise_or.at(lanes[:, lane], shards.blocks(h, 9), variants.lane_bits(h, lane))
    part = variants.Filter(0, lanes)
    assert len(part.holds(h, shards.blocks(h, 9))) == len(known)
    h = hashes(other)
    assert len(part.holds(h, shards.blocks(h, 9))) < 0.01 * len(other)
