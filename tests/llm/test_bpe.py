"""Encoding and decoding against the tokenizers library."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from wayfare.llm import bpe, texts

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
ENCODER = bpe.Encoder(bpe.Vocabulary(bpe.read_vocabulary(PATH)))
DECODER = bpe.Decoder(bpe.Vocabulary(bpe.read_vocabulary(PATH)))


def ours(strings):
    docs = texts.of_strings(strings)
    ids, starts = ENCODER(docs)
    raw, ends = DECODER(ids, starts)
    return ([ids[a:b].tolist() for a, b in zip(starts, starts[1:])],
            [raw[a:b].tobytes().decode() for a, b in zip(ends, ends[1:])])


def theirs(strings):
    return [e.ids for e in LIBRARY.encode_batch([s or "" for s in strings], add_special_tokens=False)]


TRICKY = [
    "", None, " ", "  ", "\n", " \n ", "a", " a", "  a", "\ta", " \ta", "a ", "a  ", "a \n", "a\n b", "a \n\n  b",
    "it's", "it 's", "it  's", "'s", "''s", "'S", "'sing", "'re", "'r", "'rest", "we'll've 'tis", "x'd'd 'm'",
    "a1b2", "1 234  5", "½ ² Ⅷ 一 ٣", "don't do   it", "!!! ... ?'s !'s", "\x1c\x1d a\x85b",
    "<|endoftext|>", "a <|endoftext|> b<|endoftext|><|endoftext|>'s", "<|endoftext|", " <|endoftext|>  x",
    "héllo wörld ñandú façade ß", "日本語 のテキスト", "🙂🙂 x🙂", "éä", "a" * 500, "ab" * 700 + " c",
    "é" * 300, "=" * 1000 + " -" * 40, "x" + "\n" * 300 + "y", "_a_ a_b __", "​‍ a﻿",
]


def test_tricky_texts():
    ids, decoded = ours(TRICKY)
    assert ids == theirs(TRICKY)
    assert decoded == [s or "" for s in TRICKY]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from("aeths '\n\t.!1é日🙂 l<|>v") | st.characters(codec="utf-8"), max_size=60),
                min_size=1, max_size=6))
def test_any_text(strings):
    ids, decoded = ours(strings)
    assert ids == theirs(strings)
    assert decoded == strings


def test_long_words_agree_with_short_ones():
    merger = bpe.Merger(ENCODER.cache.work.vocabulary)
    rng = random.Random(5)
    for _ in range(50):
        word = "".join(rng.choice("thereand on") for _ in range(rng.randint(1, 90)))
        short, _ = merger([word])
        assert short.tolist() == merger.long(word.encode()).tolist()


def test_cache_starts_anew():
    small = bpe.Encoder(ENCODER.cache.work.vocabulary)
    small.cache.most = 5
    strings = [f"word{i} and {i * 7} more" for i in range(40)]
    for s in strings + strings:
        ids, _ = small(texts.of_strings([s]))
        assert ids.tolist() == theirs([s])[0]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, s, "extra", i) for i, s in enumerate(TRICKY)]
    rows += [rows[9], (None, "null id", None, 1), (7_000, "long words " * 30_000, "x", 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, ids string, n_tokens long")


def test_on_spark(spark, docs):
    want = sorted((str(r.doc_id), ids, hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                   hashlib.sha256((r.text or "").encode()).hexdigest())
                  for r, ids in zip(docs.collect(), theirs([r.text for r in docs.collect()])))
    encoded = bpe.encode_documents(docs, PATH)
    assert sorted((str(r.doc_id), r.ids) for r in encoded.collect()) == [(a, b) for a, b, _, _ in want]
    trip = bpe.round_trip(docs, PATH).collect()
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in trip) == sorted(
        (a, len(b), c, d) for a, b, c, d in want)
    decoded = bpe.decode_documents(encoded, PATH)
    assert sorted((str(r.doc_id), r.text) for r in decoded.collect()) == sorted(
        (str(r.doc_id), r.text or "") for r in docs.collect())


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.round_trip(none, PATH).collect() == []
    assert bpe.decode_documents(bpe.encode_documents(none, PATH), PATH).collect() == []


def test_bytes_that_are_no_text(spark):
    cut = spark.createDataFrame([(1, [0xE9]), (2, None)], "doc_id long, ids array<int>")
    want = LIBRARY.decode([0xE9], skip_special_tokens=False)
    assert {r.doc_id: r.text for r in bpe.decode_documents(cut, PATH).collect()} == {1: want, 2: None}
