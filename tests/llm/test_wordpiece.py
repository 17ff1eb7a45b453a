"""Greedy longest match against the tokenizers library and against plain search."""

from __future__ import annotations

import random

import public_tokenizers
from tokenizers import models

from wayfare.llm import bpe, texts
from wayfare.llm.wordpiece import LongestMatch, token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")


def greedy(word: bytes, pieces: set[bytes]) -> int:
    at = n = 0
    while at < len(word):
        end = next((e for e in range(len(word), at, -1) if word[at:e] in pieces), None)
        if end is None:
            return -1
        at, n = end, n + 1
    return n


def test_against_the_library():
    rng = random.Random(3)
    for _ in range(60):
        words = {"".join(rng.choice("abc") for _ in range(rng.randint(1, 5))) for _ in range(rng.randint(2, 12))}
        parts = {"".join(rng.choice("abc") for _ in range(rng.randint(1, 5))) for _ in range(rng.randint(1, 12))}
        vocab = {w: i for i, w in enumerate(["[UNK]", *sorted(words), *("##" + p for p in sorted(parts))])}
        library = models.WordPiece(vocab, unk_token="[UNK]", max_input_chars_per_word=10_000)
        ours = LongestMatch((w.encode() for w in sorted(words)), (p.encode() for p in sorted(parts)))
        for _ in range(150):
            word = "".join(rng.choice("abc") for _ in range(rng.randint(1, 14)))
            theirs = [t.value for t in library.tokenize(word)]
            assert ours.count(word.encode()) == (-1 if theirs == ["[UNK]"] else len(theirs)), word


def test_one_set_of_pieces():
    rng = random.Random(4)
    for _ in range(60):
        pieces = {bytes(rng.choice(b"xyz") for _ in range(rng.randint(1, 6))) for _ in range(rng.randint(1, 15))}
        ours = LongestMatch(pieces)
        for _ in range(100):
            word = bytes(rng.choice(b"xyz") for _ in range(rng.randint(0, 15)))
            assert ours.count(word) == greedy(word, pieces)


def test_whole_texts(spark):
    strings = ["", None, "plain words, then more: it's 12 o'clock", "é日本🙂 " * 50, "a" * 20_000,
               "<|endoftext|> x", "plain words, then more: it's 12 o'clock"]
    docs = spark.createDataFrame([(i, s, 5) for i, s in enumerate(strings)], "doc_id long, text string, n_tokens int")
    pieces = {p for p in bpe.vocabulary(bpe.read_vocabulary(PATH)).pieces if p}
    specials = bpe.vocabulary(bpe.read_vocabulary(PATH)).special_pattern
    longest = max(map(len, pieces))
    want = {}
    for i, s in enumerate(strings):
        found = texts.of_strings([s])
        starts, lens, _ = bpe.split(found, specials)
        words = [(s or "")[a:a + n].encode() for a, n in zip(starts, lens)]
        total = 0
        for w in words:
            while w:
                end = next(e for e in range(min(len(w), longest), 0, -1) if w[:e] in pieces)
                w, total = w[end:], total + 1
        want[i] = (len(words), total, 0)
    got = {r.doc_id: (r.n_words, r.n_tokens, r.n_unknown) for r in token_counts(docs, PATH).collect()}
    assert got == want
    assert token_counts(docs.limit(0), PATH).collect() == []
