"""Token alignment against plain loops over the libraries' tokens."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict
from random import Random

import pytest
from tokenizers import Tokenizer

from sentencepiece import SentencePieceProcessor
from wayfare.llm import alignment, bpe
from wayfare.llm.queries import BYTE_BPE, PIECE_BPE

SCHEMA = "doc_id bigint, text string, pairs string, key string, times string"
NAMES = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def plain(rows):
    """Every row tokenised by the libraries; spans, groups and links found by loops."""
    first = Tokenizer.from_file(BYTE_BPE)
    first.encode_special_tokens = True
    second = SentencePieceProcessor(model_file=PIECE_BPE)
    byte_of = {c: b for b, c in bpe.byte_signs().items()}

    def spans(tokens):
        found, at = [], 0
        for i, raw in tokens:
            found.append((i, at, at + len(raw)))
            at += len(raw)
        return found

    aligned = []
    for _, text, *_ in rows:
        text = text or ""
        a = first.encode(" " + text, add_special_tokens=False)
        a = [(i, bytes(byte_of[c] for c in t)) for i, t in zip(a.ids, a.tokens)] if text else []
        b = [(i, second.id_to_piece(i)) for i in second.encode(text)] if text else []
        b = [(i, bytes([int(p[3:5], 16)]) if second.is_byte(i) else p.replace("▁", " ").encode()) for i, p in b]
        raw = (" " + text).encode()
        if not text or b"".join(x for _, x in a) != raw or b"".join(x for _, x in b) != raw:
            aligned.append(None)
            continue
        a, b = spans(a), spans(b)
        links, start = [], 0
        for i, s, e in a:
            while b[start][2] <= s:
                start += 1
            k = start
            while k < len(b) and b[k][1] < e:
                links.append((i, b[k][0]))
                k += 1
        cuts = sorted({e for _, _, e in a} & {e for _, _, e in b})
        groups, i, k = [], 0, 0
        for end in cuts:
            left, right = [], []
            while i < len(a) and a[i][2] <= end:
                left.append(str(a[i][0]))
                i += 1
            while k < len(b) and b[k][2] <= end:
                right.append(str(b[k][0]))
                k += 1
            groups.append(f"{','.join(left)}|{','.join(right)}")
        aligned.append((len(a), len(b), len(groups), links, ";".join(groups)))
    counts, most = Counter(), defaultdict(int)
    for x in aligned:
        counts.update(set(x[3]) if x else ())
    for (a, _), n in counts.items():
        most[a] = max(most[a], n)
    found = []
    for (doc_id, *_), x in zip(rows, aligned):
        if not x:
            found.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
            continue
        found.append((doc_id, x[0], x[1], x[2], len(x[3]), sum(counts[p] == most[p[0]] for p in x[3]),
                      sum(counts[p] for p in x[3]), hashlib.sha256(x[4].encode()).hexdigest()))
    return sorted(found, key=repr)


def result(df):
    assert df.columns == ["doc_id", *NAMES]
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def rows():
    rng = Random(5)
    parts = ["the", "token", "Straße", "naïve", "12345", "  ", "\n\n", "\t", "don't", "日本語", "🙂👍🏽", "е́", "...", "<|endoftext|>",
             "</s>", "<0x41>", "   x", "antidisestablishment", "ﬁ", "a b", "​"]
    texts_ = [" ".join(rng.choice(parts) for _ in range(rng.randint(1, 40))) for _ in range(60)]
    texts_ += texts_[:10] * 3 + ["copy of a text"] * 50
    texts_ += [None, "", " ", "  ", "\n", "▁", "a▁b", "x", "\x00", "a\x00b", "word " * 5000, "ab" * 20_000]
    return [(None if i == 3 else i // 2 if i < 8 else i, t, "p", "k", "t") for i, t in enumerate(texts_)]


def test_same_as_plain_loops(spark, rows):
    want = plain(rows)
    assert sum(x[1] == 0 for x in want) >= 4 and sum(x[5] < x[4] for x in want) > 10
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert result(alignment.align_documents(docs, BYTE_BPE, PIECE_BPE)) == want


@pytest.mark.parametrize("most", [0, 40])
def test_rare_pairs_are_counted_by_a_shuffle(spark, rows, most):
    docs = spark.createDataFrame(rows[:70], SCHEMA)
    assert result(alignment.align_documents(docs, BYTE_BPE, PIECE_BPE, most=most)) == plain(rows[:70])


def test_common_pairs_are_bounded_and_most_frequent(spark):
    counts = spark.createDataFrame([(i, n, True) for i, n in enumerate([1] * 50 + [2] * 20 + [70] * 3 + [5000])],
                                   "pair bigint, n bigint, best boolean")
    for most, least in ((0, None), (1, 5000), (3, 5000), (4, 70), (23, 70), (24, 2), (80, 1)):
        got = [r["n"] for r in alignment.common_pairs(counts, most).collect()]
        assert len(got) <= most and (min(got, default=None) == least)


def test_empty_table_and_other_names(spark):
    assert result(alignment.align_documents(spark.createDataFrame([], SCHEMA), BYTE_BPE, PIECE_BPE)) == []
    docs = spark.createDataFrame([("a", "hello there"), ("b", None)], "id string, body string")
    got = result(alignment.align_documents(docs, BYTE_BPE, PIECE_BPE, id_col="id", text_col="body"))
    assert got == plain([("a", "hello there"), ("b", None)])


def test_only_texts_without_tokens(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "▁")], "doc_id bigint, text string")
    assert result(alignment.align_documents(docs, BYTE_BPE, PIECE_BPE)) == [(i, 0, 0, 0, 0, 0, 0, "") for i in (1, 2, 3)]
