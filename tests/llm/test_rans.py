"""Round trips of the coded ids, checkpoints, checksums and files."""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from wayfare.llm import rans
from wayfare.session import scratch_path

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("n", [0, 1, 63, 64, 65, 1000, 70_001, 262_144, 400_003])
def test_block_round_trip(n):
    rng = np.random.default_rng(n)
    ids = np.minimum(rng.zipf(1.3, n) - 1, 50_256).astype(np.int64)
    table = rans.Table.of_counts(np.bincount(ids, minlength=50_257))
    block = rans.encode(ids, table)
    assert (rans.decode(block, table) == ids).all()
    lanes, segments = rans.HEADER.unpack_from(block)[2:4]
    alone = [rans.decode(block, table, only=i) for i in range(segments)]
    assert (np.concatenate(alone) == ids).all()
    if n == 400_003:
        p = np.bincount(ids) / n
        entropy = -(p[p > 0] * np.log2(p[p > 0])).sum() * n / 8
        assert len(block) < 1.05 * entropy + 8 * lanes * segments + 1000


@pytest.mark.parametrize("counts", [[5], [0, 0, 1], [1] * 50_257, [10**12, 1, 1, 0, 3], [1] * 5000 + [10**15], [0]])
def test_tables(counts):
    table = rans.Table.of_counts(np.array(counts))
    assert ((table.frequencies > 0) >= (np.array(counts) > 0)).all()
    ids = np.repeat(np.flatnonzero(counts), 3)
    assert (rans.decode(rans.encode(ids, table), table) == ids).all()


def test_damage_is_noticed():
    ids = np.arange(5000) % 700
    table = rans.Table.of_counts(np.bincount(ids))
    block = bytearray(rans.encode(ids, table))
    block[len(block) // 2] ^= 1
    with pytest.raises(ValueError, match="damaged"):
        rans.decode(bytes(block), table)
    with pytest.raises(ValueError, match="another"):
        rans.decode(rans.encode(ids, table), rans.Table.of_counts(np.bincount(ids) + 1 + ids[:700]))
    with pytest.raises(ValueError, match="know"):
        rans.encode(np.array([9]), rans.Table.of_counts(np.array([1, 1])))


def test_files(spark, monkeypatch):
    rows = [(3 * i % 101, f"document {i} " * (i % 9), "x", i) for i in range(101)]
    rows += [(200, None, "x", 1), (201, "", None, 1), (202, "long " * 300_000, "x", 1), rows[8],
             (None, "null id", "x", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, start long").repartition(7)
    path = scratch_path(spark, "rans-test")
    rans.write_ids(docs, path, PATH, end_id=0)
    library = Tokenizer.from_file(PATH)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0]))
    want, start = [], 0
    for key, text, *_ in order:
        ids = library.encode(text or "", add_special_tokens=False).ids + [0]
        want.append((key, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
        start += len(ids)
    key = lambda r: (r[1])
    found = [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in rans.read_ids(spark, path, True).collect()]
    assert sorted(found, key=key) == [r[:4] for r in want]
    whole = [(r.doc_id, r.start, r.n_tokens, r.ids) for r in rans.read_ids(spark, path).collect()]
    assert sorted(whole, key=key) == [(*r[:3], r[4]) for r in want]


def test_empty_table(spark):
    path = scratch_path(spark, "rans-none")
    rans.write_ids(spark.createDataFrame([], "doc_id long, text string"), path, PATH)
    assert rans.read_ids(spark, path).collect() == []


def test_library_words():
    from .test_bpe import TRICKY

    content = rans.bpe.read_vocabulary(PATH)
    encoder = rans.bpe.Encoder(rans.bpe.vocabulary(content), rans._Library(content))
    ids, starts = encoder(rans.texts.of_strings(TRICKY))
    library = Tokenizer.from_file(PATH)
    for text, a, b in zip(TRICKY, starts, starts[1:]):
        assert ids[a:b].tolist() == library.encode(text or "", add_special_tokens=False).ids
