"""Shards against their definition, worked out by hand."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import pytest

from wayfare.llm.sharding import stratified_shards


def check(docs, shards):
    rows = [r.asDict() for r in docs.select("doc_id", "text", "source").collect()]
    found = stratified_shards(docs, shards).collect()
    assert Counter((r["doc_id"], len((r["text"] or "").encode()) + 1, zlib.crc32((r["text"] or "").encode()), r["source"])
                   for r in rows) == Counter((r.doc_id, r.size, r.text_crc32, r.stratum) for r in found)
    slots = defaultdict(list)
    for r in found:
        slots[r.shard].append(r.slot)
    for s, own in slots.items():
        assert 0 <= s < shards and sorted(own) == list(range(len(own)))
    sizes = [len(slots[s]) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    mixture = Counter((r.stratum, r.shard) for r in found)
    for stratum, n in Counter(r["source"] for r in rows).items():
        for s in range(shards):
            assert abs(mixture[stratum, s] - n / shards) < 3 + len(set(r["source"] for r in rows)) / shards
    return {(r.doc_id, r.size): (r.shard, r.slot) for r in found}


def test_hot_and_tiny_sources(spark):
    rows = [(i, f"text {i}", "hot" if i % 3 else f"s{i % 11}", 1, "a") for i in range(2000)]
    rows += [(5000 + i, None, f"only{i}", 2, "b") for i in range(40)] + [(7000, "", None, 3, "c")] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, shard int, slot string")
    first = check(docs, 8)
    assert first == check(docs.repartition(13), 8)
    check(docs, 1)
    check(docs, 7)


@pytest.mark.parametrize("n", [1, 5, 8, 9])
def test_few_rows(spark, n):
    docs = spark.createDataFrame([(i, "é" * i, "s") for i in range(n)], "doc_id long, text string, source string")
    check(docs, 8)


def test_null_ids_and_empty_table(spark):
    docs = spark.createDataFrame([(None, None, None), (None, "a", "s"), (1, "a", None)],
                                 "doc_id long, text string, source string")
    check(docs, 2)
    assert stratified_shards(docs.limit(0)).collect() == []


def test_seed_changes_the_order(spark):
    docs = spark.createDataFrame([(i, "t", "s") for i in range(500)], "doc_id long, text string, source string")
    place = [{r.doc_id: r.shard for r in stratified_shards(docs, 8, seed).collect()} for seed in (1, 2)]
    assert place[0] != place[1]
