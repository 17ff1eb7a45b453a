"""The stages, each on its own input, against planted cases and plain checks."""

from __future__ import annotations

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from wayfare.llm import toxicity
from wayfare.llm.registry import ready

from .test_decontaminate import plain

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    ready(spark)
    docs = [spark.read.parquet(f"{SF_DIR}/documents.parquet")]
    for _, stage in corpus_pipeline.STAGES:
        docs.append(stage(spark, docs[-1], SF_DIR).cache())
    return docs


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_all_but_the_last_keep_the_columns(stages):
    for before, after in zip(stages, stages[1:-1]):
        assert after.dtypes == before.dtypes
        kept, had = rows(after), rows(before)
        assert kept.keys() <= had.keys() and all(kept[i] == had[i] for i in kept)


def test_rejected_by_the_classifiers(spark, stages):
    labels = rows(spark.read.parquet(f"{SF_DIR}/labels.parquet"))
    for before, after, bad in ((stages[0], stages[1], lambda r: r.toxic == 1),
                               (stages[1], stages[2], lambda r: r.quality == 0)):
        had, kept = rows(before), rows(after)
        wrong = [i for i in had if i in labels and bad(labels[i])]
        right = [i for i in had if i in labels and not bad(labels[i])]
        assert sum(i not in kept for i in wrong) > 0.75 * len(wrong)
        assert sum(i not in kept for i in right) < 0.02 * len(right)


def test_copies_go_and_clean_documents_stay(stages):
    had, kept = rows(stages[2]), rows(stages[3])
    sets = {i: {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))}
            for i, r in had.items() for w in [(r.text or "").lower().split()]}
    ids = sorted(had)
    shared = {}
    by_shingle: dict = {}
    for i in ids:
        for s in sets[i]:
            by_shingle.setdefault(s, []).append(i)
    for own in by_shingle.values():
        for a in range(len(own)):
            for b in range(a):
                shared[own[b], own[a]] = shared.get((own[b], own[a]), 0) + 1
    likeness = {p: n / len(sets[p[0]] | sets[p[1]]) for p, n in shared.items()}
    assert not [p for p, s in likeness.items() if s >= 0.95 and p[0] in kept and p[1] in kept]
    close = [p for p, s in likeness.items() if s >= 0.8]
    assert sum(p[0] in kept and p[1] in kept for p in close) <= 0.1 * len(close)
    lost = set(had) - set(kept)
    linked = {i for p, s in likeness.items() if s >= 0.5 for i in p}
    assert lost <= linked


def test_contaminated_documents_go(spark, stages):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    had, kept = rows(stages[3]), rows(stages[4])
    dirty = {int(p[0]) for p in plain([(r.doc_id, r.text) for r in had.values()], items)}
    assert set(had) - set(kept) == dirty


def test_token_ids(stages):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    had, found = rows(stages[4]), rows(stages[5])
    assert had.keys() == found.keys()
    for i, e in zip(had, library.encode_batch([r.text or "" for r in had.values()], add_special_tokens=False)):
        assert found[i].ids == e.ids


def test_run_is_the_stages_in_turn(spark, stages):
    assert rows(corpus_pipeline.run(spark, SF_DIR)) == rows(stages[-1])
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "quality", "near_duplicates", "benchmark", "bpe"]


def test_empty_documents(spark, stages):
    docs = stages[0].limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_DIR)
    assert docs.collect() == [] and toxicity.THRESHOLD == 0.5
