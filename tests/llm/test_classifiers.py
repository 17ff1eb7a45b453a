"""Quality, toxicity and language: held-out accuracy, edge cases, and the parts against plain loops."""

from __future__ import annotations

import itertools
import random
import zlib

import numpy as np
import pytest

from wayfare.llm import langid, quality, queries, texts, toxicity
from wayfare.llm.registry import ready

SF_DIR = "/root/testdata/sf0.01"
EDGES = [(1, None, "x"), (2, "", "x"), (3, " \n\t", None), (4, "123 !?", "x"), (5, "a", "x"), (6, "日本語", "x"),
         (7, "word " * 40_000, "x"), (7, "word " * 40_000, "x"), (None, "no id", "x"), (8, "x" * 30_000, "x")]


@pytest.fixture(scope="module")
def edges(spark):
    ready(spark)
    return spark.createDataFrame(EDGES, "doc_id long, text string, score string").withColumnRenamed("score", "held_out")


def area(scores, y):
    order = np.argsort(np.argsort(scores, kind="stable"), kind="stable")
    return (order[y == 1].mean() - (y.sum() - 1) / 2) / (y == 0).sum()


@pytest.mark.parametrize("name, label, threshold, least", [
    ("op4_quality", "quality", 0.3, 0.97), ("op6_toxicity", "toxic", 0.5, 0.85)])
def test_held_out_scores(spark, name, label, threshold, least):
    found = queries.QUERIES[name](spark, SF_DIR).toPandas()
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id").toPandas()
    assert sorted(found["doc_id"]) == sorted(docs["doc_id"])
    assert (found["held_out"] == [zlib.crc32(str(i).encode()) % 5 == 0 for i in found["doc_id"]]).all()
    assert found["score"].between(0, 1).all() and (found["predicted"] == (found["score"] >= threshold)).all()
    both = found[found["held_out"]].merge(spark.read.parquet(f"{SF_DIR}/labels.parquet").toPandas(), on="doc_id")
    assert area(both["score"].to_numpy(), both[label].to_numpy()) > least


def test_held_out_languages(spark):
    found = queries.QUERIES["op5_language"](spark, SF_DIR).toPandas()
    both = found.merge(spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "lang").toPandas(), on="doc_id")
    assert len(both) == len(found) and found["score"].between(0, 1).all()
    held = both[both["held_out"] & both["lang"].notna()]
    assert (held["lang_pred"] == held["lang"]).mean() > 0.98


def labelled(spark, good, bad, label):
    rows = [(i, good(i) if i % 2 else bad(i)) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)] + [(None, 1), (3, None), (999, 1)],
                                   f"doc_id long, {label} int")
    return docs, labels


def test_edge_cases(spark, edges):
    docs, labels = labelled(spark, lambda i: f"calm words number {i}", lambda i: f"!!! LOUD $$$ {i}", "quality")
    for module, own in ((quality, labels), (toxicity, labels.withColumnRenamed("quality", "toxic"))):
        for model in (module.fit(docs, own), module.fit(docs, own.limit(0)), module.fit(docs.limit(0), own)):
            found = toxicity.score_documents(edges, model).collect()
            assert sorted(str(r.doc_id) for r in found) == sorted(str(r[0]) for r in EDGES)
            assert all(0 <= r.score <= 1 for r in found)
            assert toxicity.score_documents(edges.limit(0), model).collect() == []
            kept = toxicity.keep_documents(edges, model, lambda s: s > 2)
            assert kept.columns == edges.columns and kept.count() == 0
            assert toxicity.keep_documents(edges, model, lambda s: s >= 0).count() == len(EDGES)
    tagged = docs.selectExpr("doc_id", "text", "if(doc_id % 2 = 0, 'loud', 'calm') AS lang")
    for rows in (tagged, tagged.limit(0), tagged.selectExpr("doc_id", "text", "CAST(null AS string) AS lang")):
        model = langid.fit(rows)
        found = {r.doc_id: r for r in langid.identify(edges, model).collect()}
        assert {found[i].lang_pred for i in (1, 2, 3, 4)} == {"und"} and found[1].score == 0
        assert found[5].lang_pred in ({"calm", "loud"} if model.langs else {"und"})
        spans = {r.doc_id: r.spans for r in langid.label_spans(edges, model).collect()}
        assert spans[1] == spans[4] == [] and [(s.start, s.end) for s in spans[5]] == [(0, 1)]
        assert langid.identify(edges.limit(0), model).collect() == []


def test_labels_never_leak(spark):
    """Labels of the held-out fold don't change the model."""
    docs, labels = labelled(spark, lambda i: f"calm words {i}", lambda i: f"loud words {i}", "toxic")
    flipped = labels.selectExpr("doc_id", "if(pmod(crc32(CAST(doc_id AS string)), 5) = 0, 1 - toxic, toxic) AS toxic")
    one, other = toxicity.fit(docs, labels), toxicity.fit(docs, flipped)
    assert (one.features == other.features).all() and np.allclose(one.weights, other.weights)


def plain_path(scores, switch):
    best = None
    for path in itertools.product(range(scores.shape[1]), repeat=len(scores)):
        value = sum(scores[i, l] for i, l in enumerate(path)) - switch * sum(a != b for a, b in zip(path, path[1:]))
        if best is None or value > best + 1e-9:
            best = value
    return best


def test_viterbi_against_all_paths():
    rng = np.random.default_rng(2)
    counts = rng.integers(0, 7, 40)
    first = np.concatenate([[0], np.cumsum(counts)])
    scores = rng.normal(size=(first[-1], 3)) * 3
    labels = langid.best_path(scores, first, 2.0)
    for a, b in zip(first, first[1:]):
        if b > a:
            own = labels[a:b]
            value = scores[np.arange(a, b), own].sum() - 2.0 * (own[1:] != own[:-1]).sum()
            assert abs(value - plain_path(scores[a:b], 2.0)) < 1e-9


def test_spans_of_mixed_text(spark):
    rng = random.Random(1)
    words = {"aa": ["bana", "nabu", "ubana", "nuba"], "cy": ["рука", "нога", "река"], "kk": ["kitto", "tekki", "okkit"]}
    rows = [(i, " ".join(rng.choice(words[lang]) for _ in range(30)), lang)
            for i, lang in enumerate(["aa", "cy", "kk"] * 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(docs)
    text = "bana nabu nuba ubana, река нога рука. kitto tekki okkit kitto!"
    mixed = spark.createDataFrame([(1, text)], "doc_id long, text string")
    spans = langid.label_spans(mixed, model).first().spans
    assert [(text[s.start:s.end], s.lang) for s in spans] == [
        ("bana nabu nuba ubana", "aa"), ("река нога рука", "cy"), ("kitto tekki okkit kitto", "kk")]


def test_ngrams_against_loops():
    strings = ["", "Ab", "an idiot, here", "é", "x1 y2"]
    docs = texts.of_strings(strings)
    for n, (found, edges, lens) in zip(toxicity.ORDERS, toxicity.slots(docs)):
        seen = {}
        for i, s in enumerate(strings):
            framed = " " + "".join(c if c.isalnum() else " " for c in s.lower()) + " "
            grams = [framed[k:k + n] for k in range(len(framed) - n + 1)]
            assert lens[i] == len(grams)
            for g, slot in zip(grams, found[edges[i]:edges[i] + lens[i]].tolist()):
                assert seen.setdefault(g, slot) == slot
        assert len(set(seen.values())) >= len(seen) - 1


def test_quality_features_against_loops():
    strings = ["", "One two two.\nOne two two.\nA line that is long enough\nA line that is long enough", "!!! ## ab", "AB cd EF"]
    rows = quality.features(texts.of_strings(strings))
    get = lambda name: rows[:, quality.FEATURES.index(name)]
    for i, s in enumerate(strings):
        found = s.split()
        if not s:
            assert not rows[i].any()
            continue
        assert np.isclose(get("distinct_words")[i], len(set(found)) / len(found))
        assert np.isclose(get("commonest_word")[i], max(map(found.count, found)) / len(found))
        assert np.isclose(get("word_length")[i], sum(map(len, found)) / len(found))
        assert np.isclose(get("sign_words")[i], sum(not any(c.isalpha() for c in w) for w in found) / len(found))
        assert np.isclose(get("shouted_words")[i], sum(w.isupper() and sum(map(str.isalpha, w)) > 1 and all(
            c.isupper() for c in w if c.isalpha()) for w in found) / len(found))
        assert np.isclose(get("longest_word")[i], np.log1p(max(map(len, found))))
        assert np.isclose(get("signs")[i], sum(not c.isalnum() and not c.isspace() for c in s) / len(s))


def test_pairs_learn_what_single_features_cannot():
    rng = np.random.default_rng(3)
    rows = rng.random((4000, 3))
    y = ((rows[:, 0] > 0.5) ^ (rows[:, 1] > 0.5)).astype(float)
    alone, paired = quality.train(rows, y, pairs=0, rounds=20), quality.train(rows, y, pairs=2, rounds=20)
    assert area(alone.sums(alone.bins(rows)), y) < 0.7 < 0.97 < area(paired.sums(paired.bins(rows)), y)
    assert (0, 1) in paired.pairs
