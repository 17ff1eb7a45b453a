"""Containment against plain sets of shingles."""

from __future__ import annotations

import random
import re

import pytest

from wayfare.llm import decontaminate


def words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def shingles(found, width):
    return {tuple(found[i:i + width]) for i in range(len(found) - width + 1)}


def plain(docs, items, threshold=0.8):
    least = {}
    for i, text in items:
        if i is not None and words(text):
            least[tuple(words(text))] = min(i, least.get(tuple(words(text)), i))
    found = []
    for row in docs:
        for sequence, i in least.items():
            width = min(5, len(sequence))
            own = shingles(list(sequence), width)
            n = len(own & shingles(words(row[1]), width))
            if n >= threshold * len(own) - 1e-9:
                found.append((str(row[0]), i, len(own), n))
    return sorted(found)


def made(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdéß") for _ in range(rng.randint(1, 6)))
    line = lambda n: [word() for _ in range(n)]
    items = [(i, " ".join(line(n))) for i, n in enumerate([5, 6, 8, 14, 20, 21, 36, 60, 70, 140, 700] * 2)]
    items += [(90, "two words"), (91, "Single"), (92, None), (93, ""), (94, "..."), (95, items[4][1].upper()),
              (None, "no id for this item at all"), (96, "same same same same same same same")]
    docs = [(1, None), (2, ""), (3, "x"), (4, " - "), (5, "here are TWO, words"), (6, "same " * 300)]
    for i in range(150):
        text = line(rng.choice([0, 5, 40, 300, 3000]))
        for _, item in rng.sample(items[:22], rng.choice([0, 1, 2])):
            taken = item.split()
            for _ in range(rng.choice([0, 0, 1, 3])):
                taken[rng.randrange(len(taken))] = word()
            at = rng.randint(0, len(text))
            text[at:at] = taken
        joined = " ".join(w.capitalize() if rng.random() < 0.3 else w for w in text)
        docs.append((10 + i, joined.replace(" ", ", ", 3).replace(" ", "\n", 9)))
    return docs + [docs[10], (None, docs[11][1])], items


@pytest.mark.parametrize("seed, block", [(1, 20_000), (2, 7)])
def test_against_sets(spark, seed, block):
    rows, items = made(seed)
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, item_id string, n_item int")
    bench = spark.createDataFrame([(*i, 0) for i in items], "item_id long, text string, doc_id int")
    got = decontaminate.contaminated(docs.repartition(4), bench, block_items=block).collect()
    assert sorted((str(r.doc_id), r.item_id, r.n_item, r.n_shared) for r in got) == plain(rows, items)
    assert all(abs(r.containment - r.n_shared / r.n_item) < 1e-12 for r in got)
    dirty = {r[0] for r in plain(rows, items)}
    kept = decontaminate.without_contaminated(docs, bench, block_items=block)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r[0]) for r in rows if str(r[0]) not in dirty)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "some text of a few words here")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "some text of a few words here")], "item_id long, text string")
    assert decontaminate.contaminated(docs, items.limit(0)).collect() == []
    assert decontaminate.contaminated(docs.limit(0), items).collect() == []
    assert decontaminate.contaminated(docs, items).count() == 1
    assert decontaminate.without_contaminated(docs, items.limit(0)).count() == 1


@pytest.mark.parametrize("block", [20_000, 20])
def test_items_of_the_same_words_are_one_item(spark, block):
    rng = random.Random(4)
    sequences = [["".join(rng.choice("abcdéßİΣ") for _ in range(5)) for _ in range(9)] for _ in range(12)]
    items = [(12 * k + i, sep.join(ws)) for k, sep in enumerate([", ", "  ", " - ", ".\n"]) for i, ws in enumerate(sequences)]
    items += [(100 + i, "(" + " ".join(ws).upper().lower() + ")!") for i, ws in enumerate(sequences)]
    rows = [(i, "before " + " ".join(ws) + " after") for i, ws in enumerate(sequences)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string").repartition(3)
    got = decontaminate.contaminated(docs, bench, block_items=block).collect()
    assert sorted((str(r.doc_id), r.item_id, r.n_item, r.n_shared) for r in got) == plain(rows, items)
