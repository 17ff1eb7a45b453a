"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

A feature is a hashed n-gram that occurs in a text or doesn't. Its value is the log of the ratio of its
shares among toxic and other documents; the n-grams whose ratio is the most certain are kept. A
logistic regression on these values gives the weights, so scoring is a look-up of each n-gram.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.llm import texts
from wayfare.llm.labelled import fold, labelled_sample
from wayfare.llm.texts import Texts, pieces

ORDERS = (3, 4, 5, 6)
BITS = 18
SAMPLE, FEATURES = 20_000, 2048
THRESHOLD = 0.5


@lru_cache(maxsize=1)
def folded() -> np.ndarray:
    """Each code point in lower case; what is neither letter nor number counts as a space."""
    lower = np.array([ord(x) if len(x := chr(c).lower()) == 1 else c for c in range(0x110000)], np.uint32)
    kind = texts.classes()
    lower[(kind != texts.LETTER) & (kind != texts.NUMBER)] = 32
    return lower


def slots(docs: Texts) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order the hashed n-grams at all places, and where each document's begin. Documents are
    framed by a space, so that the n-grams of their first and last words have an edge."""
    lens = np.diff(docs.starts)
    points = np.full(len(docs.points) + 2 * len(lens), 32, np.uint32)
    edges = docs.starts + 2 * np.arange(len(docs.starts))
    points[texts.expand(edges[:-1] + 1, lens)] = folded()[docs.points]
    mixed = points * np.uint32(0x85EBCA6B)
    mixed ^= mixed >> np.uint32(13)
    hashes = np.zeros(len(points), np.uint32)
    for n in range(1, max(ORDERS) + 1):
        usable = max(0, len(points) - n + 1)
        hashes = (hashes[:usable] * np.uint32(0x01000193)) ^ mixed[n - 1:n - 1 + usable]
        if n in ORDERS:
            found = (hashes * np.uint32(0x9E3779B1) + np.uint32(n)) * np.uint32(0xC2B2AE35) >> np.uint32(32 - BITS)
            yield found, np.minimum(edges, usable), np.maximum(np.diff(edges) - n + 1, 0)


class Model:
    def __init__(self, features: np.ndarray, weights: np.ndarray, bias: float):
        self.features, self.weights, self.bias = features, weights, bias
        self.column = np.full(1 << BITS, -1, np.int16)
        self.column[features] = np.arange(len(features))

    def present(self, docs: Texts) -> np.ndarray:
        """Which document has which feature."""
        seen = np.zeros((len(docs), len(self.features)), bool)
        for found, edges, lens in slots(docs):
            column = self.column[found]
            at = np.flatnonzero(column >= 0)
            doc = np.searchsorted(edges, at, "right") - 1
            inside = at < edges[doc] + lens[doc]
            seen[doc[inside], column[at[inside]]] = True
        return seen

    def scores(self, docs: Texts) -> np.ndarray:
        total = self.present(docs).astype(np.float32) @ self.weights.astype(np.float32) + self.bias
        return 1 / (1 + np.exp(-np.clip(total.astype(np.float64), -60, 60)))


def choose_features(toxic: np.ndarray, other: np.ndarray, n_toxic: int, n_other: int,
                    most: int) -> tuple[np.ndarray, np.ndarray]:
    """The slots whose log-count ratios are the most certain, and these ratios. The counts are of
    documents that hold the n-gram."""
    p, q = (toxic + 1) / (n_toxic + 2), (other + 1) / (n_other + 2)
    ratio = np.log(p / q)
    sure = np.abs(ratio) / np.sqrt(1 / (toxic + 1) + 1 / (other + 1))
    features = np.sort(np.argsort(-sure, kind="stable")[:most])
    features = features[toxic[features] + other[features] > 0]
    return features, ratio[features]


def fit_linear(rows: list[np.ndarray], y: np.ndarray, ratios: np.ndarray, penalty: float = 2.0,
               steps: int = 300) -> tuple[np.ndarray, float]:
    """Logistic regression on the scaled features, by accelerated gradient steps. ``rows`` holds the
    numbers of the features of each document."""
    n, k = len(rows), len(ratios)
    if not n:
        return np.zeros(k), 0.0
    owner = np.repeat(np.arange(n), [len(r) for r in rows])
    column = np.concatenate(rows).astype(np.int64)
    values = ratios[column]
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    w, bias = np.zeros(k), float(np.log(share / (1 - share)))
    ahead, ahead_bias, t = w.copy(), bias, 1.0
    norms = np.bincount(owner, values**2, minlength=n)
    rate = 1 / (0.25 * (norms.mean() * 2 + 1) + penalty / n)
    loss = np.inf
    for _ in range(steps):
        score = np.bincount(owner, values * ahead[column], minlength=n) + ahead_bias
        miss = 1 / (1 + np.exp(-np.clip(score, -60, 60))) - y
        now = np.logaddexp(0, np.where(y > 0, -score, score)).mean() + penalty * (ahead**2).sum() / (2 * n)
        if now > loss:  # too far: shorter steps, from where it was
            ahead, ahead_bias, t, rate = w.copy(), bias, 1.0, rate / 2
            loss = np.inf
            continue
        loss = now
        slope = np.bincount(column, values * miss[owner], minlength=k) / n + penalty * ahead / n
        new, new_bias = ahead - rate * slope, ahead_bias - rate * miss.mean()
        next_t = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead, ahead_bias = new + (t - 1) / next_t * (new - w), new_bias + (t - 1) / next_t * (new_bias - bias)
        w, bias, t = new, new_bias, next_t
    return w, float(bias)


def document_counts(docs: Texts, y: np.ndarray) -> np.ndarray:
    """How many documents of class 0 and of class 1 hold each slot."""
    counts = np.zeros((2, 1 << BITS), np.int64)
    parts = list(slots(docs))
    for i in range(len(docs)):
        seen = np.zeros(1 << BITS, bool)
        for found, edges, lens in parts:
            seen[found[edges[i]:edges[i] + lens[i]]] = True
        counts[y[i]] += seen
    return counts


def train(sample: DataFrame, features: int = FEATURES) -> Model:
    """From ``text`` and ``y`` of a sample of bounded size; counting runs on the executors."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, sizes = np.zeros((2, 1 << BITS), np.int64), np.zeros(2, np.int64)
        for piece in pieces(batches, "text"):
            y = piece.column("y").to_numpy()
            total += document_counts(texts.of_arrow(piece.column("text")), y)
            sizes += np.bincount(y, minlength=2)
        slot = np.flatnonzero(total.any(axis=0))
        slot, total = np.append(slot, -1), np.append(total[:, slot], sizes[:, None], axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(slot, pa.int32()), pa.array(total[1]), pa.array(total[0])],
                                         ["slot", "toxic", "other"])

    found = sample.mapInArrow(count, "slot int, toxic bigint, other bigint").groupBy("slot").agg(
        F.sum("toxic").alias("toxic"), F.sum("other").alias("other")).toPandas()
    counts = np.zeros((2, (1 << BITS) + 1), np.int64)
    counts[:, found["slot"]] = found["other"], found["toxic"]
    chosen, ratios = choose_features(counts[1, :-1], counts[0, :-1], counts[1, -1], counts[0, -1], features)
    bare = sample.sparkSession.sparkContext.broadcast(Model(chosen, np.zeros(len(chosen)), 0.0))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            seen = bare.value.present(texts.of_arrow(piece.column("text")))
            held = [np.flatnonzero(r).astype("<u2").tobytes() for r in seen]
            yield pa.RecordBatch.from_arrays([piece.column("y"), pa.array(held, pa.binary())], ["y", "held"])

    told = sample.mapInArrow(rows, "y int, held binary").toPandas().sort_values(["y", "held"])
    weights, bias = fit_linear([np.frombuffer(h, "<u2") for h in told["held"]], told["y"].to_numpy(float), ratios)
    return Model(chosen, weights * ratios, bias)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id",
        text_col: str = "text") -> Model:
    """Learn ``toxic`` of ``labels`` from about ``sample`` rows outside the held-out fold. Without any
    label every text scores 0.5."""
    return train(labelled_sample(docs, labels, "toxic", sample, id_col, text_col))


def score_documents(docs: DataFrame, model, threshold: float = THRESHOLD, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` by a model with a method ``scores``.

    Null texts score like empty ones. Repeated rows are scored one by one, other columns ignored. A
    null id counts as held out.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            scores = shared.value.scores(texts.of_arrow(piece.column("text")))
            yield pa.RecordBatch.from_arrays([
                piece.column("doc_id"), piece.column("held_out"), pa.array(scores, pa.float64()),
                pa.array((scores >= threshold).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(
        F.col(id_col).alias("doc_id"), (fold(id_col) == 0).alias("held_out"), F.col(text_col).alias("text"),
    ).mapInArrow(score, f"doc_id {kind}, held_out boolean, score double, predicted int")


def keep_documents(docs: DataFrame, model, accept, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose scores ``accept`` lets pass."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, text_col):
            yield piece.filter(pa.array(accept(shared.value.scores(texts.of_arrow(piece.column(text_col))))))

    return docs.mapInArrow(keep, docs.schema)
