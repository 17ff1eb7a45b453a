"""Quality: a generalised additive model with pairwise interactions.

Each feature is cut into bins, and the model is a table of one value for each bin, plus tables over the
bins of a few pairs of features. Tables are learned by boosting that goes round the features: a shallow
tree on one feature (then on one pair) fits what is still unexplained and a small part of it is
added to the table. A score is the sum of the tables' values at a text's bins.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from wayfare.llm import texts
from wayfare.llm.labelled import labelled_sample
from wayfare.llm.texts import Texts, pieces, segment_sums

SAMPLE, BINS, PAIR_BINS, PAIRS = 20_000, 32, 8, 8
ROUNDS, PAIR_ROUNDS, RATE, LEAST = 150, 60, 0.15, 20.0
THRESHOLD = 0.3

FEATURES = ["chars", "word_length", "letters", "capitals", "numbers", "white", "signs", "commonest_sign",
            "lines", "line_length", "repeated_lines", "distinct_words", "sign_words", "sign_ends",
            "shouted_words", "longest_word", "commonest_word", "stops"]


def features(docs: Texts) -> np.ndarray:
    """One row of ``FEATURES`` for each document; all zero for empty ones."""
    n = len(docs)
    found = np.zeros((n, len(FEATURES)), np.float64)
    points, starts = docs.points, docs.starts
    if not len(points):
        return found
    kind = texts.classes()[points]
    size = np.maximum(np.diff(starts), 1).astype(float)

    def share(mask: np.ndarray) -> np.ndarray:
        return segment_sums(mask, starts) / size

    white, letter, sign = kind == texts.SPACE, kind == texts.LETTER, kind == texts.OTHER
    upper = letter & _uppers()[points]
    line_end = points == 10
    put = dict(zip(FEATURES, found.T))
    put["chars"][:] = np.log1p(np.diff(starts))
    put["letters"][:], put["numbers"][:] = share(letter), share(kind == texts.NUMBER)
    put["white"][:], put["signs"][:] = share(white), share(sign)
    put["capitals"][:] = segment_sums(upper, starts) / np.maximum(segment_sums(letter, starts), 1)
    put["stops"][:] = share(np.isin(points, [46, 33, 63]))
    lines = segment_sums(line_end, starts) + 1
    put["lines"][:], put["line_length"][:] = np.log1p(lines), np.log1p(np.diff(starts) / lines)
    at = np.flatnonzero(sign)
    doc = np.searchsorted(starts, at, "right") - 1
    counts = np.bincount(doc * 128 + np.minimum(points[at], 127), minlength=n * 128).reshape(n, 128)
    put["commonest_sign"][:] = counts.max(axis=1) / size

    edge = np.zeros(len(points) + 1, bool)
    edge[starts] = True
    ink = np.append(~white, False)
    before = np.concatenate([[False], ink[:-1]])
    begin = np.flatnonzero(ink & (~before | edge))
    end = np.flatnonzero(before & (~ink | edge))
    first = np.searchsorted(begin, starts)
    words = np.maximum(np.diff(first), 1).astype(float)
    if len(begin):
        lens = end - begin
        letters = _between(letter, begin, end)
        put["word_length"][:] = segment_sums(lens, first) / words
        put["sign_words"][:] = segment_sums(letters == 0, first) / words
        put["sign_ends"][:] = segment_sums(sign[end - 1], first) / words
        put["shouted_words"][:] = segment_sums((letters > 1) & (_between(upper, begin, end) == letters), first) / words
        owner = np.repeat(np.arange(n), np.diff(first))
        np.maximum.at(put["longest_word"], owner, np.log1p(lens))
        hashes = texts.word_hashes(points, begin, lens, seeds=(1,))[0]
        distinct, most = _repeats(owner, hashes, n)
        put["distinct_words"][:], put["commonest_word"][:] = distinct / words, most / words
    line_begin = np.union1d(starts[:-1][np.diff(starts) > 0], np.flatnonzero(line_end) + 1)
    line_begin = line_begin[line_begin < len(points)]
    line_stop = np.append(line_begin[1:], len(points))
    full = line_stop - line_begin > 20
    line_begin, line_stop = line_begin[full], line_stop[full]
    if len(line_begin):
        owner = np.searchsorted(starts, line_begin, "right") - 1
        hashes = texts.word_hashes(points, line_begin, line_stop - line_begin, seeds=(1,))[0]
        distinct, _ = _repeats(owner, hashes, n)
        put["repeated_lines"][:] = 1 - distinct / np.maximum(np.bincount(owner, minlength=n), 1)
        put["repeated_lines"][np.bincount(owner, minlength=n) == 0] = 0
    found[np.diff(starts) == 0] = 0
    return found


def _uppers() -> np.ndarray:
    if not hasattr(_uppers, "table"):
        _uppers.table = np.array([chr(c).isupper() for c in range(0x110000)])
    return _uppers.table


def _between(mask: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    total = np.zeros(len(mask) + 1, np.int64)
    np.cumsum(mask, out=total[1:])
    return total[end] - total[begin]


def _repeats(owner: np.ndarray, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """For each document how many different hashes it has, and how often its most frequent one occurs."""
    order = np.lexsort((hashes, owner))
    owner, hashes = owner[order], hashes[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1])
    first = np.flatnonzero(new)
    counts = np.diff(first, append=len(owner))
    most = np.zeros(n, np.int64)
    np.maximum.at(most, owner[first], counts)
    return np.bincount(owner[first], minlength=n), most


class Model:
    """Bin edges, the tables of single features, and those of pairs."""

    def __init__(self, edges: list[np.ndarray], bias: float):
        self.edges, self.bias = edges, bias
        self.tables = [np.zeros(len(e) + 1) for e in edges]
        self.pairs: dict[tuple[int, int], np.ndarray] = {}
        self.coarse = [np.minimum(np.arange(len(e) + 1) * PAIR_BINS // (len(e) + 1), PAIR_BINS - 1) for e in edges]

    def bins(self, rows: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x, "right") for e, x in zip(self.edges, rows.T)])

    def sums(self, bins: np.ndarray) -> np.ndarray:
        total = np.full(bins.shape[1], self.bias)
        for table, own in zip(self.tables, bins):
            total += table[own]
        for (a, b), table in self.pairs.items():
            total += table[self.coarse[a][bins[a]], self.coarse[b][bins[b]]]
        return total

    def scores(self, docs: Texts) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.sums(self.bins(features(docs))), -60, 60)))


def _split(slope: np.ndarray, weight: np.ndarray, least: float) -> tuple[float, int]:
    """The best place to cut a line of bins in two, and what it gains (0 if no cut has enough rows)."""
    left_s, left_w = np.cumsum(slope)[:-1], np.cumsum(weight)[:-1]
    s, w = slope.sum(), weight.sum()
    fine = (left_w >= least) & (w - left_w >= least)
    if not fine.any():
        return 0.0, 0
    with np.errstate(all="ignore"):
        gain = left_s**2 / (left_w + 1) + (s - left_s)**2 / (w - left_w + 1) - s * s / (w + 1)
    gain[~fine] = -1
    return float(gain.max()), int(gain.argmax()) + 1


def shallow_tree(slope: np.ndarray, weight: np.ndarray, least: float, depth: int = 2) -> np.ndarray:
    """The values, for each bin of a feature, of a tree of this depth."""
    gain, at = _split(slope, weight, least) if depth and len(slope) > 1 else (0.0, 0)
    if gain <= 1e-9:
        return np.full(len(slope), slope.sum() / (weight.sum() + 1))
    return np.concatenate([shallow_tree(slope[:at], weight[:at], least, depth - 1),
                           shallow_tree(slope[at:], weight[at:], least, depth - 1)])


def pair_tree(slope: np.ndarray, weight: np.ndarray, least: float) -> tuple[np.ndarray, float]:
    """The same for a grid of two features: a cut along one, then one along the other on each side;
    and what the tree gains over one value for all."""
    best, gain_of_best = np.full(slope.shape, slope.sum() / (weight.sum() + 1)), 0.0
    base = slope.sum()**2 / (weight.sum() + 1)
    for turned in (False, True):
        s, w = (slope.T, weight.T) if turned else (slope, weight)
        for at in range(1, len(s)):
            parts, gain = [], -base
            for part in (slice(0, at), slice(at, None)):
                values = shallow_tree(s[part].sum(axis=0), w[part].sum(axis=0), least, 1)
                parts.append(np.broadcast_to(values, s[part].shape))
                for v in np.unique(values):
                    own = values == v
                    gain += s[part][:, own].sum()**2 / (w[part][:, own].sum() + 1)
            if gain > gain_of_best + 1e-9:
                tree = np.concatenate(parts)
                best, gain_of_best = tree.T if turned else tree, gain
    return best, gain_of_best


def train(rows: np.ndarray, y: np.ndarray, pairs: int = PAIRS, rounds: int = ROUNDS,
          pair_rounds: int = PAIR_ROUNDS, rate: float = RATE, least: float = LEAST) -> Model:
    """Boost single features in turn, then the pairs that explain most of what is left."""
    edges = [np.unique(np.quantile(x, np.linspace(0, 1, BINS + 1)[1:-1])) if len(x) else np.empty(0)
             for x in rows.T]
    share = np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3)
    model = Model(edges, float(np.log(share / (1 - share))))
    if not len(y):
        return model
    bins = model.bins(rows)
    total = model.sums(bins)

    def told(total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-np.clip(total, -30, 30)))
        return y - p, p * (1 - p)

    least_weight = least * share * (1 - share)
    for _ in range(rounds):
        for f, own in enumerate(bins):
            slope, weight = told(total)
            k = len(model.tables[f])
            step = rate * shallow_tree(np.bincount(own, slope, k), np.bincount(own, weight, k), least_weight * 0.25)
            model.tables[f] += step
            total += step[own]

    def grid(a: int, b: int, values: np.ndarray) -> np.ndarray:
        cell = model.coarse[a][bins[a]] * PAIR_BINS + model.coarse[b][bins[b]]
        return np.bincount(cell, values, PAIR_BINS**2).reshape(PAIR_BINS, PAIR_BINS)

    slope, weight = told(total)
    gains = {(a, b): pair_tree(grid(a, b, slope), grid(a, b, weight), least_weight * 0.25)[1]
             for a in range(len(edges)) for b in range(a + 1, len(edges))}
    for pair in sorted(gains, key=lambda p: (-gains[p], p))[:pairs]:
        model.pairs[pair] = np.zeros((PAIR_BINS, PAIR_BINS))
    for _ in range(pair_rounds):
        for (a, b), table in model.pairs.items():
            slope, weight = told(total)
            step = rate * pair_tree(grid(a, b, slope), grid(a, b, weight), least_weight * 0.25)[0]
            table += step
            total += step[model.coarse[a][bins[a]], model.coarse[b][bins[b]]]
    return model


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id",
        text_col: str = "text") -> Model:
    """Learn ``quality`` of ``labels`` from about ``sample`` rows outside the held-out fold. Features are
    worked out on the executors; a sample of numbers of bounded size comes to the driver. Without any
    label every text scores 0.5."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            rows = features(texts.of_arrow(piece.column("text")))
            yield pa.RecordBatch.from_arrays([piece.column("y"), *(pa.array(x) for x in rows.T)], ["y", *FEATURES])

    drawn = labelled_sample(docs, labels, "quality", sample, id_col, text_col)
    told = drawn.mapInArrow(measure, "y int, " + ", ".join(f"{f} double" for f in FEATURES)).toPandas()
    told = told.sort_values(["y", *FEATURES])
    return train(told[FEATURES].to_numpy(float), told["y"].to_numpy(float))
