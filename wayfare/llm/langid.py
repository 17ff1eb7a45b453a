"""Language identification of spans.

Every word (run of letters) gets a score for each language from its character n-grams; the script of its
letters narrows the languages that come into question. The Viterbi path over a text's words, with a
penalty for each switch, labels spans; the language of most letters is the text's.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.llm import texts
from wayfare.llm.labelled import fold, language_sample
from wayfare.llm.texts import Texts, WordCache, pieces

ORDERS = (1, 2, 3, 4)
BITS = 16
SAMPLE = 3_000  # documents of each language
SWITCH = 12.0  # log-likelihood that a switch of language costs
OUT = 40.0  # what a word loses for a language that does not use its script
UNKNOWN = "und"

# First code points of ranges and the script that is written there (Unicode blocks, coarsely).
# Fixed values.
SCRIPTS = [
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
    (0x0600, "arabic"), (0x0700, "other"), (0x0750, "arabic"), (0x0780, "other"), (0x08A0, "arabic"),
    (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "gurmukhi"), (0x0A80, "gujarati"),
    (0x0B00, "other"), (0x0B80, "tamil"), (0x0C00, "telugu"), (0x0C80, "kannada"), (0x0D00, "malayalam"),
    (0x0D80, "sinhala"), (0x0E00, "thai"), (0x0E80, "other"), (0x10A0, "georgian"), (0x1100, "hangul"),
    (0x1200, "other"), (0x1C80, "cyrillic"), (0x1C90, "georgian"), (0x1CC0, "other"), (0x1E00, "latin"),
    (0x1F00, "greek"), (0x2000, "other"), (0x2C60, "latin"), (0x2C80, "other"), (0x2DE0, "cyrillic"),
    (0x2E00, "han"), (0x3040, "kana"), (0x3100, "han"), (0x3130, "hangul"), (0x3190, "han"),
    (0x31F0, "kana"), (0x3200, "han"), (0xA000, "other"), (0xA640, "cyrillic"), (0xA6A0, "other"),
    (0xA720, "latin"), (0xA800, "other"), (0xAC00, "hangul"), (0xD7FC, "other"), (0xF900, "han"),
    (0xFB00, "latin"), (0xFB13, "armenian"), (0xFB1D, "hebrew"), (0xFB50, "arabic"), (0xFE00, "other"),
    (0xFE70, "arabic"), (0xFF00, "latin"), (0xFF65, "kana"), (0xFFA0, "hangul"), (0xFFE0, "other"),
    (0x20000, "han"), (0x323B0, "other"),
]
SCRIPT_NAMES = sorted({name for _, name in SCRIPTS})
_FIRSTS = np.array([first for first, _ in SCRIPTS])
_NUMBERS = np.array([SCRIPT_NAMES.index(name) for _, name in SCRIPTS])


def script_of(points: np.ndarray) -> np.ndarray:
    return _NUMBERS[np.searchsorted(_FIRSTS, points, "right") - 1]


@lru_cache(maxsize=1)
def lowered() -> np.ndarray:
    return np.array([ord(x) if len(x := chr(c).lower()) == 1 else c for c in range(0x110000)], np.uint32)


def words_of(docs: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and lengths of the runs of letters, and each document's first (one entry more)."""
    letter = np.zeros(len(docs.points) + 1, bool)
    if len(docs.points):
        letter[:-1] = texts.classes()[docs.points] == texts.LETTER
    edge = np.zeros(len(letter), bool)
    edge[docs.starts] = True
    before = np.concatenate([[False], letter[:-1]])
    starts = np.flatnonzero(letter & (~before | edge))
    ends = np.flatnonzero(before & (~letter | edge))
    return starts, ends - starts, np.searchsorted(starts, docs.starts)


def word_grams(points: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of lowered words lying on end, framed by spaces, and the word of each."""
    framed = np.full(len(points) + 2 * len(lens), 32, np.uint32)
    ends = np.cumsum(lens + 2)
    starts = ends - lens - 2
    framed[texts.expand(starts + 1, lens)] = points
    word = np.repeat(np.arange(len(lens)), lens + 2)
    mixed = framed * np.uint32(0x85EBCA6B)
    mixed ^= mixed >> np.uint32(15)
    hashes, found, owners = np.zeros(len(framed), np.uint32), [], []
    for n in range(1, max(ORDERS) + 1):
        usable = max(0, len(framed) - n + 1)
        hashes = (hashes[:usable] * np.uint32(0x01000193)) ^ mixed[n - 1:n - 1 + usable]
        inside = np.arange(usable) + n <= ends[word[:usable]]
        if n in ORDERS:
            found.append(((hashes * np.uint32(0x9E3779B1) + np.uint32(n)) * np.uint32(0xC2B2AE35)
                          >> np.uint32(32 - BITS))[inside])
            owners.append(word[:usable][inside])
    return np.concatenate(found), np.concatenate(owners)


class Model:
    """Log-likelihoods of the n-grams, and which scripts a language uses."""

    def __init__(self, langs: list[str], table: np.ndarray, uses: np.ndarray, switch: float = SWITCH):
        self.langs, self.table, self.uses, self.switch = langs, table, uses, switch

    def cache(self) -> WordCache:
        return WordCache(self.word_scores, np.float32, most=1 << 18)

    def word_scores(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """For each word the log-likelihood of each language, above that of the best one (0)."""
        docs = texts.of_strings(words)
        lens = np.diff(docs.starts)
        grams, owner = word_grams(docs.points, lens)
        total = np.stack([np.bincount(owner, row[grams], minlength=len(words)) for row in self.table], axis=1)
        scripts = script_of(docs.points)
        first = scripts[docs.starts[:-1]]  # the script of a word's first letter decides
        fits = self.uses[:, first].T
        total = np.where(fits | ~fits.any(axis=1, keepdims=True), total, total - OUT)
        total -= total.max(axis=1, keepdims=True)
        return total.astype(np.float32).ravel(), np.full(len(words), len(self.langs), np.int32)

    def label(self, docs: Texts, cache: WordCache) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Starts, lengths and each document's first word, and the words' languages."""
        starts, lens, first = words_of(docs)
        points = lowered()[docs.points] if len(docs.points) else docs.points
        numbers = cache.numbers(points, starts, lens)
        scores = cache.values.reshape(-1, len(self.langs))[cache.starts[numbers] // len(self.langs)]
        return starts, lens, first, best_path(scores, first, self.switch)


def best_path(scores: np.ndarray, first: np.ndarray, switch: float) -> np.ndarray:
    """The Viterbi path of each document's rows of scores; all documents take a step at once.

    Staying is free, a switch costs ``switch``; ties go to staying, then to the first language.
    """
    counts = np.diff(first)
    order = np.argsort(-counts, kind="stable")
    counts, begin = counts[order], first[:-1][order]
    labels = np.zeros(len(scores), np.int16)
    if not len(scores):
        return labels
    longest = int(counts[0])
    active = np.searchsorted(-counts, -np.arange(longest), "left")  # documents with more words than that
    came = np.empty((len(scores), scores.shape[1]), np.int16)  # where each language came from, per word
    own = np.arange(scores.shape[1], dtype=np.int16)
    value = scores[begin[:active[0]]].astype(np.float64)
    final = np.empty(len(counts), np.int16)
    for step in range(1, longest):
        n = active[step]
        if n < len(value):
            final[n:len(value)] = value[n:].argmax(axis=1)
            value = value[:n]
        best = value.argmax(axis=1)
        switched = value[np.arange(n), best] - switch
        stay = value >= switched[:, None]
        rows = begin[:n] + step
        came[rows] = np.where(stay, own, best[:, None])
        value = np.where(stay, value, switched[:, None]) + scores[rows]
        if step % 64 == 0:
            value -= value.max(axis=1, keepdims=True)
    final[:len(value)] = value.argmax(axis=1)
    now = final.astype(np.int64)
    for step in range(longest - 1, -1, -1):
        n = active[step]
        rows = begin[:n] + step
        labels[rows] = now[:n]
        if step:
            now[:n] = came[rows, now[:n]]
    return labels


def train(sample: DataFrame, langs: list[str]) -> Model:
    """From ``text`` and ``y`` of a sample of bounded size; counting runs on the executors."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = np.zeros((len(langs), 1 << BITS), np.int64)
        scripts = np.zeros((len(langs), len(SCRIPT_NAMES)), np.int64)
        for piece in pieces(batches, "text"):
            docs = texts.of_arrow(piece.column("text"))
            starts, lens, first = words_of(docs)
            points = lowered()[docs.points[texts.expand(starts, lens)]]
            y = np.repeat(piece.column("y").to_numpy(), np.diff(first))
            found, owner = word_grams(points, lens)
            used = script_of(points)
            letter = np.repeat(y, lens)
            for i in range(len(langs)):
                grams[i] += np.bincount(found[y[owner] == i], minlength=1 << BITS)
                scripts[i] += np.bincount(used[letter == i], minlength=len(SCRIPT_NAMES))
        for kind, table in (("gram", grams), ("script", scripts)):
            lang, slot = np.nonzero(table)
            yield pa.RecordBatch.from_arrays([
                pa.array([kind] * len(lang), pa.string()), pa.array(lang, pa.int32()), pa.array(slot, pa.int32()),
                pa.array(table[lang, slot])], ["kind", "lang", "slot", "n"])

    found = sample.mapInArrow(count, "kind string, lang int, slot int, n bigint").groupBy(
        "kind", "lang", "slot").agg(F.sum("n").alias("n")).toPandas()
    grams = np.zeros((len(langs), 1 << BITS))
    scripts = np.zeros((len(langs), len(SCRIPT_NAMES)))
    for kind, table in (("gram", grams), ("script", scripts)):
        own = found[found["kind"] == kind]
        table[own["lang"], own["slot"]] = own["n"]
    smooth = grams + 0.5
    table = np.log(smooth / smooth.sum(axis=1, keepdims=True)).astype(np.float32)
    return Model(langs, table, scripts >= 0.01 * np.maximum(1, scripts.sum(axis=1, keepdims=True)))


def fit(docs: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text",
        lang_col: str = "lang") -> Model:
    """Learn the values of ``lang`` from about ``sample`` documents of each outside the held-out fold."""
    return train(*language_sample(docs, sample, id_col, text_col, lang_col))


def label_spans(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``spans`` (array of start, end in characters, lang): the text in stretches of one language.

    The stretches go from the first letter of one to its last; texts that are null or without letters
    have an empty array. Repeated rows are labelled one by one, other columns ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        cache = own.cache()
        names = pa.array([*own.langs, UNKNOWN])
        for piece in pieces(batches, text_col):
            found = texts.of_arrow(piece.column(text_col))
            starts, lens, first, lang = _labels(own, cache, found)
            doc = np.repeat(np.arange(len(found)), np.diff(first))
            new = np.ones(len(starts), bool)
            new[1:] = (lang[1:] != lang[:-1]) | (doc[1:] != doc[:-1])
            begin = np.flatnonzero(new)
            last = np.append(begin[1:], len(starts)) - 1 if len(begin) else begin
            base = found.starts[doc[begin]]
            spans = pa.StructArray.from_arrays(
                [pa.array(starts[begin] - base, pa.int64()), pa.array(starts[last] + lens[last] - base, pa.int64()),
                 names.take(pa.array(lang[begin], pa.int32()))], ["start", "end", "lang"])
            edges = np.searchsorted(begin, first).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [piece.column(id_col), pa.ListArray.from_arrays(pa.array(edges), spans)], ["doc_id", "spans"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(
        label, f"doc_id {kind}, spans array<struct<start: bigint, end: bigint, lang: string>>")


def _labels(model: Model, cache: WordCache, docs: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    if model.langs:
        return model.label(docs, cache)
    starts, lens, first = words_of(docs)
    return starts, lens, first, np.zeros(len(starts), np.int16)  # nothing learned: everything is unknown


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred``, ``score``: the language of most letters and its share.

    ``und`` with score 0 for texts that are null or without a letter (and for all, if no language was
    learned). Repeated rows are labelled one by one, other columns ignored; a null id is held out.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        cache, k = own.cache(), max(1, len(own.langs))
        names = pa.array([*own.langs, UNKNOWN])
        for piece in pieces(batches, "text"):
            found = texts.of_arrow(piece.column("text"))
            _, lens, first, lang = _labels(own, cache, found)
            doc = np.repeat(np.arange(len(found)), np.diff(first))
            letters = np.bincount(doc * k + lang, lens, minlength=len(found) * k).reshape(-1, k)
            total = letters.sum(axis=1)
            best = np.where((total > 0) & bool(own.langs), letters.argmax(axis=1), len(own.langs))
            score = np.where(best < len(own.langs), letters.max(axis=1) / np.maximum(total, 1), 0.0)
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), piece.column("held_out"), names.take(pa.array(best, pa.int32())),
                 pa.array(score, pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(
        F.col(id_col).alias("doc_id"), (fold(id_col) == 0).alias("held_out"), F.col(text_col).alias("text"),
    ).mapInArrow(predict, f"doc_id {kind}, held_out boolean, lang_pred string, score double")
