"""Bounded samples of labelled documents to learn from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.session import settle

FOLDS = 5


def fold(id_col: str) -> Column:
    """crc32 of the id as text, modulo ``FOLDS``; fold 0 is held out. A null id is in fold 0."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(FOLDS)), F.lit(0))


def _drawn(rows: DataFrame, n: int, most: int) -> DataFrame:
    """About ``most`` of n rows, by a hash of the id."""
    if n <= most:
        return rows
    return rows.where(F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1 << 30)) < F.lit(int(most / n * (1 << 30))))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, most: int, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """``text`` and ``y`` (0 or 1) of about ``most`` labelled documents outside the held-out fold.

    Null labels and ids are left out; of several labels of one document the largest counts. The sample
    has a bounded size, so it is sent to all tasks and met there by the documents, and written once.
    """
    known = (labels.where(F.col(label).isNotNull() & F.col(id_col).isNotNull() & (fold(id_col) != 0))
             .groupBy(F.col(id_col).alias("doc_id")).agg(F.max(label).cast("int").alias("y")))
    drawn = _drawn(known, known.count(), most)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return settle(texts.join(F.broadcast(drawn), "doc_id").select("text", "y"), "sample").repartition(16)


def language_sample(docs: DataFrame, most: int, id_col: str = "doc_id", text_col: str = "text",
                    lang_col: str = "lang") -> tuple[DataFrame, list[str]]:
    """``text`` and ``y`` (number of the language) of about ``most`` documents of each language outside
    the held-out fold, and the languages."""
    rows = docs.where(F.col(lang_col).isNotNull() & (fold(id_col) != 0)).select(
        F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    langs = sorted(counts)
    if not langs:
        return rows.select("text", F.lit(0).alias("y")), []
    limit = F.create_map(*[x for lang in langs for x in (
        F.lit(lang), F.lit(int(min(1.0, most / counts[lang]) * (1 << 30))))])
    number = F.create_map(*[x for i, lang in enumerate(langs) for x in (F.lit(lang), F.lit(i))])
    draw = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1 << 30))
    return settle(rows.where(draw < limit[F.col("lang")]).select("text", number[F.col("lang")].alias("y")),
                  "sample").repartition(16), langs
