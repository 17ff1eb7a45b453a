"""Documents to token ids: toxicity, quality, near-duplicates, benchmark items, BPE.

Each stage takes what the one before it kept and calls one operator of ``wayfare.llm``. Run on its own,
every stage's result is written as Parquet and read again by the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wayfare.llm import bpe, decontaminate, quality, simhash, toxicity
from wayfare.llm.queries import BYTE_BPE
from wayfare.llm.registry import ready, table
from wayfare.session import settle


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the threshold by the toxicity classifier."""
    model = toxicity.fit(docs, table(ready(spark), sf_dir, "labels"))
    return toxicity.keep_documents(docs, model, lambda scores: scores < toxicity.THRESHOLD)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model accepts."""
    model = quality.fit(docs, table(ready(spark), sf_dir, "labels"))
    return toxicity.keep_documents(docs, model, lambda scores: scores >= quality.THRESHOLD)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (shingles of five words, similarity 0.8)."""
    ready(spark)
    return simhash.one_of_each(docs, simhash.similar(docs, similarity=0.8, width=5))


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.without_contaminated(docs, table(ready(spark), sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id`` and ``ids``."""
    ready(spark)
    return bpe.encode_documents(docs, BYTE_BPE)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", keep_good),
    ("near_duplicates", drop_near_copies),
    ("benchmark", drop_benchmark),
    ("bpe", tokenize),
]

# The stages are learned models and hashes that SQL has not; the tests check them by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(ready(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
