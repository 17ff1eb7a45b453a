"""Proportional stratified interleaving: shards of equal row counts that all hold the same mixture.

Rows are shuffled by a seeded hash inside their source; a row's fractional rank there, in [0, 1),
places it on one common line, on which every source is spread evenly. Cutting the line into equal
counts gives each shard every source in its share of the whole. DataFrame functions only.

No source has to fit one task. A source of n rows is first cut into about sqrt(n) ranges of the
hash and the line into about sqrt(N) ranges; row numbers are counted inside a range and added to
the number of rows in the ranges before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayfare.session import settle

SALTS = 64


def _unit(hash64: Column) -> Column:
    """A hash as a number in [0, 1)."""
    return F.shiftrightunsigned(hash64, 11).cast("double") / F.lit(float(1 << 53))


def _before(counts: DataFrame, order: str, *by: str) -> DataFrame:
    """``before``: the rows counted (``n``) in the ranges before each one."""
    line = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("before", F.coalesce(F.sum("n").over(line), F.lit(0))).drop("n")


def stratified_shards(docs: DataFrame, shards: int = 8, seed: int = 17, id_col: str = "doc_id",
                      text_col: str = "text", stratum_col: str = "source") -> DataFrame:
    """One row per document: its shard, and its place in it.

    Returns ``doc_id``, ``size`` (UTF-8 bytes of the text plus 1), ``text_crc32``, ``stratum``,
    ``shard`` (0 to shards - 1; counts differ by one at most), ``slot`` (gapless from 0).
    Null texts count as empty, a null stratum is a stratum of its own, repeated rows are placed one
    by one, an empty table gives no rows. Other columns of ``docs`` are ignored.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = settle(docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)).cast("bigint").alias("bytes"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.col(stratum_col).cast("string").alias("stratum"),
        F.xxhash64(F.lit(seed), F.col(id_col), text).alias("h"),
    ).withColumn("key", F.coalesce(F.concat(F.lit("="), "stratum"), F.lit(""))), "shard-rows")

    sizes = base.groupBy("key").agg(F.count("*").alias("size_of")).withColumn(
        "ranges", F.ceil(F.sqrt("size_of"))).withColumn(
        "phase", _unit(F.xxhash64(F.lit(seed), F.lit("phase"), F.col("key"))))
    # a large stratum is dealt over salts, so that the join does not bring it into one task
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    cut = (base.withColumn("salt", F.pmod("h", F.lit(SALTS)).cast("int"))
           .join(sizes.withColumn("salt", salts), ["key", "salt"]).drop("salt")
           .withColumn("range", F.floor(_unit(F.col("h")) * F.col("ranges"))))
    earlier = _before(cut.groupBy("key", "range").agg(F.count("*").alias("n")), "range", "key")
    # the phase keeps strata of a single row, or of equal sizes, from meeting on one spot
    within = Window.partitionBy("key", "range").orderBy(
        F.shiftrightunsigned("h", 11), "h", "doc_id", "text_crc32", "bytes")
    line = settle(cut.withColumn("nth", F.row_number().over(within) - 1)
                  .join(earlier, ["key", "range"])
                  .select("doc_id", "bytes", "text_crc32", "stratum", "key", "h",
                          ((F.col("before") + F.col("nth") + F.col("phase"))
                           / F.col("size_of")).alias("fraction")), "shard-line")

    total = line.count()
    ranges = max(1, int(total ** 0.5))
    line = line.withColumn("part", F.floor(F.col("fraction") * ranges))
    earlier = _before(line.groupBy("part").agg(F.count("*").alias("n")), "part")
    order = Window.partitionBy("part").orderBy("fraction", "key", "h", "doc_id", "text_crc32", "bytes")
    place = F.col("before") + F.col("nth")
    return (line.withColumn("nth", F.row_number().over(order) - 1).join(earlier, "part")
            .withColumn("place", place)
            .withColumn("shard", F.expr(f"place * {shards} div {max(1, total)}"))
            .select("doc_id", (F.col("bytes") + 1).alias("size"), "text_crc32", "stratum",
                    F.col("shard").cast("int").alias("shard"),
                    F.expr(f"place - (shard * {total} + {shards - 1}) div {shards}").alias("slot")))
