"""Connected components of a table of links, for groups of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.session import release, settle


def _mark(links: DataFrame) -> tuple:
    """Tells two sets of links apart: their number and a hash of all of them."""
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")),
                           F.bit_xor(F.xxhash64("b", "a", F.lit(1)))).first())


def components(links: DataFrame) -> DataFrame:
    """``node``, ``root``: the smallest node that each linked node reaches.

    ``links`` has the columns ``a`` and ``b``; direction, repeats and loops don't matter. Alternates
    large and small stars until every node hangs on its root, in a number of rounds that grows with
    the logarithm of the longest path. Minima are taken before the shuffle; each round is written, so
    that a lost executor doesn't undo it.
    """
    links = settle(links.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before, now = None, _mark(links)
    while before != now:
        both = links.union(links.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
        large = (both.where("b > a").join(least, "a")
                 .select(F.col("b").alias("a"), F.col("least").alias("b")).distinct())
        least = large.groupBy("a").agg(F.min("b").alias("least"))
        small = large.join(least, "a")
        links, old = settle(small.where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
                       .union(least.select("a", F.col("least").alias("b"))).distinct(), "links"), links
        before, now = now, _mark(links)
        release(old)
    return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
