"""Connected components of links between fingerprints, by contraction."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.session import release, settle

IN_ONE_TASK = 1 << 18  # at most so many links (of 16 bytes) are joined up by a single task


def joined_up(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of these links and the smallest node that each of them reaches."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    one, other = at[:len(a)], at[len(a):]
    root = np.arange(len(nodes))
    while (root[one] != root[other]).any():
        least = np.minimum(root[one], root[other])
        np.minimum.at(root, root[one], least)
        np.minimum.at(root, root[other], least)
        while (root[root] != root).any():
            root = root[root]
    return nodes, nodes[root]


def _in_one_task(links: DataFrame) -> DataFrame:
    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(batch.column("a").to_numpy(), batch.column("b").to_numpy()) for batch in batches]
        if held:
            nodes, roots = joined_up(*(np.concatenate(ends) for ends in zip(*held)))
            for i in range(0, len(nodes), 1 << 16):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(nodes[i:i + (1 << 16)]), pa.array(roots[i:i + (1 << 16)])], ["node", "root"])

    return links.repartition(1).mapInArrow(join, "node bigint, root bigint")


def _distinct_links(links: DataFrame, a: str, b: str) -> DataFrame:
    return links.where(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct()


def components(links: DataFrame, in_one_task: int = IN_ONE_TASK) -> DataFrame:
    """``node``, ``root``: each linked node but the roots, and the smallest node that it reaches.

    ``links`` has the bigint columns ``a`` and ``b``; direction, repeats and loops don't matter, and neither do
    links with a null end. While there are more than ``in_one_task`` links, every node is merged into the one
    with the least hash among itself and its neighbours, and links are drawn between what is left.
    Hashes make that a constant share of the nodes, whatever order the ids have. A node's choice is a
    minimum, taken before the shuffle, so a node with very many links is no burden. The few links
    left at the end are joined up by one task, then the merges are followed back.
    """
    left = settle(_distinct_links(links, "a", "b"), "links")
    merged = []
    while left.count() > in_one_task:
        both = left.select("a", "b").union(left.select("b", "a"))
        choice = both.groupBy("a").agg(F.min(F.struct(F.xxhash64("b"), F.col("b").alias("node"))).alias("near"))
        own = F.struct(F.xxhash64("a"), F.col("a").alias("node"))
        into = settle(choice.select(F.col("a").alias("node"), F.least("near", own)["node"].alias("into")), "merged")
        merged.append(into)

        def named(end: str) -> DataFrame:
            return into.select(F.col("node").alias(end), F.col("into").alias(f"{end}_into"))

        left, old = settle(_distinct_links(
            left.join(named("a"), "a").join(named("b"), "b"), "a_into", "b_into"), "links"), left
        release(old)
    roots = settle(_in_one_task(left), "roots")
    release(left)
    for into in reversed(merged):
        further = roots.select(F.col("node").alias("into"), "root")
        roots, old = settle(into.join(further, "into", "left").select(
            "node", F.coalesce("root", "into").alias("root")), "roots"), roots
        release(old, into)
    if merged:  # the root is the node of least hash so far
        least = roots.groupBy("root").agg(F.min("node").alias("least"))
        roots = roots.join(least, "root").select("node", F.col("least").alias("root"))
    return roots.where("node <> root")
