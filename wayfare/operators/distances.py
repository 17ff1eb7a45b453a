"""Lengths of shortest routes over a network of any extent, by cells within cells.

The network is cut into cells of few nodes. Ways inside a cell are worked out in one task and leave only
the cell's border, the nodes that roads to other cells touch, and the shortest ways between them.
What is left is cut into wider cells, and so on, so the number of steps grows with the logarithm
of the network's extent. Origins go up with the borders, lengths come down into the cells that hold
wanted nodes. Where cells don't save nodes any more, the rest is searched road by road.
"""

from __future__ import annotations

from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from wayfare.session import release, settle, ship

CELL = 512       # most nodes of a cell
ORIGINS = 1024   # origins that one group of a cell is asked for, about
_SIDE, _SPREAD = 20, 10           # bits of a place for each axis, and bits that part nodes of one place
_BITS = 2 * _SIDE + _SPREAD
_GROUP = "cell long, part long, kind int, a long, b long, length double, a_key long, b_key long"
_FOUND = "kind int, source long, node long, key long, length double"
ROAD, TARGET, BORDER, ORIGIN = range(4)


def _keyed(ends: DataFrame, nodes: DataFrame | None) -> DataFrame:
    """``node``, ``key``: nodes that are near each other share the upper bits of their keys.

    Keys follow the places of ``nodes`` in Z-order. Nodes without a place are put in order by id.
    """
    spread = F.pmod(F.xxhash64("node"), F.lit(1 << _SPREAD))

    def scaled(value: Column, low: Any, extent: Any, bits: int) -> Column:
        return F.least(F.floor((value - low) / extent * (1 << bits)), F.lit((1 << bits) - 1)).cast("bigint")

    if nodes is None:
        low, high = ends.agg(F.min("node"), F.max("node")).first()
        at = scaled(F.col("node"), low, (high or 0) - (low or 0) + 1, 2 * _SIDE)
        return ends.select("node", (F.shiftleft(at, _SPREAD) + spread).alias("key"))
    x0, y0, x1, y1 = nodes.agg(F.min("x"), F.min("y"), F.max("x"), F.max("y")).first()
    extent = max(x1 - x0, y1 - y0, 1e-9) if x0 is not None else 1.0
    x, y = scaled(F.col("x"), x0 or 0.0, extent, _SIDE), scaled(F.col("y"), y0 or 0.0, extent, _SIDE)
    at = sum((F.shiftleft(F.shiftright(v, b).bitwiseAND(F.lit(1)), 2 * b + n)
              for b in range(_SIDE) for n, v in ((0, x), (1, y))), F.lit(0).cast("bigint"))
    placed = nodes.groupBy(F.col("node_id").alias("node")).agg(F.min("x").alias("x"), F.min("y").alias("y"))
    return ends.join(placed, "node", "left").select(
        "node", (F.shiftleft(F.coalesce(at, F.pmod("node", F.lit(1 << 2 * _SIDE))), _SPREAD) + spread).alias("key"))


def _cell(key: str, shift: int) -> Column:
    return F.shiftright(key, shift)


def _widest(nodes: DataFrame) -> tuple[int, int]:
    """The number of nodes, and how many lower bits of the keys cells of at most ``CELL`` nodes can span."""
    shifts = list(range(0, _BITS + 1, 2))
    per_cell = nodes.select("key", F.explode(F.array(*map(F.lit, shifts))).alias("shift")).groupBy(
        "shift", F.expr("shiftright(key, shift)").alias("cell")).agg(F.count("*").alias("n"))
    sizes = {r["shift"]: (r["most"], r["n"]) for r in per_cell.groupBy("shift").agg(
        F.max("n").alias("most"), F.sum("n").alias("n")).collect()}
    if not sizes:
        return 0, 0
    return sizes[0][1], max((s for s in shifts if sizes[s][0] <= CELL), default=0)


def _inside(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """Shortest lengths inside one cell from each source to the targets (all nodes, if none is marked)."""
    road, seed = (rows["kind"] == ROAD).to_numpy(), (rows["kind"] >= BORDER).to_numpy()
    a, b, length = rows["a"].to_numpy(), rows["b"].to_numpy(), rows["length"].to_numpy()
    a_key, b_key = rows["a_key"].to_numpy(), rows["b_key"].to_numpy()
    nodes, first = np.unique(np.concatenate([a[road], b]), return_index=True)
    keys = np.concatenate([a_key[road], b_key])[first]
    between = np.full((len(nodes), len(nodes)), np.inf)
    np.fill_diagonal(between, 0.0)
    np.minimum.at(between, (np.searchsorted(nodes, a[road]), np.searchsorted(nodes, b[road])), length[road])
    for k in range(len(nodes)):
        np.minimum(between, between[:, k, None] + between[k], out=between)
    named = np.unique(np.stack([rows["kind"].to_numpy()[seed].astype(np.int64), a[seed]]), axis=1, return_inverse=True)
    sources, own = named[0], named[1].ravel()
    at = np.searchsorted(nodes, b[seed])
    begun = np.full((sources.shape[1], len(nodes)), np.inf)
    np.minimum.at(begun, (own, at), length[seed])
    reached = begun.copy()
    for k in np.unique(at):
        np.minimum(reached, begun[:, k, None] + between[k], out=reached)
    marked = np.searchsorted(nodes, np.unique(b[(rows["kind"] == TARGET).to_numpy()]))
    if len(marked):
        unmarked = np.ones(len(nodes), bool)
        unmarked[marked] = False
        reached[:, unmarked] = np.inf
    i, j = np.nonzero(np.isfinite(reached))
    return pd.DataFrame({"kind": sources[0][i].astype(np.int32), "source": sources[1][i], "node": nodes[j],
                         "key": keys[j], "length": reached[i, j]})


def _solved(graph: DataFrame, seeds: DataFrame, targets: DataFrame | None, shift: int, parts: int) -> DataFrame:
    """Lengths inside the cells, for ``seeds`` (``kind``, ``source``, ``node``, ``key``, ``length``); a cell's origins are
    dealt to several groups where they are many."""
    part = F.when(F.col("kind") == BORDER, F.lit(0)).otherwise(F.pmod(F.xxhash64("source"), F.lit(parts)))
    asked = seeds.select(_cell("key", shift).alias("cell"), part.cast("bigint").alias("part"), "kind",
                         F.col("source").alias("a"), F.col("node").alias("b"), "length",
                         F.lit(0).cast("bigint").alias("a_key"), F.col("key").alias("b_key"))
    groups = asked.select("cell", "part").distinct()
    rows = asked.unionByName(graph.filter(_cell("src_key", shift) == _cell("dst_key", shift)).select(
        _cell("src_key", shift).alias("cell"), F.lit(ROAD).alias("kind"), F.col("src").alias("a"),
        F.col("dst").alias("b"), "length", F.col("src_key").alias("a_key"), F.col("dst_key").alias("b_key")).join(
        groups, "cell"))
    if targets is not None:
        rows = rows.unionByName(targets.select(
            _cell("key", shift).alias("cell"), F.lit(TARGET).alias("kind"), F.col("node").alias("a"),
            F.col("node").alias("b"), F.lit(0.0).alias("length"), F.col("key").alias("a_key"),
            F.col("key").alias("b_key")).join(groups, "cell"))
    return settle(rows.groupBy("cell", "part").applyInPandas(_inside, _FOUND), "inside")


def _spread(front: DataFrame, graph: DataFrame) -> DataFrame:
    """The lengths from all sources over the whole graph, road by road."""
    onward = graph.select(F.col("src").alias("node"), "dst", F.col("length").alias("more"), F.col("dst_key"))
    best = settle(front.groupBy("kind", "source", "node", "key").agg(F.min("length").alias("length")), "reached")
    fresh, before = best, None
    while not fresh.isEmpty():
        step = fresh.join(onward, "node").groupBy(
            "kind", "source", F.col("dst").alias("node"), F.col("dst_key").alias("key")).agg(
            F.min(F.col("length") + F.col("more")).alias("new"))
        merged = settle(best.select("kind", "source", "node", "key", "length").join(
            step, ["kind", "source", "node", "key"], "full").select(
            "kind", "source", "node", "key", F.least("length", "new").alias("length"),
            (F.col("length").isNull() | F.coalesce(F.col("new") < F.col("length"), F.lit(False))).alias("fresh")),
            "reached")
        best, before = merged, best
        fresh = merged.filter("fresh").drop("fresh")
        release(before)
    return best.select("kind", "source", "node", "key", "length")


def route_lengths(pairs: DataFrame, edges: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """``origin``, ``destination``, ``length`` of the shortest route of distinct node pairs that have one.

    ``edges`` has ``src``, ``dst``, ``length`` (not negative); ``nodes`` (``node_id``, ``x``, ``y``), if given, tells where
    nodes lie, which only makes the cells better. Each step is written to the shared folder.
    """
    ship(pairs.sparkSession)
    roads = settle(edges.filter(F.col("src") != F.col("dst")).groupBy("src", "dst").agg(
        F.min("length").alias("length")).dropna(), "roads")
    keys = settle(_keyed(roads.select(F.col("src").alias("node")).union(roads.select("dst")).distinct(), nodes), "keys")

    def at(column: str, key: str) -> DataFrame:
        return keys.select(F.col("node").alias(column), F.col("key").alias(key))

    graph = settle(roads.join(at("src", "src_key"), "src").join(at("dst", "dst_key"), "dst"), "graph")
    pairs = settle(pairs.select("origin", "destination").dropna().distinct(), "pairs")
    wanted = settle(pairs.filter(F.col("origin") != F.col("destination")).join(
        at("destination", "key"), "destination"), "wanted")
    up = settle(wanted.select(F.col("origin").alias("node")).distinct().join(keys, "node").select(
        F.lit(ORIGIN).alias("kind"), F.col("node").alias("source"), "node", "key", F.lit(0.0).alias("length")), "up")
    parts = -(-up.count() // ORIGINS) or 1
    steps, last = [], -1
    while True:
        present = graph.select(F.col("src").alias("node"), F.col("src_key").alias("key")).union(
            graph.select("dst", "dst_key")).distinct()
        number, shift = _widest(present)
        if number == 0 or shift <= last:
            break
        crossing = graph.filter(_cell("src_key", shift) != _cell("dst_key", shift))
        border = settle(crossing.select(F.col("src").alias("node"), F.col("src_key").alias("key")).union(
            crossing.select("dst", "dst_key")).distinct(), "border")
        if 2 * border.count() > number:  # these cells hardly save any nodes
            break
        begun = border.select(F.lit(BORDER).alias("kind"), F.col("node").alias("source"), "node", "key",
                              F.lit(0.0).alias("length"))
        found = _solved(graph, begun.unionByName(up), border, shift, parts).join(
            border.select("node"), "node", "left_semi")
        steps.append((graph, up, shift))
        ways = found.filter((F.col("kind") == BORDER) & (F.col("source") != F.col("node"))).join(
            at("source", "src_key"), "source").select(
            F.col("source").alias("src"), F.col("node").alias("dst"), "length", "src_key", F.col("key").alias("dst_key"))
        graph = settle(crossing.select("src", "dst", "length", "src_key", "dst_key").unionByName(ways), "graph")
        up, last = found.filter(F.col("kind") == ORIGIN).select("kind", "source", "node", "key", "length"), shift
    reached = _spread(up, graph)
    for graph, up, shift in reversed(steps):
        cells = wanted.select(F.col("origin").alias("source"), _cell("key", shift).alias("cell")).distinct()
        seeds = reached.unionByName(up.select(*reached.columns)).withColumn("cell", _cell("key", shift)).join(
            cells, ["source", "cell"], "left_semi").drop("cell")
        reached = _solved(graph, seeds, None, shift, parts)
    stay = pairs.filter(F.col("origin") == F.col("destination")).withColumn("length", F.lit(0.0))
    return wanted.join(reached.select(F.col("source").alias("origin"), F.col("node").alias("destination"), "length"),
                       ["origin", "destination"]).select("origin", "destination", "length").unionByName(stay)
