"""The road network: nearest node, usable roads, shortest routes, trips snapped to roads."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from wayfare.operators.components import components
from wayfare.operators.distances import route_lengths
from wayfare.operators.trips import nonempty, parse_polyline, trip_ends
from wayfare.session import release, settle

# Classes of road that trips do not use.
EXCLUDED = ["motorway", "motorway_link", "trunk", "trunk_link"]

# A degree of longitude against one of latitude, at the city's latitude.
LON_SCALE = math.cos(math.radians(33.55))
# Wanted number of nodes in a grid cell, and the number of grid sizes tried to get there.
CELL_NODES = 8
_SIZES = 24
# Roads that a step of the search for paths goes on.
STRIDE = 4


def filter_edges(edges: DataFrame, excluded: list[str] = EXCLUDED) -> DataFrame:
    """Roads that are tagged, not areas, and not of an excluded class."""
    usable = F.col("highway").isNotNull() & ~F.col("highway").isin(*excluded)
    return edges.filter(usable & (F.coalesce("area", F.lit("no")) != "yes"))


def _square(x1: Column, y1: Column, x2: Column, y2: Column, lon_scale: float) -> Column:
    dx, dy = (x1 - x2) * lon_scale, y1 - y2
    return dx * dx + dy * dy


def _pyramid(nodes: DataFrame, lon_scale: float) -> tuple[float, int, float, float]:
    """Cell size at which no cell holds many nodes, number of doublings up to one cell, origin.

    One pass counts the nodes per cell at all sizes; nodes at one place count once.
    """
    box = nodes.agg(
        F.min(F.col("x") * lon_scale), F.min("y"), F.max(F.col("x") * lon_scale), F.max("y")).first()
    if box[0] is None:
        return 1.0, 0, 0.0, 0.0
    extent = max(box[2] - box[0], box[3] - box[1], 1e-6) * 1.000001
    places = nodes.select("x", "y").distinct()
    level = F.explode(F.sequence(F.lit(0), F.lit(_SIZES - 1))).alias("level")
    size = F.lit(extent) / F.pow(F.lit(2.0), "level")
    per_cell = places.select("x", "y", level).groupBy(
        "level", F.floor((F.col("x") * lon_scale - box[0]) / size).alias("i"),
        F.floor((F.col("y") - box[1]) / size).alias("j")).agg(F.count("*").alias("n"))
    fits = per_cell.groupBy("level").agg(F.max("n").alias("most")).filter(
        F.col("most") <= CELL_NODES).agg(F.min("level")).first()[0]
    levels = _SIZES - 1 if fits is None else fits
    return extent / 2 ** levels, levels, box[0], box[1]


def _bounds(lon_scale: float) -> list[Column]:
    """Squared distances between which the nearest node of a box lies, for all points of another box.

    The nodes' box is drawn tight, so each of its four sides touches a node: the node on the nearer side
    is at most as far as that side's farther end.
    """
    def axis(first: str, last: str, low: str, high: str, scale: float) -> tuple[Column, Column, Column]:
        to_low, to_high = (F.greatest(F.abs(F.col(first) - F.col(side)), F.abs(F.col(last) - F.col(side)))
                           for side in (low, high))
        outside = F.greatest(F.col(low) - F.col(last), F.col(first) - F.col(high), F.lit(0.0))
        return tuple(d * scale * d * scale for d in (
            outside, F.least(to_low, to_high), F.greatest(to_low, to_high)))

    out_x, near_x, far_x = axis("lon_min", "lon_max", "x_min", "x_max", lon_scale)
    out_y, near_y, far_y = axis("lat_min", "lat_max", "y_min", "y_max", 1.0)
    return [(out_x + out_y).alias("least"),
            F.least(near_x + far_y, near_y + far_x).alias("most")]


def nearest_node(
    points: DataFrame, nodes: DataFrame, lon_scale: float = LON_SCALE,
) -> DataFrame:
    """Add ``node_id``, the nearest node to (lon, lat); the smaller id where two are as near.

    The nodes lie in a grid of which no cell holds more than a few places. Points are taken together by cells
    half as wide, and only these cells, not their points, go down a pyramid of the grid's cells: at
    each step those survive that can still hold the nearest node of some point of the cell. What is left
    is one row of nodes for each cell, and each point meets that row.
    """
    size, levels, x0, y0 = _pyramid(nodes, lon_scale)

    def cell(value: Column, scale: float, origin: float, width: float) -> Column:
        return F.floor((value * scale - origin) / width)

    places = nodes.groupBy("x", "y").agg(F.min("node_id").alias("node_id"))
    leaves = settle(places.groupBy(
        cell(F.col("x"), lon_scale, x0, size).alias("i"), cell(F.col("y"), 1.0, y0, size).alias("j")).agg(
        F.collect_list(F.struct("x", "y", "node_id")).alias("held"),
        F.min("x").alias("x_min"), F.max("x").alias("x_max"),
        F.min("y").alias("y_min"), F.max("y").alias("y_max")), "leaves")

    def boxes(level: int) -> DataFrame:
        up = 1 << level
        return leaves.groupBy(
            F.floor(F.col("i") / up).alias("i"), F.floor(F.col("j") / up).alias("j")).agg(
            F.min("x_min").alias("x_min"), F.max("x_max").alias("x_max"),
            F.min("y_min").alias("y_min"), F.max("y_max").alias("y_max"))

    known = F.col("lon").isNotNull() & F.col("lat").isNotNull() & ~F.isnan("lon") & ~F.isnan("lat")
    asked = points.withColumn("_cell", F.when(known, F.struct(
        cell(F.col("lon"), lon_scale, x0, size / 2).alias("i"), cell(F.col("lat"), 1.0, y0, size / 2).alias("j"))))
    area = ["_cell", "lon_min", "lon_max", "lat_min", "lat_max"]
    front = settle(asked.filter(known).groupBy("_cell").agg(
        F.min("lon").alias("lon_min"), F.max("lon").alias("lon_max"),
        F.min("lat").alias("lat_min"), F.max("lat").alias("lat_max")).select(
        *area, F.lit(0).cast("bigint").alias("i"), F.lit(0).cast("bigint").alias("j")), "front")
    # The top of the pyramid is one cell; two levels down per step, at most 16 cells each.
    level = levels
    while level > 0:
        down = min(2, level)
        level -= down
        fan = 1 << down
        child = F.explode(F.array(*[
            F.struct((F.col("i") * fan + a).alias("i"), (F.col("j") * fan + b).alias("j"))
            for a in range(fan) for b in range(fan)])).alias("c")
        opened = front.select(*area, child).select(*area, "c.i", "c.j").join(boxes(level), ["i", "j"])
        bounded = opened.select(*area, "i", "j", *_bounds(lon_scale))
        limit = bounded.groupBy("_cell").agg(F.min("most").alias("limit"))
        # a hair above the bound, so that rounding never loses a cell
        front, old = settle(bounded.join(limit, "_cell").filter(
            F.col("least") <= F.col("limit") * (1 + 1e-12)).select(*area, "i", "j"), "front"), front
        release(old)
    held = settle(front.join(leaves, ["i", "j"]).groupBy("_cell").agg(
        F.flatten(F.collect_list("held")).alias("_held")), "held")
    nearest = F.array_min(F.transform("_held", lambda n: F.struct(
        _square(F.col("lon"), F.col("lat"), n.x, n.y, lon_scale).alias("d"),
        n.node_id.alias("node_id")))).getField("node_id")
    return asked.join(held, "_cell", "left").select(*points.columns, nearest.alias("node_id"))


def _way(length: Column, path: Column) -> Column:
    """A way in its order of preference: shorter, then fewer nodes, then first in node order."""
    return F.struct(length.alias("length"), F.size(path).alias("hops"), path.alias("path"))


def connected(pairs: DataFrame, edges: DataFrame) -> DataFrame:
    """The pairs whose ends lie in one connected part of the network, or are one node."""
    part = components(edges.select(F.col("src").alias("a"), F.col("dst").alias("b")))

    def at(column: str) -> DataFrame:
        return part.select(F.col("node").alias(column), F.col("root").alias(f"_{column}"))

    placed = pairs.join(at("origin"), "origin", "left").join(at("destination"), "destination", "left")
    return placed.filter(F.coalesce("_origin", "origin") == F.coalesce("_destination", "destination")).select(
        "origin", "destination")


def routes(pairs: DataFrame, edges: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """Shortest route by length for distinct (origin, destination) node pairs.

    ``path`` lists the nodes; pairs without a route are absent. Their lengths are found first
    (``distances.route_lengths``, which may use the places of ``nodes``). Then all origins spread together,
    ``STRIDE`` roads a step, and none beyond its farthest wanted node, however large the network is: only nodes
    that got nearer spread on. Each step is written to the shared folder, so a lost executor
    costs one step, and the table before it is deleted.
    """
    edges = settle(edges.select("src", "dst", "length"), "roads")
    pairs = settle(route_lengths(pairs, edges, nodes), "pairs")
    # a hair above, as lengths may have been summed up in another order
    limit = settle(pairs.groupBy("origin").agg((F.max("length") * (1 + 1e-9)).alias("limit")), "limit")
    roads = edges.filter(F.col("src") != F.col("dst"))
    ends = roads.select("src").union(roads.select("dst")).distinct()
    stay = ends.select("src", F.col("src").alias("dst"), _way(
        F.lit(0.0), F.slice(F.array("src"), 1, 0)).alias("way"))
    ways = settle(roads.groupBy("src", "dst").agg(
        F.min(_way(F.col("length"), F.array("dst"))).alias("way")).unionByName(stay), "ways")
    best = limit.select("origin", F.col("origin").alias("node"), _way(F.lit(0.0), F.array("origin")).alias("best"))
    front, merged = best, None
    while True:
        reached = front
        for _ in range(STRIDE):
            reached = reached.join(ways, F.col("node") == F.col("src")).join(limit, "origin").filter(
                F.col("best.length") + F.col("way.length") <= F.col("limit")).groupBy(
                "origin", F.col("dst").alias("node")).agg(F.min(_way(
                    F.col("best.length") + F.col("way.length"),
                    F.concat("best.path", "way.path"))).alias("best"))
        old = best.withColumnRenamed("best", "old")
        better = F.col("best").isNotNull() & (F.col("old").isNull() | (F.col("best") < F.col("old")))
        # Each node keeps its better way; "fresh" marks those that changed in this step.
        merged, before = settle(old.join(reached, ["origin", "node"], "full").select(
            "origin", "node", F.when(better, F.col("best")).otherwise(F.col("old")).alias("best"),
            better.alias("fresh"))), merged
        best, front = merged.drop("fresh"), merged.filter("fresh").drop("fresh")
        if before is not None:
            release(before)
        if front.isEmpty():
            break
    return pairs.select("origin", "destination").join(
        best.withColumnRenamed("node", "destination"), ["origin", "destination"]).select(
        "origin", "destination", F.col("best.length").alias("length"), F.col("best.path").alias("path"))


def route_lines(found: DataFrame, nodes: DataFrame) -> DataFrame:
    """Routes as polylines [[x, y], ...], the nodes' positions in order."""
    steps = found.select("origin", "destination", F.posexplode("path").alias("at", "node_id"))
    placed = steps.join(nodes.select("node_id", "x", "y"), "node_id")
    # One list per route, no longer than the route.
    ordered = F.array_sort(F.collect_list(F.struct("at", F.array("x", "y").alias("p"))))
    return placed.groupBy("origin", "destination").agg(
        F.transform(ordered, lambda step: step.p).alias("line"))


def snap_trips(
    trips: DataFrame, nodes: DataFrame, edges: DataFrame, key: str = "TRIP_ID",
    polyline: str = "CASA_POLYLINE",
) -> DataFrame:
    """Replace each trip's polyline by the road route between its ends.

    Trips with fewer than two vertices, without a route, or whose route is empty are dropped. A
    route is searched once for all trips that share its ends.
    """
    parsed = nonempty(parse_polyline(trips, polyline)).filter(F.size("coords") >= 2)
    ended = settle(trip_ends(parsed).drop("coords", polyline), "ends")

    def end(which: str) -> DataFrame:
        return ended.select(F.col(key).alias("key"), F.lit(which).alias("which"),
                            F.col(f"{which}_lon").alias("lon"), F.col(f"{which}_lat").alias("lat"))

    both = end("pickup").unionByName(end("dropoff")).withColumn(
        "point_id", F.struct("key", "which"))
    at = nearest_node(both.select("point_id", "lon", "lat"), nodes).select(
        F.col("point_id.key").alias(key), F.col("point_id.which").alias("which"), "node_id")
    pairs = settle(at.groupBy(key).agg(
        F.max(F.when(F.col("which") == "pickup", F.col("node_id"))).alias("origin"),
        F.max(F.when(F.col("which") == "dropoff", F.col("node_id"))).alias("destination")))
    lines = route_lines(routes(pairs, edges, nodes), nodes)
    return ended.drop("pickup_lon", "pickup_lat", "dropoff_lon", "dropoff_lat").join(
        pairs, key).join(lines, ["origin", "destination"]).withColumn(
        polyline, F.to_json("line")).drop("origin", "destination", "line")
