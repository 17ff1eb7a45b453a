from __future__ import annotations

import heapq
import json
import random

import pytest

from wayfare import session
from wayfare.operators import distances, routes


@pytest.mark.parametrize("seed, shape", [(1, "even"), (2, "clustered"), (3, "line"), (4, "same")])
def test_nearest_node_equals_brute_force(spark, seed, shape):
    rng = random.Random(seed)

    def node():
        if shape == "even":
            return rng.uniform(-7.8, -7.4), rng.uniform(33.4, 33.7)
        if shape == "clustered":  # a third of the nodes in one spot, the rest far apart
            if rng.random() < 0.35:
                return -7.6 + rng.uniform(0, 1e-4), 33.55 + rng.uniform(0, 1e-4)
            return rng.uniform(-9, -6), rng.uniform(32, 35)
        if shape == "line":
            return round(rng.uniform(-7.8, -7.4), 3), 33.5
        return -7.6, 33.55

    nodes = [(i, *node()) for i in range(300)]
    points = [(i, rng.uniform(-8.5, -6.5), rng.uniform(33, 34.2)) for i in range(300)]
    points += [(1000 + i, -7.6 + rng.uniform(0, 1e-4), 33.55) for i in range(150)]
    points += [(2000, None, 33.5), (2001, -40.0, 10.0)]
    got = {r.point_id: r.node_id for r in routes.nearest_node(
        spark.createDataFrame(points, "point_id long, lon double, lat double"),
        spark.createDataFrame(nodes, "node_id long, x double, y double")).collect()}
    k = routes.LON_SCALE
    for pid, lon, lat in points:
        if lon is None:
            assert got[pid] is None
            continue
        best = min((((lon - x) * k) * ((lon - x) * k) + (lat - y) * (lat - y), i)
                   for i, x, y in nodes)
        assert got[pid] == best[1], (pid, best)


def test_points_of_a_cell_search_together(spark, monkeypatch):
    """What the search for the nearest node writes grows with the area, not with the points."""
    written = []

    def settle(df, name="step"):
        written.append((kept := session.settle(df, name)).count())
        return kept

    monkeypatch.setattr(routes, "settle", settle)
    nodes = spark.range(400).selectExpr("id AS node_id", "id % 20 / 100 AS x", "floor(id / 20) / 100 AS y")
    points = spark.range(20_000).selectExpr("id AS point_id", "id % 141 / 500 - 0.04 AS lon", "id % 97 / 500 AS lat", "id AS more")
    found = routes.nearest_node(points, nodes)
    assert found.columns == ["point_id", "lon", "lat", "more", "node_id"]
    assert found.filter("node_id IS NULL").isEmpty() and found.count() == 20_000
    assert max(written) < 10_000, written


def dijkstra(edges, origin):
    out, heap, near = {}, [(0.0, 1, [origin])], {}
    for a, b, w in edges:
        near.setdefault(a, []).append((b, w))
    while heap:
        d, n, path = heapq.heappop(heap)
        if path[-1] in out:
            continue
        out[path[-1]] = (d, path)
        for b, w in near.get(path[-1], []):
            if b not in out:
                heapq.heappush(heap, (d + w, n + 1, path + [b]))
    return out


def test_routes_are_shortest(spark):
    rng = random.Random(9)
    edges = [(rng.randrange(40), rng.randrange(40), float(rng.randint(1, 20))) for _ in range(130)]
    pairs = [(rng.randrange(5), rng.randrange(45)) for _ in range(60)]
    got = {(r.origin, r.destination): (r.length, r.path) for r in routes.routes(
        spark.createDataFrame(pairs, "origin long, destination long"),
        spark.createDataFrame(edges, "src long, dst long, length double")).collect()}
    expected = {}
    for a, b in pairs:
        found = dijkstra(edges, a).get(b)
        if found:
            expected[(a, b)] = found
    assert {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in expected.items()}
    assert got == expected


@pytest.mark.parametrize("shape", ["grid", "ids only", "random", "many origins"])
def test_lengths_by_cells_are_shortest(spark, monkeypatch, shape):
    """Cells of a few nodes, so that there are several steps of them; a network far longer than wide, one way
    roads, loops, parallel roads, parts without connection, ends off the network."""
    monkeypatch.setattr(distances, "CELL", 12)
    monkeypatch.setattr(distances, "ORIGINS", 3 if shape == "many origins" else 1024)
    rng, wide, high = random.Random(5), 4, 60
    if shape == "random":
        edges = [(rng.randrange(80), rng.randrange(80), float(rng.randint(0, 20))) for _ in range(200)]
    else:
        near = [(n, n + 1) for n in range(wide * high) if n % wide < wide - 1] + [
            (n, n + wide) for n in range(wide * (high - 1)) if not wide * 50 <= n < wide * 51]
        edges = [(a, b, float(rng.randint(0, 20))) for x, y in near for a, b in ((x, y), (y, x))
                 if rng.random() < 0.9]
        edges += [(7, 7, 0.0), (3, 4, 1.0), (3, 4, 0.5)]
    places = None if shape in ("ids only", "random") else spark.createDataFrame(
        [(n, n % wide / 100, n // wide / 100) for n in range(wide * high - 2)], "node_id long, x double, y double")
    many = range(20) if shape == "many origins" else [0, 3, 130, 239, 999]
    pairs = [(a, b) for a in many for b in range(0, wide * high, 3)] + [(999, 999), (0, 999), (None, 1)]
    got = distances.route_lengths(
        spark.createDataFrame(pairs, "origin long, destination long"),
        spark.createDataFrame(edges, "src long, dst long, length double"), places).collect()
    assert len(got) == len({r[:2] for r in got})
    known = {a: dijkstra(edges, a) for a in {a for a, _ in pairs}}
    assert {(r.origin, r.destination): r.length for r in got} == {
        (a, b): known[a][b][0] for a, b in pairs if a is not None and b in known[a]}


def test_steps_follow_the_logarithm_of_the_extent(spark, monkeypatch):
    """A road of 3 000 nodes takes few steps, not one for every few roads."""
    monkeypatch.setattr(distances, "CELL", 64)
    written = []
    monkeypatch.setattr(distances, "settle", lambda df, name="step": written.append(name) or session.settle(df, name))
    edges = spark.range(3000).selectExpr("id AS src", "id + 1 AS dst", "1.0D AS length")
    pairs = spark.createDataFrame([(0, 3000), (5, 2000)], "origin long, destination long")
    assert sorted(map(tuple, distances.route_lengths(pairs, edges).collect())) == [(0, 3000, 3000.0), (5, 2000, 1995.0)]
    assert len(written) < 30


def test_paths_leave_far_roads_alone(spark, monkeypatch):
    """The search for paths writes no more ways than lie within the farthest wanted node."""
    written = []

    def settle(df, name="step"):
        written.append((name, (kept := session.settle(df, name)).count()))
        return kept

    monkeypatch.setattr(routes, "settle", settle)
    edges = spark.range(2000).selectExpr("id AS a", "id + 1 AS b").selectExpr(
        "explode(array(struct(a AS src, b AS dst), struct(b AS src, a AS dst))) AS e").selectExpr("e.*", "1.0D AS length")
    row, = routes.routes(spark.createDataFrame([(1000, 1006)], "origin long, destination long"), edges).collect()
    assert (row.length, row.path) == (6.0, list(range(1000, 1007)))
    assert [n for name, n in written if name == "step"] and all(n <= 20 for name, n in written if name == "step"), written


def test_roads_of_no_length_do_not_loop(spark):
    edges = spark.createDataFrame(
        [(1, 2, 0.0), (2, 1, 0.0), (1, 3, 1.0), (2, 3, 1.0)], "src long, dst long, length double")
    pairs = spark.createDataFrame([(1, 3)], "origin long, destination long")
    row, = routes.routes(pairs, edges).collect()
    assert (row.length, row.path) == (1.0, [1, 3])


def test_snapped_trips(spark):
    nodes = spark.createDataFrame([(1, 0.0, 0.0), (2, 1.0, 0.0), (3, 2.0, 0.0), (4, 9.0, 9.0)],
                                  "node_id long, x double, y double")
    edges = spark.createDataFrame([(1, 2, 5.0), (2, 3, 5.0)], "src long, dst long, length double")
    trips = spark.createDataFrame([
        ("a", json.dumps([[0.1, 0.0], [5.0, 5.0], [1.9, 0.1]])), ("one", "[[0.0, 0.0]]"),
        ("none", json.dumps([[0.1, 0.0], [8.9, 9.0]])), ("bad", "oops"),
        ("stay", json.dumps([[0.1, 0.0], [0.0, 0.1]]))], "TRIP_ID string, CASA_POLYLINE string")
    got = {r.TRIP_ID: json.loads(r.CASA_POLYLINE)
           for r in routes.snap_trips(trips, nodes, edges).collect()}
    assert got == {"a": [[0.0, 0.0], [1.0, 0.0], [2.0, 0.0]], "stay": [[0.0, 0.0]]}


def test_road_filter(spark):
    df = spark.createDataFrame([
        (1, 2, 1.0, "residential", None), (1, 2, 1.0, "motorway", "no"),
        (1, 2, 1.0, "primary", "yes"), (1, 2, 1.0, None, "no")],
        "src long, dst long, length double, highway string, area string")
    assert [r.highway for r in routes.filter_edges(df).collect()] == ["residential"]
