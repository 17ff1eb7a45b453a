from __future__ import annotations

import random

import pytest

from wayfare.operators import matching
from wayfare.operators.dispatch import Dispatcher, Request, Taxi

PING = "city string, taxi_id int, event_time long, zone_id int, latitude double, " \
       "longitude double, speed double, status string"
REQUEST = "city string, trip_id string, rider_id int, origin_zone int, destination_zone int, " \
          "requested_at long, call_type string"

# name: pings (time, taxi, zone[, status]), requests (time, trip, zone), expected outcomes
TIMELINES = {
    "exact": ([(0, 1, 5)], [(1, "A", 5)], {"A": ("MATCHED_EXACT", "1", 180, 1)}),
    "taken once": ([(0, 1, 5)], [(1, "A", 5), (2, "B", 5)], {
        "A": ("MATCHED_EXACT", "1", 180, 1), "B": ("UNFULFILLED", "NONE", 0, 7)}),
    "delayed": ([(3, 1, 5)], [(0, "A", 5)], {"A": ("MATCHED_DELAYED_EXACT", "1", 180, 5)}),
    "neighbour": ([(3, 1, 6)], [(0, "A", 5)], {"A": ("MATCHED_FALLBACK", "1", 480, 5)}),
    "one timer for all": ([], [(0, "A", 5), (4, "B", 9)], {
        "A": ("UNFULFILLED", "NONE", 0, 5), "B": ("UNFULFILLED", "NONE", 0, 5)}),
    "lower zone first": ([(3, 1, 6), (3, 2, 4)], [(0, "A", 5)], {
        "A": ("MATCHED_FALLBACK", "2", 480, 5)}),
    "fresh": ([(0, 1, 5)], [(119, "A", 5)], {"A": ("MATCHED_EXACT", "1", 180, 119)}),
    "stale": ([(0, 1, 5)], [(120, "A", 5)], {"A": ("UNFULFILLED", "NONE", 0, 125)}),
    "busy": ([(0, 1, 5, "ASSIGNED"), (0, 2, 5, "OFFLINE")], [(1, "A", 5)], {
        "A": ("UNFULFILLED", "NONE", 0, 6)}),
    "en route": ([(0, 1, 5, "EN_ROUTE")], [(1, "A", 5)], {"A": ("MATCHED_EXACT", "1", 180, 1)}),
    "smallest taxi": ([(0, 10, 5), (0, 9, 5)], [(1, "A", 5)], {
        "A": ("MATCHED_EXACT", "9", 180, 1)}),
    "moved on": ([(0, 1, 5), (1, 1, 8)], [(2, "A", 5)], {"A": ("UNFULFILLED", "NONE", 0, 7)}),
    "late timer of a settled request": ([], [(0, "A", 5), (4, "B", 9), (6, "C", 2)], {
        "A": ("UNFULFILLED", "NONE", 0, 5), "B": ("UNFULFILLED", "NONE", 0, 5),
        "C": ("UNFULFILLED", "NONE", 0, 9)}),
    "across a slab": ([(899, 1, 5)], [(897, "A", 5), (905, "B", 5)], {
        "A": ("MATCHED_DELAYED_EXACT", "1", 180, 902), "B": ("UNFULFILLED", "NONE", 0, 910)}),
    "waits at the end of a slab": ([], [(898, "A", 5)], {"A": ("UNFULFILLED", "NONE", 0, 903)}),
    "timer on the slab's edge": ([(900, 1, 5)], [(895, "A", 5)], {
        "A": ("UNFULFILLED", "NONE", 0, 900)}),
}


def frames(spark, pings, requests):
    return (spark.createDataFrame(pings, PING), spark.createDataFrame(requests, REQUEST))


def outcomes(df):
    return {(r.city, r.trip_id): (r.status, r.matched_taxi, r.eta_seconds, r.decided_at // 1000)
            for r in df.collect()}


def test_hand_made_timelines(spark):
    pings, requests, expected = [], [], {}
    for name, (taxis, trips, wanted) in TIMELINES.items():
        pings += [(name, taxi, t, zone, 33.6, -7.6, 30.0, *(status or ["AVAILABLE"]))
                  for t, taxi, zone, *status in taxis]
        requests += [(name, trip, 1, zone, 1, t, "A") for t, trip, zone in trips]
        expected.update({(name, trip): value for trip, value in wanted.items()})
    assert outcomes(matching.match_replay(*frames(spark, pings, requests))) == expected


def random_city(rng, city, span, n):
    pings = [(city, rng.randint(1, 25), rng.randint(0, span), rng.randint(1, 16), 33.6, -7.6,
              float(rng.randint(5, 60)), rng.choice(["AVAILABLE"] * 3 + ["OFFLINE", "EN_ROUTE"]))
             for _ in range(n)]
    requests = [(city, f"{city}-{i}", i, rng.randint(1, 16), 1, rng.randint(0, span), "A")
                for i in range(n)]
    return pings, requests


def in_sequence(pings, requests):
    """The rules once more, written without the dispatcher: one city, plain lists, no shortcuts."""
    events = [(t, 0, str(taxi), zone, status, speed, lat, lon)
              for _, taxi, t, zone, lat, lon, speed, status in pings]
    events += [(t, 1, trip, zone, "", 0.0, 0.0, 0.0) for _, trip, _, zone, _, t, _ in requests]
    last_ping, waiting, timers, out = {}, [], [], {}

    def take(zone, now):
        there = [int(taxi) for taxi, (z, status, seen) in last_ping.items()
                 if z == zone and status in ("AVAILABLE", "EN_ROUTE") and now - seen < 120]
        if not there:
            return None
        del last_ping[str(min(there))]
        return str(min(there))

    def run_timers(now):
        for timer in sorted(t for t in timers if t <= now):
            timers.remove(timer)
            for asked, trip, zone in sorted(waiting):
                taxi, status, eta = take(zone, timer), "MATCHED_DELAYED_EXACT", 180
                if taxi is None:
                    taxi, status, eta = take(zone - 1, timer), "MATCHED_FALLBACK", 480
                if taxi is None:
                    taxi = take(zone + 1, timer)
                if taxi is None:
                    taxi, status, eta = "NONE", "UNFULFILLED", 0
                out[trip] = (status, taxi, eta, timer)
            waiting.clear()

    for t, is_request, key, zone, status, *_ in sorted(events):
        run_timers(t)
        if not is_request:
            last_ping[key] = (zone, status, t)
            continue
        taxi = take(zone, t)
        if taxi is None:
            waiting.append((t, key, zone))
            timers.append(t + 5)
        else:
            out[key] = ("MATCHED_EXACT", taxi, 180, t)
    run_timers(float("inf"))
    return out


@pytest.mark.parametrize("slab, warm", [(900, 240), (120, 0), (150, 30)])
def test_replay_equals_one_long_sequence(spark, slab, warm):
    rng = random.Random(slab)
    pings, requests, expected = [], [], {}
    for i, (span, n) in enumerate([(5000, 500), (700, 400), (20_000, 300)]):
        p, r = random_city(rng, f"city{i}", span, n)
        expected.update({(f"city{i}", k): v for k, v in in_sequence(p, r).items()})
        pings, requests = pings + p, requests + r
    p, r = frames(spark, pings, requests)
    got = outcomes(matching.match_replay(p.repartition(3), r.repartition(5), slab, warm))
    assert got == expected
    assert len(got) == len(requests)


def test_no_taxi_serves_two_requests_on_one_ping(spark):
    rng = random.Random(7)
    pings, requests = random_city(rng, "X", 3000, 600)
    rows = matching.match_replay(*frames(spark, pings, requests)).collect()
    seen = {}
    for row in sorted(rows, key=lambda r: r.decided_at):
        if row.matched_taxi == "NONE":
            continue
        since = seen.get(row.matched_taxi, -1)
        times = [t * 1000 for _, taxi, t, *_ in pings if str(taxi) == row.matched_taxi]
        assert any(since <= t <= row.decided_at and row.decided_at - t < 120_000 for t in times)
        seen[row.matched_taxi] = max(t for t in times if t <= row.decided_at) + 1


def test_candidates_equal_all_pairs(spark):
    rng = random.Random(11)
    pings, requests = random_city(rng, "X", 1500, 400)
    got = {r.trip_id: (r.first_taxi, r.n_taxis)
           for r in matching.candidates(*reversed(frames(spark, pings, requests))).collect()}
    ordered = sorted(pings, key=lambda p: (p[1], p[2], p[4], p[5], p[6], p[7], p[3]))
    units = []
    for i, p in enumerate(ordered):
        after = ordered[i + 1] if i + 1 < len(ordered) and ordered[i + 1][1] == p[1] else None
        until = min(p[2] + 120, after[2] if after else 1 << 60)
        if p[7] in ("AVAILABLE", "EN_ROUTE"):
            units.append((p[3], p[2], until, p[1]))
    for _, trip, _, zone, _, t, _ in requests:
        there = [taxi for z, start, until, taxi in units if z == zone and start <= t < until]
        assert got[trip] == (min(there) if there else None, len(there))


def test_slabs_must_outlast_the_horizon(spark):
    p, r = frames(spark, [("X", 1, 0, 5, 33.6, -7.6, 30.0, "AVAILABLE")], [("X", "A", 1, 5, 1, 1, "A")])
    with pytest.raises(ValueError):
        matching.match_replay(p, r, slab_seconds=60)


def test_eta_uses_the_rider_position():
    d = Dispatcher()
    d.ping("1", Taxi(5, 33.595, -7.60, 30.0, 0), "AVAILABLE")
    assert d.request(Request("A", "1", 5, 1, "A", 0, 33.60, -7.64, 0), 1).eta_seconds == 449


def test_waiting_requests_are_settled_by_time_in_one_unit(spark):
    at = 1_700_000_000
    p, r = frames(spark, [("X", 1, at + 2, 5, 33.6, -7.6, 30.0, "AVAILABLE")],
                  [("X", "B", 1, 5, 1, at * 1000, "A"), ("X", "A", 1, 5, 1, at + 1, "A")])
    got = {r.trip_id: (r.status, r.matched_taxi, r.created_at) for r in matching.match_replay(p, r).collect()}
    assert got == {"B": ("MATCHED_DELAYED_EXACT", "1", at * 1000), "A": ("UNFULFILLED", "NONE", at + 1)}
    d = Dispatcher()
    for name, created, asked in (("B", at * 1000, at * 1000), ("A", at + 1, at * 1000 + 1000)):
        assert d.request(Request(name, "1", 5, 1, "A", created, None, None, asked), asked) is None
    d.ping("1", Taxi(5, 33.6, -7.6, 30.0, at * 1000 + 2000), "AVAILABLE")
    assert [(o.request.trip_id, o.matched_taxi) for o in d.settle(at * 1000 + 5000)] == [("B", "1"), ("A", "NONE")]


def test_a_task_holds_two_minutes_of_a_slab():
    """The memory of the fold does not grow with the taxis and events of its slab."""
    import tracemalloc

    import pyarrow as pa

    def batches(n, taxis_a_second=50):
        for begin in range(0, n, 1000):
            k = range(begin, begin + 1000)
            names = ["city", "slab", "kind", "entity_id", "zone_id", "event_time", "latitude", "longitude", "speed",
                     "status", "rider_id", "destination_zone", "call_type", "created_at", "state"]
            ask = [i % 40 == 39 for i in k]
            yield pa.RecordBatch.from_arrays([
                pa.array(["X"] * 1000), pa.array([0] * 1000, pa.int64()), pa.array(["request" if a else "ping" for a in ask]),
                pa.array([str(i) for i in k]), pa.array([i % 400 for i in k], pa.int32()),
                pa.array([i * 1000 // taxis_a_second for i in k], pa.int64()), pa.array([33.6] * 1000),
                pa.array([-7.6] * 1000), pa.array([30.0] * 1000), pa.array(["AVAILABLE"] * 1000), pa.array(["1"] * 1000),
                pa.array([1] * 1000, pa.int32()), pa.array(["A"] * 1000), pa.array([0] * 1000, pa.int64()),
                pa.nulls(1000, pa.string())], names)

    def peak(n):
        tracemalloc.start()
        rows = sum(b.num_rows for b in matching.fold_slabs(10**9)(batches(n)))
        found = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert rows == n // 40 + 1
        return found

    small, large = peak(20_000), peak(100_000)
    assert large < 1.3 * small
