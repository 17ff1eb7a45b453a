from __future__ import annotations

import json
import time

import pytest
from pyspark.sql import Row, functions as F

from wayfare.functions import messages
from wayfare.operators import kpi
from wayfare.sources import files, serving_tables, topics
from wayfare.streaming import jobs, matcher, states


def put(path, *rows):
    path.mkdir(parents=True, exist_ok=True)
    name = path / f"{len(list(path.iterdir()))}.json"
    name.write_text("".join(json.dumps(row) + "\n" if not isinstance(row, str) else row + "\n"
                            for row in rows))


def ping(taxi, t, zone=5):
    return {"taxi_id": taxi, "event_time": t, "zone_id": zone, "centroid_lat": 33.6,
            "centroid_lon": -7.6, "speed_kmh": 30.0, "status": "AVAILABLE"}


def trip(name, t, zone=5):
    return {"trip_id": name, "rider_id": 1, "origin_zone": zone, "destination_zone": 2,
            "requested_at": t, "call_type": "A"}


def finish(df, tmp_path, name="out"):
    query = jobs.start_table(df, str(tmp_path / name), str(tmp_path / f"{name}-cp"))
    query.awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(str(tmp_path / name)), query


def test_watermark_closes_windows_and_drops_late_rows(spark, tmp_path):
    root = tmp_path / "topics"
    put(root / "processed.gps", ping(1, 5), ping(2, 25), ping(1, 29), ping(3, 31))
    put(root / "raw.trips", trip("a", 10_000), "not json", trip("b", 5))

    def run():
        read = [topics.read_topic(spark, name, root=str(root))
                for name in ("processed.gps", "raw.trips")]
        return finish(jobs.demand_stream(*read, "X", trip_unit="s"), tmp_path)

    # the first run has no row late enough to close a window, but for the far request "a"
    out, _ = run()
    assert {(r.window_start, r.active_vehicles, r.pending_requests) for r in out.collect()} == {
        (0, 2, 1), (30_000, 1, 0)}
    put(root / "processed.gps", ping(9, 20), ping(9, 9_990))
    out, query = run()
    assert out.filter("window_start = 0").count() == 1
    dropped = sum(state.numRowsDroppedByWatermark
                  for p in query.recentProgress for state in p.stateOperators)
    assert dropped == 1


def test_stream_equals_batch_for_closed_windows(spark, tmp_path):
    root = tmp_path / "topics"
    put(root / "p", *[ping(i % 7, i % 300, 1 + i % 3) for i in range(900)], ping(1, 9_000))
    put(root / "t", *[trip(str(i), i % 300, 1 + i % 4) for i in range(200)])
    streams = [topics.read_topic(spark, name, root=str(root)) for name in "pt"]
    tables = [spark.read.text(str(root / name)) for name in "pt"]
    out, _ = finish(jobs.demand_stream(*streams, "X"), tmp_path)
    from wayfare.operators.demand import demand_windows
    whole = demand_windows(jobs.demand_events(*tables, "X")).filter("window_start < 300000")
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, whole.collect()))


def test_latest_skips_what_was_there(spark, tmp_path):
    put(tmp_path / "t", trip("old", 1))
    since = topics.unread(spark, "t", str(tmp_path))
    time.sleep(0.05)
    put(tmp_path / "t", trip("new", 2))
    fresh = topics.read_topic(spark, "t", root=str(tmp_path), start="latest", since=since)
    out, _ = finish(messages.parse_trip(fresh), tmp_path)
    assert [r.entity_id for r in out.collect()] == ["new"]
    with pytest.raises(ValueError):
        topics.read_topic(spark, "t", root=str(tmp_path), start="latest")


def test_gps_job_to_topic_and_table(spark, tmp_path):
    raw = [{"taxi_id": i, "timestamp": 100 + i, "latitude": 33.6, "longitude": -7.64,
            "speed": 10.0 * i, "status": "AVAILABLE"} for i in range(1, 20)]
    put(tmp_path / "raw.gps", *raw, "oops")
    stream = topics.read_topic(spark, "raw.gps", root=str(tmp_path), files_per_trigger=1)
    topics.write_topic(jobs.gps_messages(stream, F.lit(7).cast("bigint")), "processed.gps",
                       str(tmp_path / "cp"), root=str(tmp_path)).awaitTermination()
    texts = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "processed.gps")).collect()]
    assert sorted(t["taxi_id"] for t in texts) == list(range(1, 16))  # above 150 km/h is invalid
    assert {(t["zone_id"], t["ingested_at"], t["centroid_lat"]) for t in texts} == {(1, 7, 33.6)}
    path = str(tmp_path / "positions")
    for _ in range(2):  # the second run has nothing new to read
        jobs.start_upsert(jobs.gps_positions(stream, "X"), path, "vehicle_positions",
                          str(tmp_path / "cp2")).awaitTermination()
    table = serving_tables.read_serving(spark, path, "vehicle_positions")
    assert table.count() == 15
    newest = serving_tables.newest_first(table, "vehicle_positions").first()
    assert newest.taxi_id == 15


def test_archive_keeps_raw_messages(spark, tmp_path):
    put(tmp_path / "raw.gps", "{}", "not json")
    put(tmp_path / "raw.trips", "{}")
    topics.archive_topics(spark, ["raw.gps", "raw.trips"], str(tmp_path / "archive"),
                          str(tmp_path / "cp"), root=str(tmp_path),
                          trigger=topics.AVAILABLE_NOW).awaitTermination()
    got = spark.read.text(str(tmp_path / "archive")).groupBy("topic").count().collect()
    assert {r.topic: r["count"] for r in got} == {"raw.gps": 2, "raw.trips": 1}


def test_console_is_off_by_default(spark, tmp_path):
    put(tmp_path / "t", "{}")
    stream = topics.read_topic(spark, "t", root=str(tmp_path))
    assert topics.debug(stream) is None
    query = topics.debug(stream, on=True)
    assert query.isActive
    query.stop()


def test_live_matcher(spark, tmp_path):
    put(tmp_path / "p", ping(12, 1, 5), ping(9, 1, 5), ping(3, 2, 7))
    put(tmp_path / "t", trip("exact", 3, 5), trip("next", 4, 5), trip("near", 5, 8),
        trip("none", 6, 12), "oops", {**trip("noisy", 7, 12), "rider_id": "x"})
    streams = [topics.read_topic(spark, name, root=str(tmp_path)) for name in "pt"]
    df = matcher.match_stream(*streams, "X")
    query = jobs.start_table(df, str(tmp_path / "out"), str(tmp_path / "cp"),
                             {"processingTime": "1 second"})
    def read():
        return spark.read.schema(df.schema).parquet(str(tmp_path / "out"))
    end = time.monotonic() + 90
    while time.monotonic() < end and query.isActive:
        time.sleep(1)
        if (tmp_path / "out").exists() and read().count() == 5:
            break
    error = query.exception()
    query.stop()
    assert error is None
    got = {r.trip_id: (r.status, r.matched_taxi, r.eta_seconds) for r in read().collect()}
    assert got == {
        "exact": ("MATCHED_EXACT", "9", 180), "next": ("MATCHED_EXACT", "12", 180),
        "near": ("MATCHED_FALLBACK", "3", 480), "none": ("UNFULFILLED", "NONE", 0),
        "noisy": ("UNFULFILLED", "NONE", 0)}
    assert matcher.serving_rows(read()).count() == 4  # no numeric rider, no row


def demand_rows(spark, *rows):
    return spark.createDataFrame(list(rows), serving_tables.COLUMNS["demand_zones"])


def test_upsert_last_write_wins_and_repeats_are_harmless(spark, tmp_path):
    path = str(tmp_path / "demand")
    one = demand_rows(spark, ("X", 1, 0, 1, 1, 1.0), ("X", 2, 0, 1, 1, 1.0), ("X", 2, 0, 1, 2, 2.0))
    two = demand_rows(spark, ("X", 1, 0, 5, 5, 1.0), ("Y", 1, 0, 7, 7, 1.0))
    serving_tables.upsert(one, path, "demand_zones", 0)
    for _ in range(2):
        serving_tables.upsert(two, path, "demand_zones", 1)
    table = serving_tables.read_serving(spark, path, "demand_zones")
    got = sorted(map(tuple, table.collect()))
    assert got == [("X", 1, 0, 5, 5, 1.0), ("X", 2, 0, 1, 1, 1.0), ("Y", 1, 0, 7, 7, 1.0)]
    serving_tables.compact(spark, path, "demand_zones")
    assert len(list((tmp_path / "demand").glob("writer=*/batch=*"))) == 1
    again = serving_tables.read_serving(spark, path, "demand_zones")
    assert sorted(map(tuple, again.collect())) == got
    serving_tables.upsert(demand_rows(spark, ("X", 1, 0, 6, 6, 1.0)), path, "demand_zones", 0)
    again = serving_tables.read_serving(spark, path, "demand_zones")
    assert ("X", 1, 0, 6, 6, 1.0) in set(map(tuple, again.collect())) and again.count() == 3


def test_writers_do_not_overwrite_each_other(spark, tmp_path):
    path = str(tmp_path / "demand")
    serving_tables.upsert(demand_rows(spark, ("X", 1, 0, 1, 1, 1.0)), path, "demand_zones", 0, "stream")
    serving_tables.upsert(demand_rows(spark, ("X", 2, 0, 2, 2, 1.0)), path, "demand_zones", 0, "job")
    serving_tables.upsert(demand_rows(spark, ("X", 1, 0, 3, 3, 1.0)), path, "demand_zones", 0, "restarted")
    got = sorted(map(tuple, serving_tables.read_serving(spark, path, "demand_zones").collect()))
    assert got == [("X", 1, 0, 3, 3, 1.0), ("X", 2, 0, 2, 2, 1.0)]


def test_a_stream_with_a_new_checkpoint_keeps_old_rows(spark, tmp_path):
    path = str(tmp_path / "positions")
    for i in (1, 2):
        put(tmp_path / f"t{i}", {"taxi_id": i, "timestamp": 100, "latitude": 33.6, "longitude": -7.64,
                                 "speed": 1.0, "status": "AVAILABLE"})
        stream = topics.read_topic(spark, f"t{i}", root=str(tmp_path))
        jobs.start_upsert(jobs.gps_positions(stream, "X"), path, "vehicle_positions",
                          str(tmp_path / f"checkpoint{i}")).awaitTermination()
    rows = serving_tables.read_serving(spark, path, "vehicle_positions").collect()
    assert sorted(r.taxi_id for r in rows) == [1, 2]


def test_a_decision_wins_over_its_request_in_one_batch(spark, tmp_path):
    from wayfare.schemas import MATCH
    row = ("X", "2013-07-01", 5, "t", 1, 1, 2, "A")
    both = spark.createDataFrame([(*row, "NONE", 0, "UNFULFILLED"), (*row, "NONE", 0, "PENDING")], MATCH)
    serving_tables.upsert(both, str(tmp_path / "trips"), "trips", 0)
    assert [r.status for r in serving_tables.read_serving(spark, str(tmp_path / "trips"), "trips").collect()] == [
        "UNFULFILLED"]


def test_a_repeated_batch_leaves_nothing_of_its_first_attempt(spark, tmp_path):
    path = str(tmp_path / "demand")
    serving_tables.upsert(demand_rows(spark, ("X", 1, 0, 1, 1, 1.0), ("X", 2, 0, 1, 1, 1.0)),
                          path, "demand_zones", 0)
    serving_tables.upsert(demand_rows(spark, ("X", 1, 0, 2, 2, 1.0)), path, "demand_zones", 0)
    table = serving_tables.read_serving(spark, path, "demand_zones")
    assert [tuple(r) for r in table.collect()] == [("X", 1, 0, 2, 2, 1.0)]


def test_overwrite_replaces_only_the_given_months(spark, tmp_path):
    path = str(tmp_path / "t")
    files.write_table(spark.createDataFrame([(1, "a"), (2, "b")], "v int, m string"), path, ["m"])
    files.write_table(spark.createDataFrame([(3, "b")], "v int, m string"), path, ["m"])
    assert sorted(map(tuple, files.read_table(spark, path).collect())) == [(1, "a"), (3, "b")]


def test_missing_table_and_columns(spark, tmp_path):
    default = spark.createDataFrame([(1.0,)], "zone_id double")
    assert files.read_or_default(spark, str(tmp_path / "no"), default) is default
    files.write_table(default, str(tmp_path / "yes"))
    found = files.read_or_default(spark, str(tmp_path / "yes"), spark.range(5))
    assert found.columns == ["zone_id"]
    full = files.ensure_columns(found, ["zone_id", "is_raining"])
    assert tuple(full.first()) == (1.0, 0.0)


def test_csv_export_and_read(spark, tmp_path):
    df = spark.createDataFrame([(str(i), i, i, '[[1.0,2.0],[3.0,4.0]]') for i in range(20)],
                               "TRIP_ID string, TAXI_ID int, TIMESTAMP long, CASA_POLYLINE string")
    path = str(tmp_path / "csv")
    files.export_csv(df, path)
    assert files.read_csv_strings(spark, path).count() == 20
    files.export_first_csv(df, path, 5, ["TIMESTAMP"])
    from wayfare.schemas import TRIP_REMAPPED
    back = files.read_trips_csv(spark, path, TRIP_REMAPPED).collect()
    assert sorted(r.TAXI_ID for r in back) == [0, 1, 2, 3, 4]
    assert {r.CASA_POLYLINE for r in back} == {'[[1.0,2.0],[3.0,4.0]]'}
    assert dict(files.read_csv_strings(spark, path).dtypes)["TAXI_ID"] == "string"
    assert dict(files.read_csv_strings(spark, path, infer=True).dtypes)["TAXI_ID"] == "int"


def test_weekly_rows_fit_the_serving_table(spark, tmp_path):
    import datetime
    df = spark.createDataFrame([(1, 5, datetime.datetime(2013, 7, 7))],
                               "zone_id int, taxi_id int, trip_start timestamp_ntz")
    serving_tables.upsert(kpi.weekly_to_demand(kpi.weekly_trips(df), "X"),
                          str(tmp_path / "d"), "demand_zones", 3)
    assert serving_tables.read_serving(spark, str(tmp_path / "d"), "demand_zones").count() == 1


def test_ping_intervals_expire_in_any_order_of_arrival(spark, tmp_path):
    """Pings that arrive out of order, in two runs: the batch rule's intervals, and the state empties itself."""
    from wayfare.operators.matching import ping_intervals

    rows = [(taxi, t, 33.6, -7.6, 30.0, ["AVAILABLE", "EN_ROUTE", "OFFLINE"][(taxi + t) % 3], 1 + t % 4)
            for taxi in range(1, 6) for t in range(taxi, 900, 35 + 17 * taxi)]
    kind = "taxi_id int, event_time long, latitude double, longitude double, speed double, status string, zone_id int"
    last = (1, 100_000, 33.6, -7.6, 30.0, "OFFLINE", 1)

    def run(part):
        spark.createDataFrame(part, kind).selectExpr("to_json(struct(*)) AS value").write.mode("append").text(
            str(tmp_path / "t" / "pings"))
        stream = topics.read_topic(spark, "pings", root=str(tmp_path / "t")).selectExpr(
            f"from_json(value, '{kind}') AS p").selectExpr("p.*", "'X' AS city")
        return finish(states.ping_interval_stream(stream, "2 hours"), tmp_path)

    run(rows[::2])
    out, query = run(rows[1::2] + [last])
    whole = ping_intervals(spark.createDataFrame(rows, kind).selectExpr("*", "'X' AS city"))
    names = ["taxi_id", "event_time", "zone_id", "status", "until"]
    assert sorted(map(tuple, out.select(names).collect())) == sorted(map(tuple, whole.select(names).collect()))


def test_latest_status_whatever_the_order(spark, tmp_path):
    asked = [("a", 1, 10, 5, 6), ("b", 2, 11, 5, 6), ("c", 3, 12, 5, 6)]
    decided = [("a", 1, 10, 5, 6, "MATCHED_EXACT"), ("b", 2, 11, 5, 6, "UNFULFILLED")]
    kinds = ["trip_id string, rider_id int, requested_at long, origin_zone int, destination_zone int",
             "trip_id string, rider_id int, created_at long, origin_zone int, destination_zone int, status string"]

    def run(requests, matches):
        read = []
        for name, rows, kind in (("r", requests, kinds[0]), ("m", matches, kinds[1])):
            spark.createDataFrame(rows, kind).selectExpr("to_json(struct(*)) AS value").write.mode("append").text(
                str(tmp_path / "t" / name))
            read.append(topics.read_topic(spark, name, root=str(tmp_path / "t")).selectExpr(
                f"from_json(value, '{kind}') AS p").selectExpr("p.*"))
        out, _ = finish(states.latest_status_stream(*read, "1 hour"), tmp_path)
        return sorted((r.trip_id, r.version, r.status) for r in out.collect())

    first = run(asked[:1], decided[1:])
    assert first == [("a", 1, "PENDING"), ("b", 1, "UNFULFILLED")]
    assert run(asked[1:], decided[:1]) == sorted([*first, ("a", 2, "MATCHED_EXACT"), ("c", 1, "PENDING")])


def test_answers_leave_no_state_behind(spark, tmp_path):
    def run(requests, matches):
        for name, rows in (("r", requests), ("m", matches)):
            put(tmp_path / "t" / name, *rows)
        asked, decided = (topics.read_topic(spark, name, root=str(tmp_path / "t")).selectExpr(
            f"from_json(value, '{kind}') AS p").selectExpr("p.*") for name, kind in (
            ("r", "trip_id string, requested_at long"), ("m", "trip_id string, decided_at long, status string")))
        out, query = finish(states.answered_trips(asked, decided, "1 minute"), tmp_path)
        held = [s.numRowsTotal for p in query.recentProgress[-1:] for s in p.stateOperators]
        return sorted((r.trip_id, r.status, r.waited_seconds) for r in out.collect()), sum(held)

    many = [{"trip_id": str(i), "requested_at": 1_700_000_000 + i} for i in range(50)]
    told = [{"trip_id": str(i), "decided_at": (1_700_000_000 + i + 5) * 1000, "status": "MATCHED_EXACT"} for i in range(0, 50, 2)]
    first, held = run(many, told)
    assert first == sorted((str(i), "MATCHED_EXACT", 5.0) for i in range(0, 50, 2)) and held >= 50
    end = {"trip_id": "z", "requested_at": 1_700_090_000}, {"trip_id": "y", "decided_at": 1_700_090_000, "status": "UNFULFILLED"}
    second, held = run([end[0]], [end[1]])
    assert second == sorted([*first, *((str(i), "UNANSWERED", None) for i in range(1, 50, 2))]) and held <= 2


class Store:
    """A shard's state and timers, with the number of calls."""

    def __init__(self):
        self.parts, self.timers, self.calls = [], [], 0

    def getListState(self, name, schema):
        return self

    def get(self):
        self.calls += 1
        return iter(list(self.parts))

    def appendValue(self, part):
        self.calls += 1
        self.parts.append(part)

    def clear(self):
        self.calls += 1
        self.parts = []

    def registerTimer(self, at):
        self.calls += 1
        self.timers.append(at)

    def getCurrentWatermarkInMs(self):
        return self.watermark


def test_status_calls_go_with_shards_not_trips():
    def event(i, stage, status):
        return Row(trip_id=str(i), stage=stage, at=1_700_000_000 + i, status=status, rider_id=i, origin_zone=1,
                   destination_zone=None, message="")

    store, statuses = Store(), states.LatestStatus(3_600_000)
    statuses.init(store)
    first = list(statuses.handleInputRows((0,), iter([event(i, i % 2, "ab"[i % 2]) for i in range(1000)]), store))
    assert sorted((int(r.trip_id), r.version, r.status) for r in first) == [(i, 1, "ab"[i % 2]) for i in range(1000)]
    second = list(statuses.handleInputRows((0,), iter([event(i, 1 - i % 2, "ba"[i % 2]) for i in range(1000)]), store))
    assert sorted((int(r.trip_id), r.version, r.status) for r in second) == [(i, 2, "b") for i in range(0, 1000, 2)]
    assert store.calls <= 10
    store.watermark = min(store.timers) + 499_000
    assert list(statuses.handleExpiredTimer((0,), store, None)) == []
    assert sorted(int(trip) for part in store.parts for trip in part[0]) == list(range(500, 1000))
    assert max(store.timers) > store.watermark
    late = list(statuses.handleInputRows((0,), iter([event(0, 1, "b"), event(998, 1, "c")]), store))
    assert [(r.trip_id, r.version) for r in late] == [("0", 1), ("998", 3)]


def test_ping_calls_go_with_shards_not_taxis():
    pings = [(taxi, 1_700_000_000 + 7 * taxi % 30 + 50 * k) for taxi in range(100) for k in range(10)]
    store, intervals = Store(), states.PingIntervals(120)
    intervals.init(store)
    for part in (pings[::2], pings[1::2]):
        list(intervals.handleInputRows((0,), iter([Row(
            city="X", taxi_id=taxi, event_time=at, latitude=1.0, longitude=2.0, speed=None, status="AVAILABLE", zone_id=1)
            for taxi, at in reversed(part)]), store))
    out = []
    for store.watermark in (1_700_000_400_000, 1_700_000_400_000, 1_700_009_000_000):
        out.append([(r.taxi_id, r.event_time, r.until) for r in intervals.handleExpiredTimer((0,), store, None)])
    assert out[0] and not out[1] and all(at + 120 <= 1_700_000_400 for _, at, _ in out[0])
    ends = {(taxi, at): at + (50 if (taxi, at + 50) in set(pings) else 120) for taxi, at in pings}
    assert sorted(out[0] + out[2]) == sorted((taxi, at, end) for (taxi, at), end in ends.items())
    assert store.calls <= 16 and not store.parts
