from __future__ import annotations

import json

from pyspark.sql import functions as F

from wayfare.functions import messages, times
from wayfare.functions.casts import to_int
from wayfare.operators import serving


def frame(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


PING = {"taxi_id": 7, "timestamp": 1000, "latitude": 33.5, "longitude": -7.5, "speed": 20.0,
        "status": "AVAILABLE"}


def test_malformed_pings_are_dropped(spark):
    bad = ['{"taxi_id": 1}', "not json", "", "[1, 2]", "null",
           json.dumps({**PING, "speed": None}), json.dumps({**PING, "taxi_id": "x"})]
    assert messages.parse_gps(frame(spark, *bad, json.dumps(PING))).count() == 1


def test_numbers_are_read_leniently(spark):
    texts = [json.dumps({**PING, "taxi_id": "12"}), json.dumps({**PING, "taxi_id": 12.9}),
             json.dumps({**PING, "latitude": "33.5"})]
    got = [(r.taxi_id, r.latitude) for r in messages.parse_gps(frame(spark, *texts)).collect()]
    assert sorted(got) == [(7, 33.5), (12, 33.5), (12, 33.5)]


def test_long_epochs_keep_all_digits(spark):
    text = json.dumps({"origin_zone": 3, "requested_at": 1751371200123, "trip_id": "a"})
    row = messages.parse_trip(frame(spark, text)).first()
    assert (row.event_time, row.zone_id, row.entity_id, row.status) == (
        1751371200123, 3, "a", "PENDING")


def test_status_defaults_to_unknown(spark):
    text = json.dumps({"zone_id": 3, "event_time": 5, "taxi_id": 9})
    assert messages.parse_gps_norm(frame(spark, text)).first().status == "UNKNOWN"


def test_tag_keeps_objects_only(spark):
    out = messages.tag(frame(spark, "{}", "oops", '{"a":1}'), "gps", "X")
    assert {tuple(r) for r in out.collect()} == {("gps", "X", "{}"), ("gps", "X", '{"a":1}')}


def test_match_events_take_defaults(spark):
    ping = messages.tag(frame(spark, '{"taxi_id": 4}'), "gps", "X")
    trip = messages.tag(frame(spark, '{"trip_id": "t"}'), "trip", "X")
    by_kind = {r.kind: r for r in messages.match_events(ping.union(trip)).collect()}
    p, t = by_kind["ping"], by_kind["request"]
    assert (p.zone_id, p.latitude, p.speed, p.status) == (0, 0.0, 30.0, "AVAILABLE")
    assert (t.zone_id, t.rider_id, t.call_type, t.latitude) == (0, "0", "A", None)


def test_rider_ids(spark):
    df = spark.createDataFrame([("RIDER-SPIKE-42",), ("17",), ("x",)], "rider_id string")
    assert sorted(r[0] for r in messages.clean_rider_id(df).collect()) == [17, 42]


def test_emitted_ping_parses_back(spark):
    df = spark.createDataFrame([(1, 2, 3, "Z", 33.5, -7.5, 9.0, "AVAILABLE")],
                               "event_time long, taxi_id int, zone_id int, zone_name string, "
                               "centroid_lat double, centroid_lon double, speed double, "
                               "status string")
    value = messages.to_event_json(df, "gps", F.lit(8).cast("bigint"), key="taxi_id").first()
    assert value.key == "2"
    assert json.loads(value.value) == {
        "schema_version": "1.0.0", "event_type": "GPS_NORMALIZED", "event_time": 1,
        "ingested_at": 8, "taxi_id": 2, "zone_id": 3, "zone_name": "Z", "centroid_lat": 33.5,
        "centroid_lon": -7.5, "speed_kmh": 9.0, "status": "AVAILABLE"}


def test_demand_ratio_digits(spark):
    df = spark.createDataFrame([("X", 3, 0, 3, 1, 1 / 3)], "city string, zone_id int, "
                               "window_start long, active_vehicles int, pending_requests int, "
                               "ratio double")
    full = json.loads(messages.to_event_json(df, "demand").first().value)
    short = json.loads(messages.to_event_json(df, "demand", ratio_digits=3).first().value)
    assert full["supply_demand_ratio"] == 1 / 3 and short["supply_demand_ratio"] == 0.333


def test_epoch_units(spark):
    df = spark.createDataFrame([(1_700_000_000,), (1_700_000_000_000,)], "t long")
    assert {r[0] for r in df.select(times.to_millis(F.col("t"))).collect()} == {1_700_000_000_000}
    assert df.select(times.to_millis(F.col("t"), "s")).first()[0] == 1_700_000_000_000


def test_cell_text_is_no_zone_number(spark):
    df = spark.createDataFrame([("8839a54a2bfffff",), ("12",)], "t string")
    assert [r[0] for r in df.select(to_int(F.col("t"))).collect()] == [None, 12]


def test_intake_splits_requests(spark):
    df = spark.createDataFrame(
        [("1", "2", "3", None), ("1", "2", "3", "D"), (None, "2", "x", "A")],
        "rider_id string, origin_zone string, destination_zone string, call_type string")
    good, bad = serving.intake_requests(df, F.lit(5).cast("bigint"))
    row = good.first()
    assert (row.call_type, row.status, row.requested_at) == ("A", "PENDING", 5)
    assert len(row.trip_id) == 32
    assert sorted(tuple(r.reasons) for r in bad.collect()) == [
        ("missing:rider_id", "not a number:destination_zone"), ("unknown:call_type",)]
    # the same request gets the same id again
    assert serving.intake_requests(df, F.lit(5).cast("bigint"))[0].first().trip_id == row.trip_id


def test_latest_status_prefers_the_decision(spark):
    asked = spark.createDataFrame(
        [("a", 10, 1, 2, 3), ("b", 10, 1, 2, 3)],
        "trip_id string, requested_at long, rider_id int, origin_zone int, destination_zone int")
    decided = spark.createDataFrame(
        [("a", 10, "1", 2, 3, "MATCHED_EXACT"), ("c", 10, "RIDER", 2, 3, None)],
        "trip_id string, created_at long, rider_id string, origin_zone int, "
        "destination_zone int, status string").withColumn(
        "rider_id", messages.rider_number(F.col("rider_id")))
    got = {r.trip_id: (r.status, r.message) for r in
           serving.latest_status(asked, decided).collect()}
    assert got == {"a": ("MATCHED_EXACT", ""), "c": ("UNKNOWN", ""),
                   "b": ("PENDING", "Trip reserved, finding a driver...")}
