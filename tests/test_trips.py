from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from wayfare.operators import quality, trips
from wayfare.schemas import GPS_CONTRACT


def remap(spark, *lines):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "id int, POLYLINE string")
    out = trips.remap_polyline(df).orderBy("id").collect()
    return [json.loads(r.CASA_POLYLINE) for r in out]


def test_remap_scales_and_clamps(spark):
    got = remap(spark, "[[-8.62, 41.145]]", "[[-9.0, 42.0]]", "[[-8.60, 41.15]]")
    assert got[0][0] == pytest.approx([-7.6, 33.5], abs=1e-9)
    assert got[1][0] == pytest.approx([-7.9, 33.7], abs=1e-9)
    assert got[2][0] == pytest.approx([-7.5142857143, 33.5222222222], abs=1e-9)


def test_one_vertex_at_sea_empties_the_trip(spark):
    assert remap(spark, "[[-8.62, 41.145], [-8.58, 41.10]]") == [[]]


def test_malformed_polylines_become_empty(spark):
    assert remap(spark, "[[-8.6]]", "[]", None, "oops", "[[-8.62, 41.1],", "[[null, 41.1]]",
                 "[[-8.62, 41.1, 5.0]]") == [[]] * 7


def test_trip_ends_tolerate_short_vertices(spark):
    df = spark.createDataFrame([("[[1.0, 2.0], [3.0, 4.0]]",), ("[[5.0]]",)], "p string")
    out = trips.trip_ends(trips.parse_polyline(df, "p")).select(
        "pickup_lon", "pickup_lat", "dropoff_lon", "dropoff_lat").collect()
    assert sorted(map(tuple, out)) == [(1.0, 2.0, 3.0, 4.0), (5.0, None, 5.0, None)]


def test_curated_trips_are_unique_and_in_zones(spark):
    text = json.dumps([[-7.64, 33.6], [-7.63, 33.61], [-7.6, 33.6]])
    df = spark.createDataFrame(
        [("t1", "5", "1372636858", text), ("t1", "5", "1372636858", text),
         ("t2", "6", "1372636900", "[[-7.0, 33.0]]"), ("t3", "6", "1372636900", "[]")],
        "TRIP_ID string, TAXI_ID string, TIMESTAMP string, CASA_POLYLINE string")
    row, = trips.curate_trips(df).collect()
    assert (row.trip_id, row.zone_id, row.duration_sec, row.year_month) == ("t1", 1, 30, "2013-07")


def test_dedupe_keeps_the_first_in_a_total_order(spark):
    df = spark.createDataFrame(
        [("a", 2, "x"), ("a", 1, "z"), ("a", 1, "y"), ("b", 5, None)], "k string, t int, v string")
    for parts in (1, 5):
        got = quality.dedupe(df.repartition(parts), ["k"], ["t"]).collect()
        assert sorted(tuple(r) for r in got) == [("a", 1, "y"), ("b", 5, None)]


def test_null_profile_and_audit(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x")], "a int, b string")
    assert tuple(quality.null_counts(df).first()) == (1, 2)
    assert {r.column_name: (r.missing_values, r.missing_pct)
            for r in quality.null_profile(df).collect()} == {"a": (1, 33.33), "b": (2, 66.67)}
    assert tuple(quality.audit(df, F.col("a") > 0).first()) == (3, 2, 1)
    assert tuple(quality.audit_frames(df, df.dropna()).first()) == (3, 1, 2)
    assert [r.missing_pct for r in quality.null_profile(df.limit(0)).collect()] == [None, None]


def test_schema_check(spark):
    df = spark.range(1)
    assert quality.assert_schema(df, "id bigint") is df
    with pytest.raises(ValueError, match="id is bigint, expected int"):
        quality.assert_schema(df, "id int")


GOOD = {"schema_version": "1.0.0", "event_type": "GPS_NORMALIZED", "event_time": 1,
        "ingested_at": 2, "taxi_id": 3, "zone_id": 16, "centroid_lat": 33.5,
        "centroid_lon": -7.5, "speed_kmh": 0, "status": "OFFLINE"}


@pytest.mark.parametrize("change, reasons", [
    ({}, []), ({"zone_name": "Anfa"}, []), ({"taxi_id": 3.0}, []),
    ({"zone_id": 17}, ["maximum:zone_id"]), ({"zone_id": 0}, ["minimum:zone_id"]),
    ({"status": "EN_ROUTE"}, ["enum:status"]), ({"extra": 1}, ["unexpected:extra"]),
    ({"speed_kmh": None}, ["type:speed_kmh"]), ({"speed_kmh": "fast"}, ["type:speed_kmh"]),
    ({"taxi_id": 3.5}, ["type:taxi_id"]), ({"centroid_lat": 33.39}, ["minimum:centroid_lat"]),
    ({"schema_version": "1.0.1"}, ["const:schema_version"]),
    ({"speed_kmh": 150.5, "taxi_id": 0}, ["maximum:speed_kmh", "minimum:taxi_id"]),
])
def test_contract(spark, change, reasons):
    df = spark.createDataFrame([(json.dumps({**GOOD, **change}),)], "value string")
    assert quality.validate(df, GPS_CONTRACT).first().reasons == reasons


def test_contract_requires_fields_and_objects(spark):
    missing = {k: v for k, v in GOOD.items() if k != "speed_kmh"}
    df = spark.createDataFrame([(json.dumps(missing),), ("oops",), (json.dumps(GOOD),)],
                               "value string")
    checked = quality.validate(df, GPS_CONTRACT)
    assert [r.reasons for r in checked.collect()] == [
        ["required:speed_kmh"], ["not an object"], []]
    assert quality.conforming(checked).count() == 1
