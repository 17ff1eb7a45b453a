from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from wayfare.functions import geo
from wayfare.operators import pings
from wayfare.zones import ZONES, Zone, zone_table

POINT = "id int, latitude double, longitude double, speed double"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_lowest_zone_wins_and_bounds_are_inclusive(spark):
    cases = [(33.58, -7.62, 1), (33.59, -7.61, 2), (33.575, -7.61, 6), (33.62, -7.55, 3),
             (33.66, -7.50, 4), (33.58, -7.66, 1), (33.50, -7.60, 99)]
    df = spark.createDataFrame(
        [(i, lat, lon, 1.0) for i, (lat, lon, _) in enumerate(cases)], POINT)
    got = rows(pings.assign_zone(df).select("id", "zone_id"))
    assert got == [(i, zone) for i, (_, _, zone) in enumerate(cases)]
    assert rows(pings.assign_zone_table(df, zone_table(spark)).select("id", "zone_id")) == got


def test_zone_table_agrees_with_inline_boxes_for_any_cell_size(spark):
    rng = random.Random(3)
    points = [(i, round(rng.uniform(33.5, 33.72), 3), round(rng.uniform(-7.76, -7.44), 3), 1.0)
              for i in range(2000)]
    df = spark.createDataFrame(points, POINT)
    inline = rows(pings.assign_zone(df).select("id", "zone_id"))
    for cell in (0.005, 0.02, 0.3):
        table = pings.assign_zone_table(df, zone_table(spark), cell)
        assert rows(table.select("id", "zone_id")) == inline


def test_long_zone_lists_are_looked_up_as_a_table(spark):
    many = [Zone(i, f"z{i}", i / 10, i / 10 + 0.15, 0.0, 1.0, i / 10, 0.5) for i in range(250)]
    df = spark.createDataFrame([(i, i * 0.07 - 0.5, 0.4, 1.0) for i in range(400)], POINT)
    placed = pings.assign_zone(df, zones=many)
    one_by_one = df.withColumn("zone_id", pings.zone_of("latitude", "longitude", many))
    assert rows(placed) == rows(one_by_one) and placed.columns == one_by_one.columns
    hidden = pings.anonymize(placed, zones=many)
    few = [z for z in many if z.zone_id < 60]
    in_few = F.col("zone_id") < 60
    assert rows(hidden.filter(in_few)) == rows(pings.anonymize(placed.filter(in_few), zones=few).select(hidden.columns))
    assert rows(hidden.filter("zone_id = 99")) == rows(
        placed.filter("zone_id = 99").withColumn("zone_name", F.lit("z99")).withColumns(
            {"latitude": F.lit(9.9), "longitude": F.lit(0.5)}))


def test_valid_pings(spark):
    df = spark.createDataFrame([
        (1, 33.4, -7.8, 150.0), (2, 33.5, -7.5, 150.1), (3, 33.39, -7.5, 10.0),
        (4, 33.7, -7.4, 0.0), (5, 33.5, -7.39, 10.0), (6, None, -7.5, 10.0)], POINT)
    assert [r[0] for r in rows(pings.valid_pings(df).select("id"))] == [1, 4]


def test_anonymised_position_keeps_its_zone(spark):
    df = spark.createDataFrame([(1, 33.575, -7.625, 1.0)], POINT)
    out = pings.anonymize(pings.assign_zone(df))
    assert rows(out.select("zone_id", "zone_name", "latitude", "longitude")) == [
        (7, "Maarif", 33.585, -7.62)]
    # looked up again the centroid would fall to zone 1, so the id must stay with the row
    assert rows(pings.assign_zone(out).select("zone_id")) != [(7,)]


def test_names_with_quotes(spark):
    df = spark.createDataFrame([(10,)], "zone_id int")
    assert df.select(pings.zone_attribute("zone_name")).first()[0] == "Ben M'Sick"


def test_neighbours(spark):
    df = spark.createDataFrame([(5,)], "zone_id int")
    assert rows(pings.neighbours(df)) == [(5, 0, 4), (5, 1, 6)]


def test_distance_and_arrival_estimate(spark):
    cases = [
        (33.60, -7.64, 33.595, -7.60, 30.0, False, 449),
        (33.60, -7.64, 33.595, -7.60, 30.0, True, 749),
        (33.60, -7.64, 33.60, -7.64, 30.0, False, 60),
        (33.60, -7.64, 33.55, -7.70, 5.0, False, 2830),
        (None, None, 33.55, -7.70, 5.0, False, 180),
        (None, None, 33.55, -7.70, 5.0, True, 480)]
    df = spark.createDataFrame(
        [(i, *case) for i, case in enumerate(cases)],
        "id int, a double, b double, c double, d double, v double, far boolean, eta int")
    km = geo.haversine_km(*map(F.col, "abcd"))
    out = df.select("id", "eta", geo.eta_seconds(
        *map(F.col, "abcd"), F.col("v"), F.col("far")).alias("got"), F.round(km, 6).alias("km"))
    for row in out.collect():
        assert row.got == row.eta
    assert out.filter("id = 0").first().km == 3.746257
    assert out.filter("id = 3").first().km == 7.861863


def test_zone_constants_are_complete():
    assert [z.zone_id for z in ZONES] == list(range(1, 17))
    for z in ZONES:
        assert z.min_lat < z.centroid_lat < z.max_lat
        assert z.min_lon < z.centroid_lon < z.max_lon
