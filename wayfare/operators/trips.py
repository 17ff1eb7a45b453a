"""Trip history: polylines, times, box remapping, and the curated trip table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from wayfare.functions.frames import complete, computed_once
from wayfare.functions.geo import rescale
from wayfare.functions.hexagons import with_hex_cell
from wayfare.functions.times import seconds_to_timestamp, year_month
from wayfare.operators.pings import assign_zone, drop_outside
from wayfare.operators.quality import dedupe
from wayfare.zones import ZONES, Zone

# Fixed boxes (longitude, latitude) of the source and target city, and the sea limit.
SOURCE_BOX = {"lon": (-8.690, -8.550), "lat": (41.100, 41.190)}
TARGET_BOX = {"lon": (-7.900, -7.300), "lat": (33.300, 33.700)}
MAX_TARGET_LON = -7.46

# Published sampling interval of the trip history: one vertex every 15 seconds.
VERTEX_SECONDS = 15

POINTS = "array<array<double>>"


def parse_polyline(df: DataFrame, column: str, into: str = "coords") -> DataFrame:
    """JSON text to [[lon, lat], ...]; text that does not parse becomes null."""
    return computed_once(df, **{into: F.from_json(F.col(column), POINTS)})


def nonempty(df: DataFrame, coords: str = "coords") -> DataFrame:
    return df.filter(F.size(coords) > 0)


def _part(point: Column, index: int) -> Column:
    return F.get(point, F.lit(index))


def trip_ends(df: DataFrame, coords: str = "coords") -> DataFrame:
    """First vertex as pickup, last vertex as dropoff."""
    first, last = F.get(coords, F.lit(0)), F.try_element_at(F.col(coords), F.lit(-1))
    return df.withColumns({
        "pickup_lon": _part(first, 0), "pickup_lat": _part(first, 1),
        "dropoff_lon": _part(last, 0), "dropoff_lat": _part(last, 1),
    })


def add_times(df: DataFrame, epoch: str = "TIMESTAMP") -> DataFrame:
    """Start time, month and readable text from epoch seconds (numbers or text)."""
    seconds = F.col(epoch).cast("string").try_cast("bigint")
    start = seconds_to_timestamp(seconds)
    return df.withColumns({
        "trip_start": start, "year_month": year_month(start),
        "readable_time": F.from_unixtime(seconds),
    })


def remap_points(
    df: DataFrame, coords: str = "coords", source: dict = SOURCE_BOX, target: dict = TARGET_BOX,
    max_lon: float = MAX_TARGET_LON,
) -> DataFrame:
    """Move every vertex from the source to the target box.

    A trip with a malformed vertex, or one that would end up beyond ``max_lon``, becomes empty.
    """
    sound = F.forall(coords, lambda p: (F.size(p) == 2) & p[0].isNotNull() & p[1].isNotNull())
    moved = F.when(sound, F.transform(coords, lambda p: F.array(
        rescale(p[0], source["lon"], target["lon"]),
        rescale(p[1], source["lat"], target["lat"]))))
    at_sea = F.exists("_moved", lambda p: p[0] > max_lon)
    inside = F.filter("_moved", lambda p: p[0].between(*target["lon"])
                      & p[1].between(*target["lat"]))
    empty = F.array().cast(POINTS)
    return computed_once(df, _moved=moved).withColumn(
        coords, F.coalesce(F.when(~at_sea, inside), empty)).drop("_moved")


def remap_polyline(
    df: DataFrame, column: str = "POLYLINE", into: str = "CASA_POLYLINE", source: dict = SOURCE_BOX,
    target: dict = TARGET_BOX, max_lon: float = MAX_TARGET_LON,
) -> DataFrame:
    """Remapped polyline as JSON text, '[]' where a trip cannot be mapped."""
    parsed = parse_polyline(df, column, "_points")
    moved = remap_points(parsed, "_points", source, target, max_lon)
    return computed_once(moved, **{into: F.to_json("_points")}).drop("_points")


def polyline_to_pings(df: DataFrame, column: str = "CASA_POLYLINE") -> DataFrame:
    """One ping per vertex, in vertex order, all at the trip's time; status AVAILABLE."""
    points = F.posexplode(F.from_json(F.col(column), POINTS)).alias("vertex", "_point")
    return df.select("TRIP_ID", "TAXI_ID", "TIMESTAMP", points).select(
        F.col("TRIP_ID").alias("trip_id"), "vertex",
        F.col("TAXI_ID").cast("int").alias("taxi_id"),
        F.col("TIMESTAMP").cast("bigint").alias("timestamp"),
        _part(F.col("_point"), 1).alias("latitude"), _part(F.col("_point"), 0).alias("longitude"),
        F.lit("AVAILABLE").alias("status"),
    ).dropna(subset=["taxi_id", "timestamp", "latitude", "longitude"])


def with_cells(df: DataFrame, resolution: int = 8) -> DataFrame:
    located = with_hex_cell(df, "pickup_hex", "pickup_lat", "pickup_lon", resolution)
    return with_hex_cell(located, "dropoff_hex", "dropoff_lat", "dropoff_lon", resolution)


def curate_ends(df: DataFrame, polyline: str = "CASA_POLYLINE") -> DataFrame:
    """All input columns but the polyline, with pickup, dropoff and their cells."""
    parsed = nonempty(parse_polyline(df, polyline))
    return with_cells(trip_ends(parsed)).drop("coords", polyline)


def curate_trips(
    df: DataFrame, polyline: str = "CASA_POLYLINE", zones: list[Zone] = ZONES, resolution: int = 8,
) -> DataFrame:
    """The curated trip table: one row per trip that starts in a zone.

    The duration follows from the number of vertices. Positions and zones are computed before the
    deduplication, which then moves eight short columns instead of the polylines.
    """
    parsed = trip_ends(nonempty(parse_polyline(df, polyline)))
    rows = add_times(parsed).select(
        F.col("TRIP_ID").alias("trip_id"), F.col("TAXI_ID").cast("int").alias("taxi_id"),
        "trip_start", F.col("pickup_lat").alias("latitude"),
        F.col("pickup_lon").alias("longitude"),
        ((F.size("coords") - 1) * VERTEX_SECONDS).cast("bigint").alias("duration_sec"),
        "year_month",
    )
    placed = complete(rows, ["latitude", "longitude"])
    unique = dedupe(placed, ["trip_id"], ["trip_start", "taxi_id"])
    inside = drop_outside(assign_zone(unique, zones=zones))
    return with_hex_cell(inside, "hex_cell", "latitude", "longitude", resolution).select(
        "trip_id", "taxi_id", "trip_start", "latitude", "longitude", "duration_sec",
        "hex_cell", "zone_id", "year_month")
