"""JSON messages to typed rows and back.

Fields are read as text and converted leniently: a quoted number counts as a number, a missing
or null required field drops the row, and so does text that is not a JSON object. Every function
works on batch and streaming frames alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from wayfare import schemas
from wayfare.functions.casts import to_double, to_int, to_long

SCHEMA_VERSION = "1.0.0"


def _fields(df: DataFrame, names: list[str], value: str) -> DataFrame:
    """The named fields as text, read in one pass over the message.

    ``json_tuple`` is a generator: conditions on the fields stay above it, whereas a condition on
    ``from_json`` would be pushed down together with another copy of the parsing.
    """
    kept = [F.col(name) for name in df.columns if name != value]
    return df.select(*kept, F.json_tuple(value, *names).alias(*[f"_{name}" for name in names]))


def parse_gps(df: DataFrame, value: str = "value") -> DataFrame:
    kept = [name for name in df.columns if name != value]
    return _fields(df, schemas.GPS_FIELDS, value).select(
        *kept,
        to_int(F.col("_taxi_id")).alias("taxi_id"),
        to_long(F.col("_timestamp")).alias("event_time"),
        to_double(F.col("_latitude")).alias("latitude"),
        to_double(F.col("_longitude")).alias("longitude"),
        to_double(F.col("_speed")).alias("speed"),
        F.col("_status").alias("status"),
    ).dropna(subset=["taxi_id", "event_time", "latitude", "longitude", "speed", "status"])


def parse_gps_norm(df: DataFrame, value: str = "value") -> DataFrame:
    """Normalised pings as supply rows: kind, zone, time (s), entity, status."""
    kept = [name for name in df.columns if name != value]
    return _fields(df, ["zone_id", "event_time", "taxi_id", "status"], value).select(
        *kept,
        F.lit("vehicle").alias("kind"),
        to_int(F.col("_zone_id")).alias("zone_id"),
        to_long(F.col("_event_time")).alias("event_time"),
        F.col("_taxi_id").alias("entity_id"),
        F.coalesce("_status", F.lit("UNKNOWN")).alias("status"),
    ).dropna(subset=["zone_id", "event_time", "entity_id"])


def parse_trip(df: DataFrame, value: str = "value") -> DataFrame:
    """Trip requests as demand rows of the same shape; the time keeps the sender's unit."""
    kept = [name for name in df.columns if name != value]
    return _fields(df, ["origin_zone", "requested_at", "trip_id"], value).select(
        *kept,
        F.lit("trip").alias("kind"),
        to_int(F.col("_origin_zone")).alias("zone_id"),
        to_long(F.col("_requested_at")).alias("event_time"),
        F.col("_trip_id").alias("entity_id"),
        F.lit("PENDING").alias("status"),
    ).dropna(subset=["zone_id", "event_time", "entity_id"])


def tag(df: DataFrame, source: str, city: str | Column, value: str = "value") -> DataFrame:
    """Keep JSON objects only, labelled with their source and the city they belong to."""
    place = F.lit(city) if isinstance(city, str) else city
    return df.filter(F.json_object_keys(value).isNotNull()).select(
        F.lit(source).alias("source"), place.alias("city"), F.col(value).alias("payload"))


def rider_number(rider: Column) -> Column:
    """Rider ids may carry a text prefix; what is not a number after it becomes null."""
    return to_int(F.regexp_replace(rider, "^RIDER-SPIKE-", ""))


def clean_rider_id(df: DataFrame, column: str = "rider_id") -> DataFrame:
    return df.withColumn(column, rider_number(F.col(column).cast("string"))).dropna(
        subset=[column])


def match_events(df: DataFrame) -> DataFrame:
    """Tagged messages of both kinds as the matcher's typed input.

    Missing fields take their defaults: zone 0, position 0.0, speed 30, status AVAILABLE.
    """
    names = list(dict.fromkeys(
        [*schemas.GPS_NORMALISED_FIELDS, *schemas.GPS_FIELDS, *schemas.TRIP_FIELDS]))
    wide = _fields(df, names, "payload")
    ping, request = F.col("source") == "gps", F.col("source") == "trip"

    def first(convert, default, *fields: str) -> Column:
        return F.coalesce(*[convert(F.col(f"_{name}")) for name in fields], F.lit(default))

    return wide.select(
        "city",
        F.when(ping, "ping").otherwise("request").alias("kind"),
        F.when(ping, F.col("_taxi_id")).otherwise(F.col("_trip_id")).alias("entity_id"),
        F.when(ping, first(to_int, 0, "zone_id")).otherwise(first(to_int, 0, "origin_zone"))
        .alias("zone_id"),
        F.when(ping, F.coalesce(to_long(F.col("_event_time")), to_long(F.col("_timestamp"))))
        .otherwise(to_long(F.col("_requested_at"))).alias("event_time"),
        F.when(ping, first(to_double, 0.0, "centroid_lat", "latitude"))
        .otherwise(to_double(F.col("_origin_lat"))).alias("latitude"),
        F.when(ping, first(to_double, 0.0, "centroid_lon", "longitude"))
        .otherwise(to_double(F.col("_origin_lon"))).alias("longitude"),
        F.when(ping, first(to_double, 30.0, "speed_kmh", "speed")).alias("speed"),
        F.when(ping, first(lambda c: c, "AVAILABLE", "status")).alias("status"),
        F.when(request, first(lambda c: c, "0", "rider_id")).alias("rider_id"),
        F.when(request, first(to_int, 0, "destination_zone")).alias("destination_zone"),
        F.when(request, first(lambda c: c, "A", "call_type")).alias("call_type"),
    ).filter(F.col("entity_id").isNotNull())


def _event_fields(kind: str, ingested_at: Column, ratio_digits: int | None) -> list[Column]:
    if kind == "gps":
        return [
            F.lit(SCHEMA_VERSION).alias("schema_version"),
            F.lit("GPS_NORMALIZED").alias("event_type"),
            F.col("event_time"), ingested_at.alias("ingested_at"),
            F.col("taxi_id"), F.col("zone_id"), F.col("zone_name"),
            F.col("centroid_lat"), F.col("centroid_lon"),
            F.col("speed").alias("speed_kmh"), F.col("status"),
        ]
    if kind == "demand":
        ratio = F.col("ratio")
        return [
            F.lit(SCHEMA_VERSION).alias("schema_version"),
            F.lit("DEMAND_AGGREGATED").alias("event_type"),
            F.col("zone_id"), F.col("active_vehicles"), F.col("pending_requests"),
            (ratio if ratio_digits is None else F.round(ratio, ratio_digits))
            .alias("supply_demand_ratio"),
            F.col("window_start").alias("window_start_ms"),
            ingested_at.alias("ingested_at"), F.col("city"),
        ]
    if kind == "match":
        return [F.col(name) for name in (
            "city", "date_bucket", "created_at", "trip_id", "rider_id", "origin_zone",
            "destination_zone", "call_type", "matched_taxi", "eta_seconds", "status")]
    raise ValueError(f"unknown event kind {kind!r}")


def to_event_json(
    df: DataFrame, kind: str, ingested_at: Column | None = None,
    ratio_digits: int | None = None, key: str | None = None,
) -> DataFrame:
    """One JSON text per row in column ``value`` (and ``key``, for keyed topics)."""
    clock = F.lit(None).cast("bigint") if ingested_at is None else ingested_at
    value = F.to_json(F.struct(*_event_fields(kind, clock, ratio_digits))).alias("value")
    return df.select(*([F.col(key).cast("string").alias("key")] if key else []), value)
