"""The streaming jobs, from topic to topic and serving table."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from wayfare.functions import messages
from wayfare.functions.times import event_timestamp
from wayfare.operators.demand import WATERMARK, demand_windows, with_watermark
from wayfare.operators.pings import as_normalised_event, as_vehicle_position, normalise
from wayfare.sources.serving_tables import upsert_stream
from wayfare.sources.topics import AVAILABLE_NOW


def gps_normalize(raw: DataFrame, delay: str = WATERMARK) -> DataFrame:
    """Raw ping messages to anonymised pings; the same function for tables and streams."""
    typed = messages.parse_gps(raw).withColumn("event_ts", event_timestamp(F.col("event_time"), "s"))
    if typed.isStreaming:
        typed = with_watermark(typed, delay)
    return normalise(typed)


def gps_messages(raw: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    clock = F.unix_seconds(F.current_timestamp()) if ingested_at is None else ingested_at
    return messages.to_event_json(as_normalised_event(gps_normalize(raw)), "gps", clock)


def gps_positions(raw: DataFrame, city: str) -> DataFrame:
    return as_vehicle_position(gps_normalize(raw), city)


def demand_events(
    pings: DataFrame, trips: DataFrame, city: str, trip_unit: str = "auto",
) -> DataFrame:
    """Normalised ping messages and request messages as supply and demand rows.

    Pings carry seconds; senders of requests differ, so their unit is declared or detected.
    """
    vehicles = messages.parse_gps_norm(pings).withColumn(
        "event_ts", event_timestamp(F.col("event_time"), "s"))
    requests = messages.parse_trip(trips).withColumn(
        "event_ts", event_timestamp(F.col("event_time"), trip_unit))
    return vehicles.unionByName(requests).withColumn("city", F.lit(city))


def demand_stream(
    pings: DataFrame, trips: DataFrame, city: str, trip_unit: str = "auto",
    delay: str = WATERMARK,
) -> DataFrame:
    """Windows as they close: when the joint watermark of both topics passes their end.

    Rows behind the watermark are dropped; the query's progress counts them.
    """
    events = demand_events(pings, trips, city, trip_unit)
    return demand_windows(with_watermark(events, delay))


def demand_messages(windows: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    clock = F.unix_millis(F.current_timestamp()) if ingested_at is None else ingested_at
    return messages.to_event_json(windows, "demand", clock)


def match_messages(matches: DataFrame) -> DataFrame:
    """Match rows as messages keyed by the trip."""
    return messages.to_event_json(matches, "match", key="trip_id")


def start_upsert(
    df: DataFrame, path: str, table: str, checkpoint: str, trigger: dict = AVAILABLE_NOW,
) -> StreamingQuery:
    """Upsert a stream into a serving table; its checkpoint names the writer."""
    writer = "stream-" + hashlib.md5(checkpoint.encode()).hexdigest()[:12]
    return df.writeStream.foreachBatch(upsert_stream(path, table, writer)).option(
        "checkpointLocation", checkpoint).trigger(**trigger).start()


def start_table(
    df: DataFrame, path: str, checkpoint: str, trigger: dict = AVAILABLE_NOW,
) -> StreamingQuery:
    """Append the rows of a stream to a Parquet table, exactly once."""
    return df.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(
        **trigger).start(path)
