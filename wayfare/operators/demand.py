"""Supply and demand per zone in tumbling event-time windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

WINDOW = "30 seconds"
WATERMARK = "3 minutes"


def demand_ratio(requests: Column, vehicles: Column) -> Column:
    """Requests per vehicle; without vehicles the number of requests."""
    return requests / F.greatest(vehicles, F.lit(1)).cast("double")


def with_watermark(df: DataFrame, delay: str = WATERMARK) -> DataFrame:
    return df.withWatermark("event_ts", delay)


def demand_windows(events: DataFrame, window: str = WINDOW) -> DataFrame:
    """Distinct vehicles and requests per city, zone and window, from supply and demand rows.

    Two levels: first one row per entity and window, then counts. No step gathers the entities of
    a zone, a busy zone is spread over its entities, and the same plan runs on streams, where an
    exact distinct count is not allowed.
    """
    entities = events.groupBy(
        F.window("event_ts", window), "city", "zone_id", "kind", "entity_id").agg(
        F.count("*").alias("_n"))
    counted = entities.groupBy(
        F.window(F.window_time("window"), window).alias("slot"), "city", "zone_id").agg(
        F.count_if(F.col("kind") == "vehicle").alias("v"),
        F.count_if(F.col("kind") == "trip").alias("r"))
    return counted.select(
        "city", "zone_id",
        F.unix_millis(F.col("slot.start").cast("timestamp")).alias("window_start"),
        F.col("v").cast("int").alias("active_vehicles"),
        F.col("r").cast("int").alias("pending_requests"),
        demand_ratio(F.col("r"), F.col("v")).alias("ratio"))
