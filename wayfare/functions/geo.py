"""Distances, arrival estimates and box scaling as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

EARTH_KM = 6371
DEFAULT_ETA = 180
MIN_ETA = 60
NEIGHBOUR_PENALTY = 300
MIN_SPEED = 10.0


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    half_lat = F.sin(F.radians(lat2 - lat1) / 2)
    half_lon = F.sin(F.radians(lon2 - lon1) / 2)
    chord = (
        half_lat * half_lat
        + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    )
    return F.atan2(F.sqrt(chord), F.sqrt(1 - chord)) * (2 * EARTH_KM)


def eta_seconds(
    origin_lat: Column, origin_lon: Column, taxi_lat: Column, taxi_lon: Column,
    speed_kmh: Column, neighbour: Column | bool = False,
) -> Column:
    """Whole seconds to the rider: 180 without rider position, at least 60, +300 across zones."""
    km = haversine_km(origin_lat, origin_lon, taxi_lat, taxi_lon)
    travel = (km / F.greatest(speed_kmh, F.lit(MIN_SPEED)) * 3600).cast("int")
    eta = F.greatest(F.coalesce(travel, F.lit(DEFAULT_ETA)), F.lit(MIN_ETA))
    penalty = F.when(F.lit(neighbour) if isinstance(neighbour, bool) else neighbour,
                     NEIGHBOUR_PENALTY).otherwise(0)
    return eta + penalty


def rescale(value: Column, source: tuple[float, float], target: tuple[float, float]) -> Column:
    """Clamp to the source interval and map it linearly onto the target interval."""
    low, high = source
    clamped = F.greatest(F.least(value, F.lit(high)), F.lit(low))
    return (clamped - low) / (high - low) * (target[1] - target[0]) + target[0]
