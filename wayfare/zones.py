"""The city's zones: sixteen overlapping boxes with a centroid each."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

OUTSIDE = 99


class Zone(NamedTuple):
    zone_id: int
    zone_name: str
    min_lat: float
    max_lat: float
    min_lon: float
    max_lon: float
    centroid_lat: float
    centroid_lon: float


# Fixed values; bounds are inclusive and the lowest id wins where boxes overlap.
ZONES = [
    Zone(1, "Anfa", 33.58, 33.62, -7.66, -7.62, 33.6, -7.64),
    Zone(2, "Sidi Belyout", 33.58, 33.61, -7.62, -7.58, 33.595, -7.6),
    Zone(3, "Roches Noires", 33.6, 33.64, -7.58, -7.54, 33.62, -7.56),
    Zone(4, "Ain Sebaa", 33.64, 33.7, -7.54, -7.48, 33.67, -7.51),
    Zone(5, "Hay Mohammadi", 33.6, 33.65, -7.56, -7.5, 33.625, -7.53),
    Zone(6, "Mers Sultan", 33.57, 33.6, -7.62, -7.58, 33.585, -7.6),
    Zone(7, "Maarif", 33.57, 33.6, -7.64, -7.6, 33.585, -7.62),
    Zone(8, "Sidi Othmane", 33.55, 33.59, -7.58, -7.52, 33.57, -7.55),
    Zone(9, "Sbata", 33.56, 33.59, -7.56, -7.5, 33.575, -7.53),
    Zone(10, "Ben M'Sick", 33.55, 33.58, -7.52, -7.46, 33.565, -7.49),
    Zone(11, "Ain Chock", 33.54, 33.58, -7.6, -7.54, 33.56, -7.57),
    Zone(12, "Hay Hassani", 33.54, 33.58, -7.66, -7.6, 33.56, -7.63),
    Zone(13, "Sidi Abderrahmane", 33.56, 33.6, -7.7, -7.66, 33.58, -7.68),
    Zone(14, "Ain Diab", 33.58, 33.62, -7.7, -7.66, 33.6, -7.68),
    Zone(15, "Dar Bouazza", 33.52, 33.58, -7.74, -7.66, 33.55, -7.7),
    Zone(16, "Sidi Moumen", 33.62, 33.68, -7.52, -7.46, 33.65, -7.49),
]


def zone_table(spark: SparkSession, zones: list[Zone] = ZONES) -> DataFrame:
    return spark.createDataFrame(
        zones,
        "zone_id int, zone_name string, min_lat double, max_lat double, "
        "min_lon double, max_lon double, centroid_lat double, centroid_lon double",
    )
