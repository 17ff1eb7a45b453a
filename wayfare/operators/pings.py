"""Position pings: validity, zones, anonymised positions. The same for batch and streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from wayfare.zones import OUTSIDE, ZONES, Zone, zone_table

# Fixed limits: service area (inclusive) and highest plausible speed in km/h.
SERVICE_AREA = {"lat": (33.4, 33.7), "lon": (-7.8, -7.4)}
MAX_SPEED = 150.0
# Longest list of boxes that is compared one by one; larger ones are looked up as a table.
MAX_INLINE_ZONES = 100


def valid_pings(df: DataFrame, area: dict = SERVICE_AREA, max_speed: float = MAX_SPEED) -> DataFrame:
    return df.filter(
        (F.col("speed") <= max_speed)
        & F.col("latitude").between(*area["lat"])
        & F.col("longitude").between(*area["lon"])
    )


def zone_of(lat: str, lon: str, zones: list[Zone] = ZONES) -> Column:
    """Lowest id among the boxes that hold the position, 99 if none does."""
    boxes = " ".join(
        f"WHEN `{lat}` BETWEEN {z.min_lat!r}D AND {z.max_lat!r}D "
        f"AND `{lon}` BETWEEN {z.min_lon!r}D AND {z.max_lon!r}D THEN {z.zone_id}"
        for z in sorted(zones))
    return F.expr(f"CASE {boxes} ELSE {OUTSIDE} END")


def assign_zone(
    df: DataFrame, lat: str = "latitude", lon: str = "longitude", zones: list[Zone] = ZONES,
) -> DataFrame:
    if len(zones) > MAX_INLINE_ZONES:
        return assign_zone_table(df, zone_table(df.sparkSession, zones), lat=lat, lon=lon)
    return df.withColumn("zone_id", zone_of(lat, lon, zones))


def drop_outside(df: DataFrame) -> DataFrame:
    return df.filter(F.col("zone_id") != OUTSIDE)


def zone_attribute(name: str, zones: list[Zone] = ZONES, zone_id: str = "zone_id") -> Column:
    """A zone's attribute by its id, null for an unknown id."""
    def literal(value) -> str:
        return f"{value!r}D" if isinstance(value, float) else \
            "'" + str(value).replace("'", "\\'") + "'"

    cases = " ".join(f"WHEN {z.zone_id} THEN {literal(getattr(z, name))}" for z in zones)
    return F.expr(f"CASE `{zone_id}` {cases} END")


def anonymize(
    df: DataFrame, lat: str = "latitude", lon: str = "longitude", zones: list[Zone] = ZONES,
) -> DataFrame:
    """Replace the position by the zone's centroid, and name the zone.

    The zone id stays with the row: a centroid may lie in a box of a lower id.
    """
    if len(zones) > MAX_INLINE_ZONES:
        known = zone_table(df.sparkSession, zones).select(
            "zone_id", "zone_name", F.col("centroid_lat").alias("_lat"), F.col("centroid_lon").alias("_lon"))
        kept = [name for name in df.columns if name not in (lat, lon, "zone_name")]
        return df.join(known, "zone_id", "left").withColumns({
            lat: F.coalesce("_lat", lat), lon: F.coalesce("_lon", lon),
        }).select(*[name for name in df.columns if name in (*kept, lat, lon)], known["zone_name"])
    return df.withColumns({
        "zone_name": zone_attribute("zone_name", zones),
        lat: F.coalesce(zone_attribute("centroid_lat", zones), F.col(lat)),
        lon: F.coalesce(zone_attribute("centroid_lon", zones), F.col(lon)),
    })


def neighbours(df: DataFrame, zone_id: str = "zone_id") -> DataFrame:
    """One row per neighbouring zone number, the lower one first."""
    zone = F.col(zone_id)
    return df.select("*", F.posexplode(F.array(zone - 1, zone + 1)).alias(
        "neighbour_rank", "neighbour_zone"))


def assign_zone_table(
    df: DataFrame, zones: DataFrame, cell: float = 0.02,
    lat: str = "latitude", lon: str = "longitude",
) -> DataFrame:
    """Zone lookup against a zone table of any size.

    Boxes are registered in every grid cell they touch, and a cell keeps its boxes as one short
    sorted list. A position then meets exactly one row of that index, whatever its zone.
    """
    def span(low: str, high: str) -> Column:
        return F.sequence(F.floor(F.col(low) / cell), F.floor(F.col(high) / cell))

    index = (
        zones.withColumn("_row", F.explode(span("min_lat", "max_lat")))
        .withColumn("_col", F.explode(span("min_lon", "max_lon")))
        .groupBy("_row", "_col")
        .agg(F.array_sort(F.collect_list(F.struct(
            "zone_id", "min_lat", "max_lat", "min_lon", "max_lon"))).alias("_boxes"))
    )
    placed = df.withColumns({
        "_row": F.floor(F.col(lat) / cell), "_col": F.floor(F.col(lon) / cell)})
    hits = F.filter("_boxes", lambda box: F.col(lat).between(box.min_lat, box.max_lat)
                    & F.col(lon).between(box.min_lon, box.max_lon))
    return (
        placed.join(index, ["_row", "_col"], "left")
        .withColumn("zone_id", F.coalesce(F.get(hits, F.lit(0)).zone_id, F.lit(OUTSIDE)))
        .drop("_row", "_col", "_boxes")
    )


def normalise(df: DataFrame) -> DataFrame:
    """Typed pings to anonymised pings inside the zones."""
    return anonymize(drop_outside(assign_zone(valid_pings(df))))


def as_normalised_event(df: DataFrame) -> DataFrame:
    """Column names of the normalised event."""
    return df.withColumnsRenamed({"latitude": "centroid_lat", "longitude": "centroid_lon"})


def as_vehicle_position(df: DataFrame, city: str | Column) -> DataFrame:
    """Rows of the serving table of positions."""
    place = F.lit(city) if isinstance(city, str) else city
    return df.select(
        place.alias("city"), "zone_id", "event_time", "taxi_id",
        "latitude", "longitude", "speed", "status")
