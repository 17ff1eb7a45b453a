"""Batch queries: sources and sinks, messages, zones, quality, trips, indicators, features."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from wayfare import schemas
from wayfare.functions import geo, messages, times
from wayfare.functions.casts import first_present
from wayfare.functions.hexagons import with_hex_cell
from wayfare.operators import demand, features, kpi, pings, quality, trips
from wayfare.plans import fixtures as fx
from wayfare.plans.fixtures import CITY, hex_sql, with_tables
from wayfare.plans.registry import once, query
from wayfare.session import scratch_path, settle
from wayfare.sources import files
from wayfare.zones import ZONES, zone_table

# --- sources -------------------------------------------------------------------------------

_HISTORY = "TRIP_ID, CALL_TYPE, ORIGIN_CALL, ORIGIN_STAND, TAXI_ID, \"TIMESTAMP\", DAY_TYPE, " \
           "MISSING_DATA, POLYLINE"


def _history_csv(spark: SparkSession, sf_dir: str) -> str:
    def write(path: str) -> str:
        fx.trip_history(spark, sf_dir).write.csv(path, header=True, escape='"')
        return path

    return once(spark, sf_dir, "history_csv", write)


@query("src_csv_schema", with_tables("trip_history", f"SELECT {_HISTORY} FROM trip_history"))
def _(spark, sf_dir):
    return files.read_trips_csv(spark, _history_csv(spark, sf_dir), schemas.TRIP_HISTORY)


@query("src_csv_strings", with_tables("trip_history", """
    SELECT TRIP_ID, CALL_TYPE, ORIGIN_CALL::VARCHAR AS ORIGIN_CALL,
      ORIGIN_STAND::VARCHAR AS ORIGIN_STAND, TAXI_ID::VARCHAR AS TAXI_ID,
      "TIMESTAMP"::VARCHAR AS "TIMESTAMP", DAY_TYPE, MISSING_DATA::VARCHAR AS MISSING_DATA,
      POLYLINE FROM trip_history"""))
def _(spark, sf_dir):
    return files.read_csv_strings(spark, _history_csv(spark, sf_dir))


@query("src_csv_infer", with_tables("trip_history", """
    SELECT TRIP_ID::BIGINT AS TRIP_ID, TAXI_ID, "TIMESTAMP"::BIGINT AS "TIMESTAMP",
      MISSING_DATA, POLYLINE FROM trip_history"""))
def _(spark, sf_dir):
    frame = files.read_csv_strings(spark, _history_csv(spark, sf_dir), infer=True)
    return frame.select(F.col("TRIP_ID").cast("bigint"), "TAXI_ID",
                        F.col("TIMESTAMP").cast("bigint"), "MISSING_DATA", "POLYLINE")


@query("src_parquet", "SELECT event_type, count(*) AS n, min(ts) AS first_ts, max(ts) AS last_ts "
                      "FROM events GROUP BY event_type")
def _(spark, sf_dir):
    return files.read_table(spark, f"{sf_dir}/events.parquet").groupBy("event_type").agg(
        F.count("*").alias("n"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))


@query("src_or_default", with_tables("slots", "SELECT zone_id, slot_ts, demand FROM slots"))
def _(spark, sf_dir):
    default = features.slot_demand(fx.slot_trips(spark, sf_dir)).drop("slot_start")
    return files.read_or_default(spark, scratch_path(spark, "absent"), default)


@query("src_ensure_columns", with_tables("slots", """
    SELECT zone_id, slot_ts, demand, 0.0::DOUBLE AS is_raining, 0.0::DOUBLE AS rolling_7d_mean
    FROM slots"""))
def _(spark, sf_dir):
    slots = features.slot_demand(fx.slot_trips(spark, sf_dir)).drop("slot_start")
    return files.ensure_columns(slots, ["zone_id", "demand", "is_raining", "rolling_7d_mean"])


def _remapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips.remap_polyline(fx.trip_history(spark, sf_dir))


_PINGS = """SELECT TRIP_ID AS trip_id, k AS trip_key, new_vertex::INTEGER AS vertex,
    TAXI_ID AS taxi_id, "TIMESTAMP" AS "timestamp", new_lat AS latitude, new_lon AS longitude
    FROM mapped"""


def _replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips.polyline_to_pings(_remapped(spark, sf_dir))


@query("src_polyline_replay", with_tables("mapped", f"""
    SELECT trip_id, vertex, taxi_id, "timestamp", round(latitude, 9) AS latitude,
      round(longitude, 9) AS longitude, 'AVAILABLE' AS status FROM ({_PINGS})"""))
def _(spark, sf_dir):
    return _replayed(spark, sf_dir).withColumns({
        "latitude": F.round("latitude", 9), "longitude": F.round("longitude", 9)})


# --- sinks ---------------------------------------------------------------------------------

_HOURLY = """SELECT PULocationID, tpep_pickup_datetime::DATE AS pickup_date,
    hour(tpep_pickup_datetime)::INTEGER AS pickup_hour,
    (dayofweek(tpep_pickup_datetime) + 1)::INTEGER AS day_of_week,
    strftime(tpep_pickup_datetime, '%Y-%m') AS year_month, count(*) AS trip_count,
    avg(trip_distance) AS avg_distance_miles,
    avg(date_diff('second', tpep_pickup_datetime, tpep_dropoff_datetime) / 60) AS avg_duration_min,
    avg(fare_amount) AS avg_fare FROM nyc_trips
    WHERE PULocationID IS NOT NULL AND trip_distance > 0 AND
      date_diff('second', tpep_pickup_datetime, tpep_dropoff_datetime) / 60 BETWEEN 1 AND 180
    GROUP BY ALL"""


@query("sink_parquet", with_tables("nyc_trips", "SELECT * FROM nyc_trips"))
def _(spark, sf_dir):
    path = scratch_path(spark, "nyc")
    files.write_table(fx.nyc_trips(spark, sf_dir), path)
    return files.read_table(spark, path)


@query("sink_parquet_part", with_tables("trips_curated", "SELECT * FROM trips_curated"))
def _(spark, sf_dir):
    path = scratch_path(spark, "curated")
    files.write_table(fx.trips_curated(spark, sf_dir), path, ["year_month"], gather=True)
    return files.read_table(spark, path).withColumn("year_month", F.col("year_month").cast("string"))


def _exportable(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _remapped(spark, sf_dir).filter(F.col("CASA_POLYLINE") != "[]").select(
        "TRIP_ID", "TAXI_ID", "TIMESTAMP", "CASA_POLYLINE")


def _exported(spark: SparkSession, path: str) -> DataFrame:
    again = files.read_trips_csv(spark, path, schemas.TRIP_REMAPPED)
    return trips.parse_polyline(again, "CASA_POLYLINE").select(
        "TRIP_ID", "TAXI_ID", "TIMESTAMP", F.size("coords").cast("bigint").alias("vertices"))


_EXPORTED = """SELECT TRIP_ID, TAXI_ID, "TIMESTAMP", count(*) AS vertices FROM mapped
    GROUP BY k, TRIP_ID, TAXI_ID, "TIMESTAMP" """


@query("sink_csv_export", with_tables("mapped", _EXPORTED))
def _(spark, sf_dir):
    path = scratch_path(spark, "export")
    files.export_csv(_exportable(spark, sf_dir), path)
    return _exported(spark, path)


@query("sink_csv_first", with_tables("mapped", f"""
    SELECT * FROM ({_EXPORTED}) ORDER BY TRIP_ID, "TIMESTAMP", TAXI_ID, vertices LIMIT 50"""))
def _(spark, sf_dir):
    """The export cut at a number of rows, for whoever asks for it."""
    path = scratch_path(spark, "export")
    ordered = trips.parse_polyline(_exportable(spark, sf_dir), "CASA_POLYLINE").withColumn(
        "vertices", F.size("coords")).drop("coords")
    files.export_first_csv(ordered, path, 50, ["TRIP_ID", "TIMESTAMP", "TAXI_ID", "vertices"])
    return _exported(spark, path)


# --- messages ------------------------------------------------------------------------------

@query("parse_gps", with_tables("raw_pings", """
    SELECT event_id, taxi_id, event_time, latitude, longitude, speed, status FROM raw_pings
    WHERE event_id % 97 NOT IN (5, 6, 9, 10)"""))
def _(spark, sf_dir):
    return messages.parse_gps(fx.gps_messages(spark, sf_dir))


@query("parse_gps_norm", with_tables("zone_pings", """
    SELECT 'vehicle' AS kind, zone_id, event_time, taxi_id::VARCHAR AS entity_id,
      CASE WHEN event_id % 13 = 0 THEN 'UNKNOWN' ELSE status END AS status FROM zone_pings"""))
def _(spark, sf_dir):
    return messages.parse_gps_norm(fx.normalised_messages(spark, sf_dir))


@query("parse_trip", with_tables("trip_requests", """
    SELECT 'trip' AS kind, origin_zone AS zone_id, CASE WHEN trip_id::BIGINT % 2 = 0
      THEN requested_at * 1000 ELSE requested_at END AS event_time, trip_id AS entity_id,
      'PENDING' AS status FROM trip_requests WHERE trip_id::BIGINT % 97 <> 5"""))
def _(spark, sf_dir):
    return messages.parse_trip(fx.trip_messages(spark, sf_dir))


def _tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages.tag(fx.normalised_messages(spark, sf_dir), "gps", CITY).unionByName(
        messages.tag(fx.trip_messages(spark, sf_dir), "trip", CITY))


@query("tag_union_key", with_tables("zone_pings trip_requests", f"""
    SELECT 'gps' AS source, '{CITY}' AS city, count(*) AS n FROM zone_pings
    UNION ALL SELECT 'trip', '{CITY}', count(*) FROM trip_requests
    WHERE trip_id::BIGINT % 97 <> 5"""))
def _(spark, sf_dir):
    return _tagged(spark, sf_dir).groupBy("source", "city").agg(F.count("*").alias("n"))


@query("field_fallback", with_tables("raw_pings", """
    SELECT event_id, CASE WHEN event_id % 4 = 0 THEN 30.0::DOUBLE ELSE speed END AS speed,
      CASE WHEN event_id % 3 = 0 THEN 'AVAILABLE' ELSE status END AS status, 0 AS zone_id
    FROM raw_pings"""))
def _(spark, sf_dir):
    k = F.col("event_id")
    sparse = fx.raw_pings(spark, sf_dir).select(
        "event_id", F.when(k % 4 == 1, F.col("speed")).alias("speed_kmh"),
        F.when(k % 4 != 0, F.col("speed")).alias("speed"),
        F.when(k % 3 != 0, F.col("status")).alias("status"))
    return sparse.select(
        "event_id",
        first_present(["speed_kmh", "speed"], sparse.columns, 30.0).alias("speed"),
        first_present(["status"], sparse.columns, "AVAILABLE").alias("status"),
        first_present(["zone_id"], sparse.columns, 0).alias("zone_id"))


@query("clean_rider_id", with_tables("trip_requests", """
    SELECT trip_id, rider_id FROM trip_requests WHERE trip_id::BIGINT % 97 <> 5
      AND (trip_id::BIGINT % 5 = 0 OR trip_id::BIGINT % 11 <> 0)"""))
def _(spark, sf_dir):
    requests = fx.trip_messages(spark, sf_dir).select(
        F.json_tuple("value", "trip_id", "rider_id").alias("trip_id", "rider_id"))
    return messages.clean_rider_id(requests)


@query("emit_json", with_tables("zone_pings", """
    SELECT '{"schema_version":"1.0.0","event_type":"GPS_NORMALIZED","event_time":' || event_time
      || ',"ingested_at":' || (event_time + 5) || ',"taxi_id":' || taxi_id || ',"zone_id":'
      || zone_id || ',"zone_name":"' || zone_name || '","centroid_lat":' || latitude
      || ',"centroid_lon":' || longitude || ',"speed_kmh":' || speed || ',"status":"' || status
      || '"}' AS value FROM zone_pings"""))
def _(spark, sf_dir):
    events = pings.as_normalised_event(fx.zone_pings(spark, sf_dir))
    return messages.to_event_json(events, "gps", F.col("event_time") + 5)


@query("ratio_round", with_tables("demand_windows", """
    SELECT '{"schema_version":"1.0.0","event_type":"DEMAND_AGGREGATED","zone_id":' || zone_id
      || ',"active_vehicles":' || active_vehicles || ',"pending_requests":' || pending_requests
      || ',"supply_demand_ratio":' || round(ratio, 3) || ',"window_start_ms":' || window_start
      || ',"ingested_at":' || (window_start + 30000) || ',"city":"' || city || '"}' AS value
    FROM demand_windows"""))
def _(spark, sf_dir):
    windows = demand.demand_windows(fx.supply_and_demand(spark, sf_dir))
    return messages.to_event_json(windows, "demand", F.col("window_start") + 30_000, 3)


@query("epoch_unit", with_tables("trip_requests", """
    SELECT trip_id, requested_at * 1000 AS millis, make_timestamp(requested_at * 1000000) AS at
    FROM trip_requests"""))
def _(spark, sf_dir):
    k = F.col("trip_id").cast("bigint")
    mixed = fx.trip_requests(spark, sf_dir).withColumn(
        "requested_at", F.when(k % 2 == 0, F.col("requested_at") * 1000).otherwise(
            F.col("requested_at")))
    return mixed.select(
        "trip_id", times.to_millis(F.col("requested_at")).alias("millis"),
        times.event_timestamp(F.col("requested_at")).cast("timestamp_ntz").alias("at"))


@query("project_rename", with_tables("zone_pings", """
    SELECT event_time, taxi_id, zone_id, latitude AS centroid_lat, longitude AS centroid_lon
    FROM zone_pings"""))
def _(spark, sf_dir):
    return pings.as_normalised_event(fx.zone_pings(spark, sf_dir)).drop(
        "event_id", "speed", "status", "zone_name", "no_such_column")


# --- polylines and times -------------------------------------------------------------------

def _parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips.parse_polyline(fx.trip_history(spark, sf_dir), "POLYLINE")


@query("parse_polyline", with_tables("trip_history", """
    SELECT TRIP_ID, "TIMESTAMP", CASE fault WHEN 0 THEN (k % 12)::INTEGER WHEN 6 THEN 1 END AS n
    FROM trip_history"""))
def _(spark, sf_dir):
    return _parsed(spark, sf_dir).select("TRIP_ID", "TIMESTAMP", F.size("coords").alias("n"))


@query("polyline_nonempty", with_tables("trip_history", """
    SELECT TRIP_ID, "TIMESTAMP", CASE fault WHEN 0 THEN (k % 12)::INTEGER ELSE 1 END AS n
    FROM trip_history WHERE (fault = 0 AND k % 12 > 0) OR fault = 6"""))
def _(spark, sf_dir):
    return trips.nonempty(_parsed(spark, sf_dir)).select(
        "TRIP_ID", "TIMESTAMP", F.size("coords").alias("n"))


@query("polyline_ends", with_tables("vertices", """
    SELECT TRIP_ID, "TIMESTAMP", min_by(lon, vertex) AS pickup_lon,
      min_by(lat, vertex) AS pickup_lat, max_by(lon, vertex) AS dropoff_lon,
      max_by(lat, vertex) AS dropoff_lat FROM vertices GROUP BY k, TRIP_ID, "TIMESTAMP"
    UNION ALL SELECT TRIP_ID, "TIMESTAMP", -8.6, NULL, -8.6, NULL FROM trip_history
    WHERE fault = 6"""))
def _(spark, sf_dir):
    return trips.trip_ends(trips.nonempty(_parsed(spark, sf_dir))).select(
        "TRIP_ID", "TIMESTAMP", "pickup_lon", "pickup_lat", "dropoff_lon", "dropoff_lat")


@query("epoch_to_ts", with_tables("trip_history", """
    SELECT TRIP_ID, make_timestamp("TIMESTAMP" * 1000000) AS trip_start,
      strftime(make_timestamp("TIMESTAMP" * 1000000), '%Y-%m') AS year_month,
      strftime(make_timestamp("TIMESTAMP" * 1000000), '%Y-%m-%d %H:%M:%S') AS readable_time
    FROM trip_history"""))
def _(spark, sf_dir):
    return trips.add_times(fx.trip_history(spark, sf_dir)).select(
        "TRIP_ID", "trip_start", "year_month", "readable_time")


@query("bbox_remap", with_tables("mapped", """
    SELECT TRIP_ID, "TIMESTAMP", new_vertex::INTEGER AS vertex, round(new_lon, 9) AS lon,
      round(new_lat, 9) AS lat FROM mapped"""))
def _(spark, sf_dir):
    remapped = trips.parse_polyline(_remapped(spark, sf_dir), "CASA_POLYLINE")
    return remapped.select("TRIP_ID", "TIMESTAMP", F.posexplode("coords").alias("vertex", "p")) \
        .select("TRIP_ID", "TIMESTAMP", "vertex", F.round(F.col("p")[0], 9).alias("lon"),
                F.round(F.col("p")[1], 9).alias("lat"))


# --- zones and distances -------------------------------------------------------------------

@query("geo_valid", with_tables("valid", "SELECT * EXCLUDE (ts) FROM valid"))
def _(spark, sf_dir):
    return pings.valid_pings(fx.raw_pings(spark, sf_dir))


@query("zone_assign", with_tables("placed", "SELECT event_id, zone_id FROM placed"))
def _(spark, sf_dir):
    return pings.assign_zone(pings.valid_pings(fx.raw_pings(spark, sf_dir))).select(
        "event_id", "zone_id")


@query("zone_drop_outside", with_tables("placed", """
    SELECT zone_id, count(*) AS n FROM placed WHERE zone_id <> 99 GROUP BY zone_id"""))
def _(spark, sf_dir):
    return fx.zone_pings(spark, sf_dir).groupBy("zone_id").agg(F.count("*").alias("n"))


@query("zone_anonymize", with_tables("zone_pings", "SELECT * FROM zone_pings"))
def _(spark, sf_dir):
    return fx.zone_pings(spark, sf_dir)


@query("join_zone_range", with_tables("valid zones", """
    SELECT event_id, coalesce(min(z.zone_id), 99) AS zone_id FROM valid p LEFT JOIN zones z ON
      p.latitude BETWEEN z.min_lat AND z.max_lat AND p.longitude BETWEEN z.min_lon AND z.max_lon
    GROUP BY event_id"""))
def _(spark, sf_dir):
    return pings.assign_zone_table(
        pings.valid_pings(fx.raw_pings(spark, sf_dir)), zone_table(spark, ZONES)).select(
        "event_id", "zone_id")


@query("zone_neighbors", with_tables("trip_requests", """
    SELECT trip_id, origin_zone, r AS neighbour_rank, origin_zone + 2 * r - 1 AS neighbour_zone
    FROM trip_requests, (VALUES (0), (1)) AS v(r)"""))
def _(spark, sf_dir):
    return pings.neighbours(fx.trip_requests(spark, sf_dir), "origin_zone").select(
        "trip_id", "origin_zone", "neighbour_rank", "neighbour_zone")


@query("hex_cell", with_tables("valid", f"""
    SELECT event_id, {hex_sql('latitude', 'longitude')} AS cell8,
      {hex_sql('latitude', 'longitude', 6)} AS cell6 FROM valid"""))
def _(spark, sf_dir):
    located = pings.valid_pings(fx.raw_pings(spark, sf_dir)).select(
        "event_id", "latitude", "longitude")
    for resolution in (8, 6):
        located = with_hex_cell(
            located, f"cell{resolution}", "latitude", "longitude", resolution)
    return located.select("event_id", "cell8", "cell6")


def _to_centroid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid pings with their own and their zone's position."""
    placed = pings.drop_outside(pings.assign_zone(pings.valid_pings(fx.raw_pings(spark, sf_dir))))
    return placed.withColumns({
        "c_lat": pings.zone_attribute("centroid_lat"), "c_lon": pings.zone_attribute("centroid_lon")})


_KM = """(2 * 6371 * atan2(sqrt(a), sqrt(1 - a)))"""
_CHORDS = """chords AS (SELECT *, sin(radians(c_lat - latitude) / 2) ** 2 + cos(radians(latitude))
    * cos(radians(c_lat)) * sin(radians(c_lon - longitude) / 2) ** 2 AS a FROM (
    SELECT p.*, z.centroid_lat AS c_lat, z.centroid_lon AS c_lon
    FROM placed p JOIN zones z USING (zone_id)))"""


def _with_chords(select: str) -> str:
    return with_tables("placed zones", "").rstrip() + f", {_CHORDS} {select}"


@query("haversine_km", _with_chords(f"SELECT event_id, round({_KM}, 6) AS km FROM chords"))
def _(spark, sf_dir):
    km = geo.haversine_km(*[F.col(c) for c in ("latitude", "longitude", "c_lat", "c_lon")])
    return _to_centroid(spark, sf_dir).select("event_id", F.round(km, 6).alias("km"))


@query("eta_seconds", _with_chords(f"""
    SELECT event_id, greatest(60, CASE WHEN event_id % 10 = 0 THEN 180 ELSE
      trunc({_KM} / greatest(speed, 10) * 3600)::INTEGER END)
      + CASE WHEN event_id % 4 = 0 THEN 300 ELSE 0 END AS eta FROM chords"""))
def _(spark, sf_dir):
    k = F.col("event_id")
    known = F.when(k % 10 != 0, F.col("latitude"))
    return _to_centroid(spark, sf_dir).select("event_id", geo.eta_seconds(
        known, F.col("longitude"), F.col("c_lat"), F.col("c_lon"), F.col("speed"),
        k % 4 == 0).alias("eta"))


# --- quality -------------------------------------------------------------------------------

_NYC_COLUMNS = [
    "tpep_pickup_datetime", "tpep_dropoff_datetime", "PULocationID", "DOLocationID", "passenger_count",
    "trip_distance", "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
    "improvement_surcharge", "total_amount", "congestion_surcharge", "airport_fee"]


@query("dq_null_counts", with_tables("nyc_trips", "SELECT " + ", ".join(
    f"count(*) - count({c}) AS {c}" for c in _NYC_COLUMNS) + " FROM nyc_trips"))
def _(spark, sf_dir):
    return quality.null_counts(fx.nyc_trips(spark, sf_dir))


@query("dq_null_pct", with_tables("nyc_trips", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) - count({c}) AS missing_values, "
    f"round((count(*) - count({c})) * 100::DOUBLE / count(*), 2) AS missing_pct FROM nyc_trips"
    for c in _NYC_COLUMNS)))
def _(spark, sf_dir):
    return quality.null_profile(fx.nyc_trips(spark, sf_dir))


@query("dq_missing_flag", with_tables("trip_history", f"""
    SELECT {_HISTORY} FROM trip_history WHERE MISSING_DATA = false"""))
def _(spark, sf_dir):
    return quality.keep_complete(fx.trip_history(spark, sf_dir))


@query("dq_dropped", with_tables("trip_history", """
    SELECT count(*) AS rows_before, count(*) FILTER (NOT MISSING_DATA) AS rows_after,
      count(*) - count(*) FILTER (NOT MISSING_DATA) AS rows_dropped FROM trip_history"""))
def _(spark, sf_dir):
    return quality.audit(fx.trip_history(spark, sf_dir), ~F.col("MISSING_DATA"))


@query("dq_sanity", with_tables("trip_history", """
    SELECT count(DISTINCT TAXI_ID) AS unique_taxis,
      strftime(make_timestamp(min("TIMESTAMP") * 1000000), '%Y-%m-%d %H:%M:%S') AS first_trip_date,
      strftime(make_timestamp(max("TIMESTAMP") * 1000000), '%Y-%m-%d %H:%M:%S') AS last_trip_date
    FROM trip_history WHERE NOT MISSING_DATA"""))
def _(spark, sf_dir):
    return quality.sanity(quality.keep_complete(fx.trip_history(spark, sf_dir)))


_MONEY = ["passenger_count", "trip_distance", "fare_amount", "extra", "mta_tax", "tip_amount",
          "tolls_amount", "improvement_surcharge", "total_amount", "congestion_surcharge"]


@query("dq_summary", with_tables("nyc_trips", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, min({c}) AS min_value, avg({c}) AS mean_value, "
    f"max({c}) AS max_value FROM nyc_trips" for c in _MONEY)))
def _(spark, sf_dir):
    return quality.numeric_summary(fx.nyc_trips(spark, sf_dir), _MONEY)


@query("dq_nyc_clean", with_tables("nyc_trips", """
    SELECT * EXCLUDE (airport_fee) REPLACE (coalesce(congestion_surcharge, 0.0::DOUBLE)
      AS congestion_surcharge) FROM nyc_trips
    WHERE passenger_count BETWEEN 1 AND 6 AND trip_distance > 0 AND trip_distance < 100
      AND fare_amount > 0 AND fare_amount < 500 AND extra >= 0 AND mta_tax >= 0
      AND tip_amount >= 0 AND tip_amount < 200 AND tolls_amount >= 0 AND tolls_amount < 100
      AND improvement_surcharge >= 0 AND total_amount > 0 AND total_amount < 600
      AND coalesce(congestion_surcharge, 0) >= 0
      AND tpep_pickup_datetime >= TIMESTAMP '2019-01-01'
      AND tpep_pickup_datetime < TIMESTAMP '2019-04-01'
      AND PULocationID IS NOT NULL AND DOLocationID IS NOT NULL"""))
def _(spark, sf_dir):
    return quality.clean_nyc(fx.nyc_trips(spark, sf_dir))


@query("dq_drop_nulls", with_tables("nyc_trips", """
    SELECT count(*) AS n FROM nyc_trips WHERE PULocationID IS NOT NULL
      AND DOLocationID IS NOT NULL"""))
def _(spark, sf_dir):
    return fx.nyc_trips(spark, sf_dir).dropna(subset=["PULocationID", "DOLocationID"]).agg(
        F.count("*").alias("n"))


@query("dq_duration", with_tables("nyc_trips", """
    SELECT * FROM (SELECT tpep_pickup_datetime, PULocationID, trip_distance,
      date_diff('second', tpep_pickup_datetime, tpep_dropoff_datetime) / 60 AS duration_min
      FROM nyc_trips) WHERE duration_min BETWEEN 1 AND 180 AND trip_distance > 0"""))
def _(spark, sf_dir):
    return quality.plausible_trips(fx.nyc_trips(spark, sf_dir)).select(
        "tpep_pickup_datetime", "PULocationID", "trip_distance", "duration_min")


@query("dq_dedupe", with_tables("trip_history", """
    SELECT TRIP_ID, TAXI_ID, "TIMESTAMP", POLYLINE FROM trip_history
    QUALIFY row_number() OVER (PARTITION BY TRIP_ID ORDER BY "TIMESTAMP", TAXI_ID, POLYLINE) = 1"""))
def _(spark, sf_dir):
    history = fx.trip_history(spark, sf_dir).select("TRIP_ID", "TAXI_ID", "TIMESTAMP", "POLYLINE")
    return quality.dedupe(history, ["TRIP_ID"], ["TIMESTAMP", "TAXI_ID"])


@query("dq_contract", with_tables("zone_pings", """
    SELECT event_id, CASE WHEN event_id % 41 = 7 THEN 'not an object' ELSE array_to_string(
      list_sort(list_filter([
        CASE WHEN event_id % 41 = 1 THEN 'maximum:zone_id' END,
        CASE WHEN event_id % 41 = 2 THEN 'enum:status' END,
        CASE WHEN event_id % 41 = 3 THEN 'unexpected:note' END,
        CASE WHEN event_id % 41 = 4 THEN 'required:speed_kmh' END,
        CASE WHEN event_id % 41 = 5 THEN 'const:schema_version' END,
        CASE WHEN event_id % 41 = 6 THEN 'type:taxi_id' END,
        CASE WHEN taxi_id < 1 THEN 'minimum:taxi_id' END], lambda x: x IS NOT NULL)), ',')
      END AS reasons FROM zone_pings"""))
def _(spark, sf_dir):
    checked = quality.validate(fx.contract_messages(spark, sf_dir), schemas.GPS_CONTRACT)
    return checked.select("event_id", F.array_join("reasons", ",").alias("reasons"))


@query("dq_schema_check", with_tables("slots", "SELECT zone_id, slot_ts, demand FROM slots"))
def _(spark, sf_dir):
    path = scratch_path(spark, "slots")
    files.write_table(
        features.slot_demand(fx.slot_trips(spark, sf_dir)).drop("slot_start"), path)
    return quality.assert_schema(
        files.read_table(spark, path), "zone_id int, slot_ts bigint, demand bigint")


@query("dq_sample", with_tables("trip_history", """
    SELECT TRIP_ID, "TIMESTAMP" FROM (SELECT TRIP_ID, "TIMESTAMP",
      (('0x' || substr(md5('42|sample|' || TRIP_ID), 1, 8))::BIGINT + 0.5::DOUBLE)
        / 4294967296::DOUBLE AS draw FROM trip_history WHERE fault <> 7 AND POLYLINE <> '[]')
    WHERE draw < 0.01::DOUBLE"""))
def _(spark, sf_dir):
    usable = fx.trip_history(spark, sf_dir).filter(
        F.col("POLYLINE").isNotNull() & (F.col("POLYLINE") != "[]"))
    return quality.sample_trips(usable).select("TRIP_ID", "TIMESTAMP")


# --- demand, indicators --------------------------------------------------------------------

@query("agg_window_demand", with_tables("demand_windows", "SELECT * FROM demand_windows"))
def _(spark, sf_dir):
    return demand.demand_windows(fx.supply_and_demand(spark, sf_dir))


@query("agg_cell_trips", with_tables("trips_curated", """
    SELECT hex_cell AS pickup_hex, count(*) AS total_trips FROM trips_curated GROUP BY hex_cell"""))
def _(spark, sf_dir):
    return kpi.trips_per_cell(
        fx.trips_curated(spark, sf_dir).withColumnRenamed("hex_cell", "pickup_hex"))


@query("agg_peak_hours", with_tables("slot_trips", """
    SELECT hour(trip_start)::INTEGER AS hour, count(*) AS trip_count FROM slot_trips
    GROUP BY ALL"""))
def _(spark, sf_dir):
    return kpi.peak_hours(fx.slot_trips(spark, sf_dir))


@query("kpi_serving_batch", with_tables("trips_curated", f"""
    SELECT '{CITY}' AS city, zone_id, {fx.START}::BIGINT AS window_start,
      count(*)::INTEGER AS active_vehicles, 0 AS pending_requests, 1.0::DOUBLE AS ratio
    FROM trips_curated GROUP BY zone_id"""))
def _(spark, sf_dir):
    per_zone = kpi.trips_per_cell(fx.trips_curated(spark, sf_dir), "zone_id")
    return kpi.to_demand_rows(per_zone, CITY, fx.START, "zone_id")


@query("kpi_weekly_trips", with_tables("weekly", "SELECT * FROM weekly"))
def _(spark, sf_dir):
    return kpi.weekly_trips(fx.trips_curated(spark, sf_dir))


@query("kpi_weekly_duration", with_tables("trips_curated", """
    SELECT date_trunc('week', trip_start)::TIMESTAMP AS week_start, zone_id,
      round(avg(duration_sec) / 60, 1) AS avg_duration_min
    FROM trips_curated WHERE duration_sec > 0 GROUP BY ALL"""))
def _(spark, sf_dir):
    return kpi.weekly_duration(fx.trips_curated(spark, sf_dir))


_PEAKS = """SELECT * FROM (SELECT *, (row_number() OVER (PARTITION BY week_start
    ORDER BY trip_count DESC, hour_of_day))::INTEGER AS rank FROM (
      SELECT date_trunc('week', {ts})::TIMESTAMP AS week_start, hour({ts})::INTEGER
        AS hour_of_day, count(*) AS trip_count FROM {table} GROUP BY ALL)) WHERE rank <= 3"""


@query("kpi_weekly_peak", with_tables("trips_curated", _PEAKS.format(
    ts="trip_start", table="trips_curated")))
def _(spark, sf_dir):
    return kpi.weekly_peak_hours(fx.trips_curated(spark, sf_dir))


@query("win_rank_top3", with_tables("nyc_trips", _PEAKS.format(
    ts="tpep_pickup_datetime", table="nyc_trips")))
def _(spark, sf_dir):
    return kpi.weekly_peak_hours(
        fx.nyc_trips(spark, sf_dir).withColumnRenamed("tpep_pickup_datetime", "trip_start"))


@query("kpi_coverage_gap", with_tables("weekly", "SELECT * FROM weekly WHERE unique_taxis < 2"))
def _(spark, sf_dir):
    return kpi.coverage_gap(kpi.weekly_trips(fx.trips_curated(spark, sf_dir)))


@query("kpi_weekly_serving", with_tables("weekly", f"""
    SELECT '{CITY}' AS city, zone_id, epoch_ms(week_start) AS window_start,
      unique_taxis::INTEGER AS active_vehicles, total_trips::INTEGER AS pending_requests,
      total_trips / greatest(unique_taxis, 1)::DOUBLE AS ratio FROM weekly"""))
def _(spark, sf_dir):
    return kpi.weekly_to_demand(kpi.weekly_trips(fx.trips_curated(spark, sf_dir)), CITY)


@query("agg_nyc_hourly", with_tables("nyc_trips", _HOURLY))
def _(spark, sf_dir):
    return kpi.nyc_hourly(fx.nyc_trips(spark, sf_dir))


# --- features ------------------------------------------------------------------------------

def _slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.slot_demand(fx.slot_trips(spark, sf_dir))


def _matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.feature_matrix(fx.slot_trips(spark, sf_dir))


def _parts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Training and test rows; the matrix is written once, as the split reads it several times."""
    return features.temporal_split(settle(_matrix(spark, sf_dir), "matrix"))


@query("agg_slot_demand", with_tables("slots", "SELECT * FROM slots"))
def _(spark, sf_dir):
    return _slots(spark, sf_dir)


@query("agg_months", with_tables("trip_history", """
    SELECT DISTINCT strftime(make_timestamp("TIMESTAMP" * 1000000), '%Y-%m') AS year_month
    FROM trip_history"""))
def _(spark, sf_dir):
    return features.months(trips.add_times(fx.trip_history(spark, sf_dir)))


@query("ml_temporal", with_tables("features", """
    SELECT zone_id, slot_start, slot_date, hour_of_day, day_of_week, is_weekend, is_friday
    FROM features"""))
def _(spark, sf_dir):
    return features.add_temporal(_slots(spark, sf_dir)).drop("slot_ts", "demand")


@query("ml_weather", with_tables("slots", """
    SELECT zone_id, slot_ts, demand, CASE WHEN slot_ts // 1800 % 5 = 0 THEN 1 ELSE 0 END
      AS is_raining FROM slots"""))
def _(spark, sf_dir):
    slots = _slots(spark, sf_dir).drop("slot_start")
    wet = slots.filter(F.col("slot_ts") % 9000 == 0).select(
        "zone_id", "slot_ts", F.lit(1).alias("is_raining"))
    return features.add_weather(slots, wet)


@query("join_lag", with_tables("features", """
    SELECT zone_id, slot_ts, slot_start, demand, demand_lag_1d, demand_lag_7d FROM features"""))
def _(spark, sf_dir):
    return features.add_lags(_slots(spark, sf_dir))


@query("win_rolling_7d", with_tables("features", """
    SELECT zone_id, slot_ts, slot_start, demand, rolling_7d_mean FROM features"""))
def _(spark, sf_dir):
    return features.add_rolling(_slots(spark, sf_dir))


@query("ml_lags", with_tables("features", """
    SELECT zone_id, slot_ts, demand_lag_1d, demand_lag_7d FROM features"""))
def _(spark, sf_dir):
    """The lags of ``join_lag`` without a join, as the feature matrix takes them."""
    return features.add_history(_slots(spark, sf_dir)).select(
        "zone_id", "slot_ts", "demand_lag_1d", "demand_lag_7d")


@query("ml_rolling", with_tables("features", """
    SELECT zone_id, slot_ts, rolling_7d_mean FROM features"""))
def _(spark, sf_dir):
    return features.add_history(_slots(spark, sf_dir)).select(
        "zone_id", "slot_ts", "rolling_7d_mean")


@query("ml_matrix", with_tables("features", "SELECT * FROM features"))
def _(spark, sf_dir):
    return _matrix(spark, sf_dir)


@query("agg_date_range", with_tables("features", """
    SELECT min(slot_date) AS min_date, max(slot_date) AS max_date FROM features"""))
def _(spark, sf_dir):
    return features.date_range(features.add_temporal(_slots(spark, sf_dir)))


@query("ml_split", with_tables("split_at", """
    SELECT zone_id, slot_ts, CASE WHEN slot_date < cutoff THEN 'train' ELSE 'test' END AS part
    FROM features, split_at"""))
def _(spark, sf_dir):
    train, test = _parts(spark, sf_dir)
    return train.select("zone_id", "slot_ts", F.lit("train").alias("part")).unionAll(
        test.select("zone_id", "slot_ts", F.lit("test")))


_TEST = "test AS (SELECT * FROM features, split_at WHERE slot_date >= cutoff)"


@query("ml_baseline", with_tables("split_at", "").rstrip() + f""", {_TEST}
    SELECT zone_id, slot_ts, demand, demand_lag_7d::DOUBLE AS prediction FROM test
    WHERE demand_lag_7d > 0 OR (SELECT count(*) FROM test WHERE demand_lag_7d > 0) = 0""")
def _(spark, sf_dir):
    _, test = _parts(spark, sf_dir)
    return features.baseline(test).select("zone_id", "slot_ts", "demand", "prediction")


@query("agg_zone_rmse", with_tables("split_at", "").rstrip() + f""", {_TEST}
    SELECT zone_id, sqrt(avg((demand_lag_7d - demand) ** 2)) AS rmse, count(*) AS n_slots
    FROM test WHERE demand_lag_7d > 0 GROUP BY zone_id""")
def _(spark, sf_dir):
    _, test = _parts(spark, sf_dir)
    return features.rmse_by_zone(features.baseline(test))


@query("join_zone_metrics", with_tables("split_at", "").rstrip() + f""", {_TEST},
    a AS (SELECT zone_id, round(sqrt(avg((rolling_7d_mean - demand) ** 2)), 6) AS rmse_gbt,
      count(*) AS n_slots FROM test GROUP BY zone_id),
    b AS (SELECT zone_id, round(sqrt(avg((demand_lag_7d - demand) ** 2)), 6) AS rmse_baseline
      FROM test WHERE demand_lag_7d > 0 GROUP BY zone_id)
    SELECT a.zone_id, rmse_gbt, n_slots, rmse_baseline FROM a LEFT JOIN b USING (zone_id)""")
def _(spark, sf_dir):
    """The rolling mean stands in for the model, so that the join can be checked in SQL."""
    _, test = _parts(spark, sf_dir)
    mean = test.withColumn("prediction", F.col("rolling_7d_mean"))
    return features.compare_by_zone(mean, features.baseline(test)).withColumns({
        "rmse_gbt": F.round("rmse_gbt", 6), "rmse_baseline": F.round("rmse_baseline", 6)})


@query("ml_cast", with_tables("features", "SELECT zone_id::DOUBLE AS zone_id, " + ", ".join(
    f"{c}::DOUBLE AS {c}" for c in features.FEATURES[1:]) + ", demand::DOUBLE AS demand "
    "FROM features"))
def _(spark, sf_dir):
    return features.cast_numeric(_matrix(spark, sf_dir)).select(
        *features.FEATURES, features.TARGET)


# --- plain relational operators ------------------------------------------------------------

@query("sort_desc", with_tables("weekly", "SELECT week_start, zone_id, total_trips FROM weekly"))
def _(spark, sf_dir):
    return kpi.weekly_trips(fx.trips_curated(spark, sf_dir)).select(
        "week_start", "zone_id", "total_trips")


@query("limit_n", with_tables("slot_trips", """
    SELECT trip_start, zone_id FROM slot_trips ORDER BY trip_start DESC, zone_id LIMIT 100"""))
def _(spark, sf_dir):
    return fx.slot_trips(spark, sf_dir).orderBy(F.desc("trip_start"), "zone_id").limit(100) \
        .select("trip_start", "zone_id")


@query("set_union", with_tables("supply_and_demand", """
    SELECT kind, zone_id, event_time, entity_id FROM supply_and_demand"""))
def _(spark, sf_dir):
    return fx.supply_and_demand(spark, sf_dir).select("kind", "zone_id", "event_time", "entity_id")


@query("set_distinct", with_tables("trips_curated", """
    SELECT DISTINCT zone_id, taxi_id FROM trips_curated"""))
def _(spark, sf_dir):
    return fx.trips_curated(spark, sf_dir).select("zone_id", "taxi_id").distinct()


@query("join_left_key", with_tables("trips_curated", """
    SELECT trip_id, zone_id, hex_cell FROM trips_curated"""))
def _(spark, sf_dir):
    """Cells worked out from the positions of all pings, joined to the trips by id."""
    curated = fx.trips_curated(spark, sf_dir)
    located = fx.raw_pings(spark, sf_dir).select(
        F.col("event_id").cast("string").alias("trip_id"), "latitude", "longitude")
    cells = with_hex_cell(located, "hex_cell", "latitude", "longitude").select(
        "trip_id", "hex_cell")
    return curated.select("trip_id", "zone_id").join(cells, "trip_id", "left")


@query("etl_curated_ends", with_tables("mapped", "").rstrip() + f""",
    e AS (SELECT k, TRIP_ID, min_by(new_lon, vertex) AS pickup_lon,
      min_by(new_lat, vertex) AS pickup_lat, max_by(new_lon, vertex) AS dropoff_lon,
      max_by(new_lat, vertex) AS dropoff_lat FROM mapped GROUP BY k, TRIP_ID)
    SELECT TRIP_ID, round(pickup_lon, 9) AS pickup_lon, round(pickup_lat, 9) AS pickup_lat,
      round(dropoff_lon, 9) AS dropoff_lon, round(dropoff_lat, 9) AS dropoff_lat,
      {hex_sql('pickup_lat', 'pickup_lon')} AS pickup_hex,
      {hex_sql('dropoff_lat', 'dropoff_lon')} AS dropoff_hex FROM e""")
def _(spark, sf_dir):
    ends = trips.curate_ends(_remapped(spark, sf_dir))
    return ends.select("TRIP_ID", *[
        F.round(c, 9).alias(c) for c in ("pickup_lon", "pickup_lat", "dropoff_lon", "dropoff_lat")],
        "pickup_hex", "dropoff_hex")


@query("etl_curated_trips", with_tables("mapped", "").rstrip() + f""",
    starts AS (SELECT TRIP_ID AS trip_id, TAXI_ID AS taxi_id,
      make_timestamp("TIMESTAMP" * 1000000) AS trip_start, min_by(new_lat, vertex) AS latitude,
      min_by(new_lon, vertex) AS longitude, (count(*) - 1) * 15 AS duration_sec
      FROM mapped GROUP BY k, TRIP_ID, TAXI_ID, "TIMESTAMP"),
    uniq AS (SELECT * FROM starts QUALIFY row_number() OVER (
      PARTITION BY trip_id ORDER BY trip_start, taxi_id) = 1)
    SELECT * FROM (SELECT trip_id, taxi_id, trip_start, round(latitude, 9) AS latitude,
      round(longitude, 9) AS longitude, duration_sec, {fx._ZONE_CASE} AS zone_id,
      strftime(trip_start, '%Y-%m') AS year_month FROM uniq) WHERE zone_id <> 99""")
def _(spark, sf_dir):
    return trips.curate_trips(_remapped(spark, sf_dir)).drop("hex_cell").withColumns({
        "latitude": F.round("latitude", 9), "longitude": F.round("longitude", 9)})
