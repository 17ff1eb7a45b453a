"""The mobility tables, derived from the given tables row by row.

Every adapter is integer arithmetic (or a division of two integers), so that Spark and the
checking SQL derive the very same values. ``SQL`` holds the same adapters as common table
expressions; ``with_tables`` puts the needed ones in front of a query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from wayfare.functions.frames import computed_once
from wayfare.functions import hexagons
from wayfare.functions.times import seconds_to_timestamp
from wayfare.operators.pings import normalise
from wayfare.session import prepare
from wayfare.sources.files import read_table
from wayfare.zones import ZONES

CITY = "Casablanca"
START = 1_704_067_200  # 2024-01-01, first day of the events table
SQUEEZE = 240          # thirty days of events become three hours of pings
GRID = 25              # road nodes per row of the grid


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(prepare(spark), f"{sf_dir.rstrip('/')}/{name}.parquet")


def _squeezed(ts):
    # floor division; the events start at START, so the dividend is never negative
    return (F.lit(START) + F.floor((F.unix_timestamp(ts) - START) / SQUEEZE)).cast("bigint")


def _pings(spark: SparkSession, sf_dir: str) -> DataFrame:
    # computed once, as if the position were stored in the table
    e = computed_once(
        table(spark, sf_dir, "events"),
        latitude=(F.col("event_id") * 7919 % 3500 + 333_800) / 10_000.0,
        longitude=(F.col("event_id") * 104_729 % 4500 - 78_200) / 10_000.0)
    return e.select(
        "ts", "event_id", F.col("user_id").cast("int").alias("taxi_id"),
        _squeezed("ts").alias("event_time"), "latitude", "longitude",
        F.col("value").alias("speed"),
        F.when(F.col("event_type") == "purchase", "ASSIGNED")
        .when(F.col("event_type") == "error", "OFFLINE").otherwise("AVAILABLE").alias("status"))


def raw_pings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pings(spark, sf_dir).drop("ts")


def zone_pings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalise(raw_pings(spark, sf_dir))


def trip_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").filter(F.col("event_type") == "purchase")
    return e.select(
        F.col("event_id").cast("string").alias("trip_id"),
        F.col("user_id").cast("int").alias("rider_id"),
        (F.col("event_id") % 16 + 1).cast("int").alias("origin_zone"),
        (F.col("event_id") * 7 % 16 + 1).cast("int").alias("destination_zone"),
        _squeezed("ts").alias("requested_at"),
        F.when(F.col("event_id") % 3 == 0, "A").when(F.col("event_id") % 3 == 1, "B")
        .otherwise("C").alias("call_type"))


def supply_and_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pings and requests as rows of one shape, as both parsers give them."""
    from wayfare.functions.times import event_timestamp

    vehicles = zone_pings(spark, sf_dir).select(
        F.lit("vehicle").alias("kind"), "zone_id", "event_time",
        F.col("taxi_id").cast("string").alias("entity_id"))
    trips = trip_requests(spark, sf_dir).select(
        F.lit("trip").alias("kind"), F.col("origin_zone").alias("zone_id"),
        F.col("requested_at").alias("event_time"), F.col("trip_id").alias("entity_id"))
    return vehicles.unionByName(trips).select(
        F.lit(CITY).alias("city"), "*", event_timestamp(F.col("event_time"), "s").alias("event_ts"))


def slot_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        (F.col("user_id") % 4 + 1).cast("int").alias("zone_id"), F.col("ts").alias("trip_start"))


def nyc_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    order, part, supp, line = (F.col(f"l_{c}") for c in
                               ("orderkey", "partkey", "suppkey", "linenumber"))
    pickup = (F.lit(1_546_300_800) + order % 95 * 86_400 + (order * 37 + line * 11) % 1440 * 60)

    def money(c):
        return c.cast("double")

    fare = money(F.floor("l_extendedprice") % 2400) / 4
    extra, tip, tolls = (money(part % 11 - 1) / 2, money(order % 420) / 2, money(part % 205) / 2)
    return li.select(
        seconds_to_timestamp(pickup).alias("tpep_pickup_datetime"),
        seconds_to_timestamp(pickup + part % 200 * 60).alias("tpep_dropoff_datetime"),
        F.when((order + line) % 89 != 0, (supp % 10 + 1).cast("int")).alias("PULocationID"),
        F.when(part % 97 != 0, (part % 265 + 1).cast("int")).alias("DOLocationID"),
        F.when(order % 101 != 0, money(line % 8)).alias("passenger_count"),
        (F.col("l_quantity") - 1).alias("trip_distance"),
        fare.alias("fare_amount"), extra.alias("extra"),
        F.when(supp % 50 == 0, -0.5).otherwise(0.5).alias("mta_tax"),
        tip.alias("tip_amount"), tolls.alias("tolls_amount"),
        F.when(part % 61 == 0, -0.25).otherwise(0.25).alias("improvement_surcharge"),
        (fare + extra + tip + tolls).alias("total_amount"),
        F.when(order % 7 == 0, None).when(part % 53 == 0, -2.5).otherwise(2.5)
        .alias("congestion_surcharge"),
        F.when(order % 5 == 0, 1.25).alias("airport_fee"))


def trips_curated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every ping inside a zone as the start of a trip, at the event's own time."""
    from wayfare.functions.times import year_month
    from wayfare.operators.pings import assign_zone, drop_outside, valid_pings

    placed = drop_outside(assign_zone(valid_pings(_pings(spark, sf_dir))))
    return hexagons.with_hex_cell(placed, "hex_cell", "latitude", "longitude").select(
        F.col("event_id").cast("string").alias("trip_id"), "taxi_id",
        F.col("ts").alias("trip_start"), "latitude", "longitude",
        F.floor(F.col("speed") * 60).alias("duration_sec"),
        "hex_cell",
        "zone_id", year_month(F.col("ts")).alias("year_month"))


def trip_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw trip history with polylines of 0 to 11 vertices, repeats and malformed text."""
    e = table(spark, sf_dir, "events")
    k = F.col("event_id")
    lon = lambda j: k * 31 + j * 53
    lat = lambda j: k * 17 + j * 29

    def place(whole, places_before):
        # 4-digit decimals as text, without going through a double
        return F.concat(F.lit(places_before), F.lpad(whole.cast("string"), 4, "0"))

    vertices = F.transform(
        F.sequence(F.lit(1), (k % 12).cast("int")),
        lambda j: F.concat(
            F.lit("["), place(7500 - lon(j) % 1800, "-8."), F.lit(", "),
            place(lat(j) % 2100, "41."), F.lit("]")))
    text = F.when(k % 12 == 0, "[]").otherwise(
        F.concat(F.lit("["), F.array_join(vertices, ", "), F.lit("]")))
    return computed_once(e, polyline=text).select(
        F.when(k % 20 == 7, k - 1).otherwise(k).cast("string").alias("TRIP_ID"),
        F.when(k % 3 == 0, "A").when(k % 3 == 1, "B").otherwise("C").alias("CALL_TYPE"),
        F.when(k % 3 == 0, (k % 1000).cast("int")).alias("ORIGIN_CALL"),
        F.when(k % 3 == 1, (k % 64).cast("int")).alias("ORIGIN_STAND"),
        F.col("user_id").cast("int").alias("TAXI_ID"),
        F.unix_timestamp("ts").alias("TIMESTAMP"),
        F.lit("A").alias("DAY_TYPE"),
        F.when(k % 71 != 3, k % 50 == 1).alias("MISSING_DATA"),
        F.when(k % 97 == 5, "oops").when(k % 97 == 6, "[[-8.6]]").when(k % 97 == 7, None)
        .otherwise(F.col("polyline")).alias("POLYLINE"))


def nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(
        i.alias("node_id"), ((i % GRID * 100 - 76_500) / 10_000.0).alias("x"),
        ((F.floor(i / GRID) * 100 + 335_200) / 10_000.0).alias("y"))


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roads to the right and lower neighbour, both ways, where that node exists."""
    i = F.col("s_suppkey")
    start = table(spark, sf_dir, "supplier").select(
        i.alias("a"), F.explode(F.when(i % GRID < GRID - 1, F.array(i + 1, i + GRID))
                                .otherwise(F.array(i + GRID))).alias("b"))
    there = table(spark, sf_dir, "supplier").select(i.alias("b"))
    road = start.join(there, "b", "left_semi").select(
        "a", "b", (F.col("a") * 37 % 50 + F.col("b") * 13 % 30 + 100).cast("double").alias("length"),
        F.when(F.col("a") % 29 == 28, "motorway").when(F.col("a") % 31 == 30, "trunk_link")
        .otherwise("residential").alias("highway"),
        F.when(F.col("b") % 37 == 36, "yes").otherwise("no").alias("area"))
    back = road.select(F.col("b").alias("a"), F.col("a").alias("b"), "length", "highway", "area")
    return road.unionAll(back).withColumnsRenamed({"a": "src", "b": "dst"})


def gps_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ping messages, some malformed or with numbers in an unusual form."""
    fault = F.col("event_id") % 97
    taxi = F.col("taxi_id").cast("string")

    def message(taxi_id, timestamp="event_time", speed="speed"):
        def col(c):
            return F.col(c) if isinstance(c, str) else c
        return F.to_json(F.struct(
            taxi_id.alias("taxi_id"), col(timestamp).alias("timestamp"), F.col("latitude"),
            F.col("longitude"), col(speed).alias("speed"), F.col("status")))

    value = (
        F.when(fault == 5, "not json")
        .when(fault == 6, F.to_json(F.struct("taxi_id")))
        .when(fault == 7, message(taxi))
        .when(fault == 8, message(F.col("taxi_id") + F.lit(0.5)))
        .when(fault == 9, message(F.col("taxi_id"), speed=F.lit(None).cast("double")))
        .when(fault == 10, message(F.col("taxi_id"), timestamp=F.lit("soon")))
        .otherwise(message(F.col("taxi_id"))))
    return computed_once(raw_pings(spark, sf_dir), value=value).select("event_id", "value")


def normalised_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalised ping messages; every thirteenth has no status."""
    from wayfare.functions.messages import to_event_json
    from wayfare.operators.pings import as_normalised_event

    pings = as_normalised_event(zone_pings(spark, sf_dir)).withColumn(
        "status", F.when(F.col("event_id") % 13 != 0, F.col("status")))
    return computed_once(
        to_event_json(pings, "gps", F.col("event_time") + 2), value=F.col("value"))


def trip_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Request messages: some times in milliseconds, some rider ids with a prefix or no number."""
    k = F.col("trip_id").cast("bigint")
    rider = F.when(k % 5 == 0, F.concat(F.lit("RIDER-SPIKE-"), F.col("rider_id"))).when(
        k % 11 == 0, "x").otherwise(F.col("rider_id").cast("string"))
    text = F.to_json(F.struct(
        "trip_id", rider.alias("rider_id"), "origin_zone", "destination_zone",
        F.when(k % 2 == 0, F.col("requested_at") * 1000).otherwise(F.col("requested_at"))
        .alias("requested_at"), "call_type"))
    return computed_once(
        trip_requests(spark, sf_dir), value=F.when(k % 97 == 5, "not json").otherwise(text)
    ).select("value")


def contract_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalised ping messages of which some break the contract."""
    fault = F.col("event_id") % 41
    fields = [
        F.when(fault == 5, "2.0.0").otherwise("1.0.0").alias("schema_version"),
        F.lit("GPS_NORMALIZED").alias("event_type"), F.col("event_time"),
        (F.col("event_time") + 2).alias("ingested_at"),
        F.col("taxi_id"), F.when(fault == 1, 17).otherwise(F.col("zone_id")).alias("zone_id"),
        F.col("zone_name"), F.col("latitude").alias("centroid_lat"),
        F.col("longitude").alias("centroid_lon"),
        F.when(fault != 4, F.col("speed")).alias("speed_kmh"),
        F.when(fault == 2, "EN_ROUTE").otherwise(F.col("status")).alias("status"),
        F.when(fault == 3, "x").alias("note"),
    ]
    text = F.to_json(F.struct(*fields))
    quoted = F.regexp_replace(text, '"taxi_id":([0-9]+)', '"taxi_id":"$1"')
    return computed_once(
        zone_pings(spark, sf_dir),
        value=F.when(fault == 7, "not json").when(fault == 6, quoted).otherwise(text)
    ).select("event_id", "value")


# The same tables for the checking SQL.

_ZONE_CASE = "CASE " + " ".join(
    f"WHEN latitude BETWEEN {z.min_lat!r}::DOUBLE AND {z.max_lat!r}::DOUBLE AND longitude "
    f"BETWEEN {z.min_lon!r}::DOUBLE AND {z.max_lon!r}::DOUBLE THEN {z.zone_id}"
    for z in ZONES) + " ELSE 99 END"

_SQUEEZED = f"{START} + (epoch_us(ts)//1000000 - {START})//{SQUEEZE}"


def hex_sql(lat: str, lon: str, resolution: int = 8) -> str:
    """The cell's id as a scalar subquery: one nested SELECT for each coarser grid."""
    import math

    frames = hexagons.faces()
    dots = ", ".join("x * {!r} + y * {!r} + z * {!r}".format(*centre) for centre, _, _ in frames)

    def along(axis: int) -> str:
        return " + ".join(
            f"{name} * ([{', '.join(repr(frame[axis][n]) for frame in frames)}]::DOUBLE[])[face]"
            for n, name in enumerate("xyz"))

    tilt = hexagons.TILT if resolution % 2 else 0.0
    scale = math.sqrt(7.0) ** resolution / hexagons.UNIT
    sine, cosine, third = (repr(n) + "::DOUBLE" for n in (
        math.sin(tilt), math.cos(tilt), 1 / math.sqrt(3.0)))
    q = f"""SELECT cos(radians({lat})) * cos(radians({lon})) AS x,
        cos(radians({lat})) * sin(radians({lon})) AS y, sin(radians({lat})) AS z"""
    q = f"SELECT x, y, z, [{dots}]::DOUBLE[] AS dots FROM ({q})"
    q = f"SELECT x, y, z, list_max(dots) AS near, list_position(dots, list_max(dots)) AS face FROM ({q})"
    q = f"""SELECT face, ({along(1)}) / near * {scale!r}::DOUBLE AS u,
        ({along(2)}) / near * {scale!r}::DOUBLE AS v FROM ({q})"""
    q = f"SELECT face, u * {cosine} + v * {sine} AS u, v * {cosine} - u * {sine} AS v FROM ({q})"
    q = f"SELECT face, u + v * {third} AS p, 2 * v * {third} AS q FROM ({q})"
    q = f"""SELECT face, p, q, floor(p + 0.5::DOUBLE)::BIGINT AS np,
        floor(q + 0.5::DOUBLE)::BIGINT AS nq, floor(q - p + 0.5::DOUBLE)::BIGINT AS nr FROM ({q})"""
    q = f"""SELECT face, np, nq, nr, abs(np - p) AS o_p, abs(nq - q) AS o_q,
        abs(nr - (q - p)) AS o_r FROM ({q})"""
    q = f"""SELECT face, CASE WHEN o_p > o_q AND o_p > o_r THEN nq - nr ELSE np END AS a,
        CASE WHEN o_p > o_q AND o_p > o_r THEN nq WHEN o_q > o_r THEN np + nr ELSE nq END AS b,
        '' AS d FROM ({q})"""
    for level in range(resolution, 0, -1):
        up, down = ((("3 * a - b", "a + 2 * b"), ("2 * ua + ub", "3 * ub - ua")) if level % 2 else
                    (("2 * a + b", "3 * b - a"), ("3 * ua - ub", "ua + 2 * ub")))
        q = f"""SELECT *, round(({up[0]}) / 7::DOUBLE)::BIGINT AS ua,
            round(({up[1]}) / 7::DOUBLE)::BIGINT AS ub FROM ({q})"""
        q = f"SELECT face, d, ua, ub, a - ({down[0]}) AS da, b - ({down[1]}) AS db FROM ({q})"
        q = f"""SELECT face, ua AS a, ub AS b, CASE WHEN da = 0 AND db = 0 THEN '0'
            WHEN da = -1 AND db = -1 THEN '1' WHEN da = 0 AND db = 1 THEN '2'
            WHEN da = -1 AND db = 0 THEN '3' WHEN da = 1 AND db = 0 THEN '4'
            WHEN da = 0 AND db = -1 THEN '5' WHEN da = 1 AND db = 1 THEN '6' END || d AS d
            FROM ({q})"""
    q = f"""SELECT d, {hexagons.lookup_table()!r}[
        ((face - 1) * 5 + a + 2) * 5 + b + 3] AS e FROM ({q})"""
    q = f"""SELECT e, d, substr(e, 4 + CASE WHEN ltrim(d, '0') = '' THEN 0
        ELSE ltrim(d, '0')[1]::INTEGER END, 1)::INTEGER AS turn FROM ({q})"""
    q = f"""SELECT e[1:3] || translate(d, '{hexagons.TURN}',
        substr('{hexagons.TURN * 2}', turn + 1, 6)) || '{"7" * (15 - resolution)}' AS o FROM ({q})"""
    code = " + ".join(f"o[{n + 1}]::BIGINT * {8 ** (17 - n)}" for n in range(18))
    return f"(SELECT '8{resolution:x}' || lpad(lower(to_hex({code})), 13, '0') FROM ({q}))"


SQL = {
    "zones": "SELECT * FROM (VALUES " + ", ".join(
        f"({z.zone_id}, '{z.zone_name.replace(chr(39), chr(39) * 2)}', {z.min_lat!r}::DOUBLE, "
        f"{z.max_lat!r}::DOUBLE, {z.min_lon!r}::DOUBLE, {z.max_lon!r}::DOUBLE, "
        f"{z.centroid_lat!r}::DOUBLE, {z.centroid_lon!r}::DOUBLE)" for z in ZONES)
    + ") AS z(zone_id, zone_name, min_lat, max_lat, min_lon, max_lon, centroid_lat, centroid_lon)",
    "raw_pings": f"""
        SELECT event_id, user_id::INTEGER AS taxi_id, {_SQUEEZED} AS event_time,
          (event_id * 7919 % 3500 + 333800) / 10000::DOUBLE AS latitude,
          (event_id * 104729 % 4500 - 78200) / 10000::DOUBLE AS longitude, value AS speed,
          CASE event_type WHEN 'purchase' THEN 'ASSIGNED' WHEN 'error' THEN 'OFFLINE'
            ELSE 'AVAILABLE' END AS status, ts FROM events""",
    "valid": """
        SELECT * FROM raw_pings WHERE speed <= 150 AND latitude BETWEEN 33.4::DOUBLE AND
          33.7::DOUBLE AND longitude BETWEEN -7.8::DOUBLE AND -7.4::DOUBLE""",
    "placed": f"SELECT *, {_ZONE_CASE} AS zone_id FROM valid",
    "zone_pings": """
        SELECT p.event_id, p.taxi_id, p.event_time, z.centroid_lat AS latitude,
          z.centroid_lon AS longitude, p.speed, p.status, p.zone_id, z.zone_name
        FROM placed p JOIN zones z USING (zone_id)""",
    "trip_requests": f"""
        SELECT event_id::VARCHAR AS trip_id, user_id::INTEGER AS rider_id,
          (event_id % 16 + 1)::INTEGER AS origin_zone,
          (event_id * 7 % 16 + 1)::INTEGER AS destination_zone, {_SQUEEZED} AS requested_at,
          CASE event_id % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'B' ELSE 'C' END AS call_type
        FROM events WHERE event_type = 'purchase'""",
    "supply_and_demand": """
        SELECT 'vehicle' AS kind, zone_id, event_time, taxi_id::VARCHAR AS entity_id
          FROM zone_pings
        UNION ALL SELECT 'trip', origin_zone, requested_at, trip_id FROM trip_requests""",
    "demand_windows": f"""
        SELECT '{CITY}' AS city, zone_id, event_time // 30 * 30000 AS window_start,
          (count(DISTINCT entity_id) FILTER (kind = 'vehicle'))::INTEGER AS active_vehicles,
          (count(DISTINCT entity_id) FILTER (kind = 'trip'))::INTEGER AS pending_requests,
          (count(DISTINCT entity_id) FILTER (kind = 'trip')) / greatest(
            count(DISTINCT entity_id) FILTER (kind = 'vehicle'), 1)::DOUBLE AS ratio
        FROM supply_and_demand GROUP BY zone_id, event_time // 30""",
    "slot_trips": "SELECT (user_id % 4 + 1)::INTEGER AS zone_id, ts AS trip_start FROM events",
    "slots": """
        SELECT zone_id, make_timestamp(e * 1000000) AS slot_start, e AS slot_ts, demand FROM (
          SELECT zone_id, epoch_us(trip_start) // 1800000000 * 1800 AS e, count(*) AS demand
          FROM slot_trips GROUP BY ALL)""",
    "features": """
        SELECT a.zone_id, a.slot_start, a.slot_start::DATE AS slot_date, a.slot_ts,
          hour(a.slot_start)::INTEGER AS hour_of_day,
          (dayofweek(a.slot_start) + 1)::INTEGER AS day_of_week,
          (dayofweek(a.slot_start) IN (0, 6))::INTEGER AS is_weekend,
          (dayofweek(a.slot_start) = 5)::INTEGER AS is_friday, 0 AS is_raining, a.demand,
          coalesce(d.demand, 0) AS demand_lag_1d, coalesce(w.demand, 0) AS demand_lag_7d,
          coalesce(avg(a.demand) OVER (PARTITION BY a.zone_id ORDER BY a.slot_ts
            RANGE BETWEEN 604800 PRECEDING AND 1 PRECEDING), 0.0) AS rolling_7d_mean
        FROM slots a
        LEFT JOIN slots d ON d.zone_id = a.zone_id AND d.slot_ts = a.slot_ts - 86400
        LEFT JOIN slots w ON w.zone_id = a.zone_id AND w.slot_ts = a.slot_ts - 604800""",
    "split_at": """
        SELECT CASE WHEN hi - lo < 30 THEN (lo + greatest(1, (hi - lo) // 2)::INTEGER)::DATE
          ELSE (lo + INTERVAL 10 MONTH)::DATE END AS cutoff
        FROM (SELECT min(slot_date) AS lo, max(slot_date) AS hi FROM features)""",
    "nyc_base": """
        SELECT 1546300800 + l_orderkey % 95 * 86400 + (l_orderkey * 37 + l_linenumber * 11)
            % 1440 * 60 AS pickup, (l_orderkey * 1) AS o, l_partkey AS p, l_suppkey AS s,
          l_linenumber AS l, l_quantity AS q, (floor(l_extendedprice)::BIGINT % 2400)
            / 4::DOUBLE AS fare FROM lineitem""",
    "nyc_trips": """
        SELECT make_timestamp(pickup * 1000000) AS tpep_pickup_datetime,
          make_timestamp((pickup + p % 200 * 60) * 1000000) AS tpep_dropoff_datetime,
          CASE WHEN (o + l) % 89 <> 0 THEN (s % 10 + 1)::INTEGER END AS PULocationID,
          CASE WHEN p % 97 <> 0 THEN (p % 265 + 1)::INTEGER END AS DOLocationID,
          CASE WHEN o % 101 <> 0 THEN (l % 8)::DOUBLE END AS passenger_count,
          q - 1 AS trip_distance, fare AS fare_amount, (p % 11 - 1) / 2::DOUBLE AS extra,
          CASE WHEN s % 50 = 0 THEN -0.5 ELSE 0.5 END::DOUBLE AS mta_tax,
          (o % 420) / 2::DOUBLE AS tip_amount, (p % 205) / 2::DOUBLE AS tolls_amount,
          CASE WHEN p % 61 = 0 THEN -0.25 ELSE 0.25 END::DOUBLE AS improvement_surcharge,
          fare + (p % 11 - 1) / 2::DOUBLE + (o % 420) / 2::DOUBLE + (p % 205) / 2::DOUBLE
            AS total_amount,
          CASE WHEN o % 7 = 0 THEN NULL WHEN p % 53 = 0 THEN -2.5 ELSE 2.5 END::DOUBLE
            AS congestion_surcharge,
          CASE WHEN o % 5 = 0 THEN 1.25 END::DOUBLE AS airport_fee FROM nyc_base""",
    "trips_curated": f"""
        SELECT event_id::VARCHAR AS trip_id, taxi_id, ts AS trip_start, latitude, longitude,
          floor(speed * 60)::BIGINT AS duration_sec, {hex_sql('latitude', 'longitude')} AS hex_cell,
          zone_id, strftime(ts, '%Y-%m') AS year_month FROM placed WHERE zone_id <> 99""",
    "weekly": """
        SELECT date_trunc('week', trip_start)::TIMESTAMP AS week_start, zone_id,
          count(*) AS total_trips, count(DISTINCT taxi_id) AS unique_taxis
        FROM trips_curated GROUP BY ALL""",
    "trip_history": """
        SELECT event_id AS k, CASE WHEN event_id % 20 = 7 THEN event_id - 1 ELSE event_id
            END::VARCHAR AS TRIP_ID,
          CASE event_id % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'B' ELSE 'C' END AS CALL_TYPE,
          CASE WHEN event_id % 3 = 0 THEN (event_id % 1000)::INTEGER END AS ORIGIN_CALL,
          CASE WHEN event_id % 3 = 1 THEN (event_id % 64)::INTEGER END AS ORIGIN_STAND,
          user_id::INTEGER AS TAXI_ID, epoch_us(ts) // 1000000 AS "TIMESTAMP", 'A' AS DAY_TYPE,
          CASE WHEN event_id % 71 <> 3 THEN event_id % 50 = 1 END AS MISSING_DATA,
          CASE WHEN event_id % 97 IN (5, 6, 7) THEN event_id % 97 ELSE 0 END AS fault,
          CASE WHEN event_id % 97 = 5 THEN 'oops' WHEN event_id % 97 = 6 THEN '[[-8.6]]'
            WHEN event_id % 97 = 7 THEN NULL ELSE '[' || coalesce(list_aggregate(
              list_transform(range(1, event_id % 12 + 1), lambda j: '[-8.' || lpad(
                (7500 - (event_id * 31 + j * 53) % 1800)::VARCHAR, 4, '0') || ', 41.' || lpad(
                ((event_id * 17 + j * 29) % 2100)::VARCHAR, 4, '0') || ']'),
              'string_agg', ', '), '') || ']' END AS POLYLINE FROM events""",
    # Vertices of the trips whose text is sound, straight from the arithmetic.
    "vertices": """
        SELECT h.*, j - 1 AS vertex,
          -(87500 - (k * 31 + j * 53) % 1800) / 10000::DOUBLE AS lon,
          (410000 + (k * 17 + j * 29) % 2100) / 10000::DOUBLE AS lat
        FROM trip_history h, unnest(range(1, k % 12 + 1)) AS u(j) WHERE fault = 0""",
    "remapped": """
        SELECT *, (greatest(least(lon, -8.55::DOUBLE), -8.69::DOUBLE) - -8.69::DOUBLE)
            / (-8.55::DOUBLE - -8.69::DOUBLE) * (-7.3::DOUBLE - -7.9::DOUBLE) + -7.9::DOUBLE
            AS new_lon,
          (greatest(least(lat, 41.19::DOUBLE), 41.1::DOUBLE) - 41.1::DOUBLE)
            / (41.19::DOUBLE - 41.1::DOUBLE) * (33.7::DOUBLE - 33.3::DOUBLE) + 33.3::DOUBLE
            AS new_lat FROM vertices""",
    "mapped": """
        SELECT *, row_number() OVER (PARTITION BY k ORDER BY vertex) - 1 AS new_vertex
        FROM remapped WHERE k NOT IN (SELECT k FROM remapped WHERE new_lon > -7.46::DOUBLE)
          AND new_lon BETWEEN -7.9::DOUBLE AND -7.3::DOUBLE
          AND new_lat BETWEEN 33.3::DOUBLE AND 33.7::DOUBLE""",
    "nodes": f"""
        SELECT s_suppkey AS node_id, (s_suppkey % {GRID} * 100 - 76500) / 10000::DOUBLE AS x,
          (s_suppkey // {GRID} * 100 + 335200) / 10000::DOUBLE AS y FROM supplier""",
    "roads": f"""
        SELECT a, b, (a * 37 % 50 + b * 13 % 30 + 100)::DOUBLE AS length,
          CASE WHEN a % 29 = 28 THEN 'motorway' WHEN a % 31 = 30 THEN 'trunk_link'
            ELSE 'residential' END AS highway,
          CASE WHEN b % 37 = 36 THEN 'yes' ELSE 'no' END AS area
        FROM (SELECT s_suppkey AS a, s_suppkey + 1 AS b FROM supplier
                WHERE s_suppkey % {GRID} < {GRID - 1}
              UNION ALL SELECT s_suppkey, s_suppkey + {GRID} FROM supplier)
        WHERE b IN (SELECT s_suppkey FROM supplier)""",
    "edges": """
        SELECT a AS src, b AS dst, length, highway, area FROM roads
        UNION ALL SELECT b, a, length, highway, area FROM roads""",
}

_NEEDS = {
    "valid": ["raw_pings"], "placed": ["valid"], "zone_pings": ["placed", "zones"],
    "supply_and_demand": ["zone_pings", "trip_requests"],
    "demand_windows": ["supply_and_demand"], "slots": ["slot_trips"], "features": ["slots"],
    "split_at": ["features"], "nyc_trips": ["nyc_base"], "trips_curated": ["placed"],
    "weekly": ["trips_curated"], "vertices": ["trip_history"], "remapped": ["vertices"],
    "mapped": ["remapped"], "edges": ["roads"],
}


def with_tables(names: str, query: str) -> str:
    """``query`` with the named adapters, and those they rest on, in front."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in _NEEDS.get(name, []):
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names.split():
        add(name)
    heads = ", ".join(f"{name} AS ({SQL[name]})" for name in ordered)
    return f"WITH {heads} {query}" if heads else query
