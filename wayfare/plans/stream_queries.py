"""Queries that run a stream over topics made from the given tables, to its end."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from wayfare.functions import messages, times
from wayfare.operators import kpi, matching, serving
from wayfare.plans import fixtures as fx
from wayfare.plans.fixtures import CITY, with_tables
from wayfare.plans.registry import once, query
from wayfare.session import scratch_path
from wayfare.sources import serving_tables, topics
from wayfare.streaming import jobs, states

_MESSAGES = {
    "raw.gps": fx.gps_messages, "processed.gps": fx.normalised_messages,
    "raw.trips": fx.trip_messages,
}


def _topic(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A topic folder filled from the given tables, as a stream."""
    def fill(root: str) -> str:
        _MESSAGES[name](spark, sf_dir).select("value").write.text(topics.topic_path(root, name))
        return root

    return topics.read_topic(spark, name, root=once(spark, sf_dir, name, fill))


def _finish(df: DataFrame, spark: SparkSession, path: str | None = None,
            checkpoint: str | None = None) -> DataFrame:
    """Run a stream over what there is, and read the table it wrote."""
    path = path or scratch_path(spark, "streamed")
    jobs.start_table(df, path, checkpoint or scratch_path(spark, "checkpoint")).awaitTermination()
    return spark.read.schema(df.schema).parquet(path)


_SOUND = "event_id % 97 NOT IN (5, 6, 9, 10)"


@query("src_stream", with_tables("raw_pings", f"""
    SELECT taxi_id, event_time, latitude, longitude, speed, status FROM raw_pings
    WHERE {_SOUND}"""))
def _(spark, sf_dir):
    return _finish(messages.parse_gps(_topic(spark, sf_dir, "raw.gps")), spark)


@query("src_stream_latest", with_tables("trip_requests", """
    SELECT trip_id AS entity_id, origin_zone AS zone_id FROM trip_requests
    WHERE trip_id::BIGINT % 97 <> 5"""))
def _(spark, sf_dir):
    """Pings are in the topic before the reader comes up, requests arrive after."""
    root = scratch_path(spark, "topics")
    path = topics.topic_path(root, "mixed")
    fx.gps_messages(spark, sf_dir).select("value").write.text(path)
    since = topics.unread(spark, "mixed", root)
    fx.trip_messages(spark, sf_dir).write.mode("append").text(path)
    fresh = topics.read_topic(spark, "mixed", root=root, start="latest", since=since)
    return _finish(messages.parse_trip(fresh).select("entity_id", "zone_id"), spark)


@query("st_event_time", with_tables("zone_pings", """
    SELECT taxi_id, event_time, make_timestamp(event_time * 1000000) AS event_ts
    FROM zone_pings"""))
def _(spark, sf_dir):
    return fx.zone_pings(spark, sf_dir).select(
        "taxi_id", "event_time",
        times.event_timestamp(F.col("event_time"), "s").cast("timestamp_ntz").alias("event_ts"))


_NORMALISED = f"SELECT * FROM zone_pings WHERE {_SOUND}"


@query("st_gps_normalize", with_tables("zone_pings", f"""
    SELECT taxi_id, event_time, latitude, longitude, speed, status, zone_id, zone_name
    FROM ({_NORMALISED})"""))
def _(spark, sf_dir):
    return _finish(jobs.gps_normalize(_topic(spark, sf_dir, "raw.gps")).drop("event_ts"), spark)


@query("sink_stream_json", with_tables("zone_pings", f"""
    SELECT 'vehicle' AS kind, zone_id, event_time, taxi_id::VARCHAR AS entity_id, status
    FROM ({_NORMALISED})"""))
def _(spark, sf_dir):
    root = scratch_path(spark, "topics")
    events = jobs.gps_messages(_topic(spark, sf_dir, "raw.gps"))
    topics.write_topic(events, "processed", scratch_path(spark, "checkpoint"), root=root) \
        .awaitTermination()
    return messages.parse_gps_norm(spark.read.text(topics.topic_path(root, "processed")))


@query("sink_raw_archive", """
    SELECT 'raw.gps' AS topic, count(*) AS n, 0::BIGINT AS changed FROM events
    UNION ALL SELECT 'raw.trips', count(*), 0 FROM events WHERE event_type = 'purchase'""")
def _(spark, sf_dir):
    def fill(root: str) -> str:
        for name in ("raw.gps", "raw.trips"):
            _MESSAGES[name](spark, sf_dir).select("value").write.text(
                topics.topic_path(root, name))
        return root

    path = scratch_path(spark, "archive")
    topics.archive_topics(
        spark, ["raw.gps", "raw.trips"], path, scratch_path(spark, "checkpoint"),
        root=once(spark, sf_dir, "raw topics", fill), trigger=topics.AVAILABLE_NOW
    ).awaitTermination()
    archived = spark.read.schema("value string, topic string").option("wholetext", "false").text(path)
    sent = [_MESSAGES[name](spark, sf_dir).select("value", F.lit(name).alias("topic"), F.lit(1).alias("side"))
            for name in ("raw.gps", "raw.trips")]
    both = archived.withColumn("side", F.lit(-1)).unionByName(sent[0]).unionByName(sent[1])
    # every message must be there as often as it was sent
    each = both.groupBy("topic", "value").agg(
        F.sum("side").alias("off"), F.count_if(F.col("side") < 0).alias("n"))
    return each.groupBy("topic").agg(F.sum("n").alias("n"), F.sum(F.abs("off")).alias("changed"))


# A finite stream ends with its last windows open: only those are out whose end the watermark,
# three minutes behind the newest event, has passed.
_HEARD = """heard AS (SELECT * FROM supply_and_demand WHERE NOT (kind = 'trip'
      AND entity_id::BIGINT % 97 = 5)),
    windows AS (SELECT zone_id, event_time // 30 * 30000 AS window_start,
      (count(DISTINCT entity_id) FILTER (kind = 'vehicle'))::INTEGER AS active_vehicles,
      (count(DISTINCT entity_id) FILTER (kind = 'trip'))::INTEGER AS pending_requests
      FROM heard GROUP BY ALL)"""
_CLOSED = with_tables("supply_and_demand", "").rstrip() + f""", {_HEARD}
    SELECT '{CITY}' AS city, zone_id, window_start, active_vehicles, pending_requests,
      pending_requests / greatest(active_vehicles, 1)::DOUBLE AS ratio FROM windows
    WHERE window_start + 30000 <= (SELECT max(event_time) FROM heard) * 1000 - 180000"""


@query("st_demand", _CLOSED)
def _(spark, sf_dir):
    return _finish(jobs.demand_stream(
        _topic(spark, sf_dir, "processed.gps"), _topic(spark, sf_dir, "raw.trips"), CITY), spark)


@query("st_watermark", with_tables("supply_and_demand", "").rstrip() + f""", {_HEARD}
    SELECT count(*) AS closed_windows, max(window_start) AS last_window,
      sum(active_vehicles)::BIGINT AS vehicles, sum(pending_requests)::BIGINT AS requests
    FROM windows
    WHERE window_start + 30000 <= (SELECT max(event_time) FROM heard) * 1000 - 180000""")
def _(spark, sf_dir):
    """What a stream under the joint watermark of both topics has put out when it has read all."""
    closed = _finish(jobs.demand_stream(
        _topic(spark, sf_dir, "processed.gps"), _topic(spark, sf_dir, "raw.trips"), CITY), spark)
    return closed.agg(
        F.count("*").alias("closed_windows"), F.max("window_start").alias("last_window"),
        F.sum("active_vehicles").alias("vehicles"), F.sum("pending_requests").alias("requests"))


@query("st_late_drop", _CLOSED)
def _(spark, sf_dir):
    """Every request arrives once more, ten minutes late: all of that falls to closed windows."""
    root = scratch_path(spark, "topics")
    trips = topics.topic_path(root, "raw.trips")
    fx.trip_messages(spark, sf_dir).write.text(trips)
    path, checkpoint = scratch_path(spark, "streamed"), scratch_path(spark, "checkpoint")

    def run() -> DataFrame:
        stream = jobs.demand_stream(_topic(spark, sf_dir, "processed.gps"),
                                    topics.read_topic(spark, "raw.trips", root=root), CITY)
        return _finish(stream, spark, path, checkpoint)

    run()
    late = fx.trip_requests(spark, sf_dir).withColumns({
        "requested_at": F.col("requested_at") - 600,
        "trip_id": F.concat(F.lit("late-"), F.col("trip_id"))})
    late.select(F.to_json(F.struct("*")).alias("value")).write.mode("append").text(trips)
    return run()


@query("st_checkpoint", with_tables("zone_pings", f"""
    SELECT taxi_id, event_time, status, zone_id FROM ({_NORMALISED})
    UNION ALL SELECT taxi_id, event_time + 86400, status, zone_id FROM zone_pings
    WHERE event_id % 97 NOT IN (5, 6, 9, 10)"""))
def _(spark, sf_dir):
    """A restarted job goes on where it stopped: the next day's pings come in a second run."""
    root = scratch_path(spark, "topics")
    raw = topics.topic_path(root, "raw.gps")
    path, checkpoint = scratch_path(spark, "streamed"), scratch_path(spark, "checkpoint")
    today = messages.parse_gps(fx.gps_messages(spark, sf_dir).select("value"))
    out = None
    for day in (0, 1):
        today.select(F.to_json(F.struct(
            "taxi_id", (F.col("event_time") + day * 86_400).alias("timestamp"), "latitude",
            "longitude", "speed", "status")).alias("value")).write.mode("append").text(raw)
        stream = jobs.gps_normalize(topics.read_topic(spark, "raw.gps", root=root))
        out = _finish(stream.select("taxi_id", "event_time", "status", "zone_id"), spark, path,
                      checkpoint)
    return out


# --- matching ------------------------------------------------------------------------------

def _city_pings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.zone_pings(spark, sf_dir).drop("event_id", "zone_name").withColumn(
        "city", F.lit(CITY))


def _city_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.trip_requests(spark, sf_dir).withColumn("city", F.lit(CITY))


def _sent_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests as their senders leave them: half in milliseconds, some without a destination."""
    k = F.col("trip_id").cast("bigint")
    return _city_requests(spark, sf_dir).withColumns({
        "requested_at": F.when(k % 2 == 0, F.col("requested_at") * 1000).otherwise(F.col("requested_at")),
        "destination_zone": F.when(k % 13 != 4, F.col("destination_zone"))})


_ASOF = f"""
    SELECT '{CITY}' AS city, r.trip_id, r.origin_zone AS zone_id, r.requested_at,
      min(p.taxi_id) AS first_taxi, count(p.taxi_id) AS n_taxis
    FROM trip_requests r LEFT JOIN (
      SELECT taxi_id, zone_id, status, event_time, least(event_time + 120, coalesce(lead(event_time)
        OVER (PARTITION BY taxi_id ORDER BY event_time, latitude, longitude, speed, status,
          zone_id), event_time + 120)) AS until FROM zone_pings) p
    ON p.zone_id = r.origin_zone AND p.status IN ('AVAILABLE', 'EN_ROUTE')
      AND r.requested_at >= p.event_time AND r.requested_at < p.until
    GROUP BY ALL"""


@query("join_asof_ping", with_tables("zone_pings trip_requests", _ASOF))
def _(spark, sf_dir):
    return matching.candidates(_city_requests(spark, sf_dir), _city_pings(spark, sf_dir))


@query("ping_intervals", with_tables("zone_pings", """
    SELECT zone_id, sum(until - event_time)::BIGINT AS usable_seconds, count(*) AS n FROM (
      SELECT zone_id, status, event_time, least(event_time + 120, coalesce(lead(event_time)
        OVER (PARTITION BY taxi_id ORDER BY event_time, latitude, longitude, speed, status,
          zone_id), event_time + 120)) AS until FROM zone_pings)
    WHERE status IN ('AVAILABLE', 'EN_ROUTE') AND until > event_time GROUP BY zone_id"""))
def _(spark, sf_dir):
    """How long pings stay usable: to the taxi's next ping, at most 120 seconds."""
    return matching.ping_intervals(_city_pings(spark, sf_dir)).groupBy("zone_id").agg(
        F.sum(F.col("until") - F.col("event_time")).alias("usable_seconds"),
        F.count("*").alias("n"))


@query("st_state_ttl", with_tables("zone_pings", f"""
    SELECT zone_id, sum(until - event_time)::BIGINT AS usable_seconds, count(*) AS n FROM (
      SELECT zone_id, status, event_time, least(event_time + 120, coalesce(lead(event_time)
        OVER (PARTITION BY taxi_id ORDER BY event_time, latitude, longitude, speed, status,
          zone_id), event_time + 120)) AS until FROM ({_NORMALISED}))
    WHERE status IN ('AVAILABLE', 'EN_ROUTE') AND until > event_time
      AND event_time + 120 <= (SELECT max(event_time) - 600 FROM ({_NORMALISED})) GROUP BY zone_id"""))
def _(spark, sf_dir):
    """How long pings stay usable, from a stream with a state for each taxi that empties itself; in two runs, so
    that what is held when the first one stops is put out by the second."""
    root = scratch_path(spark, "topics")
    raw = topics.topic_path(root, "raw.gps")
    path, checkpoint = scratch_path(spark, "streamed"), scratch_path(spark, "checkpoint")
    sent = messages.parse_gps(fx.gps_messages(spark, sf_dir).select("value"))
    out = None
    for run in (0, 1):
        sent.filter((F.col("event_time") >= fx.START + 5400) == bool(run)).select(F.to_json(F.struct(
            "taxi_id", F.col("event_time").alias("timestamp"), "latitude", "longitude", "speed", "status"))
            .alias("value")).write.mode("append").text(raw)
        stream = jobs.gps_normalize(topics.read_topic(spark, "raw.gps", root=root), "10 minutes").withColumn(
            "city", F.lit(CITY))
        out = _finish(states.ping_interval_stream(stream, "10 minutes"), spark, path, checkpoint)
    return out.groupBy("zone_id").agg(
        F.sum(F.col("until") - F.col("event_time")).alias("usable_seconds"), F.count("*").alias("n"))


# The matcher's rules as a recursion: each round plays one event, or decides one waiting request
# while a timer is due. "steps" holds the events in order.
_PLAYED = """played AS (
      SELECT 0::BIGINT AS n, []::STRUCT(taxi INTEGER, zone INTEGER, seen BIGINT)[] AS free,
        []::STRUCT(asked BIGINT, trip VARCHAR, zone INTEGER)[] AS parked, []::BIGINT[] AS timers,
        NULL::VARCHAR AS trip, NULL::VARCHAR AS status, NULL::INTEGER AS taxi,
        NULL::BIGINT AS decided
      UNION ALL
      SELECT CASE WHEN settles IS NULL THEN n + 1 ELSE n END,
        CASE WHEN settles IS NULL AND asks = 0 THEN list_concat(
            list_filter(usable, lambda f: f.taxi <> id::INTEGER),
            CASE WHEN ping_status IN ('AVAILABLE', 'EN_ROUTE')
              THEN [{'taxi': id::INTEGER, 'zone': zone, 'seen': now}] ELSE [] END)
          WHEN got IS NOT NULL THEN list_filter(usable, lambda f: f.taxi <> got)
          ELSE usable END,
        CASE WHEN settles IS NOT NULL THEN list_filter(parked, lambda q: q.trip <> id)
          WHEN asks = 1 AND got IS NULL
            THEN list_append(parked, {'asked': asked, 'trip': id, 'zone': zone})
          ELSE parked END,
        CASE WHEN settles IS NOT NULL THEN timers
          WHEN asks = 1 AND got IS NULL
            THEN list_append(list_filter(timers, lambda x: x > now), now + 5)
          ELSE list_filter(timers, lambda x: x > now) END,
        CASE WHEN settles IS NOT NULL OR got IS NOT NULL THEN id END,
        CASE WHEN settles IS NULL AND got IS NOT NULL THEN 'MATCHED_EXACT'
          WHEN settles IS NOT NULL AND own IS NOT NULL THEN 'MATCHED_DELAYED_EXACT'
          WHEN settles IS NOT NULL AND got IS NOT NULL THEN 'MATCHED_FALLBACK'
          WHEN settles IS NOT NULL THEN 'UNFULFILLED' END,
        got, now
      FROM (SELECT *, CASE WHEN settles IS NOT NULL THEN coalesce(own, below, above)
          WHEN asks = 1 THEN own END AS got
        FROM (SELECT *,
          list_min(list_transform(list_filter(usable, lambda f: f.zone = zone),
            lambda f: f.taxi)) AS own,
          list_min(list_transform(list_filter(usable, lambda f: f.zone = zone - 1),
            lambda f: f.taxi)) AS below,
          list_min(list_transform(list_filter(usable, lambda f: f.zone = zone + 1),
            lambda f: f.taxi)) AS above
        FROM (SELECT *, list_filter(free, lambda f: now - f.seen < 120) AS usable
        FROM (SELECT n, free, parked, timers, settles, coalesce(settles, t) AS now, asks, asked,
          ping_status, CASE WHEN settles IS NOT NULL THEN head.trip ELSE id END AS id,
          CASE WHEN settles IS NOT NULL THEN head.zone ELSE zone END AS zone
        FROM (SELECT p.n, p.free, p.parked, p.timers, s.t, s.asks, s.asked, s.id, s.zone,
          s.status AS ping_status, list_sort(p.parked)[1] AS head,
          CASE WHEN len(p.parked) > 0 AND list_min(p.timers) <= coalesce(s.t, 1::BIGINT << 60)
            THEN list_min(p.timers) END AS settles
        FROM played p LEFT JOIN steps s ON s.n = p.n + 1
        WHERE s.n IS NOT NULL OR len(p.parked) > 0))))))"""


def _matcher_sql(steps: str, select: str) -> str:
    tables = with_tables("zone_pings trip_requests", "").rstrip()
    tables = tables.replace("WITH", "WITH RECURSIVE", 1)
    return f"""{tables}, steps AS MATERIALIZED (
      SELECT row_number() OVER (ORDER BY asked, asks, id, zone, status, speed, latitude, longitude)
        AS n, * FROM ({steps})),
    {_PLAYED} {select}"""


_RAW_TIME = "CASE WHEN trip_id::BIGINT % 2 = 0 THEN requested_at * 1000 ELSE requested_at END"
_ETA = """CASE status WHEN 'UNFULFILLED' THEN 0 WHEN 'MATCHED_FALLBACK' THEN 480 ELSE 180 END"""


_REPLAYED = _matcher_sql("""
    SELECT event_time AS t, event_time AS asked, 0 AS asks, taxi_id::VARCHAR AS id,
      zone_id AS zone, status, speed, latitude, longitude FROM zone_pings
    UNION ALL SELECT requested_at, requested_at, 1, trip_id, origin_zone, NULL, NULL, NULL, NULL
    FROM trip_requests""", f"""
    SELECT '{CITY}' AS city, strftime(make_timestamp(decided * 1000000), '%Y-%m-%d')
      AS date_bucket, {_RAW_TIME} AS created_at, trip_id, rider_id::VARCHAR AS rider_id, origin_zone,
      CASE WHEN trip_id::BIGINT % 13 <> 4 THEN destination_zone ELSE 0 END AS destination_zone,
      call_type, coalesce(taxi::VARCHAR, 'NONE') AS matched_taxi,
      {_ETA} AS eta_seconds, status, decided * 1000 AS decided_at
    FROM trip_requests JOIN (SELECT trip AS trip_id, status, taxi, decided FROM played
      WHERE status IS NOT NULL) USING (trip_id)""")


@query("st_match_replay", _REPLAYED)
def _(spark, sf_dir):
    return matching.match_replay(_city_pings(spark, sf_dir), _sent_requests(spark, sf_dir))


@query("st_match_short_slabs", _REPLAYED)
def _(spark, sf_dir):
    """Slabs and warm-ups so short that states run on across them and slabs are played again."""
    return matching.match_replay(_city_pings(spark, sf_dir), _sent_requests(spark, sf_dir),
                                 slab_seconds=matching.HORIZON, warmup_seconds=30)


@query("st_match_complete", with_tables("trip_requests", f"""
    SELECT '{CITY}' AS city, trip_id, rider_id, origin_zone, destination_zone, call_type,
      requested_at AS created_at FROM trip_requests"""))
def _(spark, sf_dir):
    """The replay answers every request exactly once, with the request's own fields."""
    matches = matching.match_replay(_city_pings(spark, sf_dir), _city_requests(spark, sf_dir))
    return messages.clean_rider_id(matches).select(
        "city", "trip_id", "rider_id", "origin_zone", "destination_zone", "call_type",
        "created_at")


# --- serving -------------------------------------------------------------------------------

def _decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Match rows for two thirds of the requests, by a fixed rule instead of the matcher."""
    k = F.col("trip_id").cast("bigint")
    return _city_requests(spark, sf_dir).filter(k % 3 != 2).select(
        "city", F.date_format(F.timestamp_seconds("requested_at"), "yyyy-MM-dd")
        .alias("date_bucket"), F.col("requested_at").alias("created_at"), "trip_id", "rider_id",
        "origin_zone", "destination_zone", "call_type",
        F.when(k % 3 == 0, (k % 100).cast("string")).otherwise("NONE").alias("matched_taxi"),
        F.when(k % 3 == 0, 180).otherwise(0).alias("eta_seconds"),
        F.when(k % 3 == 0, "MATCHED_EXACT").otherwise("UNFULFILLED").alias("status"))


_STATUS = """CASE trip_id::BIGINT % 3 WHEN 0 THEN 'MATCHED_EXACT' WHEN 1 THEN 'UNFULFILLED'
      ELSE 'PENDING' END"""


@query("sink_upsert", with_tables("trip_requests", f"""
    SELECT '{CITY}' AS city, strftime(make_timestamp(requested_at * 1000000), '%Y-%m-%d')
      AS date_bucket, requested_at AS created_at, trip_id, rider_id, origin_zone,
      destination_zone, call_type, CASE trip_id::BIGINT % 3 WHEN 0
        THEN (trip_id::BIGINT % 100)::VARCHAR ELSE 'NONE' END AS matched_taxi,
      CASE WHEN trip_id::BIGINT % 3 = 0 THEN 180 ELSE 0 END AS eta_seconds, {_STATUS} AS status
    FROM trip_requests"""))
def _(spark, sf_dir):
    """Some trips are pending and decided within one batch, others decided in a later one, which is
    written twice, by another writer whose numbers start anew."""
    path = scratch_path(spark, "trips")
    pending = _city_requests(spark, sf_dir).select(
        "city", F.date_format(F.timestamp_seconds("requested_at"), "yyyy-MM-dd")
        .alias("date_bucket"), F.col("requested_at").alias("created_at"), "trip_id", "rider_id",
        "origin_zone", "destination_zone", "call_type", F.lit("NONE").alias("matched_taxi"),
        F.lit(0).alias("eta_seconds"), F.lit("PENDING").alias("status"))
    decided = _decisions(spark, sf_dir)
    serving_tables.upsert(pending.unionByName(decided.filter("status = 'MATCHED_EXACT'")), path, "trips", 0)
    for _attempt in range(2):
        serving_tables.upsert(decided.filter("status <> 'MATCHED_EXACT'"), path, "trips", 0, "later")
    return serving_tables.read_serving(spark, path, "trips")


@query("sink_upsert_stream", with_tables("zone_pings", f"""
    SELECT DISTINCT ON (zone_id, event_time, taxi_id) '{CITY}' AS city, zone_id, event_time,
      taxi_id, latitude, longitude, speed, status FROM ({_NORMALISED})
    ORDER BY zone_id, event_time, taxi_id, latitude, longitude, speed, status"""))
def _(spark, sf_dir):
    path = scratch_path(spark, "positions")
    positions = jobs.gps_positions(_topic(spark, sf_dir, "raw.gps"), CITY)
    jobs.start_upsert(positions, path, "vehicle_positions", scratch_path(spark, "checkpoint")) \
        .awaitTermination()
    return serving_tables.read_serving(spark, path, "vehicle_positions")


@query("sink_batch_serving", with_tables("weekly", f"""
    SELECT '{CITY}' AS city, zone_id, epoch_ms(week_start) AS window_start,
      unique_taxis::INTEGER AS active_vehicles, total_trips::INTEGER AS pending_requests,
      total_trips / greatest(unique_taxis, 1)::DOUBLE AS ratio FROM weekly"""))
def _(spark, sf_dir):
    path = scratch_path(spark, "demand")
    weekly = kpi.weekly_trips(fx.trips_curated(spark, sf_dir))
    serving_tables.upsert(kpi.weekly_to_demand(weekly, CITY), path, "demand_zones", 0)
    return serving_tables.read_serving(spark, path, "demand_zones")


@query("sink_shared_table", with_tables("supply_and_demand weekly", "").rstrip() + f""", {_HEARD},
    closed AS (SELECT '{CITY}' AS city, zone_id, window_start, active_vehicles, pending_requests,
      pending_requests / greatest(active_vehicles, 1)::DOUBLE AS ratio FROM windows
      WHERE window_start + 30000 <= (SELECT max(event_time) FROM heard) * 1000 - 180000),
    weeks AS (SELECT '{CITY}' AS city, zone_id, epoch_ms(week_start) AS window_start,
      unique_taxis::INTEGER AS active_vehicles, total_trips::INTEGER AS pending_requests,
      total_trips / greatest(unique_taxis, 1)::DOUBLE AS ratio FROM weekly)
    SELECT * FROM weeks UNION ALL SELECT * FROM closed c WHERE NOT EXISTS (
      SELECT 1 FROM weeks w WHERE w.zone_id = c.zone_id AND w.window_start = c.window_start)""")
def _(spark, sf_dir):
    """The demand stream and the weekly job share one table, which is compacted in between."""
    path = scratch_path(spark, "demand")
    windows = jobs.demand_stream(
        _topic(spark, sf_dir, "processed.gps"), _topic(spark, sf_dir, "raw.trips"), CITY)
    jobs.start_upsert(windows, path, "demand_zones", scratch_path(spark, "checkpoint")).awaitTermination()
    serving_tables.compact(spark, path, "demand_zones")
    weekly = kpi.weekly_trips(fx.trips_curated(spark, sf_dir))
    serving_tables.upsert(kpi.weekly_to_demand(weekly, CITY), path, "demand_zones", 0, "weekly")
    return serving_tables.read_serving(spark, path, "demand_zones")


@query("emit_json_match", with_tables("trip_requests", f"""
    SELECT trip_id AS "key", '{CITY}' AS city, trip_id, requested_at AS created_at,
      CASE WHEN trip_id::BIGINT % 3 = 0 THEN 'MATCHED_EXACT' ELSE 'UNFULFILLED' END AS status
    FROM trip_requests WHERE trip_id::BIGINT % 3 <> 2"""))
def _(spark, sf_dir):
    """Decisions as keyed messages, read back."""
    sent = jobs.match_messages(_decisions(spark, sf_dir))
    return sent.select("key", F.json_tuple("value", "city", "trip_id", "created_at", "status").alias(
        "city", "trip_id", "created_at", "status")).withColumn("created_at", F.col("created_at").cast("bigint"))


@query("st_latest_status", with_tables("trip_requests", f"""
    SELECT trip_id, {_STATUS} AS status, rider_id, origin_zone, destination_zone,
      CASE WHEN trip_id::BIGINT % 3 = 2 THEN 'Trip reserved, finding a driver...' ELSE '' END
        AS message FROM trip_requests"""))
def _(spark, sf_dir):
    """A stream in two runs: first the requests of even trips and the decisions of odd ones, then the rest."""
    root, path, checkpoint = (scratch_path(spark, name) for name in ("topics", "streamed", "checkpoint"))
    sides = {"requests": _city_requests(spark, sf_dir), "decisions": _decisions(spark, sf_dir)}
    out = None
    for run in (0, 1):
        for other, (name, rows) in enumerate(sides.items()):
            rows.filter(F.col("trip_id").cast("bigint") % 2 == (run + other) % 2).select(
                F.to_json(F.struct("*")).alias("value")).write.mode("append").text(topics.topic_path(root, name))
        read = [topics.read_topic(spark, name, root=root).select(
            F.from_json("value", rows.schema).alias("r")).select("r.*") for name, rows in sides.items()]
        out = _finish(states.latest_status_stream(*read, "1 day"), spark, path, checkpoint)
    fields = serving.STATUS_FIELDS
    return out.groupBy("trip_id").agg(F.max_by(F.struct(*fields), "version").alias("last")).select(
        "trip_id", *[f"last.{name}" for name in fields])


@query("latest_status", with_tables("trip_requests", f"""
    SELECT trip_id, {_STATUS} AS status, rider_id, origin_zone, destination_zone,
      CASE WHEN trip_id::BIGINT % 3 = 2 THEN 'Trip reserved, finding a driver...' ELSE '' END
        AS message FROM trip_requests"""))
def _(spark, sf_dir):
    return serving.latest_status(_city_requests(spark, sf_dir), _decisions(spark, sf_dir))


# Decisions come some seconds after their requests; every seventh comes too late, two thirds come at all.
_WAIT = "CASE WHEN trip_id::BIGINT % 7 = 0 THEN 900 ELSE trip_id::BIGINT % 500 END"


@query("join_stream_answers", with_tables("trip_requests", f"""
    SELECT trip_id, requested_at, CASE WHEN answered THEN {_STATUS} ELSE 'UNANSWERED' END AS status,
      CASE WHEN answered THEN ({_WAIT})::DOUBLE END AS waited_seconds FROM (
      SELECT *, trip_id::BIGINT % 3 <> 2 AND {_WAIT} <= 600 AS answered,
        max(requested_at) OVER () AS last_asked,
        max(requested_at + {_WAIT}) FILTER (trip_id::BIGINT % 3 <> 2) OVER () AS last_decided FROM trip_requests)
    WHERE answered OR requested_at + 600 < least(last_asked, last_decided) - 60"""))
def _(spark, sf_dir):
    """Two streams joined by trip and time, as two topics come in: unanswered requests are out once the joint
    watermark, a minute behind the slower topic, has passed their ten minutes."""
    root = scratch_path(spark, "topics")
    k = F.col("trip_id").cast("bigint")
    wait = F.when(k % 7 == 0, 900).otherwise(k % 500)
    decided = _decisions(spark, sf_dir).withColumn("decided_at", (F.col("created_at") + wait) * 1000)
    sides = {"requests": _city_requests(spark, sf_dir).select("trip_id", "requested_at"),
             "decisions": decided.select("trip_id", "decided_at", "status")}
    for name, rows in sides.items():
        rows.select(F.to_json(F.struct("*")).alias("value")).write.text(topics.topic_path(root, name))
    read = [topics.read_topic(spark, name, root=root).select(
        F.from_json("value", rows.schema).alias("r")).select("r.*") for name, rows in sides.items()]
    return _finish(states.answered_trips(*read, "1 minute"), spark)


@query("join_stream_union", with_tables("zone_pings trip_requests", f"""
    SELECT '{CITY}' AS city, 'ping' AS kind, taxi_id::VARCHAR AS entity_id, zone_id, event_time,
      CASE WHEN event_id % 13 = 0 THEN 'AVAILABLE' ELSE status END AS status, speed
    FROM zone_pings
    UNION ALL SELECT '{CITY}', 'request', trip_id, origin_zone,
      CASE WHEN trip_id::BIGINT % 2 = 0 THEN requested_at * 1000 ELSE requested_at END, NULL, NULL
    FROM trip_requests WHERE trip_id::BIGINT % 97 <> 5"""))
def _(spark, sf_dir):
    """Two topics as one stream of the matcher's events."""
    tagged = messages.tag(_topic(spark, sf_dir, "processed.gps"), "gps", CITY).unionByName(
        messages.tag(_topic(spark, sf_dir, "raw.trips"), "trip", CITY))
    return _finish(messages.match_events(tagged).select(
        "city", "kind", "entity_id", "zone_id", "event_time", "status", "speed"), spark)


@query("request_intake", with_tables("trip_requests", f"""
    SELECT trip_id, CASE WHEN trip_id::BIGINT % 10 = 3 THEN NULL ELSE rider_id END AS rider_id,
      CASE WHEN trip_id::BIGINT % 10 = 4 THEN 'X' WHEN trip_id::BIGINT % 10 = 5 THEN 'A'
        ELSE call_type END AS call_type, {fx.START}::BIGINT * 1000 AS requested_at,
      CASE trip_id::BIGINT % 10 WHEN 3 THEN 'missing:rider_id' WHEN 4 THEN 'unknown:call_type'
        ELSE 'PENDING' END AS outcome FROM trip_requests"""))
def _(spark, sf_dir):
    k = F.col("trip_id").cast("bigint")
    bodies = fx.trip_requests(spark, sf_dir).select(
        "trip_id", F.when(k % 10 != 3, F.col("rider_id").cast("string")).alias("rider_id"),
        F.col("origin_zone").cast("string").alias("origin_zone"),
        F.col("destination_zone").cast("string").alias("destination_zone"),
        F.when(k % 10 == 4, "X").when(k % 10 != 5, F.col("call_type")).alias("call_type"))
    accepted, rejected = serving.intake_requests(bodies, F.lit(fx.START * 1000).cast("bigint"))
    return accepted.select(
        "trip_id", "rider_id", "call_type", "requested_at", F.col("status").alias("outcome")
    ).unionByName(rejected.select(
        "trip_id", F.col("rider_id").cast("int"), "call_type", "requested_at",
        F.array_join("reasons", ",").alias("outcome")))
