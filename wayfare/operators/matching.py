"""Matching trip requests with taxis on tables: candidates, and the exact replay of the stream."""

from __future__ import annotations

import json
from typing import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from wayfare.functions.times import to_millis
from wayfare.operators.dispatch import ELIGIBLE, Dispatcher, Outcome, Request, Taxi, STALE_MS
from wayfare.session import scratch_path, settle, ship

HORIZON = 120                    # seconds a ping stays usable
_LEVELS = HORIZON.bit_length()   # dyadic levels that cover an interval of that length

# Length of a replay slab; longer than the horizon, so that a slab without events ends empty.
SLAB_SECONDS = 900
WARMUP_SECONDS = 240

EVENT = (
    "city string, kind string, entity_id string, zone_id int, event_time bigint, "
    "latitude double, longitude double, speed double, status string, rider_id string, "
    "destination_zone int, call_type string, created_at bigint"
)


def ping_intervals(pings: DataFrame, horizon: int = HORIZON) -> DataFrame:
    """Eligible pings with the seconds [event_time, until) in which the taxi stands there.

    A taxi's next ping ends the interval, and only one within the horizon matters. So the search
    for it is split into blocks of the horizon's length, not done over a taxi's whole history.
    """
    rest = [name for name in pings.columns if name not in ("city", "taxi_id", "event_time")]
    block = F.floor(F.col("event_time") / horizon)
    spread = pings.withColumn("_own", block).withColumn(
        "_block", F.explode(F.array(F.col("_own"), F.col("_own") - 1)))
    later = Window.partitionBy("city", "taxi_id", "_block").orderBy("event_time", *sorted(rest))
    until = F.least(F.col("event_time") + horizon, F.lead("event_time").over(later))
    return (
        spread.withColumn("until", until)
        .filter((F.col("_own") == F.col("_block")) & F.col("status").isin(*sorted(ELIGIBLE))
                & (F.col("until") > F.col("event_time")))
        .drop("_own", "_block"))


def _cover(start: Column, end: Column) -> Column:
    """The dyadic intervals (level, node) that make up [start, end), at most two per level."""
    parts = []
    for level in range(_LEVELS):
        size = 1 << level
        low = F.floor((start + (size - 1)) / size)
        high = F.floor(end / size)
        parts.append(F.when((low < high) & (low % 2 == 1),
                            F.struct(F.lit(level).alias("level"), low.alias("node"))))
        parts.append(F.when((low < high) & (high % 2 == 1),
                            F.struct(F.lit(level).alias("level"), (high - 1).alias("node"))))
    return F.array_compact(F.array(*parts))


def candidates(requests: DataFrame, pings: DataFrame, horizon: int = HORIZON,
               unit: str = "auto") -> DataFrame:
    """For each request the eligible taxis in its zone at its second: how many, and the first.

    Request times are seconds or milliseconds (``unit``, by default told from the value).

    Taxi intervals are cut into dyadic pieces and summed up per piece before they meet a request,
    and a request looks up one piece per level. So the pairs of taxis and requests are never
    formed, however busy a zone and a minute are.
    """
    pieces = ping_intervals(pings, horizon).select(
        "city", "zone_id", "taxi_id",
        F.explode(_cover(F.col("event_time"), F.col("until"))).alias("piece"))
    supply = pieces.groupBy("city", "zone_id", "piece.level", "piece.node").agg(
        F.min("taxi_id").alias("first_taxi"), F.count("*").alias("n"))
    levels = F.explode(F.array(*[
        F.struct(F.lit(level).alias("level"), F.floor(to_millis(F.col("requested_at"), unit)
                                                      / (1000 << level)).alias("node")) for level in range(_LEVELS)])).alias("look")
    looked = requests.select(
        "city", "trip_id", "requested_at", F.col("origin_zone").alias("zone_id"), levels).select(
        "*", "look.level", "look.node").drop("look")
    found = looked.join(supply, ["city", "zone_id", "level", "node"], "left")
    return found.groupBy("city", "trip_id", "zone_id", "requested_at").agg(
        F.min("first_taxi").alias("first_taxi"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_taxis"))


def as_events(pings: DataFrame, requests: DataFrame, unit: str = "auto") -> DataFrame:
    """Both inputs in the matcher's row form, times in milliseconds.

    Missing fields take the defaults of the live job: zone 0, position 0.0, speed 30, status
    AVAILABLE, rider "0", call type A. Rows without an id or a time can't be placed and are left out.
    """
    def known(column: str | Column, default) -> Column:
        return F.coalesce(column, F.lit(default))

    def optional(df: DataFrame, name: str, kind: str) -> Column:
        return (F.col(name) if name in df.columns else F.lit(None)).cast(kind).alias(name)

    p = pings.select(
        "city", F.lit("ping").alias("kind"), F.col("taxi_id").cast("string").alias("entity_id"),
        known("zone_id", 0).alias("zone_id"), to_millis(F.col("event_time"), unit).alias("event_time"),
        known("latitude", 0.0).alias("latitude"), known("longitude", 0.0).alias("longitude"),
        known("speed", 30.0).alias("speed"), known("status", "AVAILABLE").alias("status"))
    r = requests.select(
        "city", F.lit("request").alias("kind"), F.col("trip_id").cast("string").alias("entity_id"),
        known("origin_zone", 0).alias("zone_id"), to_millis(F.col("requested_at"), unit).alias("event_time"),
        optional(requests, "origin_lat", "double").alias("latitude"),
        optional(requests, "origin_lon", "double").alias("longitude"),
        known(F.col("rider_id").cast("string"), "0").alias("rider_id"),
        known("destination_zone", 0).alias("destination_zone"), known("call_type", "A").alias("call_type"),
        F.col("requested_at").cast("bigint").alias("created_at"))
    return p.unionByName(r, allowMissingColumns=True).dropna(subset=["entity_id", "event_time"])


def dump_state(dispatcher: Dispatcher, now: int) -> str:
    """What can still matter after ``now``, in a form that compares equal when it is equal."""
    taxis = sorted([key, *taxi] for key, taxi in dispatcher.taxis.items()
                   if now - taxi.seen < STALE_MS)
    parked = sorted(list(request) for request in dispatcher.parked.values())
    timers = sorted(time for time in dispatcher.timers if time > now)
    return json.dumps([taxis, parked, timers]) if taxis or parked or timers else ""


def load_state(text: str) -> Dispatcher:
    dispatcher = Dispatcher()
    if text:
        taxis, parked, timers = json.loads(text)
        for key, *taxi in taxis:
            dispatcher.place(key, Taxi(*taxi))
        for request in parked:
            dispatcher.parked[request[0]] = Request(*request)
        dispatcher.timers = timers
    return dispatcher


_ROW = (
    "city string, slab bigint, trip_id string, rider_id string, origin_zone int, "
    "destination_zone int, call_type string, created_at bigint, matched_taxi string, "
    "eta_seconds int, status string, decided_at bigint, start_state string, end_state string"
)
_INPUT = ["city", "slab", "kind", "entity_id", "zone_id", "event_time", "latitude", "longitude", "speed", "status",
          "rider_id", "destination_zone", "call_type", "created_at", "state"]
_RANK = "CASE kind WHEN 'state' THEN 0 WHEN 'ping' THEN 1 ELSE 2 END"


class _Slab:
    """One slab of a city while its events go by in order. It holds the state of two minutes."""

    def __init__(self, city: str, number: int, slab_ms: int):
        self.key, self.start, self.end = (city, number), number * slab_ms, (number + 1) * slab_ms
        self.dispatcher, self.opening, self.cleared = Dispatcher(), None, 0

    def _outcome(self, o: Outcome) -> tuple:
        r = o.request
        return (*self.key, r.trip_id, r.rider_id, r.origin_zone, r.destination_zone, r.call_type, r.created_at,
                o.matched_taxi, o.eta_seconds, o.status, o.decided_at, None, None)

    def advance(self, now: int) -> Iterator[tuple]:
        for outcome in self.dispatcher.expire(now):
            if outcome.decided_at > self.start:
                yield self._outcome(outcome)
        if now - self.cleared >= STALE_MS:
            self.dispatcher.forget(now)
            self.cleared = now

    def _open(self) -> Iterator[tuple]:
        yield from self.advance(self.start)
        self.opening = dump_state(self.dispatcher, self.start)

    def play(self, kind, entity_id, zone_id, event_time, latitude, longitude, speed, status, rider_id,
             destination_zone, call_type, created_at, state) -> Iterator[tuple]:
        if kind == "state":
            self.opening = state
            self.dispatcher = load_state(state)
            return
        if self.opening is None and event_time >= self.start:
            yield from self._open()
        yield from self.advance(event_time)
        if kind == "ping":
            self.dispatcher.ping(entity_id, Taxi(zone_id, latitude, longitude, speed, event_time), status)
            return
        outcome = self.dispatcher.request(Request(
            entity_id, rider_id, zone_id, destination_zone, call_type, created_at, latitude, longitude,
            event_time), event_time)
        if outcome is not None and event_time >= self.start:
            yield self._outcome(outcome)

    def close(self) -> Iterator[tuple]:
        """The last outcomes, then a row with the states at both ends."""
        if self.opening is None:
            yield from self._open()
        yield from self.advance(self.end)
        yield (*self.key, *[None] * 10, self.opening, dump_state(self.dispatcher, self.end))


def fold_slabs(slab_ms: int):
    """Play events that come sorted by city, slab and time, batch by batch: a task holds one batch and the
    state of one slab, however many events the slab has."""
    kinds = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32()}
    schema = pa.schema([(name, kinds[kind]) for name, kind in (part.split() for part in _ROW.split(", "))])

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slab = None

        def table(rows: list[tuple]) -> pa.RecordBatch:
            columns = zip(*rows) if rows else [()] * len(schema)
            return pa.RecordBatch.from_arrays(
                [pa.array(list(column), kind.type) for column, kind in zip(columns, schema)], schema.names)

        for batch in batches:
            rows: list[tuple] = []
            for city, number, *event in zip(*(batch.column(name).to_pylist() for name in _INPUT)):
                if slab is None or slab.key != (city, number):
                    if slab is not None:
                        rows += slab.close()
                    slab = _Slab(city, number, slab_ms)
                rows += slab.play(*event)
            yield table(rows)
        if slab is not None:
            yield table(list(slab.close()))

    return fold


def match_replay(
    pings: DataFrame, requests: DataFrame, slab_seconds: int = SLAB_SECONDS,
    warmup_seconds: int = WARMUP_SECONDS, unit: str = "auto",
) -> DataFrame:
    """Replay the matcher in event time; one row per request. ``date_bucket`` is the day of the decision.

    A city's events form one sequence, but its memory is short. So the sequence is cut into slabs
    that run in parallel, each after a warm-up on the end of the slab before, and each is folded event by
    event from its sorted rows, so that a task holds two minutes of a city. The result is exact
    once every slab has started from the very state its predecessor ended in; slabs that have not
    run again from that state, until none is left. Round n proves at least the first n slabs.
    """
    if slab_seconds < HORIZON or warmup_seconds > slab_seconds:
        raise ValueError("a slab must be as long as the horizon and the warm-up")
    spark = ship(pings.sparkSession)
    slab_ms, warm_ms = slab_seconds * 1000, warmup_seconds * 1000
    # stored once: later rounds read the stale slabs' events from there
    events = settle(as_events(pings, requests, unit).withColumn(
        "slab", F.floor(F.col("event_time") / slab_ms)), "events").withColumn(
        "state", F.lit(None).cast("string"))
    path = scratch_path(spark, "replay")

    def play(frame: DataFrame, number: int) -> None:
        """Write a round: outcomes and states in separate folders."""
        in_order = frame.select(*_INPUT).repartition("city", "slab").sortWithinPartitions(
            "city", "slab", "event_time", F.expr(_RANK), "entity_id", "zone_id", "status", "speed", "latitude", "longitude")
        played = in_order.mapInArrow(fold_slabs(slab_ms), _ROW)
        played.withColumn("part", F.when(F.col("end_state").isNull(), "outcome").otherwise("state")) \
            .write.partitionBy("part").parquet(f"{path}/round={number}")

    def rows(part: str) -> DataFrame:
        table = spark.read.schema(f"{_ROW}, round int, part string").parquet(path)
        return table.filter(F.col("part") == part).drop("part")

    def latest() -> DataFrame:
        """The last round of every slab, as state rows."""
        states = rows("state")
        last = F.max(F.struct("round", "start_state", "end_state")).alias("s")
        return states.groupBy("city", "slab").agg(last).select("city", "slab", "s.*")

    next_start = (F.col("slab") + 1) * slab_ms
    warm = events.filter(F.col("event_time") >= next_start - warm_ms).withColumn(
        "slab", F.col("slab") + 1)
    # A slab that only has warm-up rows matters for requests that wait across its start.
    play(events.unionByName(warm), 0)
    number = 0
    while True:
        known = latest()
        before = known.select("city", (F.col("slab") + 1).alias("slab"),
                              F.col("end_state").alias("state"))
        stale = known.select("city", "slab", "start_state").join(
            before, ["city", "slab"], "full").select(
            "city", "slab", F.coalesce("state", F.lit("")).alias("state"), "start_state").filter(
            # a slab never played starts empty, which is right if nothing is carried into it
            F.coalesce("start_state", F.lit("")) != F.col("state")).drop("start_state")
        stale = stale.persist()
        try:
            if stale.isEmpty():
                break
            number += 1
            opening = stale.select(
                "city", F.lit("state").alias("kind"), "slab", "state",
                (F.col("slab") * slab_ms).alias("event_time"))
            again = events.join(stale.select("city", "slab"), ["city", "slab"], "left_semi")
            play(again.unionByName(opening, allowMissingColumns=True), number)
        finally:
            stale.unpersist()
    final = rows("outcome").join(
        latest().select("city", "slab", "round"), ["city", "slab", "round"], "left_semi")
    return final.select(
        "city", F.date_format(F.timestamp_millis("decided_at"), "yyyy-MM-dd").alias("date_bucket"),
        "created_at", "trip_id", "rider_id", "origin_zone", "destination_zone", "call_type",
        "matched_taxi", "eta_seconds", "status", "decided_at")
