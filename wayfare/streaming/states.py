"""Streams whose keys keep state that expires: a taxi's usable pings, a trip's latest status.

Every call of the state store from Python is a round trip to the JVM. So keys share a state: they are dealt
by hash to ``SHARDS`` shards, and the state of a shard is a list of parts, each with the columns of up to
``AT_ONCE`` rows as arrays, so that the calls go with the shards and the parts, not with keys or rows. A task holds
the rows of one shard at a time. A checkpoint goes with its number of shards.
"""

from __future__ import annotations

from itertools import islice
from typing import Any, Iterator

from pyspark.sql import Column, DataFrame, Row, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from wayfare.functions.times import event_timestamp, millis_of
from wayfare.operators.dispatch import ELIGIBLE
from wayfare.operators.matching import HORIZON
from wayfare.operators.serving import STATUS_FIELDS, status_events
from wayfare.session import ship

SHARDS = 1024
AT_ONCE = 10_000

_PING = "event_time bigint, latitude double, longitude double, speed double, status string, zone_id int"
INTERVAL = f"city string, taxi_id int, {_PING}, until bigint"
STATUS = ("trip_id string, version int, status string, rider_id int, origin_zone int, destination_zone int, "
          "message string")


def _shard(*key: str, shards: int) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(shards)).cast("int")


def _parts(fields: str) -> str:
    """The type of a part for such rows."""
    named = (field.split() for field in fields.split(","))
    return ", ".join(f"{name} array<{kind}>" for name, kind in named)


def _held(state: Any) -> Iterator[tuple]:
    for part in state.get():
        yield from zip(*part)


def _append(state: Any, rows: Iterator[tuple]) -> None:
    while some := list(islice(rows, AT_ONCE)):
        state.appendValue(tuple(map(list, zip(*some))))


def _replace(state: Any, rows: list[tuple]) -> None:
    state.clear()
    _append(state, iter(rows))


def _rank(event: tuple) -> list:
    return [(x is not None, x) for x in event]


class PingIntervals(StatefulProcessor):
    """The pings of a shard's taxis that the watermark has not passed by the horizon yet.

    A ping is put out when it expires: by then the watermark has passed everything that could
    end its interval, so the order of arrival does not matter and nothing is taken back.
    """

    def __init__(self, horizon: int):
        self.horizon = horizon

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getListState("held", _parts("city string, taxi_id int, " + _PING))

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        first = None

        def fresh() -> Iterator[tuple]:
            nonlocal first
            for r in rows:
                ping = (r.city, r.taxi_id, r.event_time, r.latitude, r.longitude, r.speed, r.status, r.zone_id)
                first = ping[2] if first is None else min(first, ping[2])
                yield ping

        _append(self.held, fresh())
        self.handle.registerTimer((first + self.horizon) * 1000)
        return iter(())

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        until = timerValues.getCurrentWatermarkInMs() // 1000
        pings = sorted(_held(self.held), key=_rank)
        open_ = [p for p in pings if p[2] + self.horizon > until]
        if len(open_) == len(pings):  # an earlier timer of the batch has put them out
            return
        _replace(self.held, open_)
        if open_:
            self.handle.registerTimer((min(p[2] for p in open_) + self.horizon) * 1000)
        for ping, after in zip(pings, [*pings[1:], None]):
            end = ping[2] + self.horizon
            if after and after[:2] == ping[:2]:
                end = min(end, after[2])
            if ping[2] + self.horizon <= until and ping[6] in ELIGIBLE and end > ping[2]:
                yield Row(city=ping[0], taxi_id=ping[1], event_time=ping[2], latitude=ping[3], longitude=ping[4],
                          speed=ping[5], status=ping[6], zone_id=ping[7], until=end)

    def close(self) -> None:
        pass


def ping_interval_stream(pings: DataFrame, delay: str, horizon: int = HORIZON, shards: int = SHARDS) -> DataFrame:
    """``matching.ping_intervals`` for a stream of pings (event times in seconds): each eligible ping with the
    second its taxi stops standing there, as soon as the watermark passes the ping's horizon.

    The state of a taxi are its pings of the horizon and the delay; it is empty when the taxi has been
    silent for so long. A city's fleet is spread over the shards.
    """
    ship(pings.sparkSession)
    if "event_ts" not in pings.columns:
        pings = pings.withColumn("event_ts", event_timestamp(F.col("event_time"), "s")).withWatermark("event_ts", delay)
    return pings.withColumn("shard", _shard("city", "taxi_id", shards=shards)).groupBy("shard").transformWithState(
        statefulProcessor=PingIntervals(horizon), outputStructType=INTERVAL, outputMode="append",
        timeMode="EventTime")


class LatestStatus(StatefulProcessor):
    """The statuses of a shard's trips: a decision outranks a request, then the later one counts, whatever order
    they come in. A trip's state leaves some time after its last change, by event time.

    The state is a list to which changes are appended, a trip's last row counts; it is written anew when rows
    leave or most of them no longer count.
    """

    def __init__(self, keep_ms: int):
        self.keep_ms = keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getListState(
            "last", _parts("trip_id string, stage int, at bigint, version int, " + STATUS.split(", ", 2)[2]))

    def _leaves(self, event: tuple) -> int:
        return millis_of(event[2]) + self.keep_ms

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        best: dict[str, tuple] = {}
        for r in rows:
            event = (r.stage, r.at, *(r[name] for name in STATUS_FIELDS))
            if r.trip_id not in best or _rank(event) > _rank(best[r.trip_id]):
                best[r.trip_id] = event
        known: dict[str, tuple] = {}
        held = 0
        for event in _held(self.last):
            held += 1
            known[event[0]] = event
        changed = []
        for trip, event in best.items():
            old = known.get(trip)
            if old is None or _rank(event) > _rank((old[1], old[2], *old[4:])):
                changed.append((trip, *event[:2], 1 if old is None else old[3] + 1, *event[2:]))
        if not changed:
            return
        known.update((event[0], event) for event in changed)
        if held + len(changed) > 2 * len(known):
            _replace(self.last, list(known.values()))
        else:
            _append(self.last, iter(changed))
        self.handle.registerTimer(min(map(self._leaves, changed)))
        for event in changed:
            yield Row(trip_id=event[0], version=event[3], **dict(zip(STATUS_FIELDS, event[4:])))

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        until = timerValues.getCurrentWatermarkInMs()
        known = {event[0]: event for event in _held(self.last)}
        stay = [event for event in known.values() if self._leaves(event) > until]
        if len(stay) < len(known):  # else they have left with an earlier timer, or a trip has changed since
            _replace(self.last, stay)
        if stay:  # an hour's trips leave together
            self.handle.registerTimer(max(min(map(self._leaves, stay)), until + min(self.keep_ms, 3_600_000)))
        return iter(())

    def close(self) -> None:
        pass


def latest_status_stream(requests: DataFrame, matches: DataFrame, delay: str, keep_hours: int = 24,
                         shards: int = SHARDS) -> DataFrame:
    """``serving.latest_status`` for streams of requests and decisions: a row whenever a trip's status changes,
    ``version`` counts them. Consumers keep the row of the highest version. Events behind the watermark, or
    without a time, are dropped."""
    ship(requests.sparkSession)
    events = status_events(requests, matches).withColumn("event_ts", event_timestamp(F.col("at"))).dropna(subset=["at"])
    events = events.withWatermark("event_ts", delay).withColumn("shard", _shard("trip_id", shards=shards))
    return events.groupBy("shard").transformWithState(
        statefulProcessor=LatestStatus(keep_hours * 3_600_000), outputStructType=STATUS, outputMode="append",
        timeMode="EventTime")


def answered_trips(requests: DataFrame, matches: DataFrame, delay: str, within: str = "10 minutes") -> DataFrame:
    """Each request with its decision, if one comes within the time; without one, when the watermark has passed
    it. Both sides are kept by trip until then and no longer.

    ``requests`` has ``trip_id``, ``requested_at``, ``matches`` ``trip_id``, ``decided_at`` and ``status``; times are
    detected to be seconds or milliseconds.
    """
    asked = requests.withColumn("asked_ts", event_timestamp(F.col("requested_at"))).withWatermark(
        "asked_ts", delay).select("trip_id", "requested_at", "asked_ts")
    decided = matches.withColumn("decided_ts", event_timestamp(F.col("decided_at"))).withWatermark(
        "decided_ts", delay).select(F.col("trip_id").alias("decided_trip"), "decided_ts", "status")
    met = (F.col("trip_id") == F.col("decided_trip")) & (F.col("decided_ts") >= F.col("asked_ts")) & (
        F.col("decided_ts") <= F.col("asked_ts") + F.expr(f"INTERVAL {within}"))
    return asked.join(decided, met, "left").select(
        "trip_id", "requested_at", F.coalesce("status", F.lit("UNANSWERED")).alias("status"),
        ((F.unix_millis("decided_ts") - F.unix_millis("asked_ts")) / 1000).alias("waited_seconds"))
