"""The live matcher: keyed state per city, processing-time timers."""

from __future__ import annotations

from typing import Any, Iterator

from pyspark.sql import DataFrame, Row, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from wayfare.functions import messages
from wayfare.functions.times import millis_of
from wayfare.operators.dispatch import Dispatcher, Outcome, Request, Taxi, STALE_MS, WAIT_MS

RESULT = (
    "city string, date_bucket string, created_at bigint, trip_id string, rider_id string, "
    "origin_zone int, destination_zone int, call_type string, matched_taxi string, "
    "eta_seconds int, status string, decided_at bigint"
)
_TAXI = "zone_id int, latitude double, longitude double, speed double, seen bigint"
_REQUEST = (
    "trip_id string, rider_id string, origin_zone int, destination_zone int, call_type string, "
    "created_at bigint, latitude double, longitude double, asked_at bigint"
)


def _day(millis: int) -> str:
    import datetime

    return datetime.datetime.fromtimestamp(millis / 1000, datetime.UTC).strftime("%Y-%m-%d")


class TripMatcher(StatefulProcessor):
    """Usable taxis and waiting requests of one city.

    A call reads the city's state once, plays the rows of the micro-batch in order (time, pings
    before requests, id) and writes back what changed. Taxis leave the state by themselves some
    time after they have gone stale.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.taxis = handle.getMapState("taxis", "taxi_id string", _TAXI, 5 * STALE_MS)
        self.parked = handle.getMapState("parked", "trip_id string", _REQUEST)

    def _load(self, now: int) -> Dispatcher:
        dispatcher = Dispatcher()
        for (taxi_id,), state in self.taxis.iterator():
            taxi = Taxi(*state)
            if now - taxi.seen < STALE_MS:
                dispatcher.place(taxi_id, taxi)
        for (trip_id,), state in self.parked.iterator():
            dispatcher.parked[trip_id] = Request(*state)
        return dispatcher

    def _store(self, dispatcher: Dispatcher, taxis: dict, parked: dict) -> None:
        for taxi_id in taxis.keys() - dispatcher.taxis.keys():
            self.taxis.removeKey((taxi_id,))
        for taxi_id, taxi in dispatcher.taxis.items():
            if taxis.get(taxi_id) != taxi:
                self.taxis.updateValue((taxi_id,), tuple(taxi))
        for trip_id in parked.keys() - dispatcher.parked.keys():
            self.parked.removeKey((trip_id,))
        for trip_id, request in dispatcher.parked.items():
            if trip_id not in parked:
                self.parked.updateValue((trip_id,), tuple(request))

    def _row(self, city: str, outcome: Outcome) -> Row:
        r = outcome.request
        return Row(
            city=city, date_bucket=_day(outcome.decided_at), created_at=r.created_at,
            trip_id=r.trip_id, rider_id=r.rider_id, origin_zone=r.origin_zone,
            destination_zone=r.destination_zone, call_type=r.call_type,
            matched_taxi=outcome.matched_taxi, eta_seconds=outcome.eta_seconds,
            status=outcome.status, decided_at=outcome.decided_at)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        now = timerValues.getCurrentProcessingTimeInMs()
        dispatcher = self._load(now)
        taxis, parked = dict(dispatcher.taxis), dict(dispatcher.parked)
        waiting = False
        ordered = sorted(rows, key=lambda r: (
            millis_of(r.event_time or 0), r.kind != "ping", r.entity_id, r.zone_id, r.status or "",
            r.speed or 0.0, r.latitude or 0.0, r.longitude or 0.0))
        for row in ordered:
            if row.kind == "ping":
                taxi = Taxi(row.zone_id, row.latitude, row.longitude, row.speed, now)
                dispatcher.ping(row.entity_id, taxi, row.status)
                continue
            outcome = dispatcher.request(Request(
                row.entity_id, row.rider_id, row.zone_id, row.destination_zone, row.call_type,
                row.event_time if row.event_time is not None else now, row.latitude,
                row.longitude, now if row.event_time is None else millis_of(row.event_time)), now)
            if outcome is None:
                waiting = True
            else:
                yield self._row(key[0], outcome)
        if waiting:
            self.handle.registerTimer(now + WAIT_MS)
        self._store(dispatcher, taxis, parked)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        now = timerValues.getCurrentProcessingTimeInMs()
        dispatcher = self._load(now)
        taxis, parked = dict(dispatcher.taxis), dict(dispatcher.parked)
        for outcome in dispatcher.settle(now):
            yield self._row(key[0], outcome)
        self._store(dispatcher, taxis, parked)

    def close(self) -> None:
        pass


def match_stream(pings: DataFrame, trips: DataFrame, city: str) -> DataFrame:
    """Normalised ping messages and request messages to match rows.

    The city is the unit of matching and of parallelism: its arrivals form one sequence. A live
    city's rate is bounded by its fleet; for whole histories use the replay, which splits them.
    """
    tagged = messages.tag(pings, "gps", city).unionByName(messages.tag(trips, "trip", city))
    return messages.match_events(tagged).groupBy("city").transformWithState(
        statefulProcessor=TripMatcher(), outputStructType=RESULT, outputMode="append",
        timeMode="ProcessingTime")


def serving_rows(matches: DataFrame) -> DataFrame:
    """Match rows as the serving table takes them; rows without a numeric rider are left out."""
    return messages.clean_rider_id(matches).select(
        "city", "date_bucket", "created_at", "trip_id", "rider_id", "origin_zone",
        "destination_zone", "call_type", "matched_taxi", "eta_seconds", "status")
