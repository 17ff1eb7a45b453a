"""The matching rules for one city, as a small state machine shared by replay and stream.

A ping makes a taxi available in a zone until it is taken, pings again or is 120 s old. A request
takes a taxi of its own zone at once, or waits; the first timer to expire settles all waiting
requests: own zone again, then the zone below, then the zone above, else unfulfilled.
"""

from __future__ import annotations

import heapq
import math
from typing import Iterator, NamedTuple

from wayfare.functions.geo import DEFAULT_ETA, EARTH_KM, MIN_ETA, MIN_SPEED, NEIGHBOUR_PENALTY

ELIGIBLE = frozenset({"AVAILABLE", "EN_ROUTE"})
STALE_MS = 120_000
WAIT_MS = 5_000


class Taxi(NamedTuple):
    zone_id: int
    latitude: float
    longitude: float
    speed: float
    seen: int


class Request(NamedTuple):
    trip_id: str
    rider_id: str
    origin_zone: int
    destination_zone: int
    call_type: str
    created_at: int
    latitude: float | None
    longitude: float | None
    asked_at: int  # milliseconds, whatever unit created_at was sent in


class Outcome(NamedTuple):
    request: Request
    matched_taxi: str
    eta_seconds: int
    status: str
    decided_at: int


def taxi_rank(taxi_id: str) -> tuple[int, str]:
    """Order of taxi ids: numbers by value."""
    return len(taxi_id), taxi_id


def _known(value) -> bool:
    return value is not None and not math.isnan(value)


def _eta(request: Request, taxi: Taxi) -> int:
    if not (_known(request.latitude) and _known(request.longitude)):
        return DEFAULT_ETA
    lat1, lat2 = math.radians(request.latitude), math.radians(taxi.latitude)
    dlon = math.radians(taxi.longitude - request.longitude)
    chord = math.sin((lat2 - lat1) / 2) ** 2 + \
        math.cos(lat1) * math.cos(lat2) * math.sin(dlon / 2) ** 2
    km = 2 * EARTH_KM * math.atan2(math.sqrt(chord), math.sqrt(1 - chord))
    return max(MIN_ETA, int(km / max(taxi.speed, MIN_SPEED) * 3600))


class Dispatcher:
    def __init__(self) -> None:
        self.taxis: dict[str, Taxi] = {}
        self.parked: dict[str, Request] = {}
        self.timers: list[int] = []
        self._free: dict[int, list[tuple[int, str]]] = {}
        self._listed: set[tuple[int, str]] = set()

    def place(self, taxi_id: str, taxi: Taxi) -> None:
        self.taxis[taxi_id] = taxi
        if (taxi.zone_id, taxi_id) not in self._listed:
            self._listed.add((taxi.zone_id, taxi_id))
            heapq.heappush(self._free.setdefault(taxi.zone_id, []), taxi_rank(taxi_id))

    def ping(self, taxi_id: str, taxi: Taxi, status: str) -> None:
        if status in ELIGIBLE:
            self.place(taxi_id, taxi)
        else:
            self.taxis.pop(taxi_id, None)

    def forget(self, now: int) -> None:
        """Drop taxis that are too old for any request from now on."""
        fresh = [(key, taxi) for key, taxi in self.taxis.items() if now - taxi.seen < STALE_MS]
        self.taxis, self._free, self._listed = {}, {}, set()
        for key, taxi in fresh:
            self.place(key, taxi)

    def _find(self, zone: int, now: int) -> str | None:
        """Smallest eligible taxi of the zone; entries that no longer hold are dropped."""
        heap = self._free.get(zone)
        while heap:
            taxi_id = heap[0][1]
            taxi = self.taxis.get(taxi_id)
            if taxi is not None and taxi.zone_id == zone and now - taxi.seen < STALE_MS:
                return taxi_id
            heapq.heappop(heap)
            self._listed.discard((zone, taxi_id))
        return None

    def _take(self, request: Request, zone: int, status: str, now: int) -> Outcome | None:
        taxi_id = self._find(zone, now)
        if taxi_id is None:
            return None
        eta = _eta(request, self.taxis.pop(taxi_id))
        if status == "MATCHED_FALLBACK":
            eta += NEIGHBOUR_PENALTY
        return Outcome(request, taxi_id, eta, status, now)

    def request(self, request: Request, now: int) -> Outcome | None:
        """The match, or None: then the request waits and a timer is set."""
        outcome = self._take(request, request.origin_zone, "MATCHED_EXACT", now)
        if outcome is None:
            self.parked[request.trip_id] = request
            heapq.heappush(self.timers, now + WAIT_MS)
        return outcome

    def settle(self, now: int) -> Iterator[Outcome]:
        """Decide every waiting request, in order of request time and id."""
        waiting = sorted(self.parked.values(), key=lambda r: (r.asked_at, r.trip_id))
        self.parked.clear()
        for request in waiting:
            zone = request.origin_zone
            yield (
                self._take(request, zone, "MATCHED_DELAYED_EXACT", now)
                or self._take(request, zone - 1, "MATCHED_FALLBACK", now)
                or self._take(request, zone + 1, "MATCHED_FALLBACK", now)
                or Outcome(request, "NONE", 0, "UNFULFILLED", now))

    def expire(self, until: int) -> Iterator[Outcome]:
        """Run the timers due by ``until``, the earliest first."""
        while self.timers and self.timers[0] <= until:
            yield from self.settle(heapq.heappop(self.timers))
