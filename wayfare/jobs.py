"""Run a job from the command line: ``wayfare <job> key=value ...`` or ``spark-submit``.

    wayfare normaliser servers=broker:9092 checkpoint=/ck/gps
    wayfare demand     root=/topics table=/serving/demand_zones city=Casablanca checkpoint=/ck/demand
    wayfare matches    root=/topics city=Casablanca checkpoint=/ck/match
    wayfare curate     history=/raw/trips.csv into=/curated/trips
    wayfare kpis       trips=/curated/trips table=/serving/demand_zones city=Casablanca
    wayfare train      trips=/curated/trips features=/features into=/models/demand
    wayfare score      requests=/requests trips=/curated/trips model=/models/demand into=/forecasts

Topics are Kafka's with ``servers``, else folders below ``root``. Streaming jobs run until stopped, or
over what there is with ``once=true``. Executors that lack the package get it from the driver.
"""

from __future__ import annotations

import sys

from pyspark.sql import SparkSession

from wayfare import schemas
from wayfare.operators import features, kpi, model, quality, trips
from wayfare.session import build_session, ship
from wayfare.sources import files, serving_tables, topics
from wayfare.streaming import jobs, matcher


def _topic(spark: SparkSession, name: str, servers: str | None, root: str | None):
    return topics.read_topic(spark, name, servers=servers, root=root)


def _trigger(once: str) -> dict:
    return topics.AVAILABLE_NOW if once == "true" else {"processingTime": "10 seconds"}


def normaliser(spark: SparkSession, checkpoint: str, servers: str = "", root: str = "", once: str = "") -> None:
    """Raw pings to anonymised pings."""
    events = jobs.gps_messages(_topic(spark, "raw.gps", servers, root))
    topics.write_topic(events, "processed.gps", checkpoint, servers, root, _trigger(once)).awaitTermination()


def demand(spark: SparkSession, table: str, city: str, checkpoint: str, servers: str = "", root: str = "",
           once: str = "") -> None:
    """Supply and demand windows into their serving table."""
    windows = jobs.demand_stream(
        _topic(spark, "processed.gps", servers, root), _topic(spark, "raw.trips", servers, root), city)
    jobs.start_upsert(windows, table, "demand_zones", checkpoint, _trigger(once)).awaitTermination()


def matches(spark: SparkSession, city: str, checkpoint: str, servers: str = "", root: str = "") -> None:
    """Requests and taxis to match messages."""
    found = matcher.match_stream(
        _topic(spark, "processed.gps", servers, root), _topic(spark, "raw.trips", servers, root), city)
    topics.write_topic(jobs.match_messages(found), "processed.matches", checkpoint, servers, root,
                       {"processingTime": "1 second"}).awaitTermination()


def curate(spark: SparkSession, history: str, into: str) -> None:
    """Trip history to the curated table, partitioned by month."""
    raw = files.read_trips_csv(spark, history, schemas.TRIP_HISTORY)
    complete = quality.dedupe(quality.keep_complete(raw), ["TRIP_ID"], ["TIMESTAMP", "TAXI_ID"])
    files.write_table(trips.curate_trips(trips.remap_polyline(complete)), into, ["year_month"], gather=True)


def kpis(spark: SparkSession, trips: str, table: str, city: str) -> None:
    """Weekly indicators into the serving table of demand."""
    weekly = kpi.weekly_trips(files.read_table(spark, trips))
    serving_tables.upsert(kpi.weekly_to_demand(weekly, city), table, "demand_zones", 0, "weekly")


def train(spark: SparkSession, trips: str, features: str, into: str) -> None:
    """The feature matrix and a model trained on its earlier part; prints the errors on the later."""
    matrix = _features.feature_matrix(files.read_table(spark, trips))
    files.write_table(matrix, features)
    earlier, later = _features.temporal_split(files.read_table(spark, features))
    fitted = model.train(earlier)
    model.save_model(fitted, into)
    print(*model.compare(model.predict(fitted, later), _features.baseline(later)).collect(), sep="\n")


def score(spark: SparkSession, requests: str, trips: str, model: str, into: str) -> None:
    """Forecasts for a table of requests (zone_id, datetime)."""
    slots = _features.slot_demand(files.read_table(spark, trips))
    files.write_table(_model.score(files.read_table(spark, requests), _model.load_model(model), slots), into)


_features, _model = features, model
JOBS = {job.__name__: job for job in (normaliser, demand, matches, curate, kpis, train, score)}


def main(args: list[str] | None = None) -> None:
    args = sys.argv[1:] if args is None else args
    if not args or args[0] not in JOBS:
        sys.exit(__doc__)
    options = dict(arg.split("=", 1) for arg in args[1:])
    spark = build_session(f"wayfare {args[0]}")
    ship(spark)
    JOBS[args[0]](spark, **options)


if __name__ == "__main__":
    main()
