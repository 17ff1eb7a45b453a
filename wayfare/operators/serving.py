"""What a booking service needs from the tables: request intake and the state of every trip."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from wayfare.functions.casts import to_int

CALL_TYPES = ("A", "B", "C")
PENDING_MESSAGE = "Trip reserved, finding a driver..."


def intake_requests(
    df: DataFrame, requested_at: Column, call_types: tuple[str, ...] = CALL_TYPES,
) -> tuple[DataFrame, DataFrame]:
    """Split request bodies (text columns) into accepted requests and rejected ones with reasons.

    Accepted requests get the call type A by default, a time, the status PENDING, a message and,
    unless they bring one, an id made from their content, which a retried task makes again.
    """
    numbers = ["rider_id", "origin_zone", "destination_zone"]
    text = {name: F.col(name).cast("string") for name in numbers}
    call = F.coalesce("call_type", F.lit("A"))
    own_id = F.md5(F.to_json(F.struct(*numbers, "call_type", requested_at.alias("at"))))
    trip_id = F.coalesce(F.col("trip_id").cast("string"), own_id) if "trip_id" in df.columns \
        else own_id
    faults = [
        *[F.when(text[name].isNull(), f"missing:{name}").when(
            to_int(text[name]).isNull(), f"not a number:{name}") for name in numbers],
        F.when(~call.isin(*call_types), "unknown:call_type"),
    ]
    checked = df.withColumns({
        "reasons": F.array_compact(F.array(*faults)), "trip_id": trip_id,
        "requested_at": requested_at, "call_type": call})
    accepted = checked.filter(F.size("reasons") == 0).withColumns({
        **{name: to_int(text[name]) for name in numbers},
        "status": F.lit("PENDING"), "message": F.lit(PENDING_MESSAGE)}).select(
        "trip_id", *numbers, "call_type", "requested_at", "status", "message")
    return accepted, checked.filter(F.size("reasons") > 0)


STATUS_FIELDS = ["status", "rider_id", "origin_zone", "destination_zone", "message"]


def status_events(requests: DataFrame, matches: DataFrame) -> DataFrame:
    """Requests and decisions as rows of one shape; ``stage`` and ``at`` say which of a trip's is the newest.
    For tables and streams."""
    asked = requests.select(
        "trip_id", F.lit(0).alias("stage"), F.col("requested_at").cast("bigint").alias("at"),
        F.lit("PENDING").alias("status"), "rider_id", "origin_zone", "destination_zone",
        F.lit(PENDING_MESSAGE).alias("message"))
    decided = matches.select(
        "trip_id", F.lit(1).alias("stage"), F.col("created_at").cast("bigint").alias("at"),
        F.coalesce("status", F.lit("UNKNOWN")).alias("status"),
        F.col("rider_id").cast("int").alias("rider_id"), "origin_zone", "destination_zone",
        F.lit("").alias("message"))
    return asked.unionByName(decided).filter(F.col("trip_id").isNotNull())


def latest_status(requests: DataFrame, matches: DataFrame) -> DataFrame:
    """The current state of each trip: PENDING until a match event says otherwise.

    An aggregate per trip; events of one trip collapse on the map side.
    """
    last = F.max(F.struct("stage", "at", *STATUS_FIELDS)).alias("last")
    return status_events(requests, matches).groupBy("trip_id").agg(last).select(
        "trip_id", *[f"last.{name}" for name in STATUS_FIELDS])
