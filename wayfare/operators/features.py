"""Demand per zone and half hour, and the features a forecast needs."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

from wayfare.functions.times import calendar_parts, epoch_seconds, slot_start_seconds, \
    seconds_to_timestamp
from wayfare.session import settle

DAY = 86_400
WEEK = 7 * DAY
SLOT = 1800

# What a forecast is made from, in the order the model takes it.
FEATURES = [
    "zone_id", "hour_of_day", "day_of_week", "is_weekend", "is_friday", "is_raining",
    "demand_lag_1d", "demand_lag_7d", "rolling_7d_mean",
]
TARGET = "demand"


def months(trips: DataFrame) -> DataFrame:
    return trips.select("year_month").distinct().orderBy("year_month")


def slot_demand(trips: DataFrame, seconds: int = SLOT) -> DataFrame:
    """Trips per zone and slot; slots without trips have no row."""
    slot = slot_start_seconds(F.col("trip_start"), seconds)
    return trips.groupBy("zone_id", slot.alias("slot_ts")).agg(
        F.count("*").alias("demand")).select(
        "zone_id", seconds_to_timestamp(F.col("slot_ts")).alias("slot_start"), "slot_ts", "demand")


def add_temporal(slots: DataFrame, ts: str = "slot_start") -> DataFrame:
    return slots.withColumns({
        "slot_date": F.to_date(ts), **calendar_parts(F.col(ts))})


def add_weather(slots: DataFrame, weather: DataFrame | None = None) -> DataFrame:
    """``is_raining`` from a table (zone_id, slot_ts, is_raining) where given, else 0."""
    if weather is None:
        return slots.withColumn("is_raining", F.lit(0))
    return slots.join(weather.select("zone_id", "slot_ts", "is_raining"),
                      ["zone_id", "slot_ts"], "left").fillna({"is_raining": 0})


def add_lags(slots: DataFrame, days: tuple[int, ...] = (1, 7)) -> DataFrame:
    """Demand of the same zone exactly that many days ago, 0 if the slot had no trip.

    A join on the computed slot, because the grid has gaps; (zone, slot) is unique on both sides.
    The slots, small next to the trips they come from, are written once and read for each lag.
    """
    slots = result = settle(slots, "slots")
    for day in days:
        earlier = slots.select(
            "zone_id", (F.col("slot_ts") + day * DAY).alias("slot_ts"),
            F.col("demand").alias(f"demand_lag_{day}d"))
        result = result.join(earlier, ["zone_id", "slot_ts"], "left")
    return result.fillna(0, subset=[f"demand_lag_{day}d" for day in days])


def _look_back(slots: DataFrame, columns: dict[str, tuple[Column, int, int]], reach: int) -> DataFrame:
    """Range aggregates over at most ``reach`` seconds back, split along time as well as by zone.

    The time axis is cut into blocks as long as the reach. Each row also joins the following block
    as context, so that a zone's whole history never has to be in one task.
    """
    block = F.floor(F.col("slot_ts") / reach)
    spread = slots.withColumn("_own", block).withColumn(
        "_block", F.explode(F.array(F.col("_own"), F.col("_own") + 1)))
    frame = Window.partitionBy("zone_id", "_block").orderBy("slot_ts")
    looked = spread.withColumns({
        name: agg.over(frame.rangeBetween(low, high))
        for name, (agg, low, high) in columns.items()})
    return looked.filter(F.col("_own") == F.col("_block")).drop("_own", "_block")


def add_rolling(slots: DataFrame) -> DataFrame:
    """Mean demand of the seven days before the slot, 0.0 if there was none."""
    mean = {"rolling_7d_mean": (F.avg("demand"), -WEEK, -1)}
    return _look_back(slots, mean, WEEK).fillna(0.0, subset=["rolling_7d_mean"])


_HISTORY = {
    "demand_lag_1d": (F.max, -DAY, -DAY),
    "demand_lag_7d": (F.max, -WEEK, -WEEK),
    "rolling_7d_mean": (F.avg, -WEEK, -1),
}


def add_history(slots: DataFrame) -> DataFrame:
    """Both lags and the rolling mean in one pass over the same windows."""
    looks = {name: (agg("demand"), low, high) for name, (agg, low, high) in _HISTORY.items()}
    return _look_back(slots, looks, WEEK).fillna(0, subset=["demand_lag_1d", "demand_lag_7d"]) \
        .fillna(0.0, subset=["rolling_7d_mean"])


def history_at(wanted: DataFrame, slots: DataFrame) -> DataFrame:
    """Lags and rolling mean for distinct (zone_id, slot_ts) rows, whether or not they had trips."""
    known = slots.select("zone_id", "slot_ts", "demand", F.lit(False).alias("_wanted"))
    asked = wanted.select("zone_id", "slot_ts", F.lit(None).cast("bigint").alias("demand"),
                          F.lit(True).alias("_wanted"))
    return add_history(known.unionByName(asked)).filter("_wanted").drop("_wanted", "demand")


def feature_matrix(trips: DataFrame, weather: DataFrame | None = None) -> DataFrame:
    slots = add_weather(add_temporal(slot_demand(trips)), weather)
    return add_history(slots).select(
        "zone_id", "slot_start", "slot_date", "slot_ts", "hour_of_day", "day_of_week",
        "is_weekend", "is_friday", "is_raining", "demand", "demand_lag_1d", "demand_lag_7d",
        "rolling_7d_mean")


def cast_numeric(features: DataFrame, columns: list[str] = (*FEATURES, TARGET)) -> DataFrame:
    """Features and target as doubles, unknown values as 0."""
    return features.withColumns({
        name: F.coalesce(F.col(name).cast("double"), F.lit(0.0)) for name in columns})


def date_range(features: DataFrame) -> DataFrame:
    return features.agg(F.min("slot_date").alias("min_date"), F.max("slot_date").alias("max_date"))


def cutoff_expr(low: Column, high: Column, train_months: int = 10) -> Column:
    """First test day: ten months in, or half way if the data spans less than 30 days."""
    span = F.date_diff(high, low)
    half = F.greatest(F.lit(1), F.floor(span / 2).cast("int"))
    return F.when(span < 30, F.date_add(low, half)).otherwise(F.add_months(low, train_months))


def cutoff_date(features: DataFrame, train_months: int = 10) -> datetime.date | None:
    """The split date as a constant, so that the split prunes the scan like any literal filter."""
    return date_range(features).select(
        cutoff_expr(F.col("min_date"), F.col("max_date"), train_months)).first()[0]


def temporal_split(features: DataFrame, train_months: int = 10) -> tuple[DataFrame, DataFrame]:
    """Rows before the cutoff to train on, the later ones to test on."""
    cutoff = F.lit(cutoff_date(features, train_months))
    return features.filter(F.col("slot_date") < cutoff), features.filter(
        F.col("slot_date") >= cutoff)


def baseline(test: DataFrame) -> DataFrame:
    """Predict the demand of seven days ago, on rows that have one (on all rows if none has)."""
    known = test.filter(F.col("demand_lag_7d") > 0)
    chosen = test if known.isEmpty() else known
    return chosen.withColumn("prediction", F.col("demand_lag_7d").cast("double"))


def rmse_by_zone(predictions: DataFrame, name: str = "rmse") -> DataFrame:
    error = F.col("prediction") - F.col("demand")
    return predictions.groupBy("zone_id").agg(
        F.sqrt(F.avg(error * error)).alias(name), F.count("*").alias("n_slots"))


def compare_by_zone(model: DataFrame, naive: DataFrame) -> DataFrame:
    """Error of model and baseline side by side; zones without a baseline keep a null."""
    return rmse_by_zone(model, "rmse_gbt").join(
        rmse_by_zone(naive, "rmse_baseline").drop("n_slots"), "zone_id", "left").orderBy("zone_id")
