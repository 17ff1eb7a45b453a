"""Epoch numbers, timestamps and calendar parts (session time zone: UTC)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# An epoch value from 1e11 on is read as milliseconds (1e11 s lies in the year 5138).
MILLIS_FROM = 100_000_000_000


def to_millis(epoch: Column, unit: str = "auto") -> Column:
    epoch = epoch.cast("bigint")
    if unit == "ms":
        return epoch
    if unit == "s":
        return epoch * 1000
    if unit == "auto":
        return F.when(epoch >= MILLIS_FROM, epoch).otherwise(epoch * 1000)
    raise ValueError(f"unknown epoch unit {unit!r}")


def millis_of(epoch: int) -> int:
    """The same for a single number, the unit detected."""
    return epoch if epoch >= MILLIS_FROM else epoch * 1000


def event_timestamp(epoch: Column, unit: str = "auto") -> Column:
    return F.timestamp_millis(to_millis(epoch, unit))


def epoch_seconds(ts: Column) -> Column:
    return F.unix_timestamp(ts)


def seconds_to_timestamp(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds).cast("timestamp_ntz")


def slot_start_seconds(ts: Column, seconds: int = 1800) -> Column:
    epoch = epoch_seconds(ts)
    return epoch - F.pmod(epoch, F.lit(seconds))


def week_start(ts: Column) -> Column:
    """Monday 00:00 of the week."""
    return F.date_trunc("week", ts).cast("timestamp_ntz")


def year_month(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")


def calendar_parts(ts: Column) -> dict[str, Column]:
    """Time features shared by training and scoring; weekday 1 = Sunday."""
    weekday = F.dayofweek(ts)
    return {
        "hour_of_day": F.hour(ts),
        "day_of_week": weekday,
        "is_weekend": F.when(weekday.isin(1, 7), 1).otherwise(0),
        "is_friday": F.when(weekday == 6, 1).otherwise(0),
    }
