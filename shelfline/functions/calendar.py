"""Date and hour expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Trading hours, first hour inclusive, last hour exclusive.
OPEN_HOUR = 6
CLOSE_HOUR = 22


def event_ts(dt: Column, hour: Column) -> Column:
    """Start of an hour slot as a zone-free timestamp."""
    return dt.cast("date").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), hour.cast("int"))


def is_operational(hour: Column, start: int = OPEN_HOUR, end: int = CLOSE_HOUR) -> Column:
    return (hour >= start) & (hour < end)


def part_of_day(hour: Column) -> Column:
    # Morning 6-11, Afternoon 12-17, Evening 18-21, Night otherwise.
    return (
        F.when(hour.between(6, 11), "Morning")
        .when(hour.between(12, 17), "Afternoon")
        .when(hour.between(18, 21), "Evening")
        .otherwise("Night")
    )


def calendar_cols(dt: Column) -> dict[str, Column]:
    """``day_of_week`` counts from 1 = Sunday, ``iso_dow0`` from 0 = Monday."""
    return {
        "day_of_week": F.dayofweek(dt),
        "iso_dow0": F.weekday(dt),
        "is_weekend": F.weekday(dt) >= 5,
        "week_of_year": F.weekofyear(dt),
        "month": F.month(dt),
    }


def date_key(dt: Column) -> Column:
    """YYYYMMDD as an int."""
    return F.year(dt) * 10000 + F.month(dt) * 100 + F.dayofmonth(dt)


def parts_from_key(key: Column, hour: Column) -> dict[str, Column]:
    """Year, month, day and hour back from a YYYYMMDD key and an hour key."""
    key = key.cast("int")
    return {
        "year": F.floor(key / 10000).cast("int"),
        "month": (F.floor(key / 100) % 100).cast("int"),
        "day": (key % 100).cast("int"),
        "hour": hour.cast("int"),
    }


def cyclical(col: Column, period: int) -> tuple[Column, Column]:
    angle = col * (2 * math.pi / period)
    return F.sin(angle), F.cos(angle)


def epoch_day(dt: Column) -> Column:
    return F.unix_date(dt)


def next_delivery(order_ts: Column, weekdays: list[int], cutoff_hours: int = 12, arrival_hour: int = 5) -> Column:
    """First delivery day (0 = Monday) whose arrival is at least the cutoff away.

    A week has seven days, so eight candidate days always hold one that fits.
    """
    first = order_ts.cast("date")
    days = F.sequence(first, F.date_add(first, 8))
    earliest = order_ts + F.make_dt_interval(F.lit(0), F.lit(cutoff_hours))
    fits = F.filter(
        days,
        lambda d: F.weekday(d).isin(*weekdays)
        & ((d.cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(arrival_hour))) >= earliest),
    )
    return F.array_min(fits)
