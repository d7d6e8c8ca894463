"""Service-day arithmetic: epochs, planned times beyond 24:00, service hours."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LOCAL_ZONE = "Europe/Berlin"
NIGHT_SHIFT_HOURS = 4


def local_time(epoch: Column) -> Column:
    """UTC epoch seconds -> wall clock without zone (session zone must be UTC)."""
    return F.from_utc_timestamp(F.timestamp_seconds(epoch), LOCAL_ZONE).cast("timestamp_ntz")


def feed_day(text: Column) -> Column:
    """`YYYYMMDD` -> date; any other length, and unreadable text, -> NULL."""
    return F.when(F.length(text) == 8, F.to_date(F.try_to_timestamp(text, F.lit("yyyyMMdd"))))


def gtfs_seconds(text: Column) -> Column:
    """`HH:MM:SS` with hours past 24 -> seconds since the service day began."""

    def part(i: int) -> Column:
        return F.split_part(text, F.lit(":"), F.lit(i)).try_cast("int")

    return part(1) * 3600 + part(2) * 60 + part(3)


def planned_timestamp(day: Column, seconds: Column) -> Column:
    return day.cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)


def service_hour(day: Column, ts: Column) -> Column:
    seconds = F.timestamp_diff("SECOND", day.cast("timestamp_ntz"), ts)
    return F.floor(seconds / F.lit(3600.0)).cast("int")


def service_hour_start(day: Column, hour: Column) -> Column:
    """Inverse of `service_hour`: equals `date_trunc('hour', ts)`."""
    return day.cast("timestamp_ntz") + F.make_dt_interval(hours=hour)


def clock_hour(ts: Column) -> Column:
    """Beginning of the clock hour of a zone-less timestamp."""
    return F.date_trunc("hour", ts).cast("timestamp_ntz")


def service_day(day_in_feed: Column, observed_at: Column) -> Column:
    shifted = observed_at - F.expr(f"INTERVAL '{NIGHT_SHIFT_HOURS}' HOUR")
    return F.coalesce(day_in_feed, F.to_date(shifted))


def weekday_name(day: Column) -> Column:
    return F.lower(F.date_format(day, "EEEE"))


def day_kind(day: Column) -> Column:
    number = F.dayofweek(day)
    return F.when(number == 1, "sunday").when(number == 7, "saturday").otherwise("weekday")


def is_weekend(day: Column) -> Column:
    return F.dayofweek(day).isin(1, 7)
