"""Raw tables -> typed tables with one naming for both sources."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopwise.functions import text as tx
from stopwise.functions import time as tm
from stopwise.functions import values as vl

WEEKDAYS = ["monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"]


def normalise_report(raw: DataFrame) -> DataFrame:
    """Trimmed, renamed and typed reports; rows without a trip id drop out."""
    return raw.where(F.trim("trip_id") != "").select(
        F.trim("trip_id").alias("trip_id"),
        tx.clean(F.col("stop_id")).alias("stop_id"),
        "stop_sequence",
        F.trim("schedule_relationship").alias("relationship"),
        F.col("arrival_delay").alias("delay_arr"),
        F.col("departure_delay").alias("delay_dep"),
        tm.local_time(F.col("arrival_time")).alias("actual_arr"),
        tm.local_time(F.col("departure_time")).alias("actual_dep"),
        tm.local_time(F.col("observed_at")).alias("observed_at"),
        tm.feed_day(tx.clean(F.col("betriebstag"))).alias("day_in_feed"),
    )


def with_service_day(reports: DataFrame) -> DataFrame:
    return reports.withColumns(
        {
            "service_day": tm.service_day(F.col("day_in_feed"), F.col("observed_at")),
            "day_estimated": F.col("day_in_feed").isNull(),
        }
    )


def trip_reports(reports: DataFrame) -> DataFrame:
    """First, last and number of trip-level reports per trip, feed day and relationship."""
    return (
        reports.where(F.col("stop_id").isNull())
        .groupBy("trip_id", "day_in_feed", "relationship")
        .agg(
            F.min("observed_at").alias("first_seen"),
            F.max("observed_at").alias("last_seen"),
            F.count("*").alias("reports"),
        )
    )


def stage_trips(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.trim("trip_id").alias("trip_id"),
        F.trim("route_id").alias("route_id"),
        F.trim("service_id").alias("service_id"),
        vl.tolerant_cast(F.col("direction_id"), "tinyint").alias("direction"),
        F.col("v").alias("schedule_version"),
    )


def stage_lines(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.trim("route_id").alias("route_id"),
        F.trim("route_short_name").alias("line"),
        F.trim("route_long_name").alias("route_text"),
        F.col("route_type"),
        vl.mode_of(F.col("route_type")).alias("mode"),
        F.col("v").alias("schedule_version"),
    )


def stage_stop_times(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.trim("trip_id").alias("trip_id"),
        F.trim("stop_id").alias("stop_id"),
        "stop_sequence",
        tm.gtfs_seconds(tx.clean(F.col("arrival_time"))).alias("arr_sec"),
        tm.gtfs_seconds(tx.clean(F.col("departure_time"))).alias("dep_sec"),
        F.col("v").alias("schedule_version"),
    )


def stage_stops(raw: DataFrame) -> DataFrame:
    """Stops of the first source: the station comes from the parent or the id itself."""
    stop_id = F.trim("stop_id")
    parent = tx.clean(F.col("parent_station"))
    source = tx.station_source(parent, stop_id)
    return raw.select(
        stop_id.alias("stop_id"),
        F.trim("stop_name").alias("stop_name"),
        parent.alias("parent_station"),
        source.alias("station_source"),
        tx.station_key(source).alias("station_id"),
        tx.station_name(F.trim("stop_name")).alias("station_name"),
        vl.tolerant_cast(F.col("stop_lat"), "double").alias("lat"),
        vl.tolerant_cast(F.col("stop_lon"), "double").alias("lon"),
        F.col("v").alias("schedule_version"),
    )


def stage_second_stops(raw: DataFrame) -> DataFrame:
    """Stops of the second source: the station is the parent, else the stop itself."""
    parent = tx.clean(F.col("parent_station"))
    return raw.select(
        F.trim("stop_id").alias("stop_id"),
        F.trim("stop_name").alias("stop_name"),
        parent.alias("parent_station"),
        tx.clean(F.col("platform_code")).alias("platform"),
        vl.tolerant_cast(F.col("location_type"), "tinyint").alias("location_type"),
        F.coalesce(parent, F.trim("stop_id")).alias("station_id"),
        F.trim("stop_name").alias("station_name"),
        vl.tolerant_cast(F.col("stop_lat"), "double").alias("lat"),
        vl.tolerant_cast(F.col("stop_lon"), "double").alias("lon"),
        F.col("v").alias("schedule_version"),
    )


def calendar_long(calendar: DataFrame, dates: DataFrame | None = None) -> DataFrame:
    """Weekday flags -> one row per valid weekday, together with the dated exceptions."""
    regular = (
        calendar.select(
            F.trim("service_id").alias("service_id"),
            F.col("v").alias("schedule_version"),
            tm.feed_day(tx.clean(F.col("start_date"))).alias("start_date"),
            tm.feed_day(tx.clean(F.col("end_date"))).alias("end_date"),
            *WEEKDAYS,
        )
        .unpivot(
            ["service_id", "schedule_version", "start_date", "end_date"],
            WEEKDAYS,
            "weekday",
            "flag",
        )
        .where(F.trim("flag") == "1")
        .select(
            "service_id",
            "schedule_version",
            F.lit("calendar").alias("origin"),
            "weekday",
            "start_date",
            "end_date",
            F.lit(None).cast("date").alias("exception_date"),
            F.lit(None).cast("tinyint").alias("exception_type"),
        )
    )
    if dates is None:
        return regular
    exceptions = dates.select(
        F.trim("service_id").alias("service_id"),
        F.col("v").alias("schedule_version"),
        F.lit("calendar_dates").alias("origin"),
        F.lit(None).cast("string").alias("weekday"),
        F.lit(None).cast("date").alias("start_date"),
        F.lit(None).cast("date").alias("end_date"),
        tm.feed_day(F.trim("date")).alias("exception_date"),
        vl.tolerant_cast(F.col("exception_type"), "tinyint").alias("exception_type"),
    )
    return regular.unionByName(exceptions)
