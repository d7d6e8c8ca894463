"""Planned × observed: every planned stop stays visible, reported or not."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stopwise.functions import time as tm

STOP_KEY = ["service_day", "trip_id", "stop_id", "stop_sequence"]


def active_services(days: DataFrame, calendar: DataFrame) -> DataFrame:
    """Services that run on a day by weekday and date range."""
    regular = calendar.where(F.col("origin") == "calendar")
    return (
        days.withColumn("weekday", tm.weekday_name(F.col("service_day")))
        .join(regular, ["schedule_version", "weekday"])
        .where(F.col("service_day").between(F.col("start_date"), F.col("end_date")))
        .select(*days.columns, "service_id")
    )


def calendar_exceptions(days: DataFrame, calendar: DataFrame, kind: int) -> DataFrame:
    """Dated additions (1) or removals (2)."""
    dated = calendar.where(
        (F.col("origin") == "calendar_dates") & (F.col("exception_type") == kind)
    ).select("schedule_version", F.col("exception_date").alias("service_day"), "service_id")
    return days.join(dated, ["schedule_version", "service_day"]).select(*days.columns, "service_id")


def calendar_set(days: DataFrame, calendar: DataFrame) -> DataFrame:
    """(regular UNION additions) EXCEPT removals, with set semantics."""
    return (
        active_services(days, calendar)
        .unionByName(calendar_exceptions(days, calendar, 1))
        .subtract(calendar_exceptions(days, calendar, 2))
    )


def trips_of_services(services: DataFrame, trips: DataFrame) -> DataFrame:
    """Trips of all active services; a trip that several services list comes several times."""
    return services.join(trips, ["schedule_version", "service_id"]).select(
        "service_day", "schedule_version", "version_substituted", "trip_id"
    )


def scheduled_trips(services: DataFrame, trips: DataFrame) -> DataFrame:
    """Distinct trips of all active services."""
    return trips_of_services(services, trips).distinct()


def with_observed_trips(scheduled: DataFrame, seen: DataFrame, days: DataFrame) -> DataFrame:
    """Trips seen in the feed enter the frame even where the calendar misses them."""
    return scheduled.unionByName(seen.join(F.broadcast(days), "service_day")).distinct()


def with_route(trips_of_day: DataFrame, trips: DataFrame) -> DataFrame:
    """Route and direction per trip, looked up before the trips fan out into stops."""
    routes = trips.select("schedule_version", "trip_id", "route_id", "direction")
    return trips_of_day.join(routes, ["schedule_version", "trip_id"])


def with_trip_head(stop_times: DataFrame) -> DataFrame:
    """Marks one stop per trip, so that trips can be counted without a distinct."""
    order = Window.partitionBy("schedule_version", "trip_id").orderBy("stop_sequence", "stop_id")
    return stop_times.withColumn("trip_head", F.row_number().over(order) == 1)


def planned_stops(trips_of_day: DataFrame, stop_times: DataFrame) -> DataFrame:
    """Trips × planned stop times of the same version, seconds turned into timestamps."""
    day = F.col("service_day")
    return (
        trips_of_day.join(stop_times, ["schedule_version", "trip_id"])
        .withColumns(
            {
                "planned_arr": tm.planned_timestamp(day, F.col("arr_sec")),
                "planned_dep": tm.planned_timestamp(day, F.col("dep_sec")),
            }
        )
        .withColumn(
            "service_hour", tm.service_hour(day, F.coalesce("planned_dep", "planned_arr"))
        )
        .drop("arr_sec", "dep_sec")
    )


def last_report_per_stop(reports: DataFrame) -> DataFrame:
    """Last report per planned-stop key.

    The filter on the first row lets Spark cut each key to one row before the shuffle, so a
    key with very many reports does not pile up in one task. Equal times are ordered by the
    reported values, which makes the choice the same in every run.
    """
    newest_first = Window.partitionBy(*STOP_KEY).orderBy(
        F.col("observed_at").desc(),
        F.col("relationship").desc(),
        F.col("delay_arr").desc_nulls_last(),
        F.col("delay_dep").desc_nulls_last(),
    )
    return (
        reports.where(F.col("stop_id").isNotNull())
        .select(
            *STOP_KEY, "relationship", "delay_arr", "delay_dep", "actual_arr", "actual_dep", "observed_at"
        )
        .withColumn("rank", F.row_number().over(newest_first))
        .where(F.col("rank") == 1)
        .drop("rank")
    )


def trip_cancelled(reports: DataFrame) -> DataFrame:
    """Any CANCELED trip-level report per feed day and trip."""
    return (
        reports.where(F.col("stop_id").isNull())
        .groupBy("day_in_feed", "trip_id")
        .agg(F.bool_or(F.col("relationship") == "CANCELED").alias("cancelled"))
    )


def with_trip_cancellation(trips_of_day: DataFrame, cancellations: DataFrame) -> DataFrame:
    """Cancelled on this day, or by a report that names no day.

    Two equi joins instead of one join on `day = day OR day IS NULL`: both hash on the trip
    and nothing doubles when a dated and an undated report exist. Runs on trips, before they
    fan out into stops.
    """
    hit = cancellations.where("cancelled")
    dated = hit.where(F.col("day_in_feed").isNotNull()).select(
        F.col("day_in_feed").alias("service_day"), "trip_id", F.lit(True).alias("dated")
    )
    undated = hit.where(F.col("day_in_feed").isNull()).select("trip_id", F.lit(True).alias("undated"))
    return (
        trips_of_day.join(dated, ["service_day", "trip_id"], "left")
        .join(undated, "trip_id", "left")
        .withColumn(
            "trip_relationship",
            F.when(F.coalesce("dated", "undated", F.lit(False)), F.lit("CANCELED")),
        )
        .drop("dated", "undated")
    )


def planned_x_observed(planned: DataFrame, last_reports: DataFrame) -> DataFrame:
    """Planned stops left-joined with their last report: the frame starts from the plan."""
    observed = last_reports.withColumnRenamed("relationship", "stop_relationship")
    return planned.join(observed, STOP_KEY, "left")
