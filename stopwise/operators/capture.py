"""Was the collector running? Hours with planned traffic against hours with reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopwise.functions import time as tm
from stopwise.functions import values as vl


def collected_hours(reports: DataFrame) -> DataFrame:
    """Reports per clock hour, whatever their service day."""
    return (
        reports.where(F.col("observed_at").isNotNull())
        .groupBy(tm.clock_hour(F.col("observed_at")).alias("hour_start"))
        .agg(F.count("*").alias("reports"))
    )


def expected_hours(frame: DataFrame) -> DataFrame:
    return frame.where(F.col("service_hour").isNotNull()).select("service_day", "service_hour").distinct()


def capture_join(expected: DataFrame, collected: DataFrame) -> DataFrame:
    start = tm.service_hour_start(F.col("service_day"), F.col("service_hour"))
    return (
        expected.withColumn("hour_start", start)
        .join(collected, "hour_start", "left")
        .select(
            "service_day",
            "service_hour",
            F.coalesce("reports", F.lit(0)).alias("reports"),
            (F.coalesce("reports", F.lit(0)) > 0).alias("captured"),
        )
    )


def capture_gaps(frame: DataFrame, reports: DataFrame) -> DataFrame:
    return capture_join(expected_hours(frame), collected_hours(reports))


def state_join(frame: DataFrame, collected: DataFrame) -> DataFrame:
    """Planned × observed with its state; a stop without planned hour counts as captured.

    The clock hours of the collector are joined directly: every planned hour of the frame is
    an expected hour, so building the gap table first would only compute the frame twice.
    There is one row per clock hour of the history, which bounds the broadcast.
    """
    hours = F.broadcast(collected.select("hour_start", F.lit(True).alias("captured")))
    start = tm.service_hour_start(F.col("service_day"), F.col("service_hour"))
    captured = F.coalesce("captured", F.col("service_hour").isNull())
    return (
        frame.withColumn("hour_start", start)
        .join(hours, "hour_start", "left")
        .withColumn(
            "state",
            vl.stop_state(
                F.col("trip_relationship"),
                F.col("stop_relationship"),
                F.col("delay_arr"),
                F.col("delay_dep"),
                captured,
            ),
        )
        .drop("captured", "hour_start")
    )


def unmatched_reports(reports: DataFrame, chosen_days: DataFrame, trips: DataFrame) -> DataFrame:
    """Per day: observed trips and stops, and those whose trip the chosen version lacks."""
    stops = (
        reports.where(F.col("stop_id").isNotNull())
        .select("service_day", "trip_id", "stop_id", "stop_sequence")
        .distinct()
    )
    known = trips.select("trip_id", "schedule_version", F.lit(True).alias("known"))
    per_trip = (
        stops.groupBy("service_day", "trip_id")
        .agg(F.count("*").alias("stops"))
        .join(F.broadcast(chosen_days.select("service_day", "schedule_version")), "service_day")
        .join(known, ["trip_id", "schedule_version"], "left")
    )
    unknown = F.col("known").isNull()
    return per_trip.groupBy("service_day").agg(
        F.max("schedule_version").alias("schedule_version"),
        F.count("*").alias("observed_trips"),
        F.count_if(unknown).alias("unmatched_trips"),
        F.sum("stops").alias("observed_stops"),
        F.coalesce(F.sum(F.when(unknown, F.col("stops"))), F.lit(0)).alias("unmatched_stops"),
    )
