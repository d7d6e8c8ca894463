"""How far forecasts moved: the delay 15 minutes before the final report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEY = ["service_day", "trip_id", "stop_id"]
LEAD = "INTERVAL '15' MINUTE"


def forecast_asof_join(reports: DataFrame) -> DataFrame:
    """Per stop the final delay and the last one known at least 15 minutes earlier.

    Written as aggregate, equi join, aggregate: each step combines before its shuffle, so a
    stop with very many reports is split over tasks. Equal times are ordered by delay.
    """
    known = reports.where(F.col("delay_arr").isNotNull()).select(*KEY, "delay_arr", "observed_at")
    latest = F.struct("observed_at", "delay_arr")
    final = (
        known.groupBy(*KEY)
        .agg(F.max(latest).alias("final"), F.count("*").alias("reports"))
        .select(
            *KEY,
            F.col("final.delay_arr").alias("delay_final"),
            F.col("final.observed_at").alias("observed_final"),
            "reports",
        )
    )
    earlier = (
        known.join(final.select(*KEY, "observed_final"), KEY)
        .where(F.col("observed_at") <= F.col("observed_final") - F.expr(LEAD))
        .groupBy(*KEY)
        .agg(F.max(latest).alias("forecast"))
    )
    return final.join(earlier, KEY).select(
        *KEY,
        "delay_final",
        "observed_final",
        "reports",
        F.col("forecast.delay_arr").alias("forecast_15min"),
        F.abs(F.col("delay_final") - F.col("forecast.delay_arr")).alias("change_sec"),
    )


def forecast_quality(
    history: DataFrame, chosen: DataFrame, trips: DataFrame, lines: DataFrame
) -> DataFrame:
    routes = trips.select("trip_id", "schedule_version", "route_id").join(
        lines.select("route_id", "schedule_version", "mode"), ["route_id", "schedule_version"]
    )
    versions = F.broadcast(chosen.select("service_day", "schedule_version"))
    change = F.col("change_sec")
    return (
        history.join(versions, "service_day")
        .join(routes, ["trip_id", "schedule_version"])
        .groupBy("service_day", "mode")
        .agg(
            F.count("*").alias("cases"),
            F.median(change).alias("change_median_sec"),
            F.avg(change).alias("change_mean_sec"),
            F.count_if(change < 60).alias("change_below_1min"),
            F.count_if(change < 180).alias("change_below_3min"),
        )
    )
