"""One fact row per planned stop, from two sources."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FIRST, SECOND = "first", "second"

FACT_COLUMNS = [
    "service_day",
    "route_id",
    "direction",
    "trip_id",
    "stop_sequence",
    "stop_id",
    "station_id",
    "stop_name",
    "planned_arr",
    "planned_dep",
    "actual_arr",
    "actual_dep",
    "delay_arr",
    "delay_dep",
    "state",
    "schedule_version",
    "source_version",
    "service_hour",
    "observed_at",
    "source",
    "trip_head",
]


def bridge_lines(trips: DataFrame, lines: DataFrame, lookup: DataFrame) -> DataFrame:
    """Trips of the second source under the route id of the first, taken-over lines only."""
    wanted = lookup.select(
        F.col("route_id").alias("first_route"), F.col("line_number").alias("line"), "mode"
    )
    routes = lines.select("route_id", "schedule_version", "line", "mode").join(wanted, ["line", "mode"])
    return (
        trips.join(routes.select("route_id", "schedule_version", "first_route"), ["route_id", "schedule_version"])
        .drop("route_id")
        .withColumnRenamed("first_route", "route_id")
    )


def stops_with_station(stop_times: DataFrame, stops: DataFrame) -> DataFrame:
    """Station of each planned stop time, looked up once per version and not per day."""
    names = stops.select(
        "schedule_version",
        "stop_id",
        "station_id",
        F.coalesce("station_name", "stop_name").alias("stop_name"),
    )
    return stop_times.join(names, ["schedule_version", "stop_id"], "left")


def station_names(stops: DataFrame) -> DataFrame:
    """One row per station and version, so that joining it never multiplies."""
    return stops.groupBy("station_id", "schedule_version").agg(
        F.min("station_name").alias("station_name")
    )


def taken_over_days(second: DataFrame) -> DataFrame:
    return second.select("service_day", "route_id").distinct()


def source_takeover(first: DataFrame, taken: DataFrame) -> DataFrame:
    """Rows of the first source drop out where the second reports the line on that day.

    `taken` comes as a stored table, so its size is known to the planner, which broadcasts it
    below the threshold and joins by shuffle above.
    """
    return first.join(taken, ["service_day", "route_id"], "left_anti")


def first_source_rows(states: DataFrame) -> DataFrame:
    return states.select(
        "*",
        F.col("schedule_version").alias("source_version"),
        F.lit(FIRST).alias("source"),
    ).withColumns(
        {
            "stop_name": F.coalesce("stop_name", "stop_id"),
            "station_id": F.coalesce("station_id", "stop_id"),
        }
    ).select(FACT_COLUMNS)


def second_source_rows(
    states: DataFrame, directions: DataFrame, shown_versions: DataFrame, stations: DataFrame
) -> DataFrame:
    """Second-source stops with inferred direction, shown under the first source's version."""
    inferred = directions.select("trip_id", "schedule_version", "direction")
    known = stations.select(
        "station_id",
        F.col("schedule_version").alias("shown_version"),
        "station_name",
        F.col("station_id").alias("first_station"),
    )
    shown = shown_versions.select("service_day", F.col("schedule_version").alias("shown_version"))
    return (
        states.drop("direction")
        .join(inferred, ["trip_id", "schedule_version"])
        .join(F.broadcast(shown), "service_day")
        .join(known, ["station_id", "shown_version"], "left")
        .select(
            "*",
            F.col("schedule_version").alias("source_version"),
            F.lit(SECOND).alias("source"),
        )
        .withColumns(
            {
                "stop_name": F.coalesce("station_name", "stop_name", "stop_id"),
                "station_id": F.coalesce("first_station", "station_id", "stop_id"),
                "schedule_version": F.col("shown_version"),
            }
        )
        .select(FACT_COLUMNS)
    )


def union_sources(first: DataFrame, second: DataFrame) -> DataFrame:
    return first.select(FACT_COLUMNS).unionByName(second.select(FACT_COLUMNS))
