"""Direction names, and direction inference for a source that does not publish it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stopwise.functions import text as tx
from stopwise.functions import values as vl


def trip_shape(trips: DataFrame, stop_times: DataFrame, stops: DataFrame) -> DataFrame:
    """Per trip and version: number of stops, first and last station, last and quarter stop."""
    trip = ["trip_id", "schedule_version"]
    names = stops.select(
        "stop_id",
        "schedule_version",
        "station_id",
        F.coalesce("station_name", "stop_name").alias("known_name"),
    )
    numbered = (
        stop_times.join(names, ["stop_id", "schedule_version"], "left")
        .select(
            *trip,
            "station_id",
            F.coalesce("known_name", "stop_id").alias("name"),
            F.row_number().over(Window.partitionBy(*trip).orderBy("stop_sequence")).alias("nr"),
            F.count("*").over(Window.partitionBy(*trip)).alias("stops"),
        )
    )
    quarter = F.greatest(F.lit(2), F.round(F.col("stops") * 0.25).cast("int"))
    last = F.col("nr") == F.col("stops")
    shape = numbered.groupBy(*trip).agg(
        F.max("stops").alias("stops"),
        F.max(F.when(last, F.col("name"))).alias("last_stop"),
        F.max(F.when(F.col("nr") == 1, F.col("station_id"))).alias("first_station"),
        F.max(F.when(last, F.col("station_id"))).alias("last_station"),
        F.max(F.when(F.col("nr") == quarter, F.col("name"))).alias("quarter_stop"),
    )
    return trips.select("route_id", "direction", *trip).join(shape, trip)


def direction_names(shapes: DataFrame) -> DataFrame:
    """Most frequent last stop per direction; a quarter stop where both directions share it."""
    line_dir = ["route_id", "direction"]
    per_trip = shapes.groupBy(*line_dir, "trip_id").agg(
        *[
            F.max(c).alias(c)
            for c in ["stops", "last_stop", "first_station", "last_station", "quarter_stop"]
        ]
    )
    totals = per_trip.groupBy(*line_dir).agg(
        F.count("*").alias("trips"),
        F.count_if(F.col("first_station") == F.col("last_station")).alias("loops"),
    )

    def most_frequent(column: str, count_name: str) -> DataFrame:
        order = Window.partitionBy(*line_dir).orderBy(F.col(count_name).desc(), F.col(column))
        return (
            per_trip.where(F.col(column).isNotNull())
            .groupBy(*line_dir, column)
            .agg(F.count("*").alias(count_name))
            .withColumn("rank", F.row_number().over(order))
            .where(F.col("rank") == 1)
            .drop("rank")
        )

    ends = most_frequent("last_stop", "trips_to_it")
    quarters = most_frequent("quarter_stop", "trips_via_it")
    shared = ends.groupBy("route_id").agg(
        (F.count("*") > F.countDistinct("last_stop")).alias("end_shared")
    )
    t, e, q, k = totals.alias("t"), ends.alias("e"), quarters.alias("q"), shared.alias("k")

    def same(other: str) -> Column:
        return (F.col("t.route_id") == F.col(f"{other}.route_id")) & F.col("t.direction").eqNullSafe(
            F.col(f"{other}.direction")
        )

    via = F.coalesce("k.end_shared", F.lit(False)) & F.col("q.quarter_stop").isNotNull()
    return (
        t.join(e, same("e"), "left")
        .join(q, same("q"), "left")
        .join(k, F.col("t.route_id") == F.col("k.route_id"), "left")
        .select(
            "t.route_id",
            "t.direction",
            F.when(via, F.concat(F.lit("via "), F.col("q.quarter_stop")))
            .otherwise(F.col("e.last_stop"))
            .alias("direction_name"),
            F.when(via, "via").otherwise("last_stop").alias("name_rule"),
            F.col("e.trips_to_it").alias("trips_to_it"),
            F.col("t.trips").alias("trips"),
            F.round(1 - vl.safe_ratio(F.col("e.trips_to_it"), F.col("t.trips")), 4).alias("short_run_share"),
            vl.share4(F.col("t.loops"), F.col("t.trips")).alias("loop_share"),
        )
    )


def position_partials(trips: DataFrame, stop_times: DataFrame, stops: DataFrame) -> DataFrame:
    """Sum and count of the relative stop position in direction 0, per version.

    Versions never change, so these sums can be stored and added up exactly later.
    """
    trip = ["trip_id", "schedule_version"]
    last = stop_times.groupBy(*trip).agg(F.max("stop_sequence").alias("last_seq"))
    stations = stops.select("stop_id", "schedule_version", "station_id")
    position = vl.safe_ratio(F.col("stop_sequence"), F.col("last_seq"))
    return (
        trips.where(F.col("direction") == 0)
        .select("route_id", *trip)
        .join(last, trip)
        .join(stop_times.select(*trip, "stop_id", "stop_sequence"), trip)
        .join(stations, ["stop_id", "schedule_version"])
        .groupBy(
            "schedule_version", "route_id", tx.station_key(F.col("station_id")).alias("station_id")
        )
        .agg(F.sum(position).alias("position_sum"), F.count(position).alias("position_n"))
    )


def position_mean(partials: DataFrame) -> DataFrame:
    return partials.groupBy("route_id", "station_id").agg(
        vl.safe_ratio(F.sum("position_sum"), F.sum("position_n")).alias("position")
    )


def end_pairs(trips: DataFrame, stop_times: DataFrame, stops: DataFrame) -> DataFrame:
    """Distinct first and last stations per version, route and direction."""
    trip = ["trip_id", "schedule_version"]
    ends = stop_times.groupBy(*trip).agg(
        F.min_by("stop_id", "stop_sequence").alias("first_stop"),
        F.max_by("stop_id", "stop_sequence").alias("last_stop"),
    )
    stations = stops.select(
        "stop_id", "schedule_version", tx.station_key(F.col("station_id")).alias("station")
    )

    def station_of(stop: str, name: str) -> DataFrame:
        return stations.select(
            F.col("stop_id").alias(stop), "schedule_version", F.col("station").alias(name)
        )

    return (
        ends.join(station_of("first_stop", "first_station"), ["first_stop", "schedule_version"])
        .join(station_of("last_stop", "last_station"), ["last_stop", "schedule_version"])
        .join(trips.select("route_id", "direction", *trip), trip)
        .select("schedule_version", "route_id", "direction", "first_station", "last_station")
        .distinct()
    )


def runs_with_position(trips: DataFrame, stop_times: DataFrame, stops: DataFrame) -> DataFrame:
    """Stations of every trip with their relative position in it."""
    trip = ["trip_id", "schedule_version"]
    bounds = stop_times.groupBy(*trip).agg(
        F.min("stop_sequence").alias("first_seq"), F.max("stop_sequence").alias("last_seq")
    )
    stations = stops.select("stop_id", "schedule_version", "station_id")
    return (
        trips.select("route_id", *trip)
        .join(bounds, trip)
        .join(stop_times.select(*trip, "stop_id", "stop_sequence"), trip)
        .join(stations, ["stop_id", "schedule_version"])
        .withColumn("position", vl.safe_ratio(F.col("stop_sequence"), F.col("last_seq")))
    )


def correlation(runs: DataFrame, positions: DataFrame) -> DataFrame:
    """Pearson correlation of a trip's positions with the mean positions of direction 0.

    Written with sums: constant input has no correlation, so it stays NULL.
    """
    x, y = F.col("position"), F.col("mean_position")
    sums = (
        runs.join(
            positions.select("route_id", "station_id", F.col("position").alias("mean_position")),
            ["route_id", "station_id"],
        )
        .groupBy("route_id", "trip_id", "schedule_version")
        .agg(
            F.count("*").alias("common_stops"),
            F.count_if(x.isNotNull() & y.isNotNull()).alias("n"),
            *[
                F.sum(F.when(x.isNotNull() & y.isNotNull(), e)).alias(a)
                for e, a in [(x, "sx"), (y, "sy"), (x * y, "sxy"), (x * x, "sxx"), (y * y, "syy")]
            ],
        )
    )
    n, sx, sy = F.col("n"), F.col("sx"), F.col("sy")
    spread = (n * F.col("sxx") - sx * sx) * (n * F.col("syy") - sy * sy)
    r = F.try_divide(n * F.col("sxy") - sx * sy, F.sqrt(F.when(spread > 1e-12, spread)))
    return sums.select("route_id", "trip_id", "schedule_version", "common_stops", r.alias("r"))


def unique_directions(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that belong to exactly one direction."""
    return (
        pairs.groupBy(*keys)
        .agg(F.min("direction").alias("direction"), F.max("direction").alias("other"))
        .where(F.col("direction") == F.col("other"))
        .drop("other")
    )


def direction_crosscheck(runs: DataFrame, pairs: DataFrame) -> DataFrame:
    """Independent guess from the end stations: unique pair first, else unique last station."""
    ends = runs.groupBy("route_id", "trip_id", "schedule_version").agg(
        F.max(F.when(F.col("stop_sequence") == F.col("first_seq"), F.col("station_id"))).alias("first_station"),
        F.max(F.when(F.col("stop_sequence") == F.col("last_seq"), F.col("station_id"))).alias("last_station"),
    )
    by_pair = unique_directions(pairs, ["route_id", "first_station", "last_station"])
    by_end = unique_directions(pairs, ["route_id", "last_station"]).withColumnRenamed("direction", "end_direction")
    return (
        ends.join(by_pair, ["route_id", "first_station", "last_station"], "left")
        .join(by_end, ["route_id", "last_station"], "left")
        .select(
            "route_id",
            "trip_id",
            "schedule_version",
            F.coalesce("direction", "end_direction").alias("direction_by_ends"),
        )
    )


def infer_direction(runs: DataFrame, positions: DataFrame, pairs: DataFrame) -> DataFrame:
    """Direction 0 for a positive correlation, 1 otherwise; needs two common stops."""
    trip = ["route_id", "trip_id", "schedule_version"]
    return (
        correlation(runs, positions)
        .where((F.col("common_stops") >= 2) & F.col("r").isNotNull())
        .join(direction_crosscheck(runs, pairs), trip)
        .select(
            *trip,
            "common_stops",
            F.round("r", 4).alias("correlation"),
            F.when(F.col("r") > 0, 0).otherwise(1).cast("tinyint").alias("direction"),
            "direction_by_ends",
        )
    )
