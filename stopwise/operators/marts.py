"""Daily aggregates of the fact table.

Line attributes depend on (route, version) alone, and a day has one version, so lookups are
joined after the aggregation, on one row per day and line instead of one per stop.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stopwise.functions import values as vl
from stopwise.operators.axis import nullsafe_join

LINE_DIR_DAY = ["service_day", "route_id", "direction"]


def state_count(state: str) -> Column:
    return F.count_if(F.col("state") == state)


def assessable_delay() -> Column:
    return F.when(vl.is_assessable(F.col("state")), F.col("delay_arr"))


def on_time_counts(thresholds: list[int] = vl.THRESHOLDS_MIN) -> list[Column]:
    """Stops less than t minutes late: arrival delay, else departure; early counts as on time."""
    delay = F.coalesce("delay_arr", "delay_dep")
    ok = vl.is_assessable(F.col("state"))
    return [F.count_if(ok & (delay < t * 60)).alias(f"on_time_{t}min") for t in thresholds]


def base_counts() -> list[Column]:
    return [
        F.count("*").alias("planned_stops"),
        F.count_if(vl.is_assessable(F.col("state"))).alias("assessable_stops"),
    ]


def mean_delay() -> Column:
    return F.avg(assessable_delay()).alias("delay_mean_sec")


def median_delay() -> Column:
    return F.median(assessable_delay()).alias("delay_median_sec")


def with_on_demand(df: DataFrame, on_demand: DataFrame) -> DataFrame:
    flag = on_demand.select("route_id").distinct().withColumn("listed", F.lit(True))
    return df.join(flag, "route_id", "left").withColumn(
        "on_demand", F.coalesce("listed", F.lit(False))
    ).drop("listed")


def dimension_join(df: DataFrame, lines: DataFrame, names: DataFrame, on_demand: DataFrame) -> DataFrame:
    """Line master data (inner), direction name (left, plain equality) and on-demand flag."""
    master = lines.select("route_id", "schedule_version", "line", "route_text", "mode")
    labels = names.select("route_id", "direction", "direction_name", "name_rule")
    joined = df.join(master, ["route_id", "schedule_version"]).join(
        labels, ["route_id", "direction"], "left"
    )
    return with_on_demand(joined, on_demand)


def line_profile(fact: DataFrame, lines: DataFrame, names: DataFrame, on_demand: DataFrame) -> DataFrame:
    per_line = fact.groupBy(*LINE_DIR_DAY, "schedule_version").agg(
        F.max("source").alias("source"),
        *base_counts(),
        F.count_if("trip_head").alias("trips"),
        state_count(vl.TRIP_CANCELLED).alias("stops_trip_cancelled"),
        state_count(vl.SKIPPED).alias("stops_skipped"),
        state_count(vl.UNREPORTED).alias("stops_unreported"),
        state_count(vl.NOT_CAPTURED).alias("stops_not_captured"),
        mean_delay(),
        median_delay(),
        *on_time_counts(),
    )
    return dimension_join(per_line, lines, names, on_demand).drop("schedule_version")


def hour_profile(fact: DataFrame) -> DataFrame:
    return (
        fact.where(F.col("service_hour").isNotNull())
        .groupBy(*LINE_DIR_DAY, "service_hour")
        .agg(
            *base_counts(),
            state_count(vl.TRIP_CANCELLED).alias("stops_trip_cancelled"),
            state_count(vl.SKIPPED).alias("stops_skipped"),
            mean_delay(),
            *on_time_counts(),
        )
    )


def delay_growth(fact: DataFrame) -> DataFrame:
    """Delay minus the delay at the previous measured stop of the same trip and day."""
    along = Window.partitionBy("service_day", "trip_id").orderBy("stop_sequence", "stop_id")
    previous = F.lag("delay_arr").over(along)
    return fact.where(F.col("delay_arr").isNotNull()).select(
        *LINE_DIR_DAY,
        "trip_id",
        "stop_sequence",
        "station_id",
        "stop_name",
        "delay_arr",
        previous.alias("delay_before"),
        (F.col("delay_arr") - previous).alias("growth_sec"),
    )


def stop_profile(fact: DataFrame, growth: DataFrame, axis: DataFrame) -> DataFrame:
    key = [*LINE_DIR_DAY, "station_id"]
    stops = fact.groupBy(*key).agg(
        F.min("stop_name").alias("stop_name"),
        *base_counts(),
        state_count(vl.SKIPPED).alias("stops_skipped"),
        state_count(vl.TRIP_CANCELLED).alias("stops_trip_cancelled"),
        mean_delay(),
        median_delay(),
        *on_time_counts([3]),
    )
    grown = (
        growth.where(F.col("growth_sec").isNotNull())
        .groupBy(*key)
        .agg(
            F.avg("growth_sec").alias("growth_mean_sec"),
            F.median("growth_sec").alias("growth_median_sec"),
            F.count("*").alias("growth_cases"),
        )
    )
    positions = axis.select("route_id", "direction", "station_id", "position")
    return nullsafe_join(
        stops.join(grown, key, "left"), positions, ["route_id", "direction", "station_id"], "left"
    )


def cancellations(fact: DataFrame) -> DataFrame:
    unusable = F.col("state").isin(vl.UNREPORTED, vl.NOT_CAPTURED)
    per_trip = fact.groupBy(*LINE_DIR_DAY, "trip_id").agg(
        F.bool_or(F.col("state") == vl.TRIP_CANCELLED).alias("cancelled"),
        state_count(vl.SKIPPED).alias("skipped"),
        F.count("*").alias("planned"),
        F.count_if(unusable).alias("unusable"),
    )
    return per_trip.groupBy(*LINE_DIR_DAY).agg(
        F.count("*").alias("trips"),
        F.count_if("cancelled").alias("trips_cancelled"),
        F.sum("skipped").alias("stops_skipped"),
        F.sum("planned").alias("planned_stops"),
        F.count_if(~F.col("cancelled") & (F.col("unusable") == F.col("planned"))).alias("trips_without_report"),
    )


def network_profile(fact: DataFrame, lines: DataFrame, on_demand: DataFrame) -> DataFrame:
    """Per day and mode, without on-demand lines."""
    modes = lines.select("route_id", "schedule_version", "mode")
    return (
        fact.join(on_demand.select("route_id").distinct(), "route_id", "left_anti")
        .join(modes, ["route_id", "schedule_version"])
        .groupBy("service_day", "mode")
        .agg(
            F.size(F.collect_set("route_id")).cast("long").alias("lines"),
            F.count_if("trip_head").alias("trips"),
            *base_counts(),
            state_count(vl.TRIP_CANCELLED).alias("stops_trip_cancelled"),
            state_count(vl.SKIPPED).alias("stops_skipped"),
            mean_delay(),
            median_delay(),
            *on_time_counts(),
        )
    )


def data_quality(fact: DataFrame, gaps: DataFrame, unmatched: DataFrame) -> DataFrame:
    hours = gaps.groupBy("service_day").agg(
        F.count_if("captured").alias("captured_hours"),
        F.count_if(~F.col("captured")).alias("missing_hours"),
    )
    foreign = unmatched.select("service_day", "observed_trips", "unmatched_trips", "unmatched_stops")
    per_day = fact.groupBy("service_day").agg(
        *base_counts(),
        state_count(vl.UNREPORTED).alias("stops_unreported"),
        state_count(vl.NOT_CAPTURED).alias("stops_not_captured"),
        F.count_if("trip_head").alias("trips"),
        F.size(F.collect_set("route_id")).cast("long").alias("lines"),
        F.min("observed_at").alias("first_report"),
        F.max("observed_at").alias("last_report"),
        F.size(F.collect_set("schedule_version")).cast("long").alias("versions"),
    )

    def zero(c: str) -> Column:
        return F.coalesce(c, F.lit(0)).alias(c)

    return (
        per_day.join(hours, "service_day", "left")
        .join(foreign, "service_day", "left")
        .select(
            *per_day.columns,
            zero("captured_hours"),
            zero("missing_hours"),
            vl.share4(F.col("assessable_stops"), F.col("planned_stops")).alias("coverage"),
            (F.coalesce("missing_hours", F.lit(0)) == 0).alias("complete"),
            zero("observed_trips"),
            zero("unmatched_trips"),
            zero("unmatched_stops"),
        )
    )
