"""Data-quality checks: each returns the rows that break its rule (none means passed)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stopwise.functions import text as tx
from stopwise.functions import values as vl
from stopwise.operators import axis as ax
from stopwise.operators import holidays as hd
from stopwise.operators import rollup

METRES_PER_DEGREE = 111_000
MAX_STATION_SPAN_M = 1000
ON_DEMAND_WORD = "ruftaxi"


def check_unique(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.groupBy(*columns).agg(F.count("*").alias("rows")).where(F.col("rows") > 1)


def check_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def check_accepted(df: DataFrame, column: str, values: list) -> DataFrame:
    """Values outside the list; NULL passes."""
    return df.where(F.col(column).isNotNull() & ~F.col(column).isin(values))


def check_range(df: DataFrame, column: str, low=None, high=None, severity: str = "error") -> DataFrame:
    broken = F.lit(False)
    if low is not None:
        broken = broken | (F.col(column) < low)
    if high is not None:
        broken = broken | (F.col(column) > high)
    return df.where(broken).withColumn("severity", F.lit(severity))


def check_foreign_key(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    keys = parent.select(F.col(parent_column).alias(column)).distinct()
    return df.where(F.col(column).isNotNull()).join(keys, column, "left_anti")


def check_states_sum(line_profile: DataFrame) -> DataFrame:
    parts = [
        "assessable_stops",
        "stops_trip_cancelled",
        "stops_skipped",
        "stops_unreported",
        "stops_not_captured",
    ]
    return line_profile.where(sum(F.col(p) for p in parts) != F.col("planned_stops"))


RECONCILED = [
    "planned_stops",
    "assessable_stops",
    "stops_trip_cancelled",
    "stops_skipped",
    *[f"on_time_{t}min" for t in vl.THRESHOLDS_MIN],
]


def check_lines_cover_network(line_profile: DataFrame, network: DataFrame) -> DataFrame:
    """Regular lines added up must give the network table, measure by measure."""
    lines = (
        line_profile.where(~F.col("on_demand"))
        .groupBy("service_day", "mode")
        .agg(*[F.sum(c).alias(c) for c in RECONCILED])
    )
    return rollup.full_reconcile(lines, network, ["service_day", "mode"], RECONCILED)


def check_no_double_source(fact: DataFrame) -> DataFrame:
    return (
        fact.groupBy("service_day", "route_id")
        .agg(F.min("source").alias("source_a"), F.max("source").alias("source_b"))
        .where(F.col("source_a") != F.col("source_b"))
    )


def check_unmatched_subset(unmatched: DataFrame) -> DataFrame:
    return unmatched.where(
        (F.col("unmatched_trips") > F.col("observed_trips"))
        | (F.col("unmatched_stops") > F.col("observed_stops"))
        | (F.least("unmatched_trips", "unmatched_stops") < 0)
    )


def check_resolution_rate(unmatched: DataFrame, min_trips: int = 50, limit: float = 0.01) -> DataFrame:
    share = vl.safe_ratio(F.col("unmatched_trips"), F.col("observed_trips"))
    return unmatched.withColumn("unmatched_share", share).where(
        (F.col("observed_trips") >= min_trips) & (share >= limit)
    )


def check_direction_distinct(names: DataFrame) -> DataFrame:
    return (
        names.groupBy("route_id")
        .agg(F.count("*").alias("directions"), F.countDistinct("direction_name").alias("names"))
        .where(F.col("directions") > F.col("names"))
    )


def check_direction_agree(inferred: DataFrame) -> DataFrame:
    """Lines with more than one trip whose two direction guesses disagree."""
    return (
        inferred.where(F.col("direction") != F.col("direction_by_ends"))
        .groupBy("route_id")
        .agg(F.count("*").alias("disagreeing"))
        .where(F.col("disagreeing") > 1)
    )


def check_station_merge(stops: DataFrame) -> DataFrame:
    """Stations merged from several id forms that lie too far apart to be one."""
    span = F.greatest(F.max("lat") - F.min("lat"), F.max("lon") - F.min("lon")) * METRES_PER_DEGREE
    return (
        stops.groupBy("schedule_version", "station_id")
        .agg(F.countDistinct("station_source").alias("forms"), span.alias("span"))
        .where((F.col("forms") > 1) & (F.col("span") > MAX_STATION_SPAN_M))
        .select("schedule_version", "station_id", "forms", F.round("span").alias("span_m"))
    )


def check_axis_follows_plan(axis: DataFrame, axis_per_version: DataFrame) -> DataFrame:
    newest = axis_per_version.agg(F.max("schedule_version").alias("v")).scalar()
    return ax.rank_agreement(axis, axis_per_version.where(F.col("schedule_version") == newest)).drop("schedule_version")


def check_stop_has_position(stop_profile: DataFrame) -> DataFrame:
    return (
        stop_profile.where(F.col("position").isNull())
        .groupBy("route_id", "direction", "station_id")
        .agg(
            F.min("stop_name").alias("stop_name"),
            F.count("*").alias("days"),
            F.sum("planned_stops").alias("planned_stops"),
        )
    )


def check_on_demand_listed(lines: DataFrame, on_demand: DataFrame) -> DataFrame:
    return (
        lines.where(F.startswith(F.lower("route_text"), F.lit(ON_DEMAND_WORD)))
        .join(on_demand.select("route_id").distinct(), "route_id", "left_anti")
        .select("route_id", "line", "route_text")
        .distinct()
    )


def check_holiday_cover(calendar: DataFrame, holidays: DataFrame, min_days: int = 60) -> DataFrame:
    """The list of a state ends soon after the newest day, or days are unclassified."""
    newest = calendar.agg(F.max("service_day").alias("d")).scalar()
    unclassified = calendar.agg(F.count_if(F.col("holiday_bw").isNull()).alias("n")).scalar()
    cover = holidays.groupBy("state").agg(F.max("last_day").alias("listed_until"))
    base = cover.select(
        "state",
        "listed_until",
        newest.alias("newest_day"),
        unclassified.alias("unclassified_days"),
    )
    left = F.date_diff("listed_until", "newest_day")
    ending = base.where(left < min_days).select(
        "*", left.alias("days_left"), F.lit("list ends soon").alias("finding")
    )
    open_days = base.where((F.col("state") == hd.LEAD_STATE) & (F.col("unclassified_days") > 0)).select(
        "*", F.lit(None).cast("int").alias("days_left"), F.lit("days without classification").alias("finding")
    )
    return ending.unionByName(open_days)


def check_holiday_ranges(holidays: DataFrame) -> DataFrame:
    """Ranges that end before they start, and overlapping ranges of one state."""
    reversed_ = holidays.where(F.col("last_day") < F.col("first_day")).select(
        F.lit("reversed").alias("finding"), "state", F.col("name").alias("name_a"), F.lit(None).cast("string").alias("name_b")
    )
    overlapping = hd.overlap_self_join(holidays).select(
        F.lit("overlap").alias("finding"), "state", "name_a", "name_b"
    )
    return reversed_.unionByName(overlapping)


def check_candidates(candidates: DataFrame) -> DataFrame:
    return candidates.where("candidate")


def check_source_still_blind(first_states: DataFrame, takeover: DataFrame) -> DataFrame:
    """Taken-over lines that the first source reports again, before they are taken over."""
    return (
        first_states.join(takeover.select("route_id").distinct(), "route_id", "left_semi")
        .groupBy("route_id")
        .agg(F.count_if(vl.is_assessable(F.col("state"))).alias("assessable_stops"))
        .where(F.col("assessable_stops") > 0)
    )


# -- operation of the log ---------------------------------------------------------------------------


def partition_completeness(
    log: DataFrame, today: dt.date, hours: int = 24, second_source: bool = False
) -> DataFrame:
    """Yesterday's hour partitions when they are too few.

    A second source is only held to this once the day before yesterday exists.
    """
    yesterday, before = today - dt.timedelta(days=1), today - dt.timedelta(days=2)
    seen = log.where(F.col("date").isin([yesterday, before])).agg(
        F.countDistinct(F.when(F.col("date") == yesterday, F.col("hour"))).alias("hours"),
        F.count_if(F.col("date") == before).alias("earlier"),
    )
    due = (F.col("earlier") > 0) if second_source else F.lit(True)
    return seen.where(due & (F.col("hours") < hours)).select(
        F.lit(yesterday).alias("date"), "hours", F.lit(hours).alias("expected")
    )


def schedule_staleness(trips: DataFrame, as_of: Column, max_age_days: int = 21) -> DataFrame:
    newest = trips.agg(F.max("schedule_version").alias("newest_version"))
    age = F.date_diff(as_of, "newest_version")
    return newest.select("newest_version", age.alias("age_days")).where(
        F.col("newest_version").isNull() | (F.col("age_days") > max_age_days)
    )


def finding_diff(previous: DataFrame, current: DataFrame, now: Column, repeat_hours: int = 24) -> DataFrame:
    """New, lasting and vanished findings between two runs.

    `previous`: finding, since, reported; `current`: finding. Findings are matched by their
    text with numbers masked; stored findings of one key count as one, with the earliest start
    and the latest report. A lasting one is reported again once per `repeat_hours`.
    """
    old = previous.groupBy(tx.finding_key(F.col("finding")).alias("key")).agg(
        F.min("finding").alias("old_finding"), F.min("since").alias("since"), F.max("reported").alias("reported")
    )
    new = current.select(tx.finding_key(F.col("finding")).alias("key"), "finding").groupBy("key").agg(
        F.min("finding").alias("finding")
    )
    hours = F.timestamp_diff("SECOND", F.col("reported"), now) / 3600
    status = (
        F.when(F.col("old_finding").isNull(), "new")
        .when(F.col("finding").isNull(), "vanished")
        .when(hours >= repeat_hours, "lasting")
        .otherwise("known")
    )
    return new.join(old, "key", "full_outer").select(
        "key",
        F.coalesce("finding", "old_finding").alias("finding"),
        status.alias("status"),
        F.coalesce("since", now).alias("since"),
        F.when(status.isin("new", "lasting"), now).otherwise(F.col("reported")).alias("reported"),
        F.floor(F.timestamp_diff("SECOND", F.coalesce("since", now), now) / 86400).alias("age_days"),
    )


def finding_escalation(previous: DataFrame, current: DataFrame, now: Column) -> DataFrame:
    """Age and level of each open finding; what is no longer open loses its history.

    `previous`: key, since; `current`: finding.
    """
    hours = F.timestamp_diff("SECOND", F.coalesce("since", now), now) / 3600
    return (
        current.withColumn("key", tx.finding_key(F.col("finding")))
        .join(previous.select("key", "since"), "key", "left")
        .select(
            "finding",
            "key",
            F.coalesce("since", now).alias("since"),
            hours.alias("age_hours"),
            F.when(hours >= 24, "high").when(hours >= 3, "raised").otherwise("normal").alias("level"),
        )
    )


def examples(findings: DataFrame, group: list[str], order: list, k: int) -> DataFrame:
    """First k rows per finding."""
    from pyspark.sql import Window

    ranked = findings.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
    return ranked.where(F.col("rank") <= k)


def assert_slug_unique(lines: DataFrame) -> DataFrame:
    """Keys that share a slug; two keys with one slug would overwrite each other's export."""
    return (
        lines.select("route_id", tx.slug(F.col("route_id")).alias("slug"))
        .distinct()
        .groupBy("slug")
        .agg(F.count("*").alias("keys"), F.min("route_id").alias("example"))
        .where(F.col("keys") > 1)
    )
