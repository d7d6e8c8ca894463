"""Which published timetable applies to a day.

There is at most one schedule version per calendar date, so the set of all versions is a
short array. It enters expressions as a scalar subquery; no join against days is needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MIN_TRIPS = 50
ALLOW_LIST_VERSIONS = 21


def version_array(trips: DataFrame) -> Column:
    return trips.agg(F.sort_array(F.collect_set("schedule_version")).alias("versions")).scalar()


def observed_days(reports: DataFrame) -> DataFrame:
    return reports.select("service_day").distinct()


def observed_trips(reports: DataFrame) -> DataFrame:
    return reports.select("service_day", "trip_id").distinct()


def version_candidates(days: DataFrame, trips: DataFrame) -> DataFrame:
    """Every version published on or before the day."""
    fitting = F.filter(F.col("versions"), lambda v: v <= F.col("service_day"))
    return days.withColumn("versions", version_array(trips)).select(
        "service_day", F.explode(fitting).alias("schedule_version")
    )


def asof_version(days: DataFrame, trips: DataFrame) -> DataFrame:
    """Newest version on or before the day, else the oldest of all."""
    fitting = F.filter(F.col("versions"), lambda v: v <= F.col("service_day"))
    return days.withColumn("versions", version_array(trips)).select(
        "service_day",
        F.coalesce(F.array_max(fitting), F.array_min("versions")).alias("schedule_version"),
        F.array_max(fitting).isNull().alias("substituted"),
    )


def version_scores(seen: DataFrame, trips: DataFrame, min_trips: int = MIN_TRIPS) -> DataFrame:
    """Observed trips per day and how many of them each candidate version resolves."""
    observed = seen.groupBy("service_day").agg(F.count("*").alias("observed"))
    known = trips.select("trip_id", "schedule_version")
    resolved = (
        seen.join(known, "trip_id")
        .where(F.col("schedule_version") <= F.col("service_day"))
        .groupBy("service_day", "schedule_version")
        .agg(F.count("*").alias("resolved"))
    )
    return (
        version_candidates(observed.where(F.col("observed") >= min_trips).select("service_day"), trips)
        .join(observed, "service_day")
        .join(resolved, ["service_day", "schedule_version"], "left")
        .select(
            "service_day",
            "schedule_version",
            "observed",
            F.coalesce("resolved", F.lit(0)).alias("resolved"),
        )
    )


def choose_version(seen: DataFrame, trips: DataFrame, min_trips: int = MIN_TRIPS) -> DataFrame:
    """Per day the version that resolves most observed trips, ties to the newer one.

    Only versions that resolve something are counted; when none does, the newest candidate
    wins with a share of zero, which is what counting the zeros would give.
    """
    observed = seen.groupBy("service_day").agg(F.count("*").alias("observed"))
    known = trips.select("trip_id", "schedule_version")
    best = (
        seen.join(known, "trip_id")
        .where(F.col("schedule_version") <= F.col("service_day"))
        .groupBy("service_day", "schedule_version")
        .agg(F.count("*").alias("resolved"))
        .groupBy("service_day")
        .agg(F.max(F.struct("resolved", "schedule_version")).alias("best"))
    )
    versions = F.col("versions")
    fitting = F.filter(versions, lambda v: v <= F.col("service_day"))
    newest = F.array_max(fitting)
    measured = (F.col("observed") >= min_trips) & newest.isNotNull()
    return (
        observed.join(best, "service_day", "left")
        .withColumn("versions", version_array(trips))
        .select(
            "service_day",
            F.when(measured, F.coalesce("best.schedule_version", newest))
            .otherwise(newest)
            .alias("schedule_version"),
            F.array_min(versions).alias("oldest_version"),
            F.when(
                measured,
                F.round(F.coalesce("best.resolved", F.lit(0)) / F.col("observed"), 4),
            ).alias("resolved_share"),
            measured.alias("version_measured"),
        )
    )


def day_versions(chosen: DataFrame) -> DataFrame:
    """The version in force per day, with a mark where the oldest had to stand in."""
    return chosen.select(
        "service_day",
        F.coalesce("schedule_version", "oldest_version").alias("schedule_version"),
        F.col("schedule_version").isNull().alias("version_substituted"),
    )


def id_stability(trips: DataFrame) -> DataFrame:
    """Shared trip and route ids of each pair of neighbouring versions."""
    spine = trips.select("schedule_version").distinct()
    successor = spine.select(
        "schedule_version",
        F.lead("schedule_version").over(Window.orderBy("schedule_version")).alias("next_version"),
    ).where(F.col("next_version").isNotNull())

    def shared(column: str) -> DataFrame:
        ids = trips.select("schedule_version", column).distinct()
        sizes = ids.groupBy("schedule_version").agg(F.count("*").alias("n"))
        later = ids.withColumnRenamed("schedule_version", "next_version")
        common = (
            ids.join(successor, "schedule_version")
            .join(later, ["next_version", column])
            .groupBy("schedule_version")
            .agg(F.count("*").alias("common"))
        )
        kind = column.removesuffix("_id")
        return (
            successor.join(sizes, "schedule_version")
            .join(
                sizes.select(
                    F.col("schedule_version").alias("next_version"), F.col("n").alias("n_next")
                ),
                "next_version",
            )
            .join(common, "schedule_version", "left")
            .select(
                "schedule_version",
                "next_version",
                F.col("n").alias(f"{kind}s_before"),
                F.col("n_next").alias(f"{kind}s_after"),
                F.coalesce("common", F.lit(0)).alias(f"{kind}s_common"),
                (F.coalesce("common", F.lit(0)) / F.col("n")).alias(f"{kind}s_share"),
            )
        )

    return shared("trip_id").join(shared("route_id"), ["schedule_version", "next_version"])


def namespace_overlap(a: DataFrame, b: DataFrame, column: str) -> DataFrame:
    """Ids in both sets, only in the first, only in the second."""
    ids = (
        a.select(F.col(column).alias("id"), F.lit(1).alias("in_a"), F.lit(0).alias("in_b"))
        .unionByName(
            b.select(F.col(column).alias("id"), F.lit(0).alias("in_a"), F.lit(1).alias("in_b"))
        )
        .groupBy("id")
        .agg(F.max("in_a").alias("in_a"), F.max("in_b").alias("in_b"))
    )
    a_, b_ = F.col("in_a") == 1, F.col("in_b") == 1
    return ids.agg(
        F.count_if(a_ & b_).alias("common"),
        F.count_if(a_ & ~b_).alias("only_first"),
        F.count_if(~a_ & b_).alias("only_second"),
    )


def newest_versions(trips: DataFrame, n: int) -> Column:
    """The n newest versions as an array."""
    return trips.agg(
        F.slice(F.sort_array(F.collect_set("schedule_version"), asc=False), 1, n).alias("newest")
    ).scalar()


def allow_list(trips: DataFrame, n: int = ALLOW_LIST_VERSIONS) -> DataFrame:
    """Union of the trips of the newest n versions; the newest row wins per trip."""
    recent = trips.withColumn("newest", newest_versions(trips, n)).where(
        F.array_contains("newest", F.col("schedule_version"))
    )
    return (
        recent.groupBy("trip_id")
        .agg(F.max(F.struct("schedule_version", "route_id", "service_id", "direction")).alias("r"))
        .select("trip_id", "r.route_id", "r.service_id", "r.direction", "r.schedule_version")
    )


def allow_list_counts(trips: DataFrame, n: int = ALLOW_LIST_VERSIONS) -> DataFrame:
    newest = trips.agg(F.max("schedule_version").alias("v")).scalar()
    return (
        allow_list(trips, n)
        .withColumn("newest", newest)
        .agg(
            F.count("*").alias("trips"),
            F.count_if(F.col("schedule_version") == F.col("newest")).alias("from_newest"),
            F.count_if(F.col("schedule_version") < F.col("newest")).alias("added_by_older"),
            F.countDistinct("schedule_version").alias("versions_used"),
        )
    )


def allow_list_filter(reports: DataFrame, allowed: DataFrame) -> DataFrame:
    return reports.join(allowed.select("trip_id"), "trip_id", "left_semi")


def version_fit(feed_trips: DataFrame, trips: DataFrame) -> DataFrame:
    """Per version: trips, feed hits and their share of the feed, best and newest marked."""
    feed = feed_trips.select("trip_id").distinct()
    total = feed.agg(F.count("*").alias("n")).scalar()
    known = trips.select("schedule_version", "trip_id").distinct()
    in_feed = feed.withColumn("hit", F.lit(1))
    fit = (
        known.join(in_feed, "trip_id", "left")
        .groupBy("schedule_version")
        .agg(F.count("*").alias("trips"), F.count("hit").alias("hits"))
        .withColumn("feed_trips", total)
    )
    best = fit.agg(F.max_by("schedule_version", F.struct("hits", "schedule_version")).alias("b"))
    newest = fit.agg(F.max("schedule_version").alias("n"))
    return fit.select(
        "schedule_version",
        "trips",
        "hits",
        F.try_divide(F.col("hits").cast("double"), F.greatest("feed_trips", F.lit(1))).alias("share"),
        (F.col("schedule_version") == best.scalar()).alias("is_best"),
        (F.col("schedule_version") == newest.scalar()).alias("is_newest"),
    )


def unknown_feed_trips(feed_trips: DataFrame, trips: DataFrame) -> DataFrame:
    return feed_trips.select("trip_id").distinct().join(trips, "trip_id", "left_anti")


def best_version(fit: DataFrame) -> DataFrame:
    """The version with most hits; the last one wins on ties."""
    return fit.agg(
        F.max_by(
            F.struct("schedule_version", "hits"), F.struct("hits", "schedule_version")
        ).alias("b")
    ).select("b.*")


def rolling_version_membership(base_trips: DataFrame, trips: DataFrame, days: DataFrame, n: int) -> DataFrame:
    """Share of one day's trips known to the newest n versions as of each later day.

    A trip is a member on a day when its newest version up to that day is among the n
    newest ones, so one row per (trip, version) meets the days through the version alone.
    """
    total = base_trips.agg(F.count("*").alias("n")).scalar()
    membership = trips.join(base_trips, "trip_id", "left_semi").select("trip_id", "schedule_version").distinct()
    anywhere = membership.agg(F.countDistinct("trip_id").alias("n")).scalar()
    fitting = F.filter(F.col("versions"), lambda v: v <= F.col("service_day"))
    window = days.withColumn("versions", version_array(trips)).select(
        "service_day",
        F.explode_outer(F.slice(F.reverse(fitting), 1, n)).alias("schedule_version"),
    )
    hits = (
        window.join(membership, "schedule_version", "left")
        .groupBy("service_day")
        .agg(
            F.countDistinct("trip_id").alias("in_window"),
            F.min("schedule_version").alias("window_from"),
            F.max("schedule_version").alias("window_to"),
        )
    )
    return hits.where(F.col("window_from").isNotNull()).select(
        "service_day",
        "window_from",
        "window_to",
        "in_window",
        anywhere.alias("in_any"),
        total.alias("base_trips"),
        F.try_divide(F.col("in_window").cast("double"), total.cast("double")).alias("share"),
    )
