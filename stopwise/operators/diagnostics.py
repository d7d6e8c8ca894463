"""Diagnostic questions on the raw material: coverage, losses, id spaces, polls."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stopwise.functions import text as tx
from stopwise.functions import time as tm
from stopwise.functions import values as vl
from stopwise.operators import versions
from stopwise.operators.neighbours import with_previous

MIN_ACTIVE_TRIPS = 1000


def percent(share: Column) -> Column:
    """One decimal; rounded finely first, so the last bits of a sum do not decide a tie."""
    return F.round(F.round(share * 100, 8), 1)


def run_coverage(reports: DataFrame, day_version: DataFrame, stop_times: DataFrame) -> DataFrame:
    """Per day: how much of each seen trip's plan was reported."""
    seen = (
        reports.where(F.col("day_in_feed").isNotNull())
        .select(F.col("day_in_feed").alias("service_day"), "trip_id", "stop_sequence")
        .distinct()
        .groupBy("service_day", "trip_id")
        .agg(F.count("*").alias("seen"))
    )
    planned = stop_times.groupBy("schedule_version", "trip_id").agg(F.count("*").alias("planned"))
    share = vl.safe_ratio(F.col("seen"), F.col("planned"))
    return (
        seen.join(F.broadcast(day_version.select("service_day", "schedule_version")), "service_day")
        .join(planned, ["schedule_version", "trip_id"], "left")
        .groupBy("service_day", "schedule_version")
        .agg(
            F.count("*").alias("trips"),
            F.count_if(F.col("planned").isNull()).alias("without_plan"),
            percent(F.avg(share)).alias("mean_pct"),
            percent(F.median(share)).alias("median_pct"),
            F.count_if(share >= 0.9).alias("trips_90"),
            F.count_if(share >= 0.5).alias("trips_50"),
        )
    )


def silent_lines_per_day(
    reports: DataFrame, day_version: DataFrame, trips: DataFrame, lines: DataFrame
) -> DataFrame:
    """Per day: lines with any report, and the names of those without."""
    days = day_version.select("service_day", "schedule_version")
    routes = trips.select("schedule_version", "route_id").distinct()
    every = days.join(routes, "schedule_version")
    seen = (
        reports.where(F.col("day_in_feed").isNotNull())
        .select(F.col("day_in_feed").alias("service_day"), "trip_id")
        .distinct()
        .join(F.broadcast(days), "service_day")
        .join(trips.select("schedule_version", "trip_id", "route_id"), ["schedule_version", "trip_id"])
        .select("service_day", "route_id")
        .distinct()
        .withColumn("seen", F.lit(True))
    )
    labels = lines.select(
        "schedule_version",
        "route_id",
        F.concat(
            "line", F.when(F.col("route_type").isin(0, 1), F.lit(" (Tram)")).otherwise(F.lit(" (Bus)"))
        ).alias("label"),
    )
    silent = F.when(F.col("seen").isNull(), F.col("label"))
    return (
        every.join(seen, ["service_day", "route_id"], "left")
        .join(labels, ["schedule_version", "route_id"])
        .groupBy("service_day")
        .agg(
            F.count("*").alias("lines"),
            F.count("seen").alias("lines_seen"),
            F.array_join(F.sort_array(F.collect_list(silent)), ", ").alias("silent"),
        )
    )


def storage_inventory(log: DataFrame) -> DataFrame:
    """Per calendar day: bytes, files, hour partitions, rows and bytes per row."""
    files = log.groupBy(
        "date", "hour", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size")
    ).agg(F.count("*").alias("rows"))
    return (
        files.groupBy("date")
        .agg(
            F.sum("size").alias("bytes"),
            F.count("*").alias("files"),
            F.countDistinct("hour").alias("hours"),
            F.sum("rows").alias("rows"),
        )
        .withColumn("bytes_per_row", F.round(F.col("bytes") / F.col("rows")))
    )


def missing_hours(log: DataFrame) -> DataFrame:
    """Missing hour partitions per calendar day; the first and the last day are only edges."""
    present = log.groupBy("date").agg(F.sort_array(F.collect_set(F.col("hour").cast("int"))).alias("present"))
    span = log.agg(F.min("date").alias("lo"), F.max("date").alias("hi"))
    missing = F.array_except(F.sequence(F.lit(0), F.lit(23)), F.col("present"))
    edge = (F.col("date") == span.select("lo").scalar()) | (F.col("date") == span.select("hi").scalar())
    return present.select(
        "date",
        F.size("present").alias("hours_present"),
        F.array_join(missing, ", ").alias("hours_missing"),
        F.when(edge, "edge").when(F.size(missing) > 0, "gap").otherwise("complete").alias("verdict"),
    )


def undated_reports(reports: DataFrame) -> DataFrame:
    return reports.agg(
        F.count("*").alias("reports"), F.count_if(F.col("day_in_feed").isNull()).alias("undated")
    )


# -- loss of reports ----------------------------------------------------------------------------


def _named(reports: DataFrame, keys: list[str]) -> DataFrame:
    """Per key: was it named, did it ever carry a value, does the last report carry one?"""
    value = ~F.coalesce(F.col("relationship") == "SKIPPED", F.lit(False)) & (
        F.col("delay_arr").isNotNull() | F.col("delay_dep").isNotNull()
    )
    return (
        reports.where(F.col("stop_id").isNotNull())
        .withColumn("value", value)
        .groupBy("service_day", *keys)
        .agg(
            F.lit(True).alias("named"),
            F.bool_or("value").alias("ever"),
            F.max(F.struct("observed_at", "value")).alias("last"),
        )
        .select("service_day", *keys, "named", "ever", F.col("last.value").alias("last_value"))
    )


def loss_funnel(planned: DataFrame, reports: DataFrame, line_of_route: DataFrame) -> DataFrame:
    """Per line: planned stops of seen trips down to stops whose last report has a value."""
    seen = reports.select("service_day", "trip_id").distinct()
    cancelled = (
        reports.where(F.col("stop_id").isNull() & (F.col("relationship") == "CANCELED"))
        .select("service_day", "trip_id", F.lit(True).alias("cancelled"))
        .distinct()
    )

    def grain(suffix: str, *keys: str) -> tuple[DataFrame, list[str]]:
        named = _named(reports, ["trip_id", *keys])
        for c in ("named", "ever", "last_value"):
            named = named.withColumnRenamed(c, f"{c}_{suffix}")
        return named, ["service_day", "trip_id", *keys]

    out = (
        planned.select("service_day", "schedule_version", "trip_id", "route_id", "stop_id", "stop_sequence")
        .distinct()
        .join(seen, ["service_day", "trip_id"], "left_semi")
        .join(cancelled, ["service_day", "trip_id"], "left")
    )
    for named, keys in (
        grain("full", "stop_id", "stop_sequence"),
        grain("seq", "stop_sequence"),
        grain("stop", "stop_id"),
    ):
        out = out.join(named, keys, "left")
    runs = F.col("cancelled").isNull()

    def flag(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(False))

    per_route = out.groupBy("schedule_version", "route_id").agg(
        F.count("*").alias("planned"),
        F.count_if(flag("named_seq")).alias("named_by_sequence"),
        F.count_if(flag("named_full")).alias("named_in_full"),
        F.count_if(flag("ever_full")).alias("ever_value"),
        F.count_if(flag("last_value_full")).alias("last_value"),
        F.count_if(flag("last_value_full") & runs).alias("counted"),
        F.count_if(flag("named_stop") & ~flag("named_full")).alias("only_stop_fits"),
        F.count_if(flag("named_seq") & ~flag("named_full")).alias("only_sequence_fits"),
        F.count_if(flag("last_value_seq") & runs).alias("last_by_sequence"),
        F.count_if(flag("last_value_stop") & runs).alias("last_by_stop"),
    )
    names = line_of_route.select("schedule_version", "route_id", "line", "mode")
    measures = [c for c in per_route.columns if c not in ("schedule_version", "route_id")]
    return (
        per_route.join(names, ["schedule_version", "route_id"])
        .groupBy("line", "mode")
        .agg(*[F.sum(c).alias(c) for c in measures])
    )


def trip_resolution(seen: DataFrame, days: DataFrame, trips: DataFrame) -> DataFrame:
    """Seen trips per day: known to the day's version, only to another one, to none."""
    known = trips.select("trip_id", "schedule_version").distinct().withColumn("here", F.lit(True))
    anywhere = trips.select("trip_id").distinct().withColumn("somewhere", F.lit(True))
    return (
        seen.join(F.broadcast(days.select("service_day", "schedule_version")), "service_day")
        .join(known, ["trip_id", "schedule_version"], "left")
        .join(anywhere, "trip_id", "left")
        .groupBy("service_day")
        .agg(
            F.count("*").alias("seen"),
            F.count("here").alias("in_version"),
            F.count_if(F.col("here").isNull() & F.col("somewhere").isNotNull()).alias("in_other_version"),
            F.count_if(F.col("somewhere").isNull()).alias("unknown"),
        )
    )


def source_daily(states: DataFrame) -> DataFrame:
    """State counts per route and day, one column per state."""
    return (
        states.groupBy("route_id", "service_day")
        .pivot("state", vl.STATES)
        .agg(F.count(F.lit(1)))
        .na.fill(0, vl.STATES)
        .withColumn("planned", sum(F.col(s) for s in vl.STATES))
        .withColumn("assessable", F.col(vl.MEASURED) + F.col(vl.DEPARTURE_ONLY))
    )


def source_comparison(first_daily: DataFrame, second_daily: DataFrame) -> DataFrame:
    """Per line: state shares in the first source, against the second source of the same line."""
    delivered = F.col("assessable") > 0
    first = first_daily.groupBy("route_id").agg(
        *[F.sum(c).alias(c) for c in ["planned", "assessable", *vl.STATES]],
        F.count("*").alias("days"),
        F.count_if(delivered).alias("days_delivered"),
        F.array_join(
            F.sort_array(F.collect_list(F.when(~delivered, F.col("service_day").cast("string")))), ", "
        ).alias("days_missing"),
    )
    second = second_daily.groupBy("route_id").agg(
        F.sum("planned").alias("second_planned"), F.sum("assessable").alias("second_assessable")
    )
    share = vl.safe_ratio(F.col("assessable"), F.col("planned"))
    second_share = vl.safe_ratio(F.col("second_assessable"), F.col("second_planned"))
    return first.join(second, "route_id", "left").select(
        "route_id",
        "planned",
        share.alias("assessable_share"),
        vl.safe_ratio(F.col("assessable"), F.col("planned") - F.col(vl.NOT_CAPTURED)).alias("captured_share"),
        *[
            vl.safe_ratio(F.col(s), F.col("planned")).alias(f"{s}_share")
            for s in (vl.TRIP_CANCELLED, vl.SKIPPED, vl.NOT_CAPTURED)
        ],
        second_share.alias("second_share"),
        vl.safe_ratio(share, second_share).alias("ratio"),
        "days",
        "days_delivered",
        "days_missing",
    )


def source_candidates(
    first_states: DataFrame,
    lines: DataFrame,
    second_days: DataFrame,
    second_calendar: DataFrame,
    second_trips: DataFrame,
    second_lines: DataFrame,
    second_seen: DataFrame,
    on_demand: DataFrame,
    takeover: DataFrame,
    prefix: str,
) -> DataFrame:
    """Lines silent in the first source that the second source covers by a quarter or more."""
    per_route = first_states.groupBy("route_id", "schedule_version", "service_day").agg(
        F.count("*").alias("planned"), F.count_if(vl.is_assessable(F.col("state"))).alias("ok")
    )
    first = (
        per_route.join(
            lines.select("route_id", "schedule_version", "line", "mode"), ["route_id", "schedule_version"]
        )
        .withColumn("line_short", tx.line_short(F.col("line"), prefix))
        .groupBy("route_id", "line", "mode", "line_short")
        .agg(
            F.sum("planned").alias("first_planned_stops"),
            F.sum("ok").alias("first_assessable_stops"),
            F.countDistinct("service_day").alias("first_days"),
        )
    )
    named = second_trips.join(
        second_lines.select("route_id", "schedule_version", F.col("line").alias("line_short"), "mode"),
        ["route_id", "schedule_version"],
    )
    days = second_days.where(F.col("schedule_version").isNotNull()).select("service_day", "schedule_version")
    services = (
        days.withColumn("weekday", tm.weekday_name(F.col("service_day")))
        .join(second_calendar.where(F.col("origin") == "calendar"), ["schedule_version", "weekday"])
        .where(F.col("service_day").between(F.col("start_date"), F.col("end_date")))
        .select("service_day", "schedule_version", "service_id")
        .distinct()
    )
    key = ["service_day", "line_short", "mode"]
    planned = (
        services.join(named, ["schedule_version", "service_id"])
        .select(*key, "trip_id")
        .distinct()
        .groupBy(*key)
        .agg(F.count("*").alias("planned_trips"))
    )
    seen = (
        second_seen.join(F.broadcast(days), "service_day")
        .join(named, ["trip_id", "schedule_version"])
        .select(*key, "trip_id")
        .distinct()
        .groupBy(*key)
        .agg(F.count("*").alias("seen_trips"))
    )
    second = (
        planned.join(seen, key, "left")
        .groupBy("line_short", "mode")
        .agg(
            F.sum("planned_trips").alias("planned_trips"),
            F.sum(F.coalesce("seen_trips", F.lit(0))).alias("seen_trips"),
            F.count("*").alias("second_days"),
        )
    )
    coverage = vl.safe_ratio(F.coalesce("seen_trips", F.lit(0)), F.col("planned_trips"))
    listed = on_demand.select("route_id").distinct().withColumn("od", F.lit(True))
    taken = takeover.select("route_id").distinct().withColumn("tk", F.lit(True))
    return (
        first.join(second, ["line_short", "mode"], "left")
        .join(listed, "route_id", "left")
        .join(taken, "route_id", "left")
        .select(
            "route_id",
            "line",
            "mode",
            "line_short",
            "first_planned_stops",
            "first_assessable_stops",
            "first_days",
            *[
                F.coalesce(c, F.lit(0)).alias(f"second_{c}" if c != "second_days" else c)
                for c in ("planned_trips", "seen_trips", "second_days")
            ],
            F.round(coverage, 4).alias("second_coverage"),
            F.col("od").isNotNull().alias("on_demand"),
            F.col("tk").isNotNull().alias("taken_over"),
            (
                (F.col("first_assessable_stops") == 0)
                & (coverage >= 0.25)
                & F.col("od").isNull()
                & F.col("tk").isNull()
            ).alias("candidate"),
        )
    )


def line_coverage_per_day(
    days: DataFrame,
    calendar: DataFrame,
    trips: DataFrame,
    lines: DataFrame,
    seen: DataFrame,
    first_seen: DataFrame,
) -> DataFrame:
    """Per day and line of the second source: planned, seen, seen without plan, other source.

    `first_seen`: (service_day, line_short, trip_id) of the first source.
    """
    named = trips.join(
        lines.select("route_id", "schedule_version", F.col("line").alias("line_short")),
        ["route_id", "schedule_version"],
    ).select("schedule_version", "service_id", "trip_id", "line_short")
    day_version = days.select("service_day", "schedule_version")
    active = (
        day_version.withColumn("weekday", tm.weekday_name(F.col("service_day")))
        .join(calendar.where(F.col("origin") == "calendar"), ["schedule_version", "weekday"])
        .where(F.col("service_day").between(F.col("start_date"), F.col("end_date")))
        .select("service_day", "schedule_version", "service_id")
        .distinct()
        .join(named, ["schedule_version", "service_id"])
        .select("service_day", "line_short", "trip_id")
        .distinct()
        .withColumn("planned", F.lit(1))
    )
    observed = (
        seen.join(F.broadcast(day_version), "service_day")
        .join(named.select("schedule_version", "trip_id", "line_short"), ["schedule_version", "trip_id"])
        .select("service_day", "line_short", "trip_id")
        .distinct()
        .withColumn("seen", F.lit(1))
    )
    key = ["service_day", "line_short"]
    own = (
        active.join(observed, [*key, "trip_id"], "full_outer")
        .groupBy(*key)
        .agg(
            F.count("planned").alias("planned_trips"),
            F.count("seen").alias("seen_trips"),
            F.count_if(F.col("planned").isNull()).alias("seen_without_plan"),
        )
    )
    other = first_seen.distinct().groupBy(*key).agg(F.count("*").alias("first_source_trips"))
    return own.join(other, key, "left").select(
        *key,
        "planned_trips",
        "seen_trips",
        (F.col("seen_trips") / F.greatest("planned_trips", F.lit(1))).alias("share"),
        "seen_without_plan",
        F.coalesce("first_source_trips", F.lit(0)).alias("first_source_trips"),
    )


# -- id spaces ------------------------------------------------------------------------------------


def bridge_keys(
    trips: DataFrame, lines: DataFrame, stop_times: DataFrame, stops: DataFrame, prefix: str | None = None
) -> DataFrame:
    """(line, first departure, first station) of every trip."""
    trip = ["trip_id", "schedule_version"]
    first = stop_times.groupBy(*trip).agg(
        F.min_by(F.struct("dep_sec", "stop_id"), "stop_sequence").alias("s")
    )
    name = F.col("line") if prefix is None else tx.line_short(F.col("line"), prefix)
    return (
        trips.select("route_id", *trip)
        .join(lines.select("route_id", "schedule_version", name.alias("line_key")), ["route_id", "schedule_version"])
        .join(first.select(*trip, "s.dep_sec", "s.stop_id"), trip)
        .join(stops.select("stop_id", "schedule_version", "station_id"), ["stop_id", "schedule_version"])
        .select("trip_id", "line_key", "dep_sec", "station_id")
        .distinct()
    )


def one_to_one_bridge(a: DataFrame, b: DataFrame) -> DataFrame:
    """Common keys, keys with exactly one trip on either side, one-sided keys."""
    key = ["line_key", "dep_sec", "station_id"]
    na = a.groupBy(*key).agg(F.count("*").alias("na"))
    nb = b.groupBy(*key).agg(F.count("*").alias("nb"))
    both = na.join(nb, key, "full_outer")
    return both.agg(
        F.count_if(F.col("na").isNotNull() & F.col("nb").isNotNull()).alias("common"),
        F.count_if((F.col("na") == 1) & (F.col("nb") == 1)).alias("one_to_one"),
        F.count_if(F.col("nb").isNull()).alias("only_first"),
        F.count_if(F.col("na").isNull()).alias("only_second"),
        F.sum("na").alias("trips_first"),
        F.sum("nb").alias("trips_second"),
    )


def id_in_versions(live: DataFrame, trips: DataFrame, allowed: DataFrame) -> DataFrame:
    """Per line: live ids, how many are allowed, in any version; the same for id groups.

    `live`: line, trip_id.
    """
    ids = live.select("line", "trip_id").distinct()
    in_list = allowed.select("trip_id").distinct().withColumn("allowed", F.lit(1))
    known = trips.select("trip_id").distinct().withColumn("known", F.lit(1))
    per_id = (
        ids.join(in_list, "trip_id", "left")
        .join(known, "trip_id", "left")
        .groupBy("line")
        .agg(F.count("*").alias("live"), F.count("allowed").alias("in_list"), F.count("known").alias("in_any_version"))
    )
    groups = ids.select("line", tx.trip_group(F.col("trip_id")).alias("id_group")).distinct()
    known_groups = (
        trips.select(tx.trip_group(F.col("trip_id")).alias("id_group")).distinct().withColumn("known", F.lit(1))
    )
    per_group = (
        groups.join(known_groups, "id_group", "left")
        .groupBy("line")
        .agg(F.count("*").alias("groups_live"), F.count("known").alias("groups_known"))
    )
    return per_id.join(per_group, "line")


def hits_per_version(live: DataFrame, trips: DataFrame) -> DataFrame:
    return (
        live.select("line", "trip_id")
        .distinct()
        .join(trips.select("trip_id", "schedule_version").distinct(), "trip_id")
        .groupBy("line", "schedule_version")
        .agg(F.count("*").alias("hits"))
    )


# -- feed snapshots -------------------------------------------------------------------------------


def poll_trip_summary(polls: DataFrame) -> DataFrame:
    """Per day and trip over all polls; `polls` has one row per poll and trip."""
    return polls.groupBy("start_date", "trip_id").agg(
        F.array_join(F.sort_array(F.collect_set("relationship")), ", ").alias("relationships"),
        F.max("stops").alias("max_stops"),
        F.max("with_time").alias("max_with_time"),
        F.max("skipped").alias("max_skipped"),
        F.min("polled_at").alias("first_seen"),
        F.max("polled_at").alias("last_seen"),
    )


def feed_statistics(polls: DataFrame) -> DataFrame:
    """Totals of a snapshot (or of many): trips, stop updates, times, skips, cancellations."""
    return polls.agg(
        F.count("*").alias("trips"),
        F.sum("stops").alias("stop_updates"),
        F.sum("with_time").alias("with_time"),
        F.sum("skipped").alias("skipped"),
        F.sum("with_stop_id").alias("with_stop_id"),
        F.count_if(F.col("relationship") == "CANCELED").alias("cancelled"),
        vl.safe_ratio(F.sum("stops"), F.count("*")).alias("stops_per_trip"),
    )


def start_hours(polls: DataFrame) -> DataFrame:
    return polls.groupBy("start_hour").agg(F.count("*").alias("trips"))


def line_board(feed: DataFrame, routes: DataFrame) -> DataFrame:
    """Per line: trips, cancelled ones, mean delay (arrival, else departure), slowest first.

    `feed`: one row per trip and stop update of one snapshot; `routes`: trip_id, line.
    """
    delay = F.when(
        F.col("trip_relationship") != "CANCELED", F.coalesce("arrival_delay", "departure_delay")
    )
    per_trip = feed.groupBy("entity_id", "trip_id").agg(
        F.max(F.col("trip_relationship") == "CANCELED").alias("cancelled"),
        F.sum(delay).alias("delay_sum"),
        F.count(delay).alias("delay_n"),
    )
    return (
        per_trip.join(routes.select("trip_id", "line"), "trip_id")
        .groupBy("line")
        .agg(
            F.count("*").alias("trips"),
            F.count_if("cancelled").alias("cancelled"),
            F.coalesce(
                vl.safe_ratio(F.sum("delay_sum"), F.sum("delay_n")).cast("long"), F.lit(0)
            ).alias("delay_mean_sec"),
        )
        .orderBy(F.col("delay_mean_sec").desc(), "line")
    )


def alerts_by_effect(alerts: DataFrame) -> DataFrame:
    return (
        alerts.select(F.explode("entity").alias("e"))
        .where(F.col("e.alert").isNotNull())
        .groupBy(F.col("e.alert.effect").alias("effect"))
        .agg(F.count("*").alias("alerts"))
    )


def poll_gaps(polls: DataFrame, interval_sec: int) -> DataFrame:
    """Gaps of more than three intervals between two polls of a source.

    `polls`: source, polled_at.
    """
    dated = polls.withColumn("day", F.to_date("polled_at"))
    gap = F.timestamp_diff("SECOND", F.col("previous.polled_at"), F.col("polled_at"))
    return (
        with_previous(dated, ["source"], "day", ["polled_at"], ["polled_at"], "previous")
        .withColumn("gap_sec", gap)
        .where(F.col("gap_sec") > 3 * interval_sec)
        .select(
            "source",
            F.col("previous.polled_at").alias("gap_from"),
            F.col("polled_at").alias("gap_to"),
            "gap_sec",
        )
    )


def poll_counts(polls: DataFrame, interval_sec: int) -> DataFrame:
    """Expected against actual polls per source."""
    span = F.timestamp_diff("SECOND", F.min("polled_at"), F.max("polled_at"))
    return polls.groupBy("source").agg(
        F.count("*").alias("polls"), (F.floor(span / interval_sec) + 1).alias("expected")
    )


def active_trips(day_services: DataFrame, trips: DataFrame) -> DataFrame:
    return (
        day_services.join(trips, ["schedule_version", "service_id"])
        .select("service_day", "trip_id")
        .distinct()
    )


def feed_scope_check(
    day_services: DataFrame, trips: DataFrame, seen: DataFrame, n_versions: int, min_active: int = MIN_ACTIVE_TRIPS
) -> DataFrame:
    """Per day: active trips (alarm when few) and feed trips missing in the allow-list."""
    active = active_trips(day_services, trips).groupBy("service_day").agg(F.count("*").alias("active_trips"))
    known = trips.select("trip_id").distinct()
    allowed = versions.allow_list(trips, n_versions).select("trip_id", F.lit(True).alias("allowed"))
    in_feed = (
        seen.join(known, "trip_id", "left_semi")
        .join(allowed, "trip_id", "left")
        .groupBy("service_day")
        .agg(F.count("*").alias("feed_trips"), F.count_if(F.col("allowed").isNull()).alias("missing_in_list"))
    )
    return active.join(in_feed, "service_day", "full_outer").select(
        "service_day",
        F.coalesce("active_trips", F.lit(0)).alias("active_trips"),
        F.coalesce("feed_trips", F.lit(0)).alias("feed_trips"),
        F.coalesce("missing_in_list", F.lit(0)).alias("missing_in_list"),
        (F.coalesce("active_trips", F.lit(0)) < min_active).alias("too_few_active"),
        (F.coalesce("missing_in_list", F.lit(0)) > 0).alias("list_incomplete"),
    )


def schedule_statistics(trips: DataFrame, lines: DataFrame, calendar: DataFrame) -> DataFrame:
    """Per version: routes, line numbers, modes, services, trips by mode and direction, range."""
    v = "schedule_version"
    routes = lines.groupBy(v).agg(
        F.countDistinct("route_id").alias("routes"),
        F.countDistinct("line").alias("line_names"),
        F.countDistinct("mode").alias("modes"),
    )
    per_trip = (
        trips.join(lines.select("route_id", v, "mode"), ["route_id", v])
        .groupBy(v)
        .agg(
            F.count("*").alias("trips"),
            *[F.count_if(F.col("mode") == m).alias(f"trips_{m}") for m in ("tram", "bus", "other")],
            F.count_if(F.col("direction") == 0).alias("trips_direction_0"),
            F.count_if(F.col("direction") == 1).alias("trips_direction_1"),
            F.count_if(F.col("direction").isNull()).alias("trips_without_direction"),
        )
    )
    services = trips.select(v, "service_id").distinct().groupBy(v).agg(F.count("*").alias("services"))
    span = (
        calendar.where(F.col("origin") == "calendar")
        .groupBy(v)
        .agg(F.min("start_date").alias("valid_from"), F.max("end_date").alias("valid_to"))
    )
    return routes.join(per_trip, v).join(services, v).join(span, v)
