"""Roll-ups and comparisons over day sets: shares are sums over sums, never means of shares."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stopwise.functions import time as tm
from stopwise.functions import values as vl

VIABLE_COVERAGE = 0.4
MIN_DAYS = {"comparison": 3, "inventory": 1}
NO_GAP = 0.005
MIN_ASSESSABLE = 200


def weighted_mean(value: str, weight: str, condition: Column | None = None) -> Column:
    """Mean of daily means weighted by cases; 0 where nothing was measured."""
    w = F.col(weight) if condition is None else F.when(condition, F.col(weight))
    total = F.sum(F.coalesce(value, F.lit(0.0)) * w)
    return F.coalesce(vl.safe_ratio(total, F.sum(w)), F.lit(0.0))


def period_rollup(mart: DataFrame, keys: list[str], threshold: int = 3) -> DataFrame:
    """Counters summed over the days of `mart`; a line count only holds for a single day."""
    aggs = [
        F.countDistinct("service_day").alias("days"),
        F.min("service_day").alias("first_day"),
        F.max("service_day").alias("last_day"),
        F.sum("trips").alias("trips"),
        F.sum("planned_stops").alias("planned_stops"),
        F.sum("assessable_stops").alias("assessable_stops"),
        F.sum(f"on_time_{threshold}min").alias("on_time"),
        F.sum("stops_trip_cancelled").alias("stops_trip_cancelled"),
        weighted_mean("delay_mean_sec", "assessable_stops").alias("delay_mean_sec"),
    ]
    if "lines" in mart.columns:
        aggs.append(F.max("lines").alias("max_lines"))
    out = mart.groupBy(*keys).agg(*aggs).withColumn(
        "share", vl.safe_ratio(F.col("on_time"), F.col("assessable_stops"))
    )
    if "lines" in mart.columns:
        out = out.withColumn("lines", F.when(F.col("days") == 1, F.col("max_lines"))).drop("max_lines")
    return out


def in_period(day: Column, start: dt.date | None, end: dt.date | None) -> Column:
    """Inclusive range, open where an end is missing; swapped ends are put in order."""
    if start is not None and end is not None and start > end:
        start, end = end, start
    condition = F.lit(True)
    if start is not None:
        condition = condition & (day >= F.lit(start))
    if end is not None:
        condition = condition & (day <= F.lit(end))
    return condition


def newest_days(mart: DataFrame) -> DataFrame:
    """Newest day and the one before it (the newest again when there is only one)."""
    newest = mart.agg(F.max("service_day").alias("d"))
    before = mart.where(F.col("service_day") < newest.scalar()).agg(F.max("service_day").alias("d"))
    return newest.select(
        F.col("d").alias("newest"), F.coalesce(before.scalar(), F.col("d")).alias("before")
    )


def period_filter(mart: DataFrame, start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
    return mart.where(in_period(F.col("service_day"), start, end))


def default_comparison(mart: DataFrame, keys: list[str], threshold: int = 3) -> DataFrame:
    """The newest day (b) against the one before (a)."""
    days = newest_days(mart)
    marked = mart.withColumns(
        {"_b": days.select("newest").scalar(), "_a": days.select("before").scalar()}
    )
    return compare_sets(
        marked, keys, F.col("service_day") == F.col("_a"), F.col("service_day") == F.col("_b"), threshold
    )


def _side(name: str, condition: Column, threshold: int) -> list[Column]:
    def total(c: str) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col(c))), F.lit(0)).alias(f"{name}_{c}")

    return [
        F.count_if(condition).alias(f"{name}_days"),
        total("planned_stops"),
        total("assessable_stops"),
        F.coalesce(F.sum(F.when(condition, F.col(f"on_time_{threshold}min"))), F.lit(0)).alias(f"{name}_on_time"),
        total("trips"),
        total("stops_trip_cancelled"),
        total("stops_skipped"),
        weighted_mean("delay_mean_sec", "assessable_stops", condition).alias(f"{name}_delay_mean_sec"),
    ]


def compare_sets(
    mart: DataFrame, keys: list[str], in_a: Column, in_b: Column, threshold: int = 3
) -> DataFrame:
    """Two day sets side by side and everything together, in one pass over the mart.

    `mart` has one row per key and day. A NULL membership means in neither set.
    """
    a, b = F.coalesce(in_a, F.lit(False)), F.coalesce(in_b, F.lit(False))
    sums = mart.groupBy(*keys).agg(
        *_side("a", a, threshold), *_side("b", b, threshold), *_side("all", F.lit(True), threshold)
    )
    shares = {
        f"{s}_share": vl.safe_ratio(F.col(f"{s}_on_time"), F.col(f"{s}_assessable_stops"))
        for s in ("a", "b", "all")
    }
    return sums.withColumns(shares).withColumn("difference_pp", (F.col("b_share") - F.col("a_share")) * 100)


def school_vs_holiday(mart: DataFrame, calendar: DataFrame, keys: list[str], threshold: int = 3) -> DataFrame:
    """School days (a) against holidays (b) of the lead state; unknown days only in the total.

    The calendar has one row per day, which bounds the broadcast.
    """
    flags = F.broadcast(calendar.select("service_day", "holiday_bw"))
    marked = mart.join(flags, "service_day", "left")
    return compare_sets(marked, keys, ~F.col("holiday_bw"), F.col("holiday_bw"), threshold)


def weekday_vs_weekend(mart: DataFrame, keys: list[str], threshold: int = 3) -> DataFrame:
    weekend = tm.is_weekend(F.col("service_day"))
    return compare_sets(mart, keys, ~weekend, weekend, threshold)


def comparison_caveats(
    mart: DataFrame,
    quality: DataFrame,
    calendar: DataFrame,
    keys: list[str],
    in_a: Column,
    in_b: Column,
    by_weekday: bool = False,
) -> DataFrame:
    """What else could explain a difference: day mix, coverage, offer, gaps, thin data."""
    per_day = quality.select("service_day", "missing_hours").join(
        calendar.select("service_day", "situation", "holiday_bw"), "service_day", "full_outer"
    )
    marked = mart.join(F.broadcast(per_day), "service_day", "left").withColumns(
        {
            "kind": tm.day_kind(F.col("service_day")),
            "in_a": F.coalesce(in_a, F.lit(False)),
            "in_b": F.coalesce(in_b, F.lit(False)),
        }
    )
    aggs = []
    for s in ("a", "b"):
        inside = F.col(f"in_{s}")
        aggs += [
            F.count_if(inside).alias(f"{s}_days"),
            *[
                F.count_if(inside & (F.col("kind") == k)).alias(f"{s}_{k}s")
                for k in ("weekday", "saturday", "sunday")
            ],
            *[
                F.coalesce(F.sum(F.when(inside, F.col(c))), F.lit(0)).alias(f"{s}_{c}")
                for c in ("trips", "assessable_stops", "planned_stops", "missing_hours")
            ],
            F.count_if(inside & (F.col("situation") == "partly")).alias(f"{s}_partly_days"),
        ]
    sums = marked.groupBy(*keys).agg(*aggs)

    def ratio(s: str, n: str, d: str) -> Column:
        return vl.safe_ratio(F.col(f"{s}_{n}"), F.col(f"{s}_{d}"))

    sums = sums.withColumns(
        {
            "a_coverage": ratio("a", "assessable_stops", "planned_stops"),
            "b_coverage": ratio("b", "assessable_stops", "planned_stops"),
            "a_trips_per_day": ratio("a", "trips", "days"),
            "b_trips_per_day": ratio("b", "trips", "days"),
        }
    )
    mix = ((F.col("a_weekdays") > 0) != (F.col("b_weekdays") > 0)) | (
        (F.col("a_sundays") > 0) != (F.col("b_sundays") > 0)
    )
    thin = F.least("a_assessable_stops", "b_assessable_stops")
    offer = F.col("a_trips_per_day")
    return sums.withColumns(
        {
            "mix_differs": F.lit(False) if by_weekday else mix,
            "coverage_differs": F.coalesce(F.abs(F.col("a_coverage") - F.col("b_coverage")) > 0.1, F.lit(False)),
            "offer_differs": F.coalesce(
                vl.safe_ratio(F.abs(F.col("b_trips_per_day") - offer), offer) > 0.1, F.lit(False)
            ),
            "few_cases": (thin > 0) & (thin < MIN_ASSESSABLE),
        }
    )


# -- findings ---------------------------------------------------------------------------------


def viable_days(quality: DataFrame, min_coverage: float = VIABLE_COVERAGE) -> DataFrame:
    return quality.where(F.col("coverage") >= min_coverage).select("service_day")


def viability(quality: DataFrame) -> DataFrame:
    """How many days carry a finding, and which kinds of finding they carry."""
    n = F.count_if(F.coalesce(F.col("coverage") >= VIABLE_COVERAGE, F.lit(False)))
    return quality.agg(F.count("*").alias("days"), n.alias("viable_days")).withColumns(
        {f"enough_for_{k}": F.col("viable_days") >= v for k, v in MIN_DAYS.items()}
    )


def network_sums(network: DataFrame, days: DataFrame) -> DataFrame:
    """Network counters per mode over a day set."""
    return (
        network.join(F.broadcast(days.select("service_day").distinct()), "service_day", "left_semi")
        .groupBy("mode")
        .agg(
            *[
                F.sum(c).alias(c)
                for c in ["assessable_stops", "planned_stops", "stops_trip_cancelled", "trips"]
                + [f"on_time_{t}min" for t in vl.THRESHOLDS_MIN]
            ]
        )
    )


def mode_gap_curve(network: DataFrame, days: DataFrame) -> DataFrame:
    """Tram against bus at every threshold, with the leader and the tipping point."""
    curve = (
        network_sums(network, days)
        .unpivot(
            ["mode", "assessable_stops"], [f"on_time_{t}min" for t in vl.THRESHOLDS_MIN], "name", "on_time"
        )
        .withColumn("minutes", F.regexp_extract("name", "[0-9]+", 0).cast("int"))
        .groupBy("minutes")
        .pivot("mode", ["tram", "bus"])
        .agg(F.max(vl.safe_ratio(F.col("on_time"), F.col("assessable_stops"))))
        .where(F.col("tram").isNotNull() & F.col("bus").isNotNull())
        .withColumn("gap_pp", (F.col("tram") - F.col("bus")) * 100)
    )
    clear = F.abs(F.col("gap_pp")) >= NO_GAP
    lead = curve.where(clear).agg(
        F.min_by(F.struct("minutes", F.signum("gap_pp").alias("sign")), "minutes").alias("l")
    )
    other = curve.where(clear & (F.signum("gap_pp") != lead.select("l.sign").scalar())).agg(
        F.min("minutes").alias("m")
    )
    return curve.select(
        "minutes",
        "tram",
        "bus",
        "gap_pp",
        F.coalesce(F.col("minutes") == lead.select("l.minutes").scalar(), F.lit(False)).alias("is_leader"),
        F.coalesce(F.col("minutes") == other.scalar(), F.lit(False)).alias("is_tipping_point"),
    )


def cancelled_share(network: DataFrame, days: DataFrame) -> DataFrame:
    return network_sums(network, days).select(
        "mode",
        "planned_stops",
        "stops_trip_cancelled",
        vl.safe_ratio(F.col("stops_trip_cancelled"), F.col("planned_stops")).alias("cancelled_share"),
    )


# -- line lists -------------------------------------------------------------------------------


def line_totals(lines_mart: DataFrame) -> DataFrame:
    """Sums per line over all days; a missing source means the first one."""
    second = F.coalesce(F.col("source") == "second", F.lit(False))
    sums = lines_mart.groupBy("route_id").agg(
        *[
            F.sum(c).alias(c)
            for c in ["planned_stops", "assessable_stops", "on_time_3min", "trips"]
        ],
        F.max("on_demand").alias("on_demand"),
        F.min(F.when(second, F.col("service_day"))).alias("second_source_from"),
        F.sum(F.when(~second, F.col("assessable_stops"))).alias("_first"),
    )
    return sums.withColumn(
        "assessable_first_source",
        F.when(F.col("second_source_from").isNotNull(), F.coalesce("_first", F.lit(0))),
    ).drop("_first")


def line_stop_names(stop_profile: DataFrame) -> DataFrame:
    return stop_profile.groupBy("route_id").agg(
        F.sort_array(F.collect_set("stop_name")).alias("stop_names")
    )


def latest_line_master(lines: DataFrame) -> DataFrame:
    newest = Window.partitionBy("route_id").orderBy(F.col("schedule_version").desc())
    return lines.withColumn("rank", F.row_number().over(newest)).where(F.col("rank") == 1).drop("rank")


def observed_lines_only(master: DataFrame, lines_mart: DataFrame) -> DataFrame:
    return master.join(lines_mart.select("route_id"), "route_id", "left_semi")


def latest_network(network: DataFrame, quality: DataFrame) -> DataFrame:
    """Rows of the newest day, with the span of days and the newest complete one."""
    span = quality.agg(
        F.min("service_day").alias("first_day"),
        F.max("service_day").alias("last_day"),
        F.max(F.when(F.col("complete"), F.col("service_day"))).alias("last_complete_day"),
    )
    return (
        network.where(F.col("service_day") == span.select("last_day").scalar())
        .withColumns({c: span.select(c).scalar() for c in ["first_day", "last_complete_day"]})
        .orderBy("mode")
    )


def silent_lines(totals: DataFrame) -> DataFrame:
    """Regular lines without one assessable stop, heaviest first."""
    return totals.where(~F.col("on_demand") & (F.col("assessable_stops") == 0)).orderBy(
        F.col("planned_stops").desc(), "route_id"
    )


def second_source_effect(totals: DataFrame) -> DataFrame:
    return totals.where(F.col("second_source_from").isNotNull()).select(
        "route_id",
        "planned_stops",
        "assessable_stops",
        "assessable_first_source",
        "second_source_from",
    )


def line_ranking(totals: DataFrame, sort: str = "share_desc") -> DataFrame:
    """Lines by punctuality (either way; unmeasured count as -1) or by assessable stops."""
    share = F.when(
        F.col("assessable_stops") > 0, F.col("on_time_3min") / F.col("assessable_stops")
    ).otherwise(F.lit(-1.0))
    ranked = totals.withColumn("rank_value", share)
    orders = {
        "share_desc": [F.col("rank_value").desc(), F.col("assessable_stops").desc()],
        "share_asc": [F.col("rank_value").asc(), F.col("assessable_stops").desc()],
        "stops": [F.col("assessable_stops").desc(), F.col("planned_stops").desc()],
    }
    return ranked.orderBy(*orders[sort], "route_id")


def search_lines(catalogue: DataFrame, term: str = "", kind: str = "all") -> DataFrame:
    """Lines whose name, route text or any stop name holds the term.

    `catalogue`: line, route_text, mode, on_demand, assessable_stops, stop_names.
    """
    wanted = {
        "all": F.lit(True),
        "on_demand": F.col("on_demand"),
        "tram": (F.col("mode") == "tram") & ~F.col("on_demand"),
        "bus": (F.col("mode") != "tram") & ~F.col("on_demand"),
    }[kind]
    needle = F.lit(term.strip().lower())

    def holds(text: Column) -> Column:
        return F.contains(F.lower(text), needle)

    by_name = holds(F.col("line")) | holds(F.col("route_text"))
    stops = F.filter("stop_names", holds)
    hit = F.coalesce(F.size(stops) > 0, F.lit(False))
    return catalogue.where(wanted & (by_name | hit)).select(
        "*",
        F.when(~by_name, F.get(stops, F.lit(0))).alias("matching_stop"),
        (F.col("assessable_stops") == 0).alias("silent"),
    )


def last_n_days(mart: DataFrame, series: list[str], n: int = 30) -> DataFrame:
    newest = Window.partitionBy(*series).orderBy(F.col("service_day").desc())
    return mart.withColumn("day_rank", F.dense_rank().over(newest)).where(F.col("day_rank") <= n)


# -- line pages -------------------------------------------------------------------------------


def hourly_rollup(hours: DataFrame, threshold: int = 3) -> DataFrame:
    return (
        hours.groupBy("route_id", "direction", "service_hour")
        .agg(
            F.sum("assessable_stops").alias("assessable_stops"),
            F.sum(f"on_time_{threshold}min").alias("on_time"),
        )
        .withColumn("share", vl.safe_ratio(F.col("on_time"), F.col("assessable_stops")))
    )


def stop_profile_rollup(stops: DataFrame) -> DataFrame:
    """Per station over a period; name and position come from the newest day that has them."""
    day = F.col("service_day")
    growth = F.sum(F.coalesce("growth_mean_sec", F.lit(0.0)) * F.coalesce("growth_cases", F.lit(0)))
    cases = F.sum(F.coalesce("growth_cases", F.lit(0)))
    return (
        stops.groupBy("route_id", "direction", "station_id")
        .agg(
            F.max_by("stop_name", day).alias("stop_name"),
            F.max_by("position", F.when(F.col("position").isNotNull(), day)).alias("position"),
            vl.safe_ratio(growth, cases).alias("growth_mean_sec"),
            cases.alias("growth_cases"),
            F.sum("assessable_stops").alias("assessable_stops"),
            F.sum("on_time_3min").alias("on_time_3min"),
            weighted_mean("delay_mean_sec", "assessable_stops").alias("_delay"),
        )
        .withColumn("delay_mean_sec", F.when(F.col("assessable_stops") > 0, F.col("_delay")))
        .drop("_delay")
        .orderBy("route_id", "direction", F.col("position").asc_nulls_last(), "stop_name")
    )


def cancellation_rollup(cancelled: DataFrame) -> DataFrame:
    return (
        cancelled.groupBy("route_id", "direction")
        .agg(
            *[
                F.sum(c).alias(c)
                for c in ["trips", "trips_cancelled", "stops_skipped", "planned_stops", "trips_without_report"]
            ]
        )
        .withColumn("cancelled_share", vl.safe_ratio(F.col("trips_cancelled"), F.col("trips")))
    )


def cancelled_per_day(cancelled: DataFrame) -> DataFrame:
    return cancelled.withColumn(
        "cancelled_share", vl.safe_ratio(F.col("trips_cancelled"), F.col("trips"))
    )


def full_reconcile(a: DataFrame, b: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    """Keys whose measures differ between two roll-ups, or that only one of them has."""
    left = a.select(*keys, *[F.col(m).alias(f"{m}_a") for m in measures])
    right = b.select(*keys, *[F.col(m).alias(f"{m}_b") for m in measures])
    differs = F.lit(False)
    for m in measures:
        differs = differs | ~F.col(f"{m}_a").eqNullSafe(F.col(f"{m}_b"))
    return left.join(right, keys, "full_outer").where(differs)
