"""Registered queries, third part: comparisons, streams and data-quality checks."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopwise.operators import direction, frame, rollup
from stopwise.plans.oracle_base import MIN_TRIPS, ONTIME
from stopwise.plans.queries import LINE_DIR, Context, r6, register, rounded
from stopwise.plans.queries_marts import _MASTER, _TOTALS, _agree
from stopwise.plans.warehouse import Warehouse
from stopwise.quality import checks
from stopwise.sources.store import TableStore
from stopwise.streaming import increments, ingest
from stopwise.streaming.version_store import VersionStore

DAY = "service_day"


# -- roll-ups and comparisons -----------------------------------------------------------------------

def big(expr: str) -> str:
    return f"CAST(coalesce({expr}, 0) AS BIGINT)"


def _weighted(cond: str = "true") -> str:
    return (
        f"coalesce(sum(coalesce(delay_mean_sec, 0) * assessable_stops) FILTER (WHERE {cond})"
        f" / nullif(sum(assessable_stops) FILTER (WHERE {cond}), 0), 0)"
    )


register("cmp1_period_rollup_network",
         lambda c: rounded(rollup.period_rollup(c.mart("network_profile"), ["mode"]), "delay_mean_sec"),
         f"""SELECT mode, count(DISTINCT service_day) AS days, min(service_day) AS first_day, max(service_day) AS last_day, {big('sum(trips)')} AS trips,
             {big('sum(planned_stops)')} AS planned_stops, {big('sum(assessable_stops)')} AS assessable_stops, {big('sum(on_time_3min)')} AS on_time,
             {big('sum(stops_trip_cancelled)')} AS stops_trip_cancelled, round({_weighted()}, 6) AS delay_mean_sec,
             CAST(sum(on_time_3min) AS DOUBLE) / nullif(sum(assessable_stops), 0) AS share, CASE WHEN count(DISTINCT service_day) = 1 THEN max(lines) END AS lines
             FROM network GROUP BY 1""", "first_day last_day")
register("cmp1_period_rollup_line",
         lambda c: rounded(rollup.period_rollup(c.mart("line_profile"), LINE_DIR), "delay_mean_sec"),
         f"""SELECT route_id, direction, count(DISTINCT service_day) AS days, min(service_day) AS first_day, max(service_day) AS last_day, {big('sum(trips)')} AS trips,
             {big('sum(planned_stops)')} AS planned_stops, {big('sum(assessable_stops)')} AS assessable_stops, {big('sum(on_time_3min)')} AS on_time,
             {big('sum(stops_trip_cancelled)')} AS stops_trip_cancelled, round({_weighted()}, 6) AS delay_mean_sec,
             CAST(sum(on_time_3min) AS DOUBLE) / nullif(sum(assessable_stops), 0) AS share FROM line_profile GROUP BY 1, 2""", "first_day last_day")
register("cmp2_period_filter",
         lambda c: rollup.period_filter(c.mart("line_profile"), dt.date(1999, 6, 30), dt.date(1998, 7, 1)).select(DAY, *LINE_DIR, "planned_stops"),
         "SELECT service_day, route_id, direction, planned_stops FROM line_profile WHERE service_day BETWEEN DATE '1998-07-01' AND DATE '1999-06-30'", DAY)


def _side_sql(s: str, cond: str) -> str:
    cols = [f"count(*) FILTER (WHERE {cond}) AS {s}_days"]
    for name, col in (("planned_stops",) * 2, ("assessable_stops",) * 2, ("on_time", "on_time_3min"), ("trips",) * 2,
                      ("stops_trip_cancelled",) * 2, ("stops_skipped",) * 2):
        cols.append(f"{big(f'sum({col}) FILTER (WHERE {cond})')} AS {s}_{name}")
    cols.append(f"round({_weighted(cond)}, 6) AS {s}_delay_mean_sec")
    cols.append(f"CAST(sum(on_time_3min) FILTER (WHERE {cond}) AS DOUBLE) / nullif(sum(assessable_stops) FILTER (WHERE {cond}), 0) AS {s}_share")
    return ", ".join(cols)


def _compare_sql(table: str, a: str, b: str) -> str:
    return f"""SELECT *, (b_share - a_share) * 100 AS difference_pp FROM (SELECT route_id, direction, {_side_sql('a', a)}, {_side_sql('b', b)},
        {_side_sql('all', 'true')} FROM {table} GROUP BY 1, 2)"""


_DELAYS = [f"{s}_delay_mean_sec" for s in ("a", "b", "all")]


def _compared(df: DataFrame) -> DataFrame:
    return rounded(df, *_DELAYS)


register("cmp2_default_comparison", lambda c: _compared(rollup.default_comparison(c.mart("line_profile"), LINE_DIR)),
         _compare_sql("line_profile", "service_day = (SELECT max(service_day) FROM line_profile WHERE service_day < (SELECT max(service_day) FROM line_profile))",
                      "service_day = (SELECT max(service_day) FROM line_profile)"))
register("cmp3_compare_sets", lambda c: _compared(rollup.compare_sets(c.mart("line_profile"), LINE_DIR, F.year(DAY) == 1996, F.year(DAY) == 1999)),
         _compare_sql("line_profile", "year(service_day) = 1996", "year(service_day) = 1999"))
register("cmp4_school_vs_holiday", lambda c: _compared(rollup.school_vs_holiday(c.mart("line_profile"), c.mart("school_calendar"), LINE_DIR)),
         _compare_sql("(SELECT l.*, s.holiday_bw FROM line_profile l LEFT JOIN school s ON s.service_day = l.service_day)", "NOT holiday_bw", "holiday_bw"))
register("cmp5_weekday_vs_weekend", lambda c: _compared(rollup.weekday_vs_weekend(c.mart("line_profile"), LINE_DIR)),
         _compare_sql("line_profile", "dayofweek(service_day) NOT IN (0, 6)", "dayofweek(service_day) IN (0, 6)"))


def _caveat_side(s: str, cond: str) -> str:
    kinds = {"weekday": "NOT IN (0, 6)", "saturday": "= 6", "sunday": "= 0"}
    cols = [f"count(*) FILTER (WHERE {cond}) AS {s}_days"]
    cols += [f"count(*) FILTER (WHERE {cond} AND dayofweek(service_day) {k}) AS {s}_{n}s" for n, k in kinds.items()]
    cols += [f"{big(f'sum({c}) FILTER (WHERE {cond})')} AS {s}_{c}" for c in ("trips", "assessable_stops", "planned_stops", "missing_hours")]
    cols.append(f"count(*) FILTER (WHERE {cond} AND situation = 'partly') AS {s}_partly_days")
    return ", ".join(cols)


register("cmp6_comparison_caveats",
         lambda c: rollup.comparison_caveats(c.mart("line_profile"), c.mart("data_quality"), c.mart("school_calendar"), LINE_DIR, ~F.col("holiday_bw"), F.col("holiday_bw")),
         f"""SELECT *, (a_weekdays > 0) <> (b_weekdays > 0) OR (a_sundays > 0) <> (b_sundays > 0) AS mix_differs,
             coalesce(abs(a_coverage - b_coverage) > 0.1, false) AS coverage_differs,
             coalesce(abs(b_trips_per_day - a_trips_per_day) / nullif(a_trips_per_day, 0) > 0.1, false) AS offer_differs,
             least(a_assessable_stops, b_assessable_stops) > 0 AND least(a_assessable_stops, b_assessable_stops) < 200 AS few_cases
             FROM (SELECT *, CAST(a_assessable_stops AS DOUBLE) / nullif(a_planned_stops, 0) AS a_coverage, CAST(b_assessable_stops AS DOUBLE) / nullif(b_planned_stops, 0) AS b_coverage,
                   CAST(a_trips AS DOUBLE) / nullif(a_days, 0) AS a_trips_per_day, CAST(b_trips AS DOUBLE) / nullif(b_days, 0) AS b_trips_per_day
                   FROM (SELECT route_id, direction, {_caveat_side('a', 'NOT holiday_bw')}, {_caveat_side('b', 'holiday_bw')}
                         FROM (SELECT l.*, q.missing_hours, s.holiday_bw, s.situation FROM line_profile l LEFT JOIN quality q ON q.service_day = l.service_day
                               LEFT JOIN school s ON s.service_day = l.service_day) GROUP BY 1, 2))""")
register("cmp7_viable_days", lambda c: c.viable, "SELECT service_day FROM quality WHERE coverage >= 0.4", DAY)
register("cmp7_viability", lambda c: rollup.viability(c.mart("data_quality")),
         """SELECT *, viable_days >= 3 AS enough_for_comparison, viable_days >= 1 AS enough_for_inventory
            FROM (SELECT count(*) AS days, count(*) FILTER (WHERE coverage >= 0.4) AS viable_days FROM quality)""")
_SUMS = "SELECT mode, " + ", ".join(f"sum({c}) AS {c}" for c in ["assessable_stops", "planned_stops", "stops_trip_cancelled"] + [f"on_time_{m}min" for m in ONTIME]) + \
    " FROM network WHERE service_day IN (SELECT service_day FROM quality WHERE coverage >= 0.4) GROUP BY 1"
_CURVE = " UNION ALL ".join(
    f"""SELECT {m} AS minutes, max(CASE WHEN mode = 'tram' THEN CAST(on_time_{m}min AS DOUBLE) / nullif(assessable_stops, 0) END) AS tram,
        max(CASE WHEN mode = 'bus' THEN CAST(on_time_{m}min AS DOUBLE) / nullif(assessable_stops, 0) END) AS bus FROM ({_SUMS})""" for m in ONTIME)
register("cmp8_mode_gap_curve", lambda c: rollup.mode_gap_curve(c.mart("network_profile"), c.viable),
         f"""SELECT minutes, tram, bus, gap_pp, coalesce(minutes = lead_at, false) AS is_leader,
             coalesce(minutes = min(CASE WHEN abs(gap_pp) >= 0.005 AND sign(gap_pp) <> lead_sign THEN minutes END) OVER (), false) AS is_tipping_point
             FROM (SELECT *, min_by(sign(gap_pp), minutes) FILTER (WHERE abs(gap_pp) >= 0.005) OVER () AS lead_sign,
                   min(minutes) FILTER (WHERE abs(gap_pp) >= 0.005) OVER () AS lead_at
                   FROM (SELECT *, (tram - bus) * 100 AS gap_pp FROM ({_CURVE}) WHERE tram IS NOT NULL AND bus IS NOT NULL))""")
register("cmp9_silent_lines", lambda c: rollup.silent_lines(c.totals).select("route_id", "planned_stops", "trips"),
         f"SELECT route_id, planned_stops, trips FROM ({_TOTALS}) WHERE NOT on_demand AND assessable_stops = 0")
register("cmp10_second_source_effect", lambda c: rollup.second_source_effect(c.totals),
         f"SELECT route_id, planned_stops, assessable_stops, assessable_first_source, second_source_from FROM ({_TOTALS}) WHERE second_source_from IS NOT NULL", "second_source_from")
register("cmp11_cancelled_share", lambda c: rollup.cancelled_share(c.mart("network_profile"), c.viable),
         f"""SELECT mode, CAST(planned_stops AS BIGINT) AS planned_stops, CAST(stops_trip_cancelled AS BIGINT) AS stops_trip_cancelled,
             CAST(stops_trip_cancelled AS DOUBLE) / nullif(planned_stops, 0) AS cancelled_share FROM ({_SUMS})""")
register("cmp12_hourly_rollup", lambda c: rollup.hourly_rollup(c.mart("hour_profile")),
         f"""SELECT route_id, direction, service_hour, {big('sum(assessable_stops)')} AS assessable_stops, {big('sum(on_time_3min)')} AS on_time,
             CAST(sum(on_time_3min) AS DOUBLE) / nullif(sum(assessable_stops), 0) AS share FROM hour_profile GROUP BY 1, 2, 3""")
register("cmp13_stop_profile_rollup", lambda c: rounded(rollup.stop_profile_rollup(c.mart("stop_profile")), "growth_mean_sec", "delay_mean_sec"),
         f"""SELECT route_id, direction, station_id, max_by(stop_name, service_day) AS stop_name,
             CAST(max_by(position, CASE WHEN position IS NOT NULL THEN service_day END) AS INTEGER) AS position,
             round(sum(coalesce(growth_mean_sec, 0) * coalesce(growth_cases, 0)) / nullif(sum(coalesce(growth_cases, 0)), 0), 6) AS growth_mean_sec,
             {big('sum(growth_cases)')} AS growth_cases, {big('sum(assessable_stops)')} AS assessable_stops, {big('sum(on_time_3min)')} AS on_time_3min,
             round(CASE WHEN sum(assessable_stops) > 0 THEN {_weighted()} END, 6) AS delay_mean_sec FROM stop_profile GROUP BY 1, 2, 3""")
register("cmp14_cancellation_rollup", lambda c: rollup.cancellation_rollup(c.mart("cancellations")),
         f"""SELECT route_id, direction, {', '.join(f"{big(f'sum({x})')} AS {x}" for x in ('trips', 'trips_cancelled', 'stops_skipped', 'planned_stops', 'trips_without_report'))},
             CAST(sum(trips_cancelled) AS DOUBLE) / nullif(sum(trips), 0) AS cancelled_share FROM cancellations GROUP BY 1, 2""")
register("cmp14_cancelled_per_day", lambda c: rollup.cancelled_per_day(c.mart("cancellations")),
         "SELECT *, CAST(trips_cancelled AS DOUBLE) / nullif(trips, 0) AS cancelled_share FROM cancellations", DAY)
_CATALOGUE = f"""SELECT m.route_id, m.line, m.route_text, m.mode, t.on_demand, t.assessable_stops FROM ({_MASTER}) m JOIN ({_TOTALS}) t ON t.route_id = m.route_id"""


def _search_sql(term: str, kind: str) -> str:
    return f"""SELECT *, assessable_stops = 0 AS silent FROM (SELECT c.*, CASE WHEN contains(lower(line), '{term}') OR contains(lower(route_text), '{term}') THEN NULL ELSE
        (SELECT min(stop_name) FROM stop_profile s WHERE s.route_id = c.route_id AND contains(lower(s.stop_name), '{term}')) END AS matching_stop,
        contains(lower(line), '{term}') OR contains(lower(route_text), '{term}') AS by_name FROM ({_CATALOGUE}) c WHERE {kind}) WHERE by_name OR matching_stop IS NOT NULL"""


register("cmp15_search_lines", lambda c: rollup.search_lines(c.catalogue, " Stop 2").drop("stop_names"),
         _search_sql("stop 2", "true").replace("SELECT *, assessable_stops = 0", "SELECT * EXCLUDE (by_name), assessable_stops = 0"))
register("cmp15_search_lines_bus", lambda c: rollup.search_lines(c.catalogue, "terminal 1", "bus").drop("stop_names"),
         _search_sql("terminal 1", "mode <> 'tram' AND NOT on_demand").replace("SELECT *, assessable_stops = 0", "SELECT * EXCLUDE (by_name), assessable_stops = 0"))

# -- streaming and increments -----------------------------------------------------------------------

_CHANGE = ["poll", "trip_id", "stop_id", "stop_sequence", "schedule_relationship", "arrival_delay", "departure_delay", "observed_at"]
register("str1_change_only", lambda c: ingest.change_only(c.feed_rows).select(*_CHANGE), f"SELECT {', '.join(_CHANGE)} FROM changes")
register("str2_idle_eviction", lambda c: ingest.idle_evictions(c.feed_rows),
         """SELECT trip_id, stop_id, last_poll, poll AS seen_again FROM (SELECT trip_id, stop_id, poll, lag(poll) OVER (PARTITION BY trip_id, stop_id
            ORDER BY poll, entity_id, stop_pos) AS last_poll FROM feed) WHERE poll - last_poll > 240""")


def _stream_ingest(c: Context) -> DataFrame:
    """Snapshot files through the streaming path, one file a micro-batch and the polls of a file from all
    over the time; the same log as the batch path must come out."""
    root = c.store.root
    done = f"{root}/stream_done"
    from stopwise.sources.store import path_exists

    if not path_exists(c.spark, f"{done}/_SUCCESS"):
        c.snapshots.repartition(4, F.xxhash64("poll")).write.mode("overwrite").json(f"{root}/snapshot_files")
        query = ingest.stream_ingest(
            c.spark, f"{root}/snapshot_files", f"{root}/stream_log", f"{root}/stream_checkpoint", files_per_trigger=1, late_polls=1 << 40
        )
        query.awaitTermination()
        c.spark.range(1).write.mode("overwrite").parquet(done)
    from stopwise.sources import scan

    return scan.scan_reports(c.spark, f"{root}/stream_log").select(*[x for x in _CHANGE if x != "poll"])


register("str3_stream_ingest", _stream_ingest, f"SELECT {', '.join(x for x in _CHANGE if x != 'poll')} FROM changes")
register("str4_recompute_window",
         lambda c: increments.recompute_window(c.fact, increments.window_start(c.mart("line_profile"))).groupBy(DAY).agg(F.count("*").alias("planned_stops")),
         "SELECT service_day, count(*) AS planned_stops FROM fact WHERE service_day >= (SELECT max(service_day) FROM line_profile) - INTERVAL 2 DAY GROUP BY 1", DAY)
register("str4_recompute_trip_reports",
         lambda c: increments.recompute_trip_reports(c.first.cancelled, increments.window_start(c.mart("line_profile"))),
         "SELECT * FROM cancelled WHERE day_in_feed >= (SELECT max(service_day) FROM line_profile) - INTERVAL 2 DAY OR day_in_feed IS NULL", "day_in_feed")
register("str5_recompute_newest_version",
         lambda c: rounded(increments.recompute_newest_version(c.position_partials, increments.newest_value(c.first.all_trips, "schedule_version")), "position_sum"),
         f"SELECT * REPLACE ({r6('position_sum')}) FROM partials WHERE schedule_version >= (SELECT max(schedule_version) FROM trips)", "schedule_version")


def _incremental_fact(c: Context) -> DataFrame:
    """The days of the window, built by a warehouse that looks at nothing before them."""
    start = increments.window_start(c.mart("line_profile"))
    return Warehouse(c.raw, MIN_TRIPS, TableStore(c.spark, f"{c.sf_dir} from {start}").keep, start).fact.where(F.col(DAY) >= F.lit(start))


register("str4_incremental_fact", lambda c: _incremental_fact(c).select(DAY, "route_id", "direction", "trip_id", "stop_sequence", "station_id", "state", "source"),
         """SELECT service_day, route_id, direction, trip_id, stop_sequence, station_id, state, source FROM fact
            WHERE service_day >= (SELECT max(service_day) FROM line_profile) - INTERVAL 2 DAY""", DAY)


def _versions_in_two_runs(c: Context) -> DataFrame:
    """Partial sums of all versions but the newest first; the second run adds the newest alone."""
    store = VersionStore(c.spark, f"{c.store.root}/versions-{uuid.uuid4().hex}")
    s = c.first
    newest = s.trips.agg(F.max("schedule_version")).scalar()
    build = lambda cut: direction.position_partials(cut(s.trips), cut(s.stop_times), cut(s.stops))
    store.layer("position_partials", s.trips.where(F.col("schedule_version") < newest), build)
    return rounded(store.layer("position_partials", s.trips, build), "position_sum")


register("str5_version_store", _versions_in_two_runs, f"SELECT * REPLACE ({r6('position_sum')}) FROM partials", "schedule_version")
register("str6_hourly_capture_stream",
         lambda c: ingest.hourly_capture_stream(c.feed_rows.select(F.timestamp_seconds("observed_at").alias("observed_ts"))),
         "SELECT date_trunc('hour', to_timestamp(observed_at) AT TIME ZONE 'UTC') AS hour_start, count(*) AS reports FROM feed GROUP BY 1", "hour_start")


def _guard(c: Context) -> DataFrame:
    """One lookup unchanged since the last full rebuild, one changed, one never built."""
    now = increments.lookup_signature(c.on_demand).select(F.lit("on_demand").alias("lookup"), "signature")
    old = increments.lookup_signature(c.takeover.where(F.col("route_id") != "de:net:00016:")).select(F.lit("takeover").alias("lookup"), "signature")
    logged = now.unionByName(old).withColumn("finished", F.lit("2001-01-01"))
    guard = increments.full_rebuild_guard(
        {"on_demand": c.on_demand, "takeover": c.takeover, "stops": c.first.stops.select("station_id").distinct()}, logged
    )
    return guard.select("lookup", "stale", "never_built")


register("str7_full_rebuild_guard", _guard,
         """SELECT 'on_demand' AS lookup, false AS stale, false AS never_built UNION ALL
            SELECT 'takeover', count(*) FILTER (WHERE route_id = 'de:net:00016:') > 0, false FROM takeover UNION ALL SELECT 'stops', false, true""")

# -- data quality -----------------------------------------------------------------------------------

register("dq1_check_unique", lambda c: checks.check_unique(c.first.reports.where(F.col("stop_id").isNotNull()), frame.STOP_KEY),
         """SELECT service_day, trip_id, stop_id, stop_sequence, count(*) AS rows FROM reports WHERE stop_id IS NOT NULL GROUP BY 1, 2, 3, 4 HAVING count(*) > 1""", DAY)
register("dq2_check_not_null", lambda c: checks.check_not_null(c.first.all_trips, "direction").select("trip_id", "schedule_version"),
         "SELECT trip_id, schedule_version FROM trips WHERE direction IS NULL", "schedule_version")
register("dq3_check_accepted", lambda c: checks.check_accepted(c.lines, "mode", ["tram", "bus"]).select("route_id", "mode", "schedule_version"),
         "SELECT route_id, mode, schedule_version FROM lines WHERE mode IS NOT NULL AND mode NOT IN ('tram', 'bus')", "schedule_version")
register("dq4_check_range", lambda c: checks.check_range(c.first.states, "service_hour", 0, 27, "warn").select(DAY, "trip_id", "stop_sequence", "service_hour", "severity"),
         "SELECT service_day, trip_id, stop_sequence, service_hour, 'warn' AS severity FROM frame WHERE service_hour < 0 OR service_hour > 27", DAY)
register("dq5_check_foreign_key", lambda c: checks.check_foreign_key(c.first.stop_times, "stop_id", c.first.stops, "stop_id").select("trip_id", "stop_id", "schedule_version"),
         "SELECT trip_id, stop_id, schedule_version FROM stop_times WHERE stop_id NOT IN (SELECT stop_id FROM stops)", "schedule_version")
register("dq6_check_states_sum", lambda c: checks.check_states_sum(c.mart("line_profile")).select(DAY, *LINE_DIR),
         """SELECT service_day, route_id, direction FROM line_profile WHERE assessable_stops + stops_trip_cancelled + stops_skipped
            + stops_unreported + stops_not_captured <> planned_stops""", DAY)
_RC = checks.RECONCILED
register("dq7_check_lines_cover_network", lambda c: checks.check_lines_cover_network(c.mart("line_profile"), c.mart("network_profile")),
         f"""SELECT service_day, mode, {', '.join(f'a.{m} AS {m}_a' for m in _RC)}, {', '.join(f'b.{m} AS {m}_b' for m in _RC)}
             FROM (SELECT service_day, mode, {', '.join(f'CAST(sum({m}) AS BIGINT) AS {m}' for m in _RC)} FROM line_profile WHERE NOT on_demand GROUP BY 1, 2) a
             FULL JOIN network b USING (service_day, mode) WHERE {' OR '.join(f'a.{m} IS DISTINCT FROM b.{m}' for m in _RC)}""", DAY)
register("dq8_check_no_double_source", lambda c: checks.check_no_double_source(c.fact),
         "SELECT service_day, route_id, min(source) AS source_a, max(source) AS source_b FROM fact GROUP BY 1, 2 HAVING count(DISTINCT source) > 1", DAY)
register("dq9_check_unmatched_subset", lambda c: checks.check_unmatched_subset(c.first.unmatched).select(DAY),
         "SELECT service_day FROM unmatched WHERE unmatched_trips > observed_trips OR unmatched_stops > observed_stops OR unmatched_trips < 0 OR unmatched_stops < 0", DAY)
register("dq10_check_resolution_rate", lambda c: checks.check_resolution_rate(c.first.unmatched, 5).select(DAY, "observed_trips", "unmatched_trips", "unmatched_share"),
         """SELECT service_day, observed_trips, unmatched_trips, CAST(unmatched_trips AS DOUBLE) / observed_trips AS unmatched_share FROM unmatched
            WHERE observed_trips >= 5 AND CAST(unmatched_trips AS DOUBLE) / observed_trips >= 0.01""", DAY)
register("dq11_check_direction_distinct", lambda c: checks.check_direction_distinct(c.direction_names),
         "SELECT route_id, count(*) AS directions, count(DISTINCT direction_name) AS names FROM names GROUP BY 1 HAVING count(*) > count(DISTINCT direction_name)")
register("dq12_check_direction_agree", lambda c: checks.check_direction_agree(c.inferred_directions),
         "SELECT route_id, count(*) AS disagreeing FROM inferred WHERE direction <> direction_by_ends GROUP BY 1 HAVING count(*) > 1")
register("dq13_check_station_merge", lambda c: checks.check_station_merge(c.first.stops),
         """SELECT schedule_version, station_id, count(DISTINCT station_source) AS forms, round(greatest(max(lat) - min(lat), max(lon) - min(lon)) * 111000) AS span_m
            FROM stops GROUP BY 1, 2 HAVING count(DISTINCT station_source) > 1 AND greatest(max(lat) - min(lat), max(lon) - min(lon)) * 111000 > 1000""", "schedule_version")
register("dq14_check_axis_follows_plan", lambda c: checks.check_axis_follows_plan(c.stop_axis, c.first.axis_per_version),
         f"SELECT * EXCLUDE (schedule_version) FROM ({_agree('SELECT max(schedule_version) AS schedule_version FROM axis')})")
register("dq15_check_stop_has_position", lambda c: checks.check_stop_has_position(c.mart("stop_profile")),
         """SELECT route_id, direction, station_id, min(stop_name) AS stop_name, count(*) AS days, CAST(sum(planned_stops) AS BIGINT) AS planned_stops
            FROM stop_profile WHERE position IS NULL GROUP BY 1, 2, 3""")
register("dq16_check_on_demand_listed", lambda c: checks.check_on_demand_listed(c.lines, c.on_demand),
         "SELECT DISTINCT route_id, line, route_text FROM lines WHERE lower(route_text) LIKE 'ruftaxi%' AND route_id NOT IN (SELECT route_id FROM on_demand)")
register("dq17_check_holiday_cover", lambda c: checks.check_holiday_cover(c.mart("school_calendar"), c.holidays),
         """SELECT a.state, a.listed_until, b.newest_day, b.unclassified_days, CAST(date_diff('day', b.newest_day, a.listed_until) AS INTEGER) AS days_left, 'list ends soon' AS finding
            FROM (SELECT state, max(last_day) AS listed_until FROM holidays GROUP BY 1) a
            CROSS JOIN (SELECT max(service_day) AS newest_day, count(*) FILTER (WHERE holiday_bw IS NULL) AS unclassified_days FROM school) b
            WHERE date_diff('day', b.newest_day, a.listed_until) < 60
            UNION ALL SELECT 'BW', (SELECT max(last_day) FROM holidays WHERE state = 'BW'), newest_day, unclassified_days, NULL, 'days without classification'
            FROM (SELECT max(service_day) AS newest_day, count(*) FILTER (WHERE holiday_bw IS NULL) AS unclassified_days FROM school) WHERE unclassified_days > 0""",
         "listed_until newest_day")
register("dq18_check_holiday_ranges", lambda c: checks.check_holiday_ranges(c.holidays),
         """SELECT 'reversed' AS finding, state, name AS name_a, CAST(NULL AS VARCHAR) AS name_b FROM holidays WHERE last_day < first_day UNION ALL
            SELECT 'overlap', a.state, a.name, b.name FROM holidays a JOIN holidays b ON b.state = a.state AND b.first_day > a.first_day AND b.first_day <= a.last_day""")
register("dq19_check_candidates", lambda c: checks.check_candidates(c.candidates).select("route_id", "line", "second_coverage"),
         """SELECT f.route_id, f.line, round(seen_trips::DOUBLE / planned_trips, 4) AS second_coverage
            FROM first_lines f JOIN offer o ON (o.line, o.mode) = (replace(replace(f.line, 'Net ', ''), 'Moonliner ', 'M'), f.mode)
            WHERE first_assessable_stops = 0 AND 4 * seen_trips >= planned_trips
              AND f.route_id NOT IN (SELECT route_id FROM on_demand UNION ALL SELECT route_id FROM takeover)""")
register("dq20_check_source_still_blind", lambda c: checks.check_source_still_blind(c.first.states, c.takeover),
         """SELECT f.route_id, count(*) FILTER (WHERE state IN ('measured', 'departure_only')) AS assessable_stops FROM states h JOIN trips f USING (trip_id, schedule_version)
            WHERE f.route_id IN (SELECT route_id FROM takeover) GROUP BY 1 HAVING count(*) FILTER (WHERE state IN ('measured', 'departure_only')) > 0""")
_UTC = "to_timestamp(observed_at) AT TIME ZONE 'UTC'"
register("dq21_partition_completeness", lambda c: checks.partition_completeness(c.log, dt.date(2024, 1, 11), 25, True),
         f"""SELECT DATE '2024-01-10' AS date, n AS hours, 25 AS expected FROM (SELECT count(DISTINCT CASE WHEN CAST({_UTC} AS DATE) = DATE '2024-01-10' THEN strftime({_UTC}, '%H') END) AS n,
             count(*) FILTER (WHERE CAST({_UTC} AS DATE) = DATE '2024-01-09') AS m FROM changes) WHERE m > 0 AND n < 25""", "date")
register("dq22_schedule_staleness",
         lambda c: checks.schedule_staleness(c.first.all_trips, c.mart("line_profile").agg((F.max(DAY) + F.expr("INTERVAL '900' DAY")).cast("date")).scalar()),
         """SELECT newest_version, CAST(date_diff('day', newest_version, d + INTERVAL 900 DAY) AS INTEGER) AS age_days
            FROM (SELECT (SELECT max(schedule_version) FROM trips) AS newest_version, (SELECT max(service_day) FROM line_profile) AS d)
            WHERE date_diff('day', newest_version, d + INTERVAL 900 DAY) > 21""", "newest_version")


def _line_findings(c: Context, version) -> DataFrame:
    """What a run over one version reports: every line with its course and mode."""
    return c.lines.where(F.col("schedule_version") == version).select(
        F.concat_ws(" ", F.lit("line"), "line", F.lit("runs"), "route_text", F.lit("as"), "mode").alias("finding"), "schedule_version"
    )


def _finding_diff(c: Context) -> DataFrame:
    """The run over the newest version against the run over the one before; each reported at the date of its version."""
    newest = c.lines.agg(F.max("schedule_version")).scalar()
    earlier = c.lines.where(F.col("schedule_version") < newest).agg(F.max("schedule_version")).scalar()
    at = F.col("schedule_version").cast("timestamp_ntz")
    previous = _line_findings(c, earlier).select("finding", at.alias("since"), at.alias("reported"))
    found = checks.finding_diff(previous, _line_findings(c, newest).select("finding"), newest.cast("timestamp_ntz"))
    return found.select("key", "status", "finding", "age_days")


_KEY = "regexp_replace(finding, '[0-9]+([.,][0-9]+)?', '#', 'g')"
_LINE_RUN = "SELECT concat_ws(' ', 'line', line, 'runs', route_text, 'as', mode) AS finding FROM lines WHERE schedule_version = {0}"
_NEWEST = "(SELECT max(schedule_version) FROM lines)"
_EARLIER = f"(SELECT max(schedule_version) FROM lines WHERE schedule_version < {_NEWEST})"
register("dq23_finding_diff", _finding_diff,
         f"""SELECT * FROM (WITH o AS (SELECT {_KEY} AS key, min(finding) AS finding FROM ({_LINE_RUN.format(_EARLIER)}) GROUP BY 1),
             n AS (SELECT {_KEY} AS key, min(finding) AS finding FROM ({_LINE_RUN.format(_NEWEST)}) GROUP BY 1),
             age AS (SELECT date_diff('day', {_EARLIER}, {_NEWEST}) AS days)
             SELECT key, CASE WHEN o.key IS NULL THEN 'new' WHEN n.key IS NULL THEN 'vanished' WHEN days >= 1 THEN 'lasting' ELSE 'known' END AS status,
                    coalesce(n.finding, o.finding) AS finding, CASE WHEN o.key IS NULL THEN 0 ELSE days END::BIGINT AS age_days
             FROM n FULL JOIN o USING (key), age)""")


def _escalation(c: Context) -> DataFrame:
    current = c.mart("line_profile").groupBy("route_id").agg(F.max(DAY).alias("d")).select(
        F.concat(F.lit("last seen "), F.col("d").cast("string"), F.lit(" on "), F.translate("route_id", "0123456789", "abcdefghij")).alias("finding"),
        F.translate("route_id", "0123456789", "abcdefghij").alias("line"), "d",
    )
    previous = current.select(
        F.concat(F.lit("last seen #-#-# on "), "line").alias("key"),
        (F.lit("2001-08-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(hours=F.dayofmonth("d"))).alias("since"),
    )
    now = F.lit("2001-08-02 00:00:00").cast("timestamp_ntz")
    return checks.finding_escalation(previous, current.select("finding"), now).select("finding", "age_hours", "level")


register("dq24_finding_escalation", _escalation,
         """SELECT 'last seen ' || CAST(d AS VARCHAR) || ' on ' || translate(route_id, '0123456789', 'abcdefghij') AS finding, CAST(24 - dayofmonth(d) AS DOUBLE) AS age_hours,
            CASE WHEN 24 - dayofmonth(d) >= 24 THEN 'high' WHEN 24 - dayofmonth(d) >= 3 THEN 'raised' ELSE 'normal' END AS level
            FROM (SELECT route_id, max(service_day) AS d FROM line_profile GROUP BY 1)""")

# -- checks on tables in which their rule is broken ---------------------------------------------------
# The real tables keep most rules, so that a check that finds nothing proves little. Here a rule is broken
# in a known part of the rows of the same table.



def _seventh():
    return F.when(F.dayofmonth(DAY) % 7 == 0, 1).otherwise(0)


register("dq6_broken_states_sum", lambda c: checks.check_states_sum(c.mart("line_profile").withColumn("planned_stops", F.col("planned_stops") + _seventh())).select(DAY, *LINE_DIR),
         "SELECT service_day, route_id, direction FROM line_profile WHERE day(service_day) % 7 = 0", DAY)
register("dq7_broken_cover",
         lambda c: checks.check_lines_cover_network(c.mart("line_profile"), c.mart("network_profile").withColumn(_RC[0], F.col(_RC[0]) + _seventh())),
         f"""SELECT service_day, mode, {', '.join(f'CAST(sum(l.{m}) AS BIGINT) AS {m}_a' for m in _RC)},
             {', '.join(f"any_value(n.{m}){' + 1' if m == _RC[0] else ''} AS {m}_b" for m in _RC)}
             FROM line_profile l JOIN network n USING (service_day, mode) WHERE NOT on_demand AND day(service_day) % 7 = 0 GROUP BY 1, 2""", DAY)
register("dq8_broken_single_source",
         lambda c: checks.check_no_double_source(c.fact.unionByName(c.fact.where(F.dayofmonth(DAY) % 7 == 0).withColumn("source", F.concat("source", F.lit(" again"))))),
         "SELECT DISTINCT service_day, route_id, source AS source_a, source || ' again' AS source_b FROM fact WHERE day(service_day) % 7 = 0", DAY)
register("dq9_broken_subset", lambda c: checks.check_unmatched_subset(c.first.unmatched.withColumn("unmatched_trips", F.col("unmatched_trips") - 1_000_000 * _seventh())).select(DAY),
         "SELECT service_day FROM unmatched WHERE day(service_day) % 7 = 0", DAY)
_FLIPPED = "right(trip_id, 1) IN ('0', '2', '4', '6', '8')"
register("dq12_broken_directions",
         lambda c: checks.check_direction_agree(c.inferred_directions.withColumn(
             "direction_by_ends", F.when(F.expr(_FLIPPED), 1 - F.col("direction")).otherwise(F.col("direction")).cast("tinyint"))),
         f"SELECT route_id, count(*) FILTER (WHERE {_FLIPPED}) AS disagreeing FROM inferred WHERE direction IS NOT NULL GROUP BY 1 HAVING count(*) FILTER (WHERE {_FLIPPED}) > 1")
register("dq14_broken_axis",
         lambda c: checks.check_axis_follows_plan(c.stop_axis.withColumn("position", -F.col("position")), c.first.axis_per_version),
         f"SELECT * EXCLUDE (schedule_version) FROM ({_agree('SELECT max(schedule_version) AS schedule_version FROM axis').replace('s.position,', '-s.position,')})")
register("fn17_broken_slugs", lambda c: checks.assert_slug_unique(c.lines.unionByName(c.lines.withColumn("route_id", F.concat("route_id", F.lit("!"))))),
         """SELECT trim(regexp_replace(lower(route_id), '[^a-z0-9]+', '-', 'g'), '-') AS slug, 2 * count(DISTINCT route_id) AS keys, min(route_id) AS example
            FROM lines GROUP BY 1""")
