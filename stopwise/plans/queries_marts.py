"""Registered queries, second part: aggregates, windows, roll-ups, streams and checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopwise.adapters import event_feed
from stopwise.adapters.driver_tables import OPERATOR_PREFIX
from stopwise.functions import text as tx
from stopwise.operators import axis as ax
from stopwise.operators import diagnostics, direction, rollup, staging, versions
from stopwise.operators.neighbours import dense_numbers
from stopwise.plans.oracle_base import MIN_TRIPS
from stopwise.plans.queries import LINE_DIR, Context, r6, register, rounded
from stopwise.quality import checks

DAY = "service_day"

# -- aggregations ------------------------------------------------------------------------------------

register("ag1_trip_reports", lambda c: staging.trip_reports(c.first.reports),
         """SELECT trip_id, day_in_feed, relationship, min(observed_at) AS first_seen, max(observed_at) AS last_seen, count(*) AS reports
            FROM reports WHERE stop_id IS NULL GROUP BY 1, 2, 3""", "day_in_feed first_seen last_seen")
register("ag2_trip_cancelled", lambda c: c.first.cancelled, "SELECT * FROM cancelled", "day_in_feed")
register("ag3_version_scores", lambda c: versions.version_scores(c.first.seen, c.first.all_trips, MIN_TRIPS), "SELECT * FROM scores", "service_day schedule_version")
register("ag4_collected_hours", lambda c: c.first.collected_hours, "SELECT * FROM collected", "hour_start")
register("ag5_capture_gaps", lambda c: c.first.capture_gaps, "SELECT * FROM gaps", DAY)
register("ag5_capture_gaps_second", lambda c: c.second.capture_gaps, "SELECT * FROM gaps2", DAY)
register("ag6_unmatched_reports", lambda c: c.first.unmatched, "SELECT * FROM unmatched", "service_day schedule_version")
register("ag7_trip_shape", lambda c: c.trip_shapes,
         "SELECT trip_id, schedule_version, route_id, direction, stops, last_stop, first_station, last_station, quarter_stop FROM shapes", "schedule_version")
register("ag8_direction_names", lambda c: direction.direction_names(c.trip_shapes), "SELECT * FROM names")
register("ag9_position_partials", lambda c: rounded(c.position_partials, "position_sum"),
         f"SELECT * REPLACE ({r6('position_sum')}) FROM partials", "schedule_version")
register("ag9_position_mean", lambda c: rounded(direction.position_mean(c.position_partials), "position"),
         f"SELECT * REPLACE ({r6('position')}) FROM pos_mean")
register("ag10_end_pairs", lambda c: c.end_pairs, "SELECT * FROM pairs", "schedule_version")
register("ag11_infer_direction",
         lambda c: direction.infer_direction(c.second_runs, c.takeover_positions, c.takeover_end_pairs), "SELECT * FROM inferred", "schedule_version")
register("ag12_direction_crosscheck", lambda c: direction.direction_crosscheck(c.second_runs, c.takeover_end_pairs), "SELECT * FROM crosscheck2", "schedule_version")
register("ag13_line_profile", lambda c: c.line_profile, "SELECT * FROM line_profile", DAY)
register("ag14_hour_profile", lambda c: c.hour_profile, "SELECT * FROM hour_profile", DAY)
register("ag15_stop_profile", lambda c: c.stop_profile, "SELECT * FROM stop_profile", DAY)
register("ag16_cancellations", lambda c: c.cancellations, "SELECT * FROM cancellations", DAY)
register("ag17_network_profile", lambda c: c.network_profile, "SELECT * FROM network", DAY)
register("ag18_forecast_quality", lambda c: c.forecast_quality, "SELECT * FROM forecast", DAY)
register("ag19_data_quality", lambda c: c.data_quality, "SELECT * FROM quality", "service_day first_report last_report")
register("ag20_school_calendar", lambda c: c.school_calendar, "SELECT * FROM school", DAY)
register("ag21_source_candidates", lambda c: c.candidates,
         """SELECT * FROM (WITH named AS (SELECT *, replace(replace(line, 'Net ', ''), 'Moonliner ', 'M') AS line_short FROM first_lines),
            met AS (SELECT n.*, o.* EXCLUDE (line, mode), seen_trips::DOUBLE / planned_trips AS ratio,
                      n.route_id IN (SELECT route_id FROM on_demand) AS on_demand, n.route_id IN (SELECT route_id FROM takeover) AS taken_over
                    FROM named n LEFT JOIN offer o ON (o.line, o.mode) = (n.line_short, n.mode))
            SELECT route_id, line, mode, line_short, first_planned_stops, first_assessable_stops, first_days, ifnull(planned_trips, 0) AS second_planned_trips,
              ifnull(seen_trips, 0) AS second_seen_trips, ifnull(days, 0) AS second_days, round(ratio, 4) AS second_coverage, on_demand, taken_over,
              CASE WHEN first_assessable_stops > 0 OR on_demand OR taken_over THEN false ELSE ratio >= 0.25 END AS candidate FROM met)""")

_TOTALS = """SELECT route_id, CAST(sum(planned_stops) AS BIGINT) AS planned_stops, CAST(sum(assessable_stops) AS BIGINT) AS assessable_stops,
    CAST(sum(on_time_3min) AS BIGINT) AS on_time_3min, CAST(sum(trips) AS BIGINT) AS trips, bool_or(on_demand) AS on_demand,
    min(CASE WHEN source = 'second' THEN service_day END) AS second_source_from,
    CASE WHEN bool_or(source = 'second') THEN CAST(coalesce(sum(CASE WHEN source IS NULL OR source <> 'second' THEN assessable_stops END), 0) AS BIGINT) END AS assessable_first_source
    FROM line_profile GROUP BY 1"""
_MASTER = "SELECT * FROM lines QUALIFY row_number() OVER (PARTITION BY route_id ORDER BY schedule_version DESC) = 1"
register("ag22_line_totals", lambda c: c.totals, _TOTALS, "second_source_from")
register("ag23_line_stop_names",
         lambda c: rollup.line_stop_names(c.mart("stop_profile")).select("route_id", F.array_join("stop_names", "|").alias("stop_names")),
         "SELECT route_id, string_agg(DISTINCT stop_name, '|' ORDER BY stop_name) AS stop_names FROM stop_profile GROUP BY 1")
register("ag24_latest_network", lambda c: rollup.latest_network(c.mart("network_profile"), c.mart("data_quality")),
         """SELECT n.*, q.first_day, q.last_complete_day FROM network n JOIN (SELECT min(service_day) AS first_day, max(service_day) AS last_day,
            max(CASE WHEN complete THEN service_day END) AS last_complete_day FROM quality) q ON q.last_day = n.service_day""",
         "service_day first_day last_complete_day")
register("ag25_observed_lines_only", lambda c: rollup.observed_lines_only(c.master, c.mart("line_profile")),
         f"SELECT * FROM ({_MASTER}) WHERE route_id IN (SELECT route_id FROM line_profile)", "schedule_version")

_ASOF = """SELECT service_day, coalesce((SELECT max(schedule_version) FROM trips f WHERE f.schedule_version <= d.service_day),
    (SELECT min(schedule_version) FROM trips)) AS schedule_version FROM (SELECT DISTINCT day_in_feed AS service_day FROM reports WHERE day_in_feed IS NOT NULL) d"""
register("ag26_run_coverage", lambda c: diagnostics.run_coverage(c.first.reports, c.asof_days, c.first.stop_times),
         f"""SELECT service_day, schedule_version, count(*) AS trips, count(*) FILTER (WHERE planned IS NULL) AS without_plan,
             round(round(avg(share) * 100, 8), 1) AS mean_pct, round(round(median(share) * 100, 8), 1) AS median_pct,
             count(*) FILTER (WHERE share >= 0.9) AS trips_90, count(*) FILTER (WHERE share >= 0.5) AS trips_50
             FROM (SELECT b.service_day, v.schedule_version, s.planned, CAST(b.seen AS DOUBLE) / s.planned AS share
                   FROM (SELECT day_in_feed AS service_day, trip_id, count(DISTINCT stop_sequence) AS seen FROM reports WHERE day_in_feed IS NOT NULL GROUP BY 1, 2) b
                   JOIN ({_ASOF}) v ON v.service_day = b.service_day
                   LEFT JOIN (SELECT trip_id, schedule_version, count(*) AS planned FROM stop_times GROUP BY 1, 2) s
                     ON s.trip_id = b.trip_id AND s.schedule_version = v.schedule_version) GROUP BY 1, 2""", "service_day schedule_version")
register("ag27_silent_lines_per_day", lambda c: diagnostics.silent_lines_per_day(c.first.reports, c.asof_days, c.first.all_trips, c.lines),
         f"""SELECT a.service_day, count(*) AS lines, count(s.route_id) AS lines_seen, coalesce(string_agg(CASE WHEN s.route_id IS NULL THEN
             l.line || CASE WHEN l.route_type IN (0, 1) THEN ' (Tram)' ELSE ' (Bus)' END END, ', ' ORDER BY l.line || CASE WHEN l.route_type IN (0, 1) THEN ' (Tram)' ELSE ' (Bus)' END), '') AS silent
             FROM (SELECT DISTINCT v.service_day, v.schedule_version, t.route_id FROM ({_ASOF}) v JOIN trips t ON t.schedule_version = v.schedule_version) a
             JOIN lines l ON l.route_id = a.route_id AND l.schedule_version = a.schedule_version
             LEFT JOIN (SELECT DISTINCT r.day_in_feed AS service_day, t.route_id FROM reports r JOIN ({_ASOF}) v ON v.service_day = r.day_in_feed
                        JOIN trips t ON t.trip_id = r.trip_id AND t.schedule_version = v.schedule_version) s
               ON s.service_day = a.service_day AND s.route_id = a.route_id GROUP BY 1""", DAY)
register("ag28_storage_inventory", lambda c: diagnostics.storage_inventory(c.log))
_UTC = "to_timestamp(observed_at) AT TIME ZONE 'UTC'"
register("ag28_storage_rows", lambda c: diagnostics.storage_inventory(c.log).select("date", "hours", "rows"),
         f"SELECT CAST({_UTC} AS DATE) AS date, count(DISTINCT strftime({_UTC}, '%H')) AS hours, count(*) AS rows FROM changes GROUP BY 1", "date")

_VALUE = "coalesce(relationship <> 'SKIPPED', true) AND (delay_arr IS NOT NULL OR delay_dep IS NOT NULL)"


def _grain(keys: str) -> str:
    return f"""(SELECT service_day, trip_id, {keys}, true AS named, bool_or({_VALUE}) AS ever, max_by({_VALUE}, (observed_at, {_VALUE})) AS last
        FROM reports WHERE stop_id IS NOT NULL GROUP BY ALL)"""


register("ag29_loss_funnel", lambda c: diagnostics.loss_funnel(c.first.planned, c.first.reports, c.lines),
         f"""SELECT l.line, l.mode, count(*) AS planned, count(*) FILTER (WHERE q.named) AS named_by_sequence, count(*) FILTER (WHERE v.named) AS named_in_full,
             count(*) FILTER (WHERE v.ever) AS ever_value, count(*) FILTER (WHERE v.last) AS last_value, count(*) FILTER (WHERE v.last AND a.trip_id IS NULL) AS counted,
             count(*) FILTER (WHERE s.named AND v.named IS NULL) AS only_stop_fits, count(*) FILTER (WHERE q.named AND v.named IS NULL) AS only_sequence_fits,
             count(*) FILTER (WHERE q.last AND a.trip_id IS NULL) AS last_by_sequence, count(*) FILTER (WHERE s.last AND a.trip_id IS NULL) AS last_by_stop
             FROM (SELECT DISTINCT p.service_day, p.schedule_version, p.trip_id, t.route_id, p.stop_id, p.stop_sequence FROM planned p
                   JOIN trips t ON t.trip_id = p.trip_id AND t.schedule_version = p.schedule_version
                   WHERE (p.service_day, p.trip_id) IN (SELECT (service_day, trip_id) FROM reports)) p
             JOIN lines l ON l.route_id = p.route_id AND l.schedule_version = p.schedule_version
             LEFT JOIN {_grain('stop_id, stop_sequence')} v ON v.service_day = p.service_day AND v.trip_id = p.trip_id AND v.stop_id = p.stop_id AND v.stop_sequence = p.stop_sequence
             LEFT JOIN {_grain('stop_sequence')} q ON q.service_day = p.service_day AND q.trip_id = p.trip_id AND q.stop_sequence = p.stop_sequence
             LEFT JOIN {_grain('stop_id')} s ON s.service_day = p.service_day AND s.trip_id = p.trip_id AND s.stop_id = p.stop_id
             LEFT JOIN (SELECT DISTINCT service_day, trip_id FROM reports WHERE stop_id IS NULL AND relationship = 'CANCELED') a
               ON a.service_day = p.service_day AND a.trip_id = p.trip_id GROUP BY 1, 2""")
register("ag30_trip_resolution", lambda c: diagnostics.trip_resolution(c.first.seen, c.first.days, c.first.all_trips),
         """SELECT b.service_day, count(*) AS seen, count(f.trip_id) AS in_version,
            count(*) FILTER (WHERE f.trip_id IS NULL AND b.trip_id IN (SELECT trip_id FROM trips)) AS in_other_version,
            count(*) FILTER (WHERE b.trip_id NOT IN (SELECT trip_id FROM trips)) AS unknown
            FROM (SELECT DISTINCT service_day, trip_id FROM reports) b JOIN days d ON d.service_day = b.service_day
            LEFT JOIN trips f ON f.trip_id = b.trip_id AND f.schedule_version = d.schedule_version GROUP BY 1""", DAY)


def _second_daily(c: Context) -> DataFrame:
    return diagnostics.source_daily(c.fact.where(F.col("source") == "second"))


_OKN = "count(*) FILTER (WHERE state IN ('measured', 'departure_only'))"
_DAILY = f"""SELECT t.route_id, h.service_day, count(*) AS planned, {_OKN} AS assessable, count(*) FILTER (WHERE state = 'trip_cancelled') AS trip_cancelled,
    count(*) FILTER (WHERE state = 'skipped') AS skipped, count(*) FILTER (WHERE state = 'not_captured') AS not_captured
    FROM states h JOIN trips t USING (trip_id, schedule_version) GROUP BY 1, 2"""
register("ag31_source_comparison",
         lambda c: diagnostics.source_comparison(diagnostics.source_daily(c.first.states), _second_daily(c)),
         f"""SELECT a.route_id, a.planned, CAST(a.assessable AS DOUBLE) / a.planned AS assessable_share, CAST(a.assessable AS DOUBLE) / nullif(a.planned - a.not_captured, 0) AS captured_share,
             CAST(a.trip_cancelled AS DOUBLE) / a.planned AS trip_cancelled_share, CAST(a.skipped AS DOUBLE) / a.planned AS skipped_share,
             CAST(a.not_captured AS DOUBLE) / a.planned AS not_captured_share, CAST(b.assessable AS DOUBLE) / b.planned AS second_share,
             (CAST(a.assessable AS DOUBLE) / a.planned) / nullif(CAST(b.assessable AS DOUBLE) / b.planned, 0) AS ratio, a.days, a.days_delivered, a.days_missing
             FROM (SELECT route_id, CAST(sum(planned) AS BIGINT) AS planned, CAST(sum(assessable) AS BIGINT) AS assessable, CAST(sum(trip_cancelled) AS BIGINT) AS trip_cancelled,
                   CAST(sum(skipped) AS BIGINT) AS skipped, CAST(sum(not_captured) AS BIGINT) AS not_captured, count(*) AS days, count(*) FILTER (WHERE assessable > 0) AS days_delivered,
                   coalesce(string_agg(CASE WHEN assessable = 0 THEN CAST(service_day AS VARCHAR) END, ', ' ORDER BY service_day), '') AS days_missing FROM ({_DAILY}) GROUP BY 1) a
             LEFT JOIN (SELECT route_id, count(*) AS planned, {_OKN} AS assessable FROM fact_second GROUP BY 1) b ON b.route_id = a.route_id""")
register("ag31_source_daily",
         lambda c: diagnostics.source_daily(c.first.states).select("route_id", DAY, "planned", "assessable", "trip_cancelled", "skipped", "not_captured"),
         _DAILY, DAY)
register("ag32_poll_trip_summary",
         lambda c: diagnostics.poll_trip_summary(c.poll_trips.drop("poll", "entity_id")),
         """SELECT start_date, trip_id, string_agg(DISTINCT relationship, ', ' ORDER BY relationship) AS relationships, CAST(max(stops) AS INTEGER) AS max_stops,
            CAST(max(with_time) AS INTEGER) AS max_with_time, CAST(max(skipped) AS INTEGER) AS max_skipped, min(polled_at) AS first_seen, max(polled_at) AS last_seen
            FROM feed_trips GROUP BY 1, 2""")


def _line_coverage(c: Context) -> DataFrame:
    s = c.second
    first = (
        c.first.seen.join(F.broadcast(c.first.days.select(DAY, "schedule_version")), DAY)
        .join(c.first.all_trips, ["trip_id", "schedule_version"])
        .join(c.lines.select("route_id", "schedule_version", "line"), ["route_id", "schedule_version"])
        .select(DAY, tx.line_short(F.col("line"), OPERATOR_PREFIX).alias("line_short"), "trip_id")
    )
    return diagnostics.line_coverage_per_day(s.days, s.calendar, s.all_trips, s.lines, s.seen, first)


register("ag33_line_coverage_per_day", _line_coverage,
         """SELECT o.service_day, o.line_short, o.planned_trips, o.seen_trips, CAST(o.seen_trips AS DOUBLE) / greatest(o.planned_trips, 1) AS share,
            o.seen_without_plan, coalesce(f.n, 0) AS first_source_trips
            FROM (SELECT service_day, line_short, count(p) AS planned_trips, count(s) AS seen_trips, count(*) FILTER (WHERE p IS NULL) AS seen_without_plan FROM (
                    SELECT coalesce(a.service_day, b.service_day) AS service_day, coalesce(a.line_short, b.line_short) AS line_short, a.trip_id AS p, b.trip_id AS s
                    FROM (SELECT DISTINCT t.service_day, l.line AS line_short, f.trip_id FROM days2 t
                          JOIN calendar2 k ON k.schedule_version = t.schedule_version AND k.weekday = lower(dayname(t.service_day)) AND t.service_day BETWEEN k.start_date AND k.end_date
                          JOIN trips2 f ON f.schedule_version = t.schedule_version AND f.service_id = k.service_id
                          JOIN lines2 l ON l.route_id = f.route_id AND l.schedule_version = f.schedule_version) a
                    FULL JOIN (SELECT DISTINCT r.service_day, l.line AS line_short, f.trip_id FROM reports2 r JOIN days2 t ON t.service_day = r.service_day
                          JOIN trips2 f ON f.trip_id = r.trip_id AND f.schedule_version = t.schedule_version
                          JOIN lines2 l ON l.route_id = f.route_id AND l.schedule_version = f.schedule_version) b
                      ON b.service_day = a.service_day AND b.line_short = a.line_short AND b.trip_id = a.trip_id) GROUP BY 1, 2) o
            LEFT JOIN (SELECT r.service_day, regexp_replace(regexp_replace(l.line, '^Net ', ''), '^Moonliner ', 'M') AS line_short, count(DISTINCT r.trip_id) AS n
                       FROM reports r JOIN days t ON t.service_day = r.service_day JOIN trips f ON f.trip_id = r.trip_id AND f.schedule_version = t.schedule_version
                       JOIN lines l ON l.route_id = f.route_id AND l.schedule_version = f.schedule_version GROUP BY 1, 2) f
              ON f.service_day = o.service_day AND f.line_short = o.line_short""", DAY)
_FIT = """SELECT t.schedule_version, count(*) AS trips, count(r.trip_id) AS hits, CAST(count(r.trip_id) AS DOUBLE) / greatest((SELECT count(DISTINCT trip_id) FROM reports), 1) AS share
    FROM trips t LEFT JOIN (SELECT DISTINCT trip_id FROM reports) r ON r.trip_id = t.trip_id GROUP BY 1"""
register("ag34_version_fit", lambda c: versions.version_fit(c.first.reports, c.first.all_trips),
         f"""SELECT *, schedule_version = (SELECT max_by(schedule_version, (hits, schedule_version)) FROM ({_FIT})) AS is_best,
             schedule_version = (SELECT max(schedule_version) FROM trips) AS is_newest FROM ({_FIT})""", "schedule_version")
register("ag34_unknown_feed_trips", lambda c: versions.unknown_feed_trips(c.second.reports.unionByName(c.first.reports), c.first.all_trips),
         "SELECT DISTINCT trip_id FROM (SELECT trip_id FROM reports UNION ALL SELECT trip_id FROM reports2) WHERE trip_id NOT IN (SELECT trip_id FROM trips)")
register("ag35_feed_statistics", lambda c: diagnostics.feed_statistics(c.poll_trips),
         """SELECT count(*) AS trips, CAST(sum(stops) AS BIGINT) AS stop_updates, CAST(sum(with_time) AS BIGINT) AS with_time, CAST(sum(skipped) AS BIGINT) AS skipped,
            CAST(sum(stops) AS BIGINT) AS with_stop_id, count(*) FILTER (WHERE relationship = 'CANCELED') AS cancelled, CAST(sum(stops) AS DOUBLE) / count(*) AS stops_per_trip FROM feed_trips""")
register("ag35_start_hours", lambda c: diagnostics.start_hours(c.poll_trips), "SELECT start_hour, count(*) AS trips FROM feed_trips GROUP BY 1")


def _line_board(c: Context) -> DataFrame:
    """Users stand for trips; a line is the user number modulo 12."""
    routes = c.feed_rows.select("trip_id").distinct().withColumn(
        "line", F.concat(F.lit("L"), F.substring("trip_id", 2, 9).cast("int") % 12)
    )
    return diagnostics.line_board(c.feed_rows, routes)


register("ag36_line_board", _line_board,
         """SELECT 'L' || (CAST(substr(trip_id, 2) AS INT) % 12) AS line, count(*) AS trips, count(*) FILTER (WHERE c) AS cancelled,
            CAST(coalesce(trunc(CAST(sum(s) AS DOUBLE) / nullif(sum(n), 0)), 0) AS BIGINT) AS delay_mean_sec
            FROM (SELECT entity_id, trip_id, bool_or(trip_relationship = 'CANCELED') AS c,
                  sum(CASE WHEN trip_relationship <> 'CANCELED' THEN coalesce(arrival_delay, departure_delay) END) AS s,
                  count(CASE WHEN trip_relationship <> 'CANCELED' THEN coalesce(arrival_delay, departure_delay) END) AS n FROM feed GROUP BY 1, 2) GROUP BY 1""")
register("ag37_feed_scope_check", lambda c: diagnostics.feed_scope_check(c.first.services, c.first.all_trips, c.first.seen, 7, 10),
         """SELECT coalesce(a.service_day, f.service_day) AS service_day, coalesce(a.n, 0) AS active_trips, coalesce(f.n, 0) AS feed_trips, coalesce(f.m, 0) AS missing_in_list,
            coalesce(a.n, 0) < 10 AS too_few_active, coalesce(f.m, 0) > 0 AS list_incomplete
            FROM (SELECT service_day, count(DISTINCT trip_id) AS n FROM scheduled GROUP BY 1) a
            FULL JOIN (SELECT service_day, count(*) AS n, count(*) FILTER (WHERE trip_id NOT IN (SELECT trip_id FROM trips WHERE schedule_version IN
                         (SELECT DISTINCT schedule_version FROM trips ORDER BY 1 DESC LIMIT 7))) AS m
                       FROM (SELECT DISTINCT service_day, trip_id FROM reports) WHERE trip_id IN (SELECT trip_id FROM trips) GROUP BY 1) f ON f.service_day = a.service_day""", DAY)
register("ag38_schedule_statistics", lambda c: diagnostics.schedule_statistics(c.first.all_trips, c.lines, c.first.calendar),
         """SELECT r.schedule_version, r.routes, r.line_names, r.modes, t.* EXCLUDE (v), s.services, k.valid_from, k.valid_to
            FROM (SELECT schedule_version, count(DISTINCT route_id) AS routes, count(DISTINCT line) AS line_names, count(DISTINCT mode) AS modes FROM lines GROUP BY 1) r
            JOIN (SELECT t.schedule_version AS v, count(*) AS trips, count(*) FILTER (WHERE mode = 'tram') AS trips_tram, count(*) FILTER (WHERE mode = 'bus') AS trips_bus,
                  count(*) FILTER (WHERE mode = 'other') AS trips_other, count(*) FILTER (WHERE direction = 0) AS trips_direction_0, count(*) FILTER (WHERE direction = 1) AS trips_direction_1,
                  count(*) FILTER (WHERE direction IS NULL) AS trips_without_direction FROM trips t JOIN lines l ON l.route_id = t.route_id AND l.schedule_version = t.schedule_version GROUP BY 1) t ON t.v = r.schedule_version
            JOIN (SELECT schedule_version AS v, count(DISTINCT service_id) AS services FROM trips GROUP BY 1) s ON s.v = r.schedule_version
            JOIN (SELECT schedule_version AS v, min(start_date) AS valid_from, max(end_date) AS valid_to FROM calendar WHERE origin = 'calendar' GROUP BY 1) k ON k.v = r.schedule_version""",
         "schedule_version valid_from valid_to")
register("ag39_alerts_by_effect", lambda c: diagnostics.alerts_by_effect(c.snapshots),
         "SELECT event_type AS effect, count(*) AS alerts FROM ev WHERE e % 11 = 0 GROUP BY 1")
register("ag40_undated_reports", lambda c: diagnostics.undated_reports(c.first.reports),
         "SELECT count(*) AS reports, count(*) FILTER (WHERE day_in_feed IS NULL) AS undated FROM reports")

# -- windows and top-k ---------------------------------------------------------------------------------

register("wn1_last_report_per_stop", lambda c: c.first.last_reports,
         "SELECT service_day, trip_id, stop_id, stop_sequence, relationship, delay_arr, delay_dep, actual_arr, actual_dep, observed_at FROM last_reports",
         "service_day actual_arr actual_dep observed_at")
register("wn2_delay_growth", lambda c: c.delay_growth, "SELECT * FROM growth", DAY)
_GROUP = ["schedule_version", *LINE_DIR]


def _reference(c: Context) -> DataFrame:
    return ax.first_visit(c.first.runs, ax.reference_run(c.first.runs, _GROUP), _GROUP)


register("wn3_nearest_anchors",
         lambda c: ax.nearest_anchors(c.first.runs, _reference(c), _GROUP).select(*_GROUP, "run_id", "step", "station_id", "nr", "before", "after"),
         """SELECT schedule_version, route_id, direction, run_id, steps[i] AS step, way[i] AS station_id, CAST(known[i] AS INTEGER) AS nr,
            CAST(list_filter(known[1 : i], lambda x: x IS NOT NULL)[-1] AS INTEGER) AS before, CAST(list_filter(known[i : len(known)], lambda x: x IS NOT NULL)[1] AS INTEGER) AS after
            FROM (SELECT *, unnest(range(1, len(way) + 1)) AS i FROM (
              SELECT a.schedule_version, a.route_id, a.direction, run_id, list(step ORDER BY step) AS steps, list(a.station_id ORDER BY step) AS way, list(nr ORDER BY step) AS known
              FROM runs_axis a LEFT JOIN ref ON (ref.schedule_version, ref.route_id, ref.station_id) = (a.schedule_version, a.route_id, a.station_id)
                AND ref.direction IS NOT DISTINCT FROM a.direction GROUP BY ALL))""",
         "schedule_version")
register("wn4_place_between_anchors", lambda c: rounded(ax.place_between_anchors(c.first.runs, _reference(c), _GROUP), "pos"),
         f"SELECT * REPLACE ({r6('pos')}) FROM placed", "schedule_version")
register("wn5_reference_run", lambda c: ax.reference_run(c.first.runs, _GROUP), "SELECT * FROM ref_run", "schedule_version")
register("wn6_first_visit", lambda c: _reference(c), "SELECT * REPLACE (CAST(nr AS INTEGER) AS nr) FROM ref", "schedule_version")
register("wn7_stop_axis_per_version", lambda c: ax.stop_axis_per_version(c.first.runs), "SELECT * REPLACE (CAST(nr AS INTEGER) AS nr) FROM axis", "schedule_version")
register("wn7_stop_axis_second", lambda c: c.second_axis_per_version, "SELECT * REPLACE (CAST(nr AS INTEGER) AS nr) FROM axis2", "schedule_version")
register("wn8_stop_axis", lambda c: ax.stop_axis(c.first.axis_per_version, c.second_axis_per_version), "SELECT * REPLACE (CAST(position AS INTEGER) AS position) FROM stop_axis")
register("wn9_choose_version", lambda c: versions.choose_version(c.first.seen, c.first.all_trips, MIN_TRIPS), "SELECT * FROM chosen", "service_day schedule_version oldest_version")
register("wn9_choose_version_second", lambda c: c.second.chosen_versions, "SELECT * FROM chosen2", "service_day schedule_version oldest_version")
register("wn10_latest_line_master", lambda c: c.master, _MASTER, "schedule_version")
_PAIRS = """SELECT route_id, direction, a, b, count(*) AS trips FROM (SELECT route_id, direction, station_id AS a,
    lead(station_id) OVER (PARTITION BY route_id, direction, schedule_version, run_id ORDER BY step) AS b FROM runs_axis) WHERE b IS NOT NULL AND a <> b GROUP BY 1, 2, 3, 4"""
_SHOWN = """SELECT route_id, direction, station_id, stop_name, position, row_number() OVER (PARTITION BY route_id, direction ORDER BY position NULLS LAST, stop_name, station_id) AS shown
    FROM (SELECT route_id, direction, station_id, max_by(stop_name, CASE WHEN stop_name IS NOT NULL THEN service_day END) AS stop_name,
          max_by(position, CASE WHEN position IS NOT NULL THEN service_day END) AS position FROM stop_profile GROUP BY 1, 2, 3)"""
register("wn11_adjacent_pairs", lambda c: ax.adjacent_pairs(c.first.runs), _PAIRS)
register("wn12_order_violations", lambda c: ax.order_violations(c.pairs, c.shown),
         f"""SELECT p.route_id, p.direction, count(*) AS checked, count(*) FILTER (WHERE x.shown >= y.shown) AS violated FROM ({_PAIRS}) p
             JOIN ({_SHOWN}) x ON x.route_id = p.route_id AND x.direction IS NOT DISTINCT FROM p.direction AND x.station_id = p.a
             JOIN ({_SHOWN}) y ON y.route_id = p.route_id AND y.direction IS NOT DISTINCT FROM p.direction AND y.station_id = p.b GROUP BY 1, 2""")
register("wn12_duplicate_names", lambda c: ax.duplicate_names(c.shown),
         f"SELECT route_id, direction, stop_name, count(*) AS stations FROM ({_SHOWN}) GROUP BY 1, 2, 3 HAVING count(*) > 1")
register("wn12_stops_without_position", lambda c: c.shown.where(F.col("position").isNull()).select(*LINE_DIR, "station_id", "stop_name"),
         f"SELECT route_id, direction, station_id, stop_name FROM ({_SHOWN}) WHERE position IS NULL")
register("wn13_is_cyclic", lambda c: ax.is_cyclic(c.pairs),
         f"""SELECT route_id, CAST(nullif(d, -1) AS TINYINT) AS direction, g IN (SELECT g FROM reach WHERE a = b) AS cyclic FROM
             (SELECT DISTINCT route_id, d, g FROM pair_edges)""")

def _membership(c: Context) -> DataFrame:
    """The trips of the newest observed day, looked up as of every observed day."""
    newest = c.first.seen.agg(F.max(DAY)).scalar()
    base = c.first.seen.where(F.col(DAY) == newest).select("trip_id").distinct()
    return versions.rolling_version_membership(base, c.first.all_trips, versions.observed_days(c.first.reports), 7)


register("wn14_rolling_version_membership", _membership,
         """WITH base AS (SELECT DISTINCT trip_id FROM reports WHERE service_day = (SELECT max(service_day) FROM reports)),
            listed AS (SELECT list_sort(list(DISTINCT schedule_version)) AS all_versions FROM trips),
            spans AS (SELECT service_day, list_filter(all_versions, lambda v: v <= service_day)[-7:] AS span FROM (SELECT DISTINCT service_day FROM reports), listed)
            SELECT service_day, span[1] AS window_from, span[-1] AS window_to,
              (SELECT count(DISTINCT t.trip_id) FROM trips t JOIN base USING (trip_id) WHERE t.schedule_version BETWEEN span[1] AND span[-1]) AS in_window,
              (SELECT count(DISTINCT trip_id) FROM trips JOIN base USING (trip_id)) AS in_any, (SELECT count(*) FROM base) AS base_trips,
              (SELECT count(DISTINCT t.trip_id) FROM trips t JOIN base USING (trip_id) WHERE t.schedule_version BETWEEN span[1] AND span[-1])
                / nullif((SELECT count(*) FROM base), 0)::DOUBLE AS share
            FROM spans WHERE len(span) > 0""", "service_day window_from window_to")
_POLLS = "SELECT DISTINCT event_type AS source, date_trunc('minute', ts) AS polled_at FROM events"
register("wn15_poll_gaps", lambda c: diagnostics.poll_gaps(event_feed.event_polls(c.spark, c.sf_dir), 600),
         f"""SELECT * FROM (SELECT source, lag(polled_at) OVER w AS gap_from, polled_at AS gap_to, date_diff('second', lag(polled_at) OVER w, polled_at) AS gap_sec
             FROM ({_POLLS}) WINDOW w AS (PARTITION BY source ORDER BY polled_at)) WHERE gap_sec > 1800""", "gap_from gap_to")
register("wn15_poll_counts", lambda c: diagnostics.poll_counts(event_feed.event_polls(c.spark, c.sf_dir), 600),
         f"SELECT source, count(*) AS polls, date_diff('second', min(polled_at), max(polled_at)) // 600 + 1 AS expected FROM ({_POLLS}) GROUP BY 1")
register("wn16_missing_hours", lambda c: diagnostics.missing_hours(c.log),
         f"""SELECT date, CAST(n AS INTEGER) AS hours_present, missing AS hours_missing, CASE WHEN date = min(date) OVER () OR date = max(date) OVER () THEN 'edge'
             WHEN n < 24 THEN 'gap' ELSE 'complete' END AS verdict
             FROM (SELECT d.date, count(p.hour) AS n, coalesce(string_agg(CASE WHEN p.hour IS NULL THEN CAST(h.hour AS VARCHAR) END, ', ' ORDER BY h.hour), '') AS missing
                   FROM (SELECT DISTINCT CAST({_UTC} AS DATE) AS date FROM changes) d CROSS JOIN (SELECT unnest(range(24)) AS hour) h
                   LEFT JOIN (SELECT DISTINCT CAST({_UTC} AS DATE) AS date, CAST(strftime({_UTC}, '%H') AS INT) AS hour FROM changes) p
                     ON p.date = d.date AND p.hour = h.hour GROUP BY 1)""", "date")
register("wn17_last_n_days", lambda c: rollup.last_n_days(c.mart("network_profile"), ["mode"], 30).select(DAY, "mode", "planned_stops", "on_time_3min", F.col("day_rank").cast("long").alias("day_rank")),
         """SELECT service_day, mode, planned_stops, on_time_3min, dense_rank() OVER (PARTITION BY mode ORDER BY service_day DESC) AS day_rank FROM network
            QUALIFY dense_rank() OVER (PARTITION BY mode ORDER BY service_day DESC) <= 30""", DAY)


def _agree(versions_: str) -> str:
    """Stations of a line in plan order next to the same stations in shown order."""
    return f"""SELECT schedule_version, route_id, direction, station_id, CAST(rank_planned AS INTEGER) AS rank_planned, CAST(list_position(shown, station_id) AS INTEGER) AS rank_shown
        FROM (SELECT *, unnest(planned) AS station_id, generate_subscripts(planned, 1) AS rank_planned FROM (
            SELECT p.schedule_version, p.route_id, p.direction, list(p.station_id ORDER BY p.nr, p.station_id) AS planned, list(p.station_id ORDER BY s.position, p.station_id) AS shown
            FROM axis p SEMI JOIN ({versions_}) v ON v.schedule_version = p.schedule_version
            JOIN stop_axis s ON (s.route_id, s.station_id) = (p.route_id, p.station_id) AND s.direction IS NOT DISTINCT FROM p.direction GROUP BY 1, 2, 3))
        WHERE list_position(shown, station_id) <> rank_planned"""


register("wn18_rank_agreement", lambda c: ax.rank_agreement(c.stop_axis, c.first.axis_per_version), _agree("SELECT schedule_version FROM axis"), "schedule_version")


def _ranking(c: Context, sort: str) -> DataFrame:
    """The order itself as a column, since the comparison ignores row order; places are numbered in buckets of the order."""
    ranked = rollup.line_ranking(c.totals, sort)
    stops, plan = -F.col("assessable_stops"), -F.col("planned_stops")
    keys = {"stops": [stops, plan], "share_desc": [-F.col("rank_value"), stops], "share_asc": [F.col("rank_value"), stops]}[sort]
    keyed = ranked.withColumn("_key", F.struct(keys[0].alias("first"), keys[1].alias("second"), F.col("route_id").alias("id")))
    bucket = F.floor(-F.log2(1 - F.col("_key.first"))) if sort == "stops" else F.floor(F.col("_key.first") * 50)
    numbers = dense_numbers(keyed, "_key", bucket, "_number")
    return keyed.join(numbers, "_key").select("route_id", "rank_value", "assessable_stops", (F.col("_number") + 1).cast("long").alias("place"))


_RANKED = f"""SELECT route_id, CASE WHEN assessable_stops > 0 THEN CAST(on_time_3min AS DOUBLE) / assessable_stops ELSE -1 END AS rank_value, assessable_stops, planned_stops FROM ({_TOTALS})"""
for _sort, _order in (("share_desc", "rank_value DESC, assessable_stops DESC"), ("share_asc", "rank_value, assessable_stops DESC"), ("stops", "assessable_stops DESC, planned_stops DESC")):
    register(f"top1_line_ranking_{_sort}", lambda c, s=_sort: _ranking(c, s),
             f"SELECT route_id, rank_value, assessable_stops, row_number() OVER (ORDER BY {_order}, route_id) AS place FROM ({_RANKED})")
register("top2_best_version", lambda c: versions.best_version(versions.version_fit(c.first.reports, c.first.all_trips)),
         f"SELECT schedule_version, hits FROM ({_FIT}) ORDER BY hits DESC, schedule_version DESC LIMIT 1", "schedule_version")
register("top3_examples",
         lambda c: checks.examples(
             ax.pair_order(c.pairs, c.shown).where("violated"), LINE_DIR, [F.col("trips").desc(), "a", "b"], 3
         ).select(*LINE_DIR, "a", "b", "trips", F.col("rank").cast("long").alias("rank")),
         f"""SELECT * FROM (SELECT p.route_id, p.direction, p.a, p.b, p.trips, row_number() OVER (PARTITION BY p.route_id, p.direction ORDER BY p.trips DESC, p.a, p.b) AS rank
             FROM ({_PAIRS}) p JOIN ({_SHOWN}) x ON x.route_id = p.route_id AND x.direction IS NOT DISTINCT FROM p.direction AND x.station_id = p.a
             JOIN ({_SHOWN}) y ON y.route_id = p.route_id AND y.direction IS NOT DISTINCT FROM p.direction AND y.station_id = p.b WHERE x.shown >= y.shown) WHERE rank <= 3""")
