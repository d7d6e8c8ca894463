"""The layers once more in DuckDB SQL, from their descriptions: runs and axes as lists, ends and names as maps, holidays as single days.

`CTES` maps a name to its SQL; `statement` puts the needed ones in front of a query.
"""

from __future__ import annotations

import re

MIN_TRIPS = 5  # the driver's tables hold few trips per day
ONTIME = [1, 3, 6, 15, 60]

_S = """CASE WHEN k % 5 = 0 AND p = 4 THEN (k % 24 * 4 + 50) % 100
             WHEN k % 43 = 0 AND p = 2 THEN k % 24 + 300
             ELSE k % 24 * 4 + p END"""
_STATION = "'de:0' || (s % 5 + 5) || lpad(CAST(s % 40 AS VARCHAR), 3, '0') || ':' || s"
_SEC = "(k // 48 % 24 * 3600 + j * 180 + 18000)"
_TRIP = "'Special#' || (k % 31) || '-' || k || '-' || (k % 4 + 1)"
_ROUTE = "'de:net:' || lpad(CAST(k % 24 AS VARCHAR), 5, '0') || ':'"
_EPOCH = "date_diff('day', DATE '1970-01-01', day) * 86400"


def clock(sec: str) -> str:
    return (
        f"lpad(CAST({sec} // 3600 AS VARCHAR), 2, '0') || ':' || "
        f"lpad(CAST({sec} // 60 % 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST({sec} % 60 AS VARCHAR), 2, '0')"
    )


def ymd(day: str) -> str:
    return f"strftime({day}, '%Y%m%d')"


def gtfs(col: str) -> str:
    parts = [f"TRY_CAST(split_part({col}, ':', {i}) AS INTEGER)" for i in (1, 2, 3)]
    return f"{parts[0]} * 3600 + {parts[1]} * 60 + {parts[2]}"


def local(epoch: str) -> str:
    return f"timezone('Europe/Berlin', to_timestamp({epoch}))"


WEEK = ["sunday", "monday", "tuesday", "wednesday", "thursday", "friday", "saturday"]

CTES: dict[str, str] = {}

# -- raw tables ---------------------------------------------------------------------------

CTES["o"] = """SELECT o_orderkey AS k, CAST(o_orderdate AS DATE) AS day, o_orderstatus AS status FROM orders"""
CTES["stop_rows"] = """SELECT k, j, CASE WHEN k % 24 % 8 = 3 AND j = 7 THEN 8 - p ELSE p END AS p FROM (
    SELECT DISTINCT l_orderkey AS k, l_linenumber AS j,
           CASE WHEN l_orderkey // 24 % 2 = 0 THEN l_linenumber ELSE 8 - l_linenumber END AS p
    FROM lineitem)"""
CTES["stop_s"] = f"SELECT k, j, {_S} AS s FROM stop_rows"
CTES["tv"] = """SELECT k, day, main AS v FROM tv0
    UNION ALL SELECT k, day, CAST(main + INTERVAL 3 MONTH AS DATE) FROM tv0 WHERE k % 3 = 0"""
CTES["tv0"] = """SELECT k, day, CAST(CASE WHEN k % 10 = 7 THEN q - INTERVAL 3 MONTH ELSE q END AS DATE) AS main
    FROM (SELECT k, day, date_trunc('quarter', day - INTERVAL 3 DAY) AS q FROM o)"""
CTES["raw_trips"] = f"""SELECT {_TRIP} AS trip_id, {_ROUTE} AS route_id, 'S' || {ymd('day')} AS service_id,
    CASE WHEN k % 97 = 0 THEN '' ELSE CAST(k // 24 % 2 AS VARCHAR) END AS direction_id, v FROM tv"""
CTES["raw_routes"] = f"""SELECT DISTINCT {_ROUTE} AS route_id,
    'Net ' || CASE WHEN k % 24 % 8 = 7 THEN 'Moonliner ' ELSE '' END || (k % 24 % 20) AS route_short_name,
    CASE WHEN k % 24 IN (5, 11, 17) THEN 'Ruftaxi Zone ' || (k % 24)
         ELSE 'Terminal ' || (k % 24) || ' - Terminal ' || (k % 24 + 1) END AS route_long_name,
    CASE k % 24 % 3 WHEN 0 THEN 0 WHEN 1 THEN 3 ELSE 7 END AS route_type, v FROM tv"""
CTES["raw_stop_times"] = f"""SELECT {_TRIP} AS trip_id,
    {_STATION} || ':' || (j % 2 + 1) || ':' || (j % 2 + 1) AS stop_id, j AS stop_sequence,
    CASE WHEN j = 1 AND k % 2 = 0 THEN '' ELSE {clock(_SEC)} END AS arrival_time,
    CASE WHEN j = 7 THEN '' WHEN k % 401 = 0 AND j = 3 THEN 'xx:10:00' ELSE {clock(f'({_SEC} + 30)')} END AS departure_time, v
    FROM stop_s JOIN tv USING (k)"""
CTES["raw_stops"] = f"""SELECT {_STATION} || ':' || pl || ':' || pl AS stop_id,
    'Stop ' || (s % 97) || ' Bstg. ' || pl AS stop_name,
    CASE WHEN s % 17 = 0 THEN 'n/a' ELSE CASE WHEN s % 14 = 0 AND pl = 2 THEN '50.' ELSE '49.' END
         || lpad(CAST(s % 1000 AS VARCHAR), 3, '0') END AS stop_lat,
    '8.' || lpad(CAST(s % 1000 AS VARCHAR), 3, '0') AS stop_lon,
    CASE WHEN s % 7 = 0 AND pl = 1 THEN {_STATION} || '_Parent' WHEN s % 7 = 0 THEN ''
         WHEN s % 3 = 0 THEN {_STATION} ELSE '' END AS parent_station, v
    FROM (SELECT s_suppkey AS s FROM supplier WHERE s_suppkey % 13 <> 0),
         (VALUES (1), (2)) AS x(pl), (SELECT DISTINCT v FROM tv)"""
_FLAGS = ", ".join(
    f"CASE WHEN dayofweek(day) = {i} OR (dayofmonth(day) % 5 = 0 AND (dayofweek(day) + 1) % 7 = {i}) THEN '1' ELSE '0' END AS {n}"
    for i, n in enumerate(WEEK)
)
CTES["raw_calendar"] = f"""SELECT 'S' || {ymd('day')} AS service_id, {_FLAGS},
    {ymd('day')} AS start_date, {ymd('day + 6')} AS end_date, v FROM (SELECT DISTINCT day, v FROM tv)"""
CTES["raw_calendar_dates"] = f"""SELECT 'S' || {ymd('day')} AS service_id, {ymd('d')} AS date, t AS exception_type, v FROM (
    SELECT day, v, day + 2 AS d, '1' AS t FROM (SELECT DISTINCT day, v FROM tv) WHERE dayofmonth(day) % 7 = 0
    UNION ALL SELECT day, v, day, '2' FROM (SELECT DISTINCT day, v FROM tv) WHERE dayofmonth(day) % 11 = 0
    UNION ALL SELECT day, v, day, 'x' FROM (SELECT DISTINCT day, v FROM tv) WHERE dayofmonth(day) % 13 = 0)"""
CTES["report_rows"] = """SELECT l_orderkey AS k, l_linenumber AS j,
    CASE WHEN l_orderkey % 24 % 8 = 3 AND l_linenumber = 7 THEN
         8 - CASE WHEN l_orderkey // 24 % 2 = 0 THEN l_linenumber ELSE 8 - l_linenumber END
         ELSE CASE WHEN l_orderkey // 24 % 2 = 0 THEN l_linenumber ELSE 8 - l_linenumber END END AS p,
    l_partkey AS part, l_suppkey AS supp, CAST(l_quantity AS INTEGER) AS qty,
    l_returnflag AS flag, l_linestatus AS line_status FROM lineitem"""
_DAYTEXT = f"""CASE WHEN k % 50 = 0 THEN '' WHEN k % 211 = 0 THEN substr({ymd('day')}, 1, 6) ELSE {ymd('day')} END"""
_PADDED = f"CASE WHEN k % 13 = 0 THEN ' ' || {_TRIP} || ' ' ELSE {_TRIP} END"
CTES["raw_reports"] = f"""SELECT {_DAYTEXT} AS betriebstag,
    CASE WHEN part % 199 = 0 THEN ' ' ELSE {_PADDED} END AS trip_id,
    {_STATION} || ':' || pl || ':' || pl AS stop_id,
    CASE WHEN k % 59 = 0 THEN j + 1 ELSE j END AS stop_sequence,
    CASE WHEN line_status = 'O' AND part % 17 = 0 THEN 'SKIPPED' ELSE 'SCHEDULED' END AS schedule_relationship,
    CASE WHEN flag <> 'N' THEN qty * 12 - 150 END AS arrival_delay,
    {_EPOCH} + {_SEC} - 3600 + CASE WHEN flag <> 'N' THEN qty * 12 - 150 END AS arrival_time,
    CASE WHEN flag <> 'R' AND part % 5 <> 0 THEN qty * 12 - 120 END AS departure_delay,
    {_EPOCH} + {_SEC} - 3600 + CASE WHEN flag <> 'R' AND part % 5 <> 0 THEN qty * 12 - 120 END AS departure_time,
    {_EPOCH} + {_SEC} - 3600 - part % 40 * 60 AS observed_at
    FROM (SELECT *, {_S} AS s, CASE WHEN k % 61 = 0 THEN 2 - j % 2 ELSE j % 2 + 1 END AS pl
          FROM report_rows JOIN o USING (k) WHERE supp % 9 <> 0 AND k % 24 NOT IN (4, 22))
    UNION ALL
    SELECT {_DAYTEXT}, {_PADDED}, '', 0, CASE WHEN k % 10 = 0 THEN 'CANCELED' ELSE 'SCHEDULED' END,
           CAST(NULL AS INTEGER), CAST(NULL AS BIGINT), CAST(NULL AS INTEGER), CAST(NULL AS BIGINT), {_EPOCH} + 14400 + shift
    FROM (SELECT k, day, status, 0 AS shift FROM o UNION ALL SELECT k, day, status, 600 FROM o WHERE k % 20 = 0)
    WHERE k % 24 NOT IN (4, 22) AND ((k % 10 = 0 AND status = 'F') OR k % 10 = 1)"""
CTES["o2"] = """SELECT k, day, CAST(date_trunc('quarter', day) AS DATE) AS v FROM o
    WHERE k % 6 = 4 AND day >= DATE '1998-01-01'"""
CTES["second_reports"] = f"""SELECT {ymd('day')} AS betriebstag, 'x' || {_TRIP} AS trip_id,
    'x' || s || '-' || (j % 2 + 1) AS stop_id, j AS stop_sequence,
    CASE WHEN part % 23 = 0 THEN 'SKIPPED' ELSE 'SCHEDULED' END AS schedule_relationship,
    CASE WHEN flag <> 'A' THEN qty * 6 - 60 END AS arrival_delay,
    {_EPOCH} + {_SEC} - 3600 + CASE WHEN flag <> 'A' THEN qty * 6 - 60 END AS arrival_time,
    CASE WHEN part % 3 <> 0 THEN qty * 6 - 30 END AS departure_delay,
    {_EPOCH} + {_SEC} - 3600 + CASE WHEN part % 3 <> 0 THEN qty * 6 - 30 END AS departure_time,
    {_EPOCH} + {_SEC} - 3600 - part % 30 * 60 AS observed_at
    FROM (SELECT *, {_S} AS s FROM report_rows JOIN o2 USING (k) WHERE supp % 10 <> 0)"""
CTES["holidays"] = """SELECT h.state, h.name || ' ' || y AS name, make_date(y, h.m1, h.d1) AS first_day, make_date(y, h.m2, h.d2) AS last_day
    FROM (SELECT DISTINCT year(day) AS y FROM o),
    (VALUES ('BW','Summer',7,30,9,12), ('BW','Autumn',10,26,10,30), ('BW','Easter',3,30,4,3),
            ('RP','Summer',6,29,8,7), ('RP','Autumn',10,5,10,16), ('HE','Summer',6,29,8,7),
            ('HE','Autumn',10,5,10,17), ('HE','Late autumn',10,15,10,20)) AS h(state, name, m1, d1, m2, d2)
    WHERE h.state <> 'HE' OR y <= 1999"""

# -- staged tables --------------------------------------------------------------------------


def _staged(raw: str) -> str:
    return f"""SELECT trim(trip_id) AS trip_id, nullif(trim(stop_id), '') AS stop_id, stop_sequence,
    trim(schedule_relationship) AS relationship, arrival_delay AS delay_arr, departure_delay AS delay_dep,
    {local('arrival_time')} AS actual_arr, {local('departure_time')} AS actual_dep, {local('observed_at')} AS observed_at,
    CASE WHEN length(nullif(trim(betriebstag), '')) = 8 THEN CAST(strptime(trim(betriebstag), '%Y%m%d') AS DATE) END AS day_in_feed
    FROM {raw} WHERE trim(trip_id) <> ''"""


def _with_day(staged: str) -> str:
    return f"""SELECT *, coalesce(day_in_feed, CAST(observed_at - INTERVAL 4 HOUR AS DATE)) AS service_day,
    day_in_feed IS NULL AS day_estimated FROM {staged}"""


CTES["staged_reports"] = _staged("raw_reports")
CTES["reports"] = _with_day("staged_reports")
CTES["staged_reports2"] = _staged("second_reports")
CTES["reports2"] = _with_day("staged_reports2")
CTES["trips"] = """SELECT trip_id, route_id, service_id, TRY_CAST(nullif(direction_id, '') AS TINYINT) AS direction, v AS schedule_version FROM raw_trips"""
CTES["lines"] = """SELECT route_id, route_short_name AS line, route_long_name AS route_text, route_type,
    CASE route_type WHEN 0 THEN 'tram' WHEN 3 THEN 'bus' ELSE 'other' END AS mode, v AS schedule_version FROM raw_routes"""
CTES["stop_times"] = f"""SELECT trip_id, stop_id, stop_sequence, {gtfs("nullif(arrival_time, '')")} AS arr_sec,
    {gtfs("nullif(departure_time, '')")} AS dep_sec, v AS schedule_version FROM raw_stop_times"""
CTES["stops"] = """SELECT stop_id, stop_name, parent, station_source, regexp_replace(station_source, '_Parent$', '') AS station_id,
    trim(regexp_replace(stop_name, '\\s+Bstg\\.?\\s*\\S*$', '')) AS station_name, lat, lon, schedule_version
    FROM (SELECT stop_id, stop_name, nullif(parent_station, '') AS parent,
                 coalesce(nullif(parent_station, ''), nullif(array_to_string(string_split(stop_id, ':')[1:3], ':'), ''), stop_id) AS station_source,
                 TRY_CAST(nullif(stop_lat, '') AS DOUBLE) AS lat, TRY_CAST(nullif(stop_lon, '') AS DOUBLE) AS lon, v AS schedule_version
          FROM raw_stops)"""


def _calendar(raw: str) -> str:
    rows = " UNION ALL ".join(
        f"SELECT service_id, v, '{d}' AS weekday, start_date, end_date FROM {raw} WHERE {d} = '1'" for d in WEEK
    )
    return f"""SELECT service_id, v AS schedule_version, 'calendar' AS origin, weekday,
    CAST(strptime(start_date, '%Y%m%d') AS DATE) AS start_date, CAST(strptime(end_date, '%Y%m%d') AS DATE) AS end_date,
    CAST(NULL AS DATE) AS exception_date, CAST(NULL AS TINYINT) AS exception_type FROM ({rows})"""


CTES["calendar"] = _calendar("raw_calendar") + """
    UNION ALL SELECT service_id, v, 'calendar_dates', NULL, NULL, NULL,
    CAST(strptime(date, '%Y%m%d') AS DATE), TRY_CAST(exception_type AS TINYINT) FROM raw_calendar_dates"""
CTES["trips2"] = f"""SELECT 'x' || {_TRIP} AS trip_id, 'x' || (k % 24) AS route_id, 'X' || {ymd('day')} AS service_id, v AS schedule_version FROM o2"""
CTES["lines2"] = """SELECT DISTINCT 'x' || (k % 24) AS route_id, CAST(k % 24 % 20 AS VARCHAR) AS line,
    CASE k % 24 % 3 WHEN 0 THEN 'tram' WHEN 1 THEN 'bus' ELSE 'other' END AS mode, v AS schedule_version FROM o2"""
CTES["stop_times2"] = f"""SELECT 'x' || {_TRIP} AS trip_id, 'x' || s || '-' || (j % 2 + 1) AS stop_id, j AS stop_sequence,
    CAST({_SEC} AS INTEGER) AS arr_sec, CAST({_SEC} + 30 AS INTEGER) AS dep_sec, v AS schedule_version
    FROM stop_s JOIN o2 USING (k)"""
CTES["stops2"] = f"""SELECT 'x' || s || '-' || pl AS stop_id, 'Stop ' || (s % 97) AS stop_name, 'Stop ' || (s % 97) AS station_name,
    CASE WHEN s % 4 <> 0 THEN {_STATION} ELSE 'x' || s || '-' || pl END AS station_id, v AS schedule_version
    FROM (SELECT s_suppkey AS s FROM supplier), (VALUES (1), (2)) AS x(pl), (SELECT DISTINCT v FROM o2)"""
CTES["calendar2"] = f"""SELECT 'X' || {ymd('day')} AS service_id, v AS schedule_version, 'calendar' AS origin,
    lower(dayname(day)) AS weekday, day AS start_date, CAST(day + len AS DATE) AS end_date,
    CAST(NULL AS DATE) AS exception_date, CAST(NULL AS TINYINT) AS exception_type
    FROM (SELECT DISTINCT day, v, 6 AS len FROM o2 UNION ALL SELECT DISTINCT day, v, 2 FROM o2 WHERE dayofmonth(day) % 6 = 0)"""
CTES["on_demand"] = "SELECT DISTINCT route_id FROM lines WHERE route_id IN ('de:net:00005:', 'de:net:00017:')"
CTES["takeover"] = """SELECT DISTINCT route_id, regexp_replace(line, '^Net ', '') AS line_number, mode FROM lines
    WHERE route_id IN ('de:net:00004:', 'de:net:00010:', 'de:net:00016:')"""
CTES["trips2b"] = """SELECT t.trip_id, t.service_id, t.schedule_version, s.route_id FROM trips2 t
    JOIN lines2 l ON l.route_id = t.route_id AND l.schedule_version = t.schedule_version
    JOIN takeover s ON s.line_number = l.line AND s.mode = l.mode"""

# -- versions, frame, states, for each source -------------------------------------------------


def _add_source(x: str, trips: str) -> None:
    """x: suffix of the source's tables; trips: the trips that build its frame."""
    CTES[f"candidates{x}"] = f"""SELECT d.service_day, v.schedule_version FROM (SELECT DISTINCT service_day FROM reports{x}) d
        JOIN (SELECT DISTINCT schedule_version FROM trips{x}) v ON v.schedule_version <= d.service_day"""
    CTES[f"scores{x}"] = f"""SELECT c.service_day, c.schedule_version, count(*) AS observed, count(f.trip_id) AS resolved
        FROM candidates{x} c JOIN (SELECT DISTINCT service_day, trip_id FROM reports{x}) b ON b.service_day = c.service_day
        LEFT JOIN trips{x} f ON f.trip_id = b.trip_id AND f.schedule_version = c.schedule_version
        GROUP BY 1, 2 HAVING count(*) >= {MIN_TRIPS}"""
    CTES[f"chosen{x}"] = f"""WITH best AS (SELECT service_day, max({{'hits': resolved, 'version': schedule_version, 'trips': observed}}) AS b FROM scores{x} GROUP BY 1),
        newest AS (SELECT service_day, max(schedule_version) AS version FROM candidates{x} GROUP BY 1)
        SELECT service_day, coalesce(b.version, newest.version) AS schedule_version, (SELECT min(schedule_version) FROM trips{x}) AS oldest_version,
        round(b.hits::DOUBLE / b.trips, 4) AS resolved_share, b IS NOT NULL AS version_measured
        FROM (SELECT DISTINCT service_day FROM reports{x}) LEFT JOIN best USING (service_day) LEFT JOIN newest USING (service_day)"""
    CTES[f"days{x}"] = f"""SELECT service_day, coalesce(schedule_version, oldest_version) AS schedule_version,
        schedule_version IS NULL AS version_substituted FROM chosen{x}"""
    CTES[f"regular{x}"] = f"""SELECT t.*, c.service_id FROM days{x} t JOIN calendar{x} c ON c.schedule_version = t.schedule_version
        AND c.origin = 'calendar' AND c.weekday = lower(dayname(t.service_day)) AND t.service_day BETWEEN c.start_date AND c.end_date"""
    for kind, name in ((1, "added"), (2, "removed")):
        CTES[f"{name}{x}"] = f"""SELECT t.*, c.service_id FROM days{x} t JOIN calendar{x} c ON c.schedule_version = t.schedule_version
            AND c.origin = 'calendar_dates' AND c.exception_date = t.service_day AND c.exception_type = {kind}"""
    CTES[f"services{x}"] = f"""(SELECT * FROM regular{x} UNION SELECT * FROM added{x}) EXCEPT SELECT * FROM removed{x}"""
    CTES[f"scheduled{x}"] = f"""SELECT DISTINCT a.service_day, a.schedule_version, a.version_substituted, f.trip_id FROM services{x} a
        JOIN {trips} f ON f.schedule_version = a.schedule_version AND f.service_id = a.service_id"""
    seen = f"SELECT DISTINCT service_day, trip_id FROM reports{x}"
    if trips != f"trips{x}":
        seen += f" WHERE trip_id IN (SELECT trip_id FROM {trips})"
    CTES[f"trips_of_day{x}"] = f"""SELECT * FROM scheduled{x} UNION SELECT b.service_day, t.schedule_version, t.version_substituted, b.trip_id
        FROM ({seen}) b JOIN days{x} t ON t.service_day = b.service_day"""
    CTES[f"planned{x}"] = f"""SELECT s.*, h.stop_id, h.stop_sequence,
        CAST(s.service_day AS TIMESTAMP) + to_seconds(h.arr_sec) AS planned_arr,
        CAST(s.service_day AS TIMESTAMP) + to_seconds(h.dep_sec) AS planned_dep
        FROM trips_of_day{x} s JOIN stop_times{x} h ON h.trip_id = s.trip_id AND h.schedule_version = s.schedule_version"""
    CTES[f"last_reports{x}"] = f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY service_day, trip_id, stop_id, stop_sequence
        ORDER BY observed_at DESC, relationship DESC, delay_arr DESC NULLS LAST, delay_dep DESC NULLS LAST) AS rn
        FROM reports{x} WHERE stop_id IS NOT NULL) WHERE rn = 1"""
    CTES[f"cancelled{x}"] = f"""SELECT day_in_feed, trip_id, bool_or(relationship = 'CANCELED') AS cancelled FROM reports{x}
        WHERE stop_id IS NULL GROUP BY 1, 2"""
    CTES[f"frame{x}"] = f"""SELECT s.service_day, s.schedule_version, s.version_substituted, s.trip_id, s.stop_id, s.stop_sequence,
        s.planned_arr, s.planned_dep,
        CAST(floor(date_diff('second', CAST(s.service_day AS TIMESTAMP), coalesce(s.planned_dep, s.planned_arr)) / 3600.0) AS INTEGER) AS service_hour,
        i.actual_arr, i.actual_dep, i.delay_arr, i.delay_dep, i.relationship AS stop_relationship,
        CASE WHEN EXISTS (SELECT 1 FROM cancelled{x} f WHERE f.cancelled AND f.trip_id = s.trip_id AND f.day_in_feed = s.service_day)
               OR EXISTS (SELECT 1 FROM cancelled{x} f WHERE f.cancelled AND f.trip_id = s.trip_id AND f.day_in_feed IS NULL)
             THEN 'CANCELED' END AS trip_relationship, i.observed_at
        FROM planned{x} s LEFT JOIN last_reports{x} i ON i.service_day = s.service_day AND i.trip_id = s.trip_id
         AND i.stop_id = s.stop_id AND i.stop_sequence = s.stop_sequence"""
    CTES[f"collected{x}"] = f"""SELECT date_trunc('hour', observed_at) AS hour_start, count(*) AS reports FROM reports{x}
        WHERE observed_at IS NOT NULL GROUP BY 1"""
    CTES[f"gaps{x}"] = f"""SELECT e.service_day, e.service_hour, coalesce(c.reports, 0) AS reports, coalesce(c.reports, 0) > 0 AS captured
        FROM (SELECT DISTINCT service_day, service_hour FROM frame{x} WHERE service_hour IS NOT NULL) e
        LEFT JOIN collected{x} c ON c.hour_start = CAST(e.service_day AS TIMESTAMP) + e.service_hour * INTERVAL 1 HOUR"""
    CTES[f"states{x}"] = f"""SELECT f.*, CASE WHEN f.trip_relationship = 'CANCELED' THEN 'trip_cancelled'
        WHEN f.stop_relationship = 'SKIPPED' THEN 'skipped' WHEN f.delay_arr IS NOT NULL THEN 'measured'
        WHEN f.delay_dep IS NOT NULL THEN 'departure_only' WHEN NOT coalesce(g.captured, true) THEN 'not_captured'
        ELSE 'unreported' END AS state
        FROM frame{x} f LEFT JOIN gaps{x} g ON g.service_day = f.service_day AND g.service_hour = f.service_hour"""


_add_source("", "trips")
_add_source("2", "trips2b")

CTES["reported_stops"] = """SELECT DISTINCT service_day, trip_id, stop_id, stop_sequence FROM reports WHERE stop_id IS NOT NULL"""
CTES["unmatched"] = """SELECT service_day, schedule_version, len(list_distinct(trip_list)) AS observed_trips,
    len(list_distinct(list_filter(trip_list, lambda t, i: NOT listed[i]))) AS unmatched_trips, len(trip_list) AS observed_stops,
    len(list_filter(listed, lambda x: NOT x)) AS unmatched_stops
    FROM (SELECT service_day, d.schedule_version, list(trip_id) AS trip_list, list((trip_id, d.schedule_version) IN (SELECT (trip_id, schedule_version) FROM trips)) AS listed
          FROM reported_stops JOIN days d USING (service_day) GROUP BY service_day, d.schedule_version)"""

# -- directions -------------------------------------------------------------------------------

CTES["trip_ways"] = """SELECT trip_id, schedule_version, list(coalesce(h.station_name, h.stop_name, t.stop_id) ORDER BY stop_sequence) AS called,
    list(h.station_id ORDER BY stop_sequence) AS way FROM stop_times t LEFT JOIN stops h USING (stop_id, schedule_version) GROUP BY 1, 2"""
CTES["shapes"] = """SELECT route_id, direction, trip_id, schedule_version, len(way) AS stops, called[-1] AS last_stop, way[1] AS first_station, way[-1] AS last_station,
    called[greatest(2, CAST(len(way) * 0.25 AS INT))] AS quarter_stop FROM trip_ways JOIN trips USING (trip_id, schedule_version)"""
_FIRST_BY_COUNT = "list_sort(list_transform(map_entries({0}), lambda e: {{'less': -e.value::BIGINT, 'stop': e.key}}))[1]"
CTES["line_ends"] = f"""SELECT route_id, direction, trips, loops, {_FIRST_BY_COUNT.format("ends")} AS top, {_FIRST_BY_COUNT.format("quarters")} AS quarter
    FROM (SELECT route_id, direction, count(*) AS trips, count(*) FILTER (WHERE a = z) AS loops, histogram(last_stop) AS ends, histogram(quarter_stop) AS quarters
          FROM (SELECT route_id, direction, trip_id, max(first_station) AS a, max(last_station) AS z, max(last_stop) AS last_stop, max(quarter_stop) AS quarter_stop
                FROM shapes GROUP BY ALL) GROUP BY route_id, direction)"""
CTES["names"] = """WITH told AS (SELECT route_id, list(top.stop) FILTER (WHERE top IS NOT NULL) AS tops FROM line_ends GROUP BY route_id),
    ruled AS (SELECT *, quarter IS NOT NULL AND len(tops) > len(list_distinct(tops)) AS by_quarter FROM line_ends JOIN told USING (route_id))
    SELECT route_id, direction, if(by_quarter, 'via ' || quarter.stop, top.stop) AS direction_name, if(by_quarter, 'via', 'last_stop') AS name_rule,
    -top.less AS trips_to_it, trips, round(1 - (-top.less)::DOUBLE / trips, 4) AS short_run_share, round(loops::DOUBLE / trips, 4) AS loop_share FROM ruled"""
CTES["partials"] = """SELECT f.schedule_version, f.route_id, h.station_id, sum(CAST(s.stop_sequence AS DOUBLE) / g.last_seq) AS position_sum,
    count(*) AS position_n FROM trips f JOIN stop_times s USING (trip_id, schedule_version)
    JOIN (SELECT trip_id, schedule_version, max(stop_sequence) AS last_seq FROM stop_times GROUP BY 1, 2) g USING (trip_id, schedule_version)
    JOIN stops h ON h.stop_id = s.stop_id AND h.schedule_version = s.schedule_version WHERE f.direction = 0 GROUP BY 1, 2, 3"""
CTES["pos_mean"] = "SELECT route_id, station_id, sum(position_sum) / sum(position_n) AS position FROM partials GROUP BY 1, 2"
CTES["station_maps"] = "SELECT schedule_version, map_from_entries(list((stop_id, station_id))) AS station FROM stops GROUP BY 1"
CTES["pairs"] = """SELECT DISTINCT schedule_version, route_id, direction, station[stop_list[1]] AS first_station, station[stop_list[-1]] AS last_station
    FROM (SELECT trip_id, schedule_version, list(stop_id ORDER BY stop_sequence) AS stop_list FROM stop_times GROUP BY 1, 2)
    JOIN trips USING (trip_id, schedule_version) JOIN station_maps USING (schedule_version)
    WHERE station[stop_list[1]] IS NOT NULL AND station[stop_list[-1]] IS NOT NULL"""
CTES["runs2"] = """SELECT f.route_id, f.trip_id, f.schedule_version, h.station_id, s.stop_sequence, g.first_seq, g.last_seq,
    CAST(s.stop_sequence AS DOUBLE) / g.last_seq AS position
    FROM trips2b f JOIN stop_times2 s USING (trip_id, schedule_version)
    JOIN (SELECT trip_id, schedule_version, min(stop_sequence) AS first_seq, max(stop_sequence) AS last_seq FROM stop_times2 GROUP BY 1, 2) g
      USING (trip_id, schedule_version)
    JOIN stops2 h ON h.stop_id = s.stop_id AND h.schedule_version = s.schedule_version"""
CTES["corr2"] = """SELECT o.route_id, o.trip_id, o.schedule_version, count(*) AS common_stops, corr(o.position, v.position) AS r
    FROM runs2 o JOIN pos_mean v ON v.route_id = o.route_id AND v.station_id = o.station_id GROUP BY 1, 2, 3"""
CTES["end_votes"] = """SELECT route_id, first_station, last_station, list_distinct(list(direction)) AS votes FROM pairs
    GROUP BY GROUPING SETS ((route_id, first_station, last_station), (route_id, last_station))"""
CTES["crosscheck2"] = """WITH told AS (SELECT map_from_entries(list(((route_id, first_station, last_station), votes[1]))) AS vote FROM end_votes WHERE len(votes) = 1),
    run_ends AS (SELECT route_id, trip_id, schedule_version, any_value(station_id) FILTER (WHERE stop_sequence = first_seq) AS a,
                 any_value(station_id) FILTER (WHERE stop_sequence = last_seq) AS z FROM runs2 GROUP BY ALL)
    SELECT route_id, trip_id, schedule_version,
      coalesce(CASE WHEN a IS NOT NULL THEN vote[(route_id, a, z)] END, vote[(route_id, CAST(NULL AS VARCHAR), z)]) AS direction_by_ends FROM run_ends, told"""
CTES["inferred"] = """SELECT k.route_id, k.trip_id, k.schedule_version, k.common_stops, round(k.r, 4) AS correlation,
    CAST(CASE WHEN k.r > 0 THEN 0 ELSE 1 END AS TINYINT) AS direction, c.direction_by_ends
    FROM corr2 k JOIN crosscheck2 c USING (route_id, trip_id, schedule_version)
    WHERE k.common_stops >= 2 AND k.r IS NOT NULL AND NOT isnan(k.r)"""

# -- fact -----------------------------------------------------------------------------------

CTES["taken"] = """SELECT DISTINCT h.service_day, r.route_id FROM states2 h JOIN inferred r USING (trip_id, schedule_version)"""
CTES["shown"] = """SELECT t.service_day, coalesce(s.schedule_version,
        (SELECT max(schedule_version) FROM trips f WHERE f.schedule_version <= t.service_day),
        (SELECT min(schedule_version) FROM trips)) AS schedule_version
    FROM days2 t LEFT JOIN chosen s ON s.service_day = t.service_day"""
_FACT = "h.planned_arr, h.planned_dep, h.actual_arr, h.actual_dep, h.delay_arr, h.delay_dep, h.state"
CTES["fact_first"] = f"""SELECT h.service_day, f.route_id, f.direction, h.trip_id, h.stop_sequence, h.stop_id,
    coalesce(s.station_id, h.stop_id) AS station_id, coalesce(s.station_name, s.stop_name, h.stop_id) AS stop_name, {_FACT},
    h.schedule_version, h.schedule_version AS source_version, h.service_hour, h.observed_at, 'first' AS source
    FROM states h JOIN trips f USING (trip_id, schedule_version)
    LEFT JOIN stops s ON s.stop_id = h.stop_id AND s.schedule_version = h.schedule_version
    WHERE NOT EXISTS (SELECT 1 FROM taken u WHERE u.service_day = h.service_day AND u.route_id = f.route_id)"""
CTES["fact_second"] = f"""SELECT h.service_day, r.route_id, r.direction, h.trip_id, h.stop_sequence, h.stop_id,
    coalesce(vs.station_id, oh.station_id, h.stop_id) AS station_id, coalesce(vs.station_name, oh.station_name, h.stop_id) AS stop_name, {_FACT},
    vv.schedule_version, h.schedule_version AS source_version, h.service_hour, h.observed_at, 'second' AS source
    FROM states2 h JOIN inferred r USING (trip_id, schedule_version)
    LEFT JOIN stops2 oh ON oh.stop_id = h.stop_id AND oh.schedule_version = h.schedule_version
    JOIN shown vv ON vv.service_day = h.service_day
    LEFT JOIN (SELECT station_id, schedule_version, min(station_name) AS station_name FROM stops GROUP BY 1, 2) vs
      ON vs.station_id = oh.station_id AND vs.schedule_version = vv.schedule_version"""
CTES["fact"] = "SELECT * FROM fact_first UNION ALL SELECT * FROM fact_second"

# -- the second source as a candidate ------------------------------------------------------

CTES["offered2"] = """SELECT DISTINCT service_day, line, mode, trip_id FROM chosen2 JOIN calendar2 USING (schedule_version) JOIN trips2 USING (schedule_version, service_id)
    JOIN lines2 USING (schedule_version, route_id) WHERE weekday = lower(dayname(service_day)) AND service_day >= start_date AND service_day <= end_date"""
CTES["told2"] = """SELECT DISTINCT service_day, line, mode, reports2.trip_id FROM reports2 JOIN chosen2 USING (service_day)
    JOIN trips2 ON (trips2.trip_id, trips2.schedule_version) = (reports2.trip_id, chosen2.schedule_version)
    JOIN lines2 ON (lines2.route_id, lines2.schedule_version) = (trips2.route_id, trips2.schedule_version)"""
CTES["offer"] = """SELECT line, mode, count(*) AS planned_trips, count(DISTINCT service_day) AS days,
      (SELECT count(*) FROM told2 SEMI JOIN offered2 o USING (service_day, line, mode) WHERE told2.line = p.line AND told2.mode = p.mode) AS seen_trips
    FROM offered2 p GROUP BY line, mode"""
CTES["first_lines"] = f"""SELECT route_id, line, mode, count(*) AS first_planned_stops, count(*) FILTER (WHERE state IN ('measured', 'departure_only')) AS first_assessable_stops,
    count(DISTINCT service_day) AS first_days FROM states JOIN trips USING (trip_id, schedule_version) JOIN lines USING (route_id, schedule_version) GROUP BY ALL"""

# -- axis -----------------------------------------------------------------------------------


def place(runs: str, reference: str, group: list[str]) -> str:
    """Known stations keep their number. Each run is a list of stations next to a list of their numbers; a station without number
    lies between the last number before it and the first one after it, and shares that gap with the others of the run that do."""
    g = ", ".join(group)
    on = " AND ".join(f"r.{c} IS NOT DISTINCT FROM l.{c}" for c in group)
    lg = ", ".join(f"l.{c}" for c in group)
    listed = f"""SELECT {lg}, l.run_id, list(l.station_id ORDER BY l.step) AS way, list(r.nr ORDER BY l.step) AS known
        FROM {runs} l LEFT JOIN {reference} r ON {on} AND r.station_id = l.station_id GROUP BY ALL"""
    fenced = f"""SELECT *, list_transform(range(1, len(way) + 1), lambda i: CASE WHEN known[i] IS NULL THEN
        [list_filter(known[1 : i], lambda x: x IS NOT NULL)[-1], list_filter(known[i : len(known)], lambda x: x IS NOT NULL)[1]] END) AS gaps FROM ({listed})"""
    single = f"SELECT {g}, way, gaps, unnest(range(1, len(way) + 1)) AS i FROM ({fenced})"
    counted = f"""SELECT {g}, way[i] AS station_id, gaps[i][1] AS low, gaps[i][2] AS high, len(list_filter(gaps[1 : i], lambda x: x = gaps[i])) AS k,
        len(list_filter(gaps, lambda x: x = gaps[i])) + 1 AS parts FROM ({single}) WHERE gaps[i] IS NOT NULL"""
    between = "coalesce(low + (k * (high - low))::DOUBLE / parts, low + k::DOUBLE / parts, high - (parts - k)::DOUBLE / parts)"
    return f"""SELECT {g}, station_id, nr::DOUBLE AS pos FROM {reference}
        UNION ALL SELECT {g}, station_id, median({between}) FROM ({counted}) GROUP BY ALL HAVING median({between}) IS NOT NULL"""


def numbered(lists: str, group: list[str], name: str) -> str:
    """Stations of a list with the place of their first visit."""
    g = ", ".join(group)
    return f"SELECT {g}, station_id, min(place) AS {name} FROM (SELECT {g}, unnest(way) AS station_id, generate_subscripts(way, 1) AS place FROM ({lists})) GROUP BY ALL"


def ordered(placed: str, group: list[str], name: str) -> str:
    """Stations that have a position, numbered along the line."""
    g = ", ".join(group)
    return numbered(f"SELECT {g}, list(station_id ORDER BY pos, station_id) AS way FROM {placed} WHERE pos IS NOT NULL GROUP BY ALL", group, name)


def _add_axis(x: str, runs_sql: str) -> None:
    group = ["schedule_version", "route_id", "direction"]
    CTES[f"runs_axis{x}"] = runs_sql
    CTES[f"ways{x}"] = f"SELECT schedule_version, route_id, direction, run_id, list(station_id ORDER BY step) AS way FROM runs_axis{x} GROUP BY ALL"
    CTES[f"ref_run{x}"] = f"SELECT schedule_version, route_id, direction, arg_min(run_id, (-len(way), run_id)) AS run_id, max(len(way)) AS stops FROM ways{x} GROUP BY ALL"
    longest = f"SELECT schedule_version, route_id, direction, arg_min(way, (-len(way), run_id)) AS way FROM ways{x} GROUP BY ALL"
    CTES[f"ref{x}"] = numbered(longest, group, "nr")
    CTES[f"placed{x}"] = place(f"runs_axis{x}", f"ref{x}", group)
    CTES[f"axis{x}"] = ordered(f"placed{x}", group, "nr")


_add_axis(
    "",
    """SELECT f.schedule_version, f.route_id, f.direction, s.trip_id AS run_id, s.stop_sequence AS step, h.station_id
    FROM stop_times s JOIN stops h ON h.stop_id = s.stop_id AND h.schedule_version = s.schedule_version
    JOIN trips f ON f.trip_id = s.trip_id AND f.schedule_version = s.schedule_version""",
)
_add_axis(
    "2",
    """SELECT f.schedule_version, f.route_id, f.direction, s.trip_id AS run_id, s.stop_sequence AS step, h.station_id
    FROM stop_times2 s JOIN stops2 h ON h.stop_id = s.stop_id AND h.schedule_version = s.schedule_version
    JOIN inferred f ON f.trip_id = s.trip_id AND f.schedule_version = s.schedule_version""",
)
CTES["axis_sources"] = """SELECT 'first' AS source, * FROM axis UNION ALL SELECT 'second', * FROM axis2"""
CTES["newest_ways"] = """SELECT route_id, direction, arg_min(way, (source, -epoch(schedule_version))) AS way FROM (
    SELECT source, schedule_version, route_id, direction, list(station_id ORDER BY nr) AS way FROM axis_sources GROUP BY ALL) GROUP BY ALL"""
CTES["ref_all"] = numbered("SELECT * FROM newest_ways", ["route_id", "direction"], "nr")
CTES["runs_all"] = """SELECT route_id, direction, source || ' ' || CAST(schedule_version AS VARCHAR) AS run_id, nr AS step, station_id FROM axis_sources"""
CTES["placed_all"] = place("runs_all", "ref_all", ["route_id", "direction"])
CTES["stop_axis"] = ordered("placed_all", ["route_id", "direction"], "position")

# -- marts ----------------------------------------------------------------------------------

OK = "state IN ('measured', 'departure_only')"


def state_counts(*names: str) -> str:
    return ", ".join(
        f"count(*) FILTER (WHERE state = '{n}') AS stops_{n}" for n in names
    )


COUNTS = f"count(*) AS planned_stops, count(*) FILTER (WHERE {OK}) AS assessable_stops"
MEAN = f"avg(delay_arr) FILTER (WHERE {OK}) AS delay_mean_sec"
MEDIAN = f"median(delay_arr) FILTER (WHERE {OK}) AS delay_median_sec"


def on_time(*minutes: int) -> str:
    return ", ".join(
        f"count(*) FILTER (WHERE {OK} AND coalesce(delay_arr, delay_dep) < {m * 60}) AS on_time_{m}min" for m in minutes
    )


CTES["line_profile"] = f"""SELECT service_day, route_id, direction, line, route_text, mode, direction_name, name_rule,
    route_id IN (SELECT route_id FROM on_demand) AS on_demand, max(source) AS source, {COUNTS}, len(list_distinct(list(trip_id))) AS trips,
    {state_counts('trip_cancelled', 'skipped', 'unreported', 'not_captured')}, {MEAN}, {MEDIAN}, {on_time(*ONTIME)}
    FROM fact JOIN (SELECT route_id, schedule_version, line, route_text, mode FROM lines) USING (route_id, schedule_version)
    LEFT JOIN (SELECT route_id, direction, direction_name, name_rule FROM names) USING (route_id, direction) GROUP BY ALL"""
CTES["hour_profile"] = f"""SELECT service_day, route_id, direction, service_hour, {COUNTS}, {state_counts('trip_cancelled', 'skipped')},
    {MEAN}, {on_time(*ONTIME)} FROM fact WHERE service_hour IS NOT NULL GROUP BY 1, 2, 3, 4"""
CTES["growth"] = """SELECT service_day, route_id, direction, trip_id, stop_sequence, station_id, stop_name, delay_arr,
    lag(delay_arr) OVER w AS delay_before, delay_arr - lag(delay_arr) OVER w AS growth_sec FROM fact WHERE delay_arr IS NOT NULL
    WINDOW w AS (PARTITION BY service_day, trip_id ORDER BY stop_sequence, stop_id)"""
CTES["growths"] = """SELECT service_day, route_id, direction, station_id, list(growth_sec) AS grown FROM growth WHERE growth_sec IS NOT NULL GROUP BY ALL"""
CTES["stop_profile"] = f"""WITH known AS (SELECT map_from_entries(list(((route_id, direction, station_id), position))) AS place FROM stop_axis),
    seen AS (SELECT service_day, route_id, direction, station_id, min(stop_name) AS stop_name, {COUNTS}, {state_counts('skipped', 'trip_cancelled')}, {MEAN}, {MEDIAN}, {on_time(3)}
             FROM fact GROUP BY ALL)
    SELECT seen.*, list_avg(grown) AS growth_mean_sec, list_median(grown) AS growth_median_sec, len(grown) AS growth_cases,
    place[(route_id, direction, station_id)]::INTEGER AS position FROM seen LEFT JOIN growths USING (service_day, route_id, direction, station_id), known"""
CTES["cancellations"] = """SELECT service_day, route_id, direction, count(*) AS trips, count(*) FILTER (WHERE c) AS trips_cancelled,
    CAST(sum(skipped) AS BIGINT) AS stops_skipped, CAST(sum(planned) AS BIGINT) AS planned_stops,
    count(*) FILTER (WHERE NOT c AND unusable = planned) AS trips_without_report
    FROM (SELECT service_day, route_id, direction, trip_id, bool_or(state = 'trip_cancelled') AS c, count(*) FILTER (WHERE state = 'skipped') AS skipped,
          count(*) AS planned, count(*) FILTER (WHERE state IN ('unreported', 'not_captured')) AS unusable FROM fact GROUP BY 1, 2, 3, 4) GROUP BY 1, 2, 3"""
CTES["network"] = f"""SELECT service_day, mode, count(DISTINCT route_id) AS lines, count(DISTINCT trip_id) AS trips, {COUNTS},
    {state_counts('trip_cancelled', 'skipped')}, {MEAN}, {MEDIAN}, {on_time(*ONTIME)}
    FROM (SELECT b.*, l.mode FROM fact b JOIN lines l ON l.route_id = b.route_id AND l.schedule_version = b.schedule_version
          WHERE b.route_id NOT IN (SELECT route_id FROM on_demand)) GROUP BY 1, 2"""
CTES["history"] = """SELECT e.service_day, e.trip_id, e.stop_id, e.delay_final, e.observed_final, e.reports,
    max_by(b.delay_arr, (b.observed_at, b.delay_arr)) AS forecast_15min,
    abs(e.delay_final - max_by(b.delay_arr, (b.observed_at, b.delay_arr))) AS change_sec
    FROM (SELECT service_day, trip_id, stop_id, max_by(delay_arr, (observed_at, delay_arr)) AS delay_final, max(observed_at) AS observed_final,
                 count(*) AS reports FROM reports WHERE delay_arr IS NOT NULL AND stop_id IS NOT NULL GROUP BY 1, 2, 3) e
    JOIN reports b ON b.service_day = e.service_day AND b.trip_id = e.trip_id AND b.stop_id = e.stop_id AND b.delay_arr IS NOT NULL
     AND b.observed_at <= e.observed_final - INTERVAL 15 MINUTE GROUP BY 1, 2, 3, 4, 5, 6"""
CTES["forecast"] = """SELECT b.service_day, l.mode, count(*) AS cases, median(change_sec) AS change_median_sec, avg(change_sec) AS change_mean_sec,
    count(*) FILTER (WHERE change_sec < 60) AS change_below_1min, count(*) FILTER (WHERE change_sec < 180) AS change_below_3min
    FROM history b JOIN chosen v ON v.service_day = b.service_day
    JOIN trips f ON f.trip_id = b.trip_id AND f.schedule_version = v.schedule_version
    JOIN lines l ON l.route_id = f.route_id AND l.schedule_version = f.schedule_version GROUP BY 1, 2"""
CTES["hours"] = "SELECT service_day, list(captured) AS caught FROM gaps GROUP BY 1"
CTES["quality"] = f"""WITH per_day AS (SELECT service_day, {COUNTS}, {state_counts('unreported', 'not_captured')}, count(DISTINCT trip_id) AS trips,
      count(DISTINCT route_id) AS lines, min(observed_at) AS first_report, max(observed_at) AS last_report, count(DISTINCT schedule_version) AS versions FROM fact GROUP BY 1),
    lost AS (SELECT service_day, len(list_filter(caught, lambda c: c)) AS captured_hours, len(list_filter(caught, lambda c: NOT c)) AS missing_hours FROM hours)
    SELECT per_day.*, ifnull(captured_hours, 0) AS captured_hours, ifnull(missing_hours, 0) AS missing_hours, round(assessable_stops / planned_stops::DOUBLE, 4) AS coverage,
    ifnull(missing_hours, 0) = 0 AS complete, ifnull(observed_trips, 0) AS observed_trips, ifnull(unmatched_trips, 0) AS unmatched_trips, ifnull(unmatched_stops, 0) AS unmatched_stops
    FROM per_day LEFT JOIN lost USING (service_day) LEFT JOIN (SELECT * EXCLUDE (schedule_version, observed_stops) FROM unmatched) USING (service_day)"""
CTES["holiday_days"] = """SELECT state, CAST(unnest(generate_series(first_day, last_day, INTERVAL 1 DAY)) AS DATE) AS service_day, name FROM holidays"""
CTES["listed_states"] = "SELECT state, max(last_day) AS listed_until FROM holidays GROUP BY 1"
CTES["day_state"] = """WITH free AS (SELECT state, service_day, min(name) AS holiday_name FROM holiday_days GROUP BY ALL),
    wanted AS (SELECT service_day, unnest((SELECT list(s) FROM listed_states s), recursive := true) FROM (SELECT DISTINCT service_day FROM fact))
    SELECT service_day, state, listed_until, holiday_name IS NOT NULL AS in_holiday, holiday_name FROM wanted LEFT JOIN free USING (state, service_day)"""
CTES["school"] = """WITH told AS (SELECT service_day, map_from_entries(list((state, in_holiday))) AS free, map_from_entries(list((state, holiday_name))) AS named
      FROM day_state WHERE service_day <= listed_until GROUP BY 1),
    flags AS (SELECT service_day, free['BW'] AS holiday_bw, free['RP'] AS holiday_rp, free['HE'] AS holiday_he, named['BW'] AS holiday_name
      FROM (SELECT DISTINCT service_day FROM day_state) LEFT JOIN told USING (service_day))
    SELECT *, CASE [holiday_bw, holiday_rp, holiday_he]::INT[] WHEN [1, 1, 1] THEN 'all' WHEN [0, 0, 0] THEN 'none'
      ELSE if(holiday_bw IS NULL OR holiday_rp IS NULL OR holiday_he IS NULL, NULL, 'partly') END AS situation FROM flags"""


def statement(body: str, dates: tuple[str, ...] = (), extra: dict[str, str] | None = None) -> str:
    """WITH clause of everything `body` reads, then `body`; `dates` leave as text."""
    known = {**CTES, **(extra or {})}
    order: list[str] = []

    def visit(sql: str, own: str) -> None:
        names = re.findall(r"(?:FROM|JOIN)\s+\(?([a-z_][a-z_0-9]*)", sql)
        for name in dict.fromkeys(names):
            if name in known and name != own and name not in order:
                visit(known[name], name)
                if name not in order:
                    order.append(name)

    visit(body, "")
    if dates:
        casts = ", ".join(f"CAST({d} AS VARCHAR) AS {d}" for d in dates)
        body = f"SELECT * REPLACE ({casts}) FROM ({body})"
    head = ",\n".join(f"{n} AS ({known[n]})" for n in order)
    recursive = "RECURSIVE " if "reach" in order else ""
    return f"WITH {recursive}{head}\n{body}" if head else body


# -- feed snapshots from events -----------------------------------------------------------------

CTES["ev"] = """SELECT event_id AS e, CAST(event_id AS VARCHAR) AS entity_id, user_id, event_type, ts,
    CAST(floor(epoch(ts)) AS BIGINT) // 60 * 60 AS polled_at, CAST(floor(value) AS INTEGER) % 4 * 30 AS delay,
    CASE WHEN event_id % 13 = 0 THEN '' ELSE 'u' || user_id END AS trip_id,
    CASE WHEN event_id % 17 <> 0 THEN strftime(ts, '%Y%m%d') END AS start_date,
    CASE WHEN event_type = 'error' AND event_id % 2 = 0 THEN 'CANCELED' ELSE 'SCHEDULED' END AS trip_relationship
    FROM events"""
CTES["poll_numbers"] = """SELECT polled_at, row_number() OVER (ORDER BY polled_at) - 1 AS poll FROM (SELECT DISTINCT polled_at FROM ev)"""
CTES["feed"] = """SELECT p.poll, x.* FROM (
      SELECT e, 0 AS stop_pos, entity_id, coalesce(start_date, '') AS betriebstag, trip_id, '' AS stop_id, 0 AS stop_sequence,
             trip_relationship AS schedule_relationship, trip_relationship, CAST(NULL AS INTEGER) AS arrival_delay, CAST(NULL AS BIGINT) AS arrival_time,
             CAST(NULL AS INTEGER) AS departure_delay, CAST(NULL AS BIGINT) AS departure_time, polled_at AS observed_at, ts
      FROM ev WHERE event_type = 'error' AND e % 11 <> 0 AND trip_id <> ''
      UNION ALL
      SELECT e, i, entity_id, coalesce(start_date, ''), trip_id, 's' || ((e + i) % 5), i,
             CASE WHEN (e + i) % 9 = 0 THEN 'SKIPPED' ELSE 'SCHEDULED' END, trip_relationship,
             CASE WHEN (e + i) % 4 <> 0 THEN delay END, CASE WHEN (e + i) % 4 <> 0 THEN polled_at // 86400 * 86400 + (e + i) % 5 * 600 + delay END,
             CASE WHEN (e + i) % 6 <> 0 THEN delay + 15 END, CASE WHEN (e + i) % 6 <> 0 THEN polled_at // 86400 * 86400 + (e + i) % 5 * 600 + delay + 15 END, polled_at, ts
      FROM ev JOIN (VALUES (0), (1), (2)) AS n(i) ON i <= e % 3
      WHERE event_type <> 'error' AND e % 11 <> 0 AND trip_id <> '') x JOIN poll_numbers p ON p.polled_at = x.observed_at"""
CTES["feed_trips"] = """SELECT e, max(poll) AS poll, max(observed_at) AS polled_at, max(trip_id) AS trip_id,
    coalesce(nullif(max(betriebstag), ''), '?') AS start_date, max(trip_relationship) AS relationship, max(strftime(ts, '%H')) AS start_hour,
    count(*) FILTER (WHERE stop_id <> '') AS stops,
    count(*) FILTER (WHERE stop_id <> '' AND (arrival_delay IS NOT NULL OR departure_delay IS NOT NULL)) AS with_time,
    count(*) FILTER (WHERE stop_id <> '' AND schedule_relationship = 'SKIPPED') AS skipped FROM feed GROUP BY 1"""
CTES["changes"] = """SELECT * EXCLUDE (same, gone) FROM (
      SELECT *, lag(poll) OVER w IS NULL OR poll - lag(poll) OVER w > 240 AS gone,
        schedule_relationship IS NOT DISTINCT FROM lag(schedule_relationship) OVER w
        AND arrival_delay IS NOT DISTINCT FROM lag(arrival_delay) OVER w AND arrival_time IS NOT DISTINCT FROM lag(arrival_time) OVER w
        AND departure_delay IS NOT DISTINCT FROM lag(departure_delay) OVER w AND departure_time IS NOT DISTINCT FROM lag(departure_time) OVER w AS same
      FROM feed WINDOW w AS (PARTITION BY trip_id, stop_id ORDER BY poll, entity_id, stop_pos)) WHERE gone OR NOT same"""

CTES["pair_edges"] = """SELECT DISTINCT route_id, coalesce(direction, -1) AS d, route_id || '/' || coalesce(direction, -1) AS g, a, b
    FROM (SELECT route_id, direction, station_id AS a,
          lead(station_id) OVER (PARTITION BY route_id, direction, schedule_version, run_id ORDER BY step) AS b FROM runs_axis)
    WHERE b IS NOT NULL AND a <> b"""
CTES["reach"] = """SELECT g, a, b FROM pair_edges UNION SELECT r.g, r.a, e.b FROM reach r JOIN pair_edges e ON e.g = r.g AND e.a = r.b"""
