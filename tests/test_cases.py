"""Fixed cases: small rows in, exact rows out."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stopwise.functions import text as tx
from stopwise.functions import time as tm
from stopwise.functions import values as vl
from stopwise.operators import axis as ax
from stopwise.operators import capture, direction, frame, holidays, rollup, versions
from stopwise.quality import checks

D = dt.date


def ts(text):
    return dt.datetime.fromisoformat(text)


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns or df.columns).collect()), key=repr)


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


# -- scalar functions ---------------------------------------------------------------------------


@pytest.mark.parametrize(
    "text,expected",
    [("25:30:00", 91800), ("00:00:05", 5), ("xx:10:00", None), ("", None), (None, None), ("10:00", None)],
)
def test_gtfs_seconds(spark, text, expected):
    assert one(spark, tm.gtfs_seconds(tx.clean(F.lit(text)))) == expected


def test_planned_timestamp_rolls_into_next_day(spark):
    x = tm.planned_timestamp(F.lit(D(2026, 9, 10)), F.lit(91800))
    assert one(spark, x) == ts("2026-09-11 01:30:00")


@pytest.mark.parametrize("when", ["2026-09-10 05:30:00", "2026-09-11 03:30:00", "2026-10-25 02:15:00"])
def test_service_hour_round_trip(spark, when):
    day = F.lit(ts(when).date() - dt.timedelta(days=1 if when.endswith("03:30:00") else 0))
    stamp = F.lit(when).cast("timestamp_ntz")
    start = tm.service_hour_start(day, tm.service_hour(day, stamp))
    assert one(spark, start) == ts(when).replace(minute=0, second=0)


def test_service_hour_before_day_start_is_negative(spark):
    assert one(spark, tm.service_hour(F.lit(D(2026, 9, 10)), F.lit("2026-09-09 23:30:00").cast("timestamp_ntz"))) == -1


def test_local_time_follows_daylight_saving(spark):
    winter = one(spark, tm.local_time(F.lit(1700000000)))
    summer = one(spark, tm.local_time(F.lit(1690000000)))
    assert winter == ts("2023-11-14 23:13:20") and summer == ts("2023-07-22 06:26:40")


def test_service_day_shifts_by_four_hours(spark):
    early = F.lit("2026-09-10 03:59:00").cast("timestamp_ntz")
    assert one(spark, tm.service_day(F.lit(None).cast("date"), early)) == D(2026, 9, 9)
    assert one(spark, tm.service_day(F.lit(D(2026, 9, 10)), early)) == D(2026, 9, 10)


@pytest.mark.parametrize("text,expected", [("20260830", D(2026, 8, 30)), ("202608", None), ("", None), ("99999999", None)])
def test_feed_day(spark, text, expected):
    assert one(spark, tm.feed_day(F.lit(text))) == expected


@pytest.mark.parametrize(
    "args,expected",
    [
        (("CANCELED", "SKIPPED", 10, 10, True), "trip_cancelled"),
        ((None, "SKIPPED", 10, 10, True), "skipped"),
        ((None, "SCHEDULED", 0, None, False), "measured"),
        ((None, "SCHEDULED", None, 0, False), "departure_only"),
        ((None, None, None, None, False), "not_captured"),
        ((None, None, None, None, True), "unreported"),
    ],
)
def test_stop_state_priority(spark, args, expected):
    trip, stop, arr, dep, captured = args
    state = vl.stop_state(
        F.lit(trip).cast("string"), F.lit(stop).cast("string"), F.lit(arr).cast("int"), F.lit(dep).cast("int"), F.lit(captured)
    )
    assert one(spark, state) == expected


@pytest.mark.parametrize("x,expected", [(1.26, 1.3), (-1.26, -1.2), (0.04, 0.0)])
def test_round1_truncates_toward_zero(spark, x, expected):
    assert one(spark, vl.round1(F.lit(x))) == expected


@pytest.mark.parametrize(
    "key,expected", [("de:net:02045:", "de-net-02045"), ("::A  b::", "a-b"), ("ÄÖ", ""), ("a--b", "a-b")]
)
def test_slug(spark, key, expected):
    assert one(spark, tx.slug(F.lit(key))) == expected


def test_natural_order(spark):
    names = spark.createDataFrame([("bus", n) for n in ["Net 15", "Net 5", "Moon", "Net 5A"]], "mode string, line string")
    order = [r["line"] for r in names.orderBy(*tx.natural_order(F.col("mode"), F.col("line"))).collect()]
    assert order == ["Net 5", "Net 5A", "Net 15", "Moon"]


def test_station_key_and_name(spark):
    source = tx.station_source(F.lit(None).cast("string"), F.lit("de:08222:2417:1:A"))
    assert one(spark, tx.station_key(source)) == "de:08222:2417"
    assert one(spark, tx.station_key(F.lit("de:08222:2417_Parent"))) == "de:08222:2417"
    assert one(spark, tx.station_name(F.lit("Main Square  Bstg. 3"))) == "Main Square"


def test_finding_key(spark):
    assert one(spark, tx.finding_key(F.lit("rebuild 78.0 h ago, limit 3 h"))) == "rebuild # h ago, limit # h"


# -- versions -----------------------------------------------------------------------------------


def seen_of(spark, day, prefix, n):
    return spark.createDataFrame([(day, f"{prefix}-{i}") for i in range(1, n + 1)], "service_day date, trip_id string")


def trips_of(spark, *versions_):
    data = [(v, f"{p}-{i}") for v, p, n in versions_ for i in range(1, n + 1)]
    return spark.createDataFrame(data, "schedule_version date, trip_id string")


V28, V29, V30 = D(2026, 8, 28), D(2026, 8, 29), D(2026, 8, 30)


@pytest.mark.parametrize(
    "day,prefix,n,published,expected",
    [
        (V30, "old", 60, [(V29, "old", 60), (V30, "new", 60)], (V29, V29, 1.0, True)),
        (V30, "new", 60, [(V29, "old", 60), (V30, "new", 60)], (V30, V29, 1.0, True)),
        (V30, "old", 5, [(V29, "old", 5), (V30, "new", 60)], (V30, V29, None, False)),
        (V29, "new", 60, [(V28, "old", 60), (V30, "new", 60)], (V28, V28, 0.0, True)),
        (V28, "new", 60, [(V30, "new", 60)], (None, V30, None, False)),
    ],
)
def test_choose_version(spark, day, prefix, n, published, expected):
    chosen = versions.choose_version(seen_of(spark, day, prefix, n), trips_of(spark, *published))
    assert rows(chosen) == [(day, *expected)]


def test_allow_list_newest_wins_within_window(spark):
    data = [(V28, "a", "r1"), (V29, "a", "r2"), (V29, "b", "r2"), (V30, "c", "r3")]
    trips = spark.createDataFrame(data, "schedule_version date, trip_id string, route_id string").withColumns(
        {"service_id": F.lit("s"), "direction": F.lit(0)}
    )
    assert rows(versions.allow_list(trips, 2), "trip_id", "route_id") == [("a", "r2"), ("b", "r2"), ("c", "r3")]
    assert rows(versions.allow_list(trips, 1), "trip_id") == [("c",)]
    assert rows(versions.allow_list_counts(trips, 3)) == [(3, 1, 2, 2)]


# -- directions and axis ------------------------------------------------------------------------

V = D(2026, 8, 27)
TRIPS = "route_id string, direction tinyint, trip_id string, schedule_version date"


def test_trip_shape_on_a_loop(spark):
    trips = spark.createDataFrame([("R", 0, "t0", V), ("R", 1, "t1", V)], TRIPS)
    stop_times = spark.createDataFrame(
        [("t0", V, s, i + 1) for i, s in enumerate("abca")] + [("t1", V, s, i + 1) for i, s in enumerate("adca")],
        "trip_id string, schedule_version date, stop_id string, stop_sequence int",
    )
    names = {"a": ("A", "Ring end"), "b": ("B", "West"), "c": ("C", "Opposite"), "d": ("D", "East")}
    stops = spark.createDataFrame(
        [(s, V, i, n, n) for s, (i, n) in names.items()],
        "stop_id string, schedule_version date, station_id string, station_name string, stop_name string",
    )
    shape = direction.trip_shape(trips, stop_times, stops)
    got = rows(shape, "trip_id", "stops", "last_stop", "first_station", "last_station", "quarter_stop")
    assert got == [("t0", 4, "Ring end", "A", "A", "West"), ("t1", 4, "Ring end", "A", "A", "East")]


SHAPE = TRIPS + ", stops long, last_stop string, first_station string, last_station string, quarter_stop string"


def test_direction_names_same_last_stop(spark):
    shapes = spark.createDataFrame(
        [("R", 0, "t0", V, 4, "Ring end", "A", "A", "West"), ("R", 1, "t1", V, 4, "Ring end", "A", "A", "East")], SHAPE
    )
    assert rows(direction.direction_names(shapes)) == [
        ("R", 0, "via West", "via", 1, 1, 0.0, 1.0),
        ("R", 1, "via East", "via", 1, 1, 0.0, 1.0),
    ]


def test_direction_names_clear_last_stops_and_repeated_versions(spark):
    data = [("R", 0, "t0", v, 2, "South", "A", "B", "South") for v in (V28, V29, V30)]
    shapes = spark.createDataFrame([*data, ("R", 1, "t1", V28, 2, "North", "B", "A", "North")], SHAPE)
    assert rows(direction.direction_names(shapes)) == [
        ("R", 0, "South", "last_stop", 1, 1, 0.0, 0.0),
        ("R", 1, "North", "last_stop", 1, 1, 0.0, 0.0),
    ]


def test_correlation_is_null_on_constant_input(spark):
    runs = spark.createDataFrame(
        [("R", "t", V, s, p) for s, p in (("A", 0.5), ("B", 0.5))] + [("R", "u", V, s, p) for s, p in (("A", 1.0), ("B", 0.5))],
        "route_id string, trip_id string, schedule_version date, station_id string, position double",
    )
    means = spark.createDataFrame([("R", "A", 0.2), ("R", "B", 0.9)], "route_id string, station_id string, position double")
    got = {r["trip_id"]: r["r"] for r in direction.correlation(runs, means).collect()}
    assert got["t"] is None and got["u"] == pytest.approx(-1.0)


def test_place_between_anchors(spark):
    """Two unknown stops in a gap, one before and one after the reference, NULL direction."""
    reference = spark.createDataFrame(
        [("R", None, "A", 1), ("R", None, "B", 2), ("R", None, "C", 3)],
        "route_id string, direction tinyint, station_id string, nr int",
    )
    run = [("x", 0), ("A", 1), ("p", 2), ("q", 3), ("B", 4), ("C", 5), ("z", 6)]
    runs = spark.createDataFrame(
        [("R", None, "run", i, s) for s, i in run], "route_id string, direction tinyint, run_id string, step int, station_id string"
    )
    placed = ax.place_between_anchors(runs, reference, ["route_id", "direction"])
    got = {r["station_id"]: r["pos"] for r in placed.collect()}
    assert got == {
        "A": 1.0, "B": 2.0, "C": 3.0, "x": 0.5,
        "p": pytest.approx(1 + 1 / 3), "q": pytest.approx(1 + 2 / 3), "z": 3.5,
    }


def _reachable_cycle(edges):
    graph = {}
    for a, b in edges:
        graph.setdefault(a, set()).add(b)

    def walk(node, path):
        return node in path or any(walk(n, path | {node}) for n in graph.get(node, ()))

    return any(walk(n, frozenset()) for n in graph)


def test_is_cyclic_against_brute_force(spark):
    lines = {
        ("line", 0): [("a", "b"), ("b", "c"), ("a", "c")],
        ("ring", 0): [("a", "b"), ("b", "c"), ("c", "a")],
        ("tail", None): [("a", "b"), ("b", "c"), ("c", "b"), ("c", "d")],
        ("tree", 1): [("a", "b"), ("a", "c"), ("c", "d"), ("b", "d")],
    }
    pairs = spark.createDataFrame(
        [(r, d, a, b) for (r, d), edges in lines.items() for a, b in edges], "route_id string, direction tinyint, a string, b string"
    )
    got = {(r["route_id"], r["direction"]): r["cyclic"] for r in ax.is_cyclic(pairs).collect()}
    assert got == {k: _reachable_cycle(e) for k, e in lines.items()}


# -- frame, capture, unmatched -------------------------------------------------------------------


def test_cancellation_dated_and_undated_does_not_double(spark):
    trips = spark.createDataFrame([(V30, "a"), (V30, "b"), (V30, "c")], "service_day date, trip_id string")
    hits = spark.createDataFrame(
        [(V30, "a", True), (None, "a", True), (None, "b", True), (V29, "c", True)], "day_in_feed date, trip_id string, cancelled boolean"
    )
    got = rows(frame.with_trip_cancellation(trips, hits), "trip_id", "trip_relationship")
    assert got == [("a", "CANCELED"), ("b", "CANCELED"), ("c", None)]


def test_last_report_wins_and_ties_are_fixed(spark):
    day = V30
    data = [
        (day, "t", "s", 1, "SCHEDULED", 30, None, ts("2026-08-30 10:00:00")),
        (day, "t", "s", 1, "SCHEDULED", 60, None, ts("2026-08-30 11:00:00")),
        (day, "t", "s", 1, "SKIPPED", None, None, ts("2026-08-30 11:00:00")),
        (day, "t", None, 0, "CANCELED", None, None, ts("2026-08-30 12:00:00")),
    ]
    reports = spark.createDataFrame(
        data,
        "service_day date, trip_id string, stop_id string, stop_sequence int, relationship string, delay_arr int, delay_dep int, observed_at timestamp_ntz",
    ).withColumns({"actual_arr": F.col("observed_at"), "actual_dep": F.col("observed_at")})
    assert rows(frame.last_report_per_stop(reports), "relationship", "delay_arr") == [("SKIPPED", None)]


def test_capture_asks_for_the_collector_not_the_day(spark):
    hours = spark.createDataFrame([(D(2026, 9, 10), h) for h in (5, 12, 27)], "service_day date, service_hour int")
    reports = spark.createDataFrame(
        [(ts("2026-09-10 05:30:00"),), (ts("2026-09-11 03:30:00"),)], "observed_at timestamp_ntz"
    )
    got = rows(capture.capture_gaps(hours, reports), "service_hour", "reports", "captured")
    assert got == [(12, 0, False), (27, 1, True), (5, 1, True)]


def unmatched(spark, known, unknown, repeat):
    data = [(V30, f"{p}-{i}", f"H{s}", s) for p, n in (("old", known), ("new", unknown)) for i in range(1, n + 1) for s in (1, 2)]
    if repeat:
        data.append((V30, "new-1", "H1", 1))
    reports = spark.createDataFrame(data, "service_day date, trip_id string, stop_id string, stop_sequence int")
    days = spark.createDataFrame([(V30, V29)], "service_day date, schedule_version date")
    return rows(capture.unmatched_reports(reports, days, trips_of(spark, (V29, "old", 25))))


def test_unmatched_reports(spark):
    assert unmatched(spark, 25, 15, True) == [(V30, V29, 40, 15, 80, 30)]
    assert unmatched(spark, 25, 0, False) == [(V30, V29, 25, 0, 50, 0)]


def test_school_calendar(spark):
    listed = [
        ("BW", "Summer", D(2026, 7, 30), D(2026, 9, 12)), ("BW", "Autumn", D(2026, 10, 26), D(2026, 10, 30)),
        ("RP", "Summer", D(2026, 6, 29), D(2026, 8, 7)), ("RP", "Autumn", D(2026, 10, 5), D(2026, 10, 16)),
        ("HE", "Summer", D(2026, 6, 29), D(2026, 8, 7)), ("HE", "Autumn", D(2026, 10, 5), D(2026, 10, 17)),
    ]
    table = spark.createDataFrame(listed, "state string, name string, first_day date, last_day date")
    days = spark.createDataFrame([(D(2026, 8, 5),), (D(2026, 9, 7),), (D(2026, 9, 16),), (D(2026, 11, 2),)], "service_day date")
    assert rows(holidays.school_calendar(days, table)) == sorted([
        (D(2026, 8, 5), True, True, True, "Summer", "all"),
        (D(2026, 9, 7), True, False, False, "Summer", "partly"),
        (D(2026, 9, 16), False, False, False, None, "none"),
        (D(2026, 11, 2), None, None, None, None, None),
    ], key=repr)


def test_overlapping_and_reversed_ranges(spark):
    listed = [
        ("BW", "A", D(2026, 1, 1), D(2026, 1, 10)), ("BW", "B", D(2026, 1, 10), D(2026, 1, 12)),
        ("RP", "C", D(2026, 1, 5), D(2026, 1, 6)), ("RP", "D", D(2026, 2, 5), D(2026, 2, 1)),
    ]
    table = spark.createDataFrame(listed, "state string, name string, first_day date, last_day date")
    assert rows(checks.check_holiday_ranges(table)) == [("overlap", "BW", "A", "B"), ("reversed", "RP", "D", None)]


# -- roll-ups -----------------------------------------------------------------------------------


@pytest.mark.parametrize("complete,last_complete", [((True, False), D(2026, 9, 19)), ((False, False), None)])
def test_latest_network(spark, complete, last_complete):
    d19, d20 = D(2026, 9, 19), D(2026, 9, 20)
    network = spark.createDataFrame(
        [(d19, "tram", 33402), (d19, "bus", 41146), (d20, "tram", 20676), (d20, "bus", 29368)],
        "service_day date, mode string, assessable_stops long",
    )
    quality = spark.createDataFrame([(d19, complete[0]), (d20, complete[1])], "service_day date, complete boolean")
    got = [tuple(r) for r in rollup.latest_network(network, quality).select("service_day", "mode", "assessable_stops", "last_complete_day").collect()]
    assert got == [(d20, "bus", 29368, last_complete), (d20, "tram", 20676, last_complete)]


def test_period_filter_swaps_ends(spark):
    days = spark.createDataFrame([(D(2026, 9, d),) for d in range(1, 6)], "service_day date")
    assert rollup.period_filter(days, D(2026, 9, 4), D(2026, 9, 2)).count() == 3
    assert rollup.period_filter(days, start=D(2026, 9, 4)).count() == 2
    assert rollup.period_filter(days).count() == 5


def test_finding_diff_and_escalation(spark):
    now = F.lit("2026-09-20 12:00:00").cast("timestamp_ntz")
    previous = spark.createDataFrame(
        [
            ("rebuild 3 h ago", ts("2026-09-19 11:00:00"), ts("2026-09-19 11:00:00")),
            ("disk 10 % free", ts("2026-09-20 11:00:00"), ts("2026-09-20 11:00:00")),
            ("gone", ts("2026-09-20 11:00:00"), ts("2026-09-20 11:00:00")),
        ],
        "finding string, since timestamp_ntz, reported timestamp_ntz",
    )
    current = spark.createDataFrame([("rebuild 28 h ago",), ("disk 9 % free",), ("fresh",)], "finding string")
    got = dict(rows(checks.finding_diff(previous, current, now), "key", "status"))
    assert got == {"rebuild # h ago": "lasting", "disk # % free": "known", "gone": "vanished", "fresh": "new"}
    keyed = previous.select(tx.finding_key(F.col("finding")).alias("key"), "since")
    levels = dict(rows(checks.finding_escalation(keyed, current, now), "finding", "level"))
    assert levels == {"rebuild 28 h ago": "high", "disk 9 % free": "normal", "fresh": "normal"}


def test_stored_findings_of_one_key_count_once(spark):
    import datetime as dt

    from pyspark.sql import functions as F

    from stopwise.quality import checks

    at = lambda h: dt.datetime(2026, 1, 1, h)
    previous = spark.createDataFrame(
        [("line 7: 3 stops", at(1), at(2)), ("line 7: 9 stops", at(3), at(4))], "finding string, since timestamp, reported timestamp"
    )
    current = spark.createDataFrame([("line 7: 5 stops",)], "finding string")
    rows = checks.finding_diff(previous, current, F.lit(at(5))).collect()
    assert [(r.status, r.since, r.reported) for r in rows] == [("known", at(1), at(4))]


def test_csv_quotes_inside_a_field(spark, folder):
    import os

    from pyspark.sql import types as T

    from stopwise.sources import scan

    os.makedirs(f"{folder}/v=2026-01-01")
    with open(f"{folder}/v=2026-01-01/stops.txt", "w") as out:
        out.write('stop_id,stop_name,stop_lat\n1,"Am ""Markt"", Nord",49.5\n')
    schema = T.StructType([T.StructField(n, T.StringType()) for n in ("stop_id", "stop_name", "stop_lat")])
    rows = scan.scan_schedule_csv(spark, folder, "stops.txt", schema).collect()
    assert [(r.stop_name, r.stop_lat) for r in rows] == [('Am "Markt", Nord', "49.5")]
