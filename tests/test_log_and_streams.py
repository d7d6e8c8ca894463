"""Change detection, snapshot explosion, sinks, incremental tables and the streaming path."""

import datetime as dt
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from stopwise.adapters.driver_tables import DriverTables
from stopwise.operators import marts
from stopwise.operators.neighbours import dense_numbers, with_previous
from stopwise.plans.warehouse import Warehouse
from stopwise.sources import feed as fd
from stopwise.sources import scan, schemas, sinks
from stopwise.sources.store import TableStore
from stopwise.streaming import changes, increments, ingest, landing

ROW = "poll long, entity_pos int, entity_id string, stop_pos int, trip_id string, stop_id string, schedule_relationship string, arrival_delay int"


def feed(spark, data):
    df = spark.createDataFrame(data, ROW)
    return df.select(
        "*", F.lit("").alias("betriebstag"), F.lit(1).alias("stop_sequence"),
        *[F.lit(None).cast(t).alias(c) for c, t in (("arrival_time", "long"), ("departure_delay", "int"), ("departure_time", "long"))],
        F.col("poll").alias("observed_at"),
    )


def test_change_detection_sequence(spark):
    states = [("SCHEDULED", 30), ("SCHEDULED", 30), ("SCHEDULED", 45), ("SCHEDULED", 45), ("SCHEDULED", None), ("SCHEDULED", None), ("CANCELED", None)]
    rows = feed(spark, [(i, 0, "e", 0, "t", "s", r, d) for i, (r, d) in enumerate(states)])
    assert sorted(r["poll"] for r in ingest.change_only(rows).collect()) == [0, 2, 4, 6]


def test_change_back_is_a_change(spark):
    rows = feed(spark, [(i, 0, "e", 0, "t", "s", "SCHEDULED", d) for i, d in enumerate([1, 2, 1])])
    assert ingest.change_only(rows).count() == 3


def test_different_keys_are_all_changes(spark):
    rows = feed(spark, [(0, 0, "e", i, t, s, "SCHEDULED", 5) for i, (t, s) in enumerate([("t", "a"), ("t", "b"), ("u", "a")])])
    assert ingest.change_only(rows).count() == 3


@pytest.mark.parametrize("gap,again", [(2, False), (3, True)])
def test_idle_eviction_counts_polls(spark, gap, again):
    rows = feed(spark, [(0, 0, "e", 0, "t", "s", "SCHEDULED", 5), (gap, 0, "e", 0, "t", "s", "SCHEDULED", 5)])
    assert (ingest.change_only(rows, max_idle=2).count() == 2) is again
    assert (ingest.idle_evictions(rows, max_idle=2).count() == 1) is again


def _brute_changes(data, max_idle):
    last, out = {}, []
    for row in sorted(data, key=lambda r: (r[0], r[1], r[2], r[3])):
        key, state = (row[4], row[5]), (row[6], row[7])
        old = last.get(key)
        if old is None or row[0] - old[0] > max_idle or old[1] != state:
            out.append((row[0], row[2], row[3]))
        last[key] = (row[0], state)
    return sorted(out)


def test_change_only_against_brute_force_over_bucket_borders(spark, monkeypatch):
    monkeypatch.setattr(ingest, "POLLS_PER_BUCKET", 3)
    rng = random.Random(7)
    data = [
        (p, e, f"e{e}", s, rng.choice("tu"), rng.choice("ab"), "SCHEDULED", rng.choice([None, 0, 30]))
        for p in rng.sample(range(40), 25) for e in range(2) for s in range(2)
    ]
    got = sorted((r["poll"], r["entity_id"], r["stop_pos"]) for r in ingest.change_only(feed(spark, data), 4).collect())
    assert got == _brute_changes(data, 4)


def test_with_previous_and_dense_numbers(spark):
    df = spark.createDataFrame([("k", i) for i in (1, 2, 5, 11, 30)], "k string, x int").withColumn("b", F.floor(F.col("x") / 4))
    got = {r["x"]: r["p"]["x"] if r["p"] else None for r in with_previous(df, ["k"], "b", ["x"], ["x"], "p").collect()}
    assert got == {1: None, 2: 1, 5: 2, 11: 5, 30: 11}
    numbers = {r["x"]: r["n"] for r in dense_numbers(df.union(df), "x", F.floor(F.col("x") / 4), "n").collect()}
    assert numbers == {1: 0, 2: 1, 5: 2, 11: 3, 30: 4}


# -- snapshots ----------------------------------------------------------------------------------


def entity(trip="t", updates=(), rel="SCHEDULED", update=True, key="1"):
    body = {"id": key}
    if update:
        body["tripUpdate"] = {"trip": {"tripId": trip, "startDate": "20260830", "scheduleRelationship": rel}, "stopTimeUpdate": list(updates)}
    return body


def stop(seq, delay=None, rel="SCHEDULED"):
    s = {"stopId": f"s{seq}", "stopSequence": seq, "scheduleRelationship": rel}
    if delay is not None:
        s["arrival"] = {"delay": delay, "time": 1000 + delay}
    return s


def snapshots(spark, folder):
    return landing.valid_snapshots(landing.read_snapshots(spark, folder))


def snapshot_file(folder, name, poll, entities):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write(json.dumps({"header": {"timestamp": 1756500000 + poll * 60}, "poll": poll, "entity": entities}))


@pytest.mark.parametrize(
    "entities,expected",
    [
        ([entity(updates=[stop(1, 30), stop(2)])], [("t", "s1", 1, 30), ("t", "s2", 2, None)]),
        ([entity(rel="CANCELED")], [("t", "", 0, None)]),
        ([entity(update=False)], []),
        ([entity(trip="")], []),
        ([entity("a", [stop(1, 0)]), entity("b")], [("a", "s1", 1, 0), ("b", "", 0, None)]),
    ],
)
def test_explode_feed(spark, folder, entities, expected):
    snapshot_file(folder, "a.json", 0, entities)
    rows = fd.explode_feed(snapshots(spark, folder))
    got = sorted(tuple(r) for r in rows.select("trip_id", "stop_id", "stop_sequence", "arrival_delay").collect())
    assert got == expected
    if expected and expected[0][1] == "" and entities[0]["tripUpdate"]["trip"]["scheduleRelationship"] == "CANCELED":
        assert rows.first()["schedule_relationship"] == "CANCELED"


def test_same_snapshot_twice_adds_nothing(spark, folder):
    for p in (0, 1):
        snapshot_file(folder, f"{p}.json", p, [entity(updates=[stop(1, 30), stop(2, 0)])])
    assert ingest.change_only(fd.explode_feed(snapshots(spark, folder))).count() == 2


def test_stream_equals_batch_over_several_runs(spark, folder):
    """Files arrive between runs; one is broken and costs only itself."""
    src, log, cp = f"{folder}/in", f"{folder}/log", f"{folder}/cp"
    rng = random.Random(3)
    for p in range(9):
        entities = [entity(t, [stop(s, rng.choice([None, 0, 30])) for s in (1, 2)], key=t) for t in ("a", "b", "c") if rng.random() < 0.7]
        snapshot_file(src, f"{p}.json", p, entities)
        if p == 4:
            with open(f"{src}/broken.json", "w") as f:
                f.write("{ no json")
        if p in (2, 5, 8):
            ingest.stream_ingest(spark, src, log, cp, max_idle=3).awaitTermination()
    batch = ingest.change_only(fd.explode_feed(snapshots(spark, src)), 3)
    cols = ["trip_id", "stop_id", "arrival_delay", "observed_at"]
    got = sorted(map(tuple, scan.scan_reports(spark, log).select(*cols).collect()), key=repr)
    assert got == sorted(map(tuple, batch.select(*cols).collect()), key=repr)


def random_polls(rng, n):
    return {
        p: [entity(t, [stop(s, rng.choice([None, 0, 30])) for s in (1, 2)], key=t) for t in ("a", "b", "c") if rng.random() < 0.7]
        for p in range(n)
    }


@pytest.mark.parametrize("seed", range(40))
def test_changes_do_not_depend_on_the_order_of_arrival(seed):
    """Net of withdrawals, any order and any cut into batches gives what brute force gives; rows delivered twice add nothing."""
    rng = random.Random(seed)
    data = [(p, e, f"e{e}", 0, "t", "s", "SCHEDULED", rng.choice([None, 0, 30])) for p in range(30) if rng.random() < 0.6 for e in range(rng.choice([1, 1, 2]))]
    step = changes.Changes(4, 1 << 40, 0)
    fields = step.FIELDS
    full = []
    for r in data:
        values = dict.fromkeys(fields) | {"trip_id": r[4], "stop_id": r[5], "schedule_relationship": r[6], "arrival_delay": r[7], "observed_at": r[0] * 10 + r[1]}
        full.append([*r[:4], *(values[f] for f in fields)])
    rng.shuffle(full)
    seen, out = {"next": None, "cut": False, "rows": []}, []
    while full:
        n = rng.randint(1, 4)
        out += step.step(seen, full[:n] + full[:1])
        seen = json.loads(json.dumps(seen))
        full = full[n:]
    gone = {r[-2] for r in out if r[-1]}
    net = sorted(r[fields.index("observed_at")] for r in out if not r[-1] and r[-2] not in gone)
    assert len({r[-2] for r in out if not r[-1]}) == sum(not r[-1] for r in out)
    assert net == sorted(p * 10 + int(e[1:]) for p, e, _ in _brute_changes(data, 4))


def test_remembered_polls_are_bounded_and_older_rows_are_not_lost():
    step = changes.Changes(240, 3, 0)
    row = lambda p, d: [p, 0, "e", 0, "d", "t", "s", 1, "SCHEDULED", d, None, None, None, p]
    seen, out = {"next": None, "cut": False, "rows": []}, []
    for p in range(20):
        out += step.step(seen, [row(p, 0)])
    assert len(out) == 1 and len(seen["rows"]) == 5
    assert [(r[-3], r[-1]) for r in step.step(seen, [row(17, 9)])] == []
    assert [(r[-3], r[-1]) for r in step.step(seen, [row(2, 7)])] == [(2, False)]


def test_stream_takes_one_file_at_a_time_in_any_order(spark, folder):
    """Polls arrive shuffled, one file a micro-batch, in three runs; one comes very late, one file is delivered twice."""
    src, log, cp = f"{folder}/in", f"{folder}/log", f"{folder}/cp"
    rng = random.Random(5)
    polls = random_polls(rng, 10)
    order = [0, 5, 2, 9, 1, 7, 8, 4, 6, 3]
    for k, p in enumerate(order):
        snapshot_file(src, f"{p}.json", p, polls[p])
        os.utime(f"{src}/{p}.json", (1756500000 + p * 60,) * 2)
        if k in (3, 6, 9):
            ingest.stream_ingest(spark, src, log, cp, max_idle=3, files_per_trigger=1).awaitTermination()
    batch = ingest.change_only(fd.explode_feed(snapshots(spark, src)), 3)
    cols = ["trip_id", "stop_id", "arrival_delay", "observed_at"]
    got = sorted(map(tuple, scan.scan_reports(spark, log).select(*cols).collect()), key=repr)
    assert got == sorted(map(tuple, batch.select(*cols).collect()), key=repr)


def test_polls_without_number_are_counted_by_file_time(spark, folder):
    """Pretty-printed documents, a header that stands still, no `poll`: each file is a poll of its own, and an outage ages nothing."""
    src, log, cp = f"{folder}/in", f"{folder}/log", f"{folder}/cp"
    os.makedirs(src)
    for p, (delay, at) in enumerate([(30, 0), (30, 60), (None, 90_000), (30, 90_060), (45, 90_120)]):
        updates = [stop(1, delay)] if delay is not None else []
        with open(f"{src}/{p}.json", "w") as f:
            f.write(json.dumps({"header": {"timestamp": 1756500000}, "entity": [entity(updates=updates)] if updates else []}, indent=2))
        os.utime(f"{src}/{p}.json", (1756500000 + at,) * 2)
        if p == 2:
            with open(f"{src}/bad.json", "w") as f:
                f.write("<html>busy</html>")
            os.utime(f"{src}/bad.json", (1756500000 + at + 1,) * 2)
        if p in (1, 4):
            ingest.stream_ingest(spark, src, log, cp, max_idle=3, files_per_trigger=2).awaitTermination()
    polls = spark.read.parquet(f"{cp}-landing/polls").select("poll", "polled_at").collect()
    assert sorted((r.poll, r.polled_at - 1756500000) for r in polls) == [(0, 0), (1, 60), (2, 90_000), (3, 90_060), (4, 90_120)]
    assert [os.path.basename(r.file) for r in spark.read.parquet(f"{cp}-landing/rejected").collect()] == ["bad.json"]
    got = scan.scan_reports(spark, log).select("arrival_delay", "observed_at").collect()
    assert sorted((r.observed_at - 1756500000, r.arrival_delay) for r in got) == [(0, 30), (90_120, 45)]


def test_stream_filters_by_allow_list(spark, folder):
    snapshot_file(f"{folder}/in", "0.json", 0, [entity("a", [stop(1, 5)], key="1"), entity("z", [stop(1, 5)], key="2")])
    spark.createDataFrame([("a",)], "trip_id string").write.parquet(f"{folder}/allowed")
    ingest.stream_ingest(spark, f"{folder}/in", f"{folder}/log", f"{folder}/cp", f"{folder}/allowed").awaitTermination()
    assert [r["trip_id"] for r in scan.scan_reports(spark, f"{folder}/log").collect()] == ["a"]


def test_hourly_capture_on_a_stream(spark, folder):
    data = [(i * 900,) for i in range(8)]
    spark.createDataFrame(data, "observed_at long").write.parquet(f"{folder}/in")
    stream = spark.readStream.schema("observed_at long").parquet(f"{folder}/in")
    counts = ingest.hourly_capture_stream(stream.select(F.timestamp_seconds("observed_at").alias("observed_ts")))
    counts.writeStream.outputMode("complete").format("memory").queryName("hours").trigger(availableNow=True).start().awaitTermination()
    assert sorted(r["reports"] for r in spark.table("hours").collect()) == [4, 4]


# -- sinks and scans ------------------------------------------------------------------------------


def test_report_sink(spark, folder):
    schema = schemas.REPORT
    data = [
        ("20260830", "t", "s", 1, "SKIPPED", None, None, None, None, 1756550000),
        ("20260830", "t", "s", 2, "SCHEDULED", 30, 1756550030, None, None, 1756553600),
    ]
    sinks.write_reports(spark.createDataFrame([], schema), f"{folder}/log")
    assert not os.path.exists(f"{folder}/log")
    sinks.write_reports(spark.createDataFrame(data, schema), f"{folder}/log")
    back = scan.scan_reports(spark, f"{folder}/log")
    assert sorted(tuple(r) for r in back.select("stop_sequence", "schedule_relationship", "arrival_delay").collect()) == [
        (1, "SKIPPED", None), (2, "SCHEDULED", 30),
    ]
    assert {(str(r["date"]), r["hour"]) for r in back.collect()} == {("2025-08-30", "10"), ("2025-08-30", "11")}
    assert all("/date=2025-08-30/hour=" in r["source_file"] for r in back.collect())


def test_missing_sources_are_empty_and_typed(spark, folder):
    assert scan.scan_reports(spark, f"{folder}/none").count() == 0
    empty = scan.scan_schedule_csv(spark, f"{folder}/none", "stops.txt", schemas.STOPS)
    assert empty.count() == 0 and "parent_station" in empty.columns


def test_csv_versions_with_other_column_order_and_bom(spark, folder):
    for v, text in (
        ("2026-08-27", "stop_id,stop_name,stop_lat\na,Alpha,49.1\n"),
        ("2026-08-28", "﻿stop_name,stop_id,extra\nBeta,b\n"),
    ):
        os.makedirs(f"{folder}/v={v}")
        with open(f"{folder}/v={v}/stops.txt", "w", encoding="utf-8") as f:
            f.write(text)
    stops = scan.scan_schedule_csv(spark, folder, "stops.txt", schemas.STOPS)
    got = sorted(tuple(r) for r in stops.select("v", "stop_id", "stop_name", "stop_lat").collect())
    assert got == [(dt.date(2026, 8, 27), "a", "Alpha", "49.1"), (dt.date(2026, 8, 28), "b", "Beta", None)]


def test_csv_with_ragged_rows_and_stray_quotes(spark, folder):
    """Two versions share a header and one scan; short and long rows and quotes cost nothing."""
    for v, text in (
        ("2026-08-27", 'stop_id,stop_name,stop_lat\na,Platz "Mitte" 1,49.1\nb\nc,"doubled ""q"", comma",1,surplus\n'),
        ("2026-08-28", "stop_id,stop_name,stop_lat\nd,Delta,2\n"),
        ("2026-08-29", "stop_lat,stop_id\n3,e\n"),
    ):
        os.makedirs(f"{folder}/v={v}")
        with open(f"{folder}/v={v}/stops.txt", "w", encoding="utf-8") as f:
            f.write(text)
    stops = scan.scan_schedule_csv(spark, folder, "stops.txt", schemas.STOPS)
    got = sorted(tuple(r) for r in stops.select("stop_id", "stop_name", "stop_lat").collect())
    assert got == [("a", 'Platz "Mitte" 1', "49.1"), ("b", None, None), ("c", 'doubled "q", comma', "1"), ("d", "Delta", "2"), ("e", None, "3")]
    assert stops._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 2


def test_schedule_version_is_written_once(spark, folder):
    trips = spark.createDataFrame([("t", "r", "s", "0")], schemas.TRIPS)
    day = dt.date(2026, 8, 27)
    assert sinks.write_schedule_version({"agency_trips": trips}, folder, day) is True
    assert sinks.write_schedule_version({"agency_trips": trips.union(trips)}, folder, day) is False
    back = scan.scan_schedule(spark, folder, "agency_trips.parquet", schemas.TRIPS)
    assert [(r["trip_id"], r["v"]) for r in back.collect()] == [("t", day)]


def test_empty_allow_list_keeps_the_old_one(spark, folder):
    path = f"{folder}/list"
    assert sinks.write_allow_list(spark.createDataFrame([("a",)], "trip_id string"), path) == 1
    with pytest.raises(ValueError):
        sinks.write_allow_list(spark.createDataFrame([], "trip_id string"), path)
    assert sinks.read_allow_list(spark, path).count() == 1
    assert sinks.write_allow_list(spark.createDataFrame([("a",), ("b",)], "trip_id string"), path) == 2
    assert sinks.read_allow_list(spark, path).count() == 2


def test_unreadable_version_is_reported(spark, folder):
    spark.createDataFrame([("t",)], "trip_id string").write.parquet(f"{folder}/v=2026-08-27/trips.parquet")
    os.makedirs(f"{folder}/v=2026-08-28")
    with open(f"{folder}/v=2026-08-28/trips.parquet", "w") as f:
        f.write("not parquet")
    spark.createDataFrame([("t", "r"), ("u", "r")], "trip_id string, route_id string").write.parquet(f"{folder}/v=2026-08-29/agency.parquet")
    os.makedirs(f"{folder}/v=2026-08-30")
    with open(f"{folder}/v=2026-08-30/agency.parquet", "w") as f:
        f.write("cut off")
    size, left_out = sinks.refresh_allow_list(spark, folder, "agency.parquet", f"{folder}/list", 7)
    assert size == 2 and len(left_out) == 1 and sorted(r.trip_id for r in sinks.read_allow_list(spark, f"{folder}/list").collect()) == ["t", "u"]
    good, bad = sinks.readable_versions(spark, folder, "trips.parquet")
    assert len(good) == 1 and len(bad) == 1 and "2026-08-28" in bad[0]


def test_columnar_json_documents(spark, folder):
    day = dt.date(2026, 8, 30)
    df = spark.createDataFrame(
        [("r", day, None, 3, 1.26), ("r", day, 1, 2, None), ("r", day, 0, 1, -1.26)],
        "route_id string, service_day date, direction int, planned_stops long, delay_mean_sec double",
    )
    doc = sinks.columnar(sinks.dates_as_text(df), ["route_id"], ["service_day", "direction"], ["direction", "planned_stops", "delay_mean_sec"])
    row = doc.first()
    assert row["direction"] == [0, 1, None] and row["planned_stops"] == [1, 2, 3] and row["delay_mean_sec"] == [-1.26, None, 1.26]
    sinks.export_columnar_json(doc, f"{folder}/json", "route_id")
    assert spark.read.json(f"{folder}/json").count() == 1


# -- incremental equals full ------------------------------------------------------------------------


def test_incremental_mart_equals_full_rebuild(spark, folder):
    sf = "/root/testdata/sf0.001"
    w = Warehouse(DriverTables(spark, sf), 5, TableStore(spark, sf).keep)
    fact = w.first.states.withColumns({"source": F.lit("first")}).where(F.year("service_day") == 1996).cache()
    newest = fact.agg(F.max("service_day")).first()[0]
    path = f"{folder}/mart"
    early = fact.where(F.col("service_day") <= newest - dt.timedelta(days=30))
    half = early.where((F.col("service_day") < early.agg(F.max("service_day")).first()[0]) | (F.col("stop_sequence") < 3))
    sinks.write_incremental(marts.hour_profile(half), path, "service_day")
    start = increments.window_start(spark.read.parquet(path))
    sinks.write_incremental(marts.hour_profile(increments.recompute_window(fact, start)), path, "service_day")
    cols = ["service_day", "route_id", "direction", "service_hour", "planned_stops", "assessable_stops", "on_time_3min"]
    full = sorted(map(tuple, marts.hour_profile(fact).select(*cols).collect()), key=repr)
    stored = sorted(map(tuple, sinks.read_incremental(spark, path).select(*cols).collect()), key=repr)
    assert stored == full


def test_lookup_signature_ignores_row_order(spark):
    a = spark.createDataFrame([("x", 1), ("y", None)], "k string, n int")
    b = spark.createDataFrame([("y", None), ("x", 1)], "k string, n int")
    c = spark.createDataFrame([("y", 0), ("x", 1)], "k string, n int")
    d = a.union(a)
    sig = [increments.lookup_signature(x).first()[0] for x in (a, b, c, d, a.limit(0), a.repartition(5))]
    assert sig[0] == sig[1] == sig[5] and len(set(sig)) == 4


# -- real files in the stored layout ------------------------------------------------------------------


def test_warehouse_over_files(spark, folder):
    """Reports, two schedule versions, CSV files and lookups on disk; no second source yet."""
    from stopwise.sources.scan import FileTables

    day, version = "20260831", dt.date(2026, 8, 30)  # a Monday
    write = {
        "routes": spark.createDataFrame([("r1", "Net 1", "A - B", 0)], schemas.ROUTES),
        "trips": spark.createDataFrame([("t1", "r1", "s", "0"), ("t2", "r1", "s", "1")], schemas.TRIPS),
        "stop_times": spark.createDataFrame(
            [(t, f"de:1:{s}:1", s, "25:30:00", "25:31:00") for t in ("t1", "t2") for s in (1, 2)], schemas.STOP_TIMES
        ),
    }
    assert sinks.write_schedule_version(write, f"{folder}/static", version)
    texts = {
        "stops.txt": "stop_id,stop_name,stop_lat,stop_lon,parent_station\n" + "".join(f"de:1:{s}:1,Stop {s} Bstg. 1,49.0,8.0,\n" for s in (1, 2)),
        "calendar.txt": "service_id,monday,tuesday,wednesday,thursday,friday,saturday,sunday,start_date,end_date\ns,1,0,0,0,0,0,0,20260801,20260930\n",
        "calendar_dates.txt": "service_id,date,exception_type\nother,20260831,1\n",
    }
    for name, text in texts.items():
        with open(f"{folder}/static/v={version}/{name}", "w") as f:
            f.write(text)
    os.makedirs(f"{folder}/lookups")
    for name, text in {
        "on_demand.csv": "route_id,line,note\n",
        "second_source.csv": "route_id,line,number,mode,note\nr9,Net 9,9,tram,none yet\n",
        "school_holidays.csv": "state,kind,name,from,to,origin\nBW,summer,Summer,2026-07-30,2026-09-12,list\n",
    }.items():
        with open(f"{folder}/lookups/{name}", "w") as f:
            f.write(text)
    at = 1788219000  # 2026-08-31 23:30 UTC, 01:30 in Berlin
    reports = [(day, "t1", "de:1:1:1", 1, "SCHEDULED", 30, at, None, None, at), (day, "t2", "", 0, "CANCELED", None, None, None, None, at)]
    sinks.write_reports(spark.createDataFrame(reports, schemas.REPORT), f"{folder}/raw")

    w = Warehouse(FileTables(spark, folder, f"{folder}/lookups"), 1, TableStore(spark, folder).keep)
    got = sorted(map(tuple, w.fact.select("trip_id", "stop_sequence", "state", "service_hour", "station_id").collect()))
    assert got == [
        ("t1", 1, "measured", 25, "de:1:1"),
        ("t1", 2, "unreported", 25, "de:1:2"),
        ("t2", 1, "trip_cancelled", 25, "de:1:1"),
        ("t2", 2, "trip_cancelled", 25, "de:1:2"),
    ]
    assert w.line_profile.agg(F.sum("planned_stops")).first()[0] == 4
    assert [r["holiday_bw"] for r in w.school_calendar.collect()] == [True]
