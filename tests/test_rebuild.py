"""An incremental run over files equals a full rebuild from raw."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from stopwise.operators.direction import position_partials
from stopwise.plans.warehouse import Warehouse
from stopwise.sources import schemas, sinks
from stopwise.streaming.rebuild import Rebuild
from stopwise.streaming.version_store import VersionStore

FIRST = dt.date(2026, 8, 31)  # a Monday
STOPS = [1, 2, 3]


def schedule(spark, root, version, routes=("r1", "r2")):
    tables = {
        "routes": spark.createDataFrame([(r, f"Net {r[1:]}", "A - B", 0) for r in routes], schemas.ROUTES),
        "trips": spark.createDataFrame([(f"{r}-{k}", r, "s", str(k % 2)) for r in routes for k in range(4)], schemas.TRIPS),
        "stop_times": spark.createDataFrame(
            [(f"{r}-{k}", f"de:1:{s if k % 2 else 4 - s}:1", s, f"{8 + k}:{10 * s}:00", f"{8 + k}:{10 * s}:30") for r in routes for k in range(4) for s in STOPS],
            schemas.STOP_TIMES,
        ),
    }
    sinks.write_schedule_version(tables, f"{root}/static", version)
    week = "1,1,1,1,1,1,1"
    texts = {
        "stops.txt": "stop_id,stop_name,stop_lat,stop_lon,parent_station\n" + "".join(f"de:1:{s}:1,Stop {s} Bstg. 1,49.0,8.0,\n" for s in STOPS),
        "calendar.txt": f"service_id,monday,tuesday,wednesday,thursday,friday,saturday,sunday,start_date,end_date\ns,{week},20260801,20260930\n",
        "calendar_dates.txt": "service_id,date,exception_type\nother,20260831,1\n",
    }
    for name, text in texts.items():
        with open(f"{root}/static/v={version}/{name}", "w") as f:
            f.write(text)


def lookups(folder):
    os.makedirs(folder)
    for name, text in {
        "on_demand.csv": "route_id,line,note\n",
        "second_source.csv": "route_id,line,number,mode,note\nr9,Net 9,9,tram,none yet\n",
        "school_holidays.csv": "state,kind,name,from,to,origin\nBW,summer,Summer,2026-07-30,2026-09-02,list\n",
    }.items():
        with open(f"{folder}/{name}", "w") as f:
            f.write(text)


def reports(day, rng, routes=("r1", "r2")):
    midnight = int(dt.datetime.combine(day, dt.time(), dt.timezone.utc).timestamp())
    out = []
    for r in routes:
        for k in range(4):
            for s in STOPS:
                if rng.random() < 0.7:
                    delay = rng.choice([0, 60, 400])
                    at = midnight + (6 + k) * 3600 + s * 600
                    out.append((f"{day:%Y%m%d}", f"{r}-{k}", f"de:1:{s if k % 2 else 4 - s}:1", s, "SCHEDULED", delay, at + delay, delay, at + delay, at))
    return out


def write(spark, root, rows):
    sinks.write_reports(spark.createDataFrame(rows, schemas.REPORT), f"{root}/raw")


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Five days built at once; then late reports, an undated cancellation, a new version and three new days arrive."""
    root = str(tmp_path_factory.mktemp("rebuild"))
    rng = random.Random(2)
    days = [FIRST + dt.timedelta(days=k) for k in range(8)]
    schedule(spark, root, FIRST - dt.timedelta(days=1))
    lookups(f"{root}/lookups")
    old = (days[0] + dt.timedelta(days=0), 7)
    undated = ("", "r1-3", "", 0, "CANCELED", None, None, None, None, int(dt.datetime.combine(old[0], dt.time(old[1]), dt.timezone.utc).timestamp()))
    for d in days[:5]:
        write(spark, root, reports(d, rng))
    write(spark, root, [undated])
    build = Rebuild(spark, root, f"{root}/lookups", f"{root}/store", min_trips=1)
    starts = [build.run()]
    at = int(dt.datetime.combine(days[5], dt.time(2), dt.timezone.utc).timestamp())
    late = [(f"{days[4]:%Y%m%d}", "r1-1", "de:1:2:1", 2, "SKIPPED", None, None, None, None, at), ("", "r2-0", "", 0, "CANCELED", None, None, None, None, at)]
    write(spark, root, late)
    schedule(spark, root, days[5], routes=("r1", "r2", "r3"))
    for d in days[5:]:
        write(spark, root, reports(d, rng, ("r1", "r2", "r3")))
    starts.append(build.run())
    whole = Rebuild(spark, root, f"{root}/lookups", f"{root}/whole", min_trips=1)
    whole.run(full=True)
    return root, build, whole, starts, days


def test_the_window_starts_two_days_before_the_newest_day(stored):
    *_, starts, days = stored
    assert starts == [None, days[2]]


@pytest.mark.parametrize("table", ["fact", *Warehouse.MARTS])
def test_incremental_equals_full(stored, table):
    """All days that the window holds, and those before it but for what an undated cancellation says later."""
    _, build, whole, starts, _ = stored
    a, b = build.read(table), whole.read(table)
    key = lambda df: sorted((str(sorted(r.asDict().items(), key=lambda x: x[0])) for r in df.where(F.col("service_day") >= F.lit(starts[1])).collect()))
    assert key(a) == key(b) and a.count() == b.count()


def test_undated_cancellations_count_in_any_window(stored):
    _, build, _, starts, days = stored
    cancelled = build.read("fact").where("state = 'trip_cancelled'").select("service_day", "trip_id").distinct().collect()
    assert {(d, "r1-3") for d in days} | {(d, "r2-0") for d in days[2:]} <= {tuple(r) for r in cancelled}


def test_the_window_reaches_the_scan(stored):
    _, build, _, starts, _ = stored
    warehouse, _ = build.warehouse(starts[1])
    plan = warehouse.raw.raw_reports._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and str(starts[1] - dt.timedelta(days=1)) in plan


def test_each_version_is_built_once(stored, spark, tmp_path):
    root, build, *_ = stored
    warehouse, _ = build.warehouse(None)
    s, asked = warehouse.first, []
    tables = (s.trips, s.stop_times, s.stops)
    store = VersionStore(spark, str(tmp_path))

    def partials(present):
        def only(cut):
            cut_trips = cut(tables[0])
            asked.append(sorted(str(r[0]) for r in cut_trips.select("schedule_version").distinct().collect()))
            return position_partials(cut_trips, cut(tables[1]), cut(tables[2]))

        return store.layer("partials", present, only)

    versions = sorted(str(r[0]) for r in s.trips.select("schedule_version").distinct().collect())
    older = s.trips.where(F.col("schedule_version") == versions[0])
    assert partials(older).select("schedule_version").distinct().count() == 1
    merged = partials(s.trips)
    assert asked == [versions[:1], versions[1:]]
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, position_partials(*tables).select(*merged.columns).collect()))
    assert partials(s.trips).count() == merged.count() and len(asked) == 2
    assert partials(older).select("schedule_version").distinct().count() == 1
