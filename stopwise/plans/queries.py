"""Registered queries: every operator on the driver's tables, next to its DuckDB statement."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stopwise.adapters import event_feed
from stopwise.adapters.driver_tables import OPERATOR_PREFIX, DriverTables
from stopwise.functions import text as tx
from stopwise.functions import time as tm
from stopwise.functions import values as vl
from stopwise.operators import axis as ax
from stopwise.operators import capture, diagnostics, direction, facts, forecast, frame, holidays, marts
from stopwise.operators import municipality, rollup, staging, versions
from stopwise.plans import oracle_base as ob
from stopwise.plans.oracle_base import MIN_TRIPS, statement
from stopwise.plans.warehouse import Warehouse
from stopwise.quality import checks
from stopwise.sources import feed as fd
from stopwise.sources import scan, sinks
from stopwise.sources.store import TableStore, path_exists
from stopwise.streaming import increments, ingest

LINE_DIR = ["route_id", "direction"]
DIGITS = 6


class Context(Warehouse):
    """The warehouse over the driver's tables, with layers stored in the session's folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        if spark.conf.get("spark.sql.session.timeZone") != "UTC":
            spark.conf.set("spark.sql.session.timeZone", "UTC")
        self.spark = spark
        self.sf_dir = sf_dir
        self.store = TableStore(spark, sf_dir)
        super().__init__(DriverTables(spark, sf_dir), MIN_TRIPS, self.store.keep)

    @cached_property
    def snapshots(self) -> DataFrame:
        return self.keep("snapshots", lambda: fd.with_poll_number(event_feed.snapshots(self.spark, self.sf_dir)))

    @cached_property
    def feed_rows(self) -> DataFrame:
        return fd.explode_feed(self.snapshots)

    @cached_property
    def poll_trips(self) -> DataFrame:
        return fd.poll_trips(self.snapshots)

    @cached_property
    def report_log(self) -> str:
        """Folder of the partitioned report log made from the feed's changes."""
        root = f"{self.store.root}/report_log"
        if not path_exists(self.spark, f"{root}/_SUCCESS"):
            sinks.write_reports(ingest.change_only(self.feed_rows), root)
        return root

    @cached_property
    def log(self) -> DataFrame:
        return scan.scan_reports(self.spark, self.report_log)

    @cached_property
    def viable(self) -> DataFrame:
        return rollup.viable_days(self.mart("data_quality"))

    @cached_property
    def totals(self) -> DataFrame:
        return rollup.line_totals(self.mart("line_profile"))

    @cached_property
    def master(self) -> DataFrame:
        return rollup.latest_line_master(self.lines)

    @cached_property
    def catalogue(self) -> DataFrame:
        return (
            self.master.select("route_id", "line", "route_text", "mode")
            .join(self.totals.select("route_id", "on_demand", "assessable_stops"), "route_id")
            .join(rollup.line_stop_names(self.mart("stop_profile")), "route_id", "left")
        )

    @cached_property
    def shown(self) -> DataFrame:
        return ax.shown_stops(self.mart("stop_profile"))

    @cached_property
    def pairs(self) -> DataFrame:
        return self.keep("adjacent_pairs", lambda: ax.adjacent_pairs(self.first.runs))

    @cached_property
    def asof_days(self) -> DataFrame:
        days = self.first.reports.where(F.col("day_in_feed").isNotNull()).select(
            F.col("day_in_feed").alias("service_day")
        )
        return versions.asof_version(days.distinct(), self.first.all_trips)

    @cached_property
    def candidates(self) -> DataFrame:
        a, b = self.first, self.second
        return diagnostics.source_candidates(
            a.states, a.lines, b.chosen_versions, b.calendar, b.all_trips, b.lines, b.seen,
            self.on_demand, self.takeover, OPERATOR_PREFIX,
        )


def portable(df: DataFrame) -> DataFrame:
    """Dates and timestamps as text, tiny integers as int: alike in every client."""
    casts = {"date": "string", "timestamp": "string", "timestamp_ntz": "string", "tinyint": "int"}
    return df.select(*[F.col(n).cast(casts[t]).alias(n) if t in casts else F.col(n) for n, t in df.dtypes])


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Sums of fractions depend on their order in the last bits."""
    return df.withColumns({c: F.round(c, DIGITS) for c in columns})


BUILDERS: dict[str, Callable[[Context], DataFrame]] = {}
SQL: dict[str, str] = {}


def register(name: str, build: Callable[[Context], DataFrame], sql: str | None = None, dates: str = "") -> None:
    BUILDERS[name] = build
    if sql is not None:
        SQL[name] = statement(sql, tuple(dates.split()))


def r6(*columns: str) -> str:
    """DuckDB counterpart of `rounded` for use in SELECT * REPLACE."""
    return ", ".join(f"round({c}, {DIGITS}) AS {c}" for c in columns)


# -- sources and sinks ---------------------------------------------------------------------------

register(
    "src1_scan_reports",
    lambda c: c.log.groupBy("date", "hour").agg(
        F.count("*").alias("reports"),
        F.count("arrival_delay").alias("with_arrival"),
        F.count_if(F.col("source_file").contains("hour=")).alias("with_path"),
    ),
    """SELECT CAST(to_timestamp(observed_at) AT TIME ZONE 'UTC' AS DATE) AS date,
       strftime(to_timestamp(observed_at) AT TIME ZONE 'UTC', '%H') AS hour,
       count(*) AS reports, count(arrival_delay) AS with_arrival, count(*) AS with_path FROM changes GROUP BY 1, 2""",
    "date",
)


def _schedule_files(c: Context) -> str:
    """Trips of two versions written in the stored layout `v=DATE/`."""
    root = f"{c.store.root}/schedule"
    if not path_exists(c.spark, f"{root}/_DONE"):
        trips = c.raw.raw_trips.withColumn("year", F.year("v"))
        for (year,) in trips.select("year").distinct().orderBy("year").collect():
            part = trips.where(F.col("year") == year).drop("year", "v")
            part.write.mode("overwrite").parquet(f"{root}/v={year}-01-01/trips.parquet")
        c.spark.range(1).write.mode("overwrite").parquet(f"{root}/_DONE")
    return root


def _scan_schedule(c: Context) -> DataFrame:
    from stopwise.sources import schemas

    trips = scan.scan_schedule(c.spark, _schedule_files(c), "trips.parquet", schemas.TRIPS)
    return trips.groupBy(F.col("v").alias("schedule_version")).agg(
        F.count("*").alias("trips"), F.countDistinct("route_id").alias("routes")
    )


register(
    "src2_scan_schedule",
    _scan_schedule,
    """SELECT make_date(year(v), 1, 1) AS schedule_version, count(*) AS trips, count(DISTINCT route_id) AS routes FROM raw_trips GROUP BY 1""",
    "schedule_version",
)


def _scan_csv(c: Context) -> DataFrame:
    """Two versions of the stops file whose columns stand in different order."""
    from stopwise.sources import schemas

    root = f"{c.store.root}/stops_csv"
    columns = ["stop_id", "stop_name", "stop_lat", "stop_lon", "parent_station"]
    if not path_exists(c.spark, f"{root}/_DONE"):
        stops = c.raw.raw_stops
        newest = stops.agg(F.max("v").alias("v")).scalar()
        for name, rows, order in (
            ("2000-01-01", stops.where(F.col("v") < newest), columns),
            ("2001-01-01", stops.where(F.col("v") == newest), columns[::-1]),
        ):
            rows.select(*order).write.mode("overwrite").option("header", True).option("emptyValue", "").csv(
                f"{root}/v={name}/stops.txt"
            )
        c.spark.range(1).write.mode("overwrite").parquet(f"{root}/_DONE")
    rows = scan.scan_schedule_csv(c.spark, root, "stops.txt", schemas.STOPS)
    return rows.groupBy(F.col("v").alias("schedule_version")).agg(
        F.count("*").alias("stops"),
        F.countDistinct("stop_id").alias("stop_ids"),
        F.count("platform_code").alias("with_platform"),
        F.sum(F.try_to_number("stop_lon", F.lit("9.999"))).cast("double").alias("lon_sum"),
    )


register(
    "src3_scan_schedule_csv",
    _scan_csv,
    """SELECT CASE WHEN v = (SELECT max(v) FROM raw_stops) THEN DATE '2001-01-01' ELSE DATE '2000-01-01' END AS schedule_version,
       count(*) AS stops, count(DISTINCT stop_id) AS stop_ids, 0::BIGINT AS with_platform,
       CAST(sum(CAST(stop_lon AS DECIMAL(9, 3))) AS DOUBLE) AS lon_sum FROM raw_stops GROUP BY 1""",
    "schedule_version",
)


def _scan_or_empty(c: Context) -> DataFrame:
    """A missing second source next to a real table: the union keeps only the real rows."""
    from stopwise.sources import schemas

    missing = scan.scan_schedule(c.spark, f"{c.store.root}/no-such-source", "trips.parquet", schemas.TRIPS)
    both = c.raw.raw_trips.withColumn("origin", F.lit("real")).unionByName(missing.withColumn("origin", F.lit("missing")))
    return both.groupBy("origin").agg(F.count("*").alias("trips"))


register("src4_scan_or_empty", _scan_or_empty, "SELECT 'real' AS origin, count(*) AS trips FROM raw_trips")

FEED_COLUMNS = [
    "poll", "betriebstag", "trip_id", "stop_id", "stop_sequence", "schedule_relationship",
    "arrival_delay", "arrival_time", "departure_delay", "departure_time", "observed_at",
]
register(
    "src5_explode_feed",
    lambda c: c.feed_rows.select(*FEED_COLUMNS),
    f"SELECT {', '.join(FEED_COLUMNS)} FROM feed",
)


def _ingest_schedule(c: Context) -> DataFrame:
    number = F.substring("route_id", 8, 5).cast("int")
    routes = c.raw.raw_routes.withColumn("agency_id", F.concat(F.lit("a"), number % 2))
    routes, trips, stop_times = sinks.ingest_schedule(routes, c.raw.raw_trips, c.raw.raw_stop_times, "a1")
    return (
        routes.agg(F.lit("routes").alias("table_name"), F.count("*").alias("rows"))
        .unionByName(trips.agg(F.lit("trips").alias("table_name"), F.count("*").alias("rows")))
        .unionByName(stop_times.agg(F.lit("stop_times").alias("table_name"), F.count("*").alias("rows")))
    )


register(
    "src6_ingest_schedule",
    _ingest_schedule,
    """SELECT 'routes' AS table_name, count(*) AS rows FROM raw_routes WHERE CAST(substr(route_id, 8, 5) AS INT) % 2 = 1
       UNION ALL SELECT 'trips', count(*) FROM raw_trips WHERE CAST(substr(route_id, 8, 5) AS INT) % 2 = 1
       UNION ALL SELECT 'stop_times', count(*) FROM raw_stop_times WHERE trip_id IN
         (SELECT trip_id FROM raw_trips WHERE CAST(substr(route_id, 8, 5) AS INT) % 2 = 1)""",
)
register(
    "snk1_write_reports",
    lambda c: c.log.select(*[f for f in FEED_COLUMNS if f != "poll"]),
    f"SELECT {', '.join(f for f in FEED_COLUMNS if f != 'poll')} FROM changes",
)


def _write_incremental(c: Context) -> DataFrame:
    """Full table first, then the newest two years again with doubled counts."""
    path = f"{c.store.root}/incremental"
    yearly = (
        c.fact.groupBy(F.year("service_day").alias("year"), "route_id")
        .agg(F.count("*").alias("planned_stops"))
        .select("route_id", "planned_stops", "year")
    )
    sinks.write_incremental(yearly, path, "year")
    stored = sinks.read_incremental(c.spark, path)
    newest = stored.agg(F.max("year").alias("y")).scalar()
    again = stored.where(F.col("year") >= newest - 1).withColumn("planned_stops", F.col("planned_stops") * 2)
    sinks.write_incremental(again, path, "year")
    return sinks.read_incremental(c.spark, path).select("year", "route_id", "planned_stops")


register(
    "snk2_write_incremental",
    _write_incremental,
    """SELECT CAST(year(service_day) AS INTEGER) AS year, route_id,
       count(*) * CASE WHEN year(service_day) >= (SELECT max(year(service_day)) - 1 FROM fact) THEN 2 ELSE 1 END AS planned_stops
       FROM fact GROUP BY year(service_day), route_id""",
)
register(
    "snk3_evolve_schema",
    lambda c: sinks.evolve_schema(
        c.mart("line_profile").drop("source").where(F.year("service_day") < 1998),
        c.mart("line_profile").where(F.year("service_day") >= 1998),
    ).select("service_day", *LINE_DIR, "planned_stops", "source"),
    """SELECT service_day, route_id, direction, planned_stops, CASE WHEN year(service_day) >= 1998 THEN source END AS source FROM line_profile""",
    "service_day",
)


def _export_marts(c: Context) -> DataFrame:
    folder = f"{c.store.root}/export"
    sinks.export_marts({n: c.mart(n) for n in c.MARTS}, c.lines, c.direction_names, folder)
    counts = [
        c.spark.read.parquet(f"{folder}/{n}.parquet").agg(F.lit(n).alias("table_name"), F.count("*").alias("rows"))
        for n in [*c.MARTS, "lines", "directions"]
    ]
    out = counts[0]
    for one in counts[1:]:
        out = out.unionByName(one)
    return out


_EXPORTED = {
    "line_profile": "line_profile", "hour_profile": "hour_profile", "stop_profile": "stop_profile",
    "cancellations": "cancellations", "network_profile": "network", "data_quality": "quality",
    "school_calendar": "school", "forecast_quality": "forecast", "directions": "names",
}
register(
    "snk4_export_marts",
    _export_marts,
    " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS rows FROM {t}" for n, t in _EXPORTED.items())
    + " UNION ALL SELECT 'lines', count(DISTINCT route_id) FROM lines",
)


def _document_text(df: DataFrame, arrays: list[str], keys: list[str]) -> DataFrame:
    """Arrays as text with NULL spelled out, so that a document is one comparable row."""
    def text(name: str):
        return F.array_join(F.transform(name, lambda x: F.coalesce(x.cast("string"), F.lit("-"))), ",").alias(name)

    return df.select(*keys, *[text(a) for a in arrays])


register(
    "snk5_export_columnar_json",
    lambda c: _document_text(
        sinks.columnar(
            sinks.dates_as_text(c.mart("line_profile")),
            ["route_id"],
            ["service_day", "direction"],
            ["service_day", "direction", "planned_stops", "assessable_stops", "on_time_3min"],
        ),
        ["service_day", "direction", "planned_stops", "assessable_stops", "on_time_3min"],
        ["route_id"],
    ),
    "SELECT route_id, "
    + ", ".join(
        f"string_agg(coalesce(CAST({f} AS VARCHAR), '-'), ',' ORDER BY service_day, direction NULLS LAST) AS {f}"
        for f in ("service_day", "direction", "planned_stops", "assessable_stops", "on_time_3min")
    )
    + " FROM line_profile GROUP BY 1",
)


_DOCUMENT = ["service_day", "direction", "planned_stops", "assessable_stops"]


def _documents_read_back(c: Context, document: DataFrame, name: str, kinds: str, keys: list[str], arrays: list[str]) -> DataFrame:
    """Documents written as JSON by year and read again."""
    folder = f"{c.store.root}/documents/{name}"
    sinks.export_columnar_json(document, folder, "year")
    return _document_text(c.spark.read.schema(f"{kinds}, year int").json(folder), arrays, [*keys, "year"])


register(
    "snk5_line_documents",
    lambda c: _documents_read_back(
        c, sinks.line_document(c.mart("line_profile")), "lines",
        "route_id string, service_day array<string>, direction array<int>, planned_stops array<bigint>, assessable_stops array<bigint>", ["route_id"], _DOCUMENT),
    "SELECT route_id, CAST(year(service_day) AS INTEGER) AS year, "
    + ", ".join(f"string_agg(coalesce(CAST({f} AS VARCHAR), '-'), ',' ORDER BY service_day, direction NULLS LAST) AS {f}" for f in _DOCUMENT)
    + " FROM line_profile GROUP BY 1, 2",
)
register(
    "snk5_network_documents",
    lambda c: _documents_read_back(
        c, sinks.network_document(c.mart("network_profile")), "network",
        "service_day array<string>, mode array<string>, planned_stops array<bigint>, lines array<bigint>", [], ["service_day", "mode", "planned_stops", "lines"]),
    "SELECT CAST(year(service_day) AS INTEGER) AS year, "
    + ", ".join(f"string_agg(CAST({f} AS VARCHAR), ',' ORDER BY service_day, mode) AS {f}" for f in ("service_day", "mode", "planned_stops", "lines"))
    + " FROM network GROUP BY 1",
)


def _lookup(c: Context) -> DataFrame:
    """The holiday list written as CSV and read back with explicit types."""
    path = f"{c.store.root}/school_holidays.csv"
    c.holidays.select(
        "state",
        F.lit("holiday").alias("kind"),
        "name",
        "first_day",
        "last_day",
        F.lit("derived").alias("origin"),
    ).write.mode("overwrite").option("header", True).csv(path)
    return scan.holiday_lookup(c.spark, path)


register("seed1_read_lookup", _lookup, "SELECT * FROM holidays", "first_day last_day")

# -- functions -------------------------------------------------------------------------------------

register("fn1_normalise_report", lambda c: staging.normalise_report(c.raw.raw_reports),
         "SELECT * FROM staged_reports", "actual_arr actual_dep observed_at day_in_feed")
register("fn2_local_time",
         lambda c: c.raw.raw_reports.select("observed_at", tm.local_time(F.col("observed_at")).alias("local")).distinct(),
         "SELECT DISTINCT observed_at, timezone('Europe/Berlin', to_timestamp(observed_at)) AS local FROM raw_reports", "local")
register("fn3_feed_day",
         lambda c: c.raw.raw_reports.select("betriebstag", tm.feed_day(F.col("betriebstag")).alias("day")).distinct(),
         "SELECT DISTINCT betriebstag, CASE WHEN length(betriebstag) = 8 THEN CAST(strptime(betriebstag, '%Y%m%d') AS DATE) END AS day FROM raw_reports", "day")
register("fn4_gtfs_seconds",
         lambda c: c.raw.raw_stop_times.select("departure_time", tm.gtfs_seconds(tx.clean(F.col("departure_time"))).alias("sec")).distinct(),
         f"SELECT DISTINCT departure_time, {ob.gtfs("nullif(departure_time, '')")} AS sec FROM raw_stop_times")
register("fn5_planned_timestamp",
         lambda c: c.first.planned.select("service_day", "trip_id", "stop_sequence", "planned_arr", "planned_dep"),
         "SELECT service_day, trip_id, stop_sequence, planned_arr, planned_dep FROM planned", "service_day planned_arr planned_dep")
register("fn6_service_hour",
         lambda c: c.first.states.groupBy("service_day", "service_hour").agg(F.count("*").alias("stops")),
         "SELECT service_day, service_hour, count(*) AS stops FROM frame GROUP BY 1, 2", "service_day")
register("fn7_service_hour_start",
         lambda c: c.first.states.where(F.col("service_hour").isNotNull()).select(
             "service_day", "service_hour",
             tm.service_hour_start(F.col("service_day"), F.col("service_hour")).alias("hour_start"),
             tm.clock_hour(F.coalesce("planned_dep", "planned_arr")).alias("clock_hour")).distinct(),
         """SELECT DISTINCT service_day, service_hour, CAST(service_day AS TIMESTAMP) + service_hour * INTERVAL 1 HOUR AS hour_start,
            date_trunc('hour', coalesce(planned_dep, planned_arr)) AS clock_hour FROM frame WHERE service_hour IS NOT NULL""",
         "service_day hour_start clock_hour")
register("fn8_service_day",
         lambda c: c.first.reports.groupBy("service_day", "day_estimated").agg(F.count("*").alias("reports")),
         "SELECT service_day, day_estimated, count(*) AS reports FROM reports GROUP BY 1, 2", "service_day")
register("fn9_station_key",
         lambda c: staging.stage_stops(c.raw.raw_stops).select("stop_id", "parent_station", "station_source", "station_id").distinct(),
         "SELECT DISTINCT stop_id, parent AS parent_station, station_source, station_id FROM stops")
register("fn10_station_name",
         lambda c: c.raw.raw_stops.select("stop_name", tx.station_name(F.col("stop_name")).alias("station_name")).distinct(),
         "SELECT DISTINCT stop_name, station_name FROM stops")
register("fn11_mode_of", lambda c: staging.stage_lines(c.raw.raw_routes), "SELECT * FROM lines", "schedule_version")
register("fn12_tolerant_cast",
         lambda c: c.raw.raw_stops.select("stop_lat", vl.tolerant_cast(F.col("stop_lat"), "double").alias("lat")).distinct()
         .join(c.raw.raw_stops.groupBy("stop_lat").agg(F.count("*").alias("stops")), "stop_lat"),
         "SELECT stop_lat, TRY_CAST(stop_lat AS DOUBLE) AS lat, count(*) AS stops FROM raw_stops GROUP BY 1, 2")
register("fn13_calendar_long",
         lambda c: staging.calendar_long(c.raw.raw_calendar, c.raw.raw_calendar_dates),
         "SELECT * FROM calendar", "schedule_version start_date end_date exception_date")
register("fn14_stop_state",
         lambda c: c.first.states.groupBy("service_day", "state").agg(F.count("*").alias("stops")),
         "SELECT service_day, state, count(*) AS stops FROM states GROUP BY 1, 2", "service_day")
register("fn15_is_assessable",
         lambda c: c.first.states.groupBy(vl.is_assessable(F.col("state")).alias("assessable")).agg(F.count("*").alias("stops")),
         "SELECT state IN ('measured', 'departure_only') AS assessable, count(*) AS stops FROM states GROUP BY 1")
register("fn16_line_short",
         lambda c: c.lines.select("line", tx.line_short(F.col("line"), OPERATOR_PREFIX).alias("line_short")).distinct(),
         "SELECT DISTINCT line, regexp_replace(regexp_replace(line, '^Net ', ''), '^Moonliner ', 'M') AS line_short FROM lines")
register("fn17_slug",
         lambda c: c.lines.select("route_id", tx.slug(F.col("route_id")).alias("slug")).distinct(),
         "SELECT DISTINCT route_id, trim(regexp_replace(lower(route_id), '[^a-z0-9]+', '-', 'g'), '-') AS slug FROM lines")
register("fn17_assert_slug_unique",
         lambda c: checks.assert_slug_unique(c.lines),
         """SELECT slug, count(*) AS keys, min(route_id) AS example FROM (SELECT DISTINCT route_id,
            trim(regexp_replace(lower(route_id), '[^a-z0-9]+', '-', 'g'), '-') AS slug FROM lines) GROUP BY 1 HAVING count(*) > 1""")
def _natural_order(c: Context) -> DataFrame:
    from pyspark.sql import Window

    order = Window.partitionBy("mode").orderBy(*tx.natural_order(F.col("mode"), F.col("line"))[1:])
    names = c.lines.select("mode", "line").distinct()
    return names.withColumn("place", F.row_number().over(order).cast("long"))


register("fn18_natural_order", _natural_order,
         """SELECT mode, line, row_number() OVER (PARTITION BY mode ORDER BY TRY_CAST(nullif(regexp_extract(line, '[0-9]+'), '') AS BIGINT) NULLS LAST, line) AS place
            FROM (SELECT DISTINCT mode, line FROM lines)""")
register("fn19_round1",
         lambda c: c.mart("network_profile").select("service_day", "mode", vl.round1(F.col("delay_mean_sec")).alias("delay_1")),
         "SELECT service_day, mode, trunc(delay_mean_sec * 10 + 0.5) / 10.0 AS delay_1 FROM network", "service_day")
register("fn20_safe_ratio",
         lambda c: c.mart("line_profile").select("service_day", *LINE_DIR, vl.safe_ratio(F.col("on_time_3min"), F.col("assessable_stops")).alias("share")),
         "SELECT service_day, route_id, direction, CAST(on_time_3min AS DOUBLE) / nullif(assessable_stops, 0) AS share FROM line_profile", "service_day")
register("fn23_day_kind",
         lambda c: c.fact.select("service_day", tm.day_kind(F.col("service_day")).alias("kind"), tm.is_weekend(F.col("service_day")).alias("weekend")).distinct(),
         """SELECT DISTINCT service_day, CASE dayofweek(service_day) WHEN 0 THEN 'sunday' WHEN 6 THEN 'saturday' ELSE 'weekday' END AS kind,
            dayofweek(service_day) IN (0, 6) AS weekend FROM fact""", "service_day")
register("fn24_trip_group",
         lambda c: c.first.all_trips.groupBy(tx.trip_group(F.col("trip_id")).alias("id_group"), tx.special_no(F.col("trip_id")).alias("special_no")).agg(F.count("*").alias("trips")),
         """SELECT regexp_replace(trip_id, '-[0-9]+-[0-9]+$', '') AS id_group, nullif(regexp_extract(trip_id, 'Special#([0-9]+)-', 1), '') AS special_no,
            count(*) AS trips FROM trips GROUP BY 1, 2""")
register("fn25_run_label",
         lambda c: c.first.axis_per_version.groupBy(tx.run_label(F.lit("first"), F.col("schedule_version")).alias("run_id")).agg(F.count("*").alias("stations")),
         "SELECT 'first ' || CAST(schedule_version AS VARCHAR) AS run_id, count(*) AS stations FROM axis GROUP BY 1")
def _findings(c: Context) -> DataFrame:
    return c.mart("data_quality").select(
        F.concat(
            F.lit("day "), F.col("service_day").cast("string"), F.lit(": coverage "), F.col("planned_stops"), F.lit(",5")
        ).alias("finding")
    )


register("fn26_finding_key",
         lambda c: _findings(c).groupBy(tx.finding_key(F.col("finding")).alias("key")).agg(F.count("*").alias("findings")),
         """SELECT regexp_replace('day ' || CAST(service_day AS VARCHAR) || ': coverage ' || CAST(planned_stops AS VARCHAR) || ',5', '[0-9]+([.,][0-9]+)?', '#', 'g') AS key,
            count(*) AS findings FROM quality GROUP BY 1""")


register("fn27_municipality_state",
         lambda c: municipality.municipality_state(c.first.stop_times),
         """SELECT substr(split_part(stop_id, ':', 2), 1, 2) AS region, count(*) AS planned_stops,
            round(CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM stop_times), 3) AS share FROM stop_times GROUP BY 1""")

# -- joins -----------------------------------------------------------------------------------------

FRAME = ["service_day", "schedule_version", "version_substituted", "trip_id", "stop_id", "stop_sequence", "planned_arr", "planned_dep"]
FRAME_DATES = "service_day schedule_version planned_arr planned_dep"
OBSERVED = ["service_hour", "actual_arr", "actual_dep", "delay_arr", "delay_dep", "stop_relationship", "trip_relationship", "observed_at"]

register("jn1_planned_x_observed", lambda c: c.first.frame.select(*FRAME, *OBSERVED), "SELECT * FROM frame",
         FRAME_DATES + " actual_arr actual_dep observed_at")
register("jn2_with_trip_cancellation",
         lambda c: frame.with_trip_cancellation(c.first.trips_of_day, c.first.cancelled)
         .where(F.col("trip_relationship").isNotNull()).select("service_day", "trip_id", "trip_relationship"),
         """SELECT t.service_day, t.trip_id, 'CANCELED' AS trip_relationship FROM trips_of_day t WHERE EXISTS (SELECT 1 FROM cancelled f
            WHERE f.cancelled AND f.trip_id = t.trip_id AND (f.day_in_feed = t.service_day OR f.day_in_feed IS NULL))""", "service_day")
register("jn3_active_services", lambda c: frame.active_services(c.first.days, c.first.calendar), "SELECT * FROM regular", "service_day schedule_version")
register("jn4_calendar_exceptions",
         lambda c: frame.calendar_exceptions(c.first.days, c.first.calendar, 1).withColumn("kind", F.lit(1)).unionByName(
             frame.calendar_exceptions(c.first.days, c.first.calendar, 2).withColumn("kind", F.lit(2))),
         "SELECT *, 1 AS kind FROM added UNION ALL SELECT *, 2 FROM removed", "service_day schedule_version")
register("jn5_scheduled_trips", lambda c: c.first.scheduled, "SELECT * FROM scheduled", "service_day schedule_version")
register("jn6_with_observed_trips", lambda c: c.first.trips_of_day, "SELECT * FROM trips_of_day", "service_day schedule_version")
register("jn7_planned_stops", lambda c: c.first.planned.select(*FRAME),
         """SELECT p.* FROM planned p JOIN trips t ON t.trip_id = p.trip_id AND t.schedule_version = p.schedule_version""", FRAME_DATES)
register("jn8_version_candidates", lambda c: versions.version_candidates(versions.observed_days(c.first.reports), c.first.all_trips),
         "SELECT * FROM candidates", "service_day schedule_version")
register("jn9_asof_version", lambda c: versions.asof_version(c.second.days.select("service_day"), c.first.all_trips),
         """SELECT service_day, coalesce((SELECT max(schedule_version) FROM trips f WHERE f.schedule_version <= t.service_day),
            (SELECT min(schedule_version) FROM trips)) AS schedule_version,
            (SELECT max(schedule_version) FROM trips f WHERE f.schedule_version <= t.service_day) IS NULL AS substituted FROM days2 t""",
         "service_day schedule_version")
register("jn10_capture_join", lambda c: capture.capture_join(capture.expected_hours(c.first.states), c.first.collected_hours),
         "SELECT * FROM gaps", "service_day")
register("jn11_state_join",
         lambda c: capture.state_join(c.first.frame, c.first.collected_hours).select("service_day", "trip_id", "stop_id", "stop_sequence", "service_hour", "state"),
         "SELECT service_day, trip_id, stop_id, stop_sequence, service_hour, state FROM states", "service_day")
register("jn12_source_takeover", lambda c: c.fact_first.groupBy("service_day", "route_id").agg(F.count("*").alias("planned_stops")),
         "SELECT service_day, route_id, count(*) AS planned_stops FROM fact_first GROUP BY 1, 2", "service_day")
register("jn13_bridge_lines", lambda c: facts.bridge_lines(c.second.all_trips, c.second.lines, c.takeover).select("trip_id", "service_id", "schedule_version", "route_id"),
         "SELECT trip_id, service_id, schedule_version, route_id FROM trips2b", "schedule_version")
register("jn14_enrich_station",
         lambda c: c.fact.select("source", "stop_id", "station_id", "stop_name", "schedule_version").distinct(),
         "SELECT DISTINCT source, stop_id, station_id, stop_name, schedule_version FROM fact", "schedule_version")
register("jn15_nullsafe_join",
         lambda c: ax.nullsafe_join(c.direction_names.select(*LINE_DIR, "direction_name"), c.stop_axis, LINE_DIR),
         """SELECT n.route_id, n.direction, n.direction_name, a.station_id, CAST(a.position AS INTEGER) AS position FROM names n
            JOIN stop_axis a ON a.route_id = n.route_id AND a.direction IS NOT DISTINCT FROM n.direction""")
register("jn16_nullsafe_anti",
         lambda c: ax.nullsafe_join(c.shown.select(*LINE_DIR, "station_id"), c.stop_axis.select(*LINE_DIR, "station_id"), [*LINE_DIR, "station_id"], "left_anti"),
         """SELECT DISTINCT route_id, direction, station_id FROM stop_profile h WHERE NOT EXISTS (SELECT 1 FROM stop_axis a
            WHERE a.route_id = h.route_id AND a.direction IS NOT DISTINCT FROM h.direction AND a.station_id = h.station_id)""")
register("jn17_interval_join_holidays", lambda c: holidays.interval_join_holidays(c.fact.select("service_day").distinct(), c.holidays),
         "SELECT * FROM day_state", "service_day listed_until")
register("jn18_overlap_self_join", lambda c: holidays.overlap_self_join(c.holidays),
         """SELECT a.state, b.first_day AS first_b, a.name AS name_a, a.first_day AS first_a, a.last_day AS last_a, b.name AS name_b, b.last_day AS last_b
            FROM holidays a JOIN holidays b ON b.state = a.state AND b.first_day > a.first_day AND b.first_day <= a.last_day""",
         "first_a last_a first_b last_b")
register("jn19_forecast_asof_join", lambda c: c.forecast_history, "SELECT * FROM history", "service_day observed_final")
register("jn20_allow_list_filter",
         lambda c: versions.allow_list_filter(c.first.reports, versions.allow_list(c.first.all_trips, 7)).groupBy("service_day").agg(F.count("*").alias("reports")),
         """SELECT service_day, count(*) AS reports FROM reports WHERE trip_id IN (SELECT trip_id FROM trips WHERE schedule_version IN
            (SELECT DISTINCT schedule_version FROM trips ORDER BY 1 DESC LIMIT 7)) GROUP BY 1""", "service_day")
_M = ["planned_stops", "assessable_stops"]
register("jn21_full_reconcile",
         lambda c: rollup.full_reconcile(
             c.mart("line_profile").groupBy("service_day", "mode").agg(*[F.sum(m).alias(m) for m in _M]),
             c.mart("network_profile"), ["service_day", "mode"], _M),
         """SELECT coalesce(a.service_day, b.service_day) AS service_day, coalesce(a.mode, b.mode) AS mode, a.planned_stops AS planned_stops_a,
            a.assessable_stops AS assessable_stops_a, b.planned_stops AS planned_stops_b, b.assessable_stops AS assessable_stops_b
            FROM (SELECT service_day, mode, CAST(sum(planned_stops) AS BIGINT) AS planned_stops, CAST(sum(assessable_stops) AS BIGINT) AS assessable_stops
                  FROM line_profile GROUP BY 1, 2) a FULL JOIN network b ON b.service_day = a.service_day AND b.mode = a.mode
            WHERE a.planned_stops IS DISTINCT FROM b.planned_stops OR a.assessable_stops IS DISTINCT FROM b.assessable_stops""", "service_day")


def _bridge(c: Context) -> DataFrame:
    a, b = c.first, c.second
    return diagnostics.one_to_one_bridge(
        diagnostics.bridge_keys(a.all_trips, a.lines, a.stop_times, a.stops, OPERATOR_PREFIX),
        diagnostics.bridge_keys(b.all_trips, b.lines, b.stop_times, b.stops),
    )


_BRIDGE = """SELECT DISTINCT t.trip_id, {line} AS line_key, f.dep_sec, h.station_id FROM {trips} t
    JOIN {lines} l ON l.route_id = t.route_id AND l.schedule_version = t.schedule_version
    JOIN (SELECT trip_id, schedule_version, dep_sec, stop_id FROM {st} QUALIFY row_number() OVER (PARTITION BY trip_id, schedule_version ORDER BY stop_sequence) = 1) f
      ON f.trip_id = t.trip_id AND f.schedule_version = t.schedule_version
    JOIN {stops} h ON h.stop_id = f.stop_id AND h.schedule_version = f.schedule_version"""
_SHORT = "regexp_replace(regexp_replace(l.line, '^Net ', ''), '^Moonliner ', 'M')"
register("jn22_one_to_one_bridge", _bridge,
         f"""SELECT count(*) FILTER (WHERE na IS NOT NULL AND nb IS NOT NULL) AS common, count(*) FILTER (WHERE na = 1 AND nb = 1) AS one_to_one,
             count(*) FILTER (WHERE nb IS NULL) AS only_first, count(*) FILTER (WHERE na IS NULL) AS only_second,
             CAST(sum(na) AS BIGINT) AS trips_first, CAST(sum(nb) AS BIGINT) AS trips_second
             FROM (SELECT line_key, dep_sec, station_id, count(*) AS na FROM ({_BRIDGE.format(line=_SHORT, trips='trips', lines='lines', st='stop_times', stops='stops')}) GROUP BY 1, 2, 3) a
             FULL JOIN (SELECT line_key, dep_sec, station_id, count(*) AS nb FROM ({_BRIDGE.format(line='l.line', trips='trips2', lines='lines2', st='stop_times2', stops='stops2')})
                   GROUP BY 1, 2, 3) b USING (line_key, dep_sec, station_id)""")


def _live(c: Context) -> DataFrame:
    """Ids of the live feed with their line, looked up in whatever version knows the trip."""
    named = c.first.all_trips.join(c.lines.select("route_id", "schedule_version", "line"), ["route_id", "schedule_version"])
    lines = named.groupBy("trip_id").agg(F.min("line").alias("line"))
    return c.first.seen.select("trip_id").distinct().join(lines, "trip_id").select("line", "trip_id")


_LIVE = """SELECT DISTINCT r.trip_id, n.line FROM reports r JOIN (SELECT t.trip_id, min(l.line) AS line FROM trips t
    JOIN lines l ON l.route_id = t.route_id AND l.schedule_version = t.schedule_version GROUP BY 1) n ON n.trip_id = r.trip_id"""
_NEWEST7 = "(SELECT DISTINCT schedule_version FROM trips ORDER BY 1 DESC LIMIT 7)"
register("jn23_id_in_versions",
         lambda c: diagnostics.id_in_versions(_live(c), c.first.all_trips, versions.allow_list(c.first.all_trips, 7)),
         f"""SELECT a.line, a.live, a.in_list, a.in_any_version, b.groups_live, b.groups_known FROM
             (SELECT line, count(*) AS live, count(*) FILTER (WHERE trip_id IN (SELECT trip_id FROM trips WHERE schedule_version IN {_NEWEST7})) AS in_list,
                     count(*) FILTER (WHERE trip_id IN (SELECT trip_id FROM trips)) AS in_any_version FROM ({_LIVE}) GROUP BY 1) a
             JOIN (SELECT line, count(*) AS groups_live, count(*) AS groups_known FROM
                   (SELECT DISTINCT line, regexp_replace(trip_id, '-[0-9]+-[0-9]+$', '') AS g FROM ({_LIVE})) GROUP BY 1) b ON b.line = a.line""")
register("jn23_hits_per_version", lambda c: diagnostics.hits_per_version(_live(c), c.first.all_trips),
         f"SELECT v.line, t.schedule_version, count(DISTINCT v.trip_id) AS hits FROM ({_LIVE}) v JOIN trips t ON t.trip_id = v.trip_id GROUP BY 1, 2", "schedule_version")
register("jn24_dimension_join",
         lambda c: marts.dimension_join(
             c.fact.groupBy("route_id", "direction", "schedule_version").agg(F.count("*").alias("planned_stops")),
             c.lines, c.direction_names, c.on_demand),
         """SELECT b.route_id, b.schedule_version, b.direction, b.planned_stops, l.line, l.route_text, l.mode, r.direction_name, r.name_rule,
            d.route_id IS NOT NULL AS on_demand FROM (SELECT route_id, direction, schedule_version, count(*) AS planned_stops FROM fact GROUP BY 1, 2, 3) b
            JOIN lines l ON l.route_id = b.route_id AND l.schedule_version = b.schedule_version
            LEFT JOIN names r ON r.route_id = b.route_id AND r.direction = b.direction LEFT JOIN on_demand d ON d.route_id = b.route_id""", "schedule_version")

# -- set operations --------------------------------------------------------------------------------

register("set1_calendar_set", lambda c: c.first.services, "SELECT * FROM services", "service_day schedule_version")
register("set2_union_sources",
         lambda c: facts.union_sources(c.fact_first, c.fact_second).groupBy("source", "service_day", "state").agg(F.count("*").alias("planned_stops")),
         "SELECT source, service_day, state, count(*) AS planned_stops FROM fact GROUP BY 1, 2, 3", "service_day")


def _stability(column: str) -> str:
    kind = column.removesuffix("_id")
    return f"""(SELECT a.v, a.nx, a.n AS {kind}s_before, b.n AS {kind}s_after,
        (SELECT count(*) FROM (SELECT {column} FROM trips WHERE schedule_version = a.v INTERSECT SELECT {column} FROM trips WHERE schedule_version = a.nx)) AS {kind}s_common
        FROM (SELECT v, n, lead(v) OVER (ORDER BY v) AS nx FROM (SELECT schedule_version AS v, count(DISTINCT {column}) AS n FROM trips GROUP BY 1)) a
        JOIN (SELECT schedule_version AS v, count(DISTINCT {column}) AS n FROM trips GROUP BY 1) b ON b.v = a.nx)"""


register("set3_id_stability", lambda c: versions.id_stability(c.first.all_trips),
         f"""SELECT t.v AS schedule_version, t.nx AS next_version, trips_before, trips_after, trips_common, CAST(trips_common AS DOUBLE) / trips_before AS trips_share,
             routes_before, routes_after, routes_common, CAST(routes_common AS DOUBLE) / routes_before AS routes_share
             FROM {_stability('trip_id')} t JOIN {_stability('route_id')} r ON r.v = t.v""", "schedule_version next_version")
register("set4_namespace_overlap", lambda c: versions.namespace_overlap(
             c.first.stops.select(F.col("station_id").alias("id")), c.second.stops.select(F.col("station_id").alias("id")), "id"),
         """SELECT count(*) FILTER (WHERE a AND b) AS common, count(*) FILTER (WHERE a AND NOT b) AS only_first, count(*) FILTER (WHERE b AND NOT a) AS only_second
            FROM (SELECT id, bool_or(s = 1) AS a, bool_or(s = 2) AS b FROM (SELECT station_id AS id, 1 AS s FROM stops UNION ALL SELECT station_id, 2 FROM stops2) GROUP BY 1)""")
register("set5_allow_list", lambda c: versions.allow_list(c.first.all_trips, 7),
         f"""SELECT trip_id, route_id, service_id, direction, schedule_version FROM trips WHERE schedule_version IN {_NEWEST7}
             QUALIFY row_number() OVER (PARTITION BY trip_id ORDER BY schedule_version DESC) = 1""", "schedule_version")
register("set5_allow_list_counts", lambda c: versions.allow_list_counts(c.first.all_trips, 7),
         f"""SELECT count(*) AS trips, count(*) FILTER (WHERE v = m) AS from_newest, count(*) FILTER (WHERE v < m) AS added_by_older, count(DISTINCT v) AS versions_used
             FROM (SELECT trip_id, max(schedule_version) AS v, (SELECT max(schedule_version) FROM trips) AS m FROM trips WHERE schedule_version IN {_NEWEST7} GROUP BY 1)""")
