"""Transit-shaped raw tables derived from the order and event tables.

The rules only use integer arithmetic on keys, so DuckDB can state the same tables.
Every table has the stored column names of the real raw files, and all text
peculiarities (blank ids, bad dates, times past 24:00) occur in it.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROUTES = 24
FIRST_SECOND_SOURCE_DAY = "1998-01-01"
ON_DEMAND_ROUTES = [5, 17]
TAKEN_OVER_ROUTES = [4, 10, 16]
SILENT_ROUTES = [4, 22]
OPERATOR_PREFIX = "Net"


def route_number(k: Column) -> Column:
    return k % ROUTES


def route_key(n: Column) -> Column:
    return F.concat(F.lit("de:net:"), F.lpad(n.cast("string"), 5, "0"), F.lit(":"))


def trip_key(k: Column) -> Column:
    return F.concat(F.lit("Special#"), k % 31, F.lit("-"), k, F.lit("-"), k % 4 + 1)


def direction_of(k: Column) -> Column:
    return F.floor(k / ROUTES) % 2


def stop_number(k: Column, j: Column) -> Column:
    """Station visited as j-th stop of trip k: rings, one branch and unlisted stops occur."""
    n = route_number(k)
    position = F.when(direction_of(k) == 0, j).otherwise(8 - j)
    position = F.when((n % 8 == 3) & (j == 7), 8 - position).otherwise(position)
    return (
        F.when((k % 5 == 0) & (position == 4), (n * 4 + 50) % 100)
        .when((k % 43 == 0) & (position == 2), n + 300)
        .otherwise(n * 4 + position)
    )


def station_text(s: Column) -> Column:
    return F.concat(
        F.lit("de:0"), s % 5 + 5, F.lpad((s % 40).cast("string"), 3, "0"), F.lit(":"), s
    )


def stop_key(s: Column, platform: Column) -> Column:
    return F.concat(station_text(s), F.lit(":"), platform, F.lit(":"), platform)


def second_stop_key(s: Column, platform: Column) -> Column:
    return F.concat(F.lit("x"), s, F.lit("-"), platform)


def planned_seconds(k: Column, j: Column) -> Column:
    return (F.floor(k / 48) % 24 * 3600 + j * 180 + 18000).cast("int")


def clock_text(seconds: Column) -> Column:
    def two(x: Column) -> Column:
        return F.lpad(x.cast("string"), 2, "0")

    return F.concat(
        two(F.floor(seconds / 3600)),
        F.lit(":"),
        two(F.floor(seconds / 60) % 60),
        F.lit(":"),
        two(seconds % 60),
    )


def _epoch(day: Column) -> Column:
    return F.unix_date(day).cast("long") * 86400


def _yyyymmdd(day: Column) -> Column:
    return F.date_format(day, "yyyyMMdd")


class DriverTables:
    """Raw feed, timetable and lookup tables for one scale-factor directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    # -- first source ---------------------------------------------------------------

    @cached_property
    def _orders(self) -> DataFrame:
        return self.table("orders").select(
            F.col("o_orderkey").alias("k"),
            F.to_date("o_orderdate").alias("day"),
            F.col("o_orderstatus").alias("status"),
        )

    @cached_property
    def _trip_versions(self) -> DataFrame:
        """(k, day, v): a tenth of the trips only has the ids of the version before, and a
        third is carried over into the next version."""
        quarter = F.to_date(F.trunc(F.date_sub("day", 3), "quarter"))
        main = F.when(F.col("k") % 10 == 7, F.add_months(quarter, -3)).otherwise(quarter)
        following = F.when(F.col("k") % 3 == 0, F.add_months(main, 3))
        return self._orders.select(
            "k", "day", F.explode(F.array_compact(F.array(main, following))).alias("v")
        )

    @cached_property
    def raw_trips(self) -> DataFrame:
        k = F.col("k")
        return self._trip_versions.select(
            trip_key(k).alias("trip_id"),
            route_key(route_number(k)).alias("route_id"),
            F.concat(F.lit("S"), _yyyymmdd(F.col("day"))).alias("service_id"),
            F.when(k % 97 == 0, "")
            .otherwise(direction_of(k).cast("string"))
            .alias("direction_id"),
            "v",
        )

    @cached_property
    def raw_routes(self) -> DataFrame:
        n = F.col("n")
        name = F.concat(
            F.lit(OPERATOR_PREFIX + " "),
            F.when(n % 8 == 7, "Moonliner ").otherwise(""),
            (n % 20).cast("string"),
        )
        long_name = F.when(n.isin(5, 11, 17), F.concat(F.lit("Ruftaxi Zone "), n)).otherwise(
            F.concat(F.lit("Terminal "), n, F.lit(" - Terminal "), n + 1)
        )
        kind = F.when(n % 3 == 0, 0).when(n % 3 == 1, 3).otherwise(7)
        return (
            self._trip_versions.select(route_number(F.col("k")).alias("n"), "v")
            .distinct()
            .select(
                route_key(n).alias("route_id"),
                name.alias("route_short_name"),
                long_name.alias("route_long_name"),
                kind.alias("route_type"),
                "v",
            )
        )

    @cached_property
    def _stop_rows(self) -> DataFrame:
        """Distinct planned stops (k, j)."""
        return (
            self.table("lineitem")
            .select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("j"))
            .distinct()
        )

    @cached_property
    def raw_stop_times(self) -> DataFrame:
        k, j = F.col("k"), F.col("j")
        seconds = planned_seconds(k, j)
        departure = (
            F.when(j == 7, "")
            .when((k % 401 == 0) & (j == 3), "xx:10:00")
            .otherwise(clock_text(seconds + 30))
        )
        return self._stop_rows.join(self._trip_versions, "k").select(
            trip_key(k).alias("trip_id"),
            stop_key(stop_number(k, j), j % 2 + 1).alias("stop_id"),
            j.alias("stop_sequence"),
            F.when((j == 1) & (k % 2 == 0), "").otherwise(clock_text(seconds)).alias("arrival_time"),
            departure.alias("departure_time"),
            "v",
        )

    @cached_property
    def _versions(self) -> Column:
        """All schedule versions as one array value; a calendar date each, so it stays short."""
        return self._trip_versions.agg(F.collect_set("v").alias("vs")).scalar()

    @cached_property
    def raw_stops(self) -> DataFrame:
        s, p = F.col("s"), F.col("p")
        degrees = F.lpad((s % 1000).cast("string"), 3, "0")
        parent = (
            F.when((s % 7 == 0) & (p == 1), F.concat(station_text(s), F.lit("_Parent")))
            .when(s % 7 == 0, "")
            .when(s % 3 == 0, station_text(s))
            .otherwise("")
        )
        lat = F.when(s % 17 == 0, "n/a").otherwise(
            F.concat(F.when((s % 14 == 0) & (p == 2), "50.").otherwise("49."), degrees)
        )
        return (
            self.table("supplier")
            .where(F.col("s_suppkey") % 13 != 0)
            .select(
                F.col("s_suppkey").alias("s"),
                F.explode(F.array(F.lit(1), F.lit(2))).alias("p"),
            )
            .select("s", "p", F.explode(self._versions).alias("v"))
            .select(
                stop_key(s, p).alias("stop_id"),
                F.concat(F.lit("Stop "), s % 97, F.lit(" Bstg. "), p).alias("stop_name"),
                lat.alias("stop_lat"),
                F.concat(F.lit("8."), degrees).alias("stop_lon"),
                parent.alias("parent_station"),
                "v",
            )
        )

    @cached_property
    def _service_dates(self) -> DataFrame:
        return self._trip_versions.select("day", "v").distinct()

    @cached_property
    def raw_calendar(self) -> DataFrame:
        day = F.col("day")
        number = F.dayofweek(day)  # 1 = Sunday
        second = F.when(F.dayofmonth(day) % 5 == 0, number % 7 + 1)
        names = ["sunday", "monday", "tuesday", "wednesday", "thursday", "friday", "saturday"]
        flags = [
            F.when((number == i + 1) | F.coalesce(second == i + 1, F.lit(False)), "1")
            .otherwise("0")
            .alias(name)
            for i, name in enumerate(names)
        ]
        return self._service_dates.select(
            F.concat(F.lit("S"), _yyyymmdd(day)).alias("service_id"),
            *flags,
            _yyyymmdd(day).alias("start_date"),
            _yyyymmdd(F.date_add(day, 6)).alias("end_date"),
            "v",
        )

    @cached_property
    def raw_calendar_dates(self) -> DataFrame:
        day = F.col("day")
        number = F.dayofmonth(day)

        def entry(divisor: int, shift: int, kind: str) -> Column:
            return F.when(
                number % divisor == 0,
                F.struct(F.date_add(day, shift).alias("d"), F.lit(kind).alias("t")),
            )

        rows = F.array_compact(F.array(entry(7, 2, "1"), entry(11, 0, "2"), entry(13, 0, "x")))
        return self._service_dates.select("day", "v", F.explode(rows).alias("e")).select(
            F.concat(F.lit("S"), _yyyymmdd(day)).alias("service_id"),
            _yyyymmdd(F.col("e.d")).alias("date"),
            F.col("e.t").alias("exception_type"),
            "v",
        )

    @cached_property
    def _report_rows(self) -> DataFrame:
        return self.table("lineitem").select(
            F.col("l_orderkey").alias("k"),
            F.col("l_linenumber").alias("j"),
            F.col("l_partkey").alias("part"),
            F.col("l_suppkey").alias("supp"),
            F.col("l_quantity").cast("int").alias("qty"),
            F.col("l_returnflag").alias("flag"),
            F.col("l_linestatus").alias("line_status"),
        )

    @cached_property
    def raw_reports(self) -> DataFrame:
        """Stop-level rows from lineitem and trip-level rows from orders, as one log."""
        k, j, part, flag = F.col("k"), F.col("j"), F.col("part"), F.col("flag")
        audible = ~route_number(k).isin(SILENT_ROUTES)
        day_text = (
            F.when(k % 50 == 0, "")
            .when(k % 211 == 0, F.substring(_yyyymmdd(F.col("day")), 1, 6))
            .otherwise(_yyyymmdd(F.col("day")))
        )
        trip = F.when(k % 13 == 0, F.concat(F.lit(" "), trip_key(k), F.lit(" "))).otherwise(trip_key(k))
        base = _epoch(F.col("day")) + planned_seconds(k, j) - 3600
        delay_arr = F.when(flag != "N", F.col("qty") * 12 - 150)
        delay_dep = F.when((flag != "R") & (part % 5 != 0), F.col("qty") * 12 - 120)
        stops = (
            self._report_rows.where((F.col("supp") % 9 != 0) & audible)
            .join(self._orders.where(audible), "k")
            .select(
                day_text.alias("betriebstag"),
                F.when(part % 199 == 0, " ").otherwise(trip).alias("trip_id"),
                stop_key(
                    stop_number(k, j), F.when(k % 61 == 0, 2 - j % 2).otherwise(j % 2 + 1)
                ).alias("stop_id"),
                F.when(k % 59 == 0, j + 1).otherwise(j).alias("stop_sequence"),
                F.when((F.col("line_status") == "O") & (part % 17 == 0), "SKIPPED")
                .otherwise("SCHEDULED")
                .alias("schedule_relationship"),
                delay_arr.alias("arrival_delay"),
                (base + delay_arr).alias("arrival_time"),
                delay_dep.alias("departure_delay"),
                (base + delay_dep).alias("departure_time"),
                (base - part % 40 * 60).alias("observed_at"),
            )
        )
        cancelled = (k % 10 == 0) & (F.col("status") == "F")
        offsets = F.when(k % 20 == 0, F.array(F.lit(0), F.lit(600))).otherwise(F.array(F.lit(0)))
        trips = (
            self._orders.where(audible & (cancelled | (k % 10 == 1)))
            .select("k", "day", F.explode(offsets).alias("shift"))
            .select(
                day_text.alias("betriebstag"),
                trip.alias("trip_id"),
                F.lit("").alias("stop_id"),
                F.lit(0).alias("stop_sequence"),
                F.when(k % 10 == 0, "CANCELED").otherwise("SCHEDULED").alias("schedule_relationship"),
                F.lit(None).cast("int").alias("arrival_delay"),
                F.lit(None).cast("long").alias("arrival_time"),
                F.lit(None).cast("int").alias("departure_delay"),
                F.lit(None).cast("long").alias("departure_time"),
                (_epoch(F.col("day")) + 14400 + F.col("shift")).alias("observed_at"),
            )
        )
        return stops.unionByName(trips)

    # -- second source --------------------------------------------------------------

    @cached_property
    def _second_orders(self) -> DataFrame:
        return self._orders.where(
            (F.col("k") % 6 == 4) & (F.col("day") >= F.to_date(F.lit(FIRST_SECOND_SOURCE_DAY)))
        ).withColumn("v", F.to_date(F.trunc("day", "quarter")))

    @cached_property
    def second_trips(self) -> DataFrame:
        k = F.col("k")
        return self._second_orders.select(
            F.concat(F.lit("x"), trip_key(k)).alias("trip_id"),
            F.concat(F.lit("x"), route_number(k)).alias("route_id"),
            F.concat(F.lit("X"), _yyyymmdd(F.col("day"))).alias("service_id"),
            F.lit("").alias("direction_id"),
            "v",
        )

    @cached_property
    def second_routes(self) -> DataFrame:
        n = F.col("n")
        return (
            self._second_orders.select(route_number(F.col("k")).alias("n"), "v")
            .distinct()
            .select(
                F.concat(F.lit("x"), n).alias("route_id"),
                (n % 20).cast("string").alias("route_short_name"),
                F.concat(F.lit("Terminal "), n).alias("route_long_name"),
                F.when(n % 3 == 0, 0).when(n % 3 == 1, 3).otherwise(7).alias("route_type"),
                "v",
            )
        )

    @cached_property
    def second_stop_times(self) -> DataFrame:
        k, j = F.col("k"), F.col("j")
        seconds = planned_seconds(k, j)
        return self._stop_rows.where(k % 6 == 4).join(self._second_orders, "k").select(
            F.concat(F.lit("x"), trip_key(k)).alias("trip_id"),
            second_stop_key(stop_number(k, j), j % 2 + 1).alias("stop_id"),
            j.alias("stop_sequence"),
            clock_text(seconds).alias("arrival_time"),
            clock_text(seconds + 30).alias("departure_time"),
            "v",
        )

    @cached_property
    def second_stops(self) -> DataFrame:
        s, p = F.col("s"), F.col("p")
        versions = self._second_orders.agg(F.collect_set("v").alias("vs")).scalar()
        return (
            self.table("supplier")
            .select(F.col("s_suppkey").alias("s"), F.explode(F.array(F.lit(1), F.lit(2))).alias("p"))
            .select("s", "p", F.explode(versions).alias("v"))
            .select(
                second_stop_key(s, p).alias("stop_id"),
                F.concat(F.lit("Stop "), s % 97).alias("stop_name"),
                F.concat(F.lit("49."), F.lpad((s % 1000).cast("string"), 3, "0")).alias("stop_lat"),
                F.concat(F.lit("8."), F.lpad((s % 1000).cast("string"), 3, "0")).alias("stop_lon"),
                F.lit("0").alias("location_type"),
                p.cast("string").alias("platform_code"),
                F.when(s % 4 != 0, station_text(s)).otherwise("").alias("parent_station"),
                "v",
            )
        )

    @cached_property
    def second_calendar(self) -> DataFrame:
        day = F.col("day")
        names = ["sunday", "monday", "tuesday", "wednesday", "thursday", "friday", "saturday"]
        copies = F.when(F.dayofmonth(day) % 6 == 0, F.array(F.lit(6), F.lit(2))).otherwise(
            F.array(F.lit(6))
        )
        return (
            self._second_orders.select("day", "v")
            .distinct()
            .select("day", "v", F.explode(copies).alias("length"))
            .select(
                F.concat(F.lit("X"), _yyyymmdd(day)).alias("service_id"),
                *[
                    F.when(F.dayofweek(day) == i + 1, "1").otherwise("0").alias(name)
                    for i, name in enumerate(names)
                ],
                _yyyymmdd(day).alias("start_date"),
                _yyyymmdd(F.date_add(day, F.col("length"))).alias("end_date"),
                "v",
            )
        )

    @cached_property
    def second_reports(self) -> DataFrame:
        k, j, part, flag = F.col("k"), F.col("j"), F.col("part"), F.col("flag")
        base = _epoch(F.col("day")) + planned_seconds(k, j) - 3600
        delay_arr = F.when(flag != "A", F.col("qty") * 6 - 60)
        delay_dep = F.when(part % 3 != 0, F.col("qty") * 6 - 30)
        return (
            self._report_rows.where((F.col("supp") % 10 != 0) & (k % 6 == 4))
            .join(self._second_orders.select("k", "day"), "k")
            .select(
                _yyyymmdd(F.col("day")).alias("betriebstag"),
                F.concat(F.lit("x"), trip_key(k)).alias("trip_id"),
                second_stop_key(stop_number(k, j), j % 2 + 1).alias("stop_id"),
                j.alias("stop_sequence"),
                F.when(part % 23 == 0, "SKIPPED").otherwise("SCHEDULED").alias("schedule_relationship"),
                delay_arr.alias("arrival_delay"),
                (base + delay_arr).alias("arrival_time"),
                delay_dep.alias("departure_delay"),
                (base + delay_dep).alias("departure_time"),
                (base - part % 30 * 60).alias("observed_at"),
            )
        )

    # -- lookups ----------------------------------------------------------------------

    @cached_property
    def on_demand(self) -> DataFrame:
        return self.raw_routes.where(
            F.col("route_id").isin([f"de:net:{n:05d}:" for n in ON_DEMAND_ROUTES])
        ).select("route_id").distinct()

    @cached_property
    def second_source_lines(self) -> DataFrame:
        """Lines of the first source that the second source takes over."""
        wanted = [f"de:net:{n:05d}:" for n in TAKEN_OVER_ROUTES]
        return (
            self.raw_routes.where(F.col("route_id").isin(wanted))
            .select(
                "route_id",
                F.regexp_replace("route_short_name", f"^{OPERATOR_PREFIX} ", "").alias("line_number"),
                F.when(F.col("route_type") == 0, "tram")
                .when(F.col("route_type") == 3, "bus")
                .otherwise("other")
                .alias("mode"),
            )
            .distinct()
        )

    @cached_property
    def holidays(self) -> DataFrame:
        """School holidays per state for every year in the data; one list ends early."""
        y = F.col("y")

        def period(state: str, name: str, start: tuple, end: tuple) -> Column:
            return F.struct(
                F.lit(state).alias("state"),
                F.concat(F.lit(name + " "), y).alias("name"),
                F.make_date(y, F.lit(start[0]), F.lit(start[1])).alias("first_day"),
                F.make_date(y, F.lit(end[0]), F.lit(end[1])).alias("last_day"),
            )

        # Holiday periods used in every year.
        periods = F.array(
            period("BW", "Summer", (7, 30), (9, 12)),
            period("BW", "Autumn", (10, 26), (10, 30)),
            period("BW", "Easter", (3, 30), (4, 3)),
            period("RP", "Summer", (6, 29), (8, 7)),
            period("RP", "Autumn", (10, 5), (10, 16)),
            period("HE", "Summer", (6, 29), (8, 7)),
            period("HE", "Autumn", (10, 5), (10, 17)),
            period("HE", "Late autumn", (10, 15), (10, 20)),
        )
        return (
            self._orders.select(F.year("day").alias("y"))
            .distinct()
            .select("y", F.explode(periods).alias("h"))
            .where((F.col("h.state") != "HE") | (y <= 1999))
            .select("h.*")
        )
