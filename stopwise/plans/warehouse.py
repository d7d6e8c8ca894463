"""The layers of the warehouse.

`raw` is anything with the raw tables as attributes: the adapter over the driver's tables,
or scans of real files. `keep(name, build)` decides whether a layer is written and read back
(`TableStore.keep`) or stays part of the reader's plan (`lazy`).
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopwise.operators import axis as ax
from stopwise.operators import capture, direction, facts, forecast, frame, holidays, marts, staging, versions
from stopwise.sources.store import lazy


class Source:
    """Staging, frame and states of one source."""

    def __init__(self, name: str, raw, stage_stops, min_trips: int, keep, bridge=None, start=None, per_version=None):
        self.name = name
        self.raw = raw
        self.stage_stops = stage_stops
        self.min_trips = min_trips
        self.bridge = bridge
        self.start = start
        self._keep = keep
        self._per_version = per_version

    def keep(self, layer: str, build) -> DataFrame:
        return self._keep(f"{self.name}_{layer}", build)

    @cached_property
    def reports(self) -> DataFrame:
        return self.keep(
            "reports",
            lambda: staging.with_service_day(staging.normalise_report(self.raw("reports"))),
        )

    @cached_property
    def all_trips(self) -> DataFrame:
        return self.keep("trips", lambda: staging.stage_trips(self.raw("trips")))

    @cached_property
    def lines(self) -> DataFrame:
        return self.keep("lines", lambda: staging.stage_lines(self.raw("routes")))

    @cached_property
    def stop_times(self) -> DataFrame:
        return self.keep("stop_times", lambda: staging.stage_stop_times(self.raw("stop_times")))

    @cached_property
    def stops(self) -> DataFrame:
        return self.keep("stops", lambda: self.stage_stops(self.raw("stops")))

    @cached_property
    def calendar(self) -> DataFrame:
        return self.keep(
            "calendar", lambda: staging.calendar_long(self.raw("calendar"), self.raw("calendar_dates"))
        )

    @cached_property
    def trips(self) -> DataFrame:
        """Trips that build a frame: all, or only those of the taken-over lines."""
        if self.bridge is None:
            return self.all_trips
        return self.keep(
            "bridged_trips", lambda: facts.bridge_lines(self.all_trips, self.lines, self.bridge())
        )

    @cached_property
    def seen(self) -> DataFrame:
        """Trips by day; an incremental run looks at its window only, and all days follow from here."""
        seen = versions.observed_trips(self.reports)
        return seen if self.start is None else seen.where(F.col("service_day") >= F.lit(self.start))

    @cached_property
    def chosen_versions(self) -> DataFrame:
        return self.keep(
            "chosen_versions",
            lambda: versions.choose_version(self.seen, self.all_trips, self.min_trips),
        )

    @cached_property
    def days(self) -> DataFrame:
        return versions.day_versions(self.chosen_versions)

    @cached_property
    def services(self) -> DataFrame:
        return frame.calendar_set(self.days, self.calendar)

    @cached_property
    def scheduled(self) -> DataFrame:
        return frame.scheduled_trips(self.services, self.trips)

    @cached_property
    def trips_of_day(self) -> DataFrame:
        seen = self.seen
        if self.bridge is not None:
            seen = seen.join(self.trips.select("trip_id"), "trip_id", "left_semi")
        listed = frame.trips_of_services(self.services, self.trips)
        return frame.with_observed_trips(listed, seen, self.days)

    @cached_property
    def cancelled(self) -> DataFrame:
        return frame.trip_cancelled(self.reports)

    @cached_property
    def planned_trips(self) -> DataFrame:
        """One row per trip and day with route, direction and cancellation."""
        return self.keep(
            "planned_trips",
            lambda: frame.with_trip_cancellation(
                frame.with_route(self.trips_of_day, self.trips), self.cancelled
            ),
        )

    @cached_property
    def planned(self) -> DataFrame:
        stop_times = facts.stops_with_station(frame.with_trip_head(self.stop_times), self.stops)
        return frame.planned_stops(self.planned_trips, stop_times)

    @cached_property
    def last_reports(self) -> DataFrame:
        return frame.last_report_per_stop(self.reports)

    @cached_property
    def frame(self) -> DataFrame:
        return frame.planned_x_observed(self.planned, self.last_reports)

    @cached_property
    def collected_hours(self) -> DataFrame:
        return capture.collected_hours(self.reports)

    @cached_property
    def states(self) -> DataFrame:
        return self.keep("states", lambda: capture.state_join(self.frame, self.collected_hours))

    @cached_property
    def capture_gaps(self) -> DataFrame:
        return capture.capture_gaps(self.states, self.reports)

    @cached_property
    def unmatched(self) -> DataFrame:
        return capture.unmatched_reports(self.reports, self.days, self.all_trips)

    @cached_property
    def runs(self) -> DataFrame:
        return ax.station_runs(self.trips, self.stop_times, self.stops)

    def per_version(self, layer: str, build) -> DataFrame:
        """`build(trips, stop_times, stops)`: from a store that builds each version once, or whole."""
        tables = (self.trips, self.stop_times, self.stops)
        if self._per_version is None:
            return build(*tables)
        return self._per_version(f"{self.name}_{layer}", self.trips, lambda only: build(*[only(t) for t in tables]))

    @cached_property
    def axis_per_version(self) -> DataFrame:
        build = lambda *tables: ax.stop_axis_per_version(ax.station_runs(*tables))
        if self._per_version is None:
            return self.keep("axis", lambda: build(self.trips, self.stop_times, self.stops))
        return self.per_version("axis", build)


class Warehouse:
    """Both sources, the fact table and the marts."""

    def __init__(self, raw, min_trips: int = versions.MIN_TRIPS, keep=lazy, start=None, per_version=None):
        """`start`: first service day of an incremental run; `per_version`: `VersionStore.layer`."""
        self.raw = raw
        self.keep = keep
        self.first = Source(
            "first", self._raw("raw", dated=True), staging.stage_stops, min_trips, keep, start=start, per_version=per_version
        )
        self.second = Source(
            "second",
            self._raw("second"),
            staging.stage_second_stops,
            min_trips,
            keep,
            bridge=lambda: self.takeover,
            start=start,
        )

    def _raw(self, prefix: str, dated: bool = False):
        """Raw tables by name, touched only when a layer has to be built from them."""
        tables = ["reports", "trips", "routes", "stop_times", "stops", "calendar"]
        tables += ["calendar_dates"] if dated else []
        return lambda name: getattr(self.raw, f"{prefix}_{name}") if name in tables else None

    def stage(self) -> None:
        """Stores the input layers of both sources side by side: they do not depend on each other, and each alone is too
        small a job for a cluster."""
        layers = ["reports", "stop_times", "all_trips", "stops", "lines", "calendar"]
        with ThreadPoolExecutor(len(layers)) as pool:
            wanted = [(source, layer) for layer in layers for source in (self.first, self.second)]
            for done in [pool.submit(getattr, source, layer) for source, layer in wanted]:
                done.result()

    # -- lookups ------------------------------------------------------------------------

    @cached_property
    def on_demand(self) -> DataFrame:
        return self.keep("on_demand", lambda: self.raw.on_demand)

    @cached_property
    def takeover(self) -> DataFrame:
        return self.keep("takeover", lambda: self.raw.second_source_lines)

    @cached_property
    def holidays(self) -> DataFrame:
        return self.keep("holidays", lambda: self.raw.holidays)

    @cached_property
    def lines(self) -> DataFrame:
        return self.first.lines

    # -- directions -----------------------------------------------------------------------

    @cached_property
    def trip_shapes(self) -> DataFrame:
        return self.first.per_version("trip_shapes", direction.trip_shape)

    @cached_property
    def direction_names(self) -> DataFrame:
        return self.keep("direction_names", lambda: direction.direction_names(self.trip_shapes))

    @cached_property
    def position_partials(self) -> DataFrame:
        return self.first.per_version("position_partials", direction.position_partials)

    @cached_property
    def end_pairs(self) -> DataFrame:
        return self.first.per_version("end_pairs", direction.end_pairs)

    @cached_property
    def second_runs(self) -> DataFrame:
        s = self.second
        return direction.runs_with_position(s.trips, s.stop_times, s.stops)

    @cached_property
    def takeover_positions(self) -> DataFrame:
        lines = self.takeover.select("route_id").distinct()
        return direction.position_mean(self.position_partials.join(lines, "route_id", "left_semi"))

    @cached_property
    def takeover_end_pairs(self) -> DataFrame:
        lines = self.takeover.select("route_id").distinct()
        return self.end_pairs.join(lines, "route_id", "left_semi")

    @cached_property
    def inferred_directions(self) -> DataFrame:
        return self.keep(
            "inferred_directions",
            lambda: direction.infer_direction(
                self.second_runs, self.takeover_positions, self.takeover_end_pairs
            ),
        )

    # -- fact -----------------------------------------------------------------------------

    @cached_property
    def taken_over_days(self) -> DataFrame:
        """Days and lines the second source reports, from stops with a known direction."""
        def build() -> DataFrame:
            known = self.inferred_directions.select("trip_id", "schedule_version")
            states = self.second.states.join(known, ["trip_id", "schedule_version"], "left_semi")
            return facts.taken_over_days(states)

        return self.keep("taken_over_days", build)

    @cached_property
    def shown_versions(self) -> DataFrame:
        """Version of the first source per day of the second source."""
        days = self.second.days.select("service_day")
        fallback = versions.asof_version(days, self.first.all_trips)
        chosen = self.first.chosen_versions.select(
            "service_day", F.col("schedule_version").alias("chosen")
        )
        return fallback.join(chosen, "service_day", "left").select(
            "service_day", F.coalesce("chosen", "schedule_version").alias("schedule_version")
        )

    @cached_property
    def fact_first(self) -> DataFrame:
        return facts.source_takeover(facts.first_source_rows(self.first.states), self.taken_over_days)

    @cached_property
    def fact_second(self) -> DataFrame:
        return facts.second_source_rows(
            self.second.states,
            self.inferred_directions,
            self.shown_versions,
            facts.station_names(self.first.stops),
        )

    @cached_property
    def fact(self) -> DataFrame:
        return self.keep("fact", lambda: facts.union_sources(self.fact_first, self.fact_second))

    # -- axis -----------------------------------------------------------------------------

    @cached_property
    def second_axis_per_version(self) -> DataFrame:
        def build() -> DataFrame:
            s = self.second
            directed = s.trips.drop("direction").join(
                self.inferred_directions.select("trip_id", "schedule_version", "direction"),
                ["trip_id", "schedule_version"],
            )
            return ax.stop_axis_per_version(ax.station_runs(directed, s.stop_times, s.stops))

        return self.keep("second_axis", build)

    @cached_property
    def stop_axis(self) -> DataFrame:
        return self.keep(
            "stop_axis",
            lambda: ax.stop_axis(self.first.axis_per_version, self.second_axis_per_version),
        )

    # -- marts ----------------------------------------------------------------------------

    @cached_property
    def line_profile(self) -> DataFrame:
        return marts.line_profile(self.fact, self.lines, self.direction_names, self.on_demand)

    @cached_property
    def hour_profile(self) -> DataFrame:
        return marts.hour_profile(self.fact)

    @cached_property
    def delay_growth(self) -> DataFrame:
        return marts.delay_growth(self.fact)

    @cached_property
    def stop_profile(self) -> DataFrame:
        return marts.stop_profile(self.fact, self.delay_growth, self.stop_axis)

    @cached_property
    def cancellations(self) -> DataFrame:
        return marts.cancellations(self.fact)

    @cached_property
    def network_profile(self) -> DataFrame:
        return marts.network_profile(self.fact, self.lines, self.on_demand)

    @cached_property
    def forecast_history(self) -> DataFrame:
        return forecast.forecast_asof_join(self.first.reports)

    @cached_property
    def forecast_quality(self) -> DataFrame:
        s = self.first
        return forecast.forecast_quality(self.forecast_history, s.chosen_versions, s.trips, s.lines)

    @cached_property
    def data_quality(self) -> DataFrame:
        return marts.data_quality(self.fact, self.first.capture_gaps, self.first.unmatched)

    @cached_property
    def school_calendar(self) -> DataFrame:
        days = self.fact.select("service_day").distinct()
        return holidays.school_calendar(days, self.holidays)

    MARTS = [
        "line_profile",
        "hour_profile",
        "stop_profile",
        "cancellations",
        "network_profile",
        "data_quality",
        "school_calendar",
        "forecast_quality",
    ]

    def mart(self, name: str) -> DataFrame:
        """A mart as stored table, for operators that read marts."""
        return self.keep(f"mart_{name}", lambda: getattr(self, name))
