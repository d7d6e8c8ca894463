"""Explicit schemas of every stored table; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

S, I, L = T.StringType(), T.IntegerType(), T.LongType()


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields.items()])


REPORT = struct(
    betriebstag=S,
    trip_id=S,
    stop_id=S,
    stop_sequence=I,
    schedule_relationship=S,
    arrival_delay=I,
    arrival_time=L,
    departure_delay=I,
    departure_time=L,
    observed_at=L,
)
ROUTES = struct(route_id=S, route_short_name=S, route_long_name=S, route_type=I)
TRIPS = struct(trip_id=S, route_id=S, service_id=S, direction_id=S)
STOP_TIMES = struct(trip_id=S, stop_id=S, stop_sequence=I, arrival_time=S, departure_time=S)
STOPS = struct(
    stop_id=S, stop_name=S, stop_lat=S, stop_lon=S, location_type=S, platform_code=S, parent_station=S
)
CALENDAR = struct(
    service_id=S,
    monday=S,
    tuesday=S,
    wednesday=S,
    thursday=S,
    friday=S,
    saturday=S,
    sunday=S,
    start_date=S,
    end_date=S,
)
CALENDAR_DATES = struct(service_id=S, date=S, exception_type=S)

_EVENT = struct(delay=I, time=L)
STOP_UPDATE = struct(
    stopId=S, stopSequence=I, scheduleRelationship=S, arrival=_EVENT, departure=_EVENT
)
TRIP = struct(tripId=S, startDate=S, startTime=S, scheduleRelationship=S)
ENTITY = struct(
    id=S,
    tripUpdate=struct(trip=TRIP, stopTimeUpdate=T.ArrayType(STOP_UPDATE)),
    alert=struct(effect=S),
)
FEED = struct(header=struct(timestamp=L), poll=L, polled_at=L, entity=T.ArrayType(ENTITY))

# Lookup files are read by position, so these names need not equal their headers.
ON_DEMAND = struct(route_id=S, line=S, note=S)
SECOND_SOURCE = struct(route_id=S, line=S, line_number=S, mode=S, note=S)
HOLIDAYS = struct(
    state=S, kind=S, name=S, first_day=T.DateType(), last_day=T.DateType(), origin=S
)
