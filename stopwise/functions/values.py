"""State of a planned stop, tolerant casts and ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MEASURED = "measured"
DEPARTURE_ONLY = "departure_only"
SKIPPED = "skipped"
TRIP_CANCELLED = "trip_cancelled"
UNREPORTED = "unreported"
NOT_CAPTURED = "not_captured"
STATES = [MEASURED, DEPARTURE_ONLY, SKIPPED, TRIP_CANCELLED, UNREPORTED, NOT_CAPTURED]

THRESHOLDS_MIN = [1, 3, 6, 15, 60]


def tolerant_cast(text: Column, type_name: str) -> Column:
    return F.nullif(F.trim(text), F.lit("")).try_cast(type_name)


def mode_of(route_type: Column) -> Column:
    return F.when(route_type == 0, "tram").when(route_type == 3, "bus").otherwise("other")


def stop_state(
    trip_relationship: Column,
    stop_relationship: Column,
    delay_arr: Column,
    delay_dep: Column,
    captured: Column,
) -> Column:
    """Exactly one state per planned stop; any positive signal outranks the capture status."""
    return (
        F.when(trip_relationship == "CANCELED", TRIP_CANCELLED)
        .when(stop_relationship == "SKIPPED", SKIPPED)
        .when(delay_arr.isNotNull(), MEASURED)
        .when(delay_dep.isNotNull(), DEPARTURE_ONLY)
        .when(~captured, NOT_CAPTURED)
        .otherwise(UNREPORTED)
    )


def is_assessable(state: Column) -> Column:
    return state.isin(MEASURED, DEPARTURE_ONLY)


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    return F.try_divide(numerator.cast("double"), F.nullif(denominator, F.lit(0)).cast("double"))


def share4(numerator: Column, denominator: Column) -> Column:
    """Share rounded to four places, as the published tables carry it."""
    return F.round(safe_ratio(numerator, denominator), 4)


def round1(value: Column) -> Column:
    """One decimal by adding a half and truncating toward zero, also for negatives."""
    return (value * 10 + 0.5).cast("long") / F.lit(10.0)
