"""Identifiers, names and labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean(text: Column) -> Column:
    """Trimmed text, empty -> NULL."""
    return F.nullif(F.trim(text), F.lit(""))


def station_source(parent: Column, stop_id: Column) -> Column:
    """Parent station, else the first three `:`-parts of the stop id, else the stop id."""
    head = F.array_join(F.slice(F.split(stop_id, ":"), 1, 3), ":")
    return F.coalesce(parent, F.nullif(head, F.lit("")), stop_id)


def station_key(source: Column) -> Column:
    return F.regexp_replace(source, "_Parent$", "")


def station_name(stop_name: Column) -> Column:
    """Stop name without its platform suffix."""
    return F.trim(F.regexp_replace(stop_name, r"\s+Bstg\.?\s*\S*$", ""))


def line_short(name: Column, operator_prefix: str) -> Column:
    """Display name as the second source writes it."""
    bare = F.regexp_replace(name, f"^{operator_prefix} ", "")
    return F.regexp_replace(bare, "^Moonliner ", "M")


def slug(key: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(key), "[^a-z0-9]+", "-"), "^-|-$", "")


def first_number(text: Column) -> Column:
    """First run of digits as a number, NULL when there is none."""
    return F.nullif(F.regexp_extract(text, "[0-9]+", 0), F.lit("")).try_cast("bigint")


def natural_order(mode: Column, name: Column) -> list[Column]:
    return [mode.asc(), first_number(name).asc_nulls_last(), name.asc()]


def trip_group(trip_id: Column) -> Column:
    """Trip id without its two trailing running numbers."""
    return F.regexp_replace(trip_id, r"-\d+-\d+$", "")


def special_no(trip_id: Column) -> Column:
    return F.nullif(F.regexp_extract(trip_id, r"Special#(\d+)-", 1), F.lit(""))


def run_label(source: Column, version: Column) -> Column:
    return F.concat_ws(" ", source, version.cast("string"))


def finding_key(text: Column) -> Column:
    """Finding text with every number masked, so a growing number stays one finding."""
    return F.regexp_replace(text, r"\d+(?:[.,]\d+)?", "#")


def region_code(stop_id: Column) -> Column:
    """First two digits of the municipality code inside a stop id."""
    return F.substring(F.split_part(stop_id, F.lit(":"), F.lit(2)), 1, 2)
