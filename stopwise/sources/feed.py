"""Feed snapshots: nested messages -> flat report rows. Same plan for batch and stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stopwise.operators.neighbours import dense_numbers

POLL_BUCKET_SEC = 86_400


def trip_updates(snapshots: DataFrame) -> DataFrame:
    """One row per entity with a trip update and a trip id; `entity_pos` is its place in the feed."""
    return (
        snapshots.select(
            "polled_at", "poll", F.posexplode("entity").alias("entity_pos", "e")
        )
        .where(F.col("e.tripUpdate").isNotNull() & (F.coalesce("e.tripUpdate.trip.tripId", F.lit("")) != ""))
        .select(
            "polled_at",
            "poll",
            "entity_pos",
            F.col("e.id").alias("entity_id"),
            F.col("e.tripUpdate.trip").alias("trip"),
            F.col("e.tripUpdate.stopTimeUpdate").alias("updates"),
        )
    )


def explode_feed(snapshots: DataFrame) -> DataFrame:
    """One row per stop update; a trip without any gives one trip-level row.

    Only the trip-level row carries the trip's relationship, a stop row carries its own.
    """
    rows = trip_updates(snapshots).select(
        "polled_at", "poll", "entity_pos", "entity_id", "trip", F.posexplode_outer("updates").alias("stop_pos", "u")
    )
    no_stop = F.col("u").isNull()
    own = F.when(no_stop, F.col("trip.scheduleRelationship")).otherwise(F.col("u.scheduleRelationship"))
    return rows.select(
        "poll",
        "entity_pos",
        F.coalesce("stop_pos", F.lit(0)).alias("stop_pos"),
        "entity_id",
        F.coalesce("trip.startDate", F.lit("")).alias("betriebstag"),
        F.col("trip.tripId").alias("trip_id"),
        F.coalesce("u.stopId", F.lit("")).alias("stop_id"),
        F.coalesce("u.stopSequence", F.lit(0)).alias("stop_sequence"),
        F.coalesce(own, F.lit("SCHEDULED")).alias("schedule_relationship"),
        F.coalesce("trip.scheduleRelationship", F.lit("SCHEDULED")).alias("trip_relationship"),
        F.col("u.arrival.delay").alias("arrival_delay"),
        F.col("u.arrival.time").alias("arrival_time"),
        F.col("u.departure.delay").alias("departure_delay"),
        F.col("u.departure.time").alias("departure_time"),
        F.col("polled_at").alias("observed_at"),
    )


def poll_trips(snapshots: DataFrame) -> DataFrame:
    """One row per poll and trip with its stop counts."""

    def count(condition) -> Column:
        return F.size(F.filter("updates", condition))

    updates = trip_updates(snapshots).withColumn("updates", F.coalesce("updates", F.array()))
    return updates.select(
        "poll",
        "polled_at",
        "entity_id",
        F.coalesce("trip.startDate", F.lit("?")).alias("start_date"),
        F.col("trip.tripId").alias("trip_id"),
        F.coalesce("trip.scheduleRelationship", F.lit("SCHEDULED")).alias("relationship"),
        F.coalesce(F.substring("trip.startTime", 1, 2), F.lit("??")).alias("start_hour"),
        F.size("updates").alias("stops"),
        count(lambda u: u["arrival"].isNotNull() | u["departure"].isNotNull()).alias("with_time"),
        count(lambda u: u["scheduleRelationship"] == "SKIPPED").alias("skipped"),
        count(lambda u: F.coalesce(u["stopId"], F.lit("")) != "").alias("with_stop_id"),
    )


def with_poll_number(snapshots: DataFrame) -> DataFrame:
    """Numbers the successful polls in time order; failed polls leave no gap. The clock is the collector's,
    because the time in a feed's header may stand still."""
    numbers = dense_numbers(snapshots.select("polled_at"), "polled_at", F.floor(F.col("polled_at") / POLL_BUCKET_SEC), "_number")
    return snapshots.join(numbers, "polled_at").withColumn("poll", F.col("_number")).drop("_number")
