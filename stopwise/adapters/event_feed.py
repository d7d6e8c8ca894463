"""Feed snapshots and alerts derived from the event table: one small message per event."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

POLL_SEC = 60


def _update(e: Column, i: int, value: Column, polled: Column) -> Column:
    n = e + i
    delay = (value * 30).cast("int")
    planned = F.floor(polled / 86_400) * 86_400 + n % 5 * 600

    def event(divisor: int, shift: int) -> Column:
        return F.when(
            n % divisor != 0,
            F.struct((delay + shift).alias("delay"), (planned + delay + shift).alias("time")),
        )

    return F.struct(
        F.concat(F.lit("s"), n % 5).alias("stopId"),
        F.lit(i).alias("stopSequence"),
        F.when(n % 9 == 0, "SKIPPED").otherwise("SCHEDULED").alias("scheduleRelationship"),
        event(4, 0).alias("arrival"),
        event(6, 15).alias("departure"),
    )


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested messages in the feed's shape, polls at full minutes."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    e = F.col("event_id")
    polled = F.floor(F.unix_seconds(F.col("ts").cast("timestamp")) / POLL_SEC) * POLL_SEC
    value = F.floor("value") % 4
    updates = F.when(F.col("event_type") == "error", F.array().cast(
        "array<struct<stopId:string,stopSequence:int,scheduleRelationship:string,"
        "arrival:struct<delay:int,time:bigint>,departure:struct<delay:int,time:bigint>>>"
    )).otherwise(
        F.slice(F.array(*[_update(e, i, value, polled) for i in range(3)]), 1, (e % 3 + 1).cast("int"))
    )
    trip = F.struct(
        F.when(e % 13 == 0, "").otherwise(F.concat(F.lit("u"), F.col("user_id"))).alias("tripId"),
        F.when(e % 17 == 0, F.lit(None)).otherwise(F.date_format("ts", "yyyyMMdd")).alias("startDate"),
        F.date_format("ts", "HH:mm:ss").alias("startTime"),
        F.when((F.col("event_type") == "error") & (e % 2 == 0), "CANCELED").otherwise("SCHEDULED").alias("scheduleRelationship"),
    )
    no_update = e % 11 == 0
    entity = F.struct(
        e.cast("string").alias("id"),
        F.when(~no_update, F.struct(trip.alias("trip"), updates.alias("stopTimeUpdate"))).alias("tripUpdate"),
        F.when(no_update, F.struct(F.col("event_type").alias("effect"))).alias("alert"),
    )
    return events.select(
        F.struct(polled.alias("timestamp")).alias("header"),
        F.lit(None).cast("long").alias("poll"),
        polled.alias("polled_at"),
        F.array(entity).alias("entity"),
    )


def event_polls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Poll log: one row per source and minute in which it was polled."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return events.select(
        F.col("event_type").alias("source"), F.date_trunc("minute", "ts").cast("timestamp_ntz").alias("polled_at")
    ).distinct()
