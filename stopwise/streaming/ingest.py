"""Feed snapshots -> report log, as batch and as stream."""

from __future__ import annotations

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stopwise.operators.neighbours import with_previous
from stopwise.operators.versions import allow_list_filter
from stopwise.sources.feed import explode_feed
from stopwise.sources.sinks import log_partitions, read_allow_list
from stopwise.streaming import changes
from stopwise.streaming.changes import KEY, ORDER, STATE
from stopwise.streaming.landing import land_snapshots, landed_snapshots

MAX_IDLE_POLLS = 240
POLLS_PER_BUCKET = 2880
#: Polls that a key's state remembers, so that a poll that arrives late still falls into its place.
LATE_POLLS = 30
#: How long an untouched key is stored. Whether a key is new again is decided by polls, never by this.
STATE_TTL_MS = 14 * 86_400_000
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

REPORT_DDL = (
    "betriebstag string, trip_id string, stop_id string, stop_sequence int, schedule_relationship string, "
    "arrival_delay int, arrival_time long, departure_delay int, departure_time long, observed_at long"
)
STREAM_DDL = f"{REPORT_DDL}, emission long, withdrawn boolean"


def change_only(rows: DataFrame, max_idle: int = MAX_IDLE_POLLS) -> DataFrame:
    """Rows whose state differs from the last seen state of (trip, stop), NULL-safe.

    A key is new again when more than `max_idle` polls have passed since it was last seen;
    the age counts polls, so an outage ages nothing.
    """
    bucketed = rows.withColumn("_bucket", F.floor(F.col("poll") / POLLS_PER_BUCKET))
    seen = with_previous(bucketed, KEY, "_bucket", ORDER, [*STATE, "poll"], "_prev")
    same = F.lit(True)
    for c in STATE:
        same = same & F.col(c).eqNullSafe(F.col(f"_prev.{c}"))
    fresh = F.col("_prev").isNull() | (F.col("poll") - F.col("_prev.poll") > max_idle)
    return seen.where(fresh | ~same).drop("_prev", "_bucket")


def idle_evictions(rows: DataFrame, max_idle: int = MAX_IDLE_POLLS) -> DataFrame:
    """Every time a key was forgotten: last poll it was seen in, and the poll it came back in."""
    bucketed = rows.withColumn("_bucket", F.floor(F.col("poll") / POLLS_PER_BUCKET))
    seen = with_previous(bucketed, KEY, "_bucket", ORDER, ["poll"], "_prev")
    return seen.where(F.col("poll") - F.col("_prev.poll") > max_idle).select(
        *KEY, F.col("_prev.poll").alias("last_poll"), F.col("poll").alias("seen_again")
    )


def change_only_stream(
    rows: DataFrame, max_idle: int = MAX_IDLE_POLLS, late_polls: int = LATE_POLLS, ttl_ms: int = STATE_TTL_MS
) -> DataFrame:
    """`change_only` on a stream, with `emission` and `withdrawn`; `scan_reports` settles the log.

    There is no watermark: the order of polls is kept per key, so no row is too late to count. An outage ages
    nothing, because only polls decide whether a key is new again.
    """
    # the class travels with the plan, so no Python worker needs this library on its path
    cloudpickle.register_pickle_by_value(changes)
    rows.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    # with processing time, an available-now run would go on forever with empty batches
    rows.sparkSession.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    return rows.groupBy(*KEY).transformWithStateInPandas(changes.Changes(max_idle, late_polls, ttl_ms), STREAM_DDL, "Append", "ProcessingTime")


def ingest(rows: DataFrame, allowed: DataFrame | None) -> DataFrame:
    return rows if allowed is None else allow_list_filter(rows, allowed)


def stream_ingest(
    spark: SparkSession,
    snapshots: str,
    log_root: str,
    checkpoint: str,
    allow_list_path: str | None = None,
    max_idle: int = MAX_IDLE_POLLS,
    files_per_trigger: int = 1000,
    late_polls: int = LATE_POLLS,
):
    """Snapshot files -> numbered polls -> flat rows -> allow-list -> changes only -> report log.

    Each run takes what has arrived and ends, and each run reads the allow-list anew. Both
    steps commit whole micro-batches, so a repeated batch adds no rows.
    """
    landing = f"{checkpoint}-landing"
    land_snapshots(spark, snapshots, landing, files_per_trigger)
    rows = explode_feed(landed_snapshots(spark, landing, files_per_trigger))
    if allow_list_path:
        rows = allow_list_filter(rows, read_allow_list(spark, allow_list_path))
    return (
        log_partitions(change_only_stream(rows, max_idle, late_polls))
        .writeStream.format("parquet")
        .partitionBy("date", "hour")
        .option("compression", "zstd")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(log_root)
    )


def hourly_capture_stream(reports: DataFrame, lateness: str = "2 hours") -> DataFrame:
    """Reports per hour of observation with a watermark; works on streams and on tables.

    `reports` has `observed_ts` as a timestamp.
    """
    return (
        reports.withWatermark("observed_ts", lateness)
        .groupBy(F.window("observed_ts", "1 hour"))
        .agg(F.count("*").alias("reports"))
        .select(F.col("window.start").alias("hour_start"), "reports")
    )
