"""Writers: report log, incremental tables, schedule versions, exports."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stopwise.functions import values as vl
from stopwise.sources.scan import matching_paths
from stopwise.sources.store import path_exists, remove, replace_text


def log_partitions(reports: DataFrame) -> DataFrame:
    """UTC date and hour of the observation as partition columns."""
    ts = F.timestamp_seconds("observed_at")
    return reports.withColumns({"date": F.to_date(ts), "hour": F.date_format(ts, "HH")})


def write_reports(reports: DataFrame, root: str) -> None:
    """Append reports to `date=/hour=` partitions.

    The rebalance gives each hour few files and splits a very full hour over several tasks,
    by size. Nothing is written for an empty batch.
    """
    from stopwise.sources.schemas import REPORT

    rows = log_partitions(reports.select(*REPORT.names))
    if rows.isEmpty():
        return
    (
        rows.hint("rebalance", F.col("date"), F.col("hour"))
        .write.partitionBy("date", "hour")
        .option("compression", "zstd")
        .mode("append")
        .parquet(root)
    )


def unique_path(path: str, purpose: str) -> str:
    """A name beside the path that no other run uses."""
    return f"{path}__{purpose}-{uuid.uuid4().hex}"


def write_incremental(df: DataFrame, path: str, key: str) -> None:
    """Replace exactly the keys of this batch (delete and insert by partition).

    The batch is staged next to the table first, because it may read the table it replaces. Each run
    stages under a name of its own, which is removed afterwards.
    """
    spark = df.sparkSession
    staging = unique_path(path, "staging")
    df.write.option("compression", "zstd").parquet(staging)
    (
        spark.read.parquet(staging)
        .hint("rebalance", F.col(key))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .partitionBy(key)
        .parquet(path)
    )
    remove(spark, staging)


def read_incremental(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("mergeSchema", True).parquet(path)


def evolve_schema(old: DataFrame, new: DataFrame) -> DataFrame:
    """New columns appear in old rows as NULL: not measured then."""
    return old.unionByName(new, allowMissingColumns=True)


def ingest_schedule(
    routes: DataFrame, trips: DataFrame, stop_times: DataFrame, agency: str
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Routes of one agency, the trips of these routes, the stop times of these trips."""
    own_routes = routes.where(F.col("agency_id") == agency).select(
        "route_id", "route_short_name", "route_long_name", F.col("route_type").cast("int").alias("route_type")
    )
    own_trips = trips.join(own_routes, "route_id", "left_semi").select(
        "trip_id", "route_id", "service_id", "direction_id"
    )
    own_stop_times = stop_times.join(own_trips, "trip_id", "left_semi").select(
        "trip_id",
        "stop_id",
        F.col("stop_sequence").cast("int").alias("stop_sequence"),
        "arrival_time",
        "departure_time",
    )
    return own_routes, own_trips, own_stop_times


def write_schedule_version(tables: dict[str, DataFrame], root: str, version: dt.date) -> bool:
    """Store one immutable version; one that exists already is left alone."""
    spark = next(iter(tables.values())).sparkSession
    folder = f"{root}/v={version.isoformat()}"
    if all(path_exists(spark, f"{folder}/{name}.parquet/_SUCCESS") for name in tables):
        return False
    for name, df in tables.items():
        df.write.mode("overwrite").option("compression", "zstd").parquet(f"{folder}/{name}.parquet")
    return True


POINTER = "current"


def write_allow_list(allowed: DataFrame, path: str) -> int:
    """Replace the list; an empty one is an error and leaves the old list in place.

    Lists stand side by side under names of their own; a pointer file names the one that holds, and it is
    replaced in one step, so a reader finds the old list or the new one at any moment.
    """
    if allowed.isEmpty():
        raise ValueError("no readable trip list; the previous one stays")
    spark = allowed.sparkSession
    name = f"list-{uuid.uuid4().hex}"
    allowed.write.parquet(f"{path}/{name}")
    replace_text(spark, f"{path}/{POINTER}", name)
    return spark.read.parquet(f"{path}/{name}").count()


def read_allow_list(spark: SparkSession, path: str) -> DataFrame:
    """The list that holds; a folder without pointer is a list itself."""
    if not path_exists(spark, f"{path}/{POINTER}"):
        return spark.read.parquet(path)
    return spark.read.parquet(f"{path}/{spark.read.text(f'{path}/{POINTER}').first()[0]}")


def refresh_allow_list(spark: SparkSession, root: str, table: str, path: str, n: int) -> tuple[int, list[str]]:
    """Builds the list from the newest n versions whose files can be read; returns its size and the files left out."""
    from stopwise.operators.staging import stage_trips
    from stopwise.operators.versions import allow_list
    from stopwise.sources import schemas
    from stopwise.sources.scan import VERSION_IN_PATH

    good, bad = readable_versions(spark, root, table)
    if not good:
        raise ValueError("no readable trip list; the previous one stays")
    version = F.to_date(F.regexp_extract(F.col("_metadata.file_path"), VERSION_IN_PATH, 1))
    trips = stage_trips(spark.read.schema(schemas.TRIPS).parquet(*good).withColumn("v", version))
    return write_allow_list(allow_list(trips, n), path), bad


def readable_versions(spark: SparkSession, root: str, table: str) -> tuple[list[str], list[str]]:
    """Version files that can be read, and those that cannot."""
    good, bad = [], []
    for path in matching_paths(spark, f"{root}/v=*/{table}"):
        try:
            spark.read.parquet(path)
            good.append(path)
        except Exception:
            bad.append(path)
    return good, bad


# -- exports --------------------------------------------------------------------------------------


def dates_as_text(df: DataFrame) -> DataFrame:
    """Dates and timestamps as text, everything else unchanged."""
    return df.select(
        *[
            F.col(n).cast("string").alias(n) if t in ("date", "timestamp", "timestamp_ntz") else F.col(n)
            for n, t in df.dtypes
        ]
    )


def export_marts(marts: dict[str, DataFrame], lines: DataFrame, directions: DataFrame, folder: str) -> None:
    """Marts, newest line master data and direction names as zstd Parquet."""
    newest = Window.partitionBy("route_id").orderBy(F.col("schedule_version").desc())
    master = lines.withColumn("rank", F.row_number().over(newest)).where(F.col("rank") == 1).drop("rank")
    for name, df in {**marts, "lines": master, "directions": directions}.items():
        dates_as_text(df).write.mode("overwrite").option("compression", "zstd").parquet(f"{folder}/{name}.parquet")


def columnar(df: DataFrame, by: list[str], order: list[Column | str], fields: list[str]) -> DataFrame:
    """One row per document: every field an array, all arrays in one row order.

    `order` must consist of orderable values where NULLs belong last.
    """
    keys = []
    for i, o in enumerate(order):
        c = F.col(o) if isinstance(o, str) else o
        keys += [c.isNull().alias(f"_n{i}"), c.alias(f"_o{i}")]
    rows = F.sort_array(F.collect_list(F.struct(*keys, *fields)))
    grouped = df.groupBy(*by).agg(rows.alias("_rows")) if by else df.agg(rows.alias("_rows"))
    return grouped.select(*by, *[F.col("_rows").getField(f).alias(f) for f in fields])


def line_document(line_profile: DataFrame) -> DataFrame:
    """Daily figures of a line and year, columns side by side, on-time counts by threshold as a map. A year bounds a document,
    however long the history is."""
    rounded = dates_as_text(line_profile.withColumn("year", F.year("service_day"))).withColumn(
        "delay_mean_sec", vl.round1(F.coalesce("delay_mean_sec", F.lit(0.0)))
    )
    on_time = [f"on_time_{t}min" for t in vl.THRESHOLDS_MIN]
    fields = [
        "service_day",
        "direction",
        "planned_stops",
        "assessable_stops",
        "trips",
        "stops_trip_cancelled",
        "stops_skipped",
        "delay_mean_sec",
        *on_time,
    ]
    doc = columnar(rounded, ["route_id", "year"], ["service_day", "direction"], fields)
    by_threshold = F.create_map(
        *[x for t in vl.THRESHOLDS_MIN for x in (F.lit(str(t)), F.col(f"on_time_{t}min"))]
    )
    return doc.withColumn("on_time", by_threshold).drop(*on_time)


def network_document(network: DataFrame) -> DataFrame:
    """Daily figures of all lines of a mode, a document a year."""
    rounded = dates_as_text(network.withColumn("year", F.year("service_day"))).withColumn(
        "delay_mean_sec", vl.round1(F.coalesce("delay_mean_sec", F.lit(0.0)))
    )
    fields = [c for c in rounded.columns if c not in ("delay_median_sec", "year")]
    return columnar(rounded, ["year"], ["service_day", "mode"], fields)


def export_columnar_json(documents: DataFrame, folder: str, by: str | None = None) -> None:
    writer = documents.write.mode("overwrite").option("ignoreNullFields", False)
    (writer.partitionBy(by) if by else writer).json(folder)
