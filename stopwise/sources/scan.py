"""Scans of report logs, schedule versions, CSV files and lookup tables."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stopwise.sources import schemas

VERSION_IN_PATH = r"v=(\d{4}-\d{2}-\d{2})"


def matching_paths(spark: SparkSession, glob: str) -> list[str]:
    path = spark._jvm.org.apache.hadoop.fs.Path(glob)
    statuses = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return sorted(s.getPath().toString() for s in statuses) if statuses else []


def scan_or_empty(spark: SparkSession, glob: str, schema: T.StructType, read) -> DataFrame:
    """`read(paths)`, or an empty typed relation when the glob matches nothing."""
    paths = matching_paths(spark, glob)
    return read(paths) if paths else spark.createDataFrame([], schema)


def scan_reports(spark: SparkSession, root: str) -> DataFrame:
    """Hour-partitioned report files with columns matched by name, and their source path.

    A log that the stream wrote also holds withdrawals; they and the rows that they withdraw are left out.
    """
    schema = T.StructType(
        [*schemas.REPORT, T.StructField("date", T.DateType()), T.StructField("hour", T.StringType())]
    )
    if not matching_paths(spark, f"{root}/date=*"):
        return spark.createDataFrame([], T.StructType([*schema, T.StructField("source_file", T.StringType())]))
    streamed = bool(matching_paths(spark, f"{root}/_spark_metadata"))
    marks = [T.StructField("emission", T.LongType()), T.StructField("withdrawn", T.BooleanType())] if streamed else []
    rows = (
        spark.read.schema(T.StructType([*schema, *marks]))
        .option("recursiveFileLookup", False)
        .parquet(root)
        .withColumn("source_file", F.col("_metadata.file_path"))
    )
    return settled(rows) if streamed else rows


def settled(log: DataFrame) -> DataFrame:
    """Reports without those withdrawn later. Both stand in the same hour, and withdrawals are few."""
    names = ["date", "hour", "trip_id", "stop_id", "emission"]
    gone = log.where("withdrawn").groupBy(*names).agg(F.lit(1).alias("_gone"))
    return log.where("withdrawn is null or not withdrawn").join(gone, names, "left_anti").drop("emission", "withdrawn")


def scan_schedule(spark: SparkSession, root: str, table: str, schema: T.StructType) -> DataFrame:
    """One table of all schedule versions; the version date `v` comes from the folder name."""

    def read(paths: list[str]) -> DataFrame:
        version = F.regexp_extract(F.col("_metadata.file_path"), VERSION_IN_PATH, 1)
        return spark.read.schema(schema).parquet(*paths).withColumn("v", F.to_date(version))

    empty = T.StructType([*schema, T.StructField("v", T.DateType())])
    return scan_or_empty(spark, f"{root}/v=*/{table}", empty, read)


def csv_headers(spark: SparkSession, paths: list[str]) -> dict[str, list[str]]:
    """The column names of every file, from one job over the first lines."""
    lines = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"))
    first = lines.where("at = 0").withColumn("n", F.monotonically_increasing_id()).groupBy("file").agg(F.min_by("value", "n").alias("line"))
    names = first.select("file", F.split(F.regexp_replace("line", "[\ufeff\r\"]", ""), ",").alias("names"))
    return {r.file: [n.strip() for n in r.names] for r in names.collect()}


def scan_schedule_csv(spark: SparkSession, root: str, file: str, schema: T.StructType) -> DataFrame:
    """A CSV file of all versions as text, matched by column name.

    Versions differ in their columns, and one scan maps columns by position, so each distinct header
    is one scan over all versions that have it. Short rows end in nulls, surplus fields are dropped, and a quote inside an
    unquoted field is a character like any other.
    """

    def read(paths: list[str]) -> DataFrame:
        by_header: dict[tuple[str, ...], list[str]] = {}
        for path, names in csv_headers(spark, paths).items():
            by_header.setdefault(tuple(names), []).append(path)
        scans = []
        for names, files in by_header.items():
            columns = T.StructType([T.StructField(f"_{k}", T.StringType()) for k in range(len(names))])
            rows = spark.read.schema(columns).option("header", True).option("enforceSchema", True).option("mode", "PERMISSIVE")
            rows = rows.option("encoding", "UTF-8").option("escape", '"').csv(files)
            wanted = [
                (F.col(f"_{names.index(f.name)}") if f.name in names else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema
            ]
            scans.append(rows.select(*wanted, F.col("_metadata.file_path").alias("source_file")))
        version = F.to_date(F.regexp_extract("source_file", VERSION_IN_PATH, 1))
        return reduce(DataFrame.unionByName, scans).select(*schema.names, version.alias("v"), "source_file")

    empty = T.StructType(
        [*schema, T.StructField("v", T.DateType()), T.StructField("source_file", T.StringType())]
    )
    return scan_or_empty(spark, f"{root}/v=*/{file}", empty, read)


def read_lookup(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A maintained lookup table with explicit types."""
    return spark.read.schema(schema).option("header", True).option("dateFormat", "yyyy-MM-dd").csv(path)


def on_demand_lookup(spark: SparkSession, path: str) -> DataFrame:
    return read_lookup(spark, path, schemas.ON_DEMAND).select("route_id")


def second_source_lookup(spark: SparkSession, path: str) -> DataFrame:
    return read_lookup(spark, path, schemas.SECOND_SOURCE).select("route_id", "line_number", "mode")


def holiday_lookup(spark: SparkSession, path: str) -> DataFrame:
    return read_lookup(spark, path, schemas.HOLIDAYS).select("state", "name", "first_day", "last_day")


class FileTables:
    """Raw tables of a data folder in the stored layout, in the shape `Warehouse` expects.

    First source: `raw/`, `static/v=*/`; second source: `raw-<second>/`, `static-<second>/v=*/`.
    `prefix` stands before the names of the ingested tables, as in `<prefix>_trips.parquet`.
    """

    def __init__(
        self, spark: SparkSession, root: str, lookups: str, second: str = "second", prefix: str = "",
        since: dt.date | None = None, older: dict[str, DataFrame] | None = None,
    ):
        """`since`: first arrival date of reports to read; `older`: reports from before that all the same, by log folder."""
        def names(p: str) -> dict[str, str]:
            return {t: f"{p}_{t}.parquet" if p else f"{t}.parquet" for t in ("trips", "routes", "stop_times")}

        def log(folder: str) -> DataFrame:
            rows = scan_reports(spark, f"{root}/{folder}")
            if since is not None:
                rows = rows.where(F.col("date") >= F.lit(since))
            rows = rows.select(*schemas.REPORT.names)
            return rows.unionByName(older[folder]) if older else rows

        def source(reports: str, static: str) -> dict[str, DataFrame]:
            files = names(prefix)
            return {
                "reports": log(reports),
                "trips": scan_schedule(spark, f"{root}/{static}", files["trips"], schemas.TRIPS),
                "routes": scan_schedule(spark, f"{root}/{static}", files["routes"], schemas.ROUTES),
                "stop_times": scan_schedule(spark, f"{root}/{static}", files["stop_times"], schemas.STOP_TIMES),
                "stops": scan_schedule_csv(spark, f"{root}/{static}", "stops.txt", schemas.STOPS),
                "calendar": scan_schedule_csv(spark, f"{root}/{static}", "calendar.txt", schemas.CALENDAR),
            }

        self.logs = ["raw", f"raw-{second}"]
        first, other = source(self.logs[0], "static"), source(self.logs[1], f"static-{second}")
        for name, df in first.items():
            setattr(self, f"raw_{name}", df)
        for name, df in other.items():
            setattr(self, f"second_{name}", df)
        self.raw_calendar_dates = scan_schedule_csv(
            spark, f"{root}/static", "calendar_dates.txt", schemas.CALENDAR_DATES
        )
        self.on_demand = on_demand_lookup(spark, f"{lookups}/on_demand.csv")
        self.second_source_lines = second_source_lookup(spark, f"{lookups}/second_source.csv")
        self.holidays = holiday_lookup(spark, f"{lookups}/school_holidays.csv")
