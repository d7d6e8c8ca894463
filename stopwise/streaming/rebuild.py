"""An incremental run over real files: new reports in, the newest days of fact and marts out.

A run reads the log from the day before its window on, because reports of a day arrive from then; builds the window's days anew; and
replaces their partitions. Cancellations without a date count for any day, so they are kept in a small table by arrival date, which every
run reads whole. Layers of a schedule version come from a `VersionStore`.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stopwise.functions import time as tm
from stopwise.operators import versions
from stopwise.plans.warehouse import Warehouse
from stopwise.sources import schemas, sinks
from stopwise.sources.scan import FileTables, matching_paths, scan_reports
from stopwise.sources.store import TableStore, remove
from stopwise.streaming.increments import WINDOW_DAYS
from stopwise.streaming.version_store import VersionStore

DAY = "service_day"


def newest_stored_day(spark: SparkSession, table: str) -> dt.date | None:
    """From the names of the partitions; no data are read."""
    names = [p.rsplit("=", 1)[1] for p in matching_paths(spark, f"{table}/{DAY}=*")]
    days = [dt.date.fromisoformat(n) for n in names if n[:1].isdigit()]
    return max(days, default=None)


def undated_cancellations(log: DataFrame) -> DataFrame:
    """Trip-level cancellations that name no day."""
    trip_level = F.coalesce("stop_id", F.lit("")) == ""
    return log.where(trip_level & tm.feed_day(F.col("betriebstag")).isNull() & (F.col("schedule_relationship") == "CANCELED"))


class Rebuild:
    """Fact and marts of a data folder, stored by service day."""

    def __init__(self, spark: SparkSession, root: str, lookups: str, store: str, min_trips: int = versions.MIN_TRIPS, second: str = "second", prefix: str = ""):
        self.spark, self.root, self.lookups, self.store = spark, root, lookups, store
        self.min_trips, self.second, self.prefix = min_trips, second, prefix

    def _older(self, folder: str, since: dt.date | None) -> DataFrame:
        """Brings the table of undated cancellations up to date and returns its rows from before the window."""
        path, log = f"{self.store}/undated/{folder}", scan_reports(self.spark, f"{self.root}/{folder}")
        if since is not None:
            log = log.where(F.col("date") >= F.lit(since))
        sinks.write_incremental(undated_cancellations(log).select(*schemas.REPORT.names, "date"), path, "date")
        if since is None or not matching_paths(self.spark, f"{path}/date=*"):
            return self.spark.createDataFrame([], schemas.REPORT)
        stored = self.spark.read.schema(T.StructType([*schemas.REPORT, T.StructField("date", T.DateType())])).parquet(path)
        return stored.where(F.col("date") < F.lit(since)).select(*schemas.REPORT.names)

    def run(self, full: bool = False, window_days: int = WINDOW_DAYS) -> dt.date | None:
        """Builds what is new and returns the first day of the window (None: everything)."""
        newest = None if full else newest_stored_day(self.spark, f"{self.store}/fact")
        start = None if newest is None else newest - dt.timedelta(days=window_days)
        warehouse, scratch = self.warehouse(start)
        for name in ["fact", *Warehouse.MARTS]:
            rows = getattr(warehouse, name)
            if start is not None:
                rows = rows.where(F.col(DAY) >= F.lit(start))
            sinks.write_incremental(rows, f"{self.store}/{name}", DAY)
            # the schema stands by itself, for a table that has no rows yet
            rows.limit(0).write.mode("overwrite").parquet(f"{self.store}/schema/{name}")
        remove(self.spark, scratch)
        return start

    def warehouse(self, start: dt.date | None) -> tuple[Warehouse, str]:
        """The warehouse over the window's reports, and the folder of its layers."""
        since = None if start is None else start - dt.timedelta(days=1)
        older = {folder: self._older(folder, since) for folder in ("raw", f"raw-{self.second}")}
        tables = FileTables(self.spark, self.root, self.lookups, self.second, self.prefix, since, older)
        layers = TableStore(self.spark, f"{self.store}-{uuid.uuid4().hex}")
        per_version = VersionStore(self.spark, f"{self.store}/versions").layer
        return Warehouse(tables, self.min_trips, layers.keep, start, per_version), layers.root

    def read(self, name: str) -> DataFrame:
        if not matching_paths(self.spark, f"{self.store}/{name}/{DAY}=*"):
            return self.spark.read.parquet(f"{self.store}/schema/{name}")
        return sinks.read_incremental(self.spark, f"{self.store}/{name}")
