"""Aggregates that each schedule version gives once and for all, and a ledger of the versions built.

A published version never changes, so what follows from it alone is stored by version and never built again. A version counts as
built when the ledger names it, which happens after its partition is complete; a half-written one is built anew.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stopwise.sources.scan import matching_paths

VERSION = "schedule_version"


class VersionStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def _ledger(self, layer: str) -> str:
        return f"{self.root}/ledger/layer={layer}"

    def built(self, layer: str) -> set[dt.date]:
        """Versions in the ledger of a layer; at most one a date."""
        if not matching_paths(self.spark, self._ledger(layer)):
            return set()
        rows = self.spark.read.schema(f"{VERSION} date").parquet(self._ledger(layer)).distinct().collect()
        return {r[VERSION] for r in rows}

    def layer(self, layer: str, trips: DataFrame, build: Callable[[Callable[[DataFrame], DataFrame]], DataFrame]) -> DataFrame:
        """The layer of all versions of `trips`. `build` gets a function that cuts a table down to the versions to build."""
        present = {r[VERSION] for r in trips.select(VERSION).distinct().collect()}
        missing = sorted(present - self.built(layer))
        path = f"{self.root}/{layer}"
        if missing:
            rows = build(lambda table: table.where(F.col(VERSION).isin(missing)))
            (
                rows.write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .option("compression", "zstd")
                .partitionBy(VERSION)
                .parquet(path)
            )
            # the schema stands by itself, for a layer that has no rows yet
            rows.limit(0).write.mode("overwrite").parquet(f"{self.root}/schema/layer={layer}")
            done = self.spark.createDataFrame([(v,) for v in missing], f"{VERSION} date")
            done.coalesce(1).write.mode("append").parquet(self._ledger(layer))
        schema = self.spark.read.parquet(f"{self.root}/schema/layer={layer}").schema
        if not matching_paths(self.spark, f"{path}/{VERSION}=*"):
            return self.spark.createDataFrame([], schema)
        stored = self.spark.read.schema(schema).parquet(path).select(*schema.names)
        return stored.where(F.col(VERSION).isin(sorted(present)))
