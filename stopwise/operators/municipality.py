"""Share of the plan by federal state, read from the region code in the stop id."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopwise.functions import text as tx


def municipality_state(stop_times: DataFrame) -> DataFrame:
    counts = stop_times.groupBy(tx.region_code(F.col("stop_id")).alias("region")).agg(
        F.count("*").alias("planned_stops")
    )
    total = counts.agg(F.sum("planned_stops").alias("n")).scalar()
    return counts.withColumn("share", F.round(F.col("planned_stops") / total, 3))
