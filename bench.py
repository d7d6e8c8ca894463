"""Headline timings: one JSON line.

The rebuild starts from the driver's tables: raw and staged tables, versions, frame, states,
fact, axis. Then every mart is computed from the stored fact, and a few larger diagnostics.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402


def session() -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("stopwise-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="stopwise-bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> None:
    from stopwise.plans.queries import Context
    from stopwise.registry import all_queries

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session()
    timings: dict[str, float] = {}

    def timed(name: str, run) -> None:
        start = time.perf_counter()
        run()
        timings[name] = round(time.perf_counter() - start, 3)

    def consume(df: DataFrame) -> None:
        df.write.mode("overwrite").format("noop").save()

    context = Context(spark, sf_dir)
    timed("stage_inputs", context.stage)
    timed("planned_x_observed", lambda: context.first.states)
    timed("direction_inference", lambda: context.inferred_directions)
    timed("fact", lambda: context.fact)
    timed("direction_names", lambda: context.direction_names)
    timed("stop_axis", lambda: context.stop_axis)
    queries = all_queries()
    for name in (
        "ag13_line_profile",
        "ag14_hour_profile",
        "ag15_stop_profile",
        "ag16_cancellations",
        "ag17_network_profile",
        "ag18_forecast_quality",
        "ag19_data_quality",
        "ag20_school_calendar",
        "wn1_last_report_per_stop",
        "wn9_choose_version",
        "ag29_loss_funnel",
        "str1_change_only",
    ):
        timed(name, lambda: consume(queries[name](spark, sf_dir)))
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "warehouse rebuild, all marts and diagnostics",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    main()
