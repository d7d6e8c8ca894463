"""Stop axis: one linear order of stations per line and direction."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stopwise.functions import text as tx

LINE_DIR = ["route_id", "direction"]


def nullsafe_equal(left: str, right: str, keys: list[str]) -> Column:
    return reduce(
        lambda a, b: a & b, [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys]
    )


def nullsafe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join in which a NULL key matches a NULL key; the right side's keys are dropped."""
    l, r = left.alias("l"), right.alias("r")
    joined = l.join(r, nullsafe_equal("l", "r", keys), how)
    if how in ("left_semi", "left_anti"):
        return joined
    return joined.select("l.*", *[F.col(f"r.{c}") for c in right.columns if c not in keys])


def nearest_anchors(runs: DataFrame, reference: DataFrame, group: list[str]) -> DataFrame:
    """Known position of every stop of a run and the nearest known ones around it."""
    known = nullsafe_join(runs, reference, [*group, "station_id"], "left")
    along = Window.partitionBy(*group, "run_id").orderBy("step")
    return known.withColumns(
        {
            "before": F.last("nr", ignorenulls=True).over(
                along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
            ),
            "after": F.first("nr", ignorenulls=True).over(
                along.rowsBetween(Window.currentRow, Window.unboundedFollowing)
            ),
        }
    )


def place_between_anchors(runs: DataFrame, reference: DataFrame, group: list[str]) -> DataFrame:
    """Position of every station on the axis of the reference run.

    Stations the reference knows keep their number. The k-th of m unknown stations in a gap
    is spread evenly between its anchors, or counted on from the only anchor; the median
    over all runs decides.
    """
    gap = Window.partitionBy(*group, "run_id", "before", "after")
    k, m = F.col("k"), F.col("m")
    before, after = F.col("before"), F.col("after")
    between = (
        nearest_anchors(runs, reference, group)
        .where(F.col("nr").isNull())
        .withColumns({"k": F.row_number().over(gap.orderBy("step")), "m": F.count("*").over(gap)})
        .withColumn(
            "place",
            F.when(before.isNotNull() & after.isNotNull(), before + k * (after - before) / (m + 1))
            .when(before.isNotNull(), before + k / (m + 1))
            .when(after.isNotNull(), after - (m + 1 - k) / (m + 1)),
        )
        .groupBy(*group, "station_id")
        .agg(F.median("place").alias("pos"))
        .where(F.col("pos").isNotNull())
    )
    unknown = nullsafe_join(between, reference.select(*group, "station_id"), [*group, "station_id"], "left_anti")
    anchored = reference.select(*group, "station_id", F.col("nr").cast("double").alias("pos"))
    return anchored.unionByName(unknown)


def station_runs(trips: DataFrame, stop_times: DataFrame, stops: DataFrame) -> DataFrame:
    """Stations in travel order per trip and version."""
    trip = ["trip_id", "schedule_version"]
    stations = stops.select("stop_id", "schedule_version", "station_id")
    return (
        stop_times.select(*trip, "stop_id", "stop_sequence")
        .join(stations, ["stop_id", "schedule_version"])
        .join(trips.select(*LINE_DIR, *trip), trip)
        .select(
            "schedule_version",
            *LINE_DIR,
            F.col("trip_id").alias("run_id"),
            F.col("stop_sequence").alias("step"),
            "station_id",
        )
    )


def reference_run(runs: DataFrame, group: list[str]) -> DataFrame:
    """Longest run per group, ties by run id."""
    longest = Window.partitionBy(*group).orderBy(F.col("stops").desc(), "run_id")
    return (
        runs.groupBy(*group, "run_id")
        .agg(F.count("*").alias("stops"))
        .withColumn("rank", F.row_number().over(longest))
        .where(F.col("rank") == 1)
        .drop("rank")
    )


def first_visit(runs: DataFrame, reference: DataFrame, group: list[str]) -> DataFrame:
    """Number of each station in the reference run, first visit only."""
    chosen = nullsafe_join(runs, reference.select(*group, "run_id"), [*group, "run_id"], "left_semi")
    return (
        chosen.withColumns(
            {
                "nr": F.row_number().over(Window.partitionBy(*group).orderBy("step")),
                "visit": F.row_number().over(Window.partitionBy(*group, "station_id").orderBy("step")),
            }
        )
        .where(F.col("visit") == 1)
        .select(*group, "station_id", "nr")
    )


def gap_free_rank(placed: DataFrame, group: list[str], name: str) -> DataFrame:
    order = Window.partitionBy(*group).orderBy("pos", "station_id")
    return placed.where(F.col("pos").isNotNull()).select(
        *group, "station_id", F.row_number().over(order).alias(name)
    )


def stop_axis_per_version(runs: DataFrame) -> DataFrame:
    group = ["schedule_version", *LINE_DIR]
    reference = first_visit(runs, reference_run(runs, group), group)
    return gap_free_rank(place_between_anchors(runs, reference, group), group, "nr")


def stop_axis(first: DataFrame, second: DataFrame) -> DataFrame:
    """One order per line and direction over all versions and both sources.

    The newest version of the first source is the reference, else the second source's.
    """
    sources = first.withColumn("source", F.lit("first")).unionByName(
        second.withColumn("source", F.lit("second"))
    )
    priority = Window.partitionBy(*LINE_DIR).orderBy("source", F.col("schedule_version").desc())
    chosen = (
        sources.select(*LINE_DIR, "source", "schedule_version")
        .distinct()
        .withColumn("rank", F.row_number().over(priority))
        .where(F.col("rank") == 1)
    )
    keys = [*LINE_DIR, "source", "schedule_version"]
    reference = nullsafe_join(sources, chosen.select(*keys), keys, "left_semi").select(
        *LINE_DIR, "station_id", "nr"
    )
    runs = sources.select(
        *LINE_DIR,
        tx.run_label(F.col("source"), F.col("schedule_version")).alias("run_id"),
        F.col("nr").alias("step"),
        "station_id",
    )
    return gap_free_rank(place_between_anchors(runs, reference, LINE_DIR), LINE_DIR, "position")


# -- checks of a published axis against the timetable ------------------------------------


def adjacent_pairs(runs: DataFrame) -> DataFrame:
    """Directly following stations with their number of trips, over all versions."""
    along = Window.partitionBy(*LINE_DIR, "schedule_version", "run_id").orderBy("step")
    return (
        runs.select(
            *LINE_DIR, F.col("station_id").alias("a"), F.lead("station_id").over(along).alias("b")
        )
        .where(F.col("b").isNotNull() & (F.col("a") != F.col("b")))
        .groupBy(*LINE_DIR, "a", "b")
        .agg(F.count("*").alias("trips"))
    )


def shown_stops(stop_profile: DataFrame) -> DataFrame:
    """Per station the name and position of the newest day that has them, in shown order."""
    stops = stop_profile.groupBy(*LINE_DIR, "station_id").agg(
        F.max_by("stop_name", F.when(F.col("stop_name").isNotNull(), F.col("service_day"))).alias("stop_name"),
        F.max_by("position", F.when(F.col("position").isNotNull(), F.col("service_day"))).alias("position"),
    )
    order = Window.partitionBy(*LINE_DIR).orderBy(
        F.col("position").asc_nulls_last(), "stop_name", "station_id"
    )
    return stops.withColumn("shown", F.row_number().over(order))


def pair_order(pairs: DataFrame, shown: DataFrame) -> DataFrame:
    """Adjacent pairs of shown stations, and whether they are shown the wrong way round."""
    a = shown.select(*LINE_DIR, F.col("station_id").alias("a"), F.col("shown").alias("shown_a"))
    b = shown.select(*LINE_DIR, F.col("station_id").alias("b"), F.col("shown").alias("shown_b"))
    both = nullsafe_join(nullsafe_join(pairs, a, [*LINE_DIR, "a"]), b, [*LINE_DIR, "b"])
    return both.withColumn("violated", F.col("shown_a") >= F.col("shown_b"))


def order_violations(pairs: DataFrame, shown: DataFrame) -> DataFrame:
    return (
        pair_order(pairs, shown)
        .groupBy(*LINE_DIR)
        .agg(F.count("*").alias("checked"), F.count_if("violated").alias("violated"))
    )


def duplicate_names(shown: DataFrame) -> DataFrame:
    return (
        shown.groupBy(*LINE_DIR, "stop_name")
        .agg(F.count("*").alias("stations"))
        .where(F.col("stations") > 1)
    )


def cyclic_groups(pairs: DataFrame, spark_checkpoint=None) -> DataFrame:
    """Line-directions whose successor graph has a cycle.

    Stations without successor and stations without predecessor are trimmed off round by round, on all graphs at
    once; what stays lies on a cycle or between two. A round shortens the longest acyclic path from both
    ends, so the number of rounds is half the length of a line in stops. The number of
    edges falls strictly until the loop ends, so no limit of rounds is needed.
    """
    keep = spark_checkpoint or (lambda df: df.checkpoint())
    named = pairs.select(F.to_json(F.struct(*LINE_DIR), {"ignoreNullFields": "false"}).alias("g"), *LINE_DIR, "a", "b").distinct()
    names = named.select("g", *LINE_DIR).distinct()
    edges = keep(named.select("g", "a", "b"))
    remaining = edges.count()
    while True:
        leads_on = edges.select("g", F.col("a").alias("b")).distinct()
        led_to = edges.select("g", F.col("b").alias("a")).distinct()
        edges = keep(edges.join(leads_on, ["g", "b"], "left_semi").join(led_to, ["g", "a"], "left_semi"))
        left = edges.count()
        if left in (0, remaining):
            break
        remaining = left
    return names.join(edges.select("g").distinct(), "g", "left_semi").select(*LINE_DIR)


def is_cyclic(pairs: DataFrame, spark_checkpoint=None) -> DataFrame:
    groups = pairs.select(*LINE_DIR).distinct()
    cyclic = cyclic_groups(pairs, spark_checkpoint).withColumn("cyclic", F.lit(True))
    return nullsafe_join(groups, cyclic, LINE_DIR, "left").select(
        *LINE_DIR, F.coalesce("cyclic", F.lit(False)).alias("cyclic")
    )


def rank_agreement(axis: DataFrame, version_axis: DataFrame) -> DataFrame:
    """Stations whose rank differs between the published axis and the axis of a version, for each version given."""
    plan = version_axis.select("schedule_version", *LINE_DIR, "station_id", "nr")
    common = nullsafe_join(axis.select(*LINE_DIR, "station_id", "position"), plan, [*LINE_DIR, "station_id"])
    line = Window.partitionBy("schedule_version", *LINE_DIR)
    return common.select(
        "schedule_version",
        *LINE_DIR,
        "station_id",
        F.row_number().over(line.orderBy("nr", "station_id")).alias("rank_planned"),
        F.row_number().over(line.orderBy("position", "station_id")).alias("rank_shown"),
    ).where(F.col("rank_planned") != F.col("rank_shown"))
