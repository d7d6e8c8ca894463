"""School holidays per state and the situation of a day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STATES = ["BW", "RP", "HE"]
LEAD_STATE = "BW"


def spread_ranges(holidays: DataFrame) -> DataFrame:
    """One row per day of each range; a range that ends before it starts has none."""
    return holidays.where(F.col("last_day") >= F.col("first_day")).withColumn(
        "service_day", F.explode(F.sequence("first_day", "last_day"))
    )


def holiday_days(holidays: DataFrame) -> DataFrame:
    """One row per state and holiday, with its name."""
    return spread_ranges(holidays).groupBy("state", "service_day").agg(F.min("name").alias("name"))


def interval_join_holidays(days: DataFrame, holidays: DataFrame) -> DataFrame:
    """Every day × state of the list with the holiday it falls into.

    Ranges are turned into days first, so the range condition becomes an equi join; the
    states come as one short array of (state, last listed day).
    """
    cover = (
        holidays.groupBy("state")
        .agg(F.max("last_day").alias("listed_until"))
        .agg(F.collect_list(F.struct("state", "listed_until")).alias("c"))
        .scalar()
    )
    spread = days.withColumn("cover", cover).select("service_day", F.explode("cover").alias("c"))
    return (
        spread.select("service_day", "c.state", "c.listed_until")
        .join(holiday_days(holidays), ["state", "service_day"], "left")
        .select(
            "service_day",
            "state",
            "listed_until",
            F.col("name").isNotNull().alias("in_holiday"),
            F.col("name").alias("holiday_name"),
        )
    )


def school_calendar(days: DataFrame, holidays: DataFrame) -> DataFrame:
    """Holiday flag per state (NULL beyond the list), holiday name and the overall situation."""
    listed = F.col("service_day") <= F.col("listed_until")
    classified = interval_join_holidays(days, holidays).select(
        "service_day",
        "state",
        F.when(listed, F.col("in_holiday")).alias("holiday"),
        F.when(listed & F.col("in_holiday"), F.col("holiday_name")).alias("holiday_name"),
    )
    wide = classified.groupBy("service_day").agg(
        *[
            F.max(F.when(F.col("state") == s, F.col("holiday"))).alias(f"holiday_{s.lower()}")
            for s in STATES
        ],
        F.max(F.when(F.col("state") == LEAD_STATE, F.col("holiday_name"))).alias("holiday_name"),
    )
    flags = [F.col(f"holiday_{s.lower()}") for s in STATES]
    any_unknown = flags[0].isNull() | flags[1].isNull() | flags[2].isNull()
    return wide.withColumn(
        "situation",
        F.when(any_unknown, F.lit(None).cast("string"))
        .when(flags[0] & flags[1] & flags[2], "all")
        .when(flags[0] | flags[1] | flags[2], "partly")
        .otherwise("none"),
    )


def overlap_self_join(holidays: DataFrame) -> DataFrame:
    """Pairs of ranges of one state where the second begins inside the first.

    The first range is spread over its days, so the range condition becomes an equi join.
    """
    inside = spread_ranges(holidays).select(
        "state",
        F.col("name").alias("name_a"),
        F.col("first_day").alias("first_a"),
        F.col("last_day").alias("last_a"),
        F.col("service_day").alias("first_b"),
    )
    starts = holidays.select(
        "state",
        F.col("first_day").alias("first_b"),
        F.col("name").alias("name_b"),
        F.col("last_day").alias("last_b"),
    )
    return inside.join(starts, ["state", "first_b"]).where(F.col("first_b") > F.col("first_a"))
