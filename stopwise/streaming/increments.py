"""What an incremental run rebuilds."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW_DAYS = 2


def newest_value(table: DataFrame | None, column: str) -> dt.date:
    """Newest stored key, read before the table is written; far past for a first build."""
    first_build = dt.date(1900, 1, 1)
    if table is None:
        return first_build
    return table.agg(F.max(column)).first()[0] or first_build


def window_start(table: DataFrame | None, column: str = "service_day", days: int = WINDOW_DAYS) -> dt.date:
    newest = newest_value(table, column)
    return newest - dt.timedelta(days=days) if newest.year > 1900 else newest


def recompute_window(df: DataFrame, start: dt.date, column: str = "service_day") -> DataFrame:
    """Days from `start` on. A literal, so it prunes partitions at the scan."""
    return df.where(F.col(column) >= F.lit(start))


def recompute_trip_reports(df: DataFrame, start: dt.date) -> DataFrame:
    """Trip-level reports of the window; undated ones always stay in."""
    return df.where((F.col("day_in_feed") >= F.lit(start)) | F.col("day_in_feed").isNull())


def report_partitions(log: DataFrame, start: dt.date) -> DataFrame:
    """Log partitions that can hold reports of the window: the log is cut by arrival date,
    and reports of a day arrive from the day before on."""
    return log.where(F.col("date") >= F.lit(start - dt.timedelta(days=1)))


def recompute_newest_version(df: DataFrame, newest: dt.date) -> DataFrame:
    """Versions from the newest stored one on; a half-written one heals."""
    return df.where(F.col("schedule_version") >= F.lit(newest))


def lookup_signature(lookup: DataFrame) -> DataFrame:
    """Content hash of a lookup table, whatever its row order.

    Two 60-bit hashes of each row are added and xor-ed, so rows fold in any order, partly in each
    task. Sums tell repeated rows apart, which cancel each other in an xor.
    """
    row = F.sha2(F.to_json(F.struct(*sorted(lookup.columns)), {"ignoreNullFields": "false"}), 256)
    hashes = lookup.select(*[F.conv(F.substring(row, 1 + 15 * k, 15), 16, 10).cast("long").alias(f"h{k}") for k in range(2)])
    folds = [F.count("*")]
    for k in range(2):
        folds += [F.sum(F.col(f"h{k}").cast("decimal(38,0)")), F.bit_xor(f"h{k}")]
    parts = [F.coalesce(f.cast("string"), F.lit("0")) for f in folds]
    return hashes.agg(F.sha2(F.concat_ws(":", *parts), 256).alias("signature"))


def full_rebuild_guard(lookups: dict[str, DataFrame], logged: DataFrame) -> DataFrame:
    """Lookups that feed stored days and have changed since the last full rebuild.

    `logged`: lookup, signature, finished (of each full rebuild). Lookups that only feed
    tables rebuilt every time do not belong into `lookups`. Unknown is not stale.
    """
    current = None
    for name, df in sorted(lookups.items()):
        one = lookup_signature(df).select(F.lit(name).alias("lookup"), F.col("signature").alias("now"))
        current = one if current is None else current.unionByName(one)
    last = logged.groupBy("lookup").agg(F.max_by("signature", "finished").alias("then"))
    stale: Column = F.col("then").isNotNull() & (F.col("then") != F.col("now"))
    return current.join(last, "lookup", "left").select(
        "lookup", "now", "then", stale.alias("stale"), F.col("then").isNull().alias("never_built")
    )
