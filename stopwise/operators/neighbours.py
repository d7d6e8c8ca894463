"""Previous row and running rank for keys of any size.

A plain window keeps one key in one task. Here the rows of a key are split into buckets of
the order column; only the last row of each bucket crosses the border.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def with_previous(
    df: DataFrame, keys: list[str], bucket: str, order: list[str], values: list[str], name: str
) -> DataFrame:
    """Adds struct `name` with `values` of the row before in `order`, NULL for the first.

    `bucket` must not decrease along `order`.
    """
    row = F.struct(*values)
    inside = Window.partitionBy(*keys, bucket).orderBy(*order)
    lasts = (
        df.groupBy(*keys, bucket)
        .agg(F.max_by(row, F.struct(*order)).alias("_last"))
        .withColumn("_before", F.lag("_last").over(Window.partitionBy(*keys).orderBy(bucket)))
        .drop("_last")
    )
    return (
        df.withColumn("_inside", F.lag(row).over(inside))
        .join(lasts, [*keys, bucket])
        .withColumn(name, F.coalesce("_inside", "_before"))
        .drop("_inside", "_before")
    )


def dense_numbers(values: DataFrame, column: str, bucket: Column, name: str) -> DataFrame:
    """Distinct values of a column numbered from 0 in order, without one big window.

    Each bucket numbers its own values; the buckets' sizes, added up, shift them.
    """
    distinct = values.select(column).distinct().withColumn("_bucket", bucket)
    sizes = distinct.groupBy("_bucket").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select("_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    rank = F.row_number().over(Window.partitionBy("_bucket").orderBy(column))
    return (
        distinct.withColumn("_rank", rank)
        .join(shifts, "_bucket")
        .select(column, (F.col("_shift") + F.col("_rank") - 1).alias(name))
    )
