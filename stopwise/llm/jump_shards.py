"""Sharding by jump consistent hashing.

A row's shard follows from its key and the number of shards alone; there is no table of the ring. When
shards are appended, a row either stays or moves into one of the new shards. Slots number the rows of a
shard from 0 without gaps: rows are numbered inside small buckets of a shard, and the buckets' sizes give
each bucket its first slot, so no task orders a whole shard.

Defined cases: a null key hashes like any other value, so all rows without a key share a shard; rows that
repeat a key share it, too. Null texts have size 1 and the checksum of no bytes. Empty tables give no rows. `assign` keeps
all columns of its input; columns named as its own are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stopwise.llm.shared import ship

LAW = "key"


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """Jump consistent hash of unsigned 64-bit keys."""
    key = keys.astype(np.uint64)
    at, last = np.zeros(len(key), np.int64), np.zeros(len(key), np.int64)
    left = np.arange(len(key))
    while len(left):
        last[left] = at[left]
        key[left] = key[left] * np.uint64(2862933555777941757) + np.uint64(1)
        at[left] = ((last[left] + 1) * (float(1 << 31) / ((key[left] >> np.uint64(33)).astype(np.float64) + 1))).astype(np.int64)
        left = left[at[left] < shards]
    return last


def shard(key: Column, shards: int) -> Column:
    """Shard of a key of any type, from 0 to shards - 1."""

    @F.pandas_udf("int")
    def place(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(jump(batch.to_numpy(np.int64).view(np.uint64), shards).astype(np.int32))

    return place(F.xxhash64(key))


def assign(rows: DataFrame, key: str, shards: int, order: list[str], buckets: int) -> DataFrame:
    """rows with shard, slot and grown_shard (the shard if there were one more).

    order: columns that order the rows of a bucket; rows equal in all of them are alike.
    buckets: parts of a shard whose rows are numbered together; let it grow with the rows.
    """
    ship(rows.sparkSession)
    own = rows.drop("shard", "slot", "grown_shard").withColumns(
        {"shard": shard(F.col(key), shards), "grown_shard": shard(F.col(key), shards + 1)}
    )
    own = own.withColumn("__bucket", F.pmod(F.xxhash64(F.lit(1), *order), F.lit(buckets)).cast("int"))
    sizes = own.groupBy("shard", "__bucket").agg(F.count("*").alias("__n"))
    before = Window.partitionBy("shard").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("__first", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    inside = Window.partitionBy("shard", "__bucket").orderBy(*order)
    return (
        own.withColumn("slot", F.row_number().over(inside) - 1)
        .join(sizes, ["shard", "__bucket"])
        .withColumn("slot", (F.col("slot") + F.col("__first")).cast("int"))
        .drop("__bucket", "__first")
    )


def shard_documents(docs: DataFrame, shards: int = 16, buckets: int = 64) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit(LAW).alias("law"),
    )
    return assign(rows, "doc_id", shards, ["doc_id", "size", "text_crc32"], buckets)


def write_shards(rows: DataFrame, path: str) -> None:
    """One folder per shard, files of rows; slot keeps the place inside the shard."""
    rows.repartition("shard", F.pmod(F.xxhash64("slot"), F.lit(16))).write.partitionBy("shard").mode("overwrite").parquet(path)
