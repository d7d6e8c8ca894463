"""Snapshot files -> numbered polls.

A collector stores what it fetched, one document a file, in whatever layout the feed has. The feed does not
count polls and its header may stand still, so the poll clock is the file's own time, and polls are
numbered by it. A document may bring `poll` and `polled_at` itself; then these hold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stopwise.operators.neighbours import dense_numbers
from stopwise.sources import schemas
from stopwise.sources.scan import matching_paths

CLOCK_BUCKET_SEC = 86_400


def _documents(text: Column) -> Column:
    """The documents of a file: one for each line if every line is one, else the whole file as one."""
    lines = F.filter(F.split(text, "\n"), lambda x: F.trim(x) != "")
    each = F.transform(lines, lambda x: F.from_json(x, schemas.FEED))
    by_line = (F.size(each) > 0) & F.forall(each, lambda d: d["entity"].isNotNull())
    return F.when(by_line, each).otherwise(F.array(F.from_json(text, schemas.FEED)))


def read_snapshots(spark: SparkSession, folder: str, stream: bool = False, files_per_trigger: int = 1000) -> DataFrame:
    """All documents with `file` and `polled_at`; those that are no snapshot have a null `entity`."""
    reader = spark.readStream.option("maxFilesPerTrigger", files_per_trigger) if stream else spark.read
    files = reader.text(folder, wholetext=True).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_modification_time").alias("file_time")
    )
    documents = files.select("file", "file_time", F.explode(_documents(F.col("value"))).alias("d"))
    return documents.select(
        F.col("d.header").alias("header"),
        F.col("d.poll").alias("poll"),
        F.coalesce("d.polled_at", F.unix_seconds("file_time")).alias("polled_at"),
        F.col("d.entity").alias("entity"),
        "file",
        "file_time",
    )


def with_numbers(documents: DataFrame, after: int = -1) -> DataFrame:
    """Numbers the polls that bring no number from `after` + 1 on, in the order of their clock and file."""
    clock = F.struct(F.coalesce(F.timestamp_seconds("polled_at"), F.col("file_time")).alias("at"), "file_time", "file")
    keyed = documents.withColumn("_clock", clock)
    numbers = dense_numbers(
        keyed.where("poll is null"), "_clock", F.floor(F.unix_seconds(F.col("_clock.at")) / CLOCK_BUCKET_SEC), "_number"
    )
    return keyed.join(numbers, "_clock", "left").withColumn("poll", F.coalesce("poll", F.col("_number") + after + 1)).drop("_clock", "_number")


def valid_snapshots(documents: DataFrame) -> DataFrame:
    return documents.where("entity is not null")


def rejected_files(documents: DataFrame) -> DataFrame:
    """Files that hold something else than snapshots; each costs only itself."""
    return documents.where("entity is null").select("file", "file_time").distinct()


def _last_number(spark: SparkSession, landing: str, before: int) -> int:
    """The highest poll number of the batches before this one."""
    if not matching_paths(spark, f"{landing}/numbers/batch=*"):
        return -1
    last = spark.read.schema("last long, batch long").parquet(f"{landing}/numbers").where(F.col("batch") < before).agg(F.max("last")).first()[0]
    return -1 if last is None else last


def land_snapshots(spark: SparkSession, folder: str, landing: str, files_per_trigger: int = 1000) -> None:
    """Takes the files that have arrived and stores their polls with numbers, each batch under its own name.

    A batch that is repeated after a failure overwrites what it has left and gets the same numbers.
    """

    def land(files: DataFrame, batch: int) -> None:
        after = _last_number(spark, landing, batch)
        files.write.mode("overwrite").parquet(f"{landing}/read/batch={batch}")
        documents = spark.read.parquet(f"{landing}/read/batch={batch}")
        bad = rejected_files(documents)
        bad.write.mode("overwrite").parquet(f"{landing}/rejected/batch={batch}")
        path = f"{landing}/polls/batch={batch}"
        with_numbers(valid_snapshots(documents), after).write.mode("overwrite").parquet(path)
        last = spark.read.parquet(path).agg(F.greatest(F.max("poll"), F.lit(after)).alias("last"))
        last.write.mode("overwrite").parquet(f"{landing}/numbers/batch={batch}")

    query = (
        read_snapshots(spark, folder, True, files_per_trigger)
        .writeStream.foreachBatch(land)
        .option("checkpointLocation", f"{landing}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def landed_snapshots(spark: SparkSession, landing: str, files_per_trigger: int = 1000) -> DataFrame:
    """The numbered polls as a stream."""
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.FEED)
    schema = f"{fields}, file string, file_time timestamp, batch long"
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(f"{landing}/polls")
