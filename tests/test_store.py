"""Stored layers: what the planner takes them for."""

from pyspark.sql import functions as F

from stopwise import registry  # noqa: F401  (the queries register)
from stopwise.plans.queries import Context
from stopwise.sources.store import TableStore

LIMIT = 10 << 20  # Spark's threshold for broadcasts unless a cluster sets another


def planned(df):
    return df._jdf.queryExecution().sparkPlan().toString()


def size(df):
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def test_a_layer_of_equal_values_is_not_broadcast(spark, folder):
    """A million stops take a few kB in a file and hundreds of MB in the driver's table for a broadcast."""
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") in ("10485760", "10485760b", "10MB")
    store = TableStore(spark, folder)
    stops = store.keep("stops", lambda: spark.range(1_000_000).select(F.floor(F.col("id") / 1000).alias("k"), F.lit("Stop 1").alias("name")))
    assert size(spark.read.parquet(f"{store.root}/stops")) < LIMIT < size(stops)
    per_key = stops.groupBy("k", "name").agg(F.count("*").alias("n"))
    for other in (stops.withColumnRenamed("name", "other"), per_key.withColumnRenamed("name", "other")):
        assert "Broadcast" not in planned(stops.join(other, "k"))
    assert stops.join(per_key, ["k", "name"]).agg(F.count("*"), F.sum("n")).first() == (1_000_000, 1_000_000_000)


def test_a_small_layer_is_broadcast_and_an_empty_one_is_read(spark, folder):
    store = TableStore(spark, folder)
    lines = store.keep("lines", lambda: spark.range(24).select(F.col("id").alias("k"), F.lit("Line").alias("line")))
    assert "BroadcastHashJoin" in planned(spark.range(1_000_000).withColumnRenamed("id", "k").join(lines, "k"))
    none = store.keep("none", lambda: lines.where("k < 0"))
    assert none.count() == 0 and none.columns == ["k", "line"] and lines.join(none, "k").count() == 0


def test_layers_follow_the_settings_of_their_session(spark, folder):
    """Only the size comes from elsewhere: what is done with a layer runs in the session it was asked from."""
    rows = TableStore(spark, folder).keep("rows", lambda: spark.range(500_000).select((F.col("id") % 7).alias("k")))
    assert rows.sparkSession is spark
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        assert "hashpartitioning(k" in (plan := rows.groupBy("k").count()._jdf.queryExecution().executedPlan().toString()) and ", 3)" in plan
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_joins_of_the_timetable_broadcast_none_of_its_tables(spark):
    """At sf0.01 the stops of all versions take 8 kB in files and 790 kB as rows; a limit between the two stands for larger tables."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "64k")
    try:
        c = Context(spark, "/root/testdata/sf0.01")
        for table in (c.first.planned, c.first.runs, c.end_pairs, c.trip_shapes, c.second.planned):
            assert "BroadcastHashJoin" not in planned(table)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
