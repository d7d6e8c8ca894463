"""Helpers of the operators: shared folders, files in them, stored tables, connected components."""

from __future__ import annotations

import os
import pickle
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


PACKAGE = Path(__file__).resolve().parents[1]
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this library to the executors once per application, for the functions that run in tasks."""
    app = spark.sparkContext.applicationId
    if app in _shipped or not PACKAGE.is_dir():
        return
    archive = Path(tempfile.mkdtemp(prefix="ship-")) / f"{PACKAGE.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(PACKAGE.rglob("*.py")):
            out.write(source, source.relative_to(PACKAGE.parent))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(app)


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; set here only where it is unset, as in tests."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="llm-")
        spark.conf.set("spark.checkpoint.dir", folder)
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Writes the rows to the shared folder; later plans start from them."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def made_in_task(rows: DataFrame, order: list[str], make: Callable[[pa.Table], object]) -> object:
    """What `make` gives for the rows of a bounded sample, in this order, in a task of its own: neither the sample nor the work on it
    stands in the driver's memory. Without rows there may be no task, and `make` gets none of them here."""
    ship(rows.sparkSession)
    names = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if held:
            made = pickle.dumps(make(pa.Table.from_batches(held)))
            yield pa.RecordBatch.from_arrays([pa.array([made], pa.binary())], ["made"])

    found = rows.repartition(1).sortWithinPartitions(*order).mapInArrow(run, "made binary").toArrow()["made"].to_pylist()
    return pickle.loads(found[0]) if found else make(pa.table({n: pa.array([], pa.string()) for n in names}))


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """The store of a path and the path in it: local folders and whatever pyarrow can reach."""
    if "://" not in path and not path.startswith("file:"):
        return pafs.LocalFileSystem(), path
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return pafs.FileSystem.from_uri(path)


def write_file(path: str, parts) -> int:
    """Writes under a name of its own and then moves it, so that a repeated task leaves one whole file."""
    fs, inner = filesystem(path)
    fs.create_dir(os.path.dirname(inner), recursive=True)
    draft = f"{inner}.{uuid.uuid4().hex}"
    size = 0
    with fs.open_output_stream(draft) as out:
        for part in parts:
            out.write(part)
            size += len(part)
    fs.move(draft, inner)
    return size


def crc_of_id(column: str = "doc_id") -> Column:
    return F.crc32(F.col(column).cast("string").cast("binary"))


def forest(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Places of edges that connect what all edges connect: one edge for each vertex that joins a larger tree."""
    names, inverse = np.unique(np.concatenate((a, b)), return_inverse=True)
    x, y = inverse[: len(a)], inverse[len(a) :]
    root = np.arange(len(names))
    keep = []
    alive = np.flatnonzero(x != y)
    while len(alive):
        low, high = np.minimum(root[x[alive]], root[y[alive]]), np.maximum(root[x[alive]], root[y[alive]])
        apart = low != high
        alive, low, high = alive[apart], low[apart], high[apart]
        if not len(alive):
            break
        # each root hooks to one smaller root; roots only point down, so no cycle forms
        _, first = np.unique(high, return_index=True)
        keep.append(alive[first])
        root_of = np.arange(len(names))
        root_of[high[first]] = low[first]
        while True:
            next_root = root_of[root_of]
            if (next_root == root_of).all():
                break
            root_of = next_root
        root = root_of[root]
    return np.concatenate(keep) if keep else np.zeros(0, int)


def _ends(graph: DataFrame) -> DataFrame:
    """(node, lo, other): both ends of each edge, with its lower end and the end opposite."""
    return graph.select(
        F.explode(F.array(F.struct(F.col("hi").alias("node"), "lo", F.col("lo").alias("other")), F.struct(F.col("lo").alias("node"), "lo", F.col("hi").alias("other")))).alias("e")
    ).select("e.*")


def _are_stars(graph: DataFrame) -> bool:
    """Whether each node stands below one node only, or above others only: the lower ends then name the components."""
    return _ends(graph).groupBy("node").agg(F.min("lo").alias("low"), F.max("lo").alias("high")).where("low < high").isEmpty()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node that links reach, for every node of an edge.

    Large-star and small-star steps: each points the neighbours of a node at the smallest of them,
    through an aggregate and a join, so no neighbourhood is gathered in one place. The graph is
    written to the shared folder after each step, until it consists of stars; the number of steps grows
    with the logarithm of the longest path. Edges with a null end or two equal ends are left out.
    """
    graph = cut(
        edges.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).where("hi > lo").distinct()
    )
    while not _are_stars(graph):
        least = _ends(graph).groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("m"))
        # rows that repeat are left for the end of the step: they are no more than the edges
        large = (
            graph.join(least.withColumnRenamed("node", "lo"), "lo")
            .select("hi", F.col("m").alias("lo"))
            .union(least.where("m < node").select(F.col("node").alias("hi"), F.col("m").alias("lo")))
        )
        low = large.groupBy("hi").agg(F.min("lo").alias("m"))
        graph = cut(
            large.join(low, "hi")
            .select(F.explode(F.array(F.struct("hi", F.col("m").alias("lo")), F.struct(F.col("lo").alias("hi"), F.col("m").alias("lo")))).alias("e"))
            .select("e.*")
            .where("hi > lo")
            .distinct()
        )
    star = graph.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
    return star.union(graph.select(F.col("lo"), F.col("lo"))).distinct()
