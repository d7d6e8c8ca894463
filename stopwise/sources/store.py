"""Intermediate tables in the shared folder of the session.

A layer that several marts read is written once and read back. That cuts the lineage in a
way that survives lost executors, and it lets every reader prune columns at the scan.
"""

from __future__ import annotations

import hashlib
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_ROWS: dict[str, int] = {}  # rows of the tables that this application has stored, by path


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names; a temporary one only for a local session without it."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="stopwise-")
    spark.conf.set("spark.checkpoint.dir", folder)
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def bytes_below(spark: SparkSession, path: str) -> int:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(hadoop_path).getLength()


def remove(spark: SparkSession, path: str) -> None:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Writes a small file beside its place and moves it over the old one in one step."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    place = jvm.org.apache.hadoop.fs.Path(path)
    draft = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}")
    out = place.getFileSystem(conf).create(draft, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    renames = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    renames[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(place.getFileSystem(conf).getUri(), conf)
    files.rename(files.makeQualified(draft), files.makeQualified(place), renames)


class TableStore:
    """Tables of one application and one input folder."""

    def __init__(self, spark: SparkSession, scope: str):
        digest = hashlib.sha256(scope.encode()).hexdigest()[:16]
        app = spark.sparkContext.applicationId
        self.spark = spark
        self.root = f"{shared_folder(spark)}/stopwise-{app}/{digest}"
        self._readers: dict[int, object] = {}

    def keep(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """The stored table, built first if this application has not written it yet."""
        path = f"{self.root}/{name}"
        if not path_exists(self.spark, f"{path}/_SUCCESS"):
            build().write.mode("overwrite").option("compression", "zstd").parquet(path)
        return self.read(path)

    def read(self, path: str) -> DataFrame:
        """A stored table that the planner takes to be as large as its rows, not as its files.

        Layers hold long runs of equal values, so their files are up to several hundred times smaller than their
        rows. By file size, a table of millions of rows passes for one to broadcast, and fills the driver and every executor.
        """
        plain = self.spark.read.parquet(path)
        if path not in _ROWS:
            _ROWS[path] = plain.count()
        rows = _ROWS[path] * (8 + plain._jdf.schema().defaultSize())
        times = -(-rows // max(1, bytes_below(self.spark, path)))
        if times <= 1:
            return plain
        plan = self._reader(1 << (times - 1).bit_length()).read().format("parquet").load(path).queryExecution().analyzed()
        frames = getattr(self.spark._jvm.org.apache.spark.sql.classic, "Dataset$")
        return DataFrame(getattr(frames, "MODULE$").ofRows(self.spark._jsparkSession, plan), self.spark)

    def _reader(self, factor: int):
        """A session like this one whose scans count a byte of a file as `factor` bytes; a scan keeps the session it was made in."""
        if factor not in self._readers:
            session = self.spark._jsparkSession.cloneSession()
            session.conf().set("spark.sql.sources.fileCompressionFactor", str(float(factor)))
            self._readers[factor] = session
        return self._readers[factor]


def lazy(name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """Store nothing: the layer stays part of the plan that uses it."""
    return build()
