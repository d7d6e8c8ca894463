"""WARC archives with a two-level capture index.

Writing: payloads are compared by digest and length; of records with equal payloads of at least
`revisit_bytes` bytes the one with the largest page id is a response and the others are revisits that refer to it.
Each task writes its rows as one archive, a gzip member per record, under a draft name and moves it into
place, so a repeated task leaves one whole file. It returns a line per record: reversed-host URL key,
archive, offset and length. The lines are sorted by key and written as compressed blocks; a directory, stored as a
table, keeps the first key, file, offset and length of each block.

Reading: `lookup` finds the blocks of a URL by binary search over the directory, reads those blocks by
range, and then the records by range. `read_all` reads every block, deals the lines to their archives
and reads each archive's records by range in order of offset.

Defined cases: null html is an empty payload and always a response; a null URL has an empty key; a null page id
is kept and never referred to while another row of the payload has an id; rows that repeat the largest page id of a payload are
the same capture and all responses. Other columns are not read. Empty tables give an empty index.
"""

from __future__ import annotations

import bisect
import gzip
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stopwise.llm.shared import filesystem, new_folder, ship, write_file

REVISIT_BYTES = 1000
BLOCK_LINES = 1000
LINES = "key string, archive string, offset long, length long"
DIRECTORY = "first_key string, last_key string, file string, offset long, length long, n_lines long"
RECORDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"


def url_key(url: str | None) -> str:
    """Host parts reversed and joined by commas, then the path: com,example,www)/path?query."""
    if not url:
        return ""
    rest = re.sub(r"^[a-z][a-z0-9+.-]*://", "", url.strip(), flags=re.I)
    host, slash, path = re.match(r"([^/?#]*)(/?)(.*)", rest, re.S).groups()
    host = re.sub(r":(80|443)$", "", host.rsplit("@", 1)[-1].lower())
    path = path.split("#", 1)[0]
    return ",".join(reversed(host.split("."))) + ")/" + path


def _line(value: str) -> str:
    return re.sub(r"[\r\n]+", " ", value)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, kind: str, refers_to: int | None) -> bytes:
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Target-URI: {_line(url or '')}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if refers_to is not None:
        head.append(f"WARC-Refers-To: <urn:page:{refers_to}>")
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    body = payload if kind == "response" else b""
    head.append("Content-Type: text/html")
    head.append(f"Content-Length: {len(body)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    head, _, body = raw.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:] if ": " in x)
    return fields, body[: int(fields["Content-Length"])]


def _writer(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = f"{folder}/part-{TaskContext.get().partitionId():06d}.warc.gz"
        keys: list[str] = []
        offsets: list[int] = []
        lengths: list[int] = []

        def members():
            at = 0
            for batch in batches:
                for r in batch.to_pylist():
                    payload = (r["html"] or "").encode()
                    digest = hashlib.sha1(payload).hexdigest()
                    kind = "revisit" if r["refers_to"] is not None else "response"
                    member = gzip.compress(record(r["page_id"], r["url"], payload, digest, kind, r["refers_to"]), 6, mtime=0)
                    keys.append(url_key(r["url"]))
                    offsets.append(at)
                    lengths.append(len(member))
                    at += len(member)
                    yield member

        first = next(batches, None)
        if first is None:
            return
        rest = batches

        def chain():
            yield first
            yield from rest

        batches = chain()
        write_file(name, members())
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.string()), pa.array([name] * len(keys), pa.string()), pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64())],
            names=["key", "archive", "offset", "length"],
        )

    return run


def _index_writer(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = f"{folder}/part-{TaskContext.get().partitionId():06d}.idx"
        entries = []

        def blocks():
            at = 0
            lines: list[tuple] = []

            def block():
                nonlocal at
                raw = "\n".join("\t".join(map(str, x)) for x in lines).encode()
                packed = zlib.compress(raw, 6)
                entries.append((lines[0][0], lines[-1][0], name, at, len(packed), len(lines)))
                at += len(packed)
                lines.clear()
                return packed

            for batch in batches:
                for r in batch.to_pylist():
                    lines.append((re.sub(r"[\t\r\n]", " ", r["key"]), r["archive"], r["offset"], r["length"]))
                    if len(lines) == BLOCK_LINES:
                        yield block()
            if lines:
                yield block()

        if write_file(name, blocks()):
            names = [x.split()[0] for x in DIRECTORY.split(", ")]
            kinds = [pa.string()] * 3 + [pa.int64()] * 3
            columns = [pa.array(c, k) for c, k in zip(zip(*entries, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def decide(pages: DataFrame, revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """page_id, url, html, refers_to (null for responses)."""
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), html.alias("html"))
    rows = rows.withColumns({"n": F.octet_length("html"), "digest": F.sha1(F.col("html").cast("binary"))})
    copies = (
        rows.where(F.col("n") >= revisit_bytes)
        .groupBy("digest", "n")
        .agg(F.max("page_id").alias("newest"), F.count("*").alias("copies"))
        .where("copies > 1")
        .drop("copies")
    )
    refers = F.when(F.col("newest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("newest")), F.col("newest"))
    return rows.join(copies, ["digest", "n"], "left").select("page_id", "url", "html", refers.alias("refers_to"))


def write(pages: DataFrame, folder: str | None = None, revisit_bytes: int = REVISIT_BYTES) -> str:
    """Writes archives, index blocks and the directory; returns the folder."""
    spark = pages.sparkSession
    ship(spark)
    folder = folder or new_folder(spark, "warc")
    lines = decide(pages, revisit_bytes).mapInArrow(_writer(f"{folder}/archives"), LINES)
    lines.write.parquet(f"{folder}/lines")
    ordered = spark.read.parquet(f"{folder}/lines").repartitionByRange("key", "archive", "offset").sortWithinPartitions("key", "archive", "offset")
    ordered.mapInArrow(_index_writer(f"{folder}/index"), DIRECTORY).write.parquet(f"{folder}/directory")
    return folder


def _read_range(handles: dict, path: str, offset: int, length: int) -> bytes:
    if path not in handles:
        fs, inner = filesystem(path)
        handles.clear()
        handles[path] = fs.open_input_file(inner)
    handles[path].seek(offset)
    return handles[path].read(length)


def _block_lines(raw: bytes) -> list[tuple[str, str, int, int]]:
    rows = [x.split("\t") for x in zlib.decompress(raw).decode().split("\n")]
    return [(k, a, int(o), int(n)) for k, a, o, n in rows]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    handles: dict = {}
    for batch in batches:
        for r in batch.to_pylist():
            lines = _block_lines(_read_range(handles, r["file"], r["offset"], r["length"]))
            columns = list(zip(*lines, strict=True))
            kinds = [pa.string(), pa.string(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["key", "archive", "offset", "length"])


def _entry(fields: dict[str, str], payload: bytes) -> tuple:
    number = lambda name: int(m[1]) if (m := re.search(r"<urn:page:(-?\d+)>", fields.get(name, ""))) else None
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if fields["WARC-Type"] == "response" and hashlib.sha1(payload).hexdigest() != digest:
        raise ValueError(f"the payload of {fields['WARC-Record-ID']} doesn't have its digest")
    return number("WARC-Record-ID"), fields["WARC-Target-URI"], int(fields["X-Payload-Length"]), digest, fields["WARC-Type"], number("WARC-Refers-To")


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    handles: dict = {}
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    names = [x.split()[0] for x in RECORDS.split(", ")]
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            raw = gzip.decompress(_read_range(handles, r["archive"], r["offset"], r["length"]))
            rows.append(_entry(*parse(raw)))
        columns = list(zip(*rows, strict=True)) if rows else [[] for _ in kinds]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def read_all(spark: SparkSession, folder: str) -> DataFrame:
    """All records of the archives, by way of directory, blocks and ranges."""
    ship(spark)
    directory = spark.read.schema(DIRECTORY).parquet(f"{folder}/directory")
    # numbers that are given are not merged, however few bytes the lines have: a task per block, and as many for the records
    blocks = max(1, directory.count())
    lines = directory.repartition(blocks, "file", "offset").mapInArrow(_blocks, LINES)
    dealt = lines.repartitionByRange(blocks, "archive", "offset").sortWithinPartitions("archive", "offset")
    return dealt.mapInArrow(_records, RECORDS)


class Directory:
    """The directory in memory, for lookups of single URLs: one entry per block of lines, sorted by key."""

    def __init__(self, spark: SparkSession, folder: str):
        rows = spark.read.schema(DIRECTORY).parquet(f"{folder}/directory").orderBy("first_key", "last_key", "file", "offset").collect()
        self.rows = [r.asDict() for r in rows]
        self.last = [r["last_key"] for r in self.rows]
        self.handles: dict = {}

    def lookup(self, url: str) -> list[tuple]:
        """Captures of a URL: page_id, url, payload_bytes, payload_digest, record_type, refers_to."""
        key = re.sub(r"[\t\r\n]", " ", url_key(url))
        at, found = bisect.bisect_left(self.last, key), []
        while at < len(self.rows) and self.rows[at]["first_key"] <= key:
            r = self.rows[at]
            lines = _block_lines(_read_range(self.handles, r["file"], r["offset"], r["length"]))
            start = bisect.bisect_left(lines, (key,))
            for k, archive, offset, length in lines[start:]:
                if k != key:
                    break
                found.append(_entry(*parse(gzip.decompress(_read_range(self.handles, archive, offset, length)))))
            at += 1
        return found
