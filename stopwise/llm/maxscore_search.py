"""Exact top-k search by inner product over posting lists, with MaxScore.

Components are scaled to integers. A shard is a file of posting lists in the shared folder: for every component and sign the vectors that have it, in
runs of `RUN` vectors, with the largest magnitude of each run. A query has a term for each of its components and each sign. Lists of equal signs add to a score, with a
bound of query component times largest magnitude; lists of different signs only lower it, so their bound is 0. In each run the terms are split:
those of smallest bounds whose sum cannot lift a vector over the query's k-th score so far are non-essential. The postings of the essential terms are traversed and added
up; vectors that could still pass with the bounds of all other terms are probed in the other lists, heaviest terms first, and leave as
soon as they cannot pass. Until k scores are known, all terms are essential and all vectors are probed. Every block of queries meets every shard; the k best of
each shard are merged by a ranking per query.

Shards hold `SHARD_COMPONENTS` components, so that their size does not depend on the width of the vectors. Blocks of queries and shards travel as names of files,
never through a shuffle.

Defined cases: vectors that are null, or hold null or non-finite components, take no part, neither as query nor as candidate. Empty vectors and zero vectors score 0 with
everything. A component that is missing in the shorter of two vectors counts as 0. Scaled components are longs; larger ones become the largest long, and so do scores. Rows whose id is the
query's own are not its candidates. Rows of one id and one vector are asked once; rows of one id with different vectors are asked each. Repeated candidates stay each. Candidates without id come after all
others of their score; rows without id are not asked. Other columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import heapq
import io
import math
import uuid
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stopwise.llm.shared import cut, filesystem, new_folder, ship, write_file

SCALE = 256
TOP = 5
#: Vectors of a run, and values of a run laid out at a time.
RUN = 2048
RUN_VALUES = 1 << 22
#: Components of the vectors of a shard, and of a block of queries.
SHARD_COMPONENTS = 1 << 21
BLOCK_COMPONENTS = 1 << 15
#: Terms that are probed before vectors that cannot pass leave.
PROBED = 8
#: Up to here doubles and longs give the same whole numbers.
SAFE = float(1 << 52)
SAVED = ("ids", "known", "width", "run", "rows", "values", "first", "most")
#: Tasks; more pairs of shard and block share them.
MOST_TASKS = 20_000
LAST_ID = np.iinfo(np.int64).max


def scaled(embedding: str, scale: int = SCALE) -> Column:
    """floor(scale * x) of every component, null where the vector takes no part."""
    wide = F.col(embedding).cast("array<double>")
    usable = F.forall(wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(usable, F.transform(wide, lambda x: F.floor(F.lit(float(scale)) * x).cast("long")))


class Shard:
    """Posting lists of some vectors in the order of their ids, cut into runs."""

    def __init__(self, ids: np.ndarray, known: np.ndarray, sizes: np.ndarray, values: np.ndarray):
        self.ids, self.known = ids, known
        n, self.width = len(ids), int(sizes.max(initial=0))
        self.run = max(64, min(RUN, RUN_VALUES // max(1, self.width)))
        row = np.repeat(np.arange(n), sizes)
        place = np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        # a list is (run, component, sign)
        lists = ((row // self.run) * self.width + place) * 2 + (values < 0)
        some = np.flatnonzero(values)
        some = some[np.argsort(lists[some], kind="stable")]
        self.rows, self.values, lists = row[some], values[some], lists[some]
        n_lists = -(-n // self.run) * self.width * 2
        self.first = np.searchsorted(lists, np.arange(n_lists + 1))
        self.most = np.zeros(n_lists, np.float64)
        full = np.flatnonzero(np.diff(self.first))
        if len(full):
            most = np.maximum.reduceat(np.abs(self.values.astype(np.float64)), self.first[full])
            self.most[full] = np.where(most < SAFE, most, np.nextafter(most, np.inf))

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **{name: getattr(self, name) for name in SAVED})
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes) -> Shard:
        self, saved = cls.__new__(cls), np.load(io.BytesIO(data))
        for name in SAVED:
            setattr(self, name, saved[name])
        self.width, self.run = int(self.width), int(self.run)
        return self

    def forward(self, run: int) -> np.ndarray:
        """The values of a run by (component, vector), to probe lists at given vectors."""
        low = run * self.run
        out = np.zeros((self.width, min(self.run, len(self.ids) - low)), np.int64)
        span = slice(self.first[run * self.width * 2], self.first[(run + 1) * self.width * 2])
        component = np.repeat(np.arange(self.width * 2), np.diff(self.first[run * self.width * 2 : (run + 1) * self.width * 2 + 1])) // 2
        out[component, self.rows[span] - low] = self.values[span]
        return out

    def search(self, queries: list[Query]) -> None:
        """Offers the vectors of every run to all queries; runs are outside, so a run's values are laid out once."""
        for run in range(-(-len(self.ids) // self.run)):
            forward = self.forward(run)
            for query in queries:
                self._run(run, forward, query)

    def _run(self, run: int, forward: np.ndarray, query: Query) -> None:
        low, least = run * self.run, query.least()
        components = query.components[query.components < self.width]
        weights = query.vector[components]
        at = (run * self.width + components) * 2
        same, against = at + (weights < 0), at + (weights > 0)
        steep = np.abs(weights.astype(np.float64))
        bounds = steep * self.most[same]
        # beyond the range of longs and of exact doubles, integers without bound
        wide = bool((steep * np.maximum(self.most[same], self.most[against])).sum() >= SAFE)
        if wide:
            forward, weights = forward.astype(object), weights.astype(object)
            bounds = np.array([abs(int(w)) * int(m) for w, m in zip(weights, self.most[same])], object)
        ranked = np.argsort(-bounds.astype(np.float64), kind="stable")
        # rests[k]: what all terms from the k-th on can add
        rests = np.concatenate((np.cumsum(bounds[ranked][::-1])[::-1], [0]))
        scores = np.zeros(forward.shape[1], object if wide else np.int64)
        essential = len(ranked) if least is None else int(np.argmax(rests <= least)) if rests[-1] <= least else len(ranked)
        for k in ranked[:essential]:
            span = slice(self.first[same[k]], self.first[same[k] + 1])
            scores[self.rows[span] - low] += self.values[span].astype(scores.dtype, copy=False) * weights[k]
        alive = np.arange(len(scores)) if least is None else np.flatnonzero(scores + rests[essential] > least)
        alive = alive[~((self.ids[low + alive] == query.own) & self.known[low + alive])]
        # traversed components only have their lists of the other sign left; they weigh most, so they come first
        for at in range(0, len(ranked), PROBED):
            if not len(alive):
                return
            some = ranked[at : at + PROBED]
            part = forward[np.ix_(components[some], alive)] * weights[some][:, None]
            traversed = max(0, min(essential - at, len(some)))
            part[:traversed] = np.minimum(part[:traversed], 0)
            scores[alive] += part.sum(axis=0)
            query.probed += len(alive)
            if least is not None:
                alive = alive[scores[alive] + rests[max(essential, min(at + PROBED, len(ranked)))] > least]
        query.offer([(int(scores[v]), low + int(v)) for v in alive] if wide else zip(scores[alive].tolist(), (low + alive).tolist()))


class Query:
    """A query vector, and the best vectors of a shard so far: (score, place), ties to the smaller place."""

    def __init__(self, own: int, vector: np.ndarray, top: int):
        self.own, self.vector, self.top = own, vector, top
        self.components = np.flatnonzero(vector)
        self.best: list[tuple[int, int]] = []
        self.probed = 0

    def least(self) -> int | None:
        """The score that a later vector must pass."""
        return self.best[-1][0] if len(self.best) == self.top else None

    def offer(self, found) -> None:
        self.best = heapq.nsmallest(self.top, chain(self.best, found), key=lambda x: (-x[0], x[1]))


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    for batch in batches:
        ids, lists = batch.column(0), batch.column(1)
        known = ~np.asarray(ids.is_null())
        sizes = lists.value_lengths().to_numpy().astype(np.int64)
        yield ids.fill_null(LAST_ID).to_numpy(), known, sizes, lists.flatten().to_numpy()


def _write_shards(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def close() -> pa.RecordBatch:
            ids, known, sizes, values = (np.concatenate(x) for x in zip(*held))
            order = np.lexsort((~known, ids))
            starts = np.cumsum(sizes) - sizes
            ranges = np.repeat(starts[order] - (np.cumsum(sizes[order]) - sizes[order]), sizes[order])
            shard = Shard(ids[order], known[order], sizes[order], values[np.arange(len(values)) + ranges])
            name = uuid.uuid4().hex
            write_file(f"{folder}/{name}", [shard.dump()])
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([len(ids)], pa.int64())], names=["file", "vectors"])

        for part in _vectors(batches):
            held.append(part)
            if sum(len(p[3]) + len(p[0]) for p in held) >= SHARD_COMPONENTS:
                yield close()
                held = []
        if held:
            yield close()

    return run


def write_index(vectors: DataFrame, folder: str, shards: int) -> DataFrame:
    """file, vectors: deals (vec_id, v) into shards and writes them to the folder."""
    ship(vectors.sparkSession)
    dealt = vectors.select("vec_id", "v").repartition(shards, F.xxhash64("vec_id", "v"))
    return cut(dealt.mapInArrow(_write_shards(folder), "file string, vectors long"))


@lru_cache(maxsize=1)
def _shard(path: str) -> Shard:
    fs, inner = filesystem(path)
    with fs.open_input_file(inner) as source:
        return Shard.load(source.read())


def _search(folder: str, top: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for task in batch.to_pylist():
                fs, inner = filesystem(f"{folder}/queries/block={task['block']}")
                if fs.get_file_info(inner).type == pafs.FileType.NotFound:
                    continue
                shard = _shard(f"{folder}/{task['file']}")
                asked = pq.read_table(inner, filesystem=fs, partitioning=None)
                queries = [Query(q, np.array(v, np.int64), top) for q, v in zip(asked["query_id"].to_pylist(), asked["v"].to_pylist())]
                shard.search(queries)
                of = np.repeat(np.arange(len(queries)), [len(q.best) for q in queries])
                places = np.array([p for q in queries for _, p in q.best], np.int64)
                scores = [min(max(s, -LAST_ID - 1), LAST_ID) for q in queries for s, _ in q.best]
                yield pa.RecordBatch.from_arrays(
                    [
                        asked["query_id"].combine_chunks().take(pa.array(of)),
                        asked["asked"].combine_chunks().take(pa.array(of)),
                        pa.array(shard.ids[places], mask=~shard.known[places]),
                        pa.array(scores, pa.int64()),
                    ],
                    names=["query_id", "asked", "vec_id", "score"],
                )

    return run


def search(rows: DataFrame, queries: Column, top: int = TOP, scale: int = SCALE) -> DataFrame:
    """query_id, rank, vec_id, score: the best rows of (vec_id, embedding) for each row that `queries` marks."""
    spark = rows.sparkSession
    ship(spark)
    folder = new_folder(spark, "maxscore")
    vectors = rows.select(F.col("vec_id").cast("long").alias("vec_id"), scaled("embedding", scale).alias("v"), F.coalesce(queries, F.lit(False)).alias("is_query"))
    vectors = vectors.where("v is not null")
    # `asked` tells vectors of one id apart
    wanted = vectors.where("is_query and vec_id is not null").select(F.col("vec_id").alias("query_id"), F.sha2(F.to_json("v"), 256).alias("asked"), "v")
    wanted = wanted.groupBy("query_id", "asked").agg(F.any_value("v").alias("v"))
    size = F.coalesce(F.sum(F.size("v") + 1), F.lit(0))
    values, asked = vectors.agg(size, F.coalesce(F.sum(F.when(F.col("is_query"), F.size("v") + 1)), F.lit(0))).first()
    blocks, shards = math.ceil(max(1, asked) / BLOCK_COMPONENTS), math.ceil(max(1, values) / SHARD_COMPONENTS)
    block = F.pmod(F.xxhash64("query_id", "asked"), F.lit(blocks)).cast("int")
    wanted.withColumn("block", block).repartition(blocks, "block").write.partitionBy("block").parquet(f"{folder}/queries")
    index = write_index(vectors, folder, shards)
    tasks = index.select("file", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    tasks = tasks.repartition(min(shards * blocks, MOST_TASKS), "file", "block")
    found = tasks.mapInArrow(_search(folder, top), "query_id long, asked string, vec_id long, score long")
    order = Window.partitionBy("query_id", "asked").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")
