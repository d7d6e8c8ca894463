"""Near-duplicate embeddings by hierarchical navigable small-world graphs, one per shard.

Equal vectors are first collapsed to one row. The distinct vectors are dealt into shards of `SHARD_BYTES` by a hash; each shard
builds a graph: every vector gets a random top level and is linked on each level to its nearest
neighbours found by beam search. A shard is one file in the shared folder. Then blocks of the vectors of every shard are searched in the graph of
every shard: from the top level down to level 0 with a beam; what the beam finds at or above the threshold is expanded over its
neighbours until nothing new appears. Cosines are verified in double precision. Each block audits its beam in a shard by two kinds of
queries whose links are known: `AUDIT` probes, vectors of the shard turned in a random direction until their cosine to the vector
is the threshold, which is as hard as a link gets; and the links that brute force finds for `AUDIT` random queries of the block. While the beam finds
less than `PROBE_RECALL` of the probes or `RECALL` of the links, it is doubled; where it would exceed `WIDEST`, brute force answers the block.

A block of queries against a shard returns how many links each query has (copies counted) and a spanning
forest of the links, not the links themselves, so a dense group costs rows in proportion to its vectors.
The forests are joined to connected components.

Defined cases: null vectors, zero vectors, vectors with null or non-finite components link with nothing, not even
with their copies; components of any finite size are scaled before the cosine; vectors of different lengths never link; rows that repeat a vector are linked with each other; a null
id is never a representative, and rows of a component whose ids are all null have a null component. Other columns are not read.
An empty table gives no rows.
"""

from __future__ import annotations

import io
import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopwise.llm.shared import components, cut, filesystem, forest, new_folder, ship, write_file

THRESHOLD = 0.95
#: Bytes of the vectors of a shard, so that its graph and a block of queries fit in a task whatever the width.
SHARD_BYTES = 64 << 20
#: Queries that one task takes.
BLOCK_ROWS = 8_192
NEIGHBOURS = 12
BUILD_BEAM = 32
BEAM = 16
WIDEST = 256
#: Probes, and queries answered by brute force, of an audit.
AUDIT = 256
#: Cosines that brute force holds at a time.
COSINES = 1 << 22
RECALL = 0.98
#: Share of probes that the beam must find.
PROBE_RECALL = 0.999
LOCKSTEP = 1024
#: Tasks; more blocks share them.
MOST_TASKS = 20_000


def unit(vectors: np.ndarray) -> np.ndarray:
    wide = vectors.astype(np.float64)
    wide = wide / np.abs(wide).max(axis=1, keepdims=True)
    return wide / np.linalg.norm(wide, axis=1, keepdims=True)


class Graph:
    """Levels of neighbour lists; level 0 holds all vectors, each with up to 2 * NEIGHBOURS neighbours (-1: none)."""

    def __init__(self, vectors: np.ndarray, seed: int = 5):
        self.v = vectors.astype(np.float32)
        n = len(vectors)
        random = np.random.default_rng(seed)
        top = np.minimum((-np.log(random.random(n) + 1e-12) / math.log(NEIGHBOURS)).astype(int), 12)
        self.members = [np.flatnonzero(top >= level) for level in range(int(top.max(initial=0)) + 1)]
        self.neighbours = [np.full((n if level == 0 else len(m), 2 * NEIGHBOURS), -1, np.int32) for level, m in enumerate(self.members)]
        self.place = [np.zeros(n, np.int32) for _ in self.members]
        for level, m in enumerate(self.members):
            self.place[level][m] = np.arange(len(m))
        for level in range(len(self.members) - 1, -1, -1):
            self._build(level)

    def _build(self, level: int) -> None:
        """Links the members of a level. Members join in rounds that double what is linked; those of a round search
        the members before them and see each other exactly in blocks."""
        members = self.members[level]
        done = min(len(members), 256)
        self._exact(level, members[:done])
        while done < len(members):
            fresh = members[done : done * 2]
            for at in range(0, len(fresh), LOCKSTEP):
                some = fresh[at : at + LOCKSTEP]
                starts = self._descend(self.v[some], level + 1, members[:done])
                found, close = self._beam(level, self.v[some], starts, BUILD_BEAM)
                mates = self.v[some] @ self.v[some].T
                np.fill_diagonal(mates, -2)
                k = min(NEIGHBOURS, len(some))
                near = np.argpartition(-mates, k - 1, axis=1)[:, :k]
                self._link(level, some, np.hstack((found, some[near])), np.hstack((close, np.take_along_axis(mates, near, 1))))
            done += len(fresh)

    def _exact(self, level: int, members: np.ndarray) -> None:
        close = self.v[members] @ self.v[members].T
        np.fill_diagonal(close, -2)
        self._link(level, members, np.broadcast_to(members, close.shape), close)

    def _link(self, level: int, own: np.ndarray, found: np.ndarray, close: np.ndarray) -> None:
        """Keeps a diverse half and the nearest rest as neighbours of `own`, and adds the links back."""
        close = np.where((found < 0) | (found == own[:, None]), -2, close)
        order = np.argsort(-close, axis=1)[:, : 3 * NEIGHBOURS]
        found, close = np.take_along_axis(found, order, 1), np.take_along_axis(close, order, 1)
        k = found.shape[1]
        # a candidate nearer to a kept one than to the vector itself waits behind the others
        among = np.einsum("nid,njd->nij", self.v[found], self.v[found])
        kept = np.zeros(found.shape, bool)
        for j in range(k):
            shadow = (kept[:, :j] & (among[:, j, :j] > close[:, j : j + 1])).any(1) if j else np.zeros(len(own), bool)
            kept[:, j] = ~shadow & (close[:, j] > -2)
        rank = np.argsort(np.where(close > -2, np.where(kept, 0, 1), 2), axis=1, kind="stable")[:, :NEIGHBOURS]
        chosen = np.where(np.take_along_axis(close, rank, 1) > -2, np.take_along_axis(found, rank, 1), -1)
        table, at = self.neighbours[level], self.place[level][own]
        table[at, :NEIGHBOURS] = -1
        table[at, : chosen.shape[1]] = chosen
        back = np.repeat(own, chosen.shape[1])
        to = chosen.ravel()
        back, to = back[to >= 0], to[to >= 0]
        listed = (table[self.place[level][to], :NEIGHBOURS] == back[:, None]).any(1)
        back, to = back[~listed], to[~listed]
        order = np.lexsort((-np.einsum("nd,nd->n", self.v[back], self.v[to]), to))
        back, to = back[order], to[order]
        seat = np.arange(len(to)) - np.searchsorted(to, to)
        rows = self.place[level][to]
        # links back fill the second half of a list; when it is full, the newest nearest take the last seats
        used = (table[rows, NEIGHBOURS:] >= 0).sum(1)
        seat = np.where(used + seat < NEIGHBOURS, used + seat, NEIGHBOURS - 1 - seat % NEIGHBOURS)
        table[rows, NEIGHBOURS + seat] = back

    def _descend(self, queries: np.ndarray, level: int, otherwise: np.ndarray) -> np.ndarray:
        """Start of each query on the level below `level`."""
        if level >= len(self.members):
            some = otherwise[:256]
            return some[(queries @ self.v[some].T).argmax(1)][:, None]
        some = self.members[-1][:64]
        starts = some[(queries @ self.v[some].T).argmax(1)][:, None]
        for at in range(len(self.members) - 1, level - 1, -1):
            starts = self._beam(at, queries, starts, 4)[0][:, :4]
        return starts

    def _beam(self, level: int, queries: np.ndarray, starts: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Best-first search of all queries in step: (found, cosine) with `beam` columns, nearest first (-1: none)."""
        n, table, place = len(queries), self.neighbours[level], self.place[level]
        seen = np.zeros((n, len(self.v)), bool) if n * len(self.v) <= 1 << 26 else None
        if seen is None:
            half = n // 2
            parts = [self._beam(level, queries[s], starts[s], beam) for s in (slice(0, half), slice(half, n))]
            return np.vstack([p[0] for p in parts]), np.vstack([p[1] for p in parts])
        found, close = np.full((n, beam), -1, np.int64), np.full((n, beam), -2.0, np.float32)
        opened = np.zeros((n, beam), bool)
        k = min(beam, starts.shape[1])
        found[:, :k] = starts[:, :k]
        close[:, :k] = np.where(starts[:, :k] >= 0, np.einsum("nkd,nd->nk", self.v[starts[:, :k]], queries), -2)
        rows, cols = np.nonzero(found >= 0)
        seen[rows, found[rows, cols]] = True
        active = np.arange(n)
        while len(active):
            ready = np.where(opened[active] | (found[active] < 0), -3, close[active])
            pick = ready.argmax(1)
            some = ready[np.arange(len(active)), pick] > -2
            active, pick = active[some], pick[some]
            if not len(active):
                break
            opened[active, pick] = True
            near = table[place[found[active, pick]]]
            near = np.where(near >= 0, near, 0)
            fresh = ~seen[active[:, None], near] & (table[place[found[active, pick]]] >= 0)
            seen[active[:, None], near] |= fresh
            cos = np.where(fresh, np.einsum("nkd,nd->nk", self.v[near], queries[active]), -2)
            wide_f = np.hstack((found[active], near))
            wide_c = np.hstack((close[active], cos.astype(np.float32)))
            wide_o = np.hstack((opened[active], np.zeros(near.shape, bool)))
            best = np.argsort(-wide_c, axis=1, kind="stable")[:, :beam]
            close[active] = np.take_along_axis(wide_c, best, 1)
            found[active] = np.where(close[active] > -2, np.take_along_axis(wide_f, best, 1), -1)
            opened[active] = np.take_along_axis(wide_o, best, 1)
        order = np.argsort(-close, axis=1, kind="stable")
        return np.take_along_axis(found, order, 1), np.take_along_axis(close, order, 1)

    def within(self, queries: np.ndarray, threshold: float, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, vector) pairs whose cosine is about the threshold or more."""
        low = threshold - 1e-4
        out_q, out_v = [], []
        for at in range(0, len(queries), LOCKSTEP):
            some = queries[at : at + LOCKSTEP].astype(np.float32)
            found, close = self._beam(0, some, self._descend(some, 1, self.members[0]), beam)
            hit = np.zeros((len(some), len(self.v)), bool)
            q, c = np.nonzero(close >= low)
            q, v = q, found[q, c]
            hit[q, v] = True
            while len(q):
                near = self.neighbours[0][v]
                nq, nv = np.repeat(q, near.shape[1]), near.ravel()
                nq, nv = nq[nv >= 0], nv[nv >= 0]
                key = np.unique(nq * len(self.v) + nv)
                nq, nv = key // len(self.v), key % len(self.v)
                new = ~hit[nq, nv]
                nq, nv = nq[new], nv[new]
                near_enough = np.einsum("nd,nd->n", some[nq], self.v[nv]) >= low
                q, v = nq[near_enough], nv[near_enough]
                hit[q, v] = True
            q, v = np.nonzero(hit)
            out_q.append(q + at)
            out_v.append(v)
        return np.concatenate(out_q) if out_q else np.zeros(0, int), np.concatenate(out_v) if out_v else np.zeros(0, int)


def verified(queries: np.ndarray, vectors: np.ndarray, q: np.ndarray, v: np.ndarray, threshold: float) -> np.ndarray:
    """Which pairs have a cosine of the threshold or more in double precision."""
    out = np.zeros(len(q), bool)
    for at in range(0, len(q), 1 << 16):
        s = slice(at, at + (1 << 16))
        out[s] = np.einsum("nd,nd->n", queries[q[s]], vectors[v[s]]) >= threshold
    return out


def exact(queries: np.ndarray, vectors: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(query, vector) pairs by all products: single precision finds them, double precision decides."""
    near, far = queries.astype(np.float32), vectors.astype(np.float32).T
    rows = max(1, COSINES // len(vectors))
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    for at in range(0, len(queries), rows):
        q, v = np.nonzero(near[at : at + rows] @ far >= threshold - 1e-4)
        good = verified(queries, vectors, q + at, v, threshold)
        found.append((q[good] + at, v[good]))
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def probes(own: np.ndarray, threshold: float, random: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """(queries, vectors): vectors of the shard turned at random until their cosine to the vector is just the threshold."""
    place = random.permutation(len(own))[:AUDIT]
    aside = random.normal(size=(len(place), own.shape[1]))
    aside -= np.einsum("nd,nd->n", aside, own[place])[:, None] * own[place]
    size = np.linalg.norm(aside, axis=1)
    some = size > 1e-6
    place, aside = place[some], aside[some] / size[some, None]
    near = min(1.0, threshold + 1e-6)
    return near * own[place] + math.sqrt(1 - near * near) * aside, place


def search(
    graph: Graph, vectors: np.ndarray, queries: np.ndarray, threshold: float, reps: np.ndarray, q_reps: np.ndarray
) -> tuple[np.ndarray, np.ndarray, int]:
    """(query, vector, beam): links between different ids, with the beam that passed the audit (all vectors: brute force)."""
    wide, own = unit(queries), unit(vectors)
    random = np.random.default_rng(11)

    def links(some: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        if beam:
            q, v = graph.within(wide[some], threshold, min(beam, len(own)))
            good = verified(wide[some], own, q, v, threshold)
            q, v = q[good], v[good]
        else:
            q, v = exact(wide[some], own, threshold)
        other = q_reps[some[q]] != reps[v]
        return some[q[other]], v[other]

    turned, origin = probes(own, threshold, random)
    audit = random.permutation(len(wide))[:AUDIT]
    true = np.bincount(links(audit, 0)[0], minlength=len(wide))
    linked = np.flatnonzero(true)
    beam = BEAM
    while beam <= WIDEST:
        q, v = graph.within(turned, threshold, min(beam, len(own)))
        recall = len(np.unique(q[v == origin[q]])) / max(1, len(turned))
        good = recall >= PROBE_RECALL
        if good and len(linked):
            found = np.bincount(links(audit, beam)[0], minlength=len(wide))[linked]
            good = min(found.sum() / true[linked].sum(), (found / true[linked]).mean()) >= RECALL
        if good:
            break
        beam *= 2
    q, v = links(np.arange(len(wide)), beam if beam <= WIDEST else 0)
    return q, v, beam if beam <= WIDEST else len(own)


@dataclass
class Shard:
    """The file of a shard: ids, copies and vectors by place, and the graph."""

    reps: np.ndarray
    copies: np.ndarray
    vectors: np.ndarray

    def dump(self) -> bytes:
        graph, out = Graph(unit(self.vectors)), io.BytesIO()
        np.savez(
            out,
            reps=self.reps,
            copies=self.copies,
            vectors=self.vectors,
            sizes=np.array([len(m) for m in graph.members], np.int64),
            members=np.concatenate(graph.members),
            neighbours=np.concatenate(graph.neighbours),
        )
        return out.getvalue()

    @classmethod
    def load_rows(cls, path: str) -> Shard:
        fs, inner = filesystem(path)
        with fs.open_input_file(inner) as source:
            saved = np.load(io.BytesIO(source.read()))
        return cls(saved["reps"], saved["copies"], saved["vectors"])

    @classmethod
    def load(cls, data: bytes) -> tuple[Shard, Graph]:
        saved = np.load(io.BytesIO(data))
        shard = cls(saved["reps"], saved["copies"], saved["vectors"])
        graph = Graph.__new__(Graph)
        graph.v = unit(shard.vectors).astype(np.float32)
        ends = np.cumsum(saved["sizes"])[:-1]
        graph.members, graph.neighbours = np.split(saved["members"], ends), np.split(saved["neighbours"], ends)
        graph.place = []
        for m in graph.members:
            place = np.zeros(len(graph.v), np.int32)
            place[m] = np.arange(len(m))
            graph.place.append(place)
        return shard, graph


def _build_shard(folder: str):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("rep").reset_index(drop=True)
        width, shard = int(pdf["width"].iloc[0]), int(pdf["shard"].iloc[0])
        vectors = np.frombuffer(b"".join(pdf["vector"]), np.float64).reshape(-1, width)
        name = f"{width}-{shard}-{uuid.uuid4().hex}"
        write_file(f"{folder}/{name}", [Shard(pdf["rep"].to_numpy(np.int64), pdf["copies"].to_numpy(np.int64), vectors).dump()])
        return pd.DataFrame({"width": [width], "shard": [shard], "file": [name], "n": [len(pdf)]})

    return run


@lru_cache(maxsize=1)
def _load(path: str) -> tuple[Shard, Graph]:
    fs, inner = filesystem(path)
    with fs.open_input_file(inner) as source:
        return Shard.load(source.read())


def _search_block(folder: str, threshold: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for task in pdf.to_dict("records"):
                shard, graph = _load(f"{folder}/{task['file']}")
                asked = shard if task["queries"] == task["file"] else Shard.load_rows(f"{folder}/{task['queries']}")
                rows = slice(task["at"], task["at"] + BLOCK_ROWS)
                q_reps = asked.reps[rows]
                q, v, beam = search(graph, shard.vectors, asked.vectors[rows], threshold, shard.reps, q_reps)
                links = np.bincount(q, shard.copies[v], len(q_reps)).astype(np.int64)
                tree = forest(q_reps[q], shard.reps[v])
                some = np.flatnonzero(links)
                yield pd.DataFrame(
                    {
                        "a": np.concatenate((q_reps[some], q_reps[q[tree]])),
                        "b": np.concatenate((q_reps[some], shard.reps[v[tree]])),
                        "links": np.concatenate((links[some], np.zeros(len(tree), np.int64))),
                        "beam": beam,
                    }
                )

    return run


def near_duplicates(rows: DataFrame, threshold: float = THRESHOLD, shards: int = 1, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row of (vec_id, embedding); `shards`: at least so many for a width."""
    spark = rows.sparkSession
    ship(spark)
    folder = new_folder(spark, "hnsw")
    vector = F.col("embedding").cast("array<double>")
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    usable = F.col("embedding").isNotNull() & F.forall("embedding", lambda x: number(x)) & F.exists("embedding", lambda x: x != 0)
    every = rows.select(F.col("vec_id").cast("long"), vector.alias("embedding")).select(
        "vec_id", F.when(F.coalesce(usable, F.lit(False)), F.col("embedding")).alias("embedding")
    )
    # a class of copies is known by two hashes of its components
    key = [F.xxhash64("embedding").alias("k1"), F.xxhash64(F.lit(7), F.reverse("embedding")).alias("k2")]
    named = cut(every.withColumns({"k1": F.when(F.col("embedding").isNotNull(), key[0]), "k2": F.when(F.col("embedding").isNotNull(), key[1])}))
    reps = cut(
        named.where("embedding is not null")
        .groupBy("k1", "k2")
        .agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"), F.first("embedding").alias("embedding"))
    )
    known = reps.where("rep is not null").withColumn("width", F.size("embedding"))
    parts = F.ceil(F.count("*") * F.col("width") * 8 / F.lit(shard_bytes)).cast("int")
    sizes = known.groupBy("width").agg(F.greatest(F.lit(shards), parts).alias("shards"))
    dealt = known.join(sizes, "width").select(
        "rep", "copies", "width", _bytes("embedding").alias("vector"), F.pmod(F.xxhash64("rep"), F.col("shards")).cast("int").alias("shard")
    )
    index = cut(dealt.groupBy("width", "shard").applyInPandas(_build_shard(folder), "width int, shard int, file string, n long"))
    # names of files only: every block of queries meets every shard of its width
    blocks = index.select("width", F.col("file").alias("queries"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(BLOCK_ROWS).cast("long"))).alias("at"))
    met = index.select("width", "file").join(blocks, "width")
    n_tasks = index.groupBy("width").agg((F.count("*") * F.sum(F.ceil(F.col("n") / BLOCK_ROWS))).alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    met = met.repartition(max(1, min(int(n_tasks), MOST_TASKS)), "file", "queries", "at")
    found = cut(met.mapInPandas(_search_block(folder, threshold), "a long, b long, links long, beam long"))
    counts = found.where("a = b").groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
    group = components(found.where("a <> b").select("a", "b")).withColumnRenamed("node", "rep")
    classes = reps.select("k1", "k2", "rep", "copies").join(counts, "rep", "left").join(group, "rep", "left")
    return (
        named.select("vec_id", "k1", "k2")
        .join(classes, ["k1", "k2"], "left")
        .select(
            "vec_id",
            F.coalesce(F.col("copies") - 1 + F.coalesce("links", F.lit(0)), F.lit(0)).cast("long").alias("n_links"),
            F.when(F.col("k1").isNull(), F.col("vec_id")).otherwise(F.coalesce("component", "rep")).alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
    )


def _bytes(column: str):
    @F.pandas_udf("binary")
    def packed(batch: pd.Series) -> pd.Series:
        return pd.Series([np.asarray(x, np.float64).tobytes() for x in batch])

    return packed(F.col(column))
