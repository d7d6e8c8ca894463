"""MinHash near-duplicates of multisets of word shingles by BagMinHash.

A document is the multiset of its runs of five words (ASCII lower case; a shorter text that has words
is one run). Its signature holds, for each of `components` positions, the earliest point of the Poisson
processes of its shingles. The weight axis of a shingle is split into dyadic intervals [0,1), [1,2),
[2,4), [4,8), ...; each interval has one process seeded by shingle and interval, of a rate equal to its
length, whose points get a random position and a level in the interval. A point counts when its level,
rounded down to a whole weight, lies below the count of the shingle. Two documents agree in a position
with the probability of their weighted Jaccard similarity. Points are drawn in order of time, and a
process ends once its time exceeds the largest entry of the signature.

`near_duplicates` collapses equal multisets, bands the signatures, and finds the connected components
of the verified links. Within a bucket no pairs are listed: every member is compared with one pivot
(the member that shares most buckets). Where the members of a pivot do not all come out in one component,
they are compared with each other exactly, in pairs of blocks of about `BLOCK` members; a pair of blocks
returns a spanning forest of its links. So no link is lost, and rows stay in proportion to the members.

Defined cases: null texts and texts without words are a class of their own each; rows of equal text
are one class; a class of rows that all have a null id has a null class; `doc_id` names a document, and
where rows with one id have several texts, their links count for the id. Other columns are not read.
An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopwise.llm import textarrays as ta
from stopwise.llm.shared import components, cut, forest, ship

COMPONENTS = 128
ROWS = 4
SHINGLE = 5
THRESHOLD = 0.8
#: Members of a pivot that are compared as one block.
BLOCK = 1024
#: Columns of the incidence matrix that are multiplied at a time.
COLUMNS = 4096
#: A pair of true similarity s is estimated with a deviation of at most sqrt(s(1-s)/128) = 0.044; estimates
#: this far below a bound rule the pair out (six deviations).
MARGIN = 0.26

_U = np.uint64


def bag(texts: ta.Texts, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, shingle, count) of every distinct shingle of every text, ordered by text and shingle."""
    data = ta.LOWER[texts.data]
    found = ta.words(ta.Texts(data, texts.offsets))
    hashes = ta.run_hash(ta.running_hash(data), found.starts, found.ends)
    text, key = ta.shingles(hashes, found.first, size)
    order = np.lexsort((key, text))
    text, key = text[order], key[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(new)
    return text[at], key[at], np.diff(np.append(at, len(key)))


def signatures(text: np.ndarray, key: np.ndarray, count: np.ndarray, n: int, m: int = COMPONENTS) -> np.ndarray:
    """BagMinHash signatures of n multisets as an (n, m) array; those of empty multisets are zero."""
    best = np.full(n * m, np.inf)
    levels = np.ceil(np.log2(count)).astype(np.int64) + 1
    process = np.repeat(np.arange(len(key)), levels)
    level = np.arange(len(process)) - np.repeat(np.cumsum(levels) - levels, levels)
    low = np.where(level == 0, 0, 1 << np.maximum(level - 1, 0))
    length = np.maximum(low, 1).astype(np.float64)
    seed = ta.mix(key[process] ^ ta.mix(level.astype(_U)))
    of, weight = text[process], count[process]
    time = np.zeros(len(process))
    step = 0
    while len(seed):
        step += 1
        draw = ta.mix(seed + _U((step * 0xD1342543DE82EF95) % (1 << 64)))
        unit = ((draw >> _U(11)).astype(np.float64) + 0.5) * 2.0**-53
        time = time - np.log(unit) / length
        other = ta.mix(draw)
        place = (other % _U(m)).astype(np.int64)
        inside = low + ((other >> _U(32)).astype(np.float64) * 2.0**-32 * length).astype(np.int64) < weight
        np.minimum.at(best, of[inside] * m + place[inside], time[inside])
        if step < 3 or step % 4 == 0:
            latest = best.reshape(n, m).max(1)
            alive = time < latest[of]
            seed, time, of, weight, low, length = (x[alive] for x in (seed, time, of, weight, low, length))
    out = best.reshape(n, m)
    return np.where(np.isinf(out), 0.0, out)


def _compact(sig: np.ndarray) -> np.ndarray:
    """32 bits of each signature entry, enough to tell points apart."""
    return (ta.mix(np.ascontiguousarray(sig).view(_U) >> _U(12)) >> _U(32)).astype(np.uint32)


def _bands(sig: np.ndarray, rows: int) -> np.ndarray:
    n, m = sig.shape
    parts = sig.astype(_U).reshape(n, m // rows, rows)
    out = np.broadcast_to(ta.mix(np.arange(m // rows, dtype=_U) + _U(1)), (n, m // rows)).copy()
    for k in range(rows):
        out = ta.mix(out ^ (parts[:, :, k] + _U(k + 1)))
    return out


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0)
        for first, last, texts in ta.passes(ta.from_arrow(batch.column(1))):
            n = last - first
            text, key, count = bag(texts)
            totals = np.bincount(text, count, n).astype(np.int64)
            pair = ta.mix(key ^ ta.mix(count.astype(_U)))
            digest = []
            for salt in (1, 2):
                sums = np.zeros(n, _U)
                np.add.at(sums, text, ta.mix(pair + _U(salt)))
                digest.append(sums.view(np.int64))
            sig = _compact(signatures(text, key, count, n))
            bands = _bands(sig, ROWS).view(np.int64)
            some = totals > 0
            offsets = np.concatenate(([0], np.cumsum(np.where(some, bands.shape[1], 0)))).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    ids.slice(first, n),
                    pa.array(totals),
                    pa.array(digest[0]),
                    pa.array(digest[1]),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(bands[some].ravel())),
                    pa.array([x.tobytes() for x in sig], pa.binary()),
                ],
                names=["doc_id", "n_shingles", "d1", "d2", "bands", "sig"],
            )


def sketch(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, number of shingles, digest of the multiset, band keys and signature."""
    ship(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        _sketch, "doc_id long, n_shingles long, d1 long, d2 long, bands array<long>, sig binary"
    )


def _agreement(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n = batch.num_rows
        left, right = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint32).reshape(n, -1) for k in (2, 3))
        share = (left == right).mean(1) if n else np.zeros(0)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(share)], names=["a", "b", "share"])


def _overlap(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Exact weighted Jaccard similarity of the texts in columns 2 and 3."""
    for batch in batches:
        left, right = ta.from_arrow(batch.column(2)), ta.from_arrow(batch.column(3))
        out = np.zeros(batch.num_rows)
        at = 0
        both = np.diff(left.offsets) + np.diff(right.offsets)
        edges = np.concatenate(([0], np.cumsum(both)))
        while at < batch.num_rows:
            upto = max(at + 1, int(np.searchsorted(edges, edges[at] + ta.PASS_BYTES, side="right")) - 1)
            parts = []
            for side in (left, right):
                offsets = side.offsets[at : upto + 1]
                parts.append(bag(ta.Texts(side.data[offsets[0] : offsets[-1]], offsets - offsets[0])))
            text = np.concatenate([p[0] for p in parts])
            key = np.concatenate([p[1] for p in parts])
            count = np.concatenate([p[2] for p in parts])
            order = np.lexsort((key, text))
            text, key, count = text[order], key[order], count[order]
            same = (text[1:] == text[:-1]) & (key[1:] == key[:-1])
            shared = np.bincount(text[1:][same], np.minimum(count[1:], count[:-1])[same], upto - at)
            total = np.bincount(text, count, upto - at)
            out[at:upto] = shared / np.maximum(total - shared, 1)
            at = upto
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out)], names=["a", "b", "similarity"])


def _estimate(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    sigs = reps.select("rep", "sig")
    return (
        pairs.join(sigs.withColumnsRenamed({"rep": "a", "sig": "sig_a"}), "a")
        .join(sigs.withColumnsRenamed({"rep": "b", "sig": "sig_b"}), "b")
        .select("a", "b", "sig_a", "sig_b")
        .mapInArrow(_agreement, "a long, b long, share double")
    )


def _verify(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """(a, b, similarity) of pairs of ids, from their texts."""
    needed = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    own = cut(texts.join(needed, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"]))
    return (
        pairs.join(own.withColumnsRenamed({"doc_id": "a", "text": "text_a"}), "a")
        .join(own.withColumnsRenamed({"doc_id": "b", "text": "text_b"}), "b")
        .select("a", "b", "text_a", "text_b")
        .mapInArrow(_overlap, "a long, b long, similarity double")
        .groupBy("a", "b")
        .agg(F.max("similarity").alias("similarity"))
    )


def linked_groups(reps: DataFrame, texts: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(node, component) of the representatives that have a link at the threshold or above.

    reps: rep, bands, sig. texts: doc_id, text.
    """
    every = reps.select("rep", F.explode("bands").alias("band"))
    crowded = every.groupBy("band").agg(F.count("*").alias("n")).where("n > 1")
    members = cut(every.join(crowded, "band"))
    score = members.groupBy("rep").agg(F.sum("n").alias("score"))
    pivots = (
        members.join(score, "rep")
        .groupBy("band")
        .agg(F.max(F.struct("score", (-F.col("rep")).alias("m"))).alias("p"))
        .select("band", (-F.col("p.m")).alias("pivot"))
    )
    seats = cut(members.select("rep", "band").join(pivots, "band").where("rep <> pivot"))
    first = _estimate(seats.select(F.col("rep").alias("a"), F.col("pivot").alias("b")).distinct(), reps)
    near = _verify(cut(first.where(F.col("share") >= threshold - MARGIN)), texts)
    linked = cut(near.where(F.col("similarity") >= threshold).select("a", "b"))
    group = components(linked)

    placed = cut(
        seats.select("pivot", "rep")
        .distinct()
        .join(group.withColumnRenamed("node", "rep"), "rep", "left")
        .select("pivot", "rep", F.coalesce("component", "rep").alias("component"))
    )
    apart = (
        placed.groupBy("pivot")
        .agg(F.count("*").alias("n"), F.min("component").alias("low"), F.max("component").alias("high"))
        .where("low <> high")
        .select("pivot", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    )
    own = placed.join(apart, "pivot").withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    own = own.join(texts.withColumnRenamed("doc_id", "rep"), "rep")
    rows = own.select("pivot", "rep", "component", "text", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    met = rows.select(
        "pivot",
        F.least("block", "other").alias("i"),
        F.greatest("block", "other").alias("j"),
        (F.col("block") <= F.col("other")).alias("first"),
        "rep",
        "component",
        "text",
    )
    more = cut(met.groupBy("pivot", "i", "j").applyInArrow(_compare(threshold), "a long, b long"))
    if more.isEmpty():
        return group
    # the groups found so far enter as stars, so only what joins them is left to do
    return components(group.select(F.col("node").alias("a"), F.col("component").alias("b")).union(more))


def _compare(threshold: float):
    def run(rows: pa.Table) -> pa.Table:
        """Links between two blocks (or within one) of members of different components, as a forest."""
        i, j = rows["i"][0].as_py(), rows["j"][0].as_py()
        rep, component = rows["rep"].to_numpy(), rows["component"].to_numpy()
        text, key, count = bag(ta.from_arrow(rows["text"].combine_chunks()))
        # the k-th copy of a shingle is an element of its own, so that sets have the overlap of the multisets
        again = np.repeat(np.arange(len(key)), count)
        nth = np.arange(len(again)) - np.repeat(np.cumsum(count) - count, count)
        text, key = text[again], ta.mix(key[again] + nth.astype(_U) * _U(0x9E3779B97F4A7C15))
        size = np.bincount(text, minlength=len(rep))
        _, column, often = np.unique(key, return_inverse=True, return_counts=True)
        shared = often[column] > 1
        text, column = text[shared], np.unique(column[shared], return_inverse=True)[1]
        left = np.flatnonzero(rows["first"].to_numpy(zero_copy_only=False))
        right = left if i == j else np.setdiff1d(np.arange(len(rep)), left)
        place = np.zeros(len(rep), np.int64)
        place[left] = np.arange(len(left))
        place[right] = np.arange(len(right))
        common = np.zeros((len(left), len(right)), np.float32)
        is_left, is_right = np.zeros(len(rep), bool), np.zeros(len(rep), bool)
        is_left[left], is_right[right] = True, True
        order = np.argsort(column, kind="stable")
        text, column = text[order], column[order]
        for at in range(0, int(column.max(initial=-1)) + 1, COLUMNS):
            part = slice(*np.searchsorted(column, (at, at + COLUMNS)))
            t, c = text[part], column[part] - at
            matrix = []
            for side, n in ((is_left, len(left)), (is_right, len(right))):
                m = np.zeros((n, COLUMNS), np.float32)
                m[place[t[side[t]]], c[side[t]]] = 1
                matrix.append(m)
            common += matrix[0] @ matrix[1].T
        union = size[left][:, None] + size[right][None, :] - common.astype(np.float64)
        x, y = np.nonzero((common >= threshold * union - 1e-6 * union) & (component[left][:, None] != component[right][None, :]))
        exact = common[x, y].astype(np.float64) / union[x, y] >= threshold
        a, b = rep[left[x[exact]]], rep[right[y[exact]]]
        tree = forest(a, b)
        return pa.table({"a": a[tree], "b": b[tree]})

    return run


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per row of docs: doc_id, n_shingles, rep (smallest id of the equal multisets), class_id (smallest id
    of the component), kept (doc_id = class_id)."""
    rows = cut(sketch(docs))
    full = rows.where("n_shingles > 0")
    same = ["d1", "d2", "n_shingles"]
    reps = cut(full.groupBy(*same).agg(F.min("doc_id").alias("rep"), F.first("bands").alias("bands"), F.first("sig").alias("sig")))
    named = reps.where("rep is not null").select("rep", "bands", "sig")
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    group = linked_groups(named, texts, threshold)
    classes = reps.select(*same, "rep").join(group.withColumnRenamed("node", "rep"), "rep", "left").select(
        *same, "rep", F.coalesce("component", "rep").alias("class_id")
    )
    return (
        rows.select("doc_id", *same)
        .join(classes, same, "left")
        .select(
            "doc_id",
            "n_shingles",
            F.when(F.col("n_shingles") > 0, F.col("rep")).otherwise(F.col("doc_id")).alias("rep"),
            F.when(F.col("n_shingles") > 0, F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"),
        )
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(False)))
    )
