"""Quality by nearest-neighbour voting in a latent semantic space.

The model is fitted on a bounded sample of labelled documents (`per_class` of each label, chosen by a
hash of the id): counts of hashed features (words, word shapes, character trigrams and line marks) are
damped and weighted by rarity in the sample, and a truncated singular value decomposition gives the
latent space. The sample's latent vectors and labels are broadcast; their number is bounded by the
parameters, so the broadcast is as well. Every document is brought into the space, its cosine with
all sample vectors is computed exactly in blocks, and its `neighbours` nearest vote with weights that
grow with similarity. Votes of each label are divided by the label's share of the sample, so that the
score is the chance of label 1 at even odds.

A text is cut into stretches of `STRETCH` bytes at word ends and is scored as the weakest stretch, so
that junk after a clean beginning counts; the whole text is read.

Defined cases: null, empty and blank texts score 0; without labelled documents of one label the score is
the share of label 1 (0.5 with no labels). Equal texts get equal scores; ties among neighbours are
decided by sample order. Null labels and labels without a document are not used. Other columns pass
through unread.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopwise.llm import textarrays as ta
from stopwise.llm.shared import made_in_task, ship

PER_CLASS = 1500
FEATURES = 2048
DIMENSIONS = 48
NEIGHBOURS = 15
STRETCH = 4096
#: Bytes of text whose features are counted at once when fitting.
FIT_BYTES = 1 << 19
SHARPNESS = 12.0
#: A stretch of fewer words counts as one of so many, so that a single odd word does not decide.
SHORTEST = 30
#: Weight of the feature that counts words equal to the one before.
REPEAT_WEIGHT = 3.0
ACCEPT = 0.3

_KIND = np.zeros(256, np.uint8)
for _low, _high, _k in ((0x30, 0x39, 1), (0x41, 0x5A, 2), (0x61, 0x7A, 3), (0x80, 0xFF, 4), (0x09, 0x0D, 5), (0x20, 0x20, 6)):
    _KIND[_low : _high + 1] = _k
_INK = (_KIND != 5) & (_KIND != 6)
_INK[:0x20] = False


def stretches(texts: ta.Texts, most: int = STRETCH) -> tuple[ta.Texts, np.ndarray]:
    """Texts cut at word ends into stretches of about `most` bytes, and the text of each stretch."""
    found = ta.words(texts, _INK)
    cuts, owner = [], []
    for k in range(len(texts)):
        start, end = int(texts.offsets[k]), int(texts.offsets[k + 1])
        pieces = max(1, round((end - start) / most))
        wanted = start + (np.arange(1, pieces) * (end - start)) // pieces
        ends = found.ends[found.first[k] : found.first[k + 1]]
        at = ends[np.minimum(np.searchsorted(ends, wanted), len(ends) - 1)] if len(ends) else wanted[:0]
        inner = np.unique(at[(at > start) & (at < end)])
        cuts.append(np.concatenate(([start], inner)))
        owner.append(np.full(len(inner) + 1, k))
    offsets = np.append(np.concatenate(cuts), texts.offsets[-1]) if cuts else texts.offsets
    return ta.Texts(texts.data, offsets), np.concatenate(owner) if owner else np.zeros(0, np.int64)


def features(texts: ta.Texts, size: int = FEATURES) -> np.ndarray:
    """Damped counts of hashed features as a (texts, size) array."""
    n, data = len(texts), texts.data
    found = ta.words(texts, _INK)
    text_of = found.text_of()
    lower = ta.LOWER[data]
    sums = ta.running_hash(lower)
    word = ta.run_hash(sums, found.starts, found.ends)
    kinds = _KIND[data]
    # the shape of a word: which kinds of characters it has, and the kind of its first and last ones
    present = np.zeros(len(found.starts), np.int64)
    if len(found.starts):
        present = np.bitwise_or.reduceat(1 << kinds.astype(np.int64), np.ravel(np.column_stack((found.starts, np.minimum(found.ends, len(data) - 1)))))[::2]
        present |= 1 << kinds[found.ends - 1].astype(np.int64)
    shape = (present * 8 + kinds[found.starts]) * 8 + kinds[found.ends - 1]
    repeated = np.zeros(len(word), bool)
    repeated[1:] = (word[1:] == word[:-1]) & (text_of[1:] == text_of[:-1])
    half = size // 2
    out = np.zeros((n, size), np.float32)
    flat = lambda text, value, low, room: text * size + low + (value % np.uint64(room)).astype(np.int64)
    counts = np.bincount(flat(text_of, ta.mix(word), 0, half), minlength=n * size)
    counts += np.bincount(flat(text_of, ta.mix(shape.astype(np.uint64) + np.uint64(77)), half, half // 4), minlength=n * size)
    counts += np.bincount(flat(text_of[repeated], np.zeros(int(repeated.sum()), np.uint64), half + half // 4, 1), minlength=n * size)
    if len(data) >= 3:
        text_at = np.repeat(np.arange(n), np.diff(texts.offsets))
        inside = text_at[2:] == text_at[:-2]
        gram = (kinds[:-2].astype(np.uint64) * np.uint64(64) + kinds[1:-1].astype(np.uint64) * np.uint64(8) + kinds[2:]) * np.uint64(7)
        mark = np.where(_INK[data] & (kinds == 0), data, 0).astype(np.uint64)
        gram += (mark[:-2] * np.uint64(256) + mark[1:-1]) * np.uint64(256) + mark[2:]
        counts += np.bincount(flat(text_at[2:][inside], ta.mix(gram[inside]), half + half // 2, half // 2), minlength=n * size)
    length = np.maximum(np.diff(found.first), SHORTEST)[:, None]
    # counts per hundred words, so that long and short stretches compare
    out[:] = np.log1p(counts.reshape(n, size) * (100.0 / length))
    out[:, half + half // 4] *= REPEAT_WEIGHT
    return out


class Model:
    def __init__(self, weight: np.ndarray, axes: np.ndarray, vectors: np.ndarray, labels: np.ndarray, prior: float):
        self.weight, self.axes, self.vectors, self.labels, self.prior = weight, axes, vectors, labels, prior

    def latent(self, counted: np.ndarray) -> np.ndarray:
        vectors = (counted * self.weight) @ self.axes
        return vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)

    def score(self, counted: np.ndarray, neighbours: int, block: int = 512) -> np.ndarray:
        if not len(self.labels) or self.labels.min() == self.labels.max():
            return np.full(len(counted), self.prior)
        share = self.labels.mean()
        worth = np.where(self.labels == 1, 1 / share, 1 / (1 - share))
        out = np.zeros(len(counted))
        k = min(neighbours, len(self.labels))
        for at in range(0, len(counted), block):
            cosine = self.latent(counted[at : at + block]) @ self.vectors.T
            near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
            close = np.take_along_axis(cosine, near, 1)
            vote = np.exp(SHARPNESS * (close - close.max(1, keepdims=True))) * worth[near]
            out[at : at + block] = (vote * self.labels[near]).sum(1) / vote.sum(1)
        return out


def fit_arrays(texts: ta.Texts, labels: np.ndarray, dimensions: int = DIMENSIONS, size: int = FEATURES) -> Model:
    prior = float(labels.mean()) if len(labels) else 0.5
    if not len(labels):
        return Model(np.ones(size, np.float32), np.zeros((size, 1), np.float32), np.zeros((0, 1), np.float32), labels, prior)
    cutup, owner = stretches(texts)
    # features are counted anew for each use, since all of them at once are the largest thing in the task
    counted = lambda: (features(part, size) for _, _, part in ta.passes(cutup, FIT_BYTES))
    seen = sum((p > 0).sum(0) for p in counted())
    weight = (np.log((1 + len(cutup)) / (1 + seen)) + 0.1).astype(np.float32)
    products = np.zeros((size, size))
    for p in counted():
        scaled = (p * weight).astype(np.float64)
        products += scaled.T @ scaled
    _, axes = np.linalg.eigh(products)
    del products
    axes = axes[:, ::-1][:, :dimensions].astype(np.float32)
    model = Model(weight, axes, np.zeros((0, dimensions), np.float32), labels[owner].astype(np.float64), prior)
    model.vectors = np.concatenate([model.latent(p) for p in counted()]).astype(np.float32)
    return model


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model:
    """docs: doc_id, text. labels: doc_id, quality. At most `per_class` documents of each label are used."""
    marked = labels.select("doc_id", F.col("quality").cast("int")).where("doc_id is not null and quality in (0, 1)")
    marked = marked.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    picks = None
    for label in (0, 1):
        own = marked.where(F.col("quality") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        picks = own if picks is None else picks.union(own)
    sample = docs.select("doc_id", F.col("text").cast("string")).where("text is not null").join(F.broadcast(picks), "doc_id")
    return made_in_task(sample.dropDuplicates(["doc_id"]).select("doc_id", "text", "quality"), ["doc_id"], _fit_rows)


def _fit_rows(rows: pa.Table) -> Model:
    texts = ta.from_arrow(rows["text"].combine_chunks())
    return fit_arrays(texts, rows["quality"].to_numpy().astype(np.int64))


def _score(shared, neighbours: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            scores = []
            for _, _, texts in ta.passes(ta.from_arrow(batch.column("text"))):
                cutup, owner = stretches(texts)
                votes = np.concatenate([model.score(features(part), neighbours) for _, _, part in ta.passes(cutup, 1 << 19)])
                worst = np.ones(len(texts))
                np.minimum.at(worst, owner, votes)
                empty = np.diff(ta.words(texts, _INK).first) == 0
                scores.append(np.where(empty, 0.0, worst))
            score = np.concatenate(scores) if scores else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score)], names=["row", "score"])

    return run


def score(docs: DataFrame, model: Model, neighbours: int = NEIGHBOURS) -> DataFrame:
    """docs with a last column `score`; a column of that name is replaced."""
    spark = docs.sparkSession
    ship(spark)
    names = [n for n in docs.columns if n != "score"]
    packed = docs.select(F.struct(*[F.col(f"`{n}`") for n in names]).alias("row"), F.col("text").cast("string").alias("text"))
    kind = packed.schema["row"].dataType.simpleString()
    out = packed.mapInArrow(_score(spark.sparkContext.broadcast(model), neighbours), f"row {kind}, score double")
    return out.select(*[F.col("row")[n].alias(n) for n in names], "score")
