"""Language of words and documents by a linear-chain conditional random field.

Words are runs of letters of the lower-case text. A word's features are its prefixes (1-3 bytes),
suffixes (1-4), its n-grams (3 and 4) and, where the learned lexicon has it, the word itself; all are
hashed into one weight table per language. Transitions between the languages of neighbouring words and
the start are learned with them. Training maximises the conditional likelihood (AdaGrad) on sequences
that switch between languages, spliced from stretches of documents of a known language, so that
the field labels words in code-switched text. Labels of words come from forward-backward: a text is cut
into blocks, the blocks' transfer matrices are multiplied in parallel, and the messages at block
borders give every word's exact posterior, however long the text.

A document's language is the one with the largest sum of posteriors; its score is that sum's share.

The model is fitted on a bounded sample: at most `per_language` documents per language, chosen by a
hash of the id, of every language that a row names. The weights grow with the number of languages; training goes
through the sequences in passes, so that its other tables do not grow with its square.

Defined cases: null texts and texts without a letter are `und` with score 0; without a labelled document
every text with letters is `und`, too. Equal texts get equal results; equal sums go to the first language in
alphabetical order. Rows with null language or text are not learned from. Other columns pass through unread.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stopwise.llm import textarrays as ta
from stopwise.llm.shared import made_in_task, ship

PER_LANGUAGE = 150
TABLE = 1 << 17
LEXICON_COUNT = 3
EPOCHS = 25
BLOCK = 32
SPLICE = 64
#: Posteriors (words times languages) that a pass of the training holds.
PASS_CELLS = 1 << 23
UNKNOWN = "und"

_U = np.uint64


def letters(texts: ta.Texts) -> ta.Words:
    """Words of letters. Texts are lower case already; common signs above ASCII separate words."""
    data = texts.data.copy()
    for lead, second, size in (
        (0xC2, (0x80, 0xBF), 2),
        (0xC3, (0x97, 0x97), 2),
        (0xC3, (0xB7, 0xB7), 2),
        (0xE2, (0x80, 0xAF), 3),
        (0xE3, (0x80, 0x80), 3),
        (0xF0, (0x9F, 0x9F), 4),
    ):
        at = np.flatnonzero(data[: len(data) - size + 1] == lead) if len(data) >= size else np.zeros(0, np.int64)
        at = at[(data[at + 1] >= second[0]) & (data[at + 1] <= second[1])]
        for k in range(size):
            data[at + k] = 0x20
    return ta.words(ta.Texts(data, texts.offsets), ta.LETTER)


def _ragged(starts: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(owner, place) of runs that begin at starts."""
    owner = np.repeat(np.arange(len(starts)), counts)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts) + starts[owner]


@dataclass
class Vocabulary:
    """Distinct words of a pass: hash, and the words' feature numbers as (word, feature) lists."""

    hashes: np.ndarray
    groups: list[tuple[np.ndarray, np.ndarray]]
    inverse: np.ndarray


def vocabulary(texts: ta.Texts, found: ta.Words, lexicon: np.ndarray) -> Vocabulary:
    sums = ta.running_hash(texts.data)
    hashes, at, inverse = np.unique(ta.run_hash(sums, found.starts, found.ends), return_index=True, return_inverse=True)
    starts, ends = found.starts[at], found.ends[at]
    everyone = np.arange(len(at))
    groups = []

    def add(owner: np.ndarray, low: np.ndarray, high: np.ndarray, salt: int) -> None:
        key = ta.mix(ta.run_hash(sums, low, high) + _U(salt))
        groups.append((owner, (key % _U(TABLE)).astype(np.int32)))

    for k in (1, 2, 3):
        add(everyone, starts, np.minimum(starts + k, ends), k)
    for k in (1, 2, 3, 4):
        add(everyone, np.maximum(ends - k, starts), ends, 10 + k)
    for k in (3, 4):
        owner, place = _ragged(starts, np.maximum(ends - starts - k + 1, 0))
        add(owner, place, place + k, 20 + k)
    if len(lexicon):
        known = np.flatnonzero(lexicon[np.minimum(np.searchsorted(lexicon, hashes), len(lexicon) - 1)] == hashes)
        add(known, starts[known], ends[known], 30)
    return Vocabulary(hashes, groups, inverse)


def emissions(words: Vocabulary, weights: np.ndarray) -> np.ndarray:
    """(distinct words, languages) sums of weights."""
    out = np.zeros((len(words.hashes), len(weights)))
    for owner, feature in words.groups:
        for label, table in enumerate(weights):
            out[:, label] += np.bincount(owner, table[feature], len(out))
    return out


def posteriors(scores: np.ndarray, first: np.ndarray, moves: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Forward-backward: (words, languages) posteriors of words in runs that begin at `first`."""
    if len(scores) == 0:
        return scores
    forward, behind, _ = messages(scores, first, moves, start)
    forward *= behind
    return forward / forward.sum(1, keepdims=True)


def expected_moves(forward: np.ndarray, after: np.ndarray, inner: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Sum over the words `inner` of the joint posterior of the languages of a word and the one before it.
    after: messages from behind times the word's own score."""
    step = np.exp(moves - moves.max())
    into, here = forward[inner - 1], after[inner]
    total = ((into @ step) * here).sum(1, keepdims=True)
    return step * ((into / total).T @ here)


def messages(scores: np.ndarray, first: np.ndarray, moves: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, languages) messages from before with the word's own score and from behind without it, each up to a factor
    for the word, and the scores as factors."""
    n, size = scores.shape
    local = np.exp(scores - scores.max(1, keepdims=True))
    step, begin = np.exp(moves - moves.max()), np.exp(start - start.max())
    lengths = np.diff(first)
    blocks_of = -(-lengths // BLOCK)
    owner, order = _ragged(np.zeros(len(lengths), np.int64), blocks_of)
    where = first[:-1][owner] + order * BLOCK
    width = np.minimum(BLOCK, first[1:][owner] - where)
    head = order == 0
    base = np.cumsum(blocks_of) - blocks_of
    count = len(where)

    product = np.broadcast_to(np.eye(size), (count, size, size)).copy()
    for k in range(BLOCK):
        use = np.flatnonzero(width > k)
        if not len(use):
            break
        part = (product[use].reshape(-1, size) @ step).reshape(-1, size, size)
        if k == 0:
            part[head[use]] = begin
        part *= local[where[use] + k][:, None, :]
        product[use] = part / part.sum((1, 2), keepdims=True)

    into, out_of = np.full((count, size), 1.0 / size), np.ones((count, size))
    longest = int(blocks_of.max()) if len(blocks_of) else 0
    by_length = np.argsort(-blocks_of, kind="stable")
    reach = np.searchsorted(-blocks_of[by_length], -np.arange(longest), side="left")
    for j in range(longest - 1):
        docs = by_length[: reach[j + 1]]
        at = base[docs] + j
        message = np.einsum("ni,nij->nj", into[at], product[at])
        into[at + 1] = message / message.sum(1, keepdims=True)
    for j in range(longest - 1, 0, -1):
        docs = by_length[: reach[j]]
        at = base[docs] + j
        message = np.einsum("nij,nj->ni", product[at], out_of[at])
        out_of[at - 1] = message / message.sum(1, keepdims=True)

    forward = np.zeros((n, size))
    state = into
    for k in range(BLOCK):
        use = np.flatnonzero(width > k)
        if not len(use):
            break
        part = state[use] @ step
        if k == 0:
            part[head[use]] = begin
        part *= local[where[use] + k]
        part /= part.sum(1, keepdims=True)
        state[use] = part
        forward[where[use] + k] = part
    behind = np.zeros((n, size))
    back = out_of
    for k in range(BLOCK - 1, -1, -1):
        use = np.flatnonzero(width > k)
        if not len(use):
            continue
        at = where[use] + k
        here = back[use]
        behind[at] = here
        part = (local[at] * here) @ step.T
        back[use] = part / part.sum(1, keepdims=True)
    return forward, behind, local


@dataclass
class Field:
    languages: list[str]
    lexicon: np.ndarray
    weights: np.ndarray
    moves: np.ndarray
    start: np.ndarray

    def label(self, texts: ta.Texts) -> tuple[ta.Words, np.ndarray]:
        """Words of lower-case texts and the posteriors of their languages."""
        found = letters(texts)
        words = vocabulary(texts, found, self.lexicon)
        scores = emissions(words, self.weights)[words.inverse]
        return found, posteriors(scores, found.first, self.moves, self.start)


def fit_arrays(texts: ta.Texts, labels: np.ndarray, languages: list[str], epochs: int = EPOCHS) -> Field:
    """texts: lower case; labels: number of each text's language."""
    size = len(languages)
    found = letters(texts)
    hashes = ta.run_hash(ta.running_hash(texts.data), found.starts, found.ends)
    distinct, counts = np.unique(hashes, return_counts=True)
    lexicon = distinct[counts >= LEXICON_COUNT]
    words = vocabulary(texts, found, lexicon)
    gold = labels[found.text_of()]

    random = np.random.default_rng(7)
    # stretches of 4 to 60 words, in random order, joined to sequences that switch between languages
    pieces = []
    for a, b in zip(found.first[:-1].tolist(), found.first[1:].tolist(), strict=True):
        while a < b:
            upto = min(b, a + int(random.integers(4, 61)))
            pieces.append(np.arange(a, upto))
            a = upto
    random.shuffle(pieces)
    order = np.concatenate(pieces) if pieces else np.zeros(0, np.int64)
    gold, inverse = gold[order], words.inverse[order]
    n = len(order)
    first = np.append(np.arange(0, n, SPLICE), n)
    inner = np.ones(n, bool)
    inner[first[:-1]] = False
    inner = np.flatnonzero(inner)

    weights, moves, start = np.zeros((size, TABLE)), np.zeros((size, size)), np.zeros(size)
    sums = [np.full_like(x, 1e-6) for x in (weights, moves, start)]
    seen_moves = np.zeros((size, size))
    np.add.at(seen_moves, (gold[inner - 1], gold[inner]), 1)
    runs = max(1, PASS_CELLS // (SPLICE * max(size, 1)))
    for _ in range(epochs if n and size > 1 else 0):
        table = emissions(words, weights)
        by_word = np.zeros((size, len(words.hashes)))
        step_m, step_s = seen_moves.copy(), np.zeros(size)
        for run in range(0, len(first) - 1, runs):
            own = first[run : run + runs + 1]
            s, own = slice(own[0], own[-1]), own - own[0]
            forward, behind, local = messages(table[inverse[s]], own, moves, start)
            slope = -forward * behind
            slope /= -slope.sum(1, keepdims=True)
            slope[np.arange(len(slope)), gold[s]] += 1
            for k in range(size):
                by_word[k] += np.bincount(inverse[s], slope[:, k], len(words.hashes))
            within = inner[(inner >= s.start) & (inner < s.stop)] - s.start
            behind *= local
            step_m -= expected_moves(forward, behind, within, moves)
            step_s += slope[own[:-1]].sum(0)
        step_w = np.zeros_like(weights)
        for owner, feature in words.groups:
            for k in range(size):
                step_w[k] += np.bincount(feature, by_word[k][owner], TABLE)
        for value, step, total, penalty in ((weights, step_w, sums[0], 0.05), (moves, step_m, sums[1], 0.5), (start, step_s, sums[2], 0.5)):
            step = step - penalty * value
            total += step * step
            value += 0.3 * step / np.sqrt(total)
    return Field(languages, lexicon, weights.astype(np.float32), moves, start)


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Field:
    """docs: doc_id, text, lang."""
    known = docs.select(
        F.col("lang").cast("string").alias("lang"), F.lower(F.col("text").cast("string")).alias("text"), "doc_id"
    ).where("text is not null and lang is not null and doc_id is not null")
    # a filter on the rank lets each task cut its languages before the shuffle
    place = F.row_number().over(Window.partitionBy("lang").orderBy("h", "text"))
    rows = known.select("lang", "text", F.xxhash64("doc_id").alias("h")).withColumn("place", place).where(F.col("place") <= per_language)
    return made_in_task(rows.select("lang", "h", "text"), ["lang", "h", "text"], _fit_rows)


def _fit_rows(sample: pa.Table) -> Field:
    named = sample["lang"].to_pylist()
    languages = sorted(set(named))
    if not languages:
        return Field([], np.zeros(0, _U), np.zeros((0, TABLE), np.float32), np.zeros((0, 0)), np.zeros(0))
    labels = np.searchsorted(languages, named)
    return fit_arrays(ta.from_arrow(sample["text"].combine_chunks()), labels, languages)


def _predict(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = shared.value
        size = len(field.languages)
        for batch in batches:
            named, scores = [], []
            lettered = batch.column("lettered").to_numpy(zero_copy_only=False)
            for first, last, texts in ta.passes(ta.from_arrow(batch.column("low")), ta.PASS_BYTES // 2):
                n = last - first
                if not size:
                    named += [UNKNOWN] * n
                    scores.append(np.zeros(n))
                    continue
                found, post = field.label(texts)
                text_of = found.text_of()
                total = np.stack([np.bincount(text_of, post[:, k], n) for k in range(size)], 1)
                counts = np.maximum(np.diff(found.first), 1)
                best = total.argmax(1)
                usable = lettered[first:last].astype(bool)
                # letters of scripts that the words' classes miss: the prior of the start decides
                bare = np.diff(found.first) == 0
                share = total[np.arange(n), best] / counts
                share = np.where(bare, 1 / size, share)
                named += [field.languages[b] if u else UNKNOWN for b, u in zip(best, usable, strict=True)]
                scores.append(np.where(usable, np.clip(share, 0, 1), 0.0))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(named, pa.string()), pa.array(np.concatenate(scores) if scores else np.zeros(0))],
                names=["row", "lang_pred", "score"],
            )

    return run


def predict(docs: DataFrame, field: Field) -> DataFrame:
    """docs with last columns lang_pred and score; columns of those names are replaced."""
    spark = docs.sparkSession
    ship(spark)
    names = [n for n in docs.columns if n not in ("lang_pred", "score")]
    text = F.col("text").cast("string")
    packed = docs.select(
        F.struct(*[F.col(f"`{n}`") for n in names]).alias("row"),
        F.lower(text).alias("low"),
        F.coalesce(text.rlike(r"\p{L}"), F.lit(False)).alias("lettered"),
    )
    kind = packed.schema["row"].dataType.simpleString()
    out = packed.mapInArrow(_predict(spark.sparkContext.broadcast(field)), f"row {kind}, lang_pred string, score double")
    return out.select(*[F.col("row")[n].alias(n) for n in names], "lang_pred", "score")


def words(text: str, field: Field) -> list[tuple[str, str, float]]:
    """(word, language, posterior) of one text, for use on single texts."""
    raw = text.lower().encode()
    found, post = field.label(ta.Texts(np.frombuffer(raw, np.uint8), np.array([0, len(raw)])))
    best = post.argmax(1)
    return [
        (raw[a:b].decode(), field.languages[k], float(p[k]))
        for a, b, k, p in zip(found.starts, found.ends, best, post, strict=True)
    ]
