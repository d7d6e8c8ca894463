"""Alignment of the tokens of two tokenizers, and how often each pair of ids overlaps in the whole corpus.

Tokenizer A is a byte-level BPE file and gets a space and the text; tokenizer B is a sentencepiece model that adds the space itself. Both cut the
same bytes, so each token has a byte range. Per pass over some documents, `pandas.merge_asof`, keyed by document, gives each start of an A token
the B token that covers it, and each start of a B token the A token that covers it; the union of both directions is all overlapping pairs,
and equal ends close groups.

Texts are encoded in units: a unit begins at a space after a printable ASCII character. The pattern of A ends a match there, and no piece of B goes on
over a space (checked when the model is loaded; else a text is one unit), so the tokens of a text are those of its units. A task remembers the
tokens of units that it has seen.

Counting the pairs of ids over the corpus: a task aligns its documents in passes, writes one compressed file of per-document results for
every `FILE_BYTES` of text into the shared folder, and emits each distinct pair of the file once, with its number of links. So no pair has more
rows than there are files, whatever its frequency. Pairs are summed, the highest count of each B id is found, and both return to the files, where
the sums of each document are made.

Defined cases: null and empty texts, and texts whose tokens do not give back their bytes, have no tokens: all numbers are 0 and the groups are
empty. Repeated rows and rows with null or repeated ids are aligned and counted each. Ties for the highest count are all highest. A text longer than a pass is a
pass of its own, whole; its work grows with its length. Other columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import os
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopwise.llm import textarrays as ta
from stopwise.llm.shared import cut, filesystem, new_folder, ship, write_file

#: Bytes of text of one file of results, and of one pass of the tokenizers.
FILE_BYTES = 24 << 20
PASS_BYTES = 1 << 20
#: Bytes of units that a task remembers; beyond them it starts anew.
MEMORY_BYTES = 6 << 20

PER_DOC = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long"


def byte_letters() -> dict[str, int]:
    """The byte of each letter of byte-level vocabularies: printable bytes stand for themselves, the others follow from 256 on."""
    own = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


@dataclass
class Pair:
    """Both tokenizers, the bytes of their ids, and the texts `id + separator` from which groups are written."""

    a: object
    b: object
    bytes_a: pa.Array
    bytes_b: pa.Array
    marks: pa.Array
    units: bool

    @property
    def size_a(self) -> int:
        return len(self.bytes_a)

    @property
    def size_b(self) -> int:
        return len(self.bytes_b)


@lru_cache(maxsize=1)
def load(path_a: str, path_b: str) -> Pair:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(path_a)
    a.encode_special_tokens = True
    a.no_truncation()
    a.no_padding()
    b = SentencePieceProcessor(model_file=path_b)
    letters = byte_letters()
    vocabulary = a.get_vocab()
    of_a = [b""] * (max(vocabulary.values()) + 1)
    for token, k in vocabulary.items():
        plain = all(c in letters for c in token)
        of_a[k] = bytes(letters[c] for c in token) if plain else token.encode()
    of_b = []
    for k in range(b.vocab_size()):
        piece = b.id_to_piece(k)
        of_b.append(bytes([int(piece[3:5], 16)]) if b.is_byte(k) else piece.replace("▁", " ").encode())
    crossing = any(" " in piece.lstrip(b" ").decode("latin-1") for piece in of_b)
    marks = [f"{k}{s}" for s in ",|" for k in range(len(of_a))] + [f"{k}{s}" for s in (",", ";", "") for k in range(len(of_b))]
    return Pair(a, b, pa.array(of_a, pa.large_binary()), pa.array(of_b, pa.large_binary()), pa.array(marks, pa.large_string()), not crossing)


def _buffer(array: pa.Array) -> tuple[np.ndarray, memoryview]:
    _, offsets, data = array.buffers()
    at = np.frombuffer(offsets, np.int64)[array.offset : array.offset + len(array) + 1] if offsets else np.zeros(1, np.int64)
    return at, memoryview(data).cast("B") if data is not None else memoryview(b"")


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    n = np.array([len(x) for x in lists], np.int64)
    return np.fromiter(chain.from_iterable(lists), np.int64, int(n.sum())), n


class Memory:
    """Encodes texts by both tokenizers through their distinct units."""

    def __init__(self, pair: Pair):
        self.pair = pair
        self.forget()

    def forget(self) -> None:
        """known: the number of each unit; of each side, the ids of all units in a row and where those of a unit end."""
        self.held = 0
        self.known: dict[bytes, int] = {}
        self.sides = [(np.zeros(0, np.int32), np.zeros(1, np.int64)) for _ in "ab"]

    def _units(self, spaced: list[bytes]) -> tuple[pa.Array, np.ndarray]:
        """All units, and how many each text has."""
        ends = np.cumsum([len(x) for x in spaced])
        data = np.frombuffer(b"".join(spaced), np.uint8)
        starts = np.concatenate(([0], ends[:-1]))
        cut = np.zeros(len(data), bool)
        if self.pair.units:
            cut[1:] = (data[1:] == 0x20) & (data[:-1] > 0x20) & (data[:-1] < 0x7F)
            # a last space is no start: B would not see it
            cut[ends - 1] = False
        cut[starts] = True
        cuts = np.flatnonzero(cut)
        places = pa.py_buffer(np.append(cuts, len(data)).astype(np.int64))
        units = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(cuts), [None, places, pa.py_buffer(data)])
        return units, np.append(np.searchsorted(cuts, starts), len(cuts))

    def encode(self, spaced: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For A and for B: the ids of all texts in a row, and how many each text has."""
        units, ends = self._units(spaced)
        coded = units.dictionary_encode()
        words = coded.dictionary.to_pylist()
        if self.held > MEMORY_BYTES:
            self.forget()
        fresh = [w for w in words if w not in self.known]
        if fresh:
            plain = [w.decode() for w in fresh]
            found = [[e.ids for e in self.pair.a.encode_batch_fast(plain, add_special_tokens=False)], self.pair.b.encode([w[1:] for w in plain], out_type=int, num_threads=1)]
            for k, (ids, n) in enumerate(map(_flat, found)):
                old, upto = self.sides[k]
                self.sides[k] = np.concatenate((old, ids.astype(np.int32))), np.concatenate((upto, upto[-1] + np.cumsum(n)))
            self.known.update(zip(fresh, range(len(self.known), len(self.known) + len(fresh))))
            self.held += sum(map(len, fresh))
        numbers = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        place = numbers[coded.indices.to_numpy()]
        return [_spread(ids, upto, place, ends) for ids, upto in self.sides]


def _spread(ids: np.ndarray, upto: np.ndarray, place: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the units at `place` in a row, and how many there are between the ends."""
    first = upto[place]
    lengths = upto[place + 1] - first
    total = np.concatenate(([0], np.cumsum(lengths)))
    return ids[np.repeat(first - total[:-1], lengths) + np.arange(total[-1])].astype(np.int64), np.diff(total[ends])


@dataclass
class Aligned:
    """Of each document: tokens, groups, links, the text of its groups; and its distinct pairs of ids (a * size_b + b) with their links."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    groups: list[memoryview]
    first: np.ndarray
    pairs: np.ndarray
    times: np.ndarray


def overlaps(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
    """All pairs of rows of (doc, start, id) that overlap, as (doc, a, b): the later start of a pair lies in the other token."""
    left, right = a.rename(columns={"id": "a"}), b.rename(columns={"id": "b"})
    starts_in_b = pd.merge_asof(left, right, on="start", by="doc")
    starts_in_a = pd.merge_asof(right, left.assign(from_a=left["start"]), on="start", by="doc")
    later = starts_in_a["from_a"].to_numpy() < starts_in_a["start"].to_numpy()
    return pd.concat([starts_in_b[["doc", "a", "b"]], starts_in_a.loc[later, ["doc", "a", "b"]]], ignore_index=True)


def align(texts: list[str], memory: Memory) -> Aligned:
    """Aligns some texts; nothing in the result depends on which texts stand together."""
    n, pair = len(texts), memory.pair
    spaced = [b" " + t.encode() for t in texts]
    (ids_a, n_a), (ids_b, n_b) = memory.encode(spaced)
    at_a, data_a = _buffer(pair.bytes_a.take(pa.array(ids_a)))
    at_b, data_b = _buffer(pair.bytes_b.take(pa.array(ids_b)))
    ends_a, ends_b = np.concatenate(([0], np.cumsum(n_a))), np.concatenate(([0], np.cumsum(n_b)))
    good = np.zeros(n, bool)
    for k, want in enumerate(spaced):
        good[k] = (
            len(want) > 1
            and data_a[at_a[ends_a[k]] : at_a[ends_a[k + 1]]] == want
            and data_b[at_b[ends_b[k]] : at_b[ends_b[k + 1]]] == want
        )
    use_a, use_b = np.repeat(good, n_a), np.repeat(good, n_b)
    size_a, size_b = np.diff(at_a)[use_a], np.diff(at_b)[use_b]
    ids_a, ids_b = ids_a[use_a], ids_b[use_b]
    n_a, n_b = np.where(good, n_a, 0), np.where(good, n_b, 0)
    doc_a, doc_b = np.repeat(np.arange(n), n_a), np.repeat(np.arange(n), n_b)
    # both sides cut the same bytes of the same documents, so running ends are places in one buffer
    end_a, end_b = np.cumsum(size_a), np.cumsum(size_b)
    found = overlaps(
        pd.DataFrame({"doc": doc_a, "start": end_a - size_a, "id": ids_a}),
        pd.DataFrame({"doc": doc_b, "start": end_b - size_b, "id": ids_b}),
    )
    common = np.intersect1d(end_a, end_b, assume_unique=True)
    group_a, group_b = np.searchsorted(common, end_a), np.searchsorted(common, end_b)
    docs = found["doc"].to_numpy(np.int64)
    width = pair.size_a * pair.size_b
    keys, times = np.unique(docs * width + found["a"].to_numpy(np.int64) * pair.size_b + found["b"].to_numpy(np.int64), return_counts=True)
    return Aligned(
        n_a,
        n_b,
        np.bincount(doc_a[np.isin(end_a, common, assume_unique=True)], minlength=n),
        np.bincount(docs, minlength=n),
        _written(ids_a, ids_b, group_a, group_b, n_a + n_b, pair),
        np.searchsorted(keys // width, np.arange(n + 1)),
        keys % width,
        times,
    )


def _written(ids_a: np.ndarray, ids_b: np.ndarray, group_a: np.ndarray, group_b: np.ndarray, n: np.ndarray, pair: Pair) -> list[memoryview]:
    """The groups of each document as text: a1,a2|b1;a3|b2,b3."""
    part = np.concatenate((group_a * 2, group_b * 2 + 1))
    order = np.argsort(part, kind="stable")
    part = part[order]
    more = np.zeros(len(part), bool)
    more[:-1] = part[1:] == part[:-1]
    last = np.zeros(len(part), bool)
    bounds = np.concatenate(([0], np.cumsum(n)))
    last[bounds[1:][n > 0] - 1] = True
    of_b = part % 2 == 1
    own = np.concatenate((ids_a, ids_b))[order]
    kind_a = np.where(more, 0, 1) * pair.size_a
    kind_b = 2 * pair.size_a + np.where(more, 0, np.where(last, 2, 1)) * pair.size_b
    at, data = _buffer(pair.marks.take(pa.array(own + np.where(of_b, kind_b, kind_a))))
    return [data[at[x] : at[y]] for x, y in zip(bounds[:-1], bounds[1:])]


def _passes(texts: pa.Array) -> Iterator[pa.Array]:
    for first, last, _ in ta.passes(ta.from_arrow(texts), PASS_BYTES):
        yield texts.slice(first, last - first)


def groups(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """doc_id, groups, links of every document: the text of its groups and its pairs of ids with their numbers of links."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = load(path_a, path_b)
        memory = Memory(pair)
        for batch in batches:
            at = 0
            for texts in _passes(batch.column(1)):
                got = align([t or "" for t in texts.to_pylist()], memory)
                links = pa.StructArray.from_arrays(
                    [pa.array(got.pairs // pair.size_b), pa.array(got.pairs % pair.size_b), pa.array(got.times)], ["a", "b", "n"]
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, len(texts)),
                        pa.array([str(g, "ascii") for g in got.groups], pa.string()),
                        pa.ListArray.from_arrays(pa.array(got.first, pa.int32()), links),
                    ],
                    names=["doc_id", "groups", "links"],
                )
                at += len(texts)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, groups string, links array<struct<a: long, b: long, n: long>>")


def sha256_or_empty(text: memoryview) -> str:
    return hashlib.sha256(text).hexdigest() if len(text) else ""


def _lists(first: list[np.ndarray], values: list[np.ndarray]) -> pa.Array:
    sizes = np.concatenate([np.diff(f) for f in first])
    return pa.LargeListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes)))), pa.array(np.concatenate(values)))


def _pack(ids: list[pa.Array], parts: list[Aligned], digests: list[str]) -> tuple[bytes, np.ndarray, np.ndarray]:
    """One file: the numbers of each document, its pairs as steps between places in the sorted pairs of the file; and these pairs with their links."""
    pairs, place = np.unique(np.concatenate([p.pairs for p in parts]), return_inverse=True)
    times = np.concatenate([p.times for p in parts])
    links = np.bincount(place, times, len(pairs)).astype(np.int64)
    first, bounds = [p.first for p in parts], np.concatenate([np.diff(p.first) for p in parts])
    steps = np.diff(place, prepend=0)
    starts = np.cumsum(bounds) - bounds
    steps[starts[bounds > 0]] = place[starts[bounds > 0]]
    table = pa.table(
        {
            "doc_id": pa.concat_arrays(ids),
            "n_a": np.concatenate([p.n_a for p in parts]),
            "n_b": np.concatenate([p.n_b for p in parts]),
            "n_groups": np.concatenate([p.n_groups for p in parts]),
            "n_links": np.concatenate([p.n_links for p in parts]),
            "digest": digests,
            "steps": _lists(first, [steps.astype(np.uint32)]),
            "times": _lists(first, [times.astype(np.uint32)]),
        }
    )
    sink = pa.BufferOutputStream()
    with pa.ipc.new_file(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table)
    return sink.getvalue(), pairs, links


def _store(folder: str, path_a: str, path_b: str, digest: Callable[[memoryview], str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = Memory(load(path_a, path_b))
        ids, parts, digests, held = [], [], [], 0

        def close() -> pa.RecordBatch:
            name = uuid.uuid4().hex
            data, pairs, links = _pack(ids, parts, digests)
            write_file(f"{folder}/{name}", [data])
            found = [pa.array(pairs, pa.int64()), pa.array(links, pa.int64())] if len(pairs) else [pa.nulls(1, pa.int64())] * 2
            return pa.RecordBatch.from_arrays([pa.array([name] * len(found[0])), *found], names=["file", "pair", "links"])

        for batch in batches:
            at = 0
            for texts in _passes(batch.column(1)):
                got = align([t or "" for t in texts.to_pylist()], memory)
                ids.append(batch.column(0).slice(at, len(texts)))
                digests += [digest(g) for g in got.groups]
                got.groups = []
                parts.append(got)
                at += len(texts)
                held += texts.nbytes
                if held >= FILE_BYTES:
                    yield close()
                    ids, parts, digests, held = [], [], [], 0
        if parts:
            yield close()

    return run


def _finish(folder: str):
    def run(found: pd.DataFrame) -> pd.DataFrame:
        fs, inner = filesystem(f"{folder}/{found['file'].iloc[0]}")
        with fs.open_input_file(inner) as source:
            table = pa.ipc.open_file(source).read_all().combine_chunks()
        found = found[found["pair"].notna()].sort_values("pair")
        corpus, best = found["corpus"].to_numpy(np.int64), found["highest"].to_numpy(bool)
        steps, times = table["steps"].chunk(0), table["times"].chunk(0).values.to_numpy().astype(np.int64)
        first = steps.offsets.to_numpy()
        run_of = np.cumsum(steps.values.to_numpy().astype(np.int64))
        # steps start anew in each document: take off what ran before it
        before = np.concatenate(([0], run_of))[first[:-1]]
        place = run_of - np.repeat(before, np.diff(first))

        def total(values: np.ndarray) -> np.ndarray:
            sums = np.concatenate(([0], np.cumsum(values)))
            return sums[first[1:]] - sums[first[:-1]]

        return pd.DataFrame(
            {
                "doc_id": table["doc_id"].to_pandas(types_mapper=lambda t: pd.Int64Dtype()),
                **{c: table[c].to_numpy() for c in ("n_a", "n_b", "n_groups", "n_links")},
                "groups_sha256": table["digest"].to_pandas(),
                "n_best": total(times * best[place]),
                "count_sum": total(times * corpus[place]),
            }
        )

    return run


def audit(docs: DataFrame, path_a: str, path_b: str, digest: Callable[[memoryview], str] = sha256_or_empty) -> DataFrame:
    """Of every document: doc_id, tokens, groups, links, a digest of the text of its groups, and the sums over corpus-wide counts of its pairs."""
    spark = docs.sparkSession
    ship(spark)
    folder = new_folder(spark, "alignment")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    pairs = cut(rows.mapInArrow(_store(folder, path_a, path_b, digest), "file string, pair long, links long"))
    size_b = load(path_a, path_b).size_b
    counts = cut(pairs.where("pair is not null").groupBy("pair").agg(F.sum("links").alias("corpus")))
    counts = counts.withColumn("b", F.pmod("pair", F.lit(size_b)))
    # one row per id of B
    highest = counts.groupBy("b").agg(F.max("corpus").alias("most"))
    if size_b <= 1 << 20:
        highest = F.broadcast(highest)
    ranked = counts.join(highest, "b").select("pair", "corpus", (F.col("corpus") == F.col("most")).alias("highest"))
    found = pairs.select("file", "pair").join(ranked, "pair", "left")
    return found.groupBy("file").applyInPandas(_finish(folder), PER_DOC)
