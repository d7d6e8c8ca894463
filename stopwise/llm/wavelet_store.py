"""Token ids in wavelet-matrix files.

A shard holds whole documents in order of id, up to about `shard_tokens` tokens. Its ids form one wavelet
matrix: from the highest bit down, the bits of the ids in their present order are one bit-plane, and the ids with a 0
then go before those with a 1. A plane keeps the number of ones before each block of 512 bits, so that rank takes
one block, and select one binary search. The file has a header in JSON, the documents' ids and
lengths, and the planes, each compressed by itself. `Shard` reads such a file: `access`, `rank` (count of a token in a prefix),
`select` (place of the k-th occurrence) and `decode` (all tokens) work on the planes.

Encoding uses the tokenizers library. White space separates words for the tokenizer, so texts are cut at spaces
and line feeds, and the distinct words of a pass into the pieces that the library's model encodes by themselves (`Pieces`). Each distinct piece of a task
is encoded once; odd words, and all words of a tokenizer that cuts otherwise, are encoded whole. A special token written in a text gets its
own id, as the library gives it with add_special_tokens=False. A pass takes documents of about `PASS_BYTES` of text.

Defined cases: null and empty texts have the end id alone; rows that share an id stay apart, in order of their text; a null id
comes first. Other columns are not read. An empty table writes no file.
"""

from __future__ import annotations

import json
import os
import struct
import unicodedata
import zlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stopwise.llm.shared import filesystem, new_folder, ship, write_file

MAGIC = b"WVLT0001"
END_ID = 1
SHARD_TOKENS = 1 << 21
RANK_BITS = 512
#: Text of the documents that are encoded at once.
PASS_BYTES = 4 << 20
#: Distinct pieces of words that a task keeps encoded; beyond it the memory starts anew.
KNOWN_WORDS = 1 << 20
MANIFEST = "part int, number int, path string, n_docs long, n_tokens long"
DOCUMENTS = "doc_id long, start long, n_tokens long, ids_crc32 long"


def planes_of(ids: np.ndarray, bits: int) -> tuple[list[bytes], list[int]]:
    """Bit-planes and the number of zeros in each."""
    order = ids.astype(np.uint16 if bits <= 16 else np.uint32)
    after = np.empty_like(order)
    planes, zeros = [], []
    for bit in range(bits - 1, -1, -1):
        on = (order & order.dtype.type(1 << bit)) != 0
        planes.append(np.packbits(on).tobytes())
        # taking by places is several times as fast as by a mask
        low, high = np.flatnonzero(~on), np.flatnonzero(on)
        zeros.append(len(low))
        np.take(order, low, out=after[: len(low)], mode="clip")
        np.take(order, high, out=after[len(low) :], mode="clip")
        order, after = after, order
    return planes, zeros


def encode_shard(doc_ids: list[int | None], lengths: np.ndarray, ids: np.ndarray) -> bytes:
    bits = max(1, int(ids.max()).bit_length()) if len(ids) else 1
    planes, zeros = planes_of(ids, bits)
    known = np.array([x is not None for x in doc_ids], np.uint8)
    table = np.array([0 if x is None else x for x in doc_ids], "<i8").tobytes() + known.tobytes() + np.asarray(lengths, "<u8").tobytes()
    packed = [zlib.compress(p, 1) for p in planes]
    head = {"tokens": len(ids), "docs": len(doc_ids), "zeros": zeros, "table": 0, "planes": [len(p) for p in packed]}
    body = zlib.compress(table, 1)
    head["table"] = len(body)
    raw = json.dumps(head).encode()
    return b"".join([MAGIC, struct.pack("<I", len(raw)), raw, body, *packed])


class Shard:
    def __init__(self, raw: bytes):
        if raw[:8] != MAGIC:
            raise ValueError("not a wavelet shard")
        size = struct.unpack("<I", raw[8:12])[0]
        head = json.loads(raw[12 : 12 + size])
        self.tokens, self.docs, self.zeros = head["tokens"], head["docs"], head["zeros"]
        at = 12 + size
        table = zlib.decompress(raw[at : at + head["table"]])
        at += head["table"]
        self.doc_ids = np.frombuffer(table, "<i8", self.docs)
        self.named = np.frombuffer(table, np.uint8, self.docs, 8 * self.docs)
        self.lengths = np.frombuffer(table, "<u8", self.docs, 9 * self.docs).astype(np.int64)
        self.packed = []
        for n in head["planes"]:
            self.packed.append(np.frombuffer(zlib.decompress(raw[at : at + n]), np.uint8))
            at += n
        self._before: list[np.ndarray] | None = None

    def decode(self) -> np.ndarray:
        """All tokens, from the lowest plane up."""
        bits = len(self.packed)
        out = np.zeros(self.tokens, np.uint16 if bits <= 16 else np.uint32)
        for bit, (plane, zeros) in enumerate(zip(reversed(self.packed), reversed(self.zeros), strict=True)):
            on = np.unpackbits(plane, count=self.tokens).view(bool)
            above = np.empty_like(out)
            above[np.flatnonzero(~on)] = out[:zeros]
            above[np.flatnonzero(on)] = out[zeros:] | out.dtype.type(1 << bit)
            out = above
        return out

    def _ranks(self) -> list[np.ndarray]:
        if self._before is None:
            step = RANK_BITS // 8
            self._before = []
            for plane in self.packed:
                ones = np.bitwise_count(plane).astype(np.int64)
                self._before.append(np.concatenate(([0], np.cumsum(np.add.reduceat(ones, np.arange(0, len(ones), step)))[:])) if len(ones) else np.zeros(1, np.int64))
        return self._before

    def _ones(self, level: int, at: int) -> int:
        """Ones before place `at` of a plane."""
        block = at // RANK_BITS
        start = block * RANK_BITS
        bits = np.unpackbits(self.packed[level][start // 8 : -(-at // 8)], count=at - start) if at > start else ()
        return int(self._ranks()[level][block]) + int(np.sum(bits))

    def access(self, at: int) -> int:
        value = 0
        for level in range(len(self.packed)):
            bit = int(self.packed[level][at // 8] >> (7 - at % 8)) & 1
            ones = self._ones(level, at)
            at = self.zeros[level] + ones if bit else at - ones
            value = value * 2 + bit
        return value

    def rank(self, token: int, upto: int) -> int:
        """Occurrences of a token before a place."""
        low = 0
        bits = len(self.packed)
        if token >> bits:
            return 0
        for level in range(bits):
            a, b = self._ones(level, low), self._ones(level, upto)
            if token >> (bits - 1 - level) & 1:
                low, upto = self.zeros[level] + a, self.zeros[level] + b
            else:
                low, upto = low - a, upto - b
        return upto - low

    def select(self, token: int, k: int) -> int:
        """Place of the k-th occurrence (from 0)."""
        if k < 0 or k >= self.rank(token, self.tokens):
            raise IndexError("the token occurs less often")
        low, high = 0, self.tokens - 1
        while low < high:
            middle = (low + high) // 2
            if self.rank(token, middle + 1) > k:
                high = middle
            else:
                low = middle + 1
        return low


class _Known:
    """Lists of ids by key, one after the other."""

    def __init__(self, kind: type):
        self.number: dict[str, int] = {}
        self.flat, self.used = np.zeros(1 << 16, kind), 0
        self.starts = np.zeros(1 << 16, np.int64)

    def find(self, keys: list[str]) -> np.ndarray:
        """Numbers of keys, -1 for those that are new."""
        return np.fromiter(map(self.number.get, keys, repeat(-1)), np.int64, len(keys))

    def add(self, keys: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        """Numbers the keys, all new and different, on from those that are known."""
        n = len(self.number)
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate((self.flat, np.zeros_like(self.flat)))
        while n + len(keys) + 1 > len(self.starts):
            self.starts = np.concatenate((self.starts, np.zeros_like(self.starts)))
        self.flat[self.used : self.used + len(ids)] = ids
        self.starts[n + 1 : n + len(keys) + 1] = self.used + np.cumsum(sizes)
        self.used += len(ids)
        self.number.update(zip(keys, range(n, n + len(keys)), strict=True))

    def places(self, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place of the first id of each numbered key, number of its ids)."""
        return self.starts[number], self.starts[number + 1] - self.starts[number]


def _join(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The runs of these places and sizes, one after the other."""
    shift = starts - (np.cumsum(sizes) - sizes)
    return flat[np.arange(int(sizes.sum())) + np.repeat(shift, sizes)]


class Pieces:
    """Cuts words into the pieces that the tokenizer encodes each by itself: runs of letters, single digits, runs of others.

    What a character becomes and which class it has is asked of the library's normalizer and pre-tokenizer when it is first seen. A
    word is odd, and left to the library as a whole, if it is not in normal form, holds an apostrophe (contractions), a special token, a
    character that Python does not know, or one that becomes several.
    """

    NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
    PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
    NEW, SPACE, LETTER, DIGIT, OTHER, ODD = range(6)

    def __init__(self, tokenizer):
        self.normalizer, self.splitter, self.model = tokenizer.normalizer, tokenizer.pre_tokenizer, tokenizer.model
        self.special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        self.letters = _byte_letters()
        self.becomes = np.arange(0x110000, dtype=np.uint32)
        self.kind = np.zeros(0x110000, np.uint8)
        self.kind[ord("\n")] = self.SPACE

    @classmethod
    def fit(cls, tokenizer) -> bool:
        """Whether this tokenizer cuts and encodes as described above."""
        if tokenizer.normalizer is None or tokenizer.pre_tokenizer is None or type(tokenizer.model).__name__ != "BPE" or tokenizer.post_processor is not None:
            return False
        steps = json.loads(tokenizer.pre_tokenizer.__getstate__()).get("pretokenizers", [])
        split = {"type": "Split", "pattern": {"Regex": cls.PATTERN}, "behavior": "Removed", "invert": True}
        level = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": False}
        model, added = tokenizer.model, tokenizer.get_added_tokens_decoder().values()
        return (
            json.loads(tokenizer.normalizer.__getstate__()) == cls.NORMALIZER
            and len(steps) == 2
            and steps[0] == split
            and {k: v for k, v in steps[1].items() if k != "trim_offsets"} == level
            and not model.dropout
            and not any(t.single_word or t.lstrip or t.rstrip or t.normalized for t in added)
            and all(model.token_to_id(chr(c) + end) is not None for c in _byte_letters() if c != 32 for end in ("", model.end_of_word_suffix or ""))
        )

    def _meet(self, codes: np.ndarray) -> None:
        for code in np.unique(codes[self.kind[codes] == self.NEW]).tolist():
            c = chr(code)
            low = self.normalizer.normalize_str(c)
            if c == "'" or len(low) != 1 or unicodedata.category(c) == "Cn" or not unicodedata.is_normalized("NFC", c):
                self.kind[code] = self.ODD
                continue
            cut = len(self.splitter.pre_tokenize_str(low + low))
            alone = self.LETTER if len(self.splitter.pre_tokenize_str("a" + low)) == 1 else self.OTHER
            self.kind[code] = (self.SPACE, alone, self.DIGIT)[cut]
            self.becomes[code] = ord(low)

    def odd(self, words: pa.Array) -> np.ndarray:
        text = _lines(words)
        codes = _codes(text)
        self._meet(codes)
        out = np.zeros(len(words), bool)
        at = np.flatnonzero(self.kind[codes] == self.ODD)
        if len(at):
            out[np.cumsum(codes == 10)[at]] = True
        if not unicodedata.is_normalized("NFC", text):
            out |= np.fromiter((not unicodedata.is_normalized("NFC", w) for w in words.to_pylist()), bool, len(words))
        for s in self.special:
            if s in text:
                out |= pc.match_substring(words, s).to_numpy(zero_copy_only=False)
        return out

    def cut(self, words: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
        """(the pieces of words that are not odd, number of pieces of each)."""
        codes = _codes(_lines(words))
        kind = self.kind[codes]
        solid = kind != self.SPACE
        first = solid & ((kind == self.DIGIT) | (kind != np.concatenate(([self.SPACE], kind[:-1]))))
        counts = np.bincount(np.cumsum(codes == 10)[first], minlength=len(words))
        starts = np.flatnonzero(first[solid])
        spaced = np.insert(self.becomes[codes[solid]], starts[1:], 32).astype("<u4").tobytes().decode("utf-32-le")
        pieces = pc.split_pattern(pa.array([spaced] if len(starts) else [], pa.string()), " ").flatten()
        return pieces.dictionary_encode(), counts

    def encode(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pieces, number of ids of each), by the library's model."""
        raw = np.frombuffer(" ".join(pieces).encode(), np.uint8)
        spelled = self.letters[raw].tobytes().decode("utf-32-le").split(" ") if pieces else []
        tokenize = self.model.tokenize
        ids: list[int] = []
        sizes: list[int] = []
        for piece in spelled:
            coded = tokenize(piece)
            sizes.append(len(coded))
            ids.extend([t.id for t in coded])
        return np.array(ids, np.int32), np.array(sizes, np.int64)


def _lines(words: pa.Array) -> str:
    """Words one after the other, a line each."""
    offsets = pa.array([0, len(words)], pa.int32())
    return pc.binary_join(pa.ListArray.from_arrays(offsets, words), "\n")[0].as_py()


def _strings(words: pa.Array) -> list[str]:
    """The words as Python has them; `to_pylist` takes several times as long, as it makes a scalar of each first."""
    return words.to_numpy(zero_copy_only=False).tolist()


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), "<u4")


def _byte_letters() -> np.ndarray:
    """The characters by which byte-level vocabularies spell the 256 bytes; the space, which parts pieces here, stays."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in visible]
    return np.array([b if b in visible or b == 32 else 256 + hidden.index(b) for b in range(256)], "<u4")


class WordMemory:
    """Ids of pieces of words (of whole words, where they are odd), each encoded once; `encode` gives the ids of many texts."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.cutter = Pieces(self.tokenizer) if Pieces.fit(self.tokenizer) else None
        self.reset()

    def reset(self) -> None:
        kind = np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.int32
        self.pieces, self.whole = _Known(kind), _Known(kind)

    def _plain(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of these words, which are not odd, number of ids of each)."""
        found, counts = self.cutter.cut(words)
        pieces = _strings(found.dictionary)
        number = self.pieces.find(pieces)
        at = np.flatnonzero(number < 0)
        number[at] = len(self.pieces.number) + np.arange(len(at))
        new = [pieces[k] for k in at.tolist()]
        self.pieces.add(new, *self.cutter.encode(new))
        starts, sizes = self.pieces.places(number)
        at = found.indices.to_numpy()
        ends = np.concatenate(([0], np.cumsum(sizes[at])))[np.cumsum(counts)]
        return _join(self.pieces.flat, starts[at], sizes[at]), np.diff(ends, prepend=0)

    def _odd(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        keys = _strings(words)
        new = [w for w in keys if w not in self.whole.number]
        for k in range(0, len(new), 4096):
            some = new[k : k + 4096]
            coded = [e.ids for e in self.tokenizer.encode_batch_fast(some, add_special_tokens=False)]
            sizes = np.fromiter(map(len, coded), np.int64, len(coded))
            self.whole.add(some, np.fromiter((i for c in coded for i in c), np.int32, int(sizes.sum())), sizes)
        starts, sizes = self.whole.places(self.whole.find(keys))
        return _join(self.whole.flat, starts, sizes), sizes

    def _distinct(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids of distinct words, place of the first of each word, number of each)."""
        if len(self.pieces.number) + len(self.whole.number) > KNOWN_WORDS:
            self.reset()
        odd = self.cutter.odd(words) if self.cutter else np.ones(len(words), bool)
        starts, sizes = np.zeros((2, len(words)), np.int64)
        parts, used = [], 0
        for which, ids_of in ((~odd, self._plain), (odd, self._odd)):
            at = np.flatnonzero(which)
            if len(at):
                ids, sizes[at] = ids_of(words.take(pa.array(at)))
                starts[at] = used + np.cumsum(sizes[at]) - sizes[at]
                parts.append(ids)
                used += len(ids)
        return np.concatenate(parts), starts, sizes

    def encode(self, texts: list[str | None] | pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts with end ids, number of ids of each)."""
        lines = pc.fill_null(pa.array(texts, pa.string()) if isinstance(texts, list) else texts.cast(pa.string()), "")
        if not len(lines):
            return np.zeros(0, self.pieces.flat.dtype), np.zeros(0, np.int64)
        split = pc.split_pattern(pc.replace_substring(lines, "\n", " "), " ")
        words = split.flatten().dictionary_encode()
        flat, starts, sizes = self._distinct(words.dictionary)
        at = words.indices.to_numpy()
        ids, sizes = _join(flat, starts[at], sizes[at]), sizes[at]
        ends = np.cumsum(pc.list_value_length(split).to_numpy())
        bounds = np.concatenate(([0], np.cumsum(sizes)))[ends]
        return np.insert(ids, bounds, END_ID), np.diff(bounds, prepend=0) + 1


def _writer(folder: str, tokenizer: str, shard_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        memory = WordMemory(tokenizer)
        held: list[tuple[list, np.ndarray, np.ndarray]] = []
        size = number = 0

        def flush() -> pa.RecordBatch:
            nonlocal size, number
            ids = [x for h in held for x in h[0]]
            lengths, tokens = np.concatenate([h[1] for h in held]), np.concatenate([h[2] for h in held])
            path = f"{folder}/part-{part:06d}-{number:06d}.wvlt"
            write_file(path, [encode_shard(ids, lengths, tokens)])
            row = {"part": part, "number": number, "path": path, "n_docs": len(ids), "n_tokens": len(tokens)}
            held.clear()
            size, number = 0, number + 1
            return pa.RecordBatch.from_pylist([row], MANIFEST_TYPE)

        for batch in batches:
            upto = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64))
            at = 0
            while at < batch.num_rows:
                # as many rows as hold about PASS_BYTES of text, one at least
                before = upto[at - 1] if at else 0
                n = max(1, int(np.searchsorted(upto, before + PASS_BYTES, "right")) - at)
                piece = batch.slice(at, n)
                at += n
                tokens, lengths = memory.encode(piece.column("text"))
                held.append((piece.column("doc_id").to_pylist(), lengths, tokens))
                size += len(tokens)
                if size >= shard_tokens:
                    yield flush()
        if held:
            yield flush()

    return run


MANIFEST_TYPE = pa.schema(
    [("part", pa.int32()), ("number", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())]
)


def write(docs: DataFrame, tokenizer: str, folder: str | None = None, shard_tokens: int = SHARD_TOKENS) -> str:
    """Writes the shards and a manifest table; returns the folder. tokenizer: path of a tokenizers file on every executor."""
    spark = docs.sparkSession
    ship(spark)
    folder = folder or new_folder(spark, "wavelet")
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    ordered = rows.repartitionByRange(F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    ordered.mapInArrow(_writer(f"{folder}/shards", tokenizer, shard_tokens), MANIFEST).write.parquet(f"{folder}/manifest")
    return folder


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for r in batch.to_pylist():
            fs, inner = filesystem(r["path"])
            with fs.open_input_file(inner) as source:
                shard = Shard(source.read())
            words = np.ascontiguousarray(shard.decode().astype("<u4"))
            view = memoryview(words).cast("B")
            ends = np.cumsum(shard.lengths)
            starts = ends - shard.lengths
            before = r["first"]
            sums = [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
            n = shard.docs
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(shard.doc_ids, mask=shard.named == 0),
                    pa.array(starts + before),
                    pa.array(shard.lengths),
                    pa.array(np.array(sums, np.int64)),
                ],
                names=[x.split()[0] for x in DOCUMENTS.split(", ")],
            )


def read(spark, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the shards."""
    ship(spark)
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    # tokens before each part (one row per part), and before each shard inside its part
    parts = manifest.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    parts = parts.withColumn("before", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("n")
    inside = Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    firsts = (
        manifest.withColumn("inner", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
        .join(parts, "part")
        .select("path", (F.col("before") + F.col("inner")).alias("first"))
    )
    # names of shards with the tokens before them are all that moves; one task per shard: a number that is given is
    # not merged, however few bytes the paths have
    return firsts.repartition(max(1, manifest.count()), "path").mapInArrow(_reader, DOCUMENTS)
