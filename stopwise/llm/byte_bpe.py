"""Byte-level BPE encoding and decoding by folds over distinct words.

Texts are split before every space that precedes a character other than white space, and between a Latin letter
and a mark of ASCII. No match of the tokenizer's pattern crosses such a place, so the ids of a text are those of its units in order. A task numbers the words and units of its
documents and stores these numbers beside the other columns, in compressed files of about `group_bytes` of text in the shared folder; texts are neither stored nor shuffled. Each distinct unit of a
file is sent once, with the numbers of the file and of the unit in it, to where the unit is encoded: a higher-order fold takes the
pattern's matches as arrays of bytes and merges, again and again, the neighbouring pair of lowest rank (the first of equal ones)
until no pair has a rank. The ids of units leave for their files packed: many units of one file as one row, their numbers as steps and
all numbers byte by byte, compressed. Ranks are a literal map: an array of pairs of ids and the ranks they
join to, in which a pair has two possible places, because a search in a map value reads all of it. It enters the plan as the
value of a one-row table, since an array written out in a plan fills the driver with its boxed numbers and texts. At its file, each
document is put together.

Decoding looks up the bytes of each id in a literal array and concatenates the pieces.

The work of a single unit grows with the square of its length in bytes; units of natural text are short.

Defined cases: null and empty texts have no ids and decode to no bytes; repeated rows are encoded each;
null ids are kept. Other columns pass through unread by way of a struct. An empty table gives no rows.
"""

from __future__ import annotations

import base64
import re
import uuid
import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stopwise.llm import textarrays as ta
from stopwise.llm.shared import filesystem, new_folder, ship, write_file

GROUP_BYTES = 32 << 20
#: Input partitions whose files share the list of a unit; beyond them a unit is encoded once more.
BLOCK_PARTITIONS = 1024
#: Encoded units that a task holds until they are packed by file.
PACK_BYTES = 16 << 20
#: Words whose ids are put together at once.
PASS_WORDS = 1 << 20
BUCKETS = 8192
#: Places of the table of pairs: enough for all pairs of a vocabulary of 50,000 tokens.
FIRST_PLACES = 250_007
SECOND_PLACES = 140_009
#: Above every id; a pair and the rank it joins to take three times so many bits.
BITS = 17
SPAN = 1 << BITS
NO_RANK = (1 << 31) - 1
#: Characters that the tokenizer's pattern counts as white space, as the body of a character class.
SPACE = r"\t-\r \u0085   -     　"
LETTER = "A-Za-zÀ-ÖØ-öø-ÿ"
MARK = r"!-/:-@\[-`{-~"
WORD_CUT = rf"(?= [^{SPACE}])"
MARK_CUT = rf"(?<=[{LETTER}])(?=[{MARK}])"
ODD = re.compile(rf" (?:[{SPACE}]|\Z)")
EXACT_WORD_CUT = re.compile(WORD_CUT)
EXACT_MARK_CUT = re.compile(MARK_CUT)


class Ranks:
    """A rank file: a base64 token and its rank per line."""

    def __init__(self, path: str, pattern: str):
        lines = [line.split() for line in open(path, "rb").read().splitlines() if line]
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in lines}
        # the pattern as Spark's regular expressions read it: white space and its complement in full
        self.pattern = pattern.replace(r"[^\s", rf"[^{SPACE}").replace(r"(?!\S)", rf"(?![^{SPACE}])").replace(r"\s", rf"[{SPACE}]")

    def tables(self, spark: SparkSession) -> Column:
        """The maps of tokens, the table of pairs and the ids of the 256 bytes: one row of one struct, as a scalar. Its value
        enters the tasks as a literal, but packed, and no text of a plan spells it out."""
        held = pa.table({
            "tokens": pa.array([self._token_maps()], pa.list_(pa.map_(pa.string(), pa.int32()))),
            "pairs": pa.ListArray.from_arrays(pa.array([0, FIRST_PLACES + SECOND_PLACES], pa.int32()), pa.array(self._pair_table())),
            "single": pa.array([[self.ranks[bytes([b])] for b in range(256)]], pa.list_(pa.int32())),
        })
        return spark.createDataFrame(held).select(F.struct("tokens", "pairs", "single")).scalar()

    def _token_maps(self) -> list[list[tuple[str, int]]]:
        """Maps of hex token to rank in order of checksum modulo BUCKETS."""
        buckets: list[list[tuple[str, int]]] = [[] for _ in range(BUCKETS)]
        for token, rank in self.ranks.items():
            key = token.hex().upper()
            buckets[zlib.crc32(key.encode()) % BUCKETS].append((key, rank))
        return buckets

    def _pair_table(self) -> np.ndarray:
        """All pairs of tokens that join to one, and the ranks they join to, as numbers pair * SPAN + rank.

        A pair stands at one of two places: the pair modulo FIRST_PLACES, or FIRST_PLACES and the pair modulo
        SECOND_PLACES. A pair that finds a place taken moves the other one on to its other place.
        """
        if max(self.ranks.values()) + 1 >= SPAN:
            raise ValueError(f"ranks must stay below {SPAN - 1}")
        table = array("q", [-1]) * (FIRST_PLACES + SECOND_PLACES)
        for token, rank in self.ranks.items():
            for at in range(1, len(token)):
                left, right = self.ranks.get(token[:at]), self.ranks.get(token[at:])
                if left is None or right is None:
                    continue
                entry = ((left + 1) * SPAN + right + 1) * SPAN + rank
                place = entry // SPAN % FIRST_PLACES
                for _ in range(10_000):
                    table[place], entry = entry, table[place]
                    if entry < 0:
                        break
                    pair = entry // SPAN
                    second = FIRST_PLACES + pair % SECOND_PLACES
                    place = pair % FIRST_PLACES if place == second else second
                else:
                    raise ValueError("the table of pairs is too small for this vocabulary")
        return np.frombuffer(table, np.int64)

    def piece_literal(self) -> Column:
        """array<hex> in order of id."""
        pieces = [""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            pieces[rank] = token.hex().upper()
        return F.split(F.lit(",".join(pieces)), ",")


def _let(value: Column, body) -> Column:
    """body of value, with value computed once: the last step of a fold over nothing that starts from it."""
    return F.aggregate(F.array().cast("array<int>"), value, lambda x, _: x, body)


def _token_rank(tokens: Column, key: Column) -> Column:
    return F.try_element_at(F.get(tokens, (F.crc32(key.cast("binary")) % BUCKETS).cast("int")), key)


def _pair_rank(table: Column, pair: Column) -> Column:
    def at(place: Column, otherwise: Column) -> Column:
        entry = lambda e: F.when(F.shiftright(e, BITS) == pair, e.bitwiseAND(SPAN - 1)).otherwise(otherwise)
        return _let(F.get(table, place.cast("int")), entry)

    return at(pair % FIRST_PLACES, at(pair % SECOND_PLACES + FIRST_PLACES, F.lit(NO_RANK)))


def merge(piece: Column, key: Column, tokens: Column, pairs: Column, single: Column) -> Column:
    """Ids of one match of the pattern, given as text and as the key of the tokens.

    The state of the fold is one array: for each id between two ends, and the left end, the rank of its pair with its right
    neighbour times SPAN, and the id itself plus 1. The ends count as 0, which no pair has.
    """
    size = F.length(key) / 2

    def entry(left: Column, right: Column) -> Column:
        return _let(left * SPAN + right, lambda x: F.shiftleft(_pair_rank(pairs, x), BITS)) + left

    def start() -> Column:
        ends = F.array(F.lit(0).cast("bigint"))
        letters = F.split(F.decode(F.encode(piece, "UTF-8"), "ISO-8859-1"), "")
        ids = F.concat(ends, F.transform(letters, lambda c: (F.get(single, F.ascii(c)) + 1).cast("bigint")), ends)
        return _let(ids, lambda p: F.transform(F.sequence(F.lit(0), F.size(p) - 2), lambda i: entry(F.get(p, i), F.get(p, i + 1))))

    def id_at(state: Column, at: Column) -> Column:
        return F.coalesce(F.get(state, at).bitwiseAND(SPAN - 1), F.lit(0).cast("bigint"))

    def step(state: Column, _: Column) -> Column:
        def joined(low: Column, at: Column) -> Column:
            # at: the place of the left id, counted from 1; the entry before it and the joined one are new
            fresh = F.array(entry(id_at(state, at - 2), low + 1), entry(low + 1, id_at(state, at + 1)))
            return F.concat(F.slice(state, F.lit(1), at - 2), fresh, F.slice(state, at + 2, F.size(state)))

        def lowest(low: Column) -> Column:
            first = F.array_position(F.transform(state, lambda e: F.shiftright(e, BITS)), low).cast("int")
            return _let(first, lambda at: joined(low, at))

        return _let(F.shiftright(F.array_min(state), BITS), lambda low: F.when(low == NO_RANK, state).otherwise(lowest(low)))

    def folded() -> Column:
        end = F.aggregate(F.sequence(F.lit(1), F.greatest(size.cast("int") - 1, F.lit(1))), start(), step)
        return _let(end, lambda p: F.transform(F.slice(p, F.lit(2), F.size(p)), lambda e: (e.bitwiseAND(SPAN - 1) - 1).cast("int")))

    return _let(_token_rank(tokens, key), lambda whole: F.when(whole.isNotNull(), F.array(whole)).otherwise(folded()))


def encode_units(units: DataFrame, column: str, ranks: Ranks) -> DataFrame:
    """units with a last column `ids`."""
    matches = F.regexp_extract_all(F.col(column), F.lit(ranks.pattern), F.lit(0))

    def encoded(tokens: Column, pairs: Column, single: Column) -> Column:
        piece = lambda m: _let(F.hex(F.encode(m, "UTF-8")), lambda h: merge(m, h, tokens, pairs, single))
        return F.flatten(F.transform(matches, piece))

    # each table is bound to a name, so that it is taken out of the row once for a unit
    with_single = lambda r, t, p: _let(r["single"], lambda s: encoded(t, p, s))
    with_pairs = lambda r, t: _let(r["pairs"], lambda p: with_single(r, t, p))
    with_tokens = lambda r: _let(r["tokens"], lambda t: with_pairs(r, t))
    with_tables = units.withColumn("_tables", ranks.tables(units.sparkSession))
    return with_tables.withColumn("ids", _let(F.col("_tables"), with_tokens)).drop("_tables")


def _nullable(kind: pa.DataType) -> pa.DataType:
    """The type with nulls allowed everywhere, as Spark names types in a schema string."""
    if pa.types.is_struct(kind):
        return pa.struct([pa.field(f.name, _nullable(f.type)) for f in kind])
    if pa.types.is_list(kind):
        return pa.list_(_nullable(kind.value_type))
    return kind


class _Numbers:
    """The words of each text, the units of each word, and the units; all numbered in order of first appearance."""

    def __init__(self):
        self.word_number: defaultdict[str, int] = defaultdict()
        self.word_number.default_factory = self.word_number.__len__
        self.words: list[np.ndarray] = []

    def add(self, texts: list[str | None]) -> None:
        for text in texts:
            words = _words(text) if text else []
            self.words.append(np.fromiter(map(self.word_number.__getitem__, words), np.int32, len(words)))

    def close(self) -> tuple[list[list[int]], list[str]]:
        """The units of each word, and all units."""
        unit_number: defaultdict[str, int] = defaultdict()
        unit_number.default_factory = unit_number.__len__
        parts = [[unit_number[u] for u in _units(w)] for w in self.word_number]
        return parts, list(unit_number)


def _ipc(table: pa.Table) -> bytes:
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, table.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 3))) as stream:
        stream.write_table(table)
    return out.getvalue()


def _by_bytes(numbers: np.ndarray) -> np.ndarray:
    """The lowest bytes of all numbers, then the next ones, and so on: like bytes side by side compress far better."""
    return np.ascontiguousarray(np.ascontiguousarray(numbers, "<i4").view(np.uint8).reshape(-1, 4).T).ravel()


def _from_bytes(planes: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(planes.reshape(4, -1).T).view("<i4").ravel()


def _lists(values: list) -> list[bytes]:
    """Lists of numbers that are given in order of first appearance, as two tables: sizes, and the numbers by bytes, a first
    appearance as 0 and all others plus 1."""
    sizes = np.fromiter(map(len, values), np.int64, len(values))
    flat = np.concatenate(values) if values and isinstance(values[0], np.ndarray) else np.fromiter((k for v in values for k in v), np.int32, int(sizes.sum()))
    seen = flat + np.int32(1)
    seen[:1] = 0
    seen[1:][flat[1:] > np.maximum.accumulate(flat)[:-1]] = 0
    return [_ipc(pa.table({"size": sizes})), _ipc(pa.table({"bytes": _by_bytes(seen)}))]


def _store(folder: str, group_bytes: int):
    """Writes the other columns and the numbered words of documents into files of about group_bytes of text; gives the units of
    each file and a row without unit for the file itself. A file is named at random, so what a repeated task emits and
    writes belongs together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() // BLOCK_PARTITIONS
        held: list[pa.Array] = []
        numbers, size = _Numbers(), 0

        def close() -> Iterator[pa.RecordBatch]:
            g = uuid.uuid4().int >> 65
            parts, units = numbers.close()
            row = pa.chunked_array(held)
            write_file(f"{folder}/{g}.rows", [_ipc(pa.table({"row": row})), *_lists(numbers.words), *_lists(parts)])
            for k in range(0, len(units) + 1, 50_000):
                some = pa.array([*units[k : k + 50_000], *([None] if k + 50_000 > len(units) else [])], pa.string())
                number = np.arange(k, k + len(some), dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(some), g)), pa.array(np.full(len(some), block, np.int32)), pa.array(number), some], ["g", "block", "k", "unit"]
                )

        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
            at = 0
            while at < batch.num_rows:
                # rows up to the one that fills the file
                upto = min(batch.num_rows, at + int(np.searchsorted(np.cumsum(sizes[at:]), group_bytes - size)) + 1)
                held.append(batch.column("row").slice(at, upto - at))
                numbers.add(batch.column("text").slice(at, upto - at).to_pylist())
                size += int(sizes[at:upto].sum())
                at = upto
                if size >= group_bytes:
                    yield from close()
                    held, numbers, size = [], _Numbers(), 0
        if held:
            yield from close()

    return run


def _read(path: str) -> tuple[pa.Table, _Lists, _Lists]:
    """The rows of a file, the words of each and the units of each word."""
    fs, inner = filesystem(path)
    with fs.open_input_file(inner) as source:
        raw = pa.BufferReader(source.read())
    rows, *tables = [pa.ipc.open_stream(raw).read_all() for _ in range(5)]

    def lists(sizes: pa.Table, numbers: pa.Table) -> _Lists:
        flat = _from_bytes(numbers["bytes"].to_numpy())
        first = flat == 0
        flat -= 1
        flat[first] = np.arange(np.count_nonzero(first))
        return _Lists(flat, sizes["size"].to_numpy())

    return rows.combine_chunks(), lists(*tables[:2]), lists(*tables[2:])


def _words(text: str) -> list[str]:
    """The text cut before spaces."""
    if ODD.search(text) is not None:
        return [p for p in EXACT_WORD_CUT.split(text) if p]
    parts = [" " + p for p in text.split(" ")]
    parts[0] = parts[0][1:]
    return parts if parts[0] else parts[1:]


def _units(word: str) -> list[str]:
    return [word] if word[1:].isalpha() and word[0] == " " else [p for p in EXACT_MARK_CUT.split(word) if p]


class _Lists:
    """Lists of numbers, one after the other."""

    def __init__(self, flat: np.ndarray, sizes: np.ndarray):
        self.flat, self.sizes, self.starts = flat, sizes, np.cumsum(sizes) - sizes

    def of(self, at: np.ndarray) -> np.ndarray:
        """The lists at these places, joined."""
        count = self.sizes[at]
        return self.flat[np.arange(int(count.sum())) + np.repeat(self.starts[at] - (np.cumsum(count) - count), count)]

    @property
    def ends(self) -> np.ndarray:
        return np.concatenate(([0], np.cumsum(self.sizes)))


def _packer(pack_bytes: int):
    """Packs encoded units by file: a row has the number of a file, the count of units and ids in it, and their numbers and ids."""

    def packed(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        coded = pa.Table.from_batches(held).combine_chunks()
        at, ids = (pa.concat_arrays(coded[name].chunks) for name in ("at", "ids"))
        lists = _Lists(ids.flatten().to_numpy(zero_copy_only=False), pc.fill_null(pc.list_value_length(ids), 0).to_numpy().astype(np.int64))
        places = at.flatten()
        g, k = (places.field(name).to_numpy(zero_copy_only=False) for name in ("g", "k"))
        unit = np.repeat(np.arange(len(at)), pc.list_value_length(at).to_numpy())
        order = np.lexsort((k, g))
        g, k, unit = g[order], k[order], unit[order]
        valid = ids.is_valid().to_numpy(zero_copy_only=False)
        rows = []
        starts = np.flatnonzero(np.concatenate(([True], g[1:] != g[:-1])))
        for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(g)], strict=True):
            # the row without ids stands for the file
            own = valid[unit[a:b]]
            units, numbers = unit[a:b][own], k[a:b][own]
            flat = lists.of(units)
            body = b"".join(_by_bytes(x).tobytes() for x in (np.diff(numbers, prepend=0), lists.sizes[units], flat))
            rows.append((int(g[a]), len(units), len(flat), pa.Codec("zstd", 3).compress(body, asbytes=True)))
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.binary())
        columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays(columns, ["g", "n", "m", "body"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                size += batch.nbytes
            if size >= pack_bytes:
                yield packed(held)
                held, size = [], 0
        if held:
            yield packed(held)

    return run


def _unpacked(coded: pa.Table) -> tuple[np.ndarray, _Lists]:
    """The numbers of a file's units, and the ids of each."""
    found = []
    for n, m, body in zip(coded["n"].to_pylist(), coded["m"].to_pylist(), coded["body"].to_pylist(), strict=True):
        raw = np.frombuffer(pa.Codec("zstd").decompress(body, 4 * (2 * n + m)), np.uint8)
        steps, sizes, ids = (_from_bytes(x) for x in np.split(raw, [4 * n, 8 * n]))
        found.append((np.cumsum(steps), sizes, ids))
    k, sizes, flat = (np.concatenate(x) for x in zip(*found, strict=True))
    return k, _Lists(flat, sizes.astype(np.int64))


def _assembler(folder: str):
    def run(coded: pa.Table) -> pa.Table:
        """The packed units of a file."""
        k, lists = _unpacked(coded)
        # place[k]: where the ids of unit k came
        place = np.argsort(k)
        docs, found, parts = _read(f"{folder}/{coded['g'][0].as_py()}.rows")
        # the ids of each word
        units = place[parts.flat]
        ends = np.concatenate(([0], np.cumsum(lists.sizes[units])))[parts.ends]
        words = _Lists(lists.of(units), np.diff(ends))
        flat_words = found.flat
        rows = [words.of(flat_words[k : k + PASS_WORDS]) for k in range(0, len(flat_words), PASS_WORDS)]
        values = pa.array(np.concatenate(rows) if rows else np.zeros(0, np.int32))
        del rows
        upto = np.zeros(len(flat_words) + 1, np.int64)
        np.cumsum(words.sizes.astype(np.int32)[flat_words], out=upto[1:])
        offsets = upto[found.ends]
        kind, place_type = (pa.LargeListArray, np.int64) if offsets[-1] >= 1 << 31 else (pa.ListArray, np.int32)
        out = kind.from_arrays(pa.array(offsets.astype(place_type)), values)
        return pa.table({"row": docs["row"].cast(_nullable(docs.schema.field("row").type)), "ids": out})

    return run


def short_plans(spark) -> None:
    """Texts of plans with literal tables run to tens of megabytes and are written again at each change of a plan; unless the
    session has set a limit itself, it gets one."""
    name = "spark.sql.maxPlanStringLength"
    if int(spark.conf.get(name, str((1 << 31) - 16))) >= (1 << 31) - 16:
        spark.conf.set(name, str(1 << 16))


def encode(docs: DataFrame, ranks: Ranks, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """docs without `text`, with a last column `ids` (array<int>)."""
    spark = docs.sparkSession
    ship(spark)
    short_plans(spark)
    folder = f"{new_folder(spark, 'bpe')}/documents"
    names = [n for n in docs.columns if n not in ("text", "ids")]
    rows = docs.select(F.struct(*[F.col(f"`{n}`") for n in names]).alias("row"), F.col("text").cast("string").alias("text"))
    own = rows.mapInArrow(_store(folder, group_bytes), "g long, block int, k int, unit string")
    # the units of a file are distinct, and a block has few files, so the list of a unit in a block is short
    units = own.repartition("unit", "block").groupBy("unit", "block").agg(F.collect_list(F.struct("g", "k")).alias("at"))
    coded = encode_units(units, "unit", ranks).select("at", "ids").mapInArrow(_packer(PACK_BYTES), "g long, n int, m long, body binary")
    kind = rows.schema["row"].dataType.simpleString()
    out = coded.groupBy("g").applyInArrow(_assembler(folder), f"row {kind}, ids array<int>")
    return out.select(*[F.col("row")[n].alias(n) for n in names], "ids")


def decode(ids: Column, ranks: Ranks) -> Column:
    """The bytes of ids."""
    joined = lambda p: F.unhex(F.array_join(F.transform(ids, lambda i: F.get(p, i)), ""))
    return _let(ranks.piece_literal(), joined)


def id_text(ids: Column) -> Column:
    """Decimal ids joined by commas."""
    return F.array_join(ids.cast("array<string>"), ",")
