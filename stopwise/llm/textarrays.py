"""Words, hashes and character runs of many texts at once, as numpy arrays over one UTF-8 buffer.

A batch of texts is a `Texts`: the bytes of all texts and the offset of each text. Null texts are
empty. All functions give the same values for a text whatever batch it stands in.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that one numpy pass takes; a longer text is a pass of its own.
PASS_BYTES = 1 << 21

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


@dataclass
class Texts:
    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers (splitmix64)."""
    x = x + _U(0x9E3779B97F4A7C15)
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def from_arrow(column: pa.Array) -> Texts:
    column = pc.fill_null(column, "") if column.null_count else column
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return Texts(np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64))
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return Texts(raw, at - at[0])


def passes(texts: Texts, most: int = PASS_BYTES) -> Iterator[tuple[int, int, Texts]]:
    """Runs of texts with at most `most` bytes together, or one longer text."""
    first, n = 0, len(texts)
    while first < n:
        last = int(np.searchsorted(texts.offsets, texts.offsets[first] + most, side="right")) - 1
        last = min(n, max(first + 1, last))
        at = texts.offsets[first : last + 1]
        yield first, last, Texts(texts.data[at[0] : at[-1]], at - at[0])
        first = last


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


#: Bytes of a word once A-Z are lower case: digits, letters, and all of every character above ASCII.
WORD = byte_class((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))
LETTER = byte_class((0x61, 0x7A), (0x80, 0xFF))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


@dataclass
class Words:
    """starts, ends: byte places; first: for each text, the number of its first word, and the end."""

    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def words(texts: Texts, table: np.ndarray = WORD) -> Words:
    """Longest runs of bytes of the class; a run never crosses two texts."""
    inside = table[texts.data]
    n = len(inside)
    if n == 0:
        return Words(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(texts.offsets), np.int64))
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = inside[:-1]
    cut = texts.offsets[texts.offsets < n]
    before[cut] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = inside[1:]
    after[texts.offsets[texts.offsets > 0] - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return Words(starts, ends, np.searchsorted(starts, texts.offsets))


_powers: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "up" not in _powers or len(_powers["up"]) < n + 1:
        size = max(n, PASS_BYTES) + 1
        for name, base in (("up", _BASE), ("down", _BASE_INVERSE)):
            steps = np.full(size, _U(base), _U)
            steps[0] = 1
            _powers[name] = np.cumprod(steps)
    return _powers["up"], _powers["down"]


_BYTE_VALUES = mix(np.arange(256, dtype=_U))


def running_hash(data: np.ndarray) -> np.ndarray:
    """Sums of byte values times powers of a base: the hash of any run follows from two of them."""
    up, _ = _power_tables(len(data))
    out = np.zeros(len(data) + 1, _U)
    np.cumsum(_BYTE_VALUES[data] * up[: len(data)], out=out[1:])
    return out


def run_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of the bytes from starts to ends, independent of their place."""
    _, down = _power_tables(len(sums) - 1)
    return mix((sums[ends] - sums[starts]) * down[starts])


def one_hash(word: bytes) -> int:
    """The value that run_hash gives for these bytes."""
    data = np.frombuffer(word, np.uint8)
    return int(run_hash(running_hash(data), np.zeros(1, np.int64), np.full(1, len(data)))[0])


def shingles(hashes: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of each run of `size` words; a text of fewer words, but not none, is one run."""
    counts = np.diff(first)
    text_of = np.repeat(np.arange(len(counts)), counts)
    value = np.zeros(len(hashes), _U)
    place = np.arange(len(hashes)) - first[:-1][text_of]
    short = (counts < size)[text_of]
    for k in range(size):
        upto = len(hashes) - k
        if upto <= 0:
            break
        part = mix(hashes[k:] + _U(k + 1))
        inside = place[:upto] + k < counts[text_of[:upto]]
        value[:upto] += np.where(inside, part, _U(0)) * _U(2 * k + 1)
    keep = np.where(short, place == 0, place + size <= counts[text_of])
    return text_of[keep], mix(value[keep])
