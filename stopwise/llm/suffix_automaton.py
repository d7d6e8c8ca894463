"""Benchmark decontamination with a generalised suffix automaton of the test items.

Texts and items are lower-cased in A-Z; words are runs of characters other than ASCII punctuation,
white space and controls. All items go into one automaton over words. A document's words are streamed
through it: after each word the automaton's state and the matched length say how long the longest suffix
is that some item contains. Where the length reaches the window (10 words, or all words of a shorter
item), the words of the window are hit, and the items whose windows the suffix holds are noted.

Words that no item has end every match, so the stream is cut there at once with arrays and only runs
of known words pass through the automaton.

The items are read by the driver in portions of at most `portion_bytes`, each a broadcast automaton of
its own; documents pass through all of them in one go per portion, so a large benchmark costs passes,
not memory.

Defined cases: null or wordless texts have no words, no hits and are clean; null or wordless items have
no window; repeated items count by id; two items with one id are both that id. Empty benchmark: nothing is hit. Other columns
pass through `clean` unread.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopwise.llm import textarrays as ta
from stopwise.llm.shared import ship

WINDOW = 10
PORTION_BYTES = 8 << 20
#: Documents of which this share of words or more is hit are dropped whole by `clean`.
MAX_COVERAGE = 0.5


class Automaton:
    """Generalised suffix automaton over word numbers; windows of items are noted on their end state."""

    def __init__(self, items: list[tuple[int, list[int]]], window: int):
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        for _, words in items:
            state = 0
            for word in words:
                state = self._extend(state, word)
        #: state -> {window length: items}: windows that end where this state is the whole window's state
        self.windows: dict[int, dict[int, set[int]]] = {}
        for item, words in items:
            size = min(window, len(words))
            state, matched = 0, 0
            for place, word in enumerate(words):
                state, matched = self.step(state, matched, word)
                if place + 1 >= size > 0:
                    at = self.holder(state, size)
                    self.windows.setdefault(at, {}).setdefault(size, set()).add(item)
        #: For each state the states on its chain of suffixes that end a window, itself included.
        self.ending: list[tuple] = [()] * len(self.link)
        for state in sorted(range(len(self.link)), key=self.length.__getitem__):
            above = self.ending[self.link[state]] if state else ()
            own = self.windows.get(state)
            mine = tuple(sorted((n, tuple(sorted(i))) for n, i in own.items())) if own else ()
            self.ending[state] = mine[::-1] + above if mine else above

    def _extend(self, last: int, word: int) -> int:
        known = self.next[last].get(word)
        if known is not None:
            if self.length[known] == self.length[last] + 1:
                return known
            return self._clone(last, word, known)
        new = self._state(self.length[last] + 1)
        at = last
        while at >= 0 and word not in self.next[at]:
            self.next[at][word] = new
            at = self.link[at]
        if at < 0:
            self.link[new] = 0
        else:
            target = self.next[at][word]
            exact = self.length[target] == self.length[at] + 1
            self.link[new] = target if exact else self._clone(at, word, target)
        return new

    def _state(self, length: int) -> int:
        self.next.append({})
        self.link.append(0)
        self.length.append(length)
        return len(self.link) - 1

    def _clone(self, at: int, word: int, target: int) -> int:
        copy = self._state(self.length[at] + 1)
        self.next[copy] = dict(self.next[target])
        self.link[copy] = self.link[target]
        self.link[target] = copy
        while at >= 0 and self.next[at].get(word) == target:
            self.next[at][word] = copy
            at = self.link[at]
        return copy

    def step(self, state: int, matched: int, word: int) -> tuple[int, int]:
        while state and word not in self.next[state]:
            state = self.link[state]
            matched = self.length[state]
        if word in self.next[state]:
            return self.next[state][word], matched + 1
        return 0, 0

    def holder(self, state: int, size: int) -> int:
        """The state of the suffix of this size."""
        while state and self.length[self.link[state]] >= size:
            state = self.link[state]
        return state

    def scan(self, words: list[int]) -> tuple[list[tuple[int, int]], set[int]]:
        """Hit windows as (start, end) places, and the items whose windows occur."""
        state = matched = 0
        spans, items = [], set()
        transitions, ending, length, link = self.next, self.ending, self.length, self.link
        for place, word in enumerate(words):
            target = transitions[state].get(word)
            while target is None and state:
                state = link[state]
                matched = length[state]
                target = transitions[state].get(word)
            if target is None:
                continue
            state, matched = target, matched + 1
            widest = 0
            for size, found in ending[state]:
                if size <= matched:
                    widest = max(widest, size)
                    items.update(found)
            if widest:
                spans.append((place + 1 - widest, place + 1))
        return spans, items


def tokens(text: str | None) -> list[bytes]:
    """Words of one text."""
    data = np.frombuffer((text or "").encode(), np.uint8)
    low = ta.LOWER[data]
    found = ta.words(ta.Texts(low, np.array([0, len(low)])))
    raw = low.tobytes()
    return [raw[a:b] for a, b in zip(found.starts, found.ends, strict=True)]


def build(items: list[tuple[int, str | None]], window: int = WINDOW) -> tuple[Automaton, np.ndarray, int]:
    """Automaton, sorted hashes of the known words (a word's number is its place), shortest window."""
    split = [(item, tokens(text)) for item, text in items]
    hashes = {w: ta.one_hash(w) for w in {w for _, words in split for w in words}}
    known = np.array(sorted(set(hashes.values())), np.uint64)
    number = {w: int(np.searchsorted(known, np.uint64(h))) for w, h in hashes.items()}
    coded = [(item, [number[w] for w in words]) for item, words in split if words]
    shortest = min((min(window, len(words)) for _, words in coded), default=window)
    return Automaton(coded, window), known, shortest


def _pass(shared, with_text: bool):
    """Adds n_words, hit spans in words and bytes, and items of one portion to what earlier portions found."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, known, shortest = shared.value
        for batch in batches:
            for first, last, texts in ta.passes(ta.from_arrow(batch.column("text"))):
                part = batch.slice(first, last - first)
                low = ta.LOWER[texts.data]
                found = ta.words(ta.Texts(low, texts.offsets))
                spans: list[list] = [[] for _ in range(len(texts))]
                items: list[set] = [set() for _ in range(len(texts))]
                if len(known) and len(found.starts):
                    hashes = ta.run_hash(ta.running_hash(low), found.starts, found.ends)
                    at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
                    text_of = found.text_of()
                    good = known[at] == hashes
                    new = good.copy()
                    new[1:] &= ~(good[:-1] & (text_of[1:] == text_of[:-1]))
                    starts = np.flatnonzero(new)
                    stop = good.copy()
                    stop[:-1] &= ~(good[1:] & (text_of[1:] == text_of[:-1]))
                    ends = np.flatnonzero(stop) + 1
                    long = ends - starts >= shortest
                    for a, b in zip(starts[long].tolist(), ends[long].tolist(), strict=True):
                        hit, which = automaton.scan(at[a:b].tolist())
                        if hit:
                            text = int(text_of[a])
                            offset = a - int(found.first[text])
                            spans[text] += [(s + offset, e + offset) for s, e in hit]
                            items[text] |= which
                before = part.column("spans").to_pylist()
                named = part.column("items").to_pylist()
                out_spans, out_items = [], []
                for k in range(len(texts)):
                    base, start = int(found.first[k]), int(texts.offsets[k])
                    merged: list[list[int]] = []
                    for s, e in sorted([(x["word"], x["word_end"]) for x in before[k]] + spans[k]):
                        if merged and s <= merged[-1][1]:
                            merged[-1][1] = max(merged[-1][1], e)
                        else:
                            merged.append([s, e])
                    out_spans.append(
                        [
                            {"word": s, "word_end": e, "byte": int(found.starts[base + s]) - start, "byte_end": int(found.ends[base + e - 1]) - start}
                            for s, e in merged
                        ]
                    )
                    out_items.append(sorted(set(named[k]) | items[k]))
                columns = [part.column("doc_id"), part.column("text")]
                columns += [
                    pa.array(np.diff(found.first)),
                    pa.array(out_spans, SPANS),
                    pa.array(out_items, pa.list_(pa.string())),
                ]
                names = ["doc_id", "text", "n_words", "spans", "items"]
                if not with_text:
                    columns, names = columns[:1] + columns[2:], names[:1] + names[2:]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


SPANS = pa.list_(pa.struct([(n, pa.int64()) for n in ("word", "word_end", "byte", "byte_end")]))
_FOUND = "n_words long, spans array<struct<word:long,word_end:long,byte:long,byte_end:long>>, items array<string>"


def find(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    portion_bytes: int = PORTION_BYTES,
    keep_text: bool = False,
) -> DataFrame:
    """Per row of docs: doc_id, (text,) n_words, spans (merged, in words and bytes of the text), items (ids as
    strings, sorted)."""
    spark = docs.sparkSession
    ship(spark)
    items = benchmark.select(F.col("item_id").cast("string"), F.col("text").cast("string")).where(
        "item_id is not null and text is not null"
    )
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    portions = max(1, math.ceil(total / portion_bytes))
    out = docs.select("doc_id", F.col("text").cast("string").alias("text")).withColumns(
        {"spans": F.expr("cast(array() as array<struct<word:long,word_end:long,byte:long,byte_end:long>>)"), "items": F.expr("cast(array() as array<string>)")}
    )
    id_type = out.schema["doc_id"].dataType.simpleString()
    for k in range(portions):
        own = items.where(F.pmod(F.xxhash64("item_id"), F.lit(portions)) == k).toLocalIterator()
        shared = spark.sparkContext.broadcast(build([(r["item_id"], r["text"]) for r in own], window))
        last = k == portions - 1
        with_text = keep_text or not last
        out = out.mapInArrow(_pass(shared, with_text), f"doc_id {id_type}, {'text string, ' * with_text}{_FOUND}")
        if not last:
            out = out.drop("n_words")
    return out


def hit_words() -> F.Column:
    """Number of words inside the spans."""
    return F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["word_end"] - s["word"])


def clean(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    max_coverage: float = MAX_COVERAGE,
    portion_bytes: int = PORTION_BYTES,
) -> DataFrame:
    """docs without contaminated passages: spans are cut out of the text (a space takes their place); a document
    whose hit words reach `max_coverage` of its words is dropped. Clean documents stay as they are."""
    names = docs.columns
    packed = docs.select(F.struct(*[F.col(f"`{n}`") for n in names]).alias("doc_id"), "text")
    found = find(packed, benchmark, window, portion_bytes, keep_text=True).withColumn("n_hit", hit_words())
    raw = F.col("text").cast("binary")
    edges = F.concat(
        F.array(F.lit(0).cast("long")),
        F.flatten(F.transform("spans", lambda s: F.array(s["byte"], s["byte_end"]))),
        F.array(F.octet_length("text").cast("long")),
    )
    found = found.withColumn("edges", edges)
    kept = F.array_join(
        F.transform(
            F.sequence(F.lit(0), F.size("spans")),
            lambda i: F.decode(
                F.substring(raw, (F.element_at("edges", 2 * i + 1) + 1).cast("int"), (F.element_at("edges", 2 * i + 2) - F.element_at("edges", 2 * i + 1)).cast("int")),
                "UTF-8",
            ),
        ),
        " ",
    )
    return (
        found.where((F.col("n_hit") == 0) | (F.col("n_hit") < F.col("n_words") * max_coverage))
        .withColumn("cleaned", F.when(F.col("n_hit") == 0, F.col("text")).otherwise(kept))
        .select(*[F.col("cleaned").alias("text") if n == "text" else F.col("doc_id")[n].alias(n) for n in names])
    )
