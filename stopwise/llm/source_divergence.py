"""How far the word use of the sources of a language lies apart, by a cube of (source block, source block, term block) cells.

Terms are runs of letters and characters above ASCII, with A-Z in lower case. A task counts the terms of its texts in numpy and sends each
(language, source, term) once for every few million occurrences, so frequent terms and a hot source arrive in few rows. A language keeps the terms that stand
in at least `min_docs` of its rows of documents.

A source is a smoothed distribution over the kept terms of its language, in integer parts of a thousand million. Two sources differ by the sum of absolute
differences. Sources are dealt into blocks by a hash, and so are terms. Each entry is sent to the cells of its source block with every
other source block, within its term block; a cell fills two small matrices and gives the partial sums of its pairs of sources with the number of terms
that it saw; sums along the term axis give the pairs, and the terms that neither source has are added by their number. A cell holds about
2 * `SOURCES` times `TERMS` values, whatever the size of the corpus.

Defined cases: null text, language and source are empty texts. Every row counts as a document, repeated ones and those without an id too. A source without terms is a group of
its own with only smoothed terms; a language that keeps no term has differences of 0. Ties are ranked by the item in UTF-8 order. A long text is one numpy
pass of its own. Other columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stopwise.llm import textarrays as ta
from stopwise.llm.shared import cut, ship

MIN_DOCS = 30
TOP_TERMS = 50
SMOOTHING = 5
SCALE_STEPS, STEP = 3, 1000
#: Sources and terms of a block of the cube.
SOURCES = 32
TERMS = 4096
#: Rows that a task gathers before it adds them up, and sums that it holds before it sends them.
GATHERED = 2_000_000
HELD = 500_000
#: Shares of the terms that are added up one after the other.
SHARES = 16

COUNTS = pa.schema([("lang", pa.large_string()), ("source", pa.large_string()), ("term", pa.large_string()), ("n", pa.int64()), ("docs", pa.int64())])
#: The same in a task, with a number for language and source.
PASSED = pa.schema([("group", pa.int32()), ("term", pa.large_string()), ("n", pa.int64()), ("docs", pa.int64())])


def parts(count, total):
    """1 + floor(10^9 * count / total), exact: long division in steps of a thousand. Takes numpy arrays; count <= total."""
    out, rest = count // total, count % total
    for _ in range(SCALE_STEPS):
        rest = rest * STEP
        out, rest = out * STEP + rest // total, rest % total
    return out + 1


def parts_column(count: Column, total: Column) -> Column:
    """The same for columns."""
    div = lambda a, b: F.call_function("div", a, b)
    out, rest = div(count, total), F.pmod(count, total)
    for _ in range(SCALE_STEPS):
        rest = rest * F.lit(STEP)
        out, rest = out * F.lit(STEP) + div(rest, total), F.pmod(rest, total)
    return out + 1


def _terms(texts: ta.Texts) -> tuple[np.ndarray, pa.DictionaryArray]:
    """(text, term) of every occurrence."""
    low = ta.LOWER[texts.data]
    found = ta.words(ta.Texts(low, texts.offsets), ta.LETTER)
    letters = low[ta.LETTER[low]]
    ends = np.concatenate(([0], np.cumsum(found.ends - found.starts)))
    array = pa.LargeStringArray.from_buffers(len(found.starts), pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(letters))
    return found.text_of(), array.dictionary_encode()


def _numbers(lang: pa.Array, source: pa.Array, known: dict[tuple[str, str], int]) -> np.ndarray:
    """The number of each row's (language, source); new ones are added to known."""
    pairs = zip(lang.to_pylist(), source.to_pylist(), strict=True)
    return np.fromiter((known.setdefault(p, len(known)) for p in pairs), np.int64, len(lang))


def _pass(texts: ta.Texts, group: np.ndarray) -> pa.Table:
    """Counts and documents of each (group, term) of some texts; group: the number of each text's language and source."""
    text_of, terms = _terms(texts)
    code, width = terms.indices.to_numpy().astype(np.int64), max(1, len(terms.dictionary))
    pairs, n = np.unique(text_of * width + code, return_counts=True)
    keys, inverse = np.unique(group[pairs // width] * width + pairs % width, return_inverse=True)
    return pa.table(
        [
            (keys // width).astype(np.int32),
            terms.dictionary.take(pa.array(keys % width)),
            np.bincount(inverse, n, len(keys)).astype(np.int64),
            np.bincount(inverse, minlength=len(keys)),
        ],
        schema=PASSED,
    )


def _share(terms: pa.ChunkedArray) -> np.ndarray:
    """The share of the terms that each belongs to, by its length, first and last byte."""
    chunks = []
    for part in terms.chunks:
        found = ta.from_arrow(part)
        starts, ends = found.offsets[:-1], found.offsets[1:]
        first, last = (found.data[at].astype(np.int64) for at in (starts, ends - 1))
        chunks.append((((ends - starts) * 31 + first) * 31 + last) % SHARES)
    return np.concatenate(chunks) if chunks else np.zeros(0, np.int64)


def _add(tables: list[pa.Table]) -> pa.Table:
    """Sums by group and term; one share of the terms after the other, since the table of all keys at once is the largest thing in a task."""
    share_of = [_share(t["term"]) for t in tables]
    sums = []
    for k in range(SHARES):
        part = pa.concat_tables([t.filter(pa.array(own == k)) for t, own in zip(tables, share_of, strict=True)])
        sums.append(part.group_by(["group", "term"], use_threads=False).aggregate([("n", "sum"), ("docs", "sum")]))
    return pa.concat_tables(sums).select(["group", "term", "n_sum", "docs_sum"]).rename_columns(PASSED.names)


def _sent(sums: pa.Table, known: dict[tuple[str, str], int], marked: int) -> Iterator[pa.RecordBatch]:
    """The sums with the names of their groups, and a row without term for each group from number `marked` on."""
    langs, sources = (pa.array([k[i] for k in known], pa.large_string()) for i in (0, 1))
    for part in sums.to_batches(1 << 16):
        yield pa.RecordBatch.from_arrays([langs.take(part["group"]), sources.take(part["group"]), *part.columns[1:]], schema=COUNTS)
    fresh = len(known) - marked
    zeros = pa.array(np.zeros(fresh, np.int64))
    yield pa.RecordBatch.from_arrays([langs[marked:], sources[marked:], pa.nulls(fresh, pa.large_string()), zeros, zeros], schema=COUNTS)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[tuple[str, str], int] = {}
    tables, rows, marked = [], 0, 0
    for batch in batches:
        group = _numbers(batch.column(0), batch.column(1), known)
        for first, last, texts in ta.passes(ta.from_arrow(batch.column(2))):
            tables.append(_pass(texts, group[first:last]))
            rows += tables[-1].num_rows
            if rows >= GATHERED:
                tables = [_add(tables)]
                rows = tables[0].num_rows
                if rows >= HELD:
                    yield from _sent(tables.pop(), known, marked)
                    rows, marked = 0, len(known)
    if known:
        yield from _sent(_add([*tables, PASSED.empty_table()]), known, marked)
    # what one task has freed would else stay with the worker while the next one runs
    del tables
    pa.default_memory_pool().release_unused()


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n, docs: occurrences and rows with an occurrence; a row with null term for each (lang, source)."""
    ship(docs.sparkSession)
    plain = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    counted = plain.mapInArrow(_count, "lang string, source string, term string, n long, docs long")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _cell(pdf: pd.DataFrame) -> pd.DataFrame:
    """Partial sums of the pairs of sources of two blocks over one block of terms."""
    meta = pdf[pdf["term"].isna()].sort_values("source")
    entries = pdf[pdf["term"].notna()]
    i, j, lang = int(pdf["i"].iloc[0]), int(pdf["j"].iloc[0]), pdf["lang"].iloc[0]
    names = meta["source"].to_numpy(object)
    total = meta["total"].to_numpy(np.int64)
    none = parts(np.full(len(meta), SMOOTHING), np.maximum(total, 1)) if len(meta) and total.min() > 0 else np.zeros(len(meta), np.int64)
    term, terms = pd.factorize(entries["term"])
    row = pd.Index(names).get_indexer(entries["source"])
    share = np.repeat(none[:, None], len(terms), axis=1)
    share[row, term] = parts(entries["n"].to_numpy(np.int64) + SMOOTHING, total[row])
    block = meta["block"].to_numpy()
    left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
    out = []
    for k, g in enumerate(left):
        others = right[k + 1 :] if i == j else right
        out.append(
            pd.DataFrame(
                {
                    "lang": lang,
                    "one": names[g],
                    "two": names[others],
                    "part": np.abs(share[g] - share[others]).sum(axis=1),
                    "seen": np.int64(len(terms)),
                    "apart": np.abs(none[g] - none[others]),
                }
            )
        )
    columns = {"lang": str, "one": str, "two": str, "part": np.int64, "seen": np.int64, "apart": np.int64}
    return pd.concat(out) if out else pd.DataFrame({c: pd.Series(dtype=t) for c, t in columns.items()})


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """lang, source, part, item, value, rank: differences to each other source (`pair`), terms most over the language's share (`term`)."""
    counts = cut(term_counts(docs))
    groups = counts.where("term is null").select("lang", "source")
    kept = cut(
        counts.where("term is not null").groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("everywhere")).where(F.col("docs") >= min_docs)
    )
    langs = kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("everywhere").alias("words"))
    entries = cut(counts.where("term is not null").join(kept.select("lang", "term", "everywhere"), ["lang", "term"]))
    sizes = entries.groupBy("lang", "source").agg(F.sum("n").alias("words_here"))
    blocks = groups.groupBy("lang").agg(F.ceil(F.count("*") / SOURCES).cast("int").alias("blocks"))
    whole = groups.join(blocks, "lang").join(langs, "lang", "left").join(sizes, ["lang", "source"], "left")
    meta = cut(
        whole.select(
            "lang",
            "source",
            "blocks",
            F.coalesce("terms", F.lit(0)).alias("terms"),
            (F.coalesce("words_here", F.lit(0)) + F.coalesce("terms", F.lit(0)) * SMOOTHING).alias("total"),
            (F.coalesce("words", F.lit(0)) + F.coalesce("terms", F.lit(0)) * SMOOTHING).alias("whole"),
            F.pmod(F.xxhash64("source"), F.col("blocks")).cast("int").alias("block"),
            F.greatest(F.lit(1), F.ceil(F.coalesce("terms", F.lit(0)) / TERMS)).cast("int").alias("slices"),
        )
    )
    named = entries.join(meta, ["lang", "source"])
    return _pairs(named, meta).unionByName(_over_represented(named, top))


def _pairs(named: DataFrame, meta: DataFrame) -> DataFrame:
    slot = F.pmod(F.xxhash64(F.lit(3), F.col("term")), F.col("slices")).cast("int")
    columns = ["lang", "source", "term", "n", "total", "block", "slice", "blocks"]
    filled = named.withColumn("slice", slot).select(columns)
    marks = meta.withColumns({"slice": F.explode(F.sequence(F.lit(0), F.col("slices") - 1)), "term": F.lit(None).cast("string"), "n": F.lit(0).cast("long")}).select(columns)
    sent = filled.unionByName(marks).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cells = sent.select("lang", "source", "term", "n", "total", "block", "slice", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    found = cells.groupBy("lang", "i", "j", "slice").applyInPandas(_cell, "lang string, one string, two string, part long, seen long, apart long")
    sums = found.groupBy("lang", "one", "two").agg(F.sum("part").alias("part"), F.sum("seen").alias("seen"), F.max("apart").alias("apart"))
    terms = meta.select("lang", "source", "terms").withColumnRenamed("source", "one")
    value = F.col("part") + (F.col("terms") - F.col("seen")) * F.col("apart")
    both = F.explode(F.array(F.struct(F.col("one").alias("source"), F.col("two").alias("item")), F.struct(F.col("two").alias("source"), F.col("one").alias("item"))))
    pairs = sums.join(terms, ["lang", "one"]).select("lang", value.alias("value"), both.alias("e")).select("lang", "e.source", F.lit("pair").alias("part"), "e.item", "value")
    return pairs.withColumn("rank", F.row_number().over(_ranking()))


def _ranking():
    return Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")


def _over_represented(named: DataFrame, top: int) -> DataFrame:
    here = parts_column(F.col("n") + SMOOTHING, F.col("total"))
    everywhere = parts_column(F.col("everywhere") + SMOOTHING, F.col("whole"))
    over = named.where("n > 0").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (here - everywhere).alias("value")).where("value > 0")
    return over.withColumn("rank", F.row_number().over(_ranking())).where(F.col("rank") <= top)
