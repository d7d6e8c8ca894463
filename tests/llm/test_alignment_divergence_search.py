"""Token alignment, source divergence and exact search against brute-force versions on odd and real rows."""

import hashlib
import math
import os
import re
import subprocess
import sys
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from stopwise.llm import maxscore_search, source_divergence, token_alignment

SF = "/root/testdata/sf0.001"
A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    (None, None),
    (None, "no id"),
    (-1, None),
    (-2, ""),
    (-3, "   "),
    (-4, " a  b \n c d 　 x\n\n  y  "),
    (-5, "I'll 12345 ½ é é 😀😀 <|endoftext|> <s> </s> <unk> <0x41> \x1c z  q"),
    (-6, "中文字符 テスト  한국어"),
    (-7, "the piece mark ▁ is not a space"),
    (-8, "word " * 20_000),
    (-9, "the same words again and again"),
    (-9, "the same words again and again"),
    (-10, "unbroken" * 3_000),
    (-11, "\x00 nul \x00"),
]


def plain_alignment(texts):
    """(tokens of A, tokens of B) of a text as (id, start, end), or none."""
    a, b = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    letters = token_alignment.byte_letters()
    out = []
    for text in texts:
        text = text or ""
        of_a = [(k, bytes(letters[c] for c in a.id_to_token(k))) for k in a.encode(" " + text, add_special_tokens=False).ids]
        of_b = [(k, bytes([int(b.id_to_piece(k)[3:5], 16)]) if b.is_byte(k) else b.id_to_piece(k).replace("▁", " ").encode()) for k in b.encode(text)]
        want = (" " + text).encode()
        if not text or any(b"".join(x for _, x in side) != want for side in (of_a, of_b)):
            out.append(([], []))
            continue
        sides = []
        for side in (of_a, of_b):
            at, spans = 0, []
            for k, x in side:
                spans.append((k, at, at + len(x)))
                at += len(x)
            sides.append(spans)
        out.append(tuple(sides))
    return out


def plain_links(a, b):
    """Both lists are in order, so a pointer walks along the other side."""
    links, j = [], 0
    for x, start, end in a:
        while j and b[j - 1][2] > start:
            j -= 1
        while j < len(b) and b[j][2] <= start:
            j += 1
        k = j
        while k < len(b) and b[k][1] < end:
            links.append((x, b[k][0]))
            k += 1
    return links


def plain_groups(a, b):
    ends = sorted({e for *_, e in a} & {e for *_, e in b})
    parts, low = [], 0
    for end in ends:
        parts.append("|".join(",".join(str(k) for k, s, e in side if low <= s and e <= end) for side in (a, b)))
        low = end
    return parts


def test_byte_letters_are_the_whole_byte_range():
    letters = token_alignment.byte_letters()
    assert sorted(letters.values()) == list(range(256)) and letters["Ġ"] == 32 and letters["Ċ"] == 10 and letters["a"] == 97


@pytest.mark.parametrize("file_bytes", [24 << 20, 20_000])
def test_alignment_equals_brute_force(spark, monkeypatch, file_bytes):
    monkeypatch.setattr(token_alignment, "FILE_BYTES", file_bytes)
    monkeypatch.setattr(token_alignment, "PASS_BYTES", min(file_bytes // 2, 1 << 20))
    real = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").where("length(text) < 4000").collect()]
    rows = ODD + real
    plain = plain_alignment([t for _, t in rows])
    links = [plain_links(*x) for x in plain]
    corpus = Counter(p for x in links for p in x)
    highest = defaultdict(int)
    for (_, b), n in corpus.items():
        highest[b] = max(highest[b], n)
    want = []
    for (doc_id, _), (a, b), own in zip(rows, plain, links):
        parts = plain_groups(a, b) if len(a) < 2000 else None
        digest = hashlib.sha256(";".join(parts).encode()).hexdigest() if parts else ""
        want.append(
            (str(doc_id), len(a), len(b), len({e for *_, e in a} & {e for *_, e in b}), len(own), digest, sum(corpus[p] == highest[p[1]] for p in own), sum(corpus[p] for p in own))
        )
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"n": F.lit(1), "file": F.lit("x"), "pair": F.lit(3)})
    got = token_alignment.audit(docs.repartition(3), A, B).collect()
    names = ["n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]
    long = {w[1:3] for w in want if w[1] >= 2000}
    found = sorted((str(r.doc_id), *((r[n] if n != "groups_sha256" or (r.n_a, r.n_b) not in long else "") for n in names)) for r in got)
    assert found == sorted(want)
    assert sum(w[1] == 0 for w in want) < len(want) / 2


def test_groups_and_links_of_single_texts(spark):
    docs = spark.createDataFrame(ODD, "doc_id long, text string")
    got = sorted((str(r.doc_id), r.groups, sorted((x.a, x.b, x.n) for x in r.links)) for r in token_alignment.groups(docs, A, B).collect() if r.doc_id not in (-8, -10))
    plain = [(i, x) for (i, _), x in zip(ODD, plain_alignment([t for _, t in ODD])) if i not in (-8, -10)]
    assert got == sorted((str(i), ";".join(plain_groups(a, b)), sorted((*p, n) for p, n in Counter(plain_links(a, b)).items())) for i, (a, b) in plain)


def test_alignment_of_no_rows(spark):
    assert token_alignment.audit(spark.createDataFrame([], "doc_id long, text string"), A, B).count() == 0


TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def plain_divergence(rows, min_docs, top):
    words = [(lang or "", source or "", TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))) for lang, source, text in rows]
    out = []
    for lang in {x[0] for x in words}:
        docs = Counter(t for x, _, w in words if x == lang for t in set(w))
        kept = {t for t, n in docs.items() if n >= min_docs}
        counts = {s: Counter() for x, s, _ in words if x == lang}
        for x, s, w in words:
            if x == lang:
                counts[s].update(t for t in w if t in kept)
        share = lambda c: {t: 1 + 10**9 * (c[t] + 5) // (sum(c.values()) + 5 * len(kept)) for t in kept}
        p = {s: share(c) for s, c in counts.items()}
        whole = share(sum(counts.values(), Counter()))
        for s in counts:
            pairs = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode(), o) for o in counts if o != s]
            terms = [(whole[t] - p[s][t], t.encode(), t) for t in kept if counts[s][t] and p[s][t] > whole[t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out += [(lang, s, part, item, -value, rank) for rank, (value, _, item) in enumerate(found, 1)]
    return sorted(out)


def divergence_rows(rng):
    vocabulary = ["a", "b", "É", "é", "Straße", "中文", "x'y", "THE", "the", "z9z"] + [f"w{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(60)]
    rows = [(None, None, None), (None, "s", ""), ("", "", "..."), ("en", None, "The THE the"), ("xx", "lone", "rare words only")]
    for k in range(300):
        picked = rng.choice(vocabulary, rng.integers(1, 30), p=None)
        rows.append((["en", "de", None][k % 3], f"src{min(k % 50, rng.integers(0, 50))}", " ".join(picked)))
    rows += rows[-3:] + [("en", "only digits", "1 2 3"), ("en", "long", "the end " * 5000)]
    return rows


@pytest.mark.parametrize("sources, terms, held", [(32, 4096, 500_000), (3, 5, 10)])
def test_divergence_equals_brute_force(spark, monkeypatch, sources, terms, held):
    monkeypatch.setattr(source_divergence, "SOURCES", sources)
    monkeypatch.setattr(source_divergence, "TERMS", terms)
    monkeypatch.setattr(source_divergence, "HELD", held)
    monkeypatch.setattr(source_divergence, "GATHERED", held)
    rows = divergence_rows(np.random.default_rng(1))
    docs = spark.createDataFrame(rows, "lang string, source string, text string").withColumns({"term": F.lit("t"), "n": F.lit(2), "block": F.lit(1)})
    got = source_divergence.audit(docs, min_docs=10, top=7).collect()
    assert sorted(tuple(r) for r in got) == plain_divergence(rows, 10, 7)


def test_divergence_without_kept_terms_and_without_rows(spark):
    rows = [("en", "a", "one"), ("en", "b", "two"), ("en", "c", None)]
    docs = spark.createDataFrame(rows, "lang string, source string, text string")
    assert sorted(tuple(r) for r in source_divergence.audit(docs).collect()) == plain_divergence(rows, 30, 50)
    assert source_divergence.audit(docs.limit(0)).count() == 0


def many_terms(size=400_000):
    """Rows of a thousand different words and some words of other rows, from three sources, and batches of them."""
    names = [f"{k:x}".translate(str.maketrans("0123456789", "ghijklmnop")) for k in range(size)]
    rows = [("en", f"source {k % 3}", " ".join(names[k * 1000 : k * 1000 + 1000] + names[: k % 7])) for k in range(size // 1000)]
    return rows, [pa.record_batch([pa.array(c) for c in zip(*rows[k : k + 100])], names=["lang", "source", "text"]) for k in range(0, len(rows), 100)]


def peak_of_counting():
    """Bytes that Arrow held at most while a fresh process counted the terms, for each row."""
    _, batches = many_terms()
    rows = sum(out.num_rows for out in source_divergence._count(iter(batches)))
    print(pa.default_memory_pool().max_memory() / rows)


def test_counting_many_terms_is_exact_and_holds_few_bytes_a_row():
    rows, batches = many_terms()
    got = []
    for out in source_divergence._count(iter(batches)):
        got += [tuple(row.values()) for row in out.to_pylist()]
    want = Counter((lang, source, w) for lang, source, text in rows for w in text.split())
    docs = Counter((lang, source, w) for lang, source, text in rows for w in set(text.split()))
    assert sorted(x for x in got if x[2]) == sorted((*k, n, docs[k]) for k, n in want.items())
    assert sorted(x for x in got if not x[2]) == [("en", f"source {k}", None, 0, 0) for k in range(3)]
    here = os.path.dirname(os.path.abspath(__file__))
    code = f"import sys; sys.path[:0] = {[here, *sys.path]!r}; import {os.path.basename(__file__)[:-3]} as t; t.peak_of_counting()"
    assert float(subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True).stdout) < 100


def test_parts_are_exact():
    total = np.array([7, 10**12 + 39, 9_000_000_000_000_000, 3], np.int64)
    count = np.array([3, 10**12 + 38, 8_999_999_999_999_999, 3], np.int64)
    assert source_divergence.parts(count, total).tolist() == [1 + 10**9 * int(c) // int(t) for c, t in zip(count, total)]


def plain_search(rows, marked, top=5):
    def scaled(v):
        if v is None or any(x is None or not math.isfinite(x) for x in v):
            return None
        return [min(max(math.floor(256 * x) if math.isfinite(256 * x) else math.copysign(2**70, x), -(2**63)), 2**63 - 1) for x in v]

    vectors = [(i, scaled(v)) for i, v in rows]
    out = []
    for q, v in {(i, tuple(v)) for i, v in vectors if v is not None and i is not None and marked(i)}:
        found = [(-min(max(sum(int(x) * int(y) for x, y in zip(v, w)), -(2**63)), 2**63 - 1), i is None, i or 0) for i, w in vectors if w is not None and i != q]
        out += [(q, rank, None if null else i, -s) for rank, (s, null, i) in enumerate(sorted(found)[:top], 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("components", [1 << 21, 300])
def test_search_equals_brute_force(spark, monkeypatch, components):
    monkeypatch.setattr(maxscore_search, "SHARD_COMPONENTS", components)
    monkeypatch.setattr(maxscore_search, "BLOCK_COMPONENTS", components)
    rng = np.random.default_rng(4)
    near = rng.normal(size=8)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(120)] + [(200 + i, (near + 0.1 * rng.normal(size=8)).tolist()) for i in range(60)]
    rows += [(None, near.tolist()), (300, None), (310, [1.0, None]), (320, [float("nan")] * 8), (330, [float("inf")]), (340, []), (350, [0.0] * 8)]
    rows += [(360, near.tolist()), (360, near.tolist()), (360, (-near).tolist()), (370, [1.5, -2.5]), (380, rng.normal(size=12).tolist()), (-20, [-x for x in near])]
    rows = [(i, v if v is None else [x if x is None else float(x) for x in v]) for i, v in rows]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({"v": F.lit(1), "block": F.lit(2), "label": F.lit(3)})
    got = maxscore_search.search(frame, F.col("vec_id") % 10 == 0).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain_search(rows, lambda i: i % 10 == 0)


def test_search_with_huge_components_and_few_rows(spark):
    rows = [(0, [1e300, -1.0, 3.0]), (1, [1e300, 5.0, 1.0]), (2, [-1e300, 2.0, 1e12]), (50, [1e12, 1e12, -1e12])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = maxscore_search.search(frame, F.col("vec_id") % 50 == 0).collect()
    assert sorted((tuple(r) for r in got), key=str) == plain_search(rows, lambda i: i % 50 == 0)
    assert maxscore_search.search(frame.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_search_probes_less_than_everything():
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(40, 32))
    values = np.floor(256 * (centres[np.arange(8000) % 40] + 0.1 * rng.normal(size=(8000, 32)))).astype(np.int64)
    shard = maxscore_search.Shard.load(maxscore_search.Shard(np.arange(8000), np.ones(8000, bool), np.full(8000, 32), values.ravel()).dump())
    queries = [maxscore_search.Query(k, values[k], 5) for k in range(0, 8000, 400)]
    shard.search(queries)
    for q in queries:
        scores = values @ q.vector
        scores[q.own] = -(2**60)
        order = np.lexsort((np.arange(8000), -scores))[:5]
        assert q.best == [(int(scores[k]), int(k)) for k in order]
    assert sum(q.probed for q in queries) < 0.7 * len(queries) * 8000 * 32 / maxscore_search.PROBED
