"""The training-data operators on small hand-made tables: brute-force versions, round trips and odd rows."""

import itertools
import re
import unicodedata
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import pytest
import tiktoken
from pyspark.sql import functions as F

from stopwise.llm import (
    bag_minhash,
    byte_bpe,
    capture_index,
    crf_language,
    hnsw_links,
    jump_shards,
    license_digest,
    shared,
    suffix_automaton,
    textarrays,
    vote_quality,
    wavelet_store,
)
from stopwise.llm.queries import SQL
from stopwise.llm.shared import components

SF = "/root/testdata/sf0.001"
ODD = [
    (None, None),
    (None, "no id"),
    (-1, None),
    (-2, ""),
    (-3, "   "),
    (-4, " a  b \n c d 　 x\n\n  y  "),
    (-5, "I'll 12345 ½ é é 😀😀 <|endoftext|> \x1c z  q"),
    (-6, "中文字符 テスト  한국어"),
    (-7, "!!! ???"),
    (-8, "word " * 20_000),
    (-9, "the same words again and again"),
    (-9, "the same words again and again"),
]


@pytest.fixture(scope="module")
def docs(spark):
    odd = spark.createDataFrame(ODD, "doc_id long, text string")
    real = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    return odd.union(real).withColumns({"n": F.lit(1), "score": F.lit("x"), "rep": F.lit(None).cast("long")})


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string")


def test_bpe_gives_the_library_s_ids_and_decodes(spark, docs):
    ranks = byte_bpe.Ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks.ranks, special_tokens={})
    want = sorted((str(r.doc_id), r.text or "", library.encode_ordinary(r.text or "")) for r in docs.collect())
    coded = byte_bpe.encode(docs.withColumn("kept", F.col("text")), ranks, group_bytes=200_000)
    rows = coded.withColumn("back", byte_bpe.decode(F.col("ids"), ranks)).collect()
    assert sorted((str(r.doc_id), r.kept or "", list(r.ids)) for r in rows) == want
    assert all(bytes(r.back).decode() == (r.kept or "") for r in rows)


def test_bpe_of_no_rows(nothing):
    ranks = byte_bpe.Ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    assert byte_bpe.encode(nothing, ranks).count() == 0


def test_bpe_of_rows_without_text(spark):
    ranks = byte_bpe.Ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    rows = spark.createDataFrame([(1, None), (2, ""), (2, "")], "doc_id long, text string").coalesce(1)
    assert sorted(map(tuple, byte_bpe.encode(rows, ranks).collect())) == [(1, []), (2, []), (2, [])]


def test_bpe_packs_ids_by_file():
    """Rows of units and their files come back whole, in less than half the bytes of a row for each unit and file."""
    random = np.random.default_rng(8)
    kind = pa.schema([("at", pa.list_(pa.struct([("g", pa.int64()), ("k", pa.int32())]))), ("ids", pa.list_(pa.int32()))])
    files, want, rows = [int(g) for g in random.integers(0, 1 << 62, 6)], {}, []
    for k in range(30_000):
        ids = random.integers(0, 50_000, random.integers(1, 5)).tolist()
        at = [{"g": g, "k": k} for g in random.permutation(files)[: random.integers(1, 4)].tolist()]
        rows.append({"at": at, "ids": ids})
        want.update({(x["g"], k): ids for x in at})
    # the rows that stand for files, one of which has no unit
    rows.append({"at": [{"g": g, "k": 30_000} for g in [*files, 7]], "ids": None})
    random.shuffle(rows)
    batches = [pa.RecordBatch.from_pylist(rows[k : k + 1000], kind) for k in range(0, len(rows), 1000)]
    packed = pa.Table.from_batches(list(byte_bpe._packer(200_000)(iter(batches))))
    got, named = {}, set()
    for g in packed["g"].unique().to_pylist():
        k, lists = byte_bpe._unpacked(packed.filter(pc.equal(packed["g"], g)))
        named.add(g)
        got.update({(g, n): lists.of(np.array([i])).tolist() for i, n in enumerate(k.tolist())})
    assert got == want and named == {*files, 7}
    plain = sum(8 + 4 + 2 * len(ids) for ids in want.values())
    assert packed.nbytes < plain / 2


def test_bpe_stores_words_in_few_bytes(spark):
    ranks = byte_bpe.Ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").coalesce(1)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0]
    before = {*Path(spark.conf.get("spark.checkpoint.dir")).rglob("*.*")}
    byte_bpe.encode(docs, ranks).count()
    stored = sum(p.stat().st_size for p in {*Path(spark.conf.get("spark.checkpoint.dir")).rglob("*.*")} - before if "bpe-" in str(p) and p.is_file())
    assert 0 < stored < 0.36 * size


WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def test_automaton_finds_what_brute_force_finds(spark, docs):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    items += [(900, "the of"), (901, None), (902, "..."), (903, "Same words AGAIN"), (903, "中文字符")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    windows = {}
    for item, text in items:
        w = words(text)
        k = min(10, len(w))
        for j in range(len(w) - k + 1 if w else 0):
            windows.setdefault(k, {}).setdefault(tuple(w[j : j + k]), set()).add(str(item))

    def brute(text):
        w, hit, found = words(text), set(), set()
        for k, known in windows.items():
            for j in range(len(w) - k + 1):
                if tuple(w[j : j + k]) in known:
                    hit.update(range(j, j + k))
                    found |= known[tuple(w[j : j + k])]
        return len(w), len(hit), sorted(found)

    want = sorted((str(r.doc_id), *brute(r.text)) for r in docs.collect())
    for portion in (1 << 20, 2000):
        got = suffix_automaton.find(docs, bench, portion_bytes=portion).withColumn("hit", suffix_automaton.hit_words()).collect()
        assert sorted((str(r.doc_id), r.n_words, r.hit, list(r["items"])) for r in got) == want


def test_clean_keeps_clean_documents_and_drops_covered_ones(spark):
    rows = [(1, "fine text", 5), (2, "start one two three end of it all", 6), (3, "One two THREE", 7), (4, None, 8)]
    bench = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    out = suffix_automaton.clean(spark.createDataFrame(rows, "doc_id long, text string, spans int"), bench)
    assert out.columns == ["doc_id", "text", "spans"]
    assert sorted(out.collect()) == [(1, "fine text", 5), (2, "start   end of it all", 6), (4, None, 8)]


def bag(text):
    w = words(text)
    runs = [" ".join(w[i : i + 5]) for i in range(max(len(w) - 4, 1))] if w else []
    return {x: runs.count(x) for x in set(runs)}


def test_bag_minhash_links_what_all_pairs_link(spark):
    random = np.random.default_rng(3)
    base = [f"w{k}" for k in range(60)]
    rows = [(k, t) for k, (_, t) in enumerate(ODD) if len(t or "") < 1000]
    for k in range(40):  # copies with edits of all sizes, so that some link only through others
        copy = list(base)
        for at in random.integers(0, 60, k % 5):
            copy[at] = f"x{k}-{at}"
        rows.append((100 + k, " ".join(copy)))
    bags = {i: bag(t) for i, t in rows}
    group = {i: i for i in bags}
    linked = True
    while linked:
        linked = False
        for a in bags:
            for b in bags:
                common = sum(min(c, bags[b].get(s, 0)) for s, c in bags[a].items())
                union = sum(bags[a].values()) + sum(bags[b].values()) - common
                if bags[a] and bags[b] and common / union >= 0.8 and group[a] != group[b]:
                    group[a] = group[b] = min(group[a], group[b])
                    linked = True
    got = bag_minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.class_id for r in got} == group
    assert {r.doc_id for r in got if r.kept} == set(group.values())


def test_bag_minhash_estimates_without_bias():
    random = np.random.default_rng(1)
    off = []
    for t in range(30):
        key = textarrays.mix(np.arange(60, dtype=np.uint64) + np.uint64(1000 * t))
        a, b = random.integers(1, 9, 60), random.integers(1, 9, 60)
        s = bag_minhash.signatures(np.repeat([0, 1], 60), np.concatenate([key, key]), np.concatenate([a, b]), 2, 512)
        off.append((s[0] == s[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum())
    assert abs(np.mean(off)) < 0.012


def test_bag_minhash_of_no_rows_and_null_ids(nothing, spark):
    assert bag_minhash.near_duplicates(nothing).count() == 0
    rows = spark.createDataFrame([(None, "a b c d e f"), (None, "a b c d e f"), (3, "a b c d e f")], "doc_id long, text string")
    assert {(r.doc_id, r.class_id, r.kept) for r in bag_minhash.near_duplicates(rows).collect()} == {(None, 3, False), (3, 3, True)}


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 101), (7, 7)], "a long, b long")
    assert {tuple(r) for r in components(edges).collect()} == {(k, 0) for k in range(41)} | {(100, 100), (101, 100)}


def test_components_take_no_step_on_stars_and_hold_on_random_graphs(spark, monkeypatch):
    steps = []
    monkeypatch.setattr(shared, "cut", lambda df, own=shared.cut: steps.append(1) or own(df))
    stars = spark.createDataFrame([(0, k) for k in range(1, 9)] + [(20, 10), (10, 20)], "a long, b long")
    assert {tuple(r) for r in components(stars).collect()} == {(k, 0) for k in range(9)} | {(10, 10), (20, 10)}
    assert len(steps) == 1
    random = np.random.default_rng(7)
    edges = random.integers(0, 120, (90, 2)).tolist()
    least = {k: k for k in itertools.chain(*edges)}
    for _ in least:
        for a, b in edges:
            least[a] = least[b] = min(least[a], least[b])
    linked = {k for a, b in edges if a != b for k in (a, b)}
    assert {tuple(r) for r in components(spark.createDataFrame(edges, "a long, b long")).collect()} == {(k, least[k]) for k in linked}


def test_hnsw_finds_links_and_components(spark):
    random = np.random.default_rng(2)
    centres = random.normal(size=(30, 16))
    rows = [(k, (centres[k % 30] + random.normal(size=16) * 0.12).astype(float).tolist()) for k in range(600)]
    rows += [(600 + k, rows[0][1]) for k in range(5)]
    bad = [(700, None), (701, [0.0] * 16), (702, [float("nan")] * 16), (703, [1.0, None]), (704, [1.0, 2.0]), (705, [2.0, 4.0])]
    got = hnsw_links.near_duplicates(spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>"), shards=3)
    got = {r.vec_id: r for r in got.collect()}
    m = hnsw_links.unit(np.array([v for _, v in rows]))
    link = m @ m.T >= 0.95
    np.fill_diagonal(link, False)
    found = sum(got[k].n_links for k in range(605))
    assert 0.98 * link.sum() <= found <= link.sum()
    assert [got[k].n_links for k in range(700, 706)] == [0, 0, 0, 0, 1, 1]
    assert [got[k].component_id for k in range(700, 706)] == [700, 701, 702, 703, 704, 704]
    assert all(got[600 + k].component_id == got[0].component_id for k in range(5))


def test_hnsw_links_vectors_of_any_finite_size(spark):
    rows = [(1, [1e200, 2e200]), (2, [1e-200, 2e-200]), (3, [1.0, 2.0]), (4, [-1e300, 1e300]), (5, [1e308, 1e308])]
    got = hnsw_links.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("rep", F.lit(1))).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == {1: (2, 1), 2: (2, 1), 3: (2, 1), 4: (0, 4), 5: (0, 5)}


def test_hnsw_of_no_rows(spark):
    assert hnsw_links.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<double>")).count() == 0


def test_hnsw_beam_answers_sparse_links_not_all_products(monkeypatch):
    """Few links, a beam far narrower than the shard: the graph gives them, and brute force sees only the audit's queries."""
    random = np.random.default_rng(6)
    own = random.normal(size=(20_000, 32))
    queries = random.normal(size=(4_000, 32))
    queries[:60] = own[:60] + random.normal(size=(60, 32)) * 0.2
    a, b = hnsw_links.unit(queries), hnsw_links.unit(own)
    want = set(zip(*map(np.ndarray.tolist, hnsw_links.exact(a, b, 0.95)), strict=True))
    asked, plain = [], hnsw_links.exact
    monkeypatch.setattr(hnsw_links, "exact", lambda q, *rest: asked.append(len(q)) or plain(q, *rest))
    reps = np.arange(20_000)
    q, v, beam = hnsw_links.search(hnsw_links.Graph(b), own, queries, 0.95, reps, reps[:4_000] + 20_000)
    assert beam <= hnsw_links.WIDEST and sum(asked) <= hnsw_links.AUDIT
    got = set(zip(q.tolist(), v.tolist(), strict=True))
    assert got <= want and len(got) >= 0.95 * len(want) and len(want) >= 40


@pytest.mark.parametrize("planted", [40, 1500])
def test_hnsw_finds_planted_pairs_between_large_shards(planted):
    """Few linked queries are answered exactly; many are held to RECALL, both against brute force."""
    random = np.random.default_rng(4)
    own, queries = random.normal(size=(3000, 256)), random.normal(size=(3000, 256))
    at = random.permutation(3000)[:planted]
    queries[at] = own[at[::-1]] + random.normal(size=(planted, 256)) * 0.15
    a, b = hnsw_links.unit(queries), hnsw_links.unit(own)
    want = set(zip(*map(np.ndarray.tolist, np.nonzero(a @ b.T >= 0.95)), strict=True))
    reps = np.arange(3000)
    q, v, _ = hnsw_links.search(hnsw_links.Graph(b), own, queries, 0.95, reps, reps + 3000)
    got = set(zip(q.tolist(), v.tolist(), strict=True))
    assert len(want) >= planted * 0.9 and len(q) == len(got) and got <= want
    assert len(got) >= (1 if planted == 40 else hnsw_links.RECALL) * len(want)


def test_wavelet_shard_answers_from_its_planes():
    ids = np.random.default_rng(0).integers(0, 300, 3000)
    shard = wavelet_store.Shard(wavelet_store.encode_shard([5, None], np.array([1000, 2000]), ids))
    assert (shard.decode() == ids).all()
    assert [shard.access(k) for k in (0, 511, 512, 1024, 2999)] == ids[[0, 511, 512, 1024, 2999]].tolist()
    for token in (ids[0], 7, 299, 5000):
        places = np.flatnonzero(ids == token)
        assert [shard.rank(int(token), k) for k in (0, 512, 3000)] == [(places < k).sum() for k in (0, 512, 3000)]
        if len(places):
            assert shard.select(int(token), len(places) - 1) == places[-1]


def test_wavelet_store_gives_the_library_s_ids(spark, docs):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    own = docs.where("doc_id is not null").dropDuplicates(["doc_id"])
    tokenizer = Tokenizer.from_file(path)
    start, want = 0, []
    for r in sorted(own.collect(), key=lambda r: r.doc_id):
        ids = tokenizer.encode(r.text or "", add_special_tokens=False).ids + [1]
        want.append((r.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    folder = wavelet_store.write(own, path, shard_tokens=5000)
    assert sorted(tuple(r) for r in wavelet_store.read(spark, folder).collect()) == want


def test_wavelet_words_give_the_library_s_special_ids(docs):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    texts = ["a <|endoftext|> b<|startoftext|>c", "x<|endoftext|>", "<|ENDOFTEXT|>", "a <|endoftext |>\n<|startoftext|><|endoftext|>", "", None]
    texts += [r.text for r in docs.where("doc_id < 0").collect()]
    want = [[*tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for t in texts]
    assert want[0][:-1] == [320, 49407, 321, 49406, 322]
    ids, lengths = wavelet_store.WordMemory(path).encode(texts)
    assert [x.tolist() for x in np.split(ids, np.cumsum(lengths)[:-1])] == want


def test_wavelet_pieces_of_words_are_encoded_once_and_give_the_library_s_ids():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    random = np.random.default_rng(5)
    known = [chr(c) for c in range(1, 0x3100) if unicodedata.category(chr(c)) != "Cn"] + list("中文한é😀ﬁ")
    words = [a + c + b for c in known for a, b in (("", ""), ("x", c), ("É", "'s"), ("1", "2b"), ("!", "e\u0301"))]
    words += ["".join(random.choice(known, 5)) for _ in range(5000)] + ["a<|endoftext|>b", "</w>", "don't", "''s's", "x\ty", "\x00\x1c"]
    words = [w for w in words if " " not in w and "\n" not in w]
    tokenizer = Tokenizer.from_file(path)
    memory = wavelet_store.WordMemory(path)
    ids, lengths = memory.encode(words)
    want = [[*e.ids, 1] for e in tokenizer.encode_batch_fast(words, add_special_tokens=False)]
    assert [x.tolist() for x in np.split(ids, np.cumsum(lengths)[:-1])] == want
    # as many words as texts can make of few pieces, and none of them left to the library whole
    memory = wavelet_store.WordMemory(path)
    memory.encode(["One one, (one) TWO-one.", "two/one one42", None, ""])
    assert set(memory.pieces.number) == {"one", "two", ",", "(", ")", "-", ".", "/", "4", "2"} and not memory.whole.number
    # a tokenizer that cuts otherwise is left to the library
    from tokenizers.normalizers import NFC

    assert wavelet_store.Pieces.fit(tokenizer)
    tokenizer.normalizer = NFC()
    assert not wavelet_store.Pieces.fit(tokenizer)


def test_jump_hash_moves_rows_only_to_the_new_shard(docs, nothing):
    rows = jump_shards.shard_documents(docs, 16, 4).collect()
    assert all(r.grown_shard in (r.shard, 16) for r in rows) and {r.shard for r in rows} == set(range(16))
    for shard in range(16):
        slots = sorted(r.slot for r in rows if r.shard == shard)
        assert slots == list(range(len(slots)))
    assert {r.doc_id: (r.size, r.text_crc32) for r in rows}[-1] == (1, 0)
    assert jump_shards.shard_documents(nothing).count() == 0


def test_captures_come_back_by_scan_and_by_url(spark):
    long = "x" * 2000
    pages = [(1, "http://a.example.com/p?q=1#f", long), (5, "https://b.example.org/", long), (3, None, long), (4, "http://a.example.com/p?q=1", "short"), (6, "u", None), (None, "http://n.example/", long)]
    folder = capture_index.write(spark.createDataFrame(pages, "page_id long, url string, html string"))
    rows = {r.page_id: (r.payload_bytes, r.record_type, r.refers_to) for r in capture_index.read_all(spark, folder).collect()}
    assert rows == {1: (2000, "revisit", 5), 5: (2000, "response", None), 3: (2000, "revisit", 5), 4: (5, "response", None), 6: (0, "response", None), None: (2000, "revisit", 5)}
    directory = capture_index.Directory(spark, folder)
    assert sorted(x[0] for x in directory.lookup("http://A.example.com/p?q=1")) == [1, 4]
    assert directory.lookup("http://a.example.com/other") == []


def test_licenses_by_canonical_digest(spark):
    mit = next(t for n, t in license_digest.LICENSES if n == "MIT" and len(t) > 100)
    rows = [(1, "Copyright (c) 2020 Someone\n" + mit.upper().replace("SUBLICENSE", "sub-licence")), (2, "text\nReleased under the MIT licence!\nmore"), (3, None), (4, "..."), (5, "Copyright 1999 X")]
    got = license_digest.scan(spark.createDataFrame(rows, "doc_id long, text string"), license_digest.known(spark)).collect()
    assert {(r.doc_id, r.place, r.license) for r in got} == {(1, 0, "MIT"), (1, 2, "MIT"), (2, 0, None), (2, 2, "MIT"), (3, 0, None), (4, 0, None), (5, 0, None)}
    assert all(r.digest is None for r in got if r.doc_id in (3, 4, 5))


def test_full_license_texts_and_lines_of_any_kind(spark):
    texts = license_digest.full_texts()
    assert {"Apache-2.0", "GPL-3.0", "BSD-3-Clause", "Zlib"} <= {n for n, _ in texts}
    rows = [(k, "Copyright (c) 2021 Someone\n\n" + t.upper()) for k, (_, t) in enumerate(texts)]
    one_line = " ".join(next(t for n, t in texts if n == "GPL-2.0").split())
    rows += [(100, f"notes\n{one_line}\nmore"), (101, "x\nDo as you like.\ny")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.place): r.license for r in license_digest.scan(docs, license_digest.known(spark)).collect()}
    assert all(got[k, 0] == n for k, (n, _) in enumerate(texts)) and got[100, 2] == "GPL-2.0"
    own = license_digest.known(spark, [("Own", "Do as you like")])
    assert {(r.doc_id, r.place) for r in license_digest.scan(docs, own).where("license = 'Own'").collect()} == {(101, 2)}


def _license_files() -> list[tuple[str | None, str]]:
    """Files as projects ship them, and texts that only resemble them."""
    full = dict(license_digest.full_texts())
    mit = next(t for n, t in license_digest.LICENSES if n == "MIT" and len(t) > 100)
    apache, directions = full["Apache-2.0"].split("END OF TERMS AND CONDITIONS")
    filled = directions.replace("[yyyy]", "2020").replace("[name of copyright owner]", "Some Corp")
    named = full["BSD-3-Clause"].replace("the copyright holder nor", "Some Corp nor")
    commented = "\n".join(" * " + line for line in ["MIT License", "", "Copyright Some Person", "", *mit.split("\n")])
    return [
        ("MIT", "MIT License\n\nCopyright (c) 2020 Some Person\n\n" + mit),
        ("MIT", "The MIT License (MIT)\r\nCopyright Some Person\r\n\r\n" + mit),
        ("MIT", "/*\n" + commented + "\n */"),
        ("BSD-3-Clause", "Copyright (c) 2020, Some Corp\nAll rights reserved.\n\n" + full["BSD-3-Clause"]),
        ("BSD-3-Clause", "BSD 3-Clause License\n\nCopyright (c) 2020, Some Corp. All rights reserved.\n\n" + named),
        ("BSD-2-Clause", 'BSD 2-Clause "Simplified" License\nCopyright Some Corp\n' + full["BSD-2-Clause"].replace("1.", "*").replace("2.", "*")),
        ("Apache-2.0", apache + "END OF TERMS AND CONDITIONS" + filled),
        ("Apache-2.0", apache + "END OF TERMS AND CONDITIONS\n"),
        ("Apache-2.0", apache),
        ("Zlib", "zlib License\n\nCopyright Some Person\n\n" + full["Zlib"]),
        ("GPL-2.0", full["GPL-2.0"].split("END OF TERMS AND CONDITIONS")[0]),
        ("All-Rights-Reserved", "All rights reserved.\n"),
        # a license is not the whole of these
        (None, apache + "END OF TERMS AND CONDITIONS\n" + "A chapter of another book. " * 20),
        (None, apache + "END OF TERMS AND CONDITIONS" + filled + "word " * 1000),
        (None, "MIT License\n\n" + mit + "\nThe Software may not be sold."),
        (None, "\n" * 20_000 + "Copyright law is old.\n" + "x\n" * 5_000),
        (None, "MIT License\n"),
        (None, "word " * 400_000),
    ]


def test_license_files_as_projects_ship_them(spark):
    import duckdb

    files = _license_files()
    docs = spark.createDataFrame([(k, t, "x") for k, (_, t) in enumerate(files)], "doc_id long, text string, license string")
    rows = license_digest.scan(docs, license_digest.known(spark)).collect()
    got = {r.doc_id: r.license for r in rows if r.place == 0}
    assert [got[k] for k in range(len(files))] == [n for n, _ in files]
    # the statement says the same of every text and line
    con = duckdb.connect()
    con.register("documents", docs.drop("license").toPandas())
    want = con.execute(f"SELECT doc_id, place, digest, license FROM ({SQL['op2_license_digest']}) q").fetchall()
    key = lambda r: (r[0], r[1])
    assert sorted([(r.doc_id, r.place, r.digest, r.license) for r in rows], key=key) == sorted(want, key=key)


def test_license_scan_of_no_rows(spark, nothing):
    assert license_digest.scan(nothing, license_digest.known(spark)).count() == 0
    none = spark.createDataFrame([], "digest string, license string")
    assert [r.license for r in license_digest.scan(spark.createDataFrame([(1, "All rights reserved.")], "doc_id long, text string"), none).collect()] == [None]


def test_forward_backward_against_plain_recursion():
    random = np.random.default_rng(0)
    first = np.array([0, 1, 1, 80, 83, 150])
    scores, moves, start = random.normal(size=(150, 3)), random.normal(size=(3, 3)), random.normal(size=3)
    got = crf_language.posteriors(scores, first, moves, start)
    for a, b in zip(first[:-1], first[1:], strict=True):
        if a == b:
            continue
        forward, back = [np.exp(start + scores[a])], [np.ones(3)]
        for t in range(a + 1, b):
            forward.append((forward[-1] @ np.exp(moves)) * np.exp(scores[t]))
        for t in range(b - 1, a, -1):
            back.insert(0, np.exp(moves) @ (np.exp(scores[t]) * back[0]))
        want = np.array(forward) * np.array(back)
        assert np.allclose(got[a:b], want / want.sum(1, keepdims=True))


def test_expected_moves_against_all_labellings():
    random = np.random.default_rng(1)
    scores, moves, start = random.normal(size=(5, 3)), random.normal(size=(3, 3)) * 2, random.normal(size=3)
    want, total = np.zeros((3, 3)), 0.0
    for path in itertools.product(range(3), repeat=5):
        pairs = list(zip(path[:-1], path[1:], strict=True))
        weight = np.exp(start[path[0]] + scores[np.arange(5), path].sum() + sum(moves[p] for p in pairs))
        total += weight
        for p in pairs:
            want[p] += weight
    forward, behind, local = crf_language.messages(scores, np.array([0, 5]), moves, start)
    assert np.allclose(crf_language.expected_moves(forward, behind * local, np.arange(1, 5), moves), want / total)


def test_every_language_is_learned(spark):
    names = [f"l{k:02d}" for k in range(70)]
    text = {n: " ".join(f"{chr(97 + k % 26)}{chr(97 + k // 26)}q{chr(97 + j)}" for j in range(12)) for k, n in enumerate(names)}
    # the last languages have the fewest rows
    rows = [(100 * k + j, text[n], n) for k, n in enumerate(names) for j in range(3 if k < 64 else 2)]
    field = crf_language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert field.languages == names
    docs = spark.createDataFrame([(k, text[n]) for k, n in enumerate(names)], "doc_id long, text string")
    assert {r.doc_id: r.lang_pred for r in crf_language.predict(docs, field).collect()} == dict(enumerate(names))


def test_language_and_quality_on_held_out_rows(spark, docs):
    real = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    field = crf_language.fit(real.where(~held))
    right = crf_language.predict(real.where(held), field).agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("int"))).first()[0]
    assert right >= 0.97
    odd = {r.doc_id: (r.lang_pred, r.score) for r in crf_language.predict(docs, field).where("doc_id < 0").collect()}
    assert all(odd[k] == ("und", 0.0) for k in (-1, -2, -3, -7))
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    model = vote_quality.fit(real, labels.where(~held))
    scored = vote_quality.score(real, model).join(labels.where(held), "doc_id")
    right = scored.agg(F.avg(((F.col("score") >= vote_quality.ACCEPT).cast("int") == F.col("quality")).cast("int"))).first()[0]
    assert right >= 0.9
    odd = {r.doc_id: r.score for r in vote_quality.score(docs, model).where("doc_id < 0").collect()}
    assert all(odd[k] == 0 for k in (-1, -2, -3)) and all(0 <= x <= 1 for x in odd.values())


def test_models_without_rows(spark, nothing):
    field = crf_language.fit(nothing)
    some = spark.createDataFrame([(1, "text"), (2, None)], "doc_id long, text string")
    assert [r.lang_pred for r in crf_language.predict(some, field).collect()] == ["und", "und"]
    model = vote_quality.fit(nothing, spark.createDataFrame([], "doc_id long, quality int"))
    assert {r.doc_id: r.score for r in vote_quality.score(some, model).collect()} == {1: 0.5, 2: 0.0}
    assert vote_quality.score(nothing, model).count() == 0 and crf_language.predict(nothing, field).count() == 0


def test_words_of_switched_text_get_their_own_language(spark):
    field = crf_language.fit(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    found = [(w, language) for w, language, _ in crf_language.words("the thing erstion of anly les eaumentelle aiauxaux du la", field)]
    assert [x for _, x in found[:5]] == ["en"] * 5 and [x for _, x in found[5:]] == ["fr"] * 5


def test_known_pieces_are_found_and_new_ones_encoded_once():
    memory = wavelet_store.WordMemory(public_tokenizers.path("word_bpe_49k.json"))
    coded = []
    memory.cutter.encode = lambda pieces, own=memory.cutter.encode: coded.append(list(pieces)) or own(pieces)
    texts = ["some words, 12 more words", "words of a second text: some more", None, "", "\u00dcber caf\u00e9 don't"]
    for _ in range(2):
        ids, sizes = memory.encode(texts)
        plain = [memory.tokenizer.encode(t or "", add_special_tokens=False).ids + [1] for t in texts]
        assert (ids.tolist(), sizes.tolist()) == ([i for p in plain for i in p], [len(p) for p in plain])
    assert len(set(coded[0])) == len(coded[0]) and not any(coded[1:])
    assert memory.pieces.find([coded[0][2], "unseen"]).tolist() == [2, -1]
