"""The registered queries of the operators, and their DuckDB statements where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stopwise.llm import (
    bag_minhash,
    byte_bpe,
    capture_index,
    crf_language,
    hnsw_links,
    jump_shards,
    license_digest,
    maxscore_search,
    source_divergence,
    suffix_automaton,
    token_alignment,
    vote_quality,
    wavelet_store,
)
from stopwise.llm.shared import crc_of_id

#: Paths of the public tokenizer files; they must exist on every executor.
TOKENIZERS = {"bytes": "byte_bpe_multi_50k.tiktoken", "words": "word_bpe_49k.json", "letters": "byte_bpe_50k.json", "pieces": "piece_bpe_32k.model"}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[build.__name__] = build
    return build


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def language_is_held_out() -> Column:
    return crc_of_id() % 4 == 2


def quality_is_held_out() -> Column:
    return crc_of_id() % 5 == 0


def byte_ranks() -> byte_bpe.Ranks:
    import public_tokenizers

    return byte_bpe.Ranks(public_tokenizers.path(TOKENIZERS["bytes"]), public_tokenizers.PATTERN)


@query
def op1_crf_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    field = crf_language.fit(docs.where(~language_is_held_out()))
    return crf_language.predict(docs.select("doc_id", "text", language_is_held_out().alias("held_out")), field).drop("text")


@query
def op2_license_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_digest.scan(table(spark, sf_dir, "documents"), license_digest.known(spark))


@query
def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = byte_ranks()
    coded = byte_bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), ranks)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(byte_bpe.id_text(F.col("ids")), 256).alias("ids_sha256"),
        F.sha2(byte_bpe.decode(F.col("ids"), ranks), 256).alias("decoded_sha256"),
    )


@query
def op4_hnsw_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw_links.near_duplicates(table(spark, sf_dir, "embeddings"))


@query
def op5_wavelet_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    folder = wavelet_store.write(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZERS["words"]))
    return wavelet_store.read(spark, folder)


@query
def op6_jump_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jump_shards.shard_documents(table(spark, sf_dir, "documents"))


@query
def op7_suffix_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_automaton.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = suffix_automaton.hit_words()
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


@query
def op8_bag_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bag_minhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op9_vote_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = vote_quality.fit(docs, table(spark, sf_dir, "labels").where(~quality_is_held_out()))
    scored = vote_quality.score(docs, model)
    return scored.select(
        "doc_id",
        F.coalesce(quality_is_held_out(), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= vote_quality.ACCEPT).cast("int").alias("predicted"),
    )


@query
def op10_capture_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = capture_index.write(table(spark, sf_dir, "pages"))
    return capture_index.read_all(spark, folder).drop("url")


@query
def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    return token_alignment.audit(docs, public_tokenizers.path(TOKENIZERS["letters"]), public_tokenizers.path(TOKENIZERS["pieces"]))


@query
def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence.audit(table(spark, sf_dir, "documents"))


@query
def op13_maxscore_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxscore_search.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


# DuckDB statements. They start from the written definitions and share no code with the operators.

_LOW = "translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = f"regexp_extract_all({_LOW}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

SQL["op4_hnsw_links"] = """
WITH RECURSIVE v AS (
    SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
    WHERE embedding IS NOT NULL AND list_aggregate(list_transform(embedding, lambda x: CASE WHEN x IS NULL OR NOT isfinite(x) THEN 1 ELSE 0 END), 'sum') = 0
      AND list_aggregate(list_transform(embedding, lambda x: CASE WHEN x <> 0 THEN 1 ELSE 0 END), 'sum') > 0
), link AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
    WHERE list_cosine_similarity(a.e, b.e) >= 0.95
), reach AS (
    SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a
)
SELECT e.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, least(e.vec_id, coalesce(c.c, e.vec_id)) AS component_id,
       e.vec_id = least(e.vec_id, coalesce(c.c, e.vec_id)) AS kept
FROM embeddings e
LEFT JOIN (SELECT a, count(*) AS n FROM link GROUP BY a) n ON n.a = e.vec_id
LEFT JOIN (SELECT a, min(b) AS c FROM reach GROUP BY a) c ON c.a = e.vec_id
"""

SQL["op7_suffix_automaton"] = f"""
WITH item AS (SELECT item_id::VARCHAR AS item, {_WORDS.format("text")} AS w FROM benchmark WHERE item_id IS NOT NULL),
span AS (SELECT item, w, least(10, len(w)) AS k FROM item WHERE len(w) > 0),
win AS (SELECT DISTINCT item, k, array_to_string(w[i : i + k - 1], ' ') AS s FROM span, unnest(range(1, len(w) - k + 2)) t(i)),
doc AS (SELECT doc_id, {_WORDS.format("text")} AS w FROM documents),
place AS (SELECT doc_id, k, i, array_to_string(w[i : i + k - 1], ' ') AS s FROM doc, (SELECT DISTINCT k FROM win) ks, unnest(range(1, greatest(len(w) - k + 2, 1))) t(i)),
hit AS (SELECT doc_id, i, place.k AS k, item FROM place JOIN win ON place.s = win.s AND place.k = win.k),
n AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM hit, unnest(range(i, i + k)) t(p) GROUP BY doc_id),
m AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM hit) x GROUP BY doc_id)
SELECT doc.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN n ON n.doc_id = doc.doc_id LEFT JOIN m ON m.doc_id = doc.doc_id
"""

SQL["op8_bag_minhash"] = f"""
WITH RECURSIVE doc AS (SELECT doc_id, {_WORDS.format("text")} AS w FROM documents),
run AS (
    SELECT doc_id, array_to_string(w[i : i + 4], ' ') AS s FROM doc, unnest(range(1, greatest(len(w) - 3, 2))) t(i) WHERE len(w) > 0
),
bag AS (SELECT doc_id, s, count(*) AS c FROM run GROUP BY doc_id, s),
size AS (SELECT doc_id, sum(c)::BIGINT AS n, md5(string_agg(s || '=' || c, '|' ORDER BY s)) AS whole FROM bag GROUP BY doc_id),
first AS (SELECT whole, min(doc_id) AS rep FROM size GROUP BY whole),
own AS (SELECT b.doc_id, b.s, b.c FROM bag b SEMI JOIN first f ON b.doc_id = f.rep),
pair AS (SELECT x.doc_id AS a, y.doc_id AS b, sum(least(x.c, y.c)) AS common FROM own x JOIN own y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY 1, 2),
near AS (SELECT a, b FROM pair JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b WHERE common / (x.n + y.n - common) >= 0.8),
link AS (SELECT a, b FROM near UNION ALL SELECT b, a FROM near),
reach AS (SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
class AS (SELECT rep, least(rep, coalesce(min(b), rep)) AS class_id FROM first LEFT JOIN reach ON a = rep GROUP BY rep)
SELECT d.doc_id, coalesce(size.n, 0) AS n_shingles, coalesce(first.rep, d.doc_id) AS rep, coalesce(class_id, d.doc_id) AS class_id,
       d.doc_id = coalesce(class_id, d.doc_id) AS kept
FROM doc d LEFT JOIN size ON size.doc_id = d.doc_id LEFT JOIN first ON first.whole = size.whole LEFT JOIN class ON class.rep = first.rep
"""

SQL["op10_capture_index"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
g AS (SELECT page_id, html, max(page_id) OVER (PARTITION BY html) AS newest FROM p),
r AS (SELECT *, octet_length(encode(html)) >= 1000 AND newest IS NOT NULL AND page_id IS DISTINCT FROM newest AS again FROM g)
SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes, sha1(html) AS payload_digest,
       CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN again THEN newest END AS refers_to
FROM r
"""


SQL["op12_source_divergence"] = f"""
WITH d AS (SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source, {_LOW.format("text")} AS text FROM documents),
w AS (SELECT row, lang, source, unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term, count(*)::HUGEINT AS n FROM w GROUP BY lang, term HAVING count(DISTINCT row) >= 30),
v AS (SELECT lang, count(*) AS v, sum(n)::HUGEINT AS n FROM kept GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
full_count AS (
    SELECT g.lang, g.source, kept.term, coalesce(c.n, 0)::HUGEINT AS n, kept.n AS all_n
    FROM g JOIN kept ON kept.lang = g.lang
    LEFT JOIN (SELECT lang, source, term, count(*) AS n FROM w GROUP BY ALL) c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term
),
total AS (SELECT lang, source, sum(n)::HUGEINT AS n FROM full_count GROUP BY lang, source),
p AS (
    SELECT f.lang, f.source, term, f.n, 1 + (1000000000 * (f.n + 5)) // (t.n + 5 * v.v) AS p, 1 + (1000000000 * (all_n + 5)) // (v.n + 5 * v.v) AS q
    FROM full_count f JOIN total t ON t.lang = f.lang AND t.source = f.source JOIN v ON v.lang = f.lang
),
found AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
           coalesce((SELECT sum(abs(x.p - y.p)) FROM p x JOIN p y ON y.lang = x.lang AND y.term = x.term WHERE x.lang = a.lang AND x.source = a.source AND y.source = b.source), 0) AS value
    FROM g a JOIN g b ON b.lang = a.lang AND b.source <> a.source
    UNION ALL
    SELECT lang, source, 'term', term, p - q FROM p WHERE n > 0 AND p > q
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM found)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INT AS rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""

SQL["op13_maxscore_search"] = """
WITH v AS (
    SELECT vec_id, list_transform(embedding::DOUBLE[], lambda x: floor(256 * x)::BIGINT) AS e FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
),
score AS (
    SELECT q.vec_id AS query_id, c.vec_id,
           coalesce(list_sum(list_transform(list_zip(q.e, c.e), lambda z: coalesce(z[1], 0) * coalesce(z[2], 0))), 0)::BIGINT AS score
    FROM v q JOIN v c ON c.vec_id IS DISTINCT FROM q.vec_id WHERE q.vec_id % 50 = 0
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id NULLS LAST) AS rank FROM score)
SELECT query_id, rank::INT AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""


def _license_sql() -> str:
    blank, mark = "[ \\t\\r\\f]", "(?:[/*#;!-]+[ \\t]*)?"
    title = (
        '(?:the )?(?:mit|expat|isc|zlib|zlib/libpng|(?:(?:new|simplified|revised|modified) )?bsd(?:[ -](?:[0-9]|zero)[ -]clause)?'
        '(?: "?(?:simplified|new|revised)"?(?: or "?revised"?)?)?) licen[cs]e(?: \\([^\\n]*\\))?|(?:the )?unlicense'
    )
    skip = "[\\s/*#;!=-]*"
    before = f"(?i)\\A{skip}(?:(?:{title}|copyright\\b[^\\n]*|\\(c\\)[^\\n]*|©[^\\n]*|all rights reserved\\.?){blank}*\\n{skip}){{1,40}}"

    def body(text: str) -> str:
        rest = f"regexp_replace({text}, '{before}', ' ')"
        return f"CASE WHEN regexp_matches({rest}, '[\\p{{L}}\\p{{N}}]') THEN {rest} ELSE {text} END"

    def words(text: str) -> str:
        line = f"(?mi)^{blank}*{mark}(?:copyright\\b[^\\n]*[0-9]{{4}}|copyright[ \\t]*(?:\\(c\\)|©|\\[yyyy\\]|<year>)|\\(c\\)|©)[^\\n]*$"
        out = f"regexp_replace({body(text)}, '{line}', ' ', 'g')"
        out = f"lower(regexp_replace({out}, '(?mi)^{blank}*{mark}(?:[0-9]{{1,2}}|[a-z])[.)][ \\t]+', ' ', 'g'))"
        out = f"trim(regexp_replace({out}, '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))"
        for a, b in (
            ("\\blicence(s?)\\b", "license\\1"),
            ("\\bsub licens", "sublicens"),
            ("\\bnon infring", "noninfring"),
            ("\\bcopyright owner", "copyright holder"),
            ("\\bwhilst\\b", "while"),
            ("\\bneither the names? of (?:[^ ]+ ){1,12}nor\\b", "neither the name of the copyright holder nor"),
        ):
            out = f"regexp_replace({out}, '{a}', '{b}', 'g')"
        return out

    # the terms: what stands before their end where only directions for use follow
    end = " end of terms and conditions"
    own = f"split_part(f, '{end}', 1)"
    terms = f"""CASE WHEN contains(f, '{end}') AND length(f) - length({own}) <= 3000
      AND regexp_matches(substr(f, length({own}) + 1), '^{end}( (?:appendix )?how to apply .*)?$') THEN {own} ELSE f END"""
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    rows = ", ".join(f"({quoted(a)}, {quoted(b)})" for a, b in license_digest.LICENSES + license_digest.full_texts())
    return f"""
WITH given(license, text) AS (VALUES {rows}),
spread AS (
    SELECT license, text FROM given
    UNION ALL SELECT license, regexp_replace(text, '\\s+', ' ', 'g') FROM given
    UNION ALL SELECT license, regexp_replace({body("text")}, '\\s+', ' ', 'g') FROM given
),
known AS (SELECT sha256({terms}) AS digest, min(license) AS license FROM (SELECT license, {words("text")} AS f FROM spread) s WHERE f <> '' GROUP BY 1),
unit AS (
    SELECT doc_id, 0 AS place, text AS u FROM documents
    UNION ALL
    SELECT doc_id, unnest(range(1, len(x) + 1))::INT AS place, unnest(x) AS u FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS x FROM documents) s
),
form AS (SELECT doc_id, place, {terms} AS f FROM (SELECT doc_id, place, {words("u")} AS f FROM unit) s),
digest AS (SELECT doc_id, place, CASE WHEN f <> '' THEN sha256(f) END AS digest FROM form)
SELECT d.doc_id, d.place, d.digest, k.license FROM digest d LEFT JOIN known k ON k.digest = d.digest
WHERE d.place = 0 OR k.license IS NOT NULL
"""


SQL["op2_license_digest"] = _license_sql()
