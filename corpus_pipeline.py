"""A training-data pipeline over `documents`: quality, language, near-duplicates, benchmark passages, tokens.

Each stage gets all documents that the one before it kept. All but the last return the columns of `documents`. Rows
with null or repeated values pass as the operators define; the near-duplicate stage keeps one row of those that repeat id and text.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from stopwise.llm import bag_minhash, byte_bpe, crf_language, suffix_automaton, vote_quality  # noqa: E402
from stopwise.llm.queries import byte_ranks, language_is_held_out, quality_is_held_out, table  # noqa: E402
from stopwise.llm.shared import cut, new_folder  # noqa: E402

#: A text of which no language has this share of words, or that has no letter, is rejected.
MIN_LANGUAGE = 0.34


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose neighbours vote against them."""
    labels = table(spark, sf_dir, "labels").where(~quality_is_held_out())
    model = vote_quality.fit(docs.select("doc_id", "text"), labels)
    return vote_quality.score(docs, model).where(F.col("score") >= vote_quality.ACCEPT).select(*docs.columns)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a language; fills missing languages."""
    field = crf_language.fit(docs.where(~language_is_held_out()))
    known = crf_language.predict(docs, field).where((F.col("lang_pred") != crf_language.UNKNOWN) & (F.col("score") >= MIN_LANGUAGE))
    return known.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*docs.columns)


def stored(spark: SparkSession, rows: DataFrame, name: str) -> DataFrame:
    """Writes rows as Parquet to the shared folder and reads them back; their size is known from then on."""
    path = f"{new_folder(spark, name)}/rows"
    rows.write.parquet(path)
    return spark.read.parquet(path)


def with_row_key(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """docs with `_key`, one row for each pair of doc_id and text: the doc_id where it stands on one row, else a number above
    2^62 made of id and text. Of rows that repeat id and text, the one of smallest values stays."""
    often = docs.groupBy("doc_id").count().where("count > 1 or doc_id is null").select(F.col("doc_id").alias("_id"), F.lit(True).alias("_often"))
    often = stored(spark, often, "repeated")
    marked = docs.join(often, F.col("doc_id").eqNullSafe(F.col("_id")), "left").drop("_id")
    once = marked.where("_often is null").drop("_often").withColumn("_key", F.col("doc_id").cast("long"))
    both = F.xxhash64(F.col("doc_id"), F.col("text").isNull(), F.col("text"), F.reverse("text"))
    rest = marked.where("_often").drop("_often").withColumn("_key", F.lit(1 << 62) + both.bitwiseAND((1 << 61) - 1))
    single = rest.groupBy("_key").agg(F.min(F.struct(*docs.columns)).alias("_row")).select("_row.*", "_key")
    return once.unionByName(single)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of smallest id of each group of near copies. Rows are told apart by id and text, so texts that
    share an id are neither lost nor brought back by it, and rows without id take part."""
    keyed = stored(spark, with_row_key(spark, docs), "keyed")
    found = bag_minhash.near_duplicates(keyed.select(F.col("_key").alias("doc_id"), "text")).where("kept")
    return keyed.join(cut(found.select(F.col("doc_id").alias("_key"))), "_key", "left_semi").select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts benchmark passages out; drops documents that consist mostly of them."""
    return suffix_automaton.clean(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, ids, and whether they decode to the text."""
    ranks = byte_ranks()
    rows = docs.select("doc_id", "lang", "source", F.sha2("text", 256).alias("text_sha256"), "text")
    # the ids are written before they are decoded, so that the tables of both directions never stand in one plan
    coded = stored(spark, byte_bpe.encode(rows, ranks), "ids")
    return coded.select(
        "doc_id",
        "lang",
        "source",
        F.size("ids").cast("long").alias("n_tokens"),
        "ids",
        (F.sha2(byte_bpe.decode(F.col("ids"), ranks), 256) == F.coalesce("text_sha256", F.sha2(F.lit(""), 256))).alias("round_trip"),
    )


STAGES = [
    ("quality classifier", quality),
    ("language ID", language),
    ("MinHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("byte-level BPE", tokens),
]

#: SQL cannot express the fitted stages; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = new_folder(spark, "pipeline")
    for k, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{k}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
