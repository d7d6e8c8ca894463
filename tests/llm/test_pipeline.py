"""Stages of the pipeline on null, repeated and empty rows, against plain versions."""

import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from stopwise.llm import crf_language, vote_quality
from stopwise.llm import textarrays as ta

SF = "/root/testdata/sf0.001"
COLUMNS = "doc_id long, text string, lang string, source string"
LONG = " ".join(f"word{k % 97} and some{k}" for k in range(120))
OTHER = " ".join(f"quite{k} different words{k % 13}" for k in range(90))
ROWS = [
    (1, LONG, "en", "a"),
    (2, LONG + " more", "en", "a"),
    (3, OTHER, "en", "b"),
    (7, LONG, "en", "c"),
    (7, OTHER + " tail", "de", "c"),
    (7, "a text of its own under an id that stands on other rows too", "en", "c"),
    (8, "repeated row", "en", "d"),
    (8, "repeated row", "en", "d"),
    (None, LONG, "en", "e"),
    (None, "no id but a text", None, None),
    (None, "no id but a text", None, None),
    (None, None, None, None),
    (9, None, "en", None),
    (10, "", "en", None),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, COLUMNS)


def bag(text):
    words = re.findall(r"[a-z0-9]+", (text or "").lower())
    return Counter(" ".join(words[k : k + 5]) for k in range(max(len(words) - 4, 1))) if words else Counter()


def test_near_duplicates_keep_one_row_of_each_group(spark, docs):
    got = sorted(corpus_pipeline.near_duplicates(spark, docs, SF).collect(), key=str)
    distinct = sorted(set(ROWS), key=lambda r: (r[0] is None, r[0] or 0, str(r[1])))
    groups, bags = [], [bag(r[1]) for r in distinct]
    for k, one in enumerate(bags):
        near = [g for g in groups if any(one and bags[m] and sum((one & bags[m]).values()) >= 0.8 * sum((one | bags[m]).values()) for m in g)]
        groups = [g for g in groups if g not in near] + [sum(near, []) + [k]]
    assert len(got) == len(groups)
    for g in groups:
        assert sum(tuple(r) in {distinct[m] for m in g} for r in got) == 1
    assert {r.text for r in got if r.doc_id == 7} == {"a text of its own under an id that stands on other rows too"}


def test_every_stage_takes_no_rows_and_odd_rows(spark, docs):
    for _, stage in corpus_pipeline.STAGES[2:4]:
        assert stage(spark, docs, SF).columns == docs.columns
        assert stage(spark, docs.limit(0), SF).count() == 0
    rows = corpus_pipeline.tokens(spark, docs, SF).collect()
    assert len(rows) == len(ROWS) and all(r.round_trip for r in rows)
    assert corpus_pipeline.tokens(spark, docs.limit(0), SF).count() == 0


def test_language_and_quality_drop_what_they_reject_and_nothing_else(spark):
    real = spark.read.parquet(f"{SF}/documents.parquet")
    odd = real.limit(1).select(*[F.lit(None).cast(t).alias(n) for n, t in real.dtypes])
    for stage in (corpus_pipeline.quality, corpus_pipeline.language):
        out = stage(spark, real.unionByName(odd), SF)
        assert out.columns == real.columns
        kept = Counter(r.doc_id for r in out.collect())
        before = Counter(r.doc_id for r in real.collect())
        assert all(before[k] >= n for k, n in kept.items()) and sum(kept.values()) > 0.4 * sum(before.values())


def test_models_are_fitted_outside_the_driver_with_the_same_result(spark, monkeypatch):
    real, labels = (spark.read.parquet(f"{SF}/{name}.parquet") for name in ("documents", "labels"))
    known = real.where("text is not null and doc_id is not null")
    rows = known.where("lang is not null").select("lang", F.lower("text").alias("text"), F.xxhash64("doc_id").alias("h")).orderBy("lang", "h", "text").toArrow()
    names = sorted(set(rows["lang"].to_pylist()))
    want_field = crf_language.fit_arrays(ta.from_arrow(rows["text"].combine_chunks()), np.searchsorted(names, rows["lang"].to_pylist()), names)
    marked = known.join(labels.where("quality in (0, 1)").select("doc_id", "quality"), "doc_id").orderBy("doc_id").toArrow()
    sample = ta.from_arrow(marked["text"].combine_chunks())
    want_model = vote_quality.fit_arrays(sample, marked["quality"].to_numpy().astype(np.int64))

    def here(*_):
        raise AssertionError("fitted on the driver")

    monkeypatch.setattr(crf_language, "fit_arrays", here)
    monkeypatch.setattr(vote_quality, "fit_arrays", here)
    field = crf_language.fit(real, per_language=10**6)
    assert field.languages == names and np.array_equal(field.lexicon, want_field.lexicon)
    assert np.allclose(field.weights, want_field.weights, atol=1e-4) and np.allclose(field.moves, want_field.moves, atol=1e-4)
    model = vote_quality.fit(real, labels, per_class=10**6)
    counted = vote_quality.features(sample)
    assert np.array_equal(model.labels, want_model.labels)
    assert np.allclose(model.score(counted, 15), want_model.score(counted, 15), atol=1e-4)
