"""The pipeline, stage by stage, and the entry points."""

from __future__ import annotations

import re

import corpus_pipeline
import pytest
from helpers import documents
from pyspark.sql import functions as F
from test_jaccard import brute as components
from test_packing import check
from test_personal import plain
from tokenizers import Tokenizer

import __spark_entry__
from encore.llm import jaccard, packing, quality


def test_registered():
    names = set(__spark_entry__.queries())
    assert "pipeline" in names
    assert all(any(re.match(rf"op{n}_", x) for x in names) for n in range(1, 11))


@pytest.fixture(scope="module")
def stages(spark, sf):
    docs, out = spark.read.parquet(f"{sf}/documents.parquet"), {}
    out["documents"] = docs
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf).cache()
        out[name] = docs
    return out


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_stages(stages, spark, sf):
    before, good = rows(stages["documents"]), rows(stages["quality"])
    assert all(tuple(good[i]) == tuple(before[i]) for i in good)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    kept = [i for i in before if labels.get(i) == 1]
    assert sum(i in good for i in kept) >= 0.97 * len(kept)
    once = rows(stages["near_duplicates"])
    expected = components([(i, r.text) for i, r in good.items()], 80, 5)
    assert set(once) == {i for i in good if expected[i][1] == i}
    clean = rows(stages["decontamination"])
    assert set(clean) <= set(once) and len(clean) < len(once)
    redacted = rows(stages["personal_data"])
    assert set(redacted) == set(clean)
    for i, r in redacted.items():
        assert r.n_chars == len(r.text) and (r.text != clean[i].text or not plain(r.text))
        assert not plain(r.text)
    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    tokenizer.encode_special_tokens = True
    check(stages["packing"].collect(), {i: r.text for i, r in redacted.items()}, tokenizer)


def test_run_is_the_stages_in_turn(stages, spark, sf):
    pieces = lambda df: sorted((r.doc_id, r.start, r.length) for r in df.groupBy("doc_id").agg(F.min("start").alias("start"), F.sum("length").alias("length")).collect())
    assert pieces(corpus_pipeline.run(spark, sf)) == pieces(stages["packing"])


def test_odd_rows(spark, sf):
    docs = documents(spark, [None, "", "a b c d e f g h i j k l m n o p", "a b c d e f g h i j k l m n o p"], "score items spans signs mark")
    docs = docs.unionAll(docs.where("doc_id = 2")).unionAll(docs.withColumn("doc_id", F.lit(None).cast("long")).limit(1))
    once = corpus_pipeline.keep_one(spark, docs, sf)
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in once.collect()) == [(False, 0), (False, 1), (False, 2), (True, 0)]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, sf).columns == corpus_pipeline.DOCUMENT
        assert stage(spark, docs.limit(0), sf).count() == 0
    assert quality.THRESHOLD == 0.3


def test_keep_one_judges_rows_by_their_texts(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "MARKS", 1)  # every id shares its mark with one that is looked at
    near, other = (" ".join(f"{x}{i}" for i in range(60)) for x in "ab")
    rows = [(1, near), (2, near + " x"), (2, other), (3, "of its own"), (3, "of its own"), (None, "same"), (None, "same"), (None, near)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.keep_one(spark, docs, "").collect()
    kept = [(1, near), (2, other), (3, "of its own"), (None, "same"), (None, "same"), (None, near)]
    assert sorted((str(r.doc_id), r.text) for r in got) == sorted((str(i), t) for i, t in kept)
