"""The quality classifier: accuracy on held-out labels, and cases."""

from __future__ import annotations

import numpy as np
from helpers import crc, documents
from pyspark.sql import functions as F

from encore.llm import quality, queries
from encore.llm.common import fold


def test_accuracy_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in queries.QUERIES["op5_quality"](spark, sf).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    held = [i for i in got if crc(i) % 5 == 0]
    assert all(got[i].held_out == (crc(i) % 5 == 0) for i in got)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got.values())
    assert np.mean([got[i].predicted == labels[i] for i in held if i in labels]) > 0.95


def test_labels_held_out_are_not_used(spark):
    docs = documents(spark, [f"word number {i} " * (i % 9 + 1) for i in range(80)])
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(80)], "doc_id long, quality int, toxic int")
    turned = labels.withColumn("quality", F.when(fold("doc_id", 5) == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    scores = [sorted(map(tuple, quality.classify(docs, x, fold("doc_id", 5) != 0).collect())) for x in (labels, turned)]
    assert scores[0] == scores[1]


def test_cases(spark):
    texts = [None, "", "plain words here. " * 20, "!!! $$$ " * 30, "x" * 300_000, "plain words here. " * 20] * 8
    docs = documents(spark, texts, "score statistics y")
    labels = spark.createDataFrame([(i, 0 if i % 6 == 3 else 1, None if i else 5) for i in range(40)] + [(7, 1, 0), (None, 0, 0)], "doc_id long, quality int, score int")
    rows = sorted(quality.classify(docs, labels, F.lit(True)).collect())
    assert len(rows) == 48 and all(0 <= r.score <= 1 for r in rows)
    assert rows[0].score == rows[1].score == rows[6].score and rows[2].score == rows[5].score
    assert rows[2].score > 0.5 > rows[3].score
    assert {r.score for r in quality.classify(docs, labels.limit(0), F.lit(True)).collect()} == {0.5}
    assert quality.classify(docs.limit(0), labels, F.lit(True)).count() == 0
    kept = quality.classify(docs, labels, F.lit(True), keep=["doc_id", "text", "lang"])
    assert sorted((r.doc_id, r.score) for r in kept.collect()) == [tuple(r) for r in rows]


def test_isotonic_is_the_least_squares_rising_line():
    y = np.array([1.0, 3, 2, 2, 5, 4])
    x, fitted = quality.isotonic(np.arange(6.0), y, np.ones(6))
    assert np.allclose(np.interp(np.arange(6), x, fitted)[[0, 2, 5]], [1, 7 / 3, 4.5])
    assert (np.diff(fitted) > 0).all()
