"""Language identification: the recursion against all segmentations, accuracy on held-out documents, cases."""

from __future__ import annotations

import numpy as np
from helpers import crc, documents
from pyspark.sql import functions as F

from encore.llm import language, queries


def every(word, chance):
    """The sum over all segmentations, one by one."""
    if not word:
        return 1.0
    return sum(
        (chance.get(word[:k], 0) + (language.UNKNOWN if k == 1 else 0)) * every(word[k:], chance) for k in range(1, len(word) + 1)
    )


def test_recursion_sums_all_segmentations():
    told = language.pieces(language.vocabulary_path())
    rng = np.random.default_rng(0)
    chance = rng.random((len(told), 2))
    chance /= chance.sum(0)
    lattice = language.Lattice(told)
    words = [" hello", " thinking", " cióné", " x", " straße", " 漢字", " a"]
    for some, chars in language.by_length(words):
        got = language.forward(lattice.edges(chars), len(some), chance)[-1]
        for row, i in zip(got, some, strict=True):
            assert np.allclose(row, [every(words[i], dict(zip(told, chance[:, k], strict=True))) for k in (0, 1)], rtol=1e-9)


def test_accuracy_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = {r.doc_id: r for r in queries.QUERIES["op10_language"](spark, sf).collect()}
    assert set(got) == set(truth)
    assert all(r.held_out == (crc(i) % 4 == 2) and 0 <= r.score <= 1 for i, r in got.items())
    held = [i for i in got if got[i].held_out and truth[i] is not None]
    assert np.mean([got[i].lang_pred == truth[i] for i in held]) > 0.97


def test_cases(spark):
    texts = ["the house and the garden are here", "das haus und der garten sind hier", None, "", "123 ... ²", "THE HOUSE", "x" * 50_000, "the house and the garden are here"]
    rows = [(i, t, "en" if i in (0, 7) else "de" if i == 1 else None) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "1 AS score", "2 AS t", "3 AS l")
    got = sorted(language.classify(df, F.lit(True)).collect(), key=lambda r: r.doc_id)
    assert [r.lang_pred for r in got][:6] == ["en", "de", "und", "und", "und", "en"] and got[6].lang_pred in ("en", "de")
    assert got[0].score == got[7].score and all(0 <= r.score <= 1 for r in got)
    assert {r.lang_pred for r in language.classify(df, F.lit(False)).collect()} == {"und"}
    assert language.classify(df.limit(0), F.lit(True)).count() == 0
    assert documents(spark, []).count() == 0
