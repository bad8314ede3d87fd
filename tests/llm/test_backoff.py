"""Stupid backoff against counts in dictionaries."""

from __future__ import annotations

import math
import re
from collections import Counter

from helpers import documents
from pyspark.sql import functions as F

from encore.llm import backoff


def brute(rows, learn, alpha=0.4):
    pairs = {}
    for k, (i, t) in enumerate(rows):
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
        pairs[k] = (i, list(zip([" <", *words], [*words, "> "], strict=True)))
    two, one, low, total = Counter(), Counter(), Counter(), 0
    for i, ps in pairs.values():
        if learn(i):
            two.update(ps)
            one.update(a for a, _ in ps)
            low.update(b for _, b in ps)
            total += len(ps)
    out = []
    for i, ps in pairs.values():
        s = [math.log(two[p] / one[p[0]]) if two[p] else math.log(alpha * max(low[p[1]], 1) / max(total, 1)) for p in ps]
        out.append((i, len(ps) - 1, round(sum(s), 6)))
    return sorted(out, key=str)


def scored(df, **more):
    return sorted(((r.doc_id, r.n_tokens, round(r.log_score, 6)) for r in backoff.score(df, **more).collect()), key=str)


def test_against_dictionaries(spark, sf, monkeypatch):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    rows += [(9000 + i, t) for i, t in enumerate([None, "", "the", "The THE the", "x\x0by z", "new words only here", "new words only here"])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(backoff, "CHUNK", 7000)  # several chunks to a task
    got = scored(df, learn=F.col("doc_id") % 3 != 0, partition=9000)
    assert got == brute(rows, lambda i: i % 3)


def test_nothing_learned_and_nothing_there(spark):
    df = documents(spark, ["a b", None, "a b"], "n_tokens i t l kind")
    assert scored(df, learn=F.lit(False)) == brute([(0, "a b"), (1, None), (2, "a b")], lambda i: False)
    assert scored(df) == brute([(0, "a b"), (1, None), (2, "a b")], lambda i: True)
    assert backoff.score(df.limit(0)).count() == 0
    no_ids = df.selectExpr("CAST(NULL AS LONG) AS doc_id", "text")
    assert [r.doc_id for r in backoff.score(no_ids).collect()] == [None] * 3
