"""Benchmark passages against a search for every window."""

from __future__ import annotations

import hashlib
import random
import re

from helpers import documents

from encore.llm import decontaminate, queries

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def told(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute(text, items):
    words = told(text)
    hit, found = set(), set()
    for item, t in items:
        own = told(t)
        width = min(10, len(own))
        windows = {tuple(own[i : i + width]) for i in range(len(own) - width + 1)} if own else set()
        for i in range(len(words) - width + 1) if own else ():
            if tuple(words[i : i + width]) in windows:
                hit |= set(range(i, i + width))
                found.update(() if item is None else (str(item),))
    return len(words), len(hit), sorted(found)


def test_query(spark, sf):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = queries.QUERIES["op9_decontamination"](spark, sf).collect()
    assert len(rows) == len(texts) and any(r.contaminated for r in rows)
    for r in rows:
        n, hit, found = brute(texts[r.doc_id], items)
        assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (n, hit, len(found), hit > 0)
        assert r.items_sha256 == hashlib.sha256(",".join(found).encode()).hexdigest()


def test_random_texts_in_one_and_in_several_rounds(spark):
    random.seed(1)
    some = lambda n: " ".join(random.choice(["a", "B", "c,", "É"]) for _ in range(n))
    items = [(i, some(random.choice([1, 3, 9, 10, 11, 14]))) for i in range(12)] + [(50, None), (51, ""), (52, "!!"), (1, "a a"), (None, "É É É a"), (None, "a B c É É B B B B B c")]
    texts = [some(random.randint(0, 60)) for _ in range(150)] + [None, "", "a" * 100_000, "A-B_c  " * 5_000]
    df = documents(spark, texts, "items spans n_hit")
    bench = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS doc_id")
    for most in (10_000, 20):
        got = sorted(decontaminate.decontaminate(df, bench, item_words=most).collect(), key=lambda r: r.doc_id)
        for r, t in zip(got, texts, strict=True):
            assert (r.n_words, r.n_hit, r["items"]) == brute(t, items), t
            assert sum(len(told(t[s.start : s.end])) for s in r.spans) == r.n_hit
            assert all(WORD.fullmatch(t[s.start].lower()) and WORD.fullmatch(t[s.end - 1].lower()) for s in r.spans)


def test_empty_tables(spark):
    df = documents(spark, ["a b", None])
    bench = spark.createDataFrame([], "item_id long, text string")
    assert [r.contaminated for r in decontaminate.decontaminate(df, bench).collect()] == [False, False]
    assert decontaminate.decontaminate(df.limit(0), bench).count() == 0
