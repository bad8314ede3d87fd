"""Spelling variants against all pairs of words."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest
from compare import oracle_connection
from helpers import crc, documents

from encore.llm import queries, variants

RUNS = re.compile("[A-Za-zÀ-ÿ]+")


def near(a: str, b: str) -> bool:
    """Whether two words differ by one code point inserted, deleted or replaced."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute(texts: dict, shortest=5, least=3, every=None) -> set:
    n: Counter = Counter()
    for key, text in texts:
        for run in RUNS.findall(text or ""):
            word = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = crc(f"{'' if key is None else key}:{word}")
            if every and h % every == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            n[word] += 1
    n = {w: k for w, k in n.items() if len(w) >= shortest and k >= least}
    told = {}
    for w in n:
        others = sorted((-n[v], v) for v in n if near(w, v))
        told[w] = (others[0][1] if others and -others[0][0] >= 2 * n[w] else None, len(others))

    def root(w):
        while told[w][0]:
            w = told[w][0]
        return w

    return {(w, f, root(w), n[w], k, n[f] if f else None) for w, (f, k) in told.items()}


def got(df) -> set:
    rows = df.select("word", "form", "root", "n", "n_near", "form_n").collect()
    assert len(rows) == len({r.word for r in rows})
    return {tuple(r) for r in rows}


@pytest.mark.parametrize("seed", [1, 2])
def test_matches_all_pairs(spark, seed):
    """Short alphabets, so that letters repeat and ties abound."""
    rng = random.Random(seed)
    texts = [" ".join("".join(rng.choices("aAbÀà", k=rng.randint(4, 8))) for _ in range(300)) for _ in range(12)]
    texts += [texts[0], None, "", "!? 123"]
    docs = documents(spark, texts, clash="word n id prefix form")
    expected = brute(list(enumerate(texts)), least=2, every=7)
    assert got(variants.variants(docs, least=2, every=7)) == expected
    assert any(f for _, f, *_ in expected) and any(f and f != r for _, f, r, *_ in expected)


def test_rotations_tell_neighbours(monkeypatch):
    """Two words share a prefix exactly if they are near, and a deletion is told once, in every form of prefix."""
    rng = random.Random(2)
    words = sorted({"".join(rng.choices("abc", k=rng.randint(3, 6))) for _ in range(200)})
    for plain in (64, 4, 0):
        monkeypatch.setattr(variants, "PLAIN", plain)
        met: Counter = Counter()
        places: dict = {}
        for w in words:
            for prefix, whole, first in variants.rotations(w):
                places.setdefault(prefix, []).append((w, whole, first))
        for group in places.values():
            for i, (a, whole, first) in enumerate(group):
                for b, other, second in group[i + 1 :]:
                    if a != b and (second if whole else first if other else True):
                        met[frozenset((a, b))] += 1
        assert met == Counter({frozenset((a, b)): 1 for a in words for b in words if a < b and near(a, b)})


def test_long_words(spark):
    """Runs of many thousand letters, near each other and near words at the limit of plain rotations."""
    rng = random.Random(4)
    long = "".join(rng.choices("abcdefgh", k=20_000))
    edge = "".join(rng.choices("abc", k=64))
    words = [long, long[:777] + "z" + long[778:], long[:9] + long[10:], edge, edge + "é", edge[:5] + "x" + edge[5:], edge[1:], edge[:-1] + "ÿ"]
    texts = [" ".join([w] * (3 + 4 * (i % 3))) for i, w in enumerate(words)]
    docs = documents(spark, texts)
    assert got(variants.variants(docs)) == brute(list(enumerate(texts)))


def test_nulls_and_empty(spark):
    docs = spark.createDataFrame([(None, "hello hello hello hallo"), (None, None), (3, "")], "doc_id long, text string")
    assert got(variants.variants(docs)) == {("hello", None, "hello", 3, 0, None)}
    assert got(variants.variants(docs, least=1)) == {("hello", None, "hello", 3, 1, None), ("hallo", "hello", "hello", 1, 1, 3)}
    assert got(variants.variants(docs, least=1, every=1)) == brute([(None, "hello hello hello hallo")], least=1, every=1)
    assert got(variants.variants(docs.limit(0))) == set()


def test_letters_beyond_ascii_keep_their_case(spark):
    docs = documents(spark, ["ÀÉCOLE Àécole àécole"] * 3)
    assert {w for w, *_ in got(variants.variants(docs))} == {"ÀÉcole", "Àécole", "àécole"}


def test_query_matches_sql(spark, sf):
    con = oracle_connection(sf)
    expected = con.execute(f"SELECT word, form, root, n, n_near, form_n FROM ({queries.ORACLE['op13_variants']})").fetchall()
    rows = got(queries.op13_variants(spark, sf))
    assert rows == set(expected) and len(rows) == len(expected) > 0
    texts = con.execute("SELECT doc_id, text FROM documents WHERE doc_id < 60").fetchall()
    some = spark.createDataFrame(texts, "doc_id long, text string")
    assert got(variants.variants(some, every=97)) == brute(texts, every=97)
