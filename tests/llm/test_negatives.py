"""Hard negatives against all rows."""

from __future__ import annotations

import itertools
import math
from collections import Counter

import numpy as np
import pytest
from compare import oracle_connection

from encore.llm import negatives, queries

SCHEMA = "vec_id long, embedding array<float>, label int"
NAMES = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def brute(rows, anchors=50, positives=5, keep=3) -> Counter:
    good = [
        (i, label, [math.floor(256 * x) for x in v]) for i, v, label in rows
        if None not in (i, v, label) and all(x is not None and math.isfinite(x) for x in v)
    ]
    out: Counter = Counter()
    for i, label, v in good:
        if i % anchors:
            continue
        scores = sorted((-max(-negatives.FAR, min(negatives.FAR, sum(a * b for a, b in zip(v, w, strict=True)))), j, k) for j, k, w in good if len(w) == len(v))
        for less, j, _ in [s for s in scores if s[2] == label and s[1] != i][:positives]:
            fit = [s for s in scores if s[2] != label and 50 * -less <= 100 * -s[0] <= 95 * -less]
            for rank, (fewer, n, _) in enumerate(fit[:keep], 1):
                out[i, j, rank, n, -less, -fewer] += 1
    return out


def mined(df, **how) -> Counter:
    return Counter(tuple(r) for r in negatives.mine(df, "vec_id % 50 = 0", **how).select(NAMES).collect())


@pytest.mark.parametrize("dims, bits", [(1, 4), (2, 3), (3, 2), (4, 2), (5, 1)])
def test_curve_visits_neighbours_in_turn(dims, bits):
    cells = np.array(list(itertools.product(range(2**bits), repeat=dims)))
    keys = negatives.hilbert(cells, bits)
    order = sorted(range(len(cells)), key=lambda i: keys[i].tobytes())
    assert len({k.tobytes() for k in keys}) == len(cells)
    steps = np.abs(np.diff(cells[order], axis=0)).sum(1)
    assert (steps == 1).all()


def test_bounds_hold_every_score():
    rng = np.random.default_rng(5)
    for _ in range(50):
        x, y = rng.integers(-300, 300, (7, 6)).astype(float), rng.integers(-300, 300, (9, 6)).astype(float)
        zero = np.zeros((7, 1), np.int64)
        search = negatives.Search(zero[:, 0], zero[:, 0], zero[:, 0], x, zero, zero, 3, True, [(zero[:0, 0],) * 3])
        lower, upper = search.bounds(y.min(0)[None], y.max(0)[None])
        scores = negatives.products(x, y)
        assert (lower[:, 0] <= scores.min(1)).all() and (scores.max(1) <= upper[:, 0]).all()


def test_products_are_exact():
    a, b = np.array([[2.0**52, 1.0], [3e9, -7.0]]), np.array([[2.0**52, 1.0], [3e9, 5.0]])
    whole = [[int(x) * int(y) + int(p) * int(q) for y, q in b.tolist()] for x, p in a.tolist()]
    assert negatives.products(a, b).tolist() == [[max(-negatives.FAR, min(negatives.FAR, w)) for w in r] for r in whole]


@pytest.mark.parametrize("kind", ["random", "clusters", "ties"])
def test_matches_all_rows(spark, kind):
    rng = np.random.default_rng(8)
    n = 1500
    if kind == "random":
        x = rng.normal(size=(n, 12))
    elif kind == "clusters":
        x = rng.normal(size=(30, 12)).repeat(50, 0) + rng.normal(0, 0.1, (n, 12))
    else:
        x = rng.integers(-1, 2, (n, 4)).astype(float)  # few different vectors, so that most scores are ties
        x[: n // 3] = [1, 1, 0, 1]
    label = rng.integers(0, 4, n)
    rows = [(int(i), [float(np.float32(c)) for c in v], int(k)) for i, v, k in zip(rng.permutation(n), x, label, strict=True)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5).selectExpr("*", "1 AS row", "2 AS page", "'x' AS who")
    got = mined(df, block=16, page=8, chunk=7)
    assert got == brute(rows) and got


def test_reads_fewer_blocks_of_clustered_rows(spark, monkeypatch):
    rng = np.random.default_rng(2)
    x = 3 * rng.normal(size=(64, 8)).repeat(64, 0) + rng.normal(0, 0.05, (4096, 8))
    rows = [(i, v.tolist(), i % 3) for i, v in enumerate(x)]
    seen = {}
    keep = negatives.saved

    def watch(df, purpose):
        out = keep(df, purpose)
        if purpose == "chosen":
            seen.setdefault("read", []).append(sum(len(r.blocks) * r.n for r in out.select("blocks", "n").collect()))
        return out

    monkeypatch.setattr(negatives, "saved", watch)
    got = mined(spark.createDataFrame(rows, SCHEMA), block=32, page=16, chunk=1)
    assert got == brute([(i, [float(np.float32(c)) for c in v], k) for i, v, k in rows])
    anchors = len([i for i, *_ in rows if i % 50 == 0])
    assert seen["read"][1] < 0.3 * anchors * 128  # positives, of all blocks of all anchors


def test_odd_rows(spark):
    """Nulls, other lengths, empty vectors, repeated rows, ids shared by different rows, components of any size."""
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=5).astype(np.float32).tolist(), i % 3) for i in range(150)]
    rows += [(50, rows[3][1], 1), (50, *rows[50][1:]), (7, *rows[7][1:]), (8, rows[9][1], 0)]
    rows += [(200, None, 1), (None, rows[1][1], 1), (201, rows[1][1], None), (250, [float("nan")] + [1.0] * 4, 1), (300, [None] + [1.0] * 4, 1)]
    rows += [(350, [], 1), (351, [], 1), (352, [], 2), (400, [1.0, 2.0], 0), (401, [2.0, 4.0], 0), (402, [1.0, 2.0], 1), (403, [float("inf")] * 5, 0)]
    rows += [(450, [1e30, 0.0, 1.0], 0), (451, [1e30, 1.0, 1.0], 0), (452, [-1e20, 3.0, 1.0], 1), (453, [1e8, 2.0, 1.0], 1)]
    rows = [(i, v if v is None else [c if c is None else float(np.float32(c)) for c in v], k) for i, v, k in rows]
    df = spark.createDataFrame(rows, SCHEMA)
    assert mined(df, block=8) == brute(rows)
    assert mined(df.withColumn("embedding", df["embedding"].cast("array<double>")), block=8) == brute(rows)
    assert mined(df.limit(0)) == Counter()
    assert mined(df.where("label is null")) == Counter()


def test_query_matches_sql(spark, sf):
    expected = oracle_connection(sf).execute(f"SELECT {', '.join(NAMES)} FROM ({queries.ORACLE['op11_negatives']})").fetchall()
    rows = [tuple(r) for r in queries.op11_negatives(spark, sf).select(NAMES).collect()]
    assert sorted(rows) == sorted(expected) and rows
