"""Near-duplicate vectors against all pairs."""

from __future__ import annotations

import numpy as np
import pytest
from helpers import Union

from encore.llm import embeddings, queries

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, cosine=0.95):
    good = {}
    for i, v in rows:
        if v and None not in v and np.isfinite(v).all() and any(v):
            x = np.array(v, np.float32).astype(float)
            good.setdefault(len(v), []).append((i, x / np.sqrt((x * x).sum())))
    links, union = dict.fromkeys((i for i, _ in rows), 0), Union(i for i, _ in rows)
    for some in good.values():
        x = np.array([v for _, v in some])
        for a, b in zip(*np.nonzero(x @ x.T >= cosine), strict=True):
            if a != b:
                links[some[a][0]] += 1
                union.link(some[a][0], some[b][0])
    return {i: (links[i], union.root(i), union.root(i) == i) for i in links}


def test_matches_all_pairs(spark, sf):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    rng, n = np.random.default_rng(3), len(rows)
    base = np.array(rows[0][1])
    rows += [(n + i, (base + rng.normal(0, 0.02, len(base))).tolist()) for i in range(150)]  # a large group of near copies
    rows += [(2 * n + i, rows[1][1]) for i in range(50)]  # and of copies
    odd = [None, [], [0.0] * 64, [float("nan")] + [1.0] * 63, [None] + [1.0] * 63, [1.0, 2.0], [2.0, 4.0], [float("inf")] * 64]
    rows += [(3 * n + i, v) for i, v in enumerate([*odd, [2 * x for x in rows[0][1]]])]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).selectExpr("*", "1 AS n_links", "2 AS id")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embeddings.near_duplicates(df, block=64).collect()}
    assert got == brute(rows)


def test_empty_table(spark):
    assert embeddings.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
    only = spark.createDataFrame([(5, None, 0), (None, [1.0, 0.0], 1), (None, [1.0, 0.0], 1)], SCHEMA)
    assert sorted((r.vec_id or -1, r.n_links, r.component_id or -1) for r in embeddings.near_duplicates(only).collect()) == [
        (-1, 0, -1), (-1, 0, -1), (5, 0, 5),
    ]


def test_bounds_lose_nothing():
    """Whatever the data, both bounds keep every pair within the radius when the whole radius is probed."""
    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, 10)) + 2 * rng.normal(size=(6, 10)).repeat(100, 0)
    x /= np.sqrt((x * x).sum(1))[:, None]
    index = embeddings.Index(x[::3], 12, 0.95, margin=1.0)
    home, code, error = index.encode(x)
    probes = index.probes(x)
    found = set()
    for at in range(len(index.centre)):
        own, asking = np.flatnonzero(home == at), [i for i in range(len(x)) if at in probes[i]]
        for i, near in zip(asking, index.search(x[asking], at, code[own], error[own], x[own]), strict=True):
            found |= {(i, int(own[j])) for j in near}
    assert found == {(a, b) for a, b in zip(*np.nonzero(x @ x.T >= 0.95), strict=True)}


def test_recall_with_many_lists(spark, sf):
    """The probed share finds at least nine in ten links, counts them on both sides, and adds none."""
    rng = np.random.default_rng(4)
    base = np.array([r.embedding for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()][:200])
    noise = rng.normal(0, 1, (5, *base.shape))
    near = base + 0.3 * noise / np.sqrt((noise**2).sum(-1, keepdims=True)) * rng.random((5, len(base), 1))
    rows = [(i, v.tolist()) for i, v in enumerate(np.vstack((base, near.reshape(-1, base.shape[1]))))]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    got = {r.vec_id: r.n_links for r in embeddings.near_duplicates(df, per_list=12, block=100).collect()}
    expected = {i: x[0] for i, x in brute(rows).items()}
    assert sum(got.values()) >= 0.9 * sum(expected.values()) > 0 and sum(got.values()) % 2 == 0
    assert all(got[i] <= expected[i] for i in got)


@pytest.mark.parametrize("columns", [["vec_id", "n_links", "component_id", "kept"]])
def test_query(spark, sf, columns):
    df = queries.QUERIES["op1_embeddings"](spark, sf)
    assert df.columns == columns
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in df.collect()} == brute(rows)


def test_ids_that_different_vectors_share(spark):
    """Rows of one id are judged each by its own vector; the id is in the component of each."""
    rows = [(5, [1.0, 0.0]), (5, [0.0, 1.0]), (6, [1.0, 0.01]), (7, [0.01, 1.0]), (3, [-1.0, 0.0]), (5, [-1.0, 0.01]), (9, [0.0, -1.0])]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    got = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in embeddings.near_duplicates(df).collect())
    assert got == sorted([(5, 1, 5, True), (6, 1, 5, False), (5, 1, 5, True), (7, 1, 5, False), (3, 1, 3, True), (5, 1, 3, False), (9, 0, 9, True)])
