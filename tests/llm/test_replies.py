"""Reply trees against plain walks, and what is read back against the rows."""

from __future__ import annotations

import hashlib
import random

import pytest
from compare import oracle_connection
from hypothesis import given, settings
from hypothesis import strategies as st

from encore.llm import queries, replies

MESSAGE = "tree string, id long, parent long, role string, text string, score double"
TURN = "conv_id long, turn long, role string, text string"


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from([*replies.CONTROL, *(c[0] + "\\" + c[1:] for c in replies.CONTROL), "<", "[", "\\", "\n", "SYS>>", "a", "é", "😀", "im_end|>"])))
def test_escaping_is_reversible(parts):
    text = "".join(parts)
    escaped = replies.escape(text)
    assert replies.unescape(escaped) == text
    assert not any(c in escaped for c in replies.CONTROL)
    formatted, start, end = replies.turn(text, text)
    assert replies.read(formatted * 2) == [(text, text)] * 2
    assert replies.unescape(formatted[start:end]) == text


def walk(rows, top):
    """(tree, rank) -> (score, messages) of the best branches, by walks up from every leaf."""
    best: dict = {}
    loose = []
    for tree, id, parent, role, text, score in rows:
        key = (-(score or 0.0), parent is not None, parent or 0, role is not None, role or "", text is not None, text or "")
        if id is None:
            loose.append((tree, id, parent, role, text, score))
        elif (tree, id) not in best or key < best[tree, id][0]:
            best[tree, id] = (key, (tree, id, parent, role, text, score))
    every = [row for _, row in best.values()] + loose
    there = {(r[0], r[1]): r for r in every if r[1] is not None}
    parents = {(r[0], r[2]) for r in every}
    found: dict = {}
    for leaf in every:
        if leaf[1] is not None and (leaf[0], leaf[1]) in parents:
            continue
        path = [leaf]
        while len(path) <= len(every) and path[-1][2] is not None and (path[-1][0], path[-1][2]) in there:
            path.append(there[path[-1][0], path[-1][2]])
        if len(path) <= len(every):
            found.setdefault(leaf[0], []).append((-sum(r[5] or 0 for r in path), leaf[1] is not None, leaf[1] or 0, path[::-1]))
    out = {}
    for tree, paths in found.items():
        for rank, (less, _, _, path) in enumerate(sorted(paths, key=lambda p: p[:3])[:top], 1):
            out[tree, rank] = (-less, [(r[3] or "", r[4] or "") for r in path])
    return out


def formatted(df):
    out: dict = {}
    for r in df.orderBy("part").collect():
        score, turns = out.setdefault((r.tree, r.branch), (r.score, []))
        here = replies.read(r.text)
        assert len(here) == r.n_turns
        said = [replies.unescape(r.text[s.start : s.end]) for s in r.loss]
        assert said == [text for role, text in here if role == "assistant"]
        turns += here
    return out


@pytest.mark.parametrize("top, turns, spread", [(1, 1024, 50_000), (3, 2, 5), (None, 4, 5)])
def test_matches_walks(spark, monkeypatch, top, turns, spread):
    """Random trees, one much larger, a parent with most replies, orphans, circles, repeated and missing ids."""
    monkeypatch.setattr(replies, "SPREAD", spread)
    rng = random.Random(7)
    rows = []
    for tree in ("a", "b", None, "c"):
        for i in range(60 if tree != "c" else 200):
            parent = rng.choice([None, 0, 0, i - 1, i - 1, i - 1, rng.randint(0, 400)]) if i else None
            rows.append((tree, i, None if parent == i else parent, rng.choice(["user", "assistant", None]), rng.choice(["x", "</s>", None, ""]) or None, float(rng.randint(-2, 2))))
    rows += [("a", i, 1000 + (i + 1) % 3, "user", "circle", 9.0) for i in (1000, 1001, 1002)] + [("a", 1003, 1001, "user", "below a circle", 1.0)]
    rows += rows[:20] + [("b", 7, 3, "user", "again", 0.5), ("b", None, 3, "user", "no id", None), ("d", 1, None, None, None, None)]
    df = spark.createDataFrame(rows, MESSAGE).selectExpr("*", "1 AS node", "2 AS at", "'x' AS path")
    assert formatted(replies.conversations(replies.messages(df), top, turns=turns)) == walk(rows, top)


def told(rows):
    """The digests of the query's contract."""
    convs: dict = {}
    for conv, turn, role, text in rows:
        mark = "" if text is None else hashlib.md5(text.encode()).hexdigest()
        convs.setdefault(conv, []).append(((turn is not None, turn or 0, role is not None, role or "", mark), role or "", text or ""))
    out = {}
    for conv, turns in convs.items():
        turns.sort()
        lost = "".join(t for _, r, t in turns if r == "assistant")
        every = "".join(f"{r}\n{t}\n" for _, r, t in turns)
        out[conv] = (len(turns), hashlib.sha256(every.encode()).hexdigest(), len(lost), hashlib.sha256(lost.encode()).hexdigest())
    return out


def test_chains_of_any_length(spark):
    """A conversation of most rows, over many parts; ties, gaps, null turns, roles, texts and ids; repeated rows."""
    rng = random.Random(3)
    rows = [(1, i, "user" if i % 2 else "assistant", f"text {i} </s>😀") for i in range(3000)]
    rows += [(2, rng.choice([None, 1, 5]), rng.choice(["user", "assistant", None]), rng.choice(["a", "b", None, ""]) or None) for _ in range(40)]
    rows += [(None, 1, "assistant", "no id"), (None, 0, "user", None), (3, 0, "line\nbreak\\", "x" * 100_000), (4, 0, "assistant", None)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, TURN).repartition(7).selectExpr("*", "1 AS id", "2 AS parent")
    made = replies.conversations(replies.chains(df), turns=64)
    assert made.where("tree = 1").count() == 47
    got = {r.tree: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in replies.digests(made).collect()}
    assert got == told(rows)


def test_empty(spark):
    none = spark.createDataFrame([], TURN)
    assert replies.digests(replies.conversations(replies.chains(none))).count() == 0
    assert replies.conversations(replies.messages(spark.createDataFrame([], MESSAGE), score=None)).count() == 0


def test_query_matches_sql(spark, sf):
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    expected = oracle_connection(sf).execute(f"SELECT {', '.join(names)} FROM ({queries.ORACLE['op12_replies']})").fetchall()
    rows = [tuple(r) for r in queries.op12_replies(spark, sf).select(names).collect()]
    assert sorted(rows) == sorted(expected) and len(rows) > 1
    assert (-1, 2) in {r[:2] for r in rows}
