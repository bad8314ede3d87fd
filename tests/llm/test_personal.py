"""Personal data against the rules as plain regular expressions."""

from __future__ import annotations

import functools
import hashlib
import random
import re
import time

import numpy as np
from helpers import documents

from encore.llm import boosting, personal, queries
from encore.llm.boosting import Trees


def plain(text):
    """(start, kind, end) by the rules, read literally."""
    text = text or ""
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m.group() if c.isdigit()][::-1]
        if 14 <= len(d) <= 19 and (sum(d[::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])) % 10 == 0:
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= sum(c.isdigit() for c in m.group()) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def test_base_spans_are_those_of_the_rules():
    random.seed(5)
    texts = ["".join(random.choice("a@.b1 +-2()0é") for _ in range(150)) for _ in range(3000)]
    texts += [".".join(str(random.randint(0, 300)) for _ in range(20)) for _ in range(300)]
    texts += ["a@b@c.d", "x@y.z@w.v", "@a.b", "a@b.", "1.2.3.4.5.6.7.8", "00000255.1.1.1", "1.2.3." + "0" * 3000 + "4", "4111 1111-1111 1111", "4111  1111", "+1 (2", ""]
    for t in texts:
        assert personal.base_spans(t) == plain(t), t


def test_long_texts_take_linear_time():
    began = time.time()
    for t in ("a" * 300_000, "1" * 300_000, "+1" * 100_000, "a@" * 100_000, "1." * 100_000, "1.1.1." + "0" * 100_000, "(at)" * 50_000, "a@b.c " * 30_000):
        personal.candidates(t)
        assert len(personal.base_spans(t)) in (0, 1, 30_000, 25_000)
    assert time.time() - began < 60


def test_query_over_all_documents(spark, sf):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = queries.QUERIES["op2_personal"](spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = plain(texts[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == i for _, k, _ in base) for i in range(4)]
        told = [f"{personal.KINDS[k]}:{a}:{b}" for a, k, b in base]
        assert r.base_sha256 == hashlib.sha256(",".join(told).encode()).hexdigest()
        assert set(told) <= set(r.spans.split(",")) or not told


def test_edges(spark):
    texts = [None, "", "mail a.b@c.de!", "mail a.b@c.de!", "ip 1.2.3.4 and a@b.c", "é" * 5 + "x@y.z"]
    df = documents(spark, texts, "spans base n_email")
    rows = sorted(personal.find(df, redact="text").collect(), key=lambda r: r.doc_id)
    assert [r.text for r in rows] == [None, "", "mail <email>!", "mail <email>!", "ip <ip> and <email>", "é" * 5 + "<email>"]
    assert [r.spans for r in rows][:3] == ["", "", "email:5:13"]
    assert personal.find(df.limit(0)).count() == 0
    assert personal.learn(df.limit(0)) is None
    assert personal.learn(df.where("doc_id < 2")) is None


def test_trees_add_what_looks_alike(spark):
    """Addresses with a blank before their sign match no rule; the trees find them by form and context."""
    random.seed(2)
    name = lambda: "".join(random.choice("abcdefgh") for _ in range(6))
    texts = [f"please write to {name()}.{i}@{name()}.example.com or call {random.randint(10**6, 10**7)} about {i}.{i % 7}.{i % 5}" for i in range(400)]
    docs = documents(spark, [*texts, "please write to someone.7 @ mail.example.com soon"])
    detector = personal.learn(docs)
    (base, every), = personal.spans(["please write to someone.7 @ mail.example.com soon"], detector)
    assert base == [] and len(every) <= 1
    found = personal.spans(texts, detector)
    assert all(set(b) <= set(e) for b, e in found)


def test_trees_learn():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(2000, 4))
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] > 0)).astype(float)
    p = Trees().fit(x[:1000], y[:1000]).chance(x[1000:])
    assert ((p > 0.5) == y[1000:]).mean() > 0.95


def test_loose_forms_are_added_and_look_alikes_are_not(spark):
    random.seed(4)
    word = lambda: "".join(random.choice("abcdefgh") for _ in range(6))
    digits = lambda n: "".join(random.choice("0123456789") for _ in range(n))
    cards = ["4111 1111 1111 1111", "5500-0000-0000-0004", "4012888888881881", "378282246310005", "6011000990139424"]
    forms = [
        lambda: f"{word()}.{digits(2)}@{word()}.example.com", lambda: ".".join(str(random.randint(1, 255)) for _ in range(4)),
        lambda: random.choice(cards), lambda: f"+{random.choice(['1', '49'])} ({random.randint(200, 999)}) 555-{digits(4)}",
    ]
    docs = documents(spark, [f"{word()} {word()} {forms[i % 4]()} {word()} {word()}. {word()}" for i in range(1600)])
    detector = personal.learn(docs)
    loose = {
        "john (at) example (dot) com": "email", "john @ example.com": "email", "(555) 123-4567": "phone", "0049 30 5551234": "phone",
        "2001:db8:85a3:8d3:1319:8a2e:370:7348": "ip", "10 . 20 . 30 . 40": "ip", "4111.1111.1111.1111": "card",
    }
    clean = ["2024-01-15 10:30:22", "15.01.2024", "1,234,567,890", "ORD-2024-001234", "v2.10.3.4711", "978-3-16-148410-0", "#4500012345", "12 @ 4.50"]
    texts = [f"abc defg {s} hab cde. Gfe" for s in [*loose, *clean]]
    told = [[(personal.KINDS[k], t[a:b]) for a, k, b in every] for t, (_, every) in zip(texts, personal.spans(texts, detector), strict=True)]
    assert all(not base for base, _ in personal.spans(texts, detector))
    assert told == [*([(kind, s)] for s, kind in loose.items()), *([] for _ in clean)]


def test_trees_of_sums_are_the_trees_of_all_rows(spark):
    rng = np.random.default_rng(5)
    x = rng.integers(0, 9, (3000, 4)).astype(float)
    y = ((x[:, 0] > 4) ^ (x[:, 1] > 2) | (rng.random(3000) < 0.05)).astype(float)
    here = boosting.Trees(rounds=12, depth=3).fit(x, y)
    blocks = spark.sparkContext.parallelize([(boosting.coded(x[i::7], here.cuts), y[i::7]) for i in range(7)], 3)
    parts = boosting.Trees(rounds=12, depth=3).fit_parts(blocks, here.cuts)
    assert np.abs(here.chance(x) - parts.chance(x)).max() < 1e-6


class Parts(list):
    """Rows in parts, as the trees use them, in this process."""

    def map(self, f):
        return Parts([f(b) for b in part] for part in self)

    def mapPartitions(self, f):
        return Parts(list(f(iter(part))) for part in self)

    def treeReduce(self, f, depth=2):
        return functools.reduce(f, [b for part in self for b in part])

    def getNumPartitions(self):
        return len(self)

    def persist(self, *_):
        return self

    unpersist = persist


def test_trees_sum_up_few_lines_of_few_rows(monkeypatch):
    """Features of few bins are summed up together, and of two nodes with one parent only the smaller."""
    rng = np.random.default_rng(6)
    x = np.concatenate([rng.integers(0, 2, (3000, 8)), rng.integers(0, 9, (3000, 2)), rng.integers(0, 1, (3000, 1))], 1).astype(float)
    y = ((x[:, 8] > 4) ^ (x[:, 1] > 0) | (rng.random(3000) < 0.05)).astype(float)
    here = Trees(rounds=12, depth=4).fit(x, y)
    blocks = Parts([(boosting.coded(x[i::7], here.cuts), y[i::7])] for i in range(7))
    summed, count = [], np.bincount
    monkeypatch.setattr(np, "bincount", lambda codes, *a, **b: summed.append(len(codes)) or count(codes, *a, **b))
    parts = Trees(rounds=12, depth=4).fit_parts(blocks, here.cuts)
    assert np.abs(here.chance(x) - parts.chance(x)).max() < 1e-6
    assert sum(summed) <= 3 * 3000 * 12 * 3 * (1 + 3 / 2)  # three sums of three lines, of all rows and then of half of them


def test_features_of_shared_lines_come_apart():
    rng = np.random.default_rng(7)
    assert boosting.Lines([1, 1]).joined(np.zeros((2, 3), np.uint8)).tolist() == [[0, 0, 0]]
    bins = [1, 256, 2, 32, 9, 8, 3, 1, 2, 2, 2, 17, 5]
    code = np.stack([rng.integers(0, b, 500) for b in bins]).astype(np.uint8)
    lines = boosting.Lines(bins)
    joined = lines.joined(code)
    assert len(joined) < len(bins) - 5 and max(lines.size) <= 256
    sums = lines.apart([np.bincount(line, minlength=size)[None] for line, size in zip(joined, lines.size, strict=True)])
    for j, b in enumerate(bins):
        assert sums[0, j].tolist() == np.bincount(code[j], minlength=256).tolist()
        for place in range(b):
            assert (lines.above(j, place)[joined[lines.spot[j][0]]] == (code[j] > place)).all()


def test_long_numbers_take_linear_time():
    began = time.time()
    for t in ("1" * 300_000 + ".", "." + "1" * 300_000, "1.2." + "3" * 300_000 + "." + "4" * 300_000 + ".x"):
        assert personal.base_spans(t) == []
    assert time.time() - began < 20


def test_all_documents_are_learned_from(spark, monkeypatch):
    """Look-alikes and loose forms of every document count, also when there are too many for one place."""
    docs = spark.range(400).selectExpr("concat('write to user', id, '@mail', id % 7, '.example.org or call +4930', 1234567 + id * 13, ' today') AS text")
    monkeypatch.setattr(personal, "SHAPE", {"rounds": 12, "depth": 3})
    together = personal.learn(docs)
    monkeypatch.setattr(personal, "TOGETHER", 100)
    seen, count = [], boosting.Trees.fit_parts
    monkeypatch.setattr(boosting.Trees, "fit_parts", lambda self, blocks, cuts: seen.append(blocks.map(lambda b: len(b[1])).sum()) or count(self, blocks, cuts))
    apart = personal.learn(docs)
    fits = [t for (t,) in docs.where("xxhash64(text) & 1 = 0").collect()]
    assert seen == [sum(len(personal._taught(t)) for t in fits)]
    text = "reach me at someone (at) mail3.example.org please"
    assert personal.spans([text], apart)[0][1] == personal.spans([text], together)[0][1]
