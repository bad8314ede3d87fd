"""Stupid-backoff scores of documents under a bigram model of the corpus, as one aggregation by hash.

Tables of n-gram counts are partitioned by a hash, the documents' exploded n-grams come to the same partitions, and what
they score there is summed up for each document. A pair goes to the partition of its first word, where the counts of both
lie. Words and pairs that hold a fixed share of the text are counted beforehand (they are few, by that share): pairs of
such words are spread by both words, and the most frequent pairs score where they stand and are never sent. Pairs that the
model has not seen go on, in a second round, to the partition of their second word. N-grams travel in columns, many to
a row.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyspark
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from encore.llm.common import LOWER, map_batches, saved

ALPHA = 0.4
#: Documents that tell which words and pairs may be frequent, and the shares that make them so: these bound their number.
SAMPLE, WORD_SHARE, PAIR_SHARE = 2000, 0.001, 0.0002
#: Tokens and documents that travel together, and tokens to a partition.
CHUNK, CHUNK_DOCUMENTS, PARTITION = 500_000, 30_000, 1_500_000
#: Numbers of the marks around a document; no text has their words.
START, END = (xxhash.xxh3_64_intdigest(x) for x in (b"\x00start", b"\x00end"))
_MASK = np.uint64((1 << 48) - 1)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 400_000:
            self.clear()
        made = self[word] = xxhash.xxh3_64_intdigest(word)
        return made


def _spread(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(33))


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return _spread(a * np.uint64(0x9E3779B97F4A7C15) ^ (b & _MASK))


class _Table:
    """Counts by hash; 0 for what it lacks."""

    def __init__(self, counts: dict[int, int]) -> None:
        self.keys = np.array(sorted(counts), np.uint64)
        self.values = np.array([counts[k] for k in sorted(counts)], float)

    def get(self, x: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(x))
        at = np.minimum(np.searchsorted(self.keys, x), len(self.keys) - 1)
        return np.where(self.keys[at] == x, self.values[at], 0.0)

    def has(self, x: np.ndarray) -> np.ndarray:
        return np.isin(x, self.keys)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Ids, whether learned from, token counts, first and second words of pairs and their documents, by chunk."""
    known = _Hashes()
    ids, learns, sizes, parts, tokens = [], [], [], [], 0

    def told() -> tuple:
        words = np.concatenate(parts)
        doc = np.repeat(np.arange(len(sizes)), np.array(sizes) + 2)
        inside = np.ones(len(words), bool)
        inside[np.cumsum(np.array(sizes) + 2) - 1] = False  # a pair does not begin with the end
        first = np.flatnonzero(inside)
        return ids, np.array(learns, bool), np.array(sizes), words[first], words[first + 1], doc[first]

    for batch in batches:
        for i, t, learn in zip(*(batch.column(c).to_pylist() for c in ("i", "t", "l")), strict=True):
            found = t.encode().translate(LOWER).split() if t else []
            words = np.empty(len(found) + 2, np.uint64)
            words[0], words[-1] = START, END
            words[1:-1] = np.fromiter(map(known.__getitem__, found), np.uint64, len(found))
            ids.append(i)
            learns.append(bool(learn))
            sizes.append(len(found))
            parts.append(words)
            tokens += len(words)
            if tokens >= CHUNK or len(ids) >= CHUNK_DOCUMENTS:
                yield told()
                ids, learns, sizes, parts, tokens = [], [], [], [], 0
    if ids:
        yield told()


def _counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(keys, return_counts=True)


def _frequent(rows: DataFrame, sample: int) -> tuple[set[int], set[int]]:
    """Words and pairs that hold at least the shares in a sample; what they are decides how n-grams travel, not scores."""
    share = min(1.0, sample / max(rows.count(), 1))
    # A bounded sample is one task's work: its shares are those of the whole sample.
    part = rows.where(F.pmod(F.xxhash64("t"), F.lit(1_000_000)) < int(share * 1_000_000)).limit(2 * sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        seen: Counter = Counter()
        for _, _, _, a, b, _ in _chunks(batches):
            for kind, keys in ((0, a), (1, _pair(a, b))):
                keys, counts = _counted(keys)
                often = counts > WORD_SHARE * len(a) / 8 if kind == 0 else counts > PAIR_SHARE * len(a) / 8
                seen.update({(kind, int(k)): int(c) for k, c in zip(keys[often], counts[often], strict=True)})
            seen[2, 0] += len(a)
        yield {"kind": [k for k, _ in seen], "key": [np.uint64(k).astype(np.int64) for _, k in seen], "n": list(seen.values())}

    found = map_batches(part, "kind int, key long, n long", run).groupBy("kind", "key").agg(F.sum("n").alias("n"))
    total = found.where("kind = 2").agg(F.sum("n")).first()[0] or 0
    limit = F.when(F.col("kind") == 0, WORD_SHARE * total).when(F.col("kind") == 1, PAIR_SHARE * total)
    often = found.where(F.col("n") >= limit).collect()  # at most one over the share of each kind
    of = [{int(np.int64(r.key).astype(np.uint64)) for r in often if r.kind == k} for k in (0, 1)]
    return of[0] | {START, END}, of[1]


def _totals(rows: DataFrame, words: set[int], pairs: set[int]) -> tuple[_Table, _Table, int, int]:
    """Exact counts of the frequent words and pairs over what is learned from, its words and ends, and all tokens."""
    spark = rows.sparkSession
    shared = spark.sparkContext.broadcast((np.array(sorted(words), np.uint64), np.array(sorted(pairs), np.uint64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        seen: Counter = Counter()
        for _, learns, sizes, a, b, doc in _chunks(batches):
            seen[2, 0] += int(sizes.sum()) + len(sizes)
            use = learns[doc]
            a, b = a[use], b[use]
            seen[3, 0] += len(a)
            seen[0, END] += int(learns.sum())
            for kind, keys, often in ((0, a, shared.value[0]), (1, _pair(a, b), shared.value[1])):
                keys, counts = _counted(keys[np.isin(keys, often)])
                seen.update({(kind, int(k)): int(c) for k, c in zip(keys, counts, strict=True)})
        yield {"kind": [k for k, _ in seen], "key": [np.uint64(k).astype(np.int64) for _, k in seen], "n": list(seen.values())}

    counts: list[dict[int, int]] = [dict.fromkeys(words, 0), dict.fromkeys(pairs, 0), {}, {}]
    for r in map_batches(rows, "kind int, key long, n long", run).groupBy("kind", "key").agg(F.sum("n").alias("n")).toLocalIterator():
        counts[r.kind][int(np.int64(r.key).astype(np.uint64))] = r.n
    return _Table(counts[0]), _Table(counts[1]), sum(counts[3].values()), sum(counts[2].values())


def _log(x: np.ndarray) -> np.ndarray:
    return np.log(np.maximum(x, 1e-300))


def _sixes(x: np.ndarray) -> bytes:
    return x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _from_sixes(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return out.reshape(-1).view("<u8")


#: kind 0: a chunk's documents, with ids, which of them are there, lengths and what they score at once; 1: pairs of a chunk
#: in a partition, as first words and their runs, second words and documents; 2: sums for documents; 3: word counts;
#: 4: unseen pairs, as chunks and their runs, second words and documents.
_ROW = "kind int, part int, chunk long, first binary, runs binary, second binary, doc binary, sums binary"
_NAMES = [x.split()[0] for x in _ROW.split(", ")]


def _columns(rows: list[dict]) -> dict[str, list]:
    return {n: [r.get(n) for r in rows] for n in _NAMES}


def _frame(rows: list[dict]) -> pd.DataFrame:
    return pd.DataFrame(_columns(rows), columns=_NAMES)


def _sums(chunk: np.ndarray, doc: np.ndarray, value: np.ndarray) -> list[dict]:
    """What each chunk's documents score here."""
    out = []
    order = np.argsort(chunk, kind="stable")
    chunks, starts = np.unique(chunk[order], return_index=True)
    for key, at in zip(chunks.tolist(), np.split(order, starts[1:]), strict=False):
        docs, to = np.unique(doc[at], return_inverse=True)
        out.append({
            "kind": 2, "part": -1, "chunk": key, "doc": docs.astype("<u2").tobytes(),
            "sums": np.bincount(to, weights=value[at]).tobytes(),
        })
    return out


def score(
    docs: DataFrame, learn: Column | None = None, doc_id: str = "doc_id", text: str = "text", alpha: float = ALPHA,
    sample: int = SAMPLE, partition: int = PARTITION,
) -> DataFrame:
    """``doc_id``, ``n_tokens`` and ``log_score`` of every row of ``docs``.

    Words are runs without ASCII white space, A-Z in lower case; a document is its words between a start and an end mark.
    The model counts the rows where ``learn`` holds (default: all). A pair scores count(pair) / count(first word), or, if
    it was not counted, ``alpha`` times count(second word) / all words and ends, an uncounted word taken as counted once.
    ``log_score`` adds the logarithms over a row's pairs. Null and empty texts have one pair, of the marks, and 0 tokens.
    Rows are scored one by one, copies too; ids may be null or repeat. Ids are whole numbers. Without rows to learn from
    every pair backs off.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("long").alias("i"), F.col(text).alias("t"), (F.lit(True) if learn is None else learn).alias("l"))
    words, pairs, total, tokens = _totals(rows, *_frequent(rows, sample))
    parts = tokens // partition + 1
    short = _Table({int(k) & int(_MASK): int(n) for k, n in zip(words.keys, words.values, strict=True)})
    shared = spark.sparkContext.broadcast((words, pairs, short, max(total, 1)))

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        words, pairs, _, _ = shared.value
        chunk = pyspark.TaskContext.get().partitionId() << 32
        for ids, learns, sizes, a, b, doc in _chunks(batches):
            both = pairs.get(_pair(a, b))
            here = (both > 0) & words.has(a)  # frequent and counted: scores at once
            local = np.bincount(doc[here], weights=_log(both[here]) - _log(words.get(a[here])), minlength=len(sizes))
            out = [{
                "kind": 0, "part": -1, "chunk": chunk, "first": np.array([i or 0 for i in ids], "<i8").tobytes(),
                "runs": np.array([i is not None for i in ids], np.uint8).tobytes(), "second": sizes.astype("<i8").tobytes(),
                "sums": local.tobytes(),
            }]
            a, b, doc = a[~here], b[~here], doc[~here]
            part = (_spread(np.where(words.has(a), _pair(a, b), a & _MASK)) % np.uint64(parts)).astype(np.int64)
            order = np.lexsort((a, part))
            a, b, doc, part = a[order], b[order], (doc * 2 + learns[doc])[order].astype("<u2"), part[order]
            ends = np.searchsorted(part, np.arange(parts + 1))
            for p in np.flatnonzero(np.diff(ends)).tolist():
                x = a[ends[p] : ends[p + 1]]
                starts = np.flatnonzero(np.append(True, x[1:] != x[:-1]))
                out.append({
                    "kind": 1, "part": p, "chunk": chunk, "first": x[starts].astype("<u8").tobytes(),
                    "runs": np.diff(np.append(starts, len(x))).astype("<u4").tobytes(),
                    "second": _sixes(b[ends[p] : ends[p + 1]]), "doc": doc[ends[p] : ends[p + 1]].tobytes(),
                })
            yield _columns(out)
            chunk += 1

    def meet(frame: pd.DataFrame) -> pd.DataFrame:
        if frame["kind"].iloc[0] == 0:  # documents pass
            return frame[_NAMES]
        words, _, short, total = shared.value
        runs = [np.frombuffer(x, "<u4") for x in frame["runs"]]
        a = np.concatenate([np.repeat(np.frombuffer(f, "<u8"), r) for f, r in zip(frame["first"], runs, strict=True)])
        b = np.concatenate([_from_sixes(x) for x in frame["second"]])
        doc = np.concatenate([np.frombuffer(x, "<u2") for x in frame["doc"]])
        chunk = np.repeat(frame["chunk"].to_numpy(), [int(r.sum()) for r in runs])
        use, doc = (doc & 1) == 1, doc >> 1
        _, at = np.unique(_pair(a, b), return_inverse=True)
        both = np.bincount(at, weights=use)[at]
        firsts, at = np.unique(a, return_inverse=True)
        own = words.has(firsts)
        counts = np.where(own, words.get(firsts), np.bincount(at, weights=use))
        unseen = both == 0
        second = np.full(len(b), 1.0)
        second[unseen] = short.get(b[unseen])
        value = np.where(unseen, np.log(alpha) - np.log(total) + _log(np.maximum(second, 1)), _log(both) - _log(counts[at]))
        out = _sums(chunk, doc, value)
        rare = ~own & (counts > 0)
        out.append({
            "kind": 3, "part": int(frame["part"].iloc[0]), "chunk": -1, "first": (firsts[rare] & _MASK).astype("<u8").tobytes(),
            "sums": counts[rare].tobytes(),
        })
        left = np.flatnonzero(unseen & (second == 0))  # their second words are counted elsewhere
        to = (_spread(b[left]) % np.uint64(parts)).astype(np.int64)
        order = np.lexsort((chunk[left], to))
        left, to = left[order], to[order]
        for some in np.split(left, np.flatnonzero(np.diff(to)) + 1) if len(left) else ():
            of = chunk[some]
            starts = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
            out.append({
                "kind": 4, "part": int(_spread(b[some[:1]])[0] % np.uint64(parts)), "chunk": -1,
                "first": of[starts].astype("<i8").tobytes(), "runs": np.diff(np.append(starts, len(of))).astype("<u4").tobytes(),
                "second": _sixes(b[some]), "doc": doc[some].astype("<u2").tobytes(),
            })
        return _frame(out)

    def again(frame: pd.DataFrame) -> pd.DataFrame:
        tables, asked = frame[frame["kind"] == 3], frame[frame["kind"] == 4]
        if not len(asked):
            return _frame([])
        keys = np.concatenate([np.frombuffer(x, "<u8") for x in tables["first"]] or [np.zeros(0, "<u8")])
        counts = np.concatenate([np.frombuffer(x) for x in tables["sums"]] or [np.zeros(0)])
        table = _Table(dict(zip(keys.tolist(), counts.tolist(), strict=True)))
        b = np.concatenate([_from_sixes(x) for x in asked["second"]])
        doc = np.concatenate([np.frombuffer(x, "<u2") for x in asked["doc"]])
        chunk = np.concatenate([
            np.repeat(np.frombuffer(f, "<i8"), np.frombuffer(r, "<u4")) for f, r in zip(asked["first"], asked["runs"], strict=True)
        ])
        return _frame(_sums(chunk, doc, _log(np.maximum(table.get(b), 1))))

    sent = map_batches(rows, _ROW, explode)
    alone = F.when(F.col("kind") == 0, F.col("chunk")).otherwise(-1).alias("alone")
    met = saved(sent.groupBy("part", alone).applyInPandas(lambda frame: meet(frame), _ROW), "scores")
    backed = met.where("kind in (3, 4)").groupBy("part").applyInPandas(again, _ROW)

    def add(frame: pd.DataFrame) -> pd.DataFrame:
        of = frame[frame["kind"] == 0].iloc[0]
        sums = np.frombuffer(of["sums"]).copy()
        more = frame[frame["kind"] == 2]
        for docs, x in zip(more["doc"], more["sums"], strict=True):
            sums[np.frombuffer(docs, "<u2")] += np.frombuffer(x)
        ids = pd.array(np.frombuffer(of["first"], "<i8"), "Int64")
        ids[np.frombuffer(of["runs"], np.uint8) == 0] = pd.NA
        return pd.DataFrame({"doc_id": ids, "n_tokens": np.frombuffer(of["second"], "<i8"), "log_score": sums})

    scored = met.where("kind in (0, 2)").unionAll(backed)
    return scored.groupBy("chunk").applyInPandas(add, "doc_id long, n_tokens long, log_score double")
