"""Hard negatives: candidates in Parquet blocks along a Hilbert curve, each with a zone map of every dimension.

A block's least and greatest components bound by interval arithmetic the inner product of any of its rows with an anchor.
A window of scores reads only the blocks whose bounds reach into it; what the anchor's own page of blocks holds tells
first how good a row must be. Bounds and scores are whole numbers, so nothing is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from encore.llm.common import map_batches, saved, slices

#: Rows of a block, blocks of a page at most, anchors of a chunk, chunks that meet a page in one task.
BLOCK, PAGE, CHUNK, SLOT = 256, 1024, 512, 256
#: Rows on which the curve's scale is fitted, bits of its key, dimensions it winds through.
SAMPLE, BITS, DIMENSIONS = 4096, 128, 64
#: Beyond any score.
FAR = np.iinfo(np.int64).max


def pack(x: np.ndarray) -> bytes:
    """Whole numbers in two bytes each if they fit, else as doubles."""
    return x.astype("<i2" if np.abs(x).max(initial=0) <= 32767 else "<f8").tobytes()


def unpack(data: bytes, rows: int, size: int) -> np.ndarray:
    if not rows * size:
        return np.zeros((rows, size))
    return np.frombuffer(data, "<i2" if len(data) == 2 * rows * size else "<f8").astype(float).reshape(rows, size)


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """The place of each row of ``cells`` (whole numbers below ``2 ** bits``) on the Hilbert curve, as bytes that sort.

    Per bit, from the highest: turn and mirror the rest of the cell as the curve does there; then take the Gray code.
    """
    x = cells.astype(np.uint32).T.copy()
    for level in range(bits - 1, 0, -1):
        bit, low = np.uint32(1 << level), np.uint32((1 << level) - 1)
        for i in range(len(x)):
            mirrored = (x[i] & bit) != 0
            swapped = np.where(mirrored, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(mirrored, low, swapped)
            x[i] ^= swapped
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    turned = np.zeros(x.shape[1], np.uint32)
    for level in range(bits - 1, 0, -1):
        turned ^= np.where((x[-1] & np.uint32(1 << level)) != 0, np.uint32((1 << level) - 1), np.uint32(0)) if len(x) else 0
    x ^= turned
    out = [(x >> np.uint32(level)) & 1 for level in range(bits - 1, -1, -1)]
    return np.packbits(np.concatenate(out).T.astype(np.uint8), axis=1) if len(x) else np.zeros((len(cells), 1), np.uint8)


@dataclass
class Curve:
    """Scales of the dimensions that spread most, for vectors of one length."""

    used: np.ndarray
    middle: np.ndarray
    spread: np.ndarray
    bits: int

    @classmethod
    def fit(cls, sample: np.ndarray) -> Curve:
        spread = sample.std(0) if len(sample) else np.zeros(sample.shape[1])
        used = np.argsort(-spread, kind="stable")[:DIMENSIONS]
        middle = sample[:, used].mean(0) if len(sample) else np.zeros(len(used))
        return cls(used, middle, np.maximum(spread[used], 1.0), max(1, min(8, BITS // max(1, len(used)))))

    def keys(self, x: np.ndarray) -> np.ndarray:
        """Cells as wide as a spread or less, from two spreads below the middle to two above."""
        most = 2**self.bits
        cells = np.floor(((x[:, self.used] - self.middle) / self.spread + 2) * (most / 4))
        return hilbert(np.clip(cells, 0, most - 1), self.bits)


def _rows(vectors: DataFrame) -> DataFrame:
    """Rows that take part: ``row`` (a number), ``id``, ``label``, ``anchor``, ``d`` (length) and ``v`` (whole numbers)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in slices(batches):
            out: dict[str, list] = {c: [] for c in ("row", "id", "label", "anchor", "d", "v")}
            column = batch.column("v")
            ends, values = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False).astype(float)
            told = zip(column.is_valid().to_pylist(), *(batch.column(c).to_pylist() for c in ("row", "id", "label", "anchor")), strict=True)
            for i, (here, *rest) in enumerate(told):
                v = values[ends[i] : ends[i + 1]]
                if here and np.isfinite(v).all():  # a null component reads as not a number
                    for name, value in zip(out, (*rest, len(v), pack(np.floor(256 * v))), strict=True):
                        out[name].append(value)
            yield out

    return map_batches(vectors, "row long, id long, label long, anchor boolean, d int, v binary", run)


def _curves(rows: DataFrame, count: int) -> dict[int, Curve]:
    """A curve for every length of vectors in a bounded sample."""
    share = int(min(1.0, 1.5 * SAMPLE / max(count, 1)) * 1_000_000) + 1
    some = rows.where(F.pmod(F.xxhash64("row"), F.lit(1_000_000)) < share).select("d", "v").limit(SAMPLE).collect()
    lengths: dict[int, list] = {}
    for r in some:
        lengths.setdefault(r.d, []).append(unpack(r.v, 1, r.d))
    return {d: Curve.fit(np.concatenate(x)) for d, x in lengths.items()}


_BLOCK = (
    "page long, block int, d int, n int, row binary, id binary, label binary, anchor binary, v binary, "
    "lo binary, hi binary, least long, kinds array<long>"
)


def _blocks(rows: DataFrame, block: int, page: int) -> DataFrame:
    """The rows in blocks along the curve, ``page`` blocks a page, with their zone maps."""

    def made(some: list[tuple], place: int, number: int, d: int) -> dict:
        row, ids, label, anchor, v = zip(*some, strict=True)
        x = np.concatenate([unpack(b, 1, d) for b in v])
        return {
            "page": [place], "block": [number], "d": [d], "n": [len(some)], "row": [np.array(row, "<i8").tobytes()],
            "id": [np.array(ids, "<i8").tobytes()], "label": [np.array(label, "<i8").tobytes()],
            "anchor": [np.array(anchor, np.uint8).tobytes()], "v": [pack(x)], "lo": [pack(x.min(0))], "hi": [pack(x.max(0))],
            "least": [min(ids)], "kinds": [sorted(set(label))],
        }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        base, number, last, some = TaskContext.get().partitionId() << 32, 0, None, []
        first = 0  # the number of the page's first block; a page holds vectors of one length
        for batch in slices(batches):
            for d, *one in zip(*(batch.column(c).to_pylist() for c in ("d", "row", "id", "label", "anchor", "v")), strict=True):
                if some and (d != last or len(some) == block):
                    yield made(some, base + first, number, last)
                    number, some = number + 1, []
                    if d != last or number - first == page:
                        first = number
                last = d
                some.append(tuple(one))
        if some:
            yield made(some, base + first, number, last)

    order = ["d", "key", "row"]
    return map_batches(rows.repartitionByRange(*order).sortWithinPartitions(*order), _BLOCK, run)


_CHUNK = "chunk long, no long, d int, n int, who binary, id binary, label binary, v binary, low binary, high binary, score binary, found binary"


def _chunks(blocks: DataFrame, size: int) -> DataFrame:
    """The anchors of each page's blocks, ``size`` together, with one window that holds every score."""

    def made(number: int, no: int, d: int, some: list) -> dict:
        who, ids, label, x = (np.concatenate(c) for c in zip(*some, strict=True))
        n = len(who)
        return {
            "chunk": [number], "no": [no], "d": [d], "n": [n], "who": [who.tobytes()], "id": [ids.tobytes()], "label": [label.tobytes()],
            "v": [pack(x)], "low": [np.full(n, -FAR).tobytes()], "high": [np.full(n, FAR).tobytes()], "score": [b""], "found": [b""],
        }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        number, last, some, held = TaskContext.get().partitionId() << 32, None, [], 0
        for batch in batches:
            for b in batch.to_pylist():
                if held and ((b["no"], b["d"]) != last or held >= size):
                    yield made(number, *last, some)
                    number, some, held = number + 1, [], 0
                last = (b["no"], b["d"])
                mine = np.frombuffer(b["anchor"], np.uint8).astype(bool)
                if mine.any():
                    held += int(mine.sum())
                    some.append([np.frombuffer(b[c], "<i8")[mine] for c in ("row", "id", "label")] + [unpack(b["v"], b["n"], b["d"])[mine]])
        if held:
            yield made(number, *last, some)

    return map_batches(blocks.select("no", "d", "n", "row", "id", "label", "anchor", "v"), _CHUNK, run)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, exactly; those beyond a long are its ends."""
    if _safe(a, b):
        return (a @ b.T).astype(np.int64)
    whole = np.array([[int(x) for x in row] for row in a], object).reshape(a.shape) @ np.array([[int(x) for x in row] for row in b], object).reshape(b.shape).T
    return np.array([[max(-FAR, min(FAR, x)) for x in row] for row in whole], np.int64).reshape(len(a), len(b))


def _safe(*parts: np.ndarray) -> bool:
    """Whether doubles hold the inner products of the first part's rows with the others' exactly."""
    peak = [float(np.abs(p).max(initial=0)) for p in parts]
    return peak[0] * max(peak[1:]) * max(1, parts[0].shape[1]) < 2**53


@dataclass
class Search:
    """Anchors with windows, and the best rows of each window so far (highest score, then smallest id)."""

    who: np.ndarray
    ids: np.ndarray
    label: np.ndarray
    x: np.ndarray
    low: np.ndarray  # anchors x windows
    high: np.ndarray
    keep: int
    same: bool
    best: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)  # anchor, score, id of each window

    @classmethod
    def of(cls, chunk: dict, keep: int, same: bool) -> Search:
        n = chunk["n"]
        long = {c: np.frombuffer(chunk[c], "<i8") for c in ("who", "id", "label", "low", "high", "score", "found")}
        low, high = long["low"].reshape(n, -1), long["high"].reshape(n, -1)
        found, score = (long[c].reshape(n, low.shape[1], -1) if len(long[c]) else np.zeros((n, low.shape[1], 0), "<i8") for c in ("found", "score"))
        best = []
        for w in range(low.shape[1]):
            a, at = np.nonzero(score[:, w] > -FAR)
            best.append((a, score[a, w, at], found[a, w, at]))
        return cls(long["who"], long["id"], long["label"], unpack(chunk["v"], n, chunk["d"]), low, high, keep, same, best)

    def packed(self) -> dict[str, bytes]:
        """The best rows as columns of a chunk."""
        score, found = np.full((2, len(self.who), self.low.shape[1], self.keep), -FAR)
        for w, (a, s, i) in enumerate(self.best):
            at = np.arange(len(a)) - np.searchsorted(a, a)
            score[a, w, at], found[a, w, at] = s, i
        return {"score": score.tobytes(), "found": found.tobytes()}

    def bars(self) -> tuple[np.ndarray, np.ndarray]:
        """The score that a row must reach in each window, and the id it must be below if it only reaches it."""
        bar, tie = self.low.copy(), np.full(self.low.shape, FAR)
        for w, (a, s, i) in enumerate(self.best):
            full = np.flatnonzero(np.arange(len(a)) - np.searchsorted(a, a) == self.keep - 1)
            bar[a[full], w], tie[a[full], w] = s[full], i[full]
        return bar, tie

    def bounds(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The least and the greatest score that a row of each block can have with each anchor."""
        if not _safe(self.x, lo, hi):
            return np.full((len(self.x), len(lo)), -float(FAR)), np.full((len(self.x), len(lo)), float(FAR))
        up, down = np.maximum(self.x, 0), np.minimum(self.x, 0)
        return up @ lo.T + down @ hi.T, up @ hi.T + down @ lo.T

    def needs(self, lower: np.ndarray, upper: np.ndarray, least: np.ndarray, kinds: np.ndarray) -> np.ndarray:
        """Which blocks each anchor's windows must read. ``kinds``: whether a block has a label that the anchor looks for."""
        bar, tie = self.bars()
        need = np.zeros(upper.shape, bool)
        for w in range(bar.shape[1]):
            reach = (upper > bar[:, w : w + 1]) | ((upper == bar[:, w : w + 1]) & (least[None, :] < tie[:, w : w + 1]))
            need |= reach & (lower <= self.high[:, w : w + 1])
        return need & kinds

    def kinds(self, labels: list[list[int]]) -> np.ndarray:
        if self.same:
            return np.array([np.isin(self.label, k) for k in labels]).reshape(len(labels), -1).T
        return np.array([np.full(len(self.label), True) if len(k) > 1 else self.label != k[0] for k in labels]).reshape(len(labels), -1).T

    def read(self, some: np.ndarray, ids: np.ndarray, label: np.ndarray, x: np.ndarray) -> None:
        """Take the rows of a block into account for the anchors ``some``."""
        scores = products(self.x[some], x)
        good = (self.label[some][:, None] == label[None, :]) == self.same
        if self.same:
            good &= self.ids[some][:, None] != ids[None, :]
        bar, _ = self.bars()
        for w, (a, s, i) in enumerate(self.best):
            r, c = np.nonzero(good & (scores >= bar[some, w : w + 1]) & (scores <= self.high[some, w : w + 1]))
            if len(r):
                a, s, i = np.concatenate([a, some[r]]), np.concatenate([s, scores[r, c]]), np.concatenate([i, ids[c]])
                order = np.lexsort((i, -s, a))
                a, s, i = a[order], s[order], i[order]
                top = np.arange(len(a)) - np.searchsorted(a, a) < self.keep
                self.best[w] = a[top], s[top], i[top]


def _zones(rows: list[dict], d: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[list[int]]]:
    lo, hi = (np.concatenate([unpack(r[c], 1, d) for r in rows]) for c in ("lo", "hi"))
    return lo, hi, np.array([r["least"] for r in rows], np.int64), [list(r["kinds"]) for r in rows]


def _meet(blocks: DataFrame, asked: DataFrame, slots: int, keep: int, same: bool, home: bool) -> DataFrame:
    """Every chunk of ``asked`` reads the blocks it must of the page ``(d, no)`` it asks.

    At home it comes back with the best rows it has; from elsewhere come rows ``chunk``, ``who``, ``w``, ``score``, ``found``
    that are better than what it had.
    """
    zones = blocks.groupBy("d", "no").agg(F.collect_list(F.struct("block", "lo", "hi", "least", "kinds")).alias("zones"))
    chunk = _CHUNK + ", blocks array<int>"

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for at in range(batch.num_rows):
                one = batch.slice(at, 1).to_pylist()[0]
                search, told = Search.of(one, keep, same), one.pop("zones")
                lo, hi, least, labels = _zones(told, one["d"])
                need = search.needs(*search.bounds(lo, hi), least, search.kinds(labels)).any(0)
                if need.any():
                    yield {**{k: [v] for k, v in one.items()}, "blocks": [[z["block"] for z, n in zip(told, need, strict=True) if n]]}

    chosen = map_batches(asked.join(zones, ["d", "no"]), chunk, choose)
    chosen = saved(chosen.withColumn("slot", F.pmod(F.xxhash64("chunk"), F.lit(slots))), "chosen")
    wanted = chosen.select("d", "no", F.explode("blocks").alias("block"), F.col("slot").alias("part")).distinct()
    sent = blocks.select("d", "no", "block", "n", "id", "label", "v", "lo", "hi", "least", "kinds").join(wanted, ["d", "no", "block"])

    def read(frame: pd.DataFrame, asks: pd.DataFrame) -> pd.DataFrame:
        rows = frame.to_dict("records")
        out: list[dict] = []
        if rows:
            d = int(rows[0]["d"])
            lo, hi, least, labels = _zones(rows, d)
            place = {int(r["block"]): at for at, r in enumerate(rows)}
        for one in asks.to_dict("records"):
            search = Search.of(one, keep, same)
            had = [set(zip(a.tolist(), s.tolist(), i.tolist(), strict=True)) for a, s, i in search.best]
            mine = np.array([place[b] for b in one["blocks"]], int)
            lower, upper = search.bounds(lo[mine], hi[mine])
            kinds, some_least = search.kinds([labels[m] for m in mine]), least[mine]
            for at in np.argsort(-upper.max(0), kind="stable"):
                cut = slice(at, at + 1)
                need = np.flatnonzero(search.needs(lower[:, cut], upper[:, cut], some_least[cut], kinds[:, cut])[:, 0])
                if len(need):
                    r = rows[mine[at]]
                    n = int(r["n"])
                    search.read(need, np.frombuffer(r["id"], "<i8"), np.frombuffer(r["label"], "<i8"), unpack(r["v"], n, d))
            if home:
                out.append({k: one[k] for k in asks.columns if k not in ("blocks", "slot")} | search.packed())
                continue
            for w, (a, s, i) in enumerate(search.best):
                fresh = [t for t in zip(a.tolist(), s.tolist(), i.tolist(), strict=True) if t not in had[w]]
                out += [{"chunk": one["chunk"], "who": int(search.who[t[0]]), "w": w, "score": t[1], "found": t[2]} for t in fresh]
        return pd.DataFrame(out, columns=names)

    schema = _CHUNK if home else _FOUND
    names = [part.split()[0] for part in schema.split(", ")]
    return sent.groupBy("d", "no", "part").cogroup(chosen.groupBy("d", "no", "slot")).applyInPandas(read, schema)


_FOUND = "chunk long, who long, w int, score long, found long"


def _told(chunks: DataFrame, keep: int, same: bool) -> DataFrame:
    """The best rows that chunks carry."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for one in batch.to_pylist():
                search = Search.of(one, keep, same)
                for w, (a, s, i) in enumerate(search.best):
                    yield {"chunk": [one["chunk"]] * len(a), "who": search.who[a].tolist(), "w": [w] * len(a), "score": s.tolist(), "found": i.tolist()}

    return map_batches(chunks, _FOUND, run)


def _search(blocks: DataFrame, pages: DataFrame, chunks: DataFrame, keep: int, same: bool) -> DataFrame:
    """The first ``keep`` rows of every window: ``chunk``, ``who``, ``w``, ``score``, ``found``, ``rank``."""
    slots = max(1, -(-chunks.count() // SLOT))
    first = saved(_meet(blocks, chunks, slots, keep, same, home=True), "first")
    # A page that no window needs sends nothing back; its chunks go on with nothing found.
    first = first.unionByName(chunks.join(first.select("chunk"), "chunk", "left_anti"))
    first = saved(first, "first")
    asked = first.join(pages.groupBy("d").agg(F.max("no").alias("last")), "d").withColumnRenamed("no", "own")
    asked = asked.withColumn("no", F.explode(F.sequence(F.lit(0).cast("long"), "last"))).where("no <> own").drop("own", "last")
    found = _meet(blocks, asked, slots, keep, same, home=False).unionByName(_told(first, keep, same))
    order = Window.partitionBy("who", "w").orderBy(F.desc("score"), "found")
    return saved(found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= keep), "found")


def _windows(chunks: DataFrame, found: DataFrame, keep: int, low: int, high: int) -> DataFrame:
    """Chunks that look for scores from ``low`` to ``high`` percent of each score found."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            for one in batch.to_pylist():
                told = one.pop("told")
                at = {w: a for a, w in enumerate(np.frombuffer(one["who"], "<i8").tolist())}
                least, most = np.full((one["n"], keep), FAR), np.full((one["n"], keep), -FAR)  # empty windows
                for t in told:
                    least[at[t["who"]], t["rank"] - 1] = -(-low * t["score"] // 100)
                    most[at[t["who"]], t["rank"] - 1] = high * t["score"] // 100
                one |= {"low": least.tobytes(), "high": most.tobytes(), "score": b"", "found": b""}
                yield {k: [v] for k, v in one.items()}

    told = found.groupBy("chunk").agg(F.collect_list(F.struct("who", "rank", "score")).alias("told"))
    return map_batches(chunks.join(told, "chunk"), _CHUNK, run)


def mine(
    vectors: DataFrame, anchor: Column | str, vec_id: str = "vec_id", embedding: str = "embedding", label: Column | str = "label",
    positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, block: int = BLOCK, page: int | None = None, chunk: int = CHUNK,
) -> DataFrame:
    """Hard negatives of every anchor (a row where ``anchor`` is true) and each of its ``positives``.

    Components count as ``floor(256 * x)``; a row's score is its inner product with the anchor. An anchor's positives are
    the first rows of its label with other ids, by score from the highest, ties by smaller id. Its negatives for a positive
    are the first ``negatives`` rows of other labels whose score is at least ``low`` and at most ``high`` percent of the
    positive's: ``anchor_id``, ``positive_id``, ``rank`` (from 1), ``negative_id``, ``positive_score``, ``negative_score``.

    Rows with a null id, label or vector, or a null or non-finite component, take no part. Vectors meet those of their own
    length only; an empty vector scores 0. Repeated rows are rows of their own, so an anchor that is there twice is mined
    twice. Ids and labels are whole numbers; a score beyond a long counts as its end. Other columns are not read.
    """
    spark = vectors.sparkSession
    told = F.expr(anchor) if isinstance(anchor, str) else anchor
    mark = F.expr(label) if isinstance(label, str) else label
    kind = vectors.schema[embedding].dataType.elementType.simpleString()
    told = vectors.select(
        F.monotonically_increasing_id().alias("row"), F.col(vec_id).cast("long").alias("id"), mark.cast("long").alias("label"),
        F.coalesce(told, F.lit(False)).alias("anchor"), F.col(embedding).cast("array<float>" if kind == "float" else "array<double>").alias("v"),
    )
    rows = saved(_rows(told.where("id is not null and label is not null and v is not null")), "rows")
    count = rows.count()
    curves = spark.sparkContext.broadcast(_curves(rows, count))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in slices(batches):
            out = {c: batch.column(c).to_pylist() for c in ("row", "id", "label", "anchor", "d", "v")}
            length, key = np.array(out["d"], int), [b""] * batch.num_rows
            for d in set(out["d"]) & set(curves.value):
                at = np.flatnonzero(length == d)
                x = np.concatenate([unpack(out["v"][i], 1, d) for i in at])
                for i, k in zip(at.tolist(), curves.value[d].keys(x), strict=True):
                    key[i] = k.tobytes()
            yield out | {"key": key}

    placed = map_batches(rows, "row long, id long, label long, anchor boolean, d int, v binary, key binary", place)
    if page is None:  # so many pages that every core has some
        page = int(np.clip(-(-count // (block * 4 * spark.sparkContext.defaultParallelism)), 4, PAGE))
    blocks = saved(_blocks(placed, block, page), "blocks")
    numbers = Window.partitionBy("d").orderBy("page")
    pages = saved(blocks.select("d", "page").distinct().withColumn("no", (F.row_number().over(numbers) - 1).cast("long")), "pages")
    blocks = blocks.join(pages, ["d", "page"])
    chunks = saved(_chunks(blocks, chunk), "chunks")
    near = _search(blocks, pages, chunks, positives, same=True)
    far = _search(blocks, pages, saved(_windows(chunks, near, positives, low, high), "windows"), negatives, same=False)
    near = near.select("who", F.col("rank").alias("place"), F.col("found").alias("positive_id"), F.col("score").alias("positive_score"))
    far = far.select("who", (F.col("w") + 1).alias("place"), "rank", F.col("found").alias("negative_id"), F.col("score").alias("negative_score"))
    names = rows.where("anchor").select(F.col("row").alias("who"), F.col("id").alias("anchor_id"))
    out = far.join(near, ["who", "place"]).join(names, "who")
    return out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def oracle_sql(anchors: int = 50, moved: int = 7, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95) -> str:
    """The same over all rows, for DuckDB."""
    return f"""
WITH e AS (
  SELECT vec_id, row_number() OVER () AS r, CASE WHEN vec_id % {moved} = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.r, a.vec_id AS anchor, b.r AS s, b.vec_id AS id, a.label = b.label AS same,
    coalesce(list_dot_product(a.q, b.q), 0)::BIGINT AS score
  FROM e a JOIN e b ON a.vec_id % {anchors} = 0 AND len(a.q) = len(b.q)),
p AS (
  SELECT r, anchor, s, id, score FROM s WHERE same AND id <> anchor
  QUALIFY row_number() OVER (PARTITION BY r ORDER BY score DESC, id) <= {positives})
SELECT p.anchor AS anchor_id, p.id AS positive_id, row_number() OVER (PARTITION BY p.r, p.s ORDER BY s.score DESC, s.id)::INTEGER AS rank,
  s.id AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON p.r = s.r AND NOT s.same AND {low} * p.score <= 100 * s.score AND 100 * s.score <= {high} * p.score
QUALIFY rank <= {negatives}
"""
