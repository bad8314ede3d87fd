"""Quality classifier: random Fourier features of document statistics, ridge scores, isotonic calibration.

The kernel model is linear in its features, so it is fitted from sums: every partition adds up its own normal
equations, one set for each fold, and only those fixed-size sums reach the driver. Leaving a fold's sums out gives
scores for rows that a model has not seen, and on these the calibration is fitted.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from encore.llm.common import fresh, map_batches, map_rows, saved

#: Fixed parameters of the model.
FOURIER = 160
FOLDS = 4
RIDGE = 1e-3
BINS = 2000
SEED = 7
#: Documents with a lower score are rejected.
THRESHOLD = 0.3

_CLASSES = [
    b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ", b"\n\r", b"\t\x0b\x0c", b".", b",", b"!",
    b"?", b"|", b"$#%&*@^~", b"-_/\\=+<>", b"()[]{}", b"'\"`;:", bytes(range(128, 256)),
]
_OF = np.zeros((256, len(_CLASSES)))
for _i, _chars in enumerate(_CLASSES):
    _OF[list(_chars), _i] = 1
STATISTICS = len(_CLASSES) + 13


def statistics(text: str | None) -> np.ndarray:
    """Figures about the form of a whole text; null counts as empty."""
    data = (text or "").encode()
    n = len(data)
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    shares = counts / max(n, 1)
    seen = shares[shares > 0]
    words = data.split()
    distinct = set(words)
    lines = [x for x in data.split(b"\n") if x.strip()]
    k = max(len(words), 1)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1)
    low = data.lower()
    more = [
        np.log1p(n), np.log1p(len(words)), -(seen * np.log(seen)).sum() if n else 0.0, lengths.mean(), lengths.std(),
        np.log1p(lengths.max()), len(distinct) / k**0.8, len(set(lines)) / max(len(lines), 1), np.log1p(len(lines)),
        np.log1p(len(words) / max(len(lines), 1)), sum(w[:1].isupper() for w in distinct) / max(len(distinct), 1),
        len(set(low.split())) / max(len(distinct), 1), sum(map(eq, words, words[1:])) / k,
    ]
    return np.concatenate((np.sqrt(shares @ _OF), more))


def with_statistics(docs: DataFrame, text: str = "text", name: str = "statistics") -> DataFrame:
    return map_rows(
        docs, [text], f"{name} array<double>", lambda: lambda texts: {name: [statistics(t).tolist() for t in texts]}
    )


class Fourier:
    """Standardised statistics, and cosines that approximate a Gaussian kernel over them."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, size: int = FOURIER, width: float = 1.0) -> None:
        rng = np.random.default_rng(SEED)
        self.mean, self.scale = mean, scale
        self.w = rng.normal(0, 1 / (width * np.sqrt(len(mean))), (len(mean), size))
        self.b = rng.uniform(0, 2 * np.pi, size)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        x = np.clip((x - self.mean) / self.scale, -4, 4)
        z = np.cos(x @ self.w + self.b) * np.sqrt(2 / len(self.b))
        return np.hstack((np.ones((len(x), 1)), x / 4, z))


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.values).reshape(len(column), -1) if len(column) else np.zeros((0, STATISTICS))


class Model:
    """Ridge weights of the whole and of each fold left out, and the calibration."""

    def __init__(self, fourier: Fourier, weights: np.ndarray, left_out: np.ndarray) -> None:
        self.fourier, self.weights, self.left_out = fourier, weights, left_out
        self.x, self.y = np.array([0.0, 1.0]), np.array([0.0, 1.0])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.fourier(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(x), self.x, self.y)


def isotonic(x: np.ndarray, total: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: points of a rising line through bins at ``x`` with ``n`` rows that add up to ``total``."""
    blocks: list[list[float]] = []
    for a, s, k in zip(x, total, n, strict=True):
        blocks.append([a * k, s, k])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            b = blocks.pop()
            blocks[-1] = [p + q for p, q in zip(blocks[-1], b, strict=True)]
    return np.array([b[0] / b[2] for b in blocks]), np.array([b[1] / b[2] for b in blocks])


def _sums(part: DataFrame, fourier: Broadcast, groups: int) -> list[dict[int, np.ndarray]]:
    """The normal equations of each fold: partitions sum their rows, ``groups`` tasks sum the partitions."""

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            x, y, f = _matrix(b.column("s")), np.asarray(b.column("y")), np.asarray(b.column("f"))
            for at in range(0, len(x), 4096):
                z = np.hstack((fourier.value(x[at : at + 4096]), y[at : at + 4096, None], np.ones((len(y[at : at + 4096]), 1))))
                for k in np.unique(f[at : at + 4096]):
                    one = z[f[at : at + 4096] == k]
                    sums[int(k)] = sums.get(int(k), 0) + one.T @ one
        if sums:
            yield {"f": list(sums), "z": [s.tobytes() for s in sums.values()]}

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for k, z in zip(b.column("f").to_pylist(), b.column("z").to_pylist(), strict=True):
                sums[k] = sums.get(k, 0) + np.frombuffer(z)
        if sums:
            yield {"f": list(sums), "z": [s.tobytes() for s in sums.values()]}

    rows = map_batches(map_batches(part, "f int, z binary", first).repartition(groups), "f int, z binary", again)
    total: dict[int, np.ndarray] = {}
    for row in rows.toLocalIterator():
        z = np.frombuffer(row.z)
        d = int(round(len(z) ** 0.5))
        total[row.f] = total.get(row.f, 0) + z.reshape(d, d)
    return total


def _solve(z: np.ndarray) -> np.ndarray:
    """Ridge weights from the sums over (features, label, 1); the constant is not shrunk."""
    d = len(z) - 2
    penalty = np.full(d, RIDGE * max(z[-1, -1], 1.0))
    penalty[0] = 1e-9
    return np.linalg.solve(z[:d, :d] + np.diag(penalty), z[:d, d])


def fit(rows: DataFrame, label: str, statistics: str = "statistics", key: Column | None = None, groups: int = 16) -> Model | None:
    """A model of ``label`` (0 or 1; rows with another or none are left out) from statistics; None without rows.

    Folds go by a hash of ``key`` (default: the statistics, so that copies stay in one fold). Rows are only ever
    summed: two passes for mean and spread and for the normal equations, one for the calibration.
    """
    spark = rows.sparkSession
    key = F.col(statistics) if key is None else key
    part = rows.where(F.col(label).isin(0, 1)).select(
        F.col(statistics).alias("s"), F.col(label).cast("double").alias("y"),
        F.pmod(F.xxhash64(key), F.lit(FOLDS)).cast("int").alias("f"),
    )

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        n, a, b = 0, np.zeros(STATISTICS), np.zeros(STATISTICS)
        for batch in batches:
            x = _matrix(batch.column("s"))
            n, a, b = n + len(x), a + x.sum(0), b + (x * x).sum(0)
        yield {"k": list(range(STATISTICS)), "n": [n] * STATISTICS, "a": a.tolist(), "b": b.tolist()}

    found = map_batches(part, "k int, n long, a double, b double", moments).groupBy("k").sum("n", "a", "b").orderBy("k").collect()
    if not found or not found[0][1]:
        return None
    n, a, b = (np.array([r[i] for r in found], float) for i in (1, 2, 3))
    mean = a / n
    fourier = Fourier(mean, np.sqrt(np.maximum(b / n - mean**2, 0)) + 1e-6)
    total = _sums(part, spark.sparkContext.broadcast(fourier), groups)
    z = sum(total.values())
    weights = _solve(z)
    left_out = np.array([_solve(z - total[k]) if k in total and len(total) > 1 else weights for k in range(FOLDS)])
    model = Model(fourier, weights, left_out)
    shared = spark.sparkContext.broadcast(model)

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        n, total = np.zeros(BINS), np.zeros(BINS)
        for batch in batches:
            x, y, f = _matrix(batch.column("s")), np.asarray(batch.column("y")), np.asarray(batch.column("f"))
            raw = (shared.value.fourier(x) * shared.value.left_out[f]).sum(1) if len(x) else np.zeros(0)
            at = np.clip(((raw + 1) / 3 * BINS).astype(int), 0, BINS - 1)
            n += np.bincount(at, minlength=BINS)
            total += np.bincount(at, weights=y, minlength=BINS)
        full = np.flatnonzero(n)
        yield {"k": full.tolist(), "n": n[full].tolist(), "y": total[full].tolist()}

    bins = map_batches(part, "k int, n double, y double", binned).groupBy("k").sum("n", "y").orderBy("k").collect()
    k, n, y = (np.array([r[i] for r in bins], float) for i in range(3))
    # A row of either kind at the ends keeps scores off 0 and 1.
    x = np.concatenate(([-1.0], (k + 0.5) / BINS * 3 - 1, [2.0]))
    model.x, model.y = isotonic(x, np.concatenate(([0.0], y, [1.0])), np.concatenate(([1.0], n, [1.0])))
    return model


def score(rows: DataFrame, model: Model | None, statistics: str = "statistics", name: str = "score") -> DataFrame:
    """``rows`` with the calibrated score; without a model 0.5 for all."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def make():
        def work(lists):
            if not lists or shared.value is None:
                return {name: [0.5] * len(lists)}
            return {name: shared.value.score(np.array(lists)).tolist()}

        return work

    return map_rows(rows, [statistics], f"{name} double", make)


def classify(
    docs: DataFrame, labels: DataFrame, learn: Column, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
    keep: list[str] | None = None,
) -> DataFrame:
    """The columns ``keep`` (default: ``doc_id``) of every row of ``docs``, and ``score`` (0 to 1, the chance of label 1).

    The model sees statistics of whole texts only. It learns from rows where ``learn`` holds and the label table has
    0 or 1; null ids have no label, a repeated label counts as often as it stands. Null texts count as empty, and
    empty texts get a score like any other. Rows are scored one by one: copies get equal scores. Without any usable
    label every score is 0.5. Where texts are not kept, statistics are computed once and stored in the shared folder
    (a few hundred bytes a row); else the labelled rows' are computed a second time beside the texts.
    """
    learns, figures = fresh("learn"), fresh("statistics")
    keep = keep or [doc_id]
    rows = docs.select(*dict.fromkeys([*keep, doc_id, text]), learn.alias(learns))
    known = labels.select(F.col(doc_id).alias(doc_id), F.col(label).alias(label)).where(F.col(label).isNotNull())
    if text in keep:
        taught = with_statistics(rows.where(F.col(learns)).select(doc_id, text), text, figures).drop(text)
        part = saved(taught, "statistics")
        stored = with_statistics(rows, text, figures)
    else:
        stored = saved(with_statistics(rows, text, figures).drop(*{text} - set(keep)), "statistics")
        part = stored.where(F.col(learns))
    model = fit(part.select(doc_id, figures).join(known, doc_id), label, figures)
    return score(stored, model, figures).select(*keep, "score")
