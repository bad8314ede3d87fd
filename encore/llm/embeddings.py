"""Near-duplicate vectors by product quantisation: coarse lists, residual codes, table-lookup distances, exact rerank.

Equal vectors are first made one class. Every class lies in the list of its nearest centroid, as a code of the residual
together with the code's exact error. A query goes to the lists whose cells come within a share of the radius: the distance
to the plane between two centroids tells, and by the whole radius no link can be lost; a near vector that differs in no
particular direction moves towards any one plane by a fraction of that, so a smaller share finds practically all, and the
recall is measured against all pairs. There it goes to every member whose table-lookup distance is within the radius plus
that member's error, which loses nothing (triangle inequality); what passes is compared by exact cosine. Lists meet their queries in blocks of bounded size, and a block gives counts and a spanning forest, never its pairs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.llm.common import components, map_batches, saved

#: Vectors to a list on average, lists at most, and vectors that the index is fitted on (32 to a list, and at least SAMPLE).
PER_LIST, LISTS, SAMPLE = 256, 4096, 16_384
#: Subspaces and codewords of each; members and queries of a block.
SUBSPACES, CODEWORDS = 8, 256
#: Share of the radius within which a cell is probed; 1 loses nothing.
MARGIN = 0.5
BLOCK = 2048
#: Queries whose distances are looked up together, and pairs that are compared together.
ASKED, PAIRS = 256, 20_000
ROUNDS = 8


def means(x: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """Lloyd's centroids; an empty one stays where it was."""
    centre = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(ROUNDS):
        home = nearest(x, centre)
        n = np.bincount(home, minlength=len(centre))
        total = np.zeros_like(centre)
        np.add.at(total, home, x)
        centre[n > 0] = total[n > 0] / n[n > 0, None]
    return centre


def _distances(x: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] + (centre * centre).sum(1) - 2 * x @ centre.T, 0)


def nearest(x: np.ndarray, centre: np.ndarray) -> np.ndarray:
    out = [_distances(x[a : a + 1024], centre).argmin(1) for a in range(0, len(x), 1024)]
    return np.concatenate(out) if out else np.zeros(0, int)


class Index:
    """Centroids and codebooks, fitted on a sample of unit vectors."""

    def __init__(self, sample: np.ndarray, lists: int, cosine: float, margin: float = MARGIN, seed: int = 5) -> None:
        rng = np.random.default_rng(seed)
        self.cosine, self.margin = cosine, margin
        self.radius = float(np.sqrt(2 - 2 * cosine)) + 1e-6
        self.centre = means(sample, lists, rng)
        self.apart = np.sqrt(_distances(self.centre, self.centre))
        left = sample - self.centre[nearest(sample, self.centre)]
        self.cuts = np.array_split(np.arange(sample.shape[1]), min(SUBSPACES, sample.shape[1]))
        self.books = [means(left[:, c], CODEWORDS, rng) for c in self.cuts]

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The list, the code and the code's error of each vector."""
        home = nearest(x, self.centre)
        left = x - self.centre[home]
        code = np.stack([nearest(left[:, c], b) for c, b in zip(self.cuts, self.books, strict=True)], 1)
        told = np.hstack([b[code[:, i]] for i, b in enumerate(self.books)])
        return home, code.astype(np.uint8), np.sqrt(((left - told) ** 2).sum(1))

    def probes(self, x: np.ndarray) -> list[np.ndarray]:
        """The lists whose cells come near enough to each vector; its own among them."""
        out = []
        for a in range(0, len(x), 1024):
            d = _distances(x[a : a + 1024], self.centre)
            home = d.argmin(1)
            near = d - d[np.arange(len(d)), home][:, None] <= 2 * self.margin * self.radius * self.apart[home] + 1e-9
            out += [np.flatnonzero(row) for row in near]
        return out

    def asks(self, x: np.ndarray, home: int, at: int) -> np.ndarray:
        """Whether vectors of list ``home`` probe list ``at``."""
        d = _distances(x, self.centre[[home, at]])
        return d[:, 1] - d[:, 0] <= 2 * self.margin * self.radius * self.apart[home, at] + 1e-9

    def search(self, queries: np.ndarray, at: int, code: np.ndarray, error: np.ndarray, members: np.ndarray) -> Iterator[np.ndarray]:
        """For each query the members of list ``at`` with cosine enough: table look-ups, then exact."""
        left = queries - self.centre[at]
        most = (self.radius + error) ** 2 + 1e-6
        tables = [_distances(left[:, c], b) for c, b in zip(self.cuts, self.books, strict=True)]
        for start in range(0, len(queries), ASKED):
            some = slice(start, start + ASKED)
            far = sum(t[some][:, code[:, m]] for m, t in enumerate(tables))
            asking, near = np.nonzero(far <= most)
            exact = [
                (members[near[a : a + PAIRS]] * queries[start + asking[a : a + PAIRS]]).sum(1) for a in range(0, len(near), PAIRS)
            ]
            good = np.concatenate(exact) >= self.cosine if exact else np.zeros(0, bool)
            asking, near = asking[good], near[good]
            yield from np.split(near, np.searchsorted(asking, np.arange(1, len(queries[some]))))


def unit(data: list[bytes]) -> np.ndarray:
    """Rows of float32 bytes as unit vectors in double precision."""
    x = np.frombuffer(b"".join(data), "<f4").astype(float).reshape(len(data), -1)
    return x / np.sqrt((x * x).sum(1))[:, None]


def _vectors(rows: DataFrame) -> DataFrame:
    """``id``, and for vectors that can link ``key`` (a digest), ``v`` (float32 bytes) and ``d`` (length)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            key, vectors, size = [], [], []
            column = batch.column("v")
            ends, values = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False).astype("<f4") + np.float32(0)
            for i, here in enumerate(column.is_valid().to_pylist()):
                v = values[ends[i] : ends[i + 1]] if here else values[:0]
                good = len(v) > 0 and np.isfinite(v).all() and v.any()  # a null component reads as not a number
                data = v.tobytes() if good else None
                key.append(hashlib.blake2b(data, digest_size=16).digest() if good else None)
                vectors.append(data)
                size.append(len(v) if good else None)
            yield {"id": batch.column("id").to_pylist(), "key": key, "v": vectors, "d": size}

    return map_batches(rows, "id long, key binary, v binary, d int", run)


def _forest(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """The links that a spanning forest needs."""
    up: dict[int, int] = {}

    def root(x: int) -> int:
        while (y := up.setdefault(x, x)) != x:
            up[x] = up[y]
            x = up[x]
        return x

    out = []
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        p, q = root(x), root(y)
        if p != q:
            up[p] = q
            out.append((x, y))
    return out


def _meet(classes: DataFrame, n: int, cosine: float, margin: float, per_list: int, block: int) -> DataFrame:
    """``id``, ``links`` (rows linked through a block) and ``b`` (a linked class, for the components)."""
    spark = classes.sparkSession
    lists = int(min(LISTS, max(1, n // per_list)))
    most = max(SAMPLE, 32 * lists)
    part = classes.where(F.pmod(F.xxhash64("key"), F.lit(1_000_000)) < int(min(1.0, 1.5 * most / n) * 1_000_000))
    sample = unit([r.v for r in part.select("v").limit(most).collect()] or [r.v for r in classes.select("v").limit(most).collect()])
    shared = spark.sparkContext.broadcast(Index(sample, lists, cosine, margin))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            v = batch.column("v").to_pylist()
            if not v:
                continue
            x = unit(v)
            home, code, error = shared.value.encode(x)
            yield {
                "id": batch.column("id").to_pylist(), "w": batch.column("w").to_pylist(), "v": v, "list": home.tolist(),
                "code": [c.tobytes() for c in code], "error": error.tolist(), "probes": [p.tolist() for p in shared.value.probes(x)],
            }

    coded = map_batches(
        classes.select("id", "w", "v"), "id long, w long, v binary, list int, code binary, error double, probes array<int>", encode
    )
    coded = saved(coded, "codes")
    # Blocks of members by a hash, so that lists of any length are spread; and blocks of queries likewise.
    members = coded.groupBy("list").agg(F.count("*").alias("n")).select("list", F.ceil(F.col("n") / block).alias("mb"))
    asked = coded.select(F.explode("probes").alias("list")).groupBy("list").agg(F.count("*").alias("n"))
    asked = asked.select("list", F.ceil(F.col("n") / block).alias("qb"))
    plan = saved(members.join(asked, "list"), "lists")  # one row a list, LISTS at most
    spot = F.xxhash64("id")
    side = coded.join(F.broadcast(plan), "list").withColumn("m", F.pmod(spot, F.col("mb")))
    side = side.withColumn("q", F.explode(F.sequence(F.lit(0).cast("long"), F.col("qb") - 1)))
    side = side.select("list", "m", "q", F.lit(True).alias("member"), "id", "w", "v", F.col("list").alias("home"), "code", "error")
    ask = coded.select("id", "w", "v", F.col("list").alias("home"), F.explode("probes").alias("list")).join(F.broadcast(plan), "list")
    ask = ask.withColumn("q", F.pmod(spot, F.col("qb"))).withColumn("m", F.explode(F.sequence(F.lit(0).cast("long"), F.col("mb") - 1)))
    ask = ask.select("list", "m", "q", F.lit(False).alias("member"), "id", "w", "v", "home", F.lit(None).cast("binary").alias("code"), F.lit(0.0).alias("error"))

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        own, queries = frame[frame["member"]], frame[~frame["member"]]
        if not len(own) or not len(queries):
            return pd.DataFrame({"id": [], "links": [], "b": []}).astype("int64")
        index = shared.value
        code = np.frombuffer(b"".join(own["code"]), np.uint8).reshape(len(own), -1)
        ids, weight, members = own["id"].to_numpy(), own["w"].to_numpy(), unit(own["v"].tolist())
        at = int(frame["list"].iloc[0])
        asking, a, b, some = queries["id"].to_numpy(), [], [], []
        found = index.search(unit(queries["v"].tolist()), at, code, own["error"].to_numpy(), members)
        for i, w, home, near in zip(asking.tolist(), queries["w"].tolist(), queries["home"].tolist(), found, strict=True):
            near = near[ids[near] != i]
            if not len(near):
                continue
            some.append((i, int(weight[near].sum()), i))
            if home != at:  # members that do not ask back learn of the link here
                some += [(int(ids[y]), w, int(ids[y])) for y in near[~index.asks(members[near], at, home)]]
            a.append(np.full(len(near), i))
            b.append(ids[near])
        some += [(x, 0, y) for x, y in _forest(np.concatenate(a), np.concatenate(b))] if a else []
        return pd.DataFrame(some, columns=["id", "links", "b"]).astype("int64")

    return side.unionAll(ask).groupBy("list", "m", "q").applyInPandas(run, "id long, links long, b long")


def near_duplicates(
    vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", cosine: float = 0.95, margin: float = MARGIN,
    per_list: int = PER_LIST, block: int = BLOCK,
) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` and ``kept`` of every row of ``vectors``, whatever its other columns.

    Two rows are linked if the cosine of their vectors, in double precision, is at least ``cosine``; vectors of different
    lengths never are. Null, empty and zero vectors and such with null or non-finite components are linked with nothing.
    ``n_links`` counts the other rows linked directly; ``component_id`` is the smallest id that links reach; ``kept`` marks
    the row of that id. Equal vectors are one class throughout, which has a number of its own, as rows of different vectors may share
    an id. The index is fitted on at most 32 vectors a list (and
    ``SAMPLE`` at least); all are indexed and searched. Ids are whole numbers.
    """
    rows = saved(_vectors(vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(embedding).cast("array<float>").alias("v"))), "vectors")
    whole = rows.where("key is not null and id is not null")
    classes = whole.groupBy("key", "d").agg(F.min("id").alias("least"), F.count("*").alias("w"), F.first("v").alias("v"))
    # Numbers in the order of the classes' least ids, so the least number that links reach has the least id.
    placed = classes.repartitionByRange("least", "key").sortWithinPartitions("least", "key")
    classes = saved(placed.withColumn("id", F.monotonically_increasing_id()), "classes")
    sizes = classes.groupBy("d").agg(F.count("*").alias("n")).collect()  # one row for each length of vectors
    met = None
    for size in sizes:
        one = _meet(classes.where(F.col("d") == size.d), size.n, cosine, margin, per_list, block)
        met = one if met is None else met.unionAll(one)
    own = classes.select("key", F.col("id").alias("class"), "w", "least")
    if met is None:
        found = own.select("key", F.lit(0).cast("long").alias("n_links"), F.col("least").alias("component_id"))
    else:
        met = saved(met, "met")
        count = met.groupBy("id").agg(F.sum("links").alias("links"))
        roots = components(met.where("id <> b"), "id", "b")
        found = own.join(count, own["class"] == count["id"], "left").join(roots, F.col("class") == F.col("node"), "left")
        names = classes.select(F.col("id").alias("named"), F.col("least").alias("first"))
        found = found.join(names, F.col("root") == F.col("named"), "left").select(
            "key", (F.col("w") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("first", "least").alias("component_id")
        )
    out = rows.select("id", "key").join(found, "key", "left")
    out = out.select(
        F.col("id").alias("vec_id"), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id"),
    )
    return out.withColumn("kept", F.col("vec_id") == F.col("component_id"))
