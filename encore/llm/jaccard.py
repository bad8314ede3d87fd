"""N-gram Jaccard join over count vectors.

A text is its set of word shingles, kept as 64-bit hashes. The hashes are dealt into groups and the group counts are a
point; the sum of the coordinates' minima of two points bounds the sets' overlap from above, and so do a point and a
box. Sets are first made one per class of equal sets. Two similar sets differ in few shingles: dealt into one part more
than they can differ in, they have some part in common, so the join meets only sets that share a part. The points of sets
that share one become an R-tree, boxes that can hold similar sets are searched, and what survives is one group. The sets of a
group, in blocks of bounded size, are searched the same way and verified. A set that is reached already is not compared again,
so no group is multiplied out.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from encore.llm.common import LOWER, components, map_rows, saved

#: Groups of the count vector at least and at most, entries of a box, and shingles in a block of sets (a longer set is a
#: block).
GROUPS, MOST_GROUPS = 32, 512
#: Rows of a part, and rows of several parts, that a task searches at most, about.
MEMBERS, MET = 25_000, 20_000
NODE = 32
BLOCK = 2_000_000
#: Sizes of a band, as the ratio of its ends.
BAND = 1.6
#: Fixed size of the table by which texts are chosen that may be candidates.
MARKS = 1 << 20
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 200_000:
            self.clear()
        made = self[word] = xxhash.xxh3_64_intdigest(word)
        return made


def _spread(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingles(text: str | None, width: int, known: dict[bytes, int]) -> np.ndarray:
    """Sorted distinct hashes of ``width`` consecutive words (A-Z lower-cased, cut at ASCII white space).

    A text of fewer words has one shingle, all its words; a null text or one without words has none.
    """
    words = text.encode().translate(LOWER).split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    n = max(1, len(h) - width + 1)
    out = np.full(n, np.uint64(min(len(h), width)))
    for i in range(min(width, len(h))):
        out = _spread(out ^ (h[i : i + n] * _MIX[i % 3] + _MIX[(i + 1) % 3]))
    return np.unique(out)


class Threshold:
    """Similarity at least ``share`` percent, in whole numbers."""

    def __init__(self, percent: int) -> None:
        self.percent = percent

    def differ(self, size: int) -> int:
        """Shingles in one but not both, at most, of a set of ``size`` and a similar one that is no smaller."""
        union = size * 100 // self.percent
        return union - -(-self.percent * union // 100)

    def linked(self, both: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return 100 * both >= self.percent * (a + b - both)

    def bands(self, size: int) -> list[int]:
        """The bands that a set's parts are made for: its own, and those below where smaller similar sets may lie."""
        least = -(-self.percent * size // 100)
        return list(range(self.band(least), self.band(size) + 1))

    def band(self, size: int) -> int:
        return int(math.log(max(size, 1)) / math.log(BAND) + 1e-9)

    def parts(self, band: int) -> tuple[int, int]:
        """The shingles that two similar sets, the smaller one in the band, differ in at most; and the number of parts, which
        is larger by a few, as some parts are empty."""
        differ = self.differ(math.ceil(BAND ** (band + 1)))
        return differ, differ + 2 + differ // 30


def signatures(hashes: np.ndarray, threshold: Threshold) -> np.ndarray:
    """For each band and part, one number for the shingles that fall there.

    Similar sets agree in all parts but those that hold a shingle of one alone. A set leaves out its empty parts where it
    has so few that some full part must be among those that agree; of two similar sets that meet nowhere else, both
    have kept theirs.
    """
    out = []
    mixed = _spread(hashes * _MIX[0])
    for band in threshold.bands(len(hashes)):
        differ, k = threshold.parts(band)
        differ = min(differ, threshold.differ(len(hashes)))
        part = (mixed % np.uint64(k)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        start = np.searchsorted(part[order], np.arange(k))
        sums = np.add.reduceat(np.append(mixed[order] * _MIX[2] ^ (mixed[order] >> np.uint64(7)), np.uint64(0)), start)
        empty = np.append(start[1:], len(hashes)) == start
        sums[empty] = 0
        made = _spread(sums ^ _spread(np.arange(k, dtype=np.uint64) + np.uint64(band << 32) + np.uint64(1)))
        out.append(made[~empty] if empty.sum() < k - differ else made)
    return np.concatenate(out)


def counts(hashes: np.ndarray, groups: int = GROUPS) -> np.ndarray:
    """The point: how many hashes fall into each group."""
    return np.bincount((hashes >> np.uint64(40)).astype(np.int64) % groups, minlength=groups).astype(np.int32)


def _fitting(size: float) -> int:
    """About as many groups as a set has shingles, by eight: fewer bound the overlap loosely, more cost more than they tell."""
    groups = GROUPS
    while groups < MOST_GROUPS and groups * 8 < size:
        groups *= 2
    return groups


def _folded(points: list[np.ndarray]) -> np.ndarray:
    """Points of one number of groups: a larger number is a multiple, and its counts add up to those of the smaller."""
    groups = min(map(len, points))
    return np.array([p if len(p) == groups else p.reshape(-1, groups).sum(0) for p in points])


def _overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Of sorted sets, how much they share."""
    if len(a) > len(b):
        a, b = b, a
    return int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())


def packed(points: np.ndarray) -> np.ndarray:
    """An order in which points near each other stand together: halves along what varies most, size or a coordinate, down to
    leaves of ``NODE``; but for the last, leaves are full."""
    sized = np.column_stack((points.sum(1), points))
    out, waiting = [np.zeros(0, np.int64)], [np.arange(len(points))]
    while waiting:
        some = waiting.pop()
        if len(some) <= NODE:
            out.append(some)
            continue
        part = sized[some]
        order = some[np.argsort(part[:, part.var(0).argmax()], kind="stable")]
        half = -(-(len(some) // 2) // NODE) * NODE
        waiting += [order[half:], order[:half]]
    return np.concatenate(out)


class Tree:
    """An R-tree: points in leaves of ``NODE``, boxes above them."""

    def __init__(self, points: np.ndarray) -> None:
        order = packed(points)
        self.order, self.points = order, points[order]
        self.levels = []
        low, high = self.points, self.points
        while len(low) > 1 or not self.levels:
            starts = np.arange(0, len(low), NODE)
            low = np.minimum.reduceat(low, starts)
            high = np.maximum.reduceat(high, starts)
            self.levels.append((low.sum(1), high))

    def search(self, point: np.ndarray, threshold: Threshold, alive: np.ndarray) -> np.ndarray:
        """Positions, in packed order, of live points whose overlap bound allows a link."""
        n = point.sum()
        at = np.zeros(1, np.int64)
        for depth in range(len(self.levels) - 1, -1, -1):
            least, high = self.levels[depth]
            at = at[at < len(high)]
            # A box's sets have at least its lowest size and share at most the sum of minima with its upper corner.
            most = np.minimum(high[at], point).sum(1)
            at = at[threshold.linked(most, n, np.maximum(least[at], most))]
            at = (at[:, None] * NODE + np.arange(NODE)).ravel()
        at = at[at < len(self.points)]
        at = at[alive[at]]
        bound = np.minimum(self.points[at], point).sum(1)
        return at[threshold.linked(bound, n, self.points[at].sum(1))]


def links(ids: np.ndarray, sets: list[np.ndarray], side: np.ndarray, threshold: Threshold) -> list[tuple[int, int]]:
    """Links that connect what is connected: through ``ids``, of pairs with a member in the first block (``side`` 0).

    Searches spread from set to set; a set leaves the tree when it is reached. Sets of the second block are reached
    from any set but start no search among themselves.
    """
    groups = _fitting(4 * sum(map(len, sets)) / max(len(sets), 1))
    points = np.array([counts(s, groups) for s in sets]).reshape(len(sets), groups)

    def similar(x: int, y: int) -> bool:
        return bool(threshold.linked(_overlap(sets[x], sets[y]), len(sets[x]), len(sets[y])))

    return [(int(ids[x]), int(ids[y])) for x, y in _searches(points, side, threshold, similar)]


def _searches(points: np.ndarray, side: np.ndarray, threshold: Threshold, similar: Callable[[int, int], bool]) -> list[tuple[int, int]]:
    tree = Tree(points)
    alive = np.ones(len(points), bool)
    where = np.empty(len(points), np.int64)
    where[tree.order] = np.arange(len(points))
    second = side[tree.order] == 1
    out = []
    for first in np.flatnonzero(side == 0):
        if not alive[where[first]]:
            continue
        alive[where[first]] = False
        reached = [first]
        while reached and alive.any():
            x = reached.pop()
            near = tree.search(points[x], threshold, alive & ~second if side[x] else alive)
            for at in near:
                y = tree.order[at]
                if similar(x, y):
                    alive[at] = False
                    out.append((x, y))
                    reached.append(y)
    return out


def _survivors(frame: pd.DataFrame, threshold: Threshold) -> list[tuple[int, int]]:
    """Pairs of classes, of rows (sign, class, point) of shared parts, whose points allow a link: enough to connect what such
    pairs connect."""
    frame = frame.drop_duplicates(["sign", "class"]).sort_values(["sign", "class"])
    classes = frame["class"].to_numpy()
    firsts = np.flatnonzero(np.append(True, np.diff(frame["sign"].to_numpy()) != 0))
    known = {}
    for c, p in zip(classes.tolist(), frame["point"], strict=True):
        if c not in known:
            known[c] = np.frombuffer(p, "<u2").astype(np.int32)
    out, done = set(), set()
    for members in np.split(classes, firsts[1:]):
        key = tuple(members.tolist())
        if len(key) < 2 or key in done:  # many parts are shared by the same sets
            continue
        done.add(key)
        points = _folded([known[c] for c in key])
        if len(key) == 2:
            a, b = points
            if threshold.linked(np.minimum(a, b).sum(), a.sum(), b.sum()):
                out.add(key)
        else:
            found = _searches(points, np.zeros(len(key), int), threshold, lambda x, y: True)
            out.update((key[x], key[y]) for x, y in found)
    return sorted(out)


def _class(hashes: np.ndarray) -> int | None:
    """A number for a set; equal sets have the same."""
    return xxhash.xxh3_64_intdigest(hashes.tobytes()) - (1 << 63) if len(hashes) else None


def join(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80, block: int = BLOCK,
    key: str | None = None,
) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` of every row of ``docs``, and the ``xxhash64`` of its text under the name
    ``key`` if given.

    Two texts are linked if their sets of shingles share at least ``percent`` of their union; a component's id is the
    smallest ``doc_id`` that links reach. Texts without words (null, empty) are linked with nothing, nor are rows without an
    id, whose component is null. Rows of equal texts are one class and are never multiplied out; rows of one id keep one
    row each. Ids are whole numbers. A table whose texts nowhere share a part, or an empty one, has no links.
    """
    threshold = Threshold(percent)
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("t"))
    keyed = rows.withColumn("key", F.xxhash64("t")) if key else rows

    def make():
        known = _Hashes()

        def work(texts):
            sets = [shingles(t, width, known) for t in texts]
            signs = [signatures(s, threshold).astype(np.int64) if len(s) and threshold.differ(len(s)) else () for s in sets]
            points = [counts(s, _fitting(len(s))).clip(max=65535).astype("<u2").tobytes() for s in sets]
            return {"n": [len(s) for s in sets], "class": [_class(s) for s in sets], "signs": signs, "point": points}

        return work

    made = saved(map_rows(keyed, ["t"], "n long, class long, signs array<long>, point binary", make).drop("t"), "shingles")
    whole = made.where("class is not null and id is not null")
    # From here on copies are one row, combined before they are sent.
    one = whole.groupBy("class").agg(F.min("id").alias("id"), *(F.first(c).alias(c) for c in ("n", "signs", "point")))
    one = saved(one, "one")
    # One exchange for both uses.
    parts = one.select("class", F.explode("signs").alias("sign")).repartition("sign")
    meets = parts.groupBy("sign").agg(F.min("class").alias("low"), F.max("class").alias("high"), F.count("*").alias("rows"))
    meets = meets.where("low < high").select("sign", F.ceil(F.col("rows") / MEMBERS).alias("cuts"))
    met = saved(parts.join(meets, "sign").select("sign", "class", "cuts"), "met")
    groups = components(_near(met, one, threshold), "class", "low").select(F.col("node").alias("class"), F.col("root").alias("group"))
    # One text for each class that met another.
    texts = one.select("class", "n", "id").join(groups, "class")
    roots = components(_links(rows, saved(texts, "groups"), width, threshold, block))
    found = one.select("class", "id").join(roots, F.col("class") == F.col("node"), "left")
    found = saved(found.select("class", F.coalesce("root", "class").alias("root"), "id"), "classes")
    least = found.groupBy("root").agg(F.min("id").alias("component_id"))
    members = found.join(least, "root").select("class", "component_id")
    return made.drop("signs", "point").join(members, "class", "left").select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id")).alias("component_id"),
        *([F.col("key").alias(key)] if key else []),
    )


def _near(met: DataFrame, one: DataFrame, threshold: Threshold) -> DataFrame:
    """Links (class, low) between classes that share a part and whose points allow a link, enough to connect what these
    connect. Parts share tasks; a part of very many classes is cut, and any two cuts of it meet in a task."""
    tasks = met.count() // MET + 1
    cut = F.pmod(F.xxhash64("class"), F.col("cuts"))
    rows = met.withColumn("cut", cut).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("cuts") - 1)))
    pair = F.concat_ws("/", "sign", F.least("cut", "other"), F.greatest("cut", "other"))
    task = F.when(F.col("cuts") == 1, F.pmod(F.xxhash64("sign"), F.lit(tasks)).cast("string")).otherwise(pair)
    points = one.select("class", "point").join(met.select("class").distinct(), "class", "left_semi")
    placed = rows.select("sign", "class", task.alias("task")).join(points, "class")

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(_survivors(frame, threshold), columns=["low", "class"], dtype="int64")

    return placed.groupBy("task").applyInPandas(run, "low long, class long")


def _links(rows: DataFrame, texts: DataFrame, width: int, threshold: Threshold, block: int) -> DataFrame:
    """Verified links between the classes of each group, enough to connect what is connected.

    Sets of a group, in order of size, are cut into blocks of about ``block`` shingles; a task takes one block, or two whose
    sizes allow a link. What is in which task is decided before the sets are made again and sent there.
    """
    mark = F.pmod(F.xxhash64("id"), F.lit(MARKS))
    # At most MARKS rows, so it is safe to send: leaves out most texts before their shingles are made again.
    chosen = texts.select(mark.alias("m")).distinct()
    some = rows.where("id is not null and t is not null").withColumn("m", mark).join(F.broadcast(chosen), "m", "left_semi").drop("m")

    def make():
        known = _Hashes()

        def work(told):
            sets = [shingles(t, width, known) for t in told]
            return {"class": [_class(s) for s in sets], "set": [_short(s) for s in sets]}

        return work

    sets = map_rows(some, ["t"], "class long, set binary", make).drop("t")
    tasks = _tasks(texts, threshold, block)
    sent = sets.join(tasks, ["id", "class"]).dropDuplicates(["id", "class", "task", "side"])

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        found = []
        for _, at in sorted(frame.groupby("group").indices.items()):
            hashes = [_long(x) for x in frame["set"].iloc[at]]
            found += links(frame["class"].to_numpy()[at], hashes, frame["side"].to_numpy()[at], threshold)
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return saved(sent.select("task", "group", "side", "class", "set").groupBy("task").applyInPandas(run, "a long, b long"), "verified")


def _short(hashes: np.ndarray) -> bytes:
    """The upper six bytes of each hash."""
    return hashes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, 2:].tobytes()


def _long(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, 2:] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return out.reshape(-1).view("<u8")


def _tasks(texts: DataFrame, threshold: Threshold, block: int) -> DataFrame:
    """For each text the tasks that it is part of, and its side there. Groups of one block share tasks.

    Blocks go by size within the group, then by a hash; sizes are counted first, so that no group is gathered.
    """
    sizes = texts.groupBy("group", "n").agg((F.count("*") * F.col("n")).alias("c"))
    before = sizes.withColumn("before", F.sum("c").over(Window.partitionBy("group").orderBy("n")) - F.col("c"))
    spot = F.floor(F.col("before") / block) + F.pmod(F.xxhash64("id"), F.ceil(F.col("c") / block))
    placed = texts.join(before, ["group", "n"]).withColumn("block", spot).drop("before", "c")
    spans = saved(
        placed.groupBy("group", "block").agg(F.min("n").alias("least"), F.max("n").alias("most"), F.sum("n").alias("all")), "blocks"
    )
    total = spans.agg(F.sum("all")).first()[0] or 0
    a, b = spans.alias("a"), spans.alias("b")
    both = a.join(b, F.col("a.group") == F.col("b.group")).where(
        (F.col("a.block") < F.col("b.block")) & (F.col("a.most") * 100 >= F.col("b.least") * threshold.percent)
        & (F.col("b.most") * 100 >= F.col("a.least") * threshold.percent)
    )
    shared = F.pmod(F.xxhash64("group"), F.lit(total // block + 1))
    small = F.max("block").over(Window.partitionBy("group")) == 0
    alone = spans.select(
        "group", "block", F.when(small, shared.cast("string")).otherwise(F.concat_ws("/", "group", "block")).alias("task"),
        F.lit(0).alias("side"),
    )
    task = F.concat_ws("/", F.col("a.group"), F.col("a.block"), F.col("b.block")).alias("task")
    sides = [
        both.select(F.col(f"{x}.group").alias("group"), F.col(f"{x}.block").alias("block"), task, F.lit(i).alias("side"))
        for i, x in enumerate("ab")
    ]
    tasks = alone.unionAll(sides[0]).unionAll(sides[1])
    return placed.join(tasks, ["group", "block"]).select("id", "class", "group", "task", "side")
