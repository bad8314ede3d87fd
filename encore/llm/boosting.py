"""Gradient-boosted regression trees on binned features, for logistic loss: of rows in memory, or of any number of rows by sums."""

from __future__ import annotations

from operator import add

import numpy as np
from pyspark import RDD, StorageLevel

#: Rounds after which the sums of all trees so far start from the rows again, so that no chain of steps gets long.
CHAIN = 10
#: Parts whose sums the driver adds up itself.
DIRECT = 16


class Trees:
    """Depth-limited trees of equal shape, stored as arrays: a row walks from node 0 to a leaf."""

    def __init__(self, rounds: int = 40, depth: int = 3, rate: float = 0.2, bins: int = 32, least: float = 5.0, shrink: float = 1.0):
        self.rounds, self.depth, self.rate, self.bins, self.least, self.shrink = rounds, depth, rate, bins, least, shrink

    def fit(self, x: np.ndarray, y: np.ndarray) -> Trees:
        n, d = x.shape
        self.cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, self.bins + 1)[1:-1])) for j in range(d)]
        code = np.stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(self.cuts)], 1)
        p = np.clip(y.mean(), 1e-4, 1 - 1e-4)
        self.base = np.log(p / (1 - p))
        f = np.full(n, self.base)
        size = 2 ** (self.depth + 1) - 1
        self.feature = np.full((self.rounds, size), -1)
        self.cut = np.zeros((self.rounds, size))
        self.value = np.zeros((self.rounds, size))
        for t in range(self.rounds):
            q = 1 / (1 + np.exp(-f))
            grad, hess = y - q, q * (1 - q)
            node = np.zeros(n, int)
            for k in range(size):
                rows = np.flatnonzero(node == k)
                if not len(rows):
                    continue
                g, h = grad[rows].sum(), hess[rows].sum()
                self.value[t, k] = self.rate * g / (h + self.shrink)
                if k >= size // 2:
                    continue
                best = (1e-6, -1, 0)
                for j, cuts in enumerate(self.cuts):
                    if not len(cuts):
                        continue
                    gs = np.cumsum(np.bincount(code[rows, j], grad[rows], len(cuts) + 1))[:-1]
                    hs = np.cumsum(np.bincount(code[rows, j], hess[rows], len(cuts) + 1))[:-1]
                    ns = np.cumsum(np.bincount(code[rows, j], minlength=len(cuts) + 1))[:-1]
                    gain = gs**2 / (hs + self.shrink) + (g - gs) ** 2 / (h - hs + self.shrink) - g**2 / (h + self.shrink)
                    gain[(ns < self.least) | (len(rows) - ns < self.least)] = 0
                    i = int(gain.argmax())
                    if gain[i] > best[0]:
                        best = (gain[i], j, i)
                if best[1] >= 0:
                    self.feature[t, k], self.cut[t, k] = best[1], self.cuts[best[1]][best[2]]
                    node[rows] = 2 * k + 1 + (code[rows, best[1]] > best[2])
            f += self._tree(t, x)
        return self

    def _tree(self, t: int, x: np.ndarray) -> np.ndarray:
        node = np.zeros(len(x), int)
        for _ in range(self.depth):
            j = self.feature[t, node]
            right = x[np.arange(len(x)), np.maximum(j, 0)] > self.cut[t, node]
            node = np.where(j < 0, node, 2 * node + 1 + right)
        return self.value[t, node]

    def chance(self, x: np.ndarray) -> np.ndarray:
        f = np.full(len(x), self.base)
        for t in range(self.rounds):
            f += self._tree(t, x)
        return 1 / (1 + np.exp(-f))

    def fit_parts(self, blocks: RDD, cuts: list[np.ndarray]) -> Trees:
        """:meth:`fit` on all rows of ``blocks``, of (features as :func:`coded`, label 0 or 1) arrays, wherever they lie.

        Rows stay where they are: for every level of every tree each part tells its sums by node, feature and bin. Of two nodes
        with one parent only the smaller is summed up; the other has what is left of the parent's sums.
        """
        self.cuts, lines = cuts, Lines([len(c) + 1 for c in cuts])
        n, ones = blocks.map(lambda b: (len(b[1]), float(b[1].sum()))).treeReduce(lambda a, b: (a[0] + b[0], a[1] + b[1]))
        p = np.clip(ones / n, 1e-4, 1 - 1e-4)
        self.base = np.log(p / (1 - p))
        size = 2 ** (self.depth + 1) - 1
        self.feature = np.full((self.rounds, size), -1)
        self.cut = np.zeros((self.rounds, size))
        self.value = np.zeros((self.rounds, size))
        places = np.zeros((self.rounds, size), int)  # cuts as bins
        few = blocks.getNumPartitions() <= DIRECT
        held = None
        for t in range(self.rounds):
            anew = t % CHAIN == 0
            told = slice(0 if anew else t - 1, t)
            step = _stepped(lines, self.base if anew else None, self.feature[told], places[told], self.value[told], self.depth)
            now = (blocks if anew else held).mapPartitions(step).persist(StorageLevel.MEMORY_AND_DISK)
            known, counted = {}, [0]  # sums by node, and the nodes of the next level that are to be counted
            for level in range(self.depth):
                low = 2**level - 1
                if counted:
                    count = _counted(lines, self.feature[t], places[t], level, counted)
                    found = now.mapPartitions(count).treeReduce(add, 1 if few else 2)
                    known |= {k: found[:, i] for i, k in enumerate(counted)}
                    known |= {k + 1 if k % 2 else k - 1: known[(k - 1) // 2] - known[k] for k in counted if k}
                counted = []
                for k in range(low, 2 * low + 1):
                    if k not in known:
                        continue
                    gs, hs, ns = np.cumsum(known[k], 2)
                    g, h, m = gs[0, -1], hs[0, -1], ns[0, -1]
                    self.value[t, k] = self.rate * g / (h + self.shrink)
                    gain = gs**2 / (hs + self.shrink) + (g - gs) ** 2 / (h - hs + self.shrink) - g**2 / (h + self.shrink)
                    gain[(ns < self.least) | (m - ns < self.least)] = 0
                    j, i = np.unravel_index(int(gain.argmax()), gain.shape)
                    if gain[j, i] > 1e-6:
                        self.feature[t, k], self.cut[t, k], places[t, k] = j, cuts[j][i], i
                        counted.append(2 * k + 1 + int(2 * ns[j, i] > m))
                        for at, gk, hk in ((2 * k + 1, gs[j, i], hs[j, i]), (2 * k + 2, g - gs[j, i], h - hs[j, i])):
                            self.value[t, at] = self.rate * gk / (hk + self.shrink)
            if held is not None:
                held.unpersist()
            held = now
        held.unpersist()
        return self


def coded(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    """The bin of every row for every feature: a line for each feature, as sums are made line by line."""
    return np.stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(cuts)]).astype(np.uint8)


class Lines:
    """Features of few bins share a line of at most 256 codes, so that rows are summed up once for all of them."""

    def __init__(self, bins: list[int]) -> None:
        self.bins, self.width = bins, max(bins)
        self.size = [1]  # codes of each line
        self.spot = [(0, 1)] * len(bins)  # line and step of each feature; one bin says nothing and takes no room
        for j in sorted((j for j, b in enumerate(bins) if b > 1), key=lambda j: -bins[j]):
            at = next((i for i, n in enumerate(self.size) if n * bins[j] <= 256), len(self.size))
            if at == len(self.size):
                self.size.append(1)
            self.spot[j] = (at, self.size[at])
            self.size[at] *= bins[j]

    def joined(self, code: np.ndarray) -> np.ndarray:
        """Lines of features as :func:`coded`."""
        out = np.zeros((len(self.size), code.shape[1]), np.uint8)
        for j, (at, step) in enumerate(self.spot):
            out[at] += code[j] * np.uint8(step)
        return out

    def above(self, j: int, place: int) -> np.ndarray:
        """For each code of feature ``j``'s line whether the feature's bin is above ``place``."""
        at, step = self.spot[j]
        return np.arange(self.size[at]) // step % self.bins[j] > place

    def apart(self, sums: list[np.ndarray]) -> np.ndarray:
        """Sums by feature and bin of sums by the codes of each line: the last axis becomes two."""
        out = np.zeros((*sums[0].shape[:-1], len(self.bins), self.width))
        for j, (at, step) in enumerate(self.spot):
            by = sums[at].reshape(*sums[at].shape[:-1], -1, self.bins[j], step)
            out[..., j, : self.bins[j]] = by.sum((-3, -1))
        return out


def _walked(lines: Lines, code: np.ndarray, feature: np.ndarray, place: np.ndarray, depth: int) -> np.ndarray:
    """The node of each row after ``depth`` steps."""
    node = np.zeros(code.shape[1], np.min_scalar_type(2 ** (depth + 1)))
    for k in np.flatnonzero(feature[: 2**depth - 1] >= 0).tolist():
        right = lines.above(feature[k], place[k])[code[lines.spot[feature[k]][0]]]
        node = np.where(node == k, right + node.dtype.type(2 * k + 1), node)
    return node


def _stepped(lines, base, feature, place, value, depth):
    """Rows with the sum of their trees: these trees on ``base`` of rows as :func:`coded`, or added to what the rows have."""

    def run(blocks):
        for code, y, *rest in blocks:
            code, f = (lines.joined(code), np.full(len(y), base)) if base is not None else (code, rest[0].copy())
            for t in range(len(value)):
                f += value[t][_walked(lines, code, feature[t], place[t], depth)]
            yield code, y, f

    return run


def _counted(lines, feature, place, level, nodes):
    """Sums of gradients, of their derivatives, and rows, by node (of these of a level), feature and bin."""

    def run(blocks):
        sums = [np.zeros((3, len(nodes) * size)) for size in lines.size]
        number = np.full(2 ** (level + 1) - 1, -1)
        number[nodes] = range(len(nodes))
        for code, y, f in blocks:
            of = number[_walked(lines, code, feature, place, level)]
            here = np.flatnonzero(of >= 0)
            if len(here) < len(of):
                code, y, f, of = code.take(here, 1), y[here], f[here], of[here]
            q = 1 / (1 + np.exp(-f))
            grad, hess = y - q, q * (1 - q)
            for out, line, size in zip(sums, code, lines.size, strict=True):
                at = of * size + line
                for i, weights in enumerate((grad, hess, None)):
                    out[i] += np.bincount(at, weights, len(nodes) * size)
        yield lines.apart([out.reshape(3, len(nodes), -1) for out in sums])

    return run
