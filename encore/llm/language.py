"""Language identification by unigrams with the segmentation summed out.

Words are split into pieces of a fixed public vocabulary. A language gives every piece a chance; a word's likelihood is the
sum over all its segmentations, by a forward recursion over its characters. The chances are learned by expectation and
maximisation, with the backward recursion. Distinct words are handled in arrays, words of equal length together.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from encore.llm.common import fresh, map_batches, map_rows, saved

#: Documents of a language that are learned from, about; rounds of learning.
SAMPLE, ROUNDS = 4000, 3
#: Longest piece; longer words are scored in stretches of WORD characters; chance of a character that no piece has.
PIECE, WORD, UNKNOWN = 12, 32, 1e-7
#: Words whose likelihoods a task remembers.
CACHED = 300_000
_WORDS = re.compile(r"[^\W\d_]+")
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BITS = 18


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@lru_cache(maxsize=2)
def pieces(path: str) -> list[str]:
    """The vocabulary's pieces that are lower-case letters, with a blank in front of those that begin a word."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    told = {model.id_to_piece(i).replace("▁", " ") for i in range(model.get_piece_size())}
    return sorted(p for p in told if p.strip() and len(p) <= PIECE and p == p.lower() and p.strip().isalpha() and " " not in p[1:])


def words(text: str | None) -> list[str]:
    """Lower-case runs of letters, each with a blank in front, in stretches of at most ``WORD`` characters."""
    out = []
    for w in _WORDS.findall(text.lower()) if text else ():
        if len(w) < WORD:
            out.append(" " + w)
        else:
            w = " " + w
            out += [w[a : a + WORD] for a in range(0, len(w), WORD)]
    return out


class Lattice:
    """Where the vocabulary's pieces lie in words."""

    def __init__(self, vocabulary: list[str]) -> None:
        self.n = len(vocabulary)
        self.table = np.full(1 << _BITS, -1, np.int32)
        self.hash = np.zeros(self.n, np.uint64)
        for i, p in enumerate(vocabulary):
            h = np.uint64(0)
            for c in p:
                h = self._add(h, np.uint64(ord(c)))
            self.hash[i] = h
        # Open addressing: a piece lies in the first free place from its own on.
        self.reach = 1
        for i, h in enumerate(self.hash.tolist()):
            at = h >> (64 - _BITS)
            far = 0
            while self.table[(at + far) & ((1 << _BITS) - 1)] >= 0:
                far += 1
            self.table[(at + far) & ((1 << _BITS) - 1)] = i
            self.reach = max(self.reach, far + 1)

    @staticmethod
    def _add(h, c):
        with np.errstate(over="ignore"):
            h = (h ^ c) * _STEP
            return h ^ (h >> np.uint64(29))

    def find(self, h: np.ndarray) -> np.ndarray:
        """The number of the piece with each hash, or -1."""
        at = (h >> np.uint64(64 - _BITS)).astype(np.int64)
        out = np.full(len(h), -1, np.int32)
        for far in range(self.reach):
            i = self.table[(at + far) & ((1 << _BITS) - 1)]
            hit = (i >= 0) & (self.hash[i] == h)
            out[hit] = i[hit]
        return out

    def edges(self, chars: np.ndarray) -> list[list[tuple[int, np.ndarray, np.ndarray]]]:
        """For each end position: start, rows and pieces there, for words (rows) of equal length."""
        rows, length = chars.shape
        out: list[list] = [[] for _ in range(length + 1)]
        for start in range(length):
            h = np.zeros(rows, np.uint64)
            for end in range(start + 1, min(length, start + PIECE) + 1):
                h = self._add(h, chars[:, end - 1])
                piece = self.find(h)
                some = np.flatnonzero(piece >= 0)
                if len(some):
                    out[end].append((start, some, piece[some]))
        return out


def forward(edges: list, rows: int, chance: np.ndarray) -> np.ndarray:
    """(positions, rows, languages): chance of each beginning, over all its segmentations."""
    f = np.zeros((len(edges), rows, chance.shape[1]))
    f[0] = 1
    for end in range(1, len(edges)):
        f[end] = f[end - 1] * UNKNOWN
        for start, some, piece in edges[end]:
            f[end][some] += f[start][some] * chance[piece]
    return f


def by_length(told: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of the words of each length, and their characters as numbers."""
    sizes = np.fromiter(map(len, told), np.int64, len(told))
    for length in np.unique(sizes):
        at = np.flatnonzero(sizes == length)
        for a in range(0, len(at), 20_000):
            some = at[a : a + 20_000]
            text = "".join([told[i] for i in some])
            yield some, np.frombuffer(text.encode("utf-32-le"), "<u4").reshape(len(some), length).astype(np.uint64)


class Model:
    """A chance for every piece in every language, and of every language."""

    def __init__(self, languages: list[str], prior: np.ndarray, vocabulary: list[str], chance: np.ndarray) -> None:
        self.languages, self.prior, self.vocabulary, self.chance = languages, prior, vocabulary, chance

    def lattice(self) -> Lattice:
        return Lattice(self.vocabulary)


def _expected(model: Model, part: DataFrame) -> np.ndarray:
    """Expected uses of each piece in each language, over the counted words of ``part`` (k, word, n)."""
    spark = part.sparkSession
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        m = shared.value
        lattice, total = m.lattice(), np.zeros(m.chance.shape)
        for batch in batches:
            told = batch.column("word").to_pylist()
            lang, n = np.asarray(batch.column("k")), np.asarray(batch.column("n")).astype(float)
            for some, chars in by_length(told):
                edges, rows, of = lattice.edges(chars), np.arange(len(some)), lang[some]
                f = np.zeros((len(edges), len(some)))
                b = np.zeros_like(f)
                f[0] = b[-1] = 1
                for end in range(1, len(edges)):
                    f[end] = f[end - 1] * UNKNOWN
                    for start, r, piece in edges[end]:
                        f[end][r] += f[start][r] * m.chance[piece, of[r]]
                for end in range(len(edges) - 1, 0, -1):
                    b[end - 1] += b[end] * UNKNOWN
                    for start, r, piece in edges[end]:
                        b[start][r] += b[end][r] * m.chance[piece, of[r]]
                weight = n[some] / np.maximum(f[-1], 1e-300)
                for end in range(1, len(edges)):
                    for start, r, piece in edges[end]:
                        np.add.at(total, (piece, of[r]), weight[r] * f[start][r] * m.chance[piece, of[r]] * b[end][r])
                del rows
        at = np.nonzero(total)
        yield {"k": at[1].tolist(), "piece": at[0].tolist(), "n": total[at].tolist()}

    out = np.zeros(model.chance.shape)
    # At most one row for each language and piece of the fixed vocabulary.
    for row in map_batches(part, "k int, piece int, n double", run).groupBy("k", "piece").agg(F.sum("n").alias("n")).toLocalIterator():
        out[row.piece, row.k] = row.n
    return out


def _maximised(uses: np.ndarray) -> np.ndarray:
    uses = uses + 0.05
    return uses / uses.sum(0)


def fit(docs: DataFrame, text: str, lang: str, sample: int = SAMPLE, vocabulary: str | None = None) -> Model | None:
    """A model of the languages of ``docs``; about ``sample`` documents of each, chosen by a hash of the text, teach its
    pieces. Rows without language or text, or without a letter, teach nothing; None if no row is left."""
    docs = docs.select(F.col(text).alias("t"), F.col(lang).cast("string").alias("l")).where("t is not null and l is not null")
    found = docs.groupBy("l").count().orderBy("l").collect()  # one row for each language
    if not found:
        return None
    languages = [r.l for r in found]
    share = F.create_map(*(F.lit(x) for r in found for x in (r.l, int(min(1.0, sample / r["count"]) * 1_000_000))))
    number = F.create_map(*(F.lit(x) for i, name in enumerate(languages) for x in (name, i)))
    chosen = docs.where(F.pmod(F.xxhash64("t"), F.lit(1_000_000)) < share[F.col("l")]).select("t", number[F.col("l")].alias("k"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        seen: Counter = Counter()

        def told() -> dict:
            return {"k": [k for k, _ in seen], "word": [w for _, w in seen], "n": list(seen.values())}

        for batch in batches:
            for t, k in zip(batch.column("t").to_pylist(), batch.column("k").to_pylist(), strict=True):
                seen.update([(k, w) for w in words(t)])
                if len(seen) > CACHED:
                    yield told()
                    seen.clear()
        yield told()

    counted = map_batches(chosen, "k int, word string, n long", count).groupBy("k", "word").agg(F.sum("n").alias("n"))
    counted = saved(counted, "words")
    if counted.isEmpty():
        return None
    told = pieces(vocabulary or vocabulary_path())
    total = np.array([r["count"] for r in found], float)
    flat = np.ones((len(told), len(languages)))
    # Short pieces are the likelier ones to begin with.
    model = Model(languages, total / total.sum(), told, flat / len(told) * np.exp(-0.5 * np.array([[len(p)] for p in told])) * 3)
    for _ in range(ROUNDS):
        model.chance = _maximised(_expected(model, counted))
    return model


def identify(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """Every row of ``docs`` with ``lang_pred`` and ``score`` (its chance among the learned languages, 0 to 1).

    The new columns replace columns of the same names. Null and empty texts and such without a letter are ``und`` with
    score 0, as is everything without a model. Texts are scored whole; of languages equally likely the first by name
    is chosen. Rows are judged one by one.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        m = shared.value
        if m is None:
            return lambda texts: {"lang_pred": ["und"] * len(texts), "score": [0.0] * len(texts)}
        lattice, prior = m.lattice(), np.log(m.prior)
        number: dict[str, int] = {}
        scores = np.zeros((0, len(m.languages)))

        def learn(new: list[str]) -> np.ndarray:
            out = np.zeros((len(new), len(m.languages)))
            for some, chars in by_length(new):
                out[some] = np.log(np.maximum(forward(lattice.edges(chars), len(some), m.chance)[-1], 1e-300))
            return out

        def work(texts):
            nonlocal scores
            lang, chance = [], []
            for a in range(0, len(texts), 500):
                told = [words(t) for t in texts[a : a + 500]]
                every = set().union(*told)
                if len(number) > CACHED:
                    number.clear()
                    scores = scores[:0]
                new = sorted(every.difference(number))
                if new:
                    number.update(zip(new, range(len(number), len(number) + len(new)), strict=True))
                    scores = np.vstack((scores, learn(new)))
                for ws in told:
                    if not any(c.isalpha() for w in ws for c in w):
                        lang.append("und")
                        chance.append(0.0)
                        continue
                    at = np.fromiter(map(number.__getitem__, ws), np.int64, len(ws))
                    s = scores[at].sum(0) + prior
                    best = int(s.argmax())
                    lang.append(m.languages[best])
                    chance.append(float(1 / np.exp(s - s[best]).sum()))
            return {"lang_pred": lang, "score": chance}

        return work

    return map_rows(docs, [text], "lang_pred string, score double", make)


def classify(docs: DataFrame, learn: Column, text: str = "text", lang: str = "lang") -> DataFrame:
    """``docs`` with predictions of a model that learns from the rows where ``learn`` holds."""
    learns = fresh("learn")
    taught = docs.select(text, lang, learn.alias(learns)).where(F.col(learns))
    return identify(docs, fit(taught, text, lang), text)
