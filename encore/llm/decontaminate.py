"""Benchmark decontamination: one Aho-Corasick automaton over the test items, each text scanned once.

Items and texts are normalised alike: A-Z in lower case, words are runs of digits, letters and everything beyond
ASCII. The automaton runs over word numbers, so a match ends at a word, and word positions map to the original text.
"""

from __future__ import annotations

import re

import ahocorasick
import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.llm.common import map_rows

WINDOW = 10
#: Words of items that one automaton holds; larger benchmarks are scanned for in several rounds.
ITEM_WORDS = 4_000_000

#: Word characters of the contract: all bytes but 0x00-0x2F, 0x3A-0x60, 0x7B-0x7F, after lower-casing A-Z.
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_TABLE = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def words(text: str | None) -> list[bytes]:
    """The normalised words of a text; none for null."""
    return text.encode().translate(_TABLE).split() if text else []


def automaton(items: list[tuple[str | None, list[bytes]]], window: int) -> tuple[dict, ahocorasick.Automaton, list]:
    """Numbers of the items' words, the automaton over their windows, and (words, items) of each window."""
    numbers: dict[bytes, int] = {}
    places: dict[tuple[int, ...], set[str]] = {}
    for item, told in items:
        ids = [numbers.setdefault(w, len(numbers) + 1) for w in told]
        for at in range(max(1, len(ids) - window + 1)) if ids else ():
            places.setdefault(tuple(ids[at : at + window]), set()).update(() if item is None else (item,))
    machine = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
    found = []
    for key, of in places.items():
        machine.add_word(key, len(found))
        found.append((len(key), of))
    if found:
        machine.make_automaton()
    return numbers, machine, found


def _chunks(benchmark: DataFrame, item: str, text: str, most: int):
    """The items' words, in lists of at most ``most`` words (or of one item). Streams the items to the driver."""
    chunk, size = [], 0
    rows = benchmark.select(F.col(item).cast("string").alias("i"), F.col(text).alias("t"))
    for row in rows.where("t is not null").toLocalIterator():
        told = words(row.t)
        if chunk and size + len(told) > most:
            yield chunk
            chunk, size = [], 0
        chunk.append((row.i, told))
        size += len(told)
    yield chunk


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text",
    window: int = WINDOW, item_words: int = ITEM_WORDS,
) -> DataFrame:
    """Every row of ``docs`` with what it shares with the benchmark.

    New columns, which replace columns of the same names: ``n_words``; ``n_hit``, the words inside any occurrence of a
    window (``window`` consecutive item words, or a whole shorter item); ``items``, the sorted ids with occurring
    windows; ``spans``, hit passages as [start, end) code points of the original text; ``contaminated``.

    Null and empty texts have no words and no hits. Items with null text, or without words, match nothing; what
    matches an item without an id is hit, but no id is told. Repeated items count once. Rows, copies too, are judged one by one and all are kept. An empty benchmark marks
    nothing. Benchmarks of more than ``item_words`` words are scanned for in rounds that add up exactly.
    """
    for round_, chunk in enumerate(_chunks(benchmark, item, item_text, item_words)):
        docs = _scan(docs, chunk, text, window, first=round_ == 0)
    return docs


def _scan(docs: DataFrame, chunk: list, text: str, window: int, first: bool) -> DataFrame:
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(chunk)

    def make():
        numbers, machine, found = automaton(shared.value, window)
        least = min((n for n, _ in found), default=0)
        get = numbers.get

        def work(texts, *before):
            out = {k: [] for k in ("n_words", "n_hit", "items", "spans", "contaminated")}
            for i, t in enumerate(texts):
                told = words(t)
                hits, items = [], set()
                if found and len(told) >= least:
                    ids = np.fromiter((get(w, 0) for w in told), np.int64, len(told))
                    for at, till in _runs(ids, least):  # no window holds a word that no item has
                        for end, k in machine.iter(tuple(ids[at:till].tolist())):
                            n, of = found[k]
                            hits.append((at + end - n + 1, at + end + 1))
                            items |= of
                    hits = _joined(hits)
                spans = []
                if hits:
                    places = [m.span() for m in WORD.finditer(t)]
                    spans = [{"start": places[a][0], "end": places[b - 1][1]} for a, b in hits]
                if not first:  # add to what earlier rounds found
                    old_items, old_spans = before[0][i], before[1][i]
                    items |= set(old_items)
                    spans = _merged([*spans, *old_spans])
                    n_hit = _covered(t, spans)
                else:
                    n_hit = sum(b - a for a, b in hits)
                out["n_words"].append(len(told))
                out["n_hit"].append(n_hit)
                out["items"].append(sorted(items))
                out["spans"].append(spans)
                out["contaminated"].append(n_hit > 0)
            return out

        return work

    schema = "n_words long, n_hit long, items array<string>, spans array<struct<start:long,end:long>>, contaminated boolean"
    return map_rows(docs, [text] if first else [text, "items", "spans"], schema, make)


def _runs(ids: np.ndarray, least: int) -> list[tuple[int, int]]:
    """The stretches of at least ``least`` known words."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], ids > 0, [0])).astype(np.int8)))
    return [(a, b) for a, b in edges.reshape(-1, 2).tolist() if b - a >= least]


def _joined(hits: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Word ranges with those that touch made one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(hits):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def _merged(spans: list[dict]) -> list[dict]:
    return [{"start": a, "end": b} for a, b in _joined([(s["start"], s["end"]) for s in spans])]


def _covered(text: str | None, spans: list[dict]) -> int:
    return sum(len(WORD.findall(text, s["start"], s["end"])) for s in spans)

