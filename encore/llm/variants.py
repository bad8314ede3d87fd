"""Spelling variants: words one edit apart, found by the rotations of their terminator-marked forms.

The rotation of ``word$`` that begins after a letter ends with that letter, so what stands before it is what the word
shares with every word that has another letter there, and is itself a rotation of the word without it. Sorted by that
prefix, replacements, insertions and deletions lie side by side, and no pair is ever compared.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.llm.common import map_batches, saved, slices

RUN = re.compile("[A-Za-zÀ-ÿ]+")
_LOWER = {c: c + 32 for c in range(65, 91)}
#: One in so many (document, word) pairs has a letter deleted.
DAMAGE = 97
#: Words of a task's table of counts, and letters, before it is handed on.
WORDS, LETTERS = 300_000, 16_000_000
#: Words up to this length are rotated letter by letter, longer ones by hashes of their halves.
PLAIN = 64
ROWS = 50_000
#: Words that a task rotates.
PART = 20_000
_PRIME, _BASE = (1 << 127) - 1, 0x1F3D5B79A2C4E6080F1E2D3C4B5A6979


def lower(run: str) -> str:
    """A-Z in lower case, all else as it is."""
    return run.lower() if run.isascii() else run.translate(_LOWER)


def damaged(key: object, word: str, every: int = DAMAGE) -> str:
    """The word as a document spells it: without one letter if the crc32 of ``key:word`` is a multiple of ``every``."""
    h = zlib.crc32(f"{'' if key is None else key}:{word}".encode())
    if h % every:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1 :]


def counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", every: int | None = None) -> DataFrame:
    """``word`` and ``n``, how often it occurs in all texts, of every lower-cased run of letters (null text: none).

    With ``every``, spellings are damaged first (:func:`damaged`; a null id reads as the empty string).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        found: Counter[str] = Counter()
        letters = 0
        for batch in slices(batches):
            for key, told in zip(batch.column("k").to_pylist(), batch.column("t").to_pylist(), strict=True):
                for word, n in Counter(RUN.findall(told or "")).items() if every is None else _spelled(key, told, every):
                    word = lower(word) if every is None else word
                    if word not in found:
                        letters += len(word)
                    found[word] += n
                if len(found) > WORDS or letters > LETTERS:
                    yield {"word": list(found), "n": list(found.values())}
                    found, letters = Counter(), 0
        yield {"word": list(found), "n": list(found.values())}

    rows = docs.select(F.col(doc_id).cast("string").alias("k"), F.col(text).alias("t"))
    return map_batches(rows, "word string, n long", run).groupBy("word").agg(F.sum("n").alias("n"))


def _spelled(key: str | None, told: str | None, every: int) -> Iterator[tuple[str, int]]:
    whole: Counter[str] = Counter()
    for run, n in Counter(RUN.findall(told or "")).items():
        whole[lower(run)] += n
    for word, n in whole.items():
        yield damaged(key, word, every), n


def rotations(word: str) -> Iterator[tuple[str, bool, bool]]:
    """``prefix``, ``whole``, ``first`` of every rotation of ``word$``.

    Once as it is (``whole``), once without the letter that it ends with; ``first`` is false where that letter repeats the
    one before it, since deleting either gives the same word. Prefixes of more than ``PLAIN`` letters are told by their
    number of letters and two polynomial hashes, of what stands before and behind the place.
    """
    size = len(word)
    heads, powers = [0], [1]
    for c in word if size > PLAIN else "":
        heads.append((heads[-1] * _BASE + ord(c)) % _PRIME)
        powers.append(powers[-1] * _BASE % _PRIME)

    def tail(at: int) -> int:
        return (heads[size] - heads[at] * powers[size - at]) % _PRIME

    for at in range(size + 1):
        yield f"{word[at:]}${word[:at]}" if size <= PLAIN else f"{size}${heads[at]:x}:{tail(at):x}", True, True
    for at in range(size):
        plain = size - 1 <= PLAIN
        prefix = f"{word[at + 1 :]}${word[:at]}" if plain else f"{size - 1}${heads[at]:x}:{tail(at + 1):x}"
        yield prefix, False, at == 0 or word[at] != word[at - 1]


def _ranges(words: DataFrame) -> DataFrame:
    """The prefixes of all rotations, each with its word's number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        out: dict[str, list] = {"prefix": [], "id": [], "n": [], "whole": [], "first": []}
        for batch in slices(batches):
            for number, word, n in zip(*(batch.column(c).to_pylist() for c in ("id", "word", "n")), strict=True):
                for prefix, whole, first in rotations(word):
                    for name, value in zip(out, (prefix, number, n, whole, first), strict=True):
                        out[name].append(value)
                    if len(out["id"]) >= ROWS:
                        yield out
                        out = {name: [] for name in out}
        yield out

    # However many words there are, a task has no more of them.
    words = words.select("id", "word", "n").repartition(max(1, -(-words.count() // PART)), "id")
    return map_batches(words, "prefix string, id long, n long, whole boolean, first boolean", run)


def numbered(words: DataFrame) -> DataFrame:
    """``words`` with ``id``, a number in the code-point order of ``word``, which is unique in the table."""
    placed = words.repartitionByRange("word").sortWithinPartitions("word")
    return saved(placed.withColumn("id", F.monotonically_increasing_id()), "words")


def neighbours(words: DataFrame) -> DataFrame:
    """Of every row of :func:`numbered` words ``n_near`` and, of those with near words, ``best``: (``less``, minus the
    count, and ``id``) of the near word of largest count, then smallest.

    The words of one prefix are one for each letter and one without a letter there, so groups are bounded; of a group
    each member is told how many others are near and which is the best of them.
    """
    groups = _ranges(words).groupBy("prefix").agg(F.collect_list(F.struct("id", "n", "whole", "first")).alias("all"))
    groups = groups.where(F.size("all") > 1).select("all", F.explode("all").alias("own"))
    near = F.filter(
        "all",
        lambda x: (x["id"] != F.col("own.id"))
        & F.when(x["whole"], F.col("own.first")).when(F.col("own.whole"), x["first"]).otherwise(True),
    )
    told = groups.select(F.col("own.id").alias("id"), near.alias("near")).where(F.size("near") > 0)
    told = told.select(
        "id", F.size("near").cast("long").alias("k"),
        F.array_min(F.transform("near", lambda x: F.struct((-x["n"]).alias("less"), x["id"].alias("id")))).alias("best"),
    )
    told = told.groupBy("id").agg(F.sum("k").alias("n_near"), F.min("best").alias("best"))
    return words.join(told, "id", "left").withColumn("n_near", F.coalesce("n_near", F.lit(0).cast("long")))


def forms(words: DataFrame, factor: int = 2) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n`` of every row of ``words`` (distinct, with counts ``n``).

    A word's ``form`` is its near word (one code point inserted, deleted or replaced) of largest ``n``, of ties the
    smallest in code-point order, if that is at least ``factor`` (2 or more) times its own; else null, as is ``form_n``.
    ``root`` is where forms lead to in the end, the word itself if it has none. Counts double with every step, so few
    rounds of self-joins, each of which halves the way, reach it.
    """
    words = numbered(words.select("word", "n"))
    has = -F.col("best.less") >= factor * F.col("n")
    near = neighbours(words).select(
        "id", "word", "n", "n_near", F.when(has, F.col("best.id")).alias("form_id"), F.when(has, -F.col("best.less")).alias("form_n")
    )
    near = saved(near, "near")
    way = near.where("form_id is not null").select("id", F.col("form_id").alias("end"))
    while True:
        on = way.select(F.col("id").alias("mid"), F.col("end").alias("far"))
        step = way.join(on, F.col("end") == F.col("mid"), "left").select("id", F.coalesce("far", "end").alias("end"), "far")
        step = saved(step, "way")
        way = step.select("id", "end")
        if step.where("far is not null").isEmpty():
            break
    names = words.select(F.col("id").alias("at"), F.col("word").alias("name"))
    ends = way.join(names, F.col("end") == F.col("at")).select("id", F.col("name").alias("root"))
    firsts = near.where("form_id is not null").join(names, F.col("form_id") == F.col("at")).select("id", F.col("name").alias("form"))
    out = near.join(firsts, "id", "left").join(ends, "id", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def variants(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shortest: int = 5, least: int = 3, factor: int = 2, every: int | None = None
) -> DataFrame:
    """:func:`forms` of the words of at least ``shortest`` code points that occur ``least`` times or more in all texts.

    Null and empty texts and an empty table have no words; repeated rows count again; other columns are not read.
    ``every`` damages spellings first, for measurements (:func:`damaged`).
    """
    found = counts(docs, doc_id, text, every)
    return forms(found.where((F.length("word") >= shortest) & (F.col("n") >= least)), factor)


def oracle_sql(shortest: int = 5, least: int = 3, every: int = DAMAGE) -> str:
    """The same by joins on words without one letter, for DuckDB."""
    return f"""
WITH RECURSIVE byte AS (
  SELECT list(r ORDER BY i) AS t FROM (
    SELECT i, list_reduce(range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, i) AS r
    FROM range(256) x(i))),
runs AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS word, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) AS run FROM documents)
  GROUP BY ALL),
keyed AS (
  SELECT *, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || word)) AS code FROM runs),
summed AS (
  SELECT word, n,
    xor(list_reduce(range(length(code) // 2),
      lambda c, k: xor(c // 256, t[1 + xor(c % 256, ('0x' || substr(code, 2 * k + 1, 2))::BIGINT)]), 4294967295), 4294967295) AS h
  FROM keyed CROSS JOIN byte),
spelled AS (
  SELECT CASE WHEN h % {every} = 0 THEN substr(word, 1, h % length(word)) || substr(word, h % length(word) + 2) ELSE word END AS word, n
  FROM summed),
words AS (SELECT word, sum(n)::BIGINT AS n FROM spelled GROUP BY word HAVING length(word) >= {shortest} AND sum(n) >= {least}),
cut AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS short
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
pairs AS (
  SELECT a.word, b.word AS other, b.n FROM cut a JOIN cut b ON a.short = b.short AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cut a JOIN words b ON a.short = b.word
  UNION SELECT b.word, a.word, a.n FROM cut a JOIN words b ON a.short = b.word),
near AS (
  SELECT word, count(*) AS n_near, min_by(other, (-n, other)) AS best, max(n) AS best_n FROM pairs GROUP BY word),
told AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 2 * w.n THEN best END AS form,
    CASE WHEN best_n >= 2 * w.n THEN best_n END AS form_n
  FROM words w LEFT JOIN near USING (word)),
way AS (
  SELECT word, word AS root FROM told
  UNION ALL SELECT way.word, told.form FROM way JOIN told ON told.word = way.root WHERE told.form IS NOT NULL),
ends AS (SELECT way.word, way.root FROM way JOIN told ON told.word = way.root WHERE told.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM told JOIN ends USING (word)
"""
