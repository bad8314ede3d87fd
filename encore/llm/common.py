"""Helpers that the operators of this folder share."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from encore.session import importable, saved  # noqa: F401

SLICE = 1000
#: Lower-cases A-Z and keeps every other byte.
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(key: Column | str, folds: int) -> Column:
    """crc32 of the key's decimal text, modulo ``folds``; null for a null key."""
    key = F.col(key) if isinstance(key, str) else key
    return (F.crc32(key.cast("string").cast("binary")) % folds).cast("int")


def fresh(name: str) -> str:
    """A column name that no table has."""
    return f"{name}_{uuid.uuid4().hex[:8]}"


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A thousand rows at a time, so that a worker holds few texts as objects."""
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            yield batch.slice(at, SLICE)


def map_rows(
    df: DataFrame, columns: list[str], schema: str | T.StructType, make: Callable[[], Callable[..., dict]]
) -> DataFrame:
    """Keep every row of ``df`` with new columns beside its own; a new column replaces one of the same name.

    ``make`` runs once per task and returns a function from the lists of ``columns`` to the new columns' lists.
    """
    new = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    names = set(new.names)
    kept = [f for f in df.schema if f.name not in names]
    out = T.StructType([*kept, *new])
    arrow = to_arrow_schema(out)
    kept_names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in slices(batches):
            made = work(*(batch.column(c).to_pylist() for c in columns))
            arrays = [batch.column(c) for c in kept_names]
            arrays = [a if a.type == f.type else a.cast(f.type) for a, f in zip(arrays, arrow, strict=False)]
            arrays += [pa.array(made[f.name], arrow.field(f.name).type) for f in new]
            yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    importable(df.sparkSession)
    return df.mapInArrow(run, out)


def map_batches(df: DataFrame, schema: str | T.StructType, run: Callable[[Iterator[pa.RecordBatch]], Iterator[dict]]) -> DataFrame:
    """``mapInArrow`` for functions that yield dicts of columns."""
    out = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(out)

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for made in run(batches):
            yield pa.RecordBatch.from_arrays([pa.array(made[f.name], f.type) for f in arrow], schema=arrow)

    importable(df.sparkSession)
    return df.mapInArrow(go, out)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of a graph given by its links: columns ``node`` and ``root`` (the smallest node).

    Every round hooks each node to the smallest label around it and then halves the paths, so the number of rounds
    grows with the logarithm of a component's diameter. Rounds run on the links that are still between two labels,
    and are written to the shared folder. Null links are left out.
    """
    spark = edges.sparkSession
    links = edges.select(F.col(a).alias("x"), F.col(b).alias("y")).where("x is not null and y is not null and x <> y")
    links = saved(links.select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y")).distinct(), "links")
    first = links
    forests: list[DataFrame] = []
    while not links.isEmpty():
        # A star of every label to the smallest label that it touches.
        both = links.unionAll(links.select(F.col("y").alias("x"), F.col("x").alias("y")))
        near = both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("p"))
        tree = saved(near, "hooks")
        for _ in range(64):
            up = tree.select(F.col("x").alias("u"), F.col("p").alias("q"))
            step = tree.join(up, tree["p"] == up["u"], "left").select("x", "p", F.coalesce("q", "p").alias("g"))
            step = saved(step, "hooks")
            still = not step.where("g <> p").isEmpty()
            tree = step.select("x", F.col("g").alias("p"))
            if not still:
                break
        forests.append(tree)
        up = tree.select(F.col("x").alias("u"), F.col("p").alias("q"))
        there = links.join(up, links["x"] == up["u"]).select(F.col("q").alias("x"), "y")
        there = there.join(up, there["y"] == up["u"]).select("x", F.col("q").alias("y")).where("x <> y")
        links = saved(there.select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y")).distinct(), "links")
    if not forests:
        return first.select(F.col("x").alias("node"), F.col("y").alias("root"))
    found = forests[0].select(F.col("x").alias("node"), F.col("p").alias("root"))
    for tree in forests[1:]:
        up = tree.select(F.col("x").alias("u"), F.col("p").alias("q"))
        found = found.join(up, found["root"] == up["u"], "left").select("node", F.coalesce("q", "root").alias("root"))
    return found
