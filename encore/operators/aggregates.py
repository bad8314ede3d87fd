"""Counters, running aggregates, sliding windows and user-defined aggregation."""

from __future__ import annotations

import math

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from encore.session import importable


def word_count(words: DataFrame) -> DataFrame:
    return words.groupBy("value").count()


def click_totals(clicks: DataFrame, key: str = "uid", count: str = "click_count") -> DataFrame:
    """Additive total per key."""
    return clicks.groupBy(key).agg(F.sum(count).alias("clicks"))


def running_sum(events: DataFrame, key: str, value: Column | str) -> DataFrame:
    """Total per key over everything seen; on a stream the totals carry over batches."""
    return events.groupBy(key).agg(F.sum(value).alias("total"))


def running_max(events: DataFrame, key: str, value: str) -> DataFrame:
    """Largest value per key over everything seen, starting from 0."""
    return events.groupBy(key).agg(F.greatest(F.max(value), F.lit(0)).alias("best"))


def last_put(rows: DataFrame, keys: list[str], value: str, order: str) -> DataFrame:
    """Overwriting put: the value of the newest row per key (equal times: the larger value)."""
    newest = F.max(F.struct(F.col(order), F.col(value))).alias("n")
    per_value = rows.groupBy(*keys, value).agg(F.max(order).alias(order))
    return per_value.groupBy(*keys).agg(newest).select(*keys, F.col(f"n.{value}").alias(value))


def typed_average(df: DataFrame, value: str, *keys: str) -> DataFrame:
    """Average as (sum, count) buffers, merged and finished as sum / count."""
    buffers = df.groupBy(*keys).agg(F.sum(value).alias("_sum"), F.count(value).alias("_count"))
    return buffers.select(*keys, (F.col("_sum").cast("double") / F.col("_count")).alias("average"))


def user_aggregate(
    df: DataFrame,
    keys: list[str],
    inputs: list[str],
    buffer: str,
    reduce: Callable[[pd.DataFrame], dict],
    merge: Callable[[pd.DataFrame], dict],
    finish: Column,
) -> DataFrame:
    """Aggregation with user code, for what no built-in aggregate can say.

    ``reduce`` turns input rows of one key into one buffer row, ``merge`` several buffer
    rows into one, ``finish`` is a column over the buffer. ``buffer`` is its DDL.

    The input is never grouped in Python: each Arrow batch is reduced where it is, then
    buffers are merged per source partition and only those results per key. A key with
    a third of all rows thus costs its last task one buffer per partition.
    """
    fields = T.StructType.fromDDL(buffer)
    names = [f.name for f in fields]
    key_schema = T.StructType([df.schema[k] for k in keys])
    batch_schema = T.StructType([*key_schema, *fields, T.StructField("_part", T.IntegerType())])
    final_schema = T.StructType([*key_schema, *fields])

    def rows_of(pdf: pd.DataFrame, step) -> list[dict]:
        return [
            {**dict(zip(keys, key)), **step(group)} for key, group in pdf.groupby(keys, dropna=False, sort=False)
        ]

    def reduce_batches(batches):
        for pdf in batches:
            if len(pdf):
                part = int(pdf["_part"].iloc[0])
                out = pd.DataFrame(rows_of(pdf[[*keys, *inputs]], reduce))
                yield out.assign(_part=part)[[*keys, *names, "_part"]]

    def merge_groups(pdf: pd.DataFrame) -> pd.DataFrame:
        first = {k: pdf[k].iloc[0] for k in keys}
        return pd.DataFrame([{**first, **merge(pdf[names])}])[[*keys, *names]]

    importable(df.sparkSession)
    source = df.select(*keys, *inputs, F.spark_partition_id().alias("_part"))
    buffers = source.mapInPandas(reduce_batches, batch_schema)
    per_part = buffers.groupBy(*keys, "_part").applyInPandas(merge_groups, final_schema)
    merged = per_part.groupBy(*keys).applyInPandas(merge_groups, final_schema)
    return merged.select(*keys, finish)


def register_average(spark: SparkSession, name: str = "typed_avg") -> None:
    """The user-defined average (zero, reduce, merge, finish) as a function of SQL text: ``SELECT k, typed_avg(v) ... GROUP BY k``.

    SQL hands user code the values of a whole group, so the query should group by a part of it first where a group may be
    very large; :func:`user_aggregate` and :func:`stream_user_aggregate` reduce as they go. Nulls do not count; a group without values has
    a null average. Without GROUP BY and without rows there is no row.
    """
    importable(spark)

    @F.pandas_udf("double")
    def average(values: pd.Series) -> float:
        known = values.dropna()
        return float(known.sum()) / len(known) if len(known) else None

    spark.udf.register(name, average)


def stream_user_aggregate(
    df: DataFrame,
    keys: list[str],
    inputs: list[str],
    buffer: str,
    reduce: Callable[[pd.DataFrame], dict],
    merge: Callable[[pd.DataFrame], dict],
) -> DataFrame:
    """:func:`user_aggregate` over a stream: the keys and the buffer of every key that a batch touches.

    The state of a key is its buffer. Each Arrow batch of a key is reduced as it comes and merged into it, so no group is
    held as a whole. Run it with mode ``update``; the caller finishes the buffers.
    """
    fields = T.StructType.fromDDL(buffer)
    names = [f.name for f in fields]
    schema = T.StructType([*[df.schema[k] for k in keys], *fields])

    def update(key, frames, state):
        rows = [dict(zip(names, state.get, strict=True))] if state.exists else []
        for frame in frames:
            rows = [merge(pd.DataFrame([*rows, reduce(frame[inputs])])[names])]
        state.update(tuple(rows[0][n] for n in names))
        yield pd.DataFrame([{**dict(zip(keys, key, strict=True)), **rows[0]}])[[*keys, *names]]

    importable(df.sparkSession)
    return df.select(*keys, *inputs).groupBy(*keys).applyInPandasWithState(update, schema, fields, "update", "NoTimeout")


def sliding_stats(
    df: DataFrame,
    key: str,
    ts: str,
    value: str,
    size: str = "10 seconds",
    slide: str = "3 seconds",
    watermark: str | None = None,
) -> DataFrame:
    """First time, last time and sum per sliding window and key; ``ts`` must be a TIMESTAMP.

    Windows start at whole multiples of the slide since the epoch, and the window's
    bounds stay in the output.
    """
    rows = df.withWatermark(ts, watermark) if watermark else df
    return (
        rows.groupBy(F.window(ts, size, slide).alias("w"), key)
        .agg(
            F.min(ts).alias("min_timestamp"),
            F.max(ts).alias("max_timestamp"),
            F.sum(value).alias("sum_value"),
        )
        .select(
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            key,
            "min_timestamp",
            "max_timestamp",
            "sum_value",
        )
    )


def sliding_panes(df: DataFrame, key: str, ts: str, value: str, size: int = 10, slide: int = 3) -> DataFrame:
    """:func:`sliding_stats` of a batch, ``size`` and ``slide`` in whole seconds, by way of panes.

    A pane is the greatest common divisor of both long, so every window is whole panes. Rows are first summed up per pane
    and key (combined map-side), and only those sums go to the windows that hold them, each of which is combined again
    before it is sent: what is shuffled is a row for a pane and key, not one for a row and window.
    """
    step = math.gcd(size, slide) * 1_000_000
    micros = F.unix_micros(ts)
    panes = df.where(F.col(ts).isNotNull()).groupBy((micros - F.pmod(micros, F.lit(step))).alias("_pane"), key).agg(
        F.min(ts).alias("min_timestamp"), F.max(ts).alias("max_timestamp"), F.sum(value).alias("sum_value")
    )
    last = F.col("_pane") - F.pmod("_pane", F.lit(slide * 1_000_000))
    steps = F.sequence(F.lit(0), F.lit(-(-size // slide) - 1))
    placed = panes.withColumn("_start", F.explode(F.transform(steps, lambda i: last - i * slide * 1_000_000)))
    placed = placed.where(F.col("_start") + size * 1_000_000 > F.col("_pane"))
    return placed.groupBy("_start", key).agg(
        F.min("min_timestamp").alias("min_timestamp"), F.max("max_timestamp").alias("max_timestamp"), F.sum("sum_value").alias("sum_value")
    ).select(
        F.timestamp_micros("_start").alias("window_start"), F.timestamp_micros(F.col("_start") + size * 1_000_000).alias("window_end"),
        key, "min_timestamp", "max_timestamp", "sum_value",
    )
