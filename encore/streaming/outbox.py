"""Messages that are sent until there is a receipt.

A message is known by its keys. What a sender acknowledges gets a receipt row; a message without one is sent again by the
next run, so a failure loses none, and none that has a receipt is sent again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from encore.session import importable
from encore.streaming import sinks

#: Sends the messages of one batch of rows and tells for each a receipt, or None where it was not taken.
Send = Callable[[pd.DataFrame], list]


def _schema(messages: DataFrame, keys: list[str]) -> str:
    return ", ".join(f"{k} {dict(messages.dtypes)[k]}" for k in keys) + ", receipt string, sent_u bigint, attempt bigint"


def receipts(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One row for each message that was taken, the first if it was taken twice; empty before anything was sent.

    Between a send and the writing of its receipt a run can be lost; such a message is sent again, under the same keys, by
    which the receiver knows it.
    """
    kept = T.StructType.fromDDL(schema)
    keys = [f.name for f in kept][:-3]
    try:
        rows = spark.read.schema(kept).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], kept)
    first = F.min(F.struct("attempt", "sent_u", "receipt")).alias("r")
    return rows.groupBy(*keys).agg(first).select(*keys, "r.receipt", "r.sent_u", "r.attempt")


def send(messages: DataFrame, keys: list[str], sender: Callable[[], Send], path: str, attempt: int) -> DataFrame:
    """Send the messages that have no receipt below ``path``, and return the receipts of this run.

    ``messages`` holds the keys and what ``sender`` needs; repeated keys are one message, the least by its other columns. ``sender``
    makes a connection once for each task. Receipts are written to ``path``/attempt=``attempt`` as they come; the same attempt run
    again replaces its own.
    """
    spark, schema = messages.sparkSession, _schema(messages, keys)
    importable(spark)
    rest = [c for c in messages.columns if c not in keys]
    one = messages.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("m")).select(*keys, "m.*") if rest else messages.distinct()
    done = receipts(spark, path, schema).where(F.col("attempt") < attempt).select(*keys)
    todo = one.join(done, keys, "left_anti")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        deliver = sender()
        for frame in frames:
            told = pd.Series(deliver(frame), index=frame.index, dtype=object)
            taken = told.notna()
            yield frame[keys][taken].assign(receipt=told[taken].astype(str))

    names = schema.split(", sent_u")[0]
    sent = todo.mapInPandas(run, names).withColumn("sent_u", F.unix_timestamp())
    sent.write.mode("overwrite").parquet(f"{path}/attempt={attempt}")
    return spark.read.schema(f"{names}, sent_u bigint").parquet(f"{path}/attempt={attempt}").withColumn("attempt", F.lit(attempt).cast("bigint"))


def pending(messages: DataFrame, keys: list[str], path: str) -> DataFrame:
    """Messages that have no receipt yet."""
    return messages.join(receipts(messages.sparkSession, path, _schema(messages, keys)).select(*keys), keys, "left_anti")


def start_sending(
    messages: DataFrame, keys: list[str], sender: Callable[[], Send], log: str, path: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Send a stream of messages: with each batch goes what the one before could not get rid of, which is all that ``log`` is
    read for."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        before = sinks.read_batches(batch.sparkSession, log, batch.schema).where(F.col("batch_id") == batch_id - 1)
        todo = batch.unionByName(before.drop("batch_id"))
        send(todo, keys, sender, path, batch_id + 1)
        sinks.write_batch(pending(todo, keys, path), log, batch_id)

    return sinks.start(messages, handle, checkpoint, every=every)
