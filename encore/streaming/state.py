"""State that the engine keeps for a stream, and how it is read.

A job whose result is its state writes nothing else: sums and maxima per key lie in the state store of its checkpoint,
which the engine changes, snapshots and restores with every batch. The ``statestore`` source reads the state of the last
committed batch, also while the query runs.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from encore.session import ROCKS, importable


#: State outside the heap, which timers need; a batch does not count all rows anew. Keys are columns of boards, much alike.
KEPT = {
    "spark.sql.streaming.stateStore.providerClass": ROCKS,
    "spark.sql.streaming.stateStore.rocksdb.compression": "zstd",
    "spark.sql.streaming.stateStore.compression.codec": "zstd",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}
CHANGELOG = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"


def keep_outside_heap(spark: SparkSession, every: str | None = None) -> None:
    """Streams that start from now on have their state in RocksDB.

    With ``every``, of a job with many small batches, a batch uploads its changes. Without it batches are few and large: each
    uploads the store's own sorted files, which are smaller, and a restart or reader opens them instead of putting every change
    in again. A checkpoint may go from one to the other.
    """
    for key, value in {**KEPT, CHANGELOG: "true" if every else "false"}.items():
        spark.conf.set(key, value)


def start_kept(rows: DataFrame, checkpoint: str, every: str | None = None, mode: str = "update") -> StreamingQuery:
    """Run a stateful stream for its state alone, in RocksDB. ``every`` is the batch interval; without it the query works off
    what is there and ends."""
    keep_outside_heap(rows.sparkSession, every)
    writer = rows.writeStream.format("noop").option("checkpointLocation", checkpoint).outputMode(mode)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def read_kept(spark: SparkSession, checkpoint: str, schema: str, variable: str | None = None) -> DataFrame:
    """The state after the last committed batch as columns of ``schema``: the keys, then the values, in their order.

    Of a stream that has not committed a batch it is empty. ``variable`` names one of a processor's state variables.
    """
    kept = T.StructType.fromDDL(schema)
    reader = spark.read.format("statestore")
    try:
        state = (reader.option("stateVarName", variable) if variable else reader).load(checkpoint)
    except PySparkException as missing:
        if not (missing.getCondition() or "").startswith("STDS_"):
            raise
        if has_commits(spark, checkpoint):
            raise
        return spark.createDataFrame([], kept)
    values = state.schema["value"].dataType
    inner = ("value.groupState", values["groupState"].dataType) if "groupState" in values.names else ("value", values)
    told = [F.col(f"{part}.`{name}`") for part, kind in (("key", state.schema["key"].dataType), inner) for name in kind.names]
    return state.select(*[c.cast(f.dataType).alias(f.name) for c, f in zip(told, kept, strict=True)])


def has_commits(spark: SparkSession, checkpoint: str) -> bool:
    """Whether a query has finished a batch under this checkpoint."""
    try:
        return not spark.read.text(f"{checkpoint}/commits").isEmpty()
    except PySparkException:
        return False


def rounds(start: Callable[[], StreamingQuery], pause: float, go_on: Callable[[], bool]) -> None:
    """Run a job that works off what is there again and again, until ``go_on`` says no.

    Every round starts the job anew under its checkpoint, so dimensions that it gets as functions are read again: a changed
    configuration takes effect at the next round, while keyed state goes on.
    """
    while go_on():
        start().awaitTermination()
        time.sleep(pause)


class ExpiringSum(StatefulProcessor):
    """The sum of each key, which goes ``keep`` seconds after the key's last write.

    A write that comes later than that starts anew, and a timer drops what nobody writes to any more once the watermark has
    passed its end.
    """

    def __init__(self, keys: list[str], keep: int) -> None:
        self.keys, self.keep = keys, keep

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.kept = handle.getValueState("kept", "total bigint, last_u bigint")

    def _told(self, key, total, last, gone: bool) -> pd.DataFrame:
        return pd.DataFrame([(*key, total, last, gone)], columns=[*self.keys, "total", "last_u", "gone"])

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        total, last = self.kept.get() if self.kept.exists() else (0, None)
        frames = list(rows)
        at, value = (np.concatenate([f[c].to_numpy(np.int64) for f in frames]) for c in ("written_u", "written_value"))
        order = np.argsort(at, kind="stable")
        at, value = at[order], value[order]
        before = np.concatenate([[at[0] if last is None else last], at[:-1]])
        before = np.maximum.accumulate(before)
        fresh = np.flatnonzero(at - before > self.keep)
        first = fresh[-1] if len(fresh) else 0
        total = int(value[first:].sum()) + (0 if len(fresh) else total)
        last = int(max(at[-1], before[-1]))
        self.kept.update((total, last))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer((last + self.keep + 1) * 1000)
        yield self._told(key, total, last, False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        total, last = self.kept.get()
        self.kept.clear()
        yield self._told(key, total, last, True)

    def close(self) -> None:
        pass


def expiring_sums(rows: DataFrame, keys: list[str], value: str, time: str, keep: int, late: str = "0 seconds") -> DataFrame:
    """Changes of additive upserts with a time to live per key: the keys, ``total``, ``last_u`` and ``gone``.

    ``time`` is a timestamp column. A key's sum is kept for ``keep`` seconds after its last write, by the rows' own times
    in whole seconds; rows that come more than ``late`` behind the newest one are dropped. Only keys that are written to, and
    those whose time has come, are touched. Run it by :func:`start_kept` and read it by :func:`read_sums`.
    """
    importable(rows.sparkSession)
    told = rows.withWatermark(time, late).select(
        *keys, F.unix_seconds(time).alias("written_u"), F.col(value).cast("bigint").alias("written_value"), time
    )
    kinds = ", ".join(f"{k} {dict(told.dtypes)[k]}" for k in keys)
    schema = f"{kinds}, total bigint, last_u bigint, gone boolean"
    return told.groupBy(*keys).transformWithStateInPandas(ExpiringSum(keys, keep), schema, "Update", "EventTime")


def read_sums(spark: SparkSession, checkpoint: str, keys: str) -> DataFrame:
    """The live sums of :func:`expiring_sums`; ``keys`` gives the keys' columns and types."""
    return read_kept(spark, checkpoint, f"{keys}, total bigint, last_u bigint", "kept")


def _foremost(rows: pa.Table, by: list[str], k: int) -> pa.Table:
    """Rows that can be among the ``k`` best members of their board: of every member its best, down to the ``k``-th best score,
    and those at which there is nothing to compare."""
    known = pc.and_(pc.is_valid(rows["member"]), pc.is_valid(rows["score"]))
    rows, others = rows.filter(known).combine_chunks(), rows.filter(pc.invert(known))
    if not len(rows):
        return others
    board, kinds = np.zeros(len(rows), np.int64), 1
    for name in [*by, "member"]:
        if kinds > 1 << 40:
            board = np.unique(board, return_inverse=True)[1]
            kinds = int(board.max()) + 1
        if name == "member":
            key = board  # of the board alone
        told = pc.dictionary_encode(rows[name].combine_chunks(), null_encoding="encode")
        told = told.combine_chunks() if isinstance(told, pa.ChunkedArray) else told
        board, kinds = board * len(told.dictionary) + told.indices.to_numpy(zero_copy_only=False), kinds * len(told.dictionary)
    score = rows["score"].to_numpy()
    order = np.lexsort((score, board))
    at = order[np.append(board[order][1:] != board[order][:-1], True)]
    at = at[np.lexsort((-score[at], key[at]))]
    first = np.flatnonzero(np.append(True, key[at][1:] != key[at][:-1]))
    size = np.diff(np.append(first, len(at)))
    lowest = np.where(size >= k, score[at][np.minimum(first + k - 1, len(at) - 1)], np.iinfo(np.int64).min)
    return pa.concat_tables([rows.take(at[score[at] >= np.repeat(lowest, size)]), others])


def _foremost_of_parts(by: list[str], k: int, at_most: int = 1 << 19) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """:func:`_foremost` of the rows of each task, which holds some ``at_most`` of them and hands on what does not get fewer."""

    def pruned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        count = 0
        for batch in batches:
            held.append(batch)
            count += batch.num_rows
            if count >= at_most:
                held = _foremost(pa.Table.from_batches(held), by, k).to_batches()
                count = sum(b.num_rows for b in held)
                if count > at_most // 2:
                    yield from held
                    held, count = [], 0
        if held:
            yield from _foremost(pa.Table.from_batches(held), by, k).to_batches()

    return pruned


def top_lists(changes: DataFrame, by: list[str], k: int, slots: int = 1) -> DataFrame:
    """Keep each board's list of its ``k`` best members, and tell the touched members that are on it.

    ``changes`` is a stream of boards, ``member`` (text) and its new whole ``score``, which only grows, as sums of positive
    parts and maxima do. So a member that no row touches cannot enter a list: a batch holds the touched members against the
    lowest of the list and reads no other board. Each task sends on only rows that can be among the best ``k`` of those touched,
    as no other member can be on the list then. Rows that come twice or late change no list. A board with very many
    members is kept in ``slots`` lists, by a hash of the member; the best ``k`` of them are the board's.
    """

    def update(key, frames, state) -> Iterator[pd.DataFrame]:
        held = dict(zip(*state.get, strict=True)) if state.exists else {}
        touched: set[str] = set()
        for frame in frames:
            best = frame.groupby("member", sort=False)["score"].max()
            if len(held) >= k:
                best = best[(best >= min(held.values())) | best.index.isin(held)]
            for member, score in best.items():
                held[member] = max(int(score), held.get(member, int(score)))
                touched.add(member)
            if len(held) > k:
                held = dict(sorted(held.items(), key=lambda m: (m[1], m[0].encode()), reverse=True)[:k])
        state.update((list(held), list(held.values())))
        on = [m for m in touched if m in held]
        yield pd.DataFrame({**dict(zip(names, key, strict=True)), "member": on, "score": [held[m] for m in on]}, columns=[*names, "member", "score"])

    importable(changes.sparkSession)
    names = [*by, "slot"]
    told = changes.withColumn("slot", F.pmod(F.xxhash64("member"), F.lit(slots)))
    told = told.mapInArrow(_foremost_of_parts(names, k), told.schema)
    kinds = dict(told.dtypes)
    schema = ", ".join(f"{c} {kinds[c]}" for c in names) + ", member string, score bigint"
    return told.groupBy(*names).applyInPandasWithState(update, schema, "members array<string>, scores array<bigint>", "append", "NoTimeout")


def read_lists(spark: SparkSession, checkpoint: str, by: str) -> DataFrame:
    """The lists of :func:`top_lists`: boards (columns and types in ``by``), ``member``, ``score``."""
    lists = read_kept(spark, checkpoint, f"{by}, slot bigint, members array<string>, scores array<bigint>")
    return lists.select("*", F.explode(F.arrays_zip("members", "scores")).alias("m")).select(
        *[f.name for f in T.StructType.fromDDL(by)], F.col("m.members").alias("member"), F.col("m.scores").alias("score")
    )
