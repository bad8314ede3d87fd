"""As-of joins of two streams by event time.

Both streams come in any order; the watermark says when a time is complete. Until then events wait in the state of their
room, beside the room's switches; after it of older switches only the one that is still valid is kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from encore.session import importable

STATE = "times array<bigint>, highs array<string>, lows array<string>, first string, waiting array<bigint>, events array<string>"


def asof_stream(events: DataFrame, switches: DataFrame, late: str, fallback: str = "earliest", slots: int = 1) -> DataFrame:
    """Add ``cate`` to a stream of events: the newest switch of the event's room at or before its ``time_u``.

    ``switches`` is a stream of ``room_id``, ``cate``, ``time_u``; rows of either that come more than ``late`` behind the
    newest row of both are dropped, as are rows without a room or a time. An event leaves once the watermark has passed its
    time and the room's first switch. Before that switch it gets the room's earliest category, or null with
    ``fallback='null'``; events of a room without switches wait on. Switches of one second count as one, the highest
    category in text order. The events of a busy room are dealt over ``slots`` states.
    """
    importable(events.sparkSession)
    fields = T.StructType(events.schema.fields)
    dealt = F.pmod(F.xxhash64(*events.columns), F.lit(slots)).cast("int")
    nothing = F.lit(None).cast("string")
    beats = events.select("room_id", dealt.alias("slot"), "time_u", nothing.alias("cate"), F.to_json(F.struct(*events.columns)).alias("event"))
    every = F.explode(F.sequence(F.lit(0), F.lit(slots - 1))).alias("slot")
    turns = switches.where("cate IS NOT NULL").select("room_id", every, "time_u", "cate", nothing.alias("event"))
    rows = beats.unionByName(turns).withColumn("at", F.timestamp_seconds("time_u")).withWatermark("at", late)
    rows = rows.where("room_id IS NOT NULL AND time_u IS NOT NULL")

    def update(key, frames, state) -> Iterator[pd.DataFrame]:
        times, highs, lows, first, waiting, held = state.get if state.exists else ([], [], [], None, [], [])
        high, low = dict(zip(times, highs, strict=True)), dict(zip(times, lows, strict=True))
        waiting, held = list(waiting), list(held)
        for frame in frames if not state.hasTimedOut else ():
            event = frame["event"].notna()
            for t, c in zip(frame["time_u"][~event].tolist(), frame["cate"][~event].tolist(), strict=True):
                high[t], low[t] = max(c, high.get(t, c)), min(c, low.get(t, c))
            waiting += frame["time_u"][event].tolist()
            held += frame["event"][event].tolist()
        complete = state.getCurrentWatermarkMs() // 1000  # rows up to this second come no more
        past = np.array(sorted(t for t in high if t <= complete), np.int64)
        if first is None and len(past):
            first = low[int(past[0])]
        if first is not None:
            at = np.array(waiting, np.int64)
            gone = np.flatnonzero(at <= complete)
            spot = np.searchsorted(past, at[gone], "right") - 1
            early = first if fallback == "earliest" else None
            cates = [high[int(past[s])] if s >= 0 else early for s in spot]
            yield pd.DataFrame({"event": [held[i] for i in gone], "cate": pd.Series(cates, dtype=object)})
            left = np.flatnonzero(at > complete)
            waiting, held = at[left].tolist(), [held[i] for i in left]
        kept = [int(t) for t in past[-1:]] + sorted(t for t in high if t > complete)
        state.update((kept, [high[t] for t in kept], [low[t] for t in kept], first, waiting, held))
        coming = [t for t in [*kept, *waiting] if t > complete]
        if coming:
            state.setTimeoutTimestamp(min(coming) * 1000)

    found = rows.groupBy("room_id", "slot").applyInPandasWithState(update, "event string, cate string", STATE, "append", "EventTimeTimeout")
    return found.select(F.from_json("event", fields).alias("e"), "cate").select("e.*", "cate")
