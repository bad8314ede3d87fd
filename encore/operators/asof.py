"""Category history of rooms, and the category a room had at the time of an event."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BUCKET = 600
DAY = 86400


def latest_switch(switches: DataFrame) -> DataFrame:
    """Last switch time of each (room, category): A, B, A leaves one A."""
    return switches.groupBy("room_id", "cate").agg(F.max("time_u").alias("time_u"))


def category_intervals(switches: DataFrame, bucket: int = DAY) -> DataFrame:
    """Validity of each switch: [time_u, until_u), open at the newest one.

    Switches of one room at the same second count as one, the highest category in text order.
    The successor is looked for within the room's bucket; only the last switch of a bucket
    needs the first one of the room's next bucket. So a room with very many switches is
    sorted bucket by bucket, and per room only its buckets.
    """
    slot = F.floor(F.col("time_u") / bucket)
    single = switches.groupBy("room_id", "time_u").agg(F.max("cate").alias("cate")).withColumn("_slot", slot)
    firsts = switches.groupBy("room_id", slot.alias("_slot")).agg(F.min("time_u").alias("_first"))
    ahead = firsts.select(
        "room_id", "_slot", F.lead("_first").over(Window.partitionBy("room_id").orderBy("_slot")).alias("_ahead")
    )
    order = Window.partitionBy("room_id", "_slot").orderBy("time_u")
    inside = single.withColumn("_next", F.lead("time_u").over(order))
    joined = inside.join(ahead, ["room_id", "_slot"])
    return joined.select("room_id", "time_u", "cate", F.coalesce("_next", "_ahead").alias("until_u"))


def _asof_last(events: DataFrame, latest: DataFrame, fallback: str) -> DataFrame:
    """One list a room, as long as it had categories."""
    lists = latest.groupBy("room_id").agg(F.collect_list(F.struct("time_u", "cate")).alias("_list"))
    joined = events.join(lists, "room_id")
    within = F.array_max(F.filter("_list", lambda s: s.time_u <= F.col("time_u")))["cate"]
    options = [within] + ([F.array_min("_list")["cate"]] if fallback == "earliest" else [])
    return joined.select(*events.columns, F.coalesce(*options).alias("cate"))


def asof_category(
    events: DataFrame,
    switches: DataFrame,
    history: str = "last",
    fallback: str = "earliest",
    bucket: int = BUCKET,
) -> DataFrame:
    """Add ``cate``: the newest switch of the event's room at or before its ``time_u``.

    ``history='last'`` keeps one time per (room, category), ``'full'`` every switch.
    Before the first switch an event gets the room's earliest category, or null with
    ``fallback='null'``. Events of rooms without history are dropped.

    With one time per category a room's history is one short list, joined by room in one pass. Of the full history, time
    is cut into buckets. Per (room, bucket) there is exactly one lookup row: the
    category carried into the bucket and the switches inside it, at most one per second
    and so at most ``bucket`` of them however hot the room. Each event then meets one
    row: no candidate pairs, and a hot room spreads over its buckets (adaptive execution
    splits the event side of a bucket that is hot by itself).
    """
    if history == "last":
        return _asof_last(events, latest_switch(switches), fallback)
    slot = F.floor(F.col("time_u") / bucket)
    seconds = switches.groupBy("room_id", "time_u").agg(F.max("cate").alias("cate"), F.min("cate").alias("low"))
    asked = events.select("room_id", slot.alias("_slot")).distinct().withColumn("asked", F.lit(True))
    at = F.when(F.col("time_u").isNotNull(), F.struct("time_u", "cate"))
    merged = (
        seconds.withColumn("_slot", slot)
        .unionByName(asked, allowMissingColumns=True)
        .groupBy("room_id", "_slot")
        .agg(
            F.max("asked").alias("asked"),
            F.collect_list(at).alias("inside"),
            F.max(at).alias("last"),
            F.min(F.when(F.col("time_u").isNotNull(), F.struct("time_u", "low"))).alias("first"),
        )
    )
    # The window holds one row per room and bucket, never one per event.
    room = Window.partitionBy("room_id").orderBy("_slot")
    earlier = room.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("room_id")
    lookup = (
        merged.withColumn("carried", F.last(F.col("last.cate"), ignorenulls=True).over(earlier))
        .withColumn("earliest", F.min("first").over(whole)["low"])
        .where(F.col("asked") & F.col("earliest").isNotNull())
        .select("room_id", "_slot", "inside", "carried", "earliest")
    )
    joined = events.withColumn("_slot", slot).join(lookup, ["room_id", "_slot"])
    within = F.array_max(F.filter("inside", lambda s: s.time_u <= F.col("time_u")))["cate"]
    options = [within, F.col("carried")] + ([F.col("earliest")] if fallback == "earliest" else [])
    return joined.select(*events.columns, F.coalesce(*options).alias("cate"))
