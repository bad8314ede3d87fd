"""Watch time from heartbeats, and the sign-in days earned with it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from encore.functions.calendar import local_date, minute_floor
from encore.operators.asof import asof_category
from encore.operators.campaigns import match_campaigns

SKETCH = 12  # binary logarithm of a sketch's buckets
SIGN_IN_MINUTES = 170
# A local day touches at most 26 clock hours (25 in a long day, one more where the zone
# is not a whole number of hours off), so hour number mod 26 never meets itself in a day.
HOURS = 26
KEYS = ("uid",)  # whose minutes are counted; ("project", "uid") counts them by campaign
WORDS = [f"h{i}" for i in range(HOURS)]


def in_range(events: DataFrame, start_u: int, end_u: int) -> DataFrame:
    """Both ends count."""
    return events.where(F.col("time_u").between(start_u, end_u))


def rooms_of(heartbeats: DataFrame, stream_room: DataFrame) -> DataFrame:
    """Add ``room_id``; heartbeats of unmapped streams are dropped."""
    known = stream_room.where(F.col("room_id").isNotNull() & (F.col("room_id") != "")).select("stream", "room_id")
    return heartbeats.join(known, "stream")


def beats_in_category(
    heartbeats: DataFrame, stream_room: DataFrame, switches: DataFrame, cates: list[str], history: str = "last"
) -> DataFrame:
    """Heartbeats whose room was in one of ``cates`` at the time; there is no wildcard."""
    placed = asof_category(rooms_of(heartbeats, stream_room), switches, history=history)
    return placed.where(F.col("cate").isin(*cates))


def beats_of_campaigns(
    heartbeats: DataFrame, stream_room: DataFrame, switches: DataFrame, campaigns: DataFrame, history: str = "last", **how
) -> DataFrame:
    """Heartbeats with the ``project`` of every campaign whose time range (both ends count) and categories they meet.

    A campaign without categories has no watch time: there is no wildcard here.
    """
    placed = asof_category(rooms_of(heartbeats, stream_room), switches, history=history)
    asked = campaigns.where(F.size("cates") > 0).select("project", "start_u", "end_u", "cates", "gift_ids")
    return match_campaigns(placed, asked, **how).select(*placed.columns, "project")


def expand_minutes(beats: DataFrame, tz: str = "UTC", keys: tuple[str, ...] = KEYS) -> DataFrame:
    """(keys, day, minute_u): a player beat is its minute, a client beat also the one before.

    The day is that of the minute, so a client beat at midnight reaches into two days.
    """
    minute = minute_floor(F.col("time_u"))
    minutes = F.when(F.col("flag") == "p", F.array(minute)).otherwise(F.array(minute - 60, minute))
    rows = beats.select(*keys, F.explode(minutes).alias("minute_u"))
    return rows.select(*keys, local_date(F.col("minute_u"), tz).alias("day"), "minute_u")


def watch_minutes(beats: DataFrame, tz: str = "UTC", keys: tuple[str, ...] = KEYS) -> DataFrame:
    """Distinct (keys, day, minute_u)."""
    return expand_minutes(beats, tz, keys).distinct()


def _hour(minute_u: Column) -> Column:
    return F.pmod(F.floor(minute_u / 3600), F.lit(HOURS))


def minute_words(minutes: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """The minutes of each (keys, day) as one 60-bit word per hour.

    A user-day is a single fixed-width row, combined map-side with ``bit_or``: duplicates
    cost nothing, one shuffle is enough, and it also runs as a streaming aggregate.
    """
    position = F.floor(F.pmod(F.col("minute_u"), F.lit(3600)) / 60).cast("int")
    bits = minutes.select(
        *keys, "day", _hour(F.col("minute_u")).alias("_hour"), F.expr("1L").alias("_one"), position.alias("_pos")
    ).withColumn("_bit", F.expr("shiftleft(_one, _pos)"))
    words = [
        F.coalesce(F.bit_or(F.when(F.col("_hour") == i, F.col("_bit"))), F.lit(0).cast("bigint")).alias(w)
        for i, w in enumerate(WORDS)
    ]
    return bits.groupBy(*keys, "day").agg(*words)


def merge_words(words: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """Join partial words of the same (keys, day)."""
    return words.groupBy(*keys, "day").agg(*[F.bit_or(w).alias(w) for w in WORDS])


def count_words() -> Column:
    return reduce(lambda a, b: a + b, [F.bit_count(w) for w in WORDS])


def minutes_per_day(beats: DataFrame, tz: str = "UTC", keys: tuple[str, ...] = KEYS) -> DataFrame:
    """Distinct watched minutes per (keys, day), exact."""
    return minute_words(expand_minutes(beats, tz, keys), keys).select(
        *keys, "day", count_words().cast("bigint").alias("minutes")
    )


def minutes_per_day_approx(beats: DataFrame, tz: str = "UTC", rsd: float = 0.01) -> DataFrame:
    """The same by a cardinality sketch."""
    return (
        expand_minutes(beats, tz).groupBy("uid", "day").agg(F.approx_count_distinct("minute_u", rsd).alias("minutes"))
    )


def minute_sketches(minutes: DataFrame, keys: tuple[str, ...] = KEYS, lg: int = SKETCH) -> DataFrame:
    """The minutes of each (keys, day) as a sketch of at most ``2 ** lg`` buckets, which can be added to.

    ``minutes`` are rows of :func:`expand_minutes`. A sketch has a bounded size however many minutes it has seen.
    """
    return minutes.groupBy(*keys, "day").agg(F.hll_sketch_agg("minute_u", lg).alias("sketch"))


def merge_sketches(sketches: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """Sketches of the same (keys, day) as one, as if one had seen all minutes."""
    return sketches.groupBy(*keys, "day").agg(F.hll_union_agg("sketch").alias("sketch"))


def estimate_minutes(sketches: DataFrame, keys: tuple[str, ...] = KEYS, lg: int = SKETCH) -> DataFrame:
    """What sketches tell: ``minutes``, and ``low`` and ``high``, between which the true number lies 997 times of a thousand.

    The standard error is 1.04 over the root of the number of buckets; small sketches list what they have seen and
    are exact but for collisions.
    """
    error = 3 * 1.04 / 2 ** (lg / 2)
    told = sketches.select(*keys, "day", F.hll_sketch_estimate("sketch").alias("minutes"))
    return told.withColumn("low", F.floor(F.col("minutes") / (1 + error))).withColumn("high", F.ceil(F.col("minutes") / (1 - error)))


def signin_days(per_day: DataFrame, threshold: int = SIGN_IN_MINUTES, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """(keys, day) of every day with at least ``threshold`` watched minutes."""
    return per_day.where(F.col("minutes") >= threshold).select(*keys, "day")


def signin_events(days: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """One message per signed-in day: the user's total so far, also as JSON ``value``.

    A pure function of the days, so a failed send can simply be repeated.
    """
    order = Window.partitionBy(*keys).orderBy("day")
    counted = days.withColumn("days", F.count("*").over(order))
    return counted.withColumn("value", F.to_json(F.struct("uid", "days")))


def nth_signin_day(days: DataFrame, n: int = 1) -> DataFrame:
    """The day on which each user signed in for the n-th time."""
    order = Window.partitionBy("uid").orderBy("day")
    return days.withColumn("nth", F.row_number().over(order)).where(F.col("nth") == n).drop("nth")
