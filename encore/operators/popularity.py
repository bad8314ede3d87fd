"""Popularity boards: averages of daily peaks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.functions.calendar import local_date, period_key, period_start
from encore.operators.campaigns import POPULARITY_KEYS, Span, match_campaigns

PERIODS = tuple(POPULARITY_KEYS)


def host_day_peak(
    readings: DataFrame, campaigns: DataFrame, tz: str = "UTC", span: Span | None = None
) -> DataFrame:
    """Highest reading per (project, host_id, day).

    The day is that of the reading's own clock text ``time`` if the column is there,
    else of ``time_u`` in ``tz``; the campaign gate always goes by ``time_u``.
    """
    if "time" in readings.columns:
        day = F.substring("time", 1, 10).try_cast("date")
    else:
        day = local_date(F.col("time_u"), tz)
    return (
        match_campaigns(readings, campaigns, span=span)
        .groupBy("project", "host_id", day.alias("day"))
        .agg(F.max("num").alias("peak"))
    )


def popularity_scores(peaks: DataFrame, campaigns: DataFrame, periods=PERIODS, tz: str = "UTC") -> DataFrame:
    """Average of the non-zero daily peaks from the campaign's start, per period.

    Integer division; only positive averages make a row. The trailing range of a period
    always ends at its newest day, so the final score is one aggregate over the period.
    """
    switches = campaigns.select("project", "start_u", *[f"popular_{p}" for p in POPULARITY_KEYS])
    listed = F.array(*[F.struct(F.lit(p).alias("period"), F.col(f"popular_{p}").alias("on")) for p in periods])
    rows = (
        peaks.where(F.col("peak") != 0)
        .join(switches, "project")
        .where(F.col("day") >= local_date(F.col("start_u"), tz))
        .select("project", "host_id", "day", "peak", F.inline(F.filter(listed, lambda p: p.on)))
        .withColumn("date", period_start(F.col("period"), F.col("day")))
    )
    sums = rows.groupBy("project", "period", "date", F.col("host_id").alias("member")).agg(
        F.sum(F.col("peak").cast("bigint")).alias("_sum"), F.count("*").alias("_days")
    )
    return sums.where(F.col("_sum") > 0).select(
        "project",
        F.lit("all").alias("scope"),
        "period",
        period_key(F.col("period"), F.col("date")).alias("period_key"),
        "member",
        F.expr("_sum div _days").alias("score"),
    )
