"""Calendar columns over epoch seconds.

Everything here gives the same answer under any session time zone: zone-less
timestamps are read as UTC and the calendar zone is an explicit argument.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DAY = 86400
EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _utc_session(df: DataFrame) -> bool:
    return df.sparkSession.conf.get("spark.sql.session.timeZone") in ("UTC", "Etc/UTC", "GMT", "Z")


def _instant(df: DataFrame, name: str) -> Column | None:
    """The column as an instant, if that takes no more than a cast."""
    if isinstance(df.schema[name].dataType, T.TimestampNTZType) and not _utc_session(df):
        return None
    return F.col(name).cast("timestamp")


def _wall_minutes(ts: Column) -> Column:
    """Whole minutes since the epoch of a zone-less timestamp."""
    days = F.unix_date(ts.cast("date")).cast("bigint")
    return days * 1440 + F.hour(ts) * 60 + F.minute(ts)


def epoch_seconds(df: DataFrame, name: str) -> Column:
    """Whole epoch seconds of a timestamp column, whichever timestamp type it has."""
    instant = _instant(df, name)
    if instant is not None:
        return F.unix_seconds(instant)
    return _wall_minutes(F.col(name)) * 60 + F.second(F.col(name))


def epoch_micros(df: DataFrame, name: str) -> Column:
    """Epoch microseconds of a timestamp column."""
    instant = _instant(df, name)
    if instant is not None:
        return F.unix_micros(instant)
    seconds = F.extract(F.lit("SECOND"), F.col(name))
    return _wall_minutes(F.col(name)) * 60_000_000 + (seconds * 1_000_000).cast("bigint")


def ntz_literal(epoch_s: int) -> Column:
    """A zone-less timestamp literal, for filters that should reach the scan."""
    return F.expr(f"{EPOCH} + INTERVAL '{int(epoch_s)}' SECOND")


def local_timestamp(time_u: Column, tz: str = "UTC") -> Column:
    """Wall-clock timestamp of epoch seconds in ``tz``."""
    utc = F.expr(EPOCH) + F.make_dt_interval(secs=time_u)
    return utc if tz == "UTC" else F.convert_timezone(F.lit("UTC"), F.lit(tz), utc)


def local_date(time_u: Column, tz: str = "UTC") -> Column:
    """Calendar date of epoch seconds in ``tz``."""
    if tz == "UTC":
        return F.date_from_unix_date(((time_u - F.pmod(time_u, F.lit(DAY))) / DAY).cast("int"))
    return local_timestamp(time_u, tz).cast("date")


def minute_floor(time_u: Column) -> Column:
    return time_u - F.pmod(time_u, F.lit(60))


def day_key(date: Column) -> Column:
    """yyyyMMdd; by arithmetic, which is several times cheaper than a formatter."""
    return (F.year(date) * 10000 + F.month(date) * 100 + F.dayofmonth(date)).cast("string")


def month_key(date: Column) -> Column:
    return (F.year(date) * 100 + F.month(date)).cast("string")


def week_key(date: Column) -> Column:
    """ISO year and week: week numbers alone would merge the same week of two years."""
    year = F.extract(F.lit("YEAROFWEEK"), date).cast("string")
    return F.concat(year, F.lit("-W"), F.lpad(F.weekofyear(date).cast("string"), 2, "0"))


ONE_PERIOD = "1970-01-01"


def period_start(period: Column, date: Column) -> Column:
    """First date of the calendar period (``all``, ``day``, ``week`` or ``month``) holding ``date``.

    Grouping by it is cheaper than by the text :func:`period_key` makes of it.
    """
    return (
        F.when(period == "day", date)
        .when(period == "week", F.trunc(date, "week"))
        .when(period == "month", F.trunc(date, "month"))
        .otherwise(F.lit(ONE_PERIOD).cast("date"))
    )


def period_key(period: Column, date: Column) -> Column:
    """Text key of the calendar period holding ``date``; empty for ``all``."""
    return (
        F.when(period == "day", day_key(date))
        .when(period == "week", week_key(date))
        .when(period == "month", month_key(date))
        .otherwise("")
    )


def day_number(date: Column, start: Column) -> Column:
    """1 on the start date, 2 on the day after, and so on."""
    return F.datediff(date, start) + 1
