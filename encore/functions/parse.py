"""Wire formats to columns.

Every parser keeps the raw ``value`` and adds an ``error`` column that is null for a
usable record. Nothing is thrown away here: :func:`good` and :func:`quarantine` split
the result, so a bad record can be stored and never fails a batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


CLIENT_BEAT = "GET /client_punch.gif?"  # Fixed value: how access logs show a client beat


def good(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("error").isNull()).drop("value", "error")


def quarantine(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("error").isNotNull()).select("value", "error")


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def _once(df: DataFrame, value: str, *columns: Column, keep: tuple[str, ...] = ()) -> DataFrame:
    """The line, the columns ``keep`` and the parsed ones.

    Generated rather than projected: the optimizer copies a projected expression into
    every later use and filter, and parsing is the expensive part of these jobs.
    """
    return df.select(F.col(value).alias("value"), *keep, F.inline(F.array(F.struct(*columns))))


def _envelope(df: DataFrame, value: str, fields: T.StructType, keep: tuple[str, ...] = ()) -> DataFrame:
    """Open ``{"data": "<json text>", ...}``: the payload is JSON inside a JSON string."""
    payload = F.from_json(F.get_json_object(F.col(value), "$.data"), fields)
    return _once(df, value, payload.alias("d"), keep=keep)


def _first_error(**required: Column) -> Column:
    """Name of the first required field that is missing or unusable."""
    return F.coalesce(*[F.when(ok.isNull() | ~ok, F.lit(name)) for name, ok in required.items()])


def _long(text: Column) -> Column:
    """Whole part of a number given as text (``"1540796914.95"`` gives 1540796914); null for what is no such number."""
    return text.try_cast("double").try_cast("bigint")


def parse_gift(df: DataFrame, value: str = "value") -> DataFrame:
    """Gift envelope to (uid, qid, room_id, gift_id, total, cate, time_u)."""
    fields = _strings("uid", "anchor", "roomid", "giftid", "total", "cate", "time")
    rows = _envelope(df, value, fields).select(
        "value",
        F.col("d.uid").alias("uid"),
        F.col("d.anchor").alias("qid"),
        F.col("d.roomid").alias("room_id"),
        F.col("d.giftid").alias("gift_id"),
        F.col("d.total").try_cast("int").alias("total"),
        F.col("d.cate").alias("cate"),
        _long(F.col("d.time")).alias("time_u"),
    )
    present = {n: F.col(n).isNotNull() for n in ("uid", "qid", "room_id", "gift_id", "total", "cate", "time_u")}
    return rows.withColumn("error", _first_error(**present))


def positive_gifts(gifts: DataFrame) -> DataFrame:
    """A gift counts only with a total above zero."""
    return gifts.where(F.col("total") > 0)


def parse_popularity(df: DataFrame, value: str = "value") -> DataFrame:
    """Popularity envelope to (host_id, room_id, cate, num, time_u, time)."""
    fields = _strings("classification", "hostid", "roomid", "person_num", "timestamp")
    rows = _envelope(df, value, fields).select(
        "value",
        F.col("d.hostid").alias("host_id"),
        F.col("d.roomid").alias("room_id"),
        F.col("d.classification").alias("cate"),
        F.col("d.person_num").try_cast("int").alias("num"),
        _long(F.col("d.timestamp")).alias("time_u"),
        F.get_json_object("value", "$.time").alias("time"),
    )
    checks = {n: F.col(n).isNotNull() for n in ("host_id", "room_id", "cate", "num", "time_u")}
    checks["time"] = F.try_to_timestamp("time", F.lit("yyyy-MM-dd HH:mm:ss")).isNotNull()
    return rows.withColumn("error", _first_error(**checks))


def parse_profile_change(df: DataFrame, value: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Profile or room-number change, routed by which id the payload carries.

    ``kind`` is ``profile`` (rid, nickname and/or avatar) or ``room`` (hostid, new_id). ``keep`` names columns of ``df``
    to carry along, such as the record's offset, by which changes are ordered.
    """
    d = F.col("d")
    rows = _envelope(df, value, _strings("rid", "nickname", "avatar", "hostid", "new_id"), keep).select(
        "value",
        *keep,
        F.when(d.rid.isNotNull(), "profile").when(d.hostid.isNotNull(), "room").alias("kind"),
        F.coalesce(d.rid, d.hostid).alias("rid"),
        F.when(d.rid.isNotNull(), d.nickname).alias("nickname"),
        F.when(d.rid.isNotNull(), d.avatar).alias("avatar"),
        F.when(d.rid.isNull(), d.new_id).alias("room_id"),
    )
    complete = (F.col("kind") == "profile") | F.col("room_id").isNotNull()
    return rows.withColumn("error", _first_error(rid=F.col("rid").isNotNull(), new_id=complete))


def parse_heartbeat(df: DataFrame, stream_prefix: str, value: str = "value", client: str = CLIENT_BEAT) -> DataFrame:
    """Access-log line to (uid, stream, flag, time_u); flag ``c`` marks the two-minute client beat.

    ``stream_prefix`` is the url-encoded path that stands before the stream name, ``client`` the request of a client beat.
    """
    line = F.col(value)
    stamp = F.regexp_extract(line, r"\[([^\]]*)\]", 1)
    url = F.regexp_extract(line, r"[?&]u=(.*?)\.flv", 1)
    # F.split takes a regular expression; \Q..\E keeps the prefix literal.
    path = F.get(F.split(url, rf"\Q{stream_prefix}\E"), F.lit(1))
    rows = _once(
        df,
        value,
        F.regexp_extract(line, r"\buid=([^& ]*)", 1).alias("uid"),
        F.get(F.split(path, "_"), F.lit(0)).alias("stream"),
        F.when(line.contains(client), "c").otherwise("p").alias("flag"),
        F.unix_seconds(F.try_to_timestamp(stamp, F.lit("dd/MMM/yyyy:HH:mm:ss Z"))).alias("time_u"),
    )
    return rows.withColumn(
        "error",
        _first_error(
            time_u=F.col("time_u").isNotNull(),
            uid=F.col("uid").try_cast("bigint") > 0,
            stream=F.col("stream") != "",
        ),
    )


def parse_switch(df: DataFrame, tz: str = "UTC", value: str = "value") -> DataFrame:
    """Tab-separated category switch to (room_id, cate, time_u): fields 0, 3 and 5 of at least 6."""
    cells = F.split(F.col(value), "\t")
    # Parsed with an explicit offset-free UTC suffix, then moved to the zone of the log.
    stamp = F.concat(F.get(cells, F.lit(5)), F.lit(" +0000"))
    wall = F.try_to_timestamp(stamp, F.lit("yyyy-MM-dd HH:mm:ss Z"))
    instant = wall if tz == "UTC" else F.to_utc_timestamp(wall, tz)
    rows = _once(
        df,
        value,
        F.size(cells).alias("_cells"),
        F.get(cells, F.lit(0)).alias("room_id"),
        F.get(cells, F.lit(3)).alias("cate"),
        F.unix_seconds(instant).alias("time_u"),
    )
    return rows.withColumn(
        "error", _first_error(fields=F.col("_cells") >= 6, time_u=F.col("time_u").isNotNull())
    ).drop("_cells")


def parse_clicks(df: DataFrame, value: str = "value") -> DataFrame:
    """Click JSON to (uid, event_time, os_type, click_count); counts arrive as doubles."""
    fields = _strings("uid", "event_time", "os_type", "click_count")
    rows = _once(df, value, F.from_json(value, fields).alias("d")).select(
        "value", "d.uid", "d.event_time", "d.os_type", _long(F.col("d.click_count")).try_cast("int").alias("click_count")
    )
    return rows.withColumn(
        "error", _first_error(uid=F.col("uid").isNotNull(), click_count=F.col("click_count").isNotNull())
    )


def parse_reading(df: DataFrame, value: str = "value") -> DataFrame:
    """``id,yyyy-MM-dd HH:mm:ss,int`` to (id, timestamp, value); the raw line is kept as ``line``."""
    cells = F.split(F.trim(F.col(value)), ",")
    rows = df.select(
        F.col(value).alias("line"),
        F.get(cells, F.lit(0)).alias("id"),
        F.try_to_timestamp(F.get(cells, F.lit(1)), F.lit("yyyy-MM-dd HH:mm:ss")).alias("timestamp"),
        F.get(cells, F.lit(2)).try_cast("int").alias("value"),
    )
    return rows.withColumn(
        "error", _first_error(timestamp=F.col("timestamp").isNotNull(), value=F.col("value").isNotNull())
    )


def parse_people(df: DataFrame, value: str = "value") -> DataFrame:
    """``name, age`` lines to (name, age)."""
    cells = F.split(F.col(value), ",")
    rows = df.select(
        F.col(value).alias("value"),
        F.get(cells, F.lit(0)).alias("name"),
        F.trim(F.get(cells, F.lit(1))).try_cast("bigint").alias("age"),
    )
    return rows.withColumn("error", _first_error(age=F.col("age").isNotNull()))


def words(df: DataFrame, value: str = "value") -> DataFrame:
    """One row per space-separated word of each line, as column ``value``.

    Trailing spaces give no words; spaces in a row elsewhere give empty ones.
    """
    text = F.rtrim(F.col(value))
    cells = F.when((text == "") & (F.length(value) > 0), F.array().cast("array<string>")).otherwise(
        F.split(text, " ")
    )
    return df.select(F.explode(cells).alias("value"))


def lines(df: DataFrame, text: str) -> DataFrame:
    """One row per line of a text column, as column ``value``."""
    return df.select(F.explode(F.split(F.col(text), "\n")).alias("value"))


def options(text: str) -> dict[str, str]:
    """Job arguments ``k=v,k=v`` as keyword arguments."""
    pairs = (part.partition("=") for part in text.split(",") if part)
    return {key.strip(): val for key, _, val in pairs}
