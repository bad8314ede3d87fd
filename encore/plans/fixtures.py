"""The event domains laid over the benchmark tables.

Gifts come from orders and their lines, readings, heartbeats and switches from events,
profiles from customers. Every view reads its whole tables.
"""

from __future__ import annotations

from calendar import timegm
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from encore.functions.calendar import epoch_seconds, ntz_literal
from encore.operators.campaigns import Span, campaign_span, parse_campaigns
from encore.session import roomy
from encore.sources.files import dealt


def utc(*moment: int) -> int:
    return timegm((*moment, *(0,) * (6 - len(moment)), 0, 0, 0))


def _config(project: str, start: int, end: int, **more) -> tuple[str, str]:
    parts = {"project": project, "startTimeU": start, "endTimeU": end, **more}
    return project, ",".join(f"{k}={v}" for k, v in parts.items())


ON = "true"
CONFIGS = [
    _config("opening", utc(1996, 1, 1), utc(1999, 12, 31, 23, 59, 59), flag=0, allRank=ON, dayAllRank=ON,
            weekAllRank=ON, monthAllRank=ON),
    _config("dance", utc(1997, 1, 1), utc(1998, 12, 31), flag=0, cates="PROMO-SMALL", allRank=ON,
            monthAllRank=ON, hourAllRank=ON),
    _config("bonus", utc(1998, 6, 1), utc(2000, 6, 30), flag=0, giftIds="Brand#1-Brand#2-Brand#13",
            specificExtraAdd=ON, specificExtraRate=0.1, allRank=ON, specificRank=ON, daySpecificRank=ON,
            weekSpecificRank=ON, monthSpecificRank=ON, u2q=ON),
    _config("signup", utc(1995, 6, 1), utc(2001, 6, 30), flag=1, allRank=ON, weekAllRank=ON, monthAllRank=ON,
            u2q=ON, userLevel=ON),
    _config("teams", utc(1996, 3, 1), utc(2000, 2, 29), flag=2, giftIds="Brand#3-Brand#4", allRank=ON,
            specificRank=ON, monthAllRank=ON),
    _config("offline", utc(1995, 1, 1), utc(2002, 1, 1), flag=0, online="false", allRank=ON),
    _config("stars", utc(2024, 1, 5), utc(2024, 1, 28, 12), flag=0, popularRank=ON, weekPopularRank=ON,
            monthPopularRank=ON),
    _config("stars_signup", utc(2024, 1, 3), utc(2024, 1, 25), flag=1, cates="click-view-purchase",
            popularRank=ON, weekPopularRank=ON, monthPopularRank="false"),
    _config("stars_group", utc(2024, 1, 1), utc(2024, 1, 31), flag=2, popularRank=ON),
]
WATCH_CONFIGS = [
    _config("night", utc(2024, 1, 3, 18), utc(2024, 1, 20, 6, 30), flag=0, cates="cat0-cat1-cat2"),
    _config("day", utc(2024, 1, 10), utc(2024, 1, 25, 12), flag=0, cates="cat3-cat2"),
    _config("any", utc(2024, 1, 1), utc(2024, 1, 31), flag=0),
]
SIGN_IN_CATES = ["cat0", "cat1", "cat2"]
SIGN_IN_THRESHOLD = 3


@lru_cache(maxsize=256)
def _schema(spark: SparkSession, path: str) -> StructType:
    """Read from the files once per session; inferring it again costs a job each time."""
    return spark.read.parquet(path).schema


def read(spark: SparkSession, sf: str, name: str) -> DataFrame:
    path = f"{sf}/{name}.parquet"
    return spark.read.schema(_schema(spark, path)).parquet(path)


def read_spread(spark: SparkSession, sf: str, name: str, *columns: str, span: Span | None = None, time: str = "") -> DataFrame:
    """Columns of a table ahead of heavy per-row work, cut to a span of its time column, dealt out by the first."""
    return dealt(within(read(spark, sf, name).select(*columns), time, span), columns[0])


def campaigns(spark: SparkSession, kind: str = "gift", configs: list[tuple[str, str]] = CONFIGS) -> DataFrame:
    rows = ", ".join(f"('{name}', '{config}')" for name, config in configs)
    return parse_campaigns(spark.sql(f"SELECT * FROM VALUES {rows} AS t(name, config)"), kind)


def within(df: DataFrame, time: str, span: Span | None) -> DataFrame:
    """Cut to the campaigns' window on the raw time column, which the scan can use to skip row groups."""
    if span is None:
        return df
    # An event of the last second may carry a fraction.
    return df.where((F.col(time) >= ntz_literal(span.first_u)) & (F.col(time) < ntz_literal(span.last_u + 1)))


def gift_campaigns(spark: SparkSession) -> DataFrame:
    return campaigns(spark).where(F.col("board_mask") != 0)


@lru_cache(maxsize=8)
def running(spark: SparkSession, kind: str = "gift") -> tuple[DataFrame, Span]:
    """The campaigns of a batch job and their span; the configuration is a constant here."""
    found = gift_campaigns(spark) if kind == "gift" else campaigns(spark, kind)
    return found, campaign_span(found)


def as_gifts(lines: DataFrame, spark: SparkSession, sf: str) -> DataFrame:
    orders = read(spark, sf, "orders").select("o_orderkey", "o_custkey")
    part = read(spark, sf, "part").select("p_partkey", "p_brand", "p_type")
    joined = lines.join(part, lines.l_partkey == part.p_partkey).join(orders, lines.l_orderkey == orders.o_orderkey)
    return joined.select(
        F.col("o_custkey").cast("string").alias("uid"),
        F.col("l_suppkey").cast("string").alias("qid"),
        F.col("l_suppkey").cast("string").alias("room_id"),
        F.col("p_brand").alias("gift_id"),
        F.col("l_quantity").cast("int").alias("total"),
        F.col("p_type").alias("cate"),
        epoch_seconds(lines, "l_shipdate").alias("time_u"),
    )


LINE_COLUMNS = ["l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate"]


def gifts(spark: SparkSession, sf: str, span: Span | None = None) -> DataFrame:
    """Gifts; with a span only those that running campaigns can match."""
    roomy(spark, read(spark, sf, "lineitem").count())
    lines = read_spread(spark, sf, "lineitem", *LINE_COLUMNS, span=span, time="l_shipdate")
    return as_gifts(lines, spark, sf)


def as_readings(events: DataFrame) -> DataFrame:
    host = F.col("user_id").cast("string")
    return events.select(
        host.alias("host_id"),
        host.alias("room_id"),
        F.col("event_type").alias("cate"),
        F.floor("value").cast("int").alias("num"),
        epoch_seconds(events, "ts").alias("time_u"),
    )


def readings(spark: SparkSession, sf: str, span: Span | None = None) -> DataFrame:
    return as_readings(within(read(spark, sf, "events"), "ts", span))


def _k() -> Column:
    return F.get_json_object("props", "$.k")


def as_heartbeats(events: DataFrame) -> DataFrame:
    return events.select(
        "event_id",
        F.col("user_id").cast("string").alias("uid"),
        _k().alias("stream"),
        F.when(F.col("event_type").isin("purchase", "signup"), "c").otherwise("p").alias("flag"),
        epoch_seconds(events, "ts").alias("time_u"),
    )


def heartbeats(spark: SparkSession, sf: str) -> DataFrame:
    columns = ("event_id", "user_id", "props", "event_type", "ts")
    return as_heartbeats(read_spread(spark, sf, "events", *columns))


def stream_rooms(spark: SparkSession) -> DataFrame:
    k = F.col("id")
    rooms = spark.range(100).where(k % 10 != 9)
    return rooms.select(k.cast("string").alias("stream"), (k % 40).cast("string").alias("room_id"))


def switches(spark: SparkSession, sf: str) -> DataFrame:
    events = read(spark, sf, "events").where(F.col("event_type") == "error")
    room = _k().cast("int") % 40
    return events.where(room < 38).select(
        room.cast("string").alias("room_id"),
        F.concat(F.lit("cat"), (F.floor("value").cast("int") % 5).cast("string")).alias("cate"),
        epoch_seconds(events, "ts").alias("time_u"),
    )


def host_pool(spark: SparkSession, sf: str) -> DataFrame:
    """Every third supplier is signed up for every gift campaign."""
    projects = F.array(*[F.lit(name) for name, _ in CONFIGS if not name.startswith("stars")])
    hosts = read(spark, sf, "supplier").where(F.col("s_suppkey") % 3 == 0)
    return hosts.select(F.explode(projects).alias("project"), F.col("s_suppkey").cast("string").alias("qid"))


def star_pool(spark: SparkSession, sf: str) -> DataFrame:
    hosts = read(spark, sf, "customer").where(F.col("c_custkey") % 3 == 0)
    return hosts.select(F.lit("stars_signup").alias("project"), F.col("c_custkey").cast("string").alias("qid"))


def host_group(spark: SparkSession, sf: str) -> DataFrame:
    group = (F.col("s_nationkey") % 4).cast("string")
    return read(spark, sf, "supplier").select(
        F.lit("teams").alias("project"),
        F.col("s_suppkey").cast("string").alias("qid"),
        F.when(F.col("s_suppkey") % 7 == 0, "").otherwise(group).alias("grp"),
    )


def profiles(spark: SparkSession, sf: str) -> DataFrame:
    """Four of five customers have a profile."""
    known = read(spark, sf, "customer").where(F.col("c_custkey") % 5 != 0)
    return known.select(
        F.col("c_custkey").cast("string").alias("rid"),
        F.col("c_name").alias("nick_name"),
        F.col("c_mktsegment").alias("avatar"),
    )


def user_level(spark: SparkSession, sf: str) -> DataFrame:
    level = F.floor(F.greatest(F.col("c_acctbal"), F.lit(0.0)) / 1000).cast("int")
    return read(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("rid"), level.alias("level"))
