"""Campaign configuration, and matching events with the campaigns they count for."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The (period, gift class) boards and the config key switching each one on.
BOARD_KEYS = {
    ("all", "all"): "allRank",
    ("all", "special"): "specificRank",
    ("day", "all"): "dayAllRank",
    ("day", "special"): "daySpecificRank",
    ("week", "all"): "weekAllRank",
    ("week", "special"): "weekSpecificRank",
    ("month", "all"): "monthAllRank",
    ("month", "special"): "monthSpecificRank",
}
POPULARITY_KEYS = {"all": "popularRank", "week": "weekPopularRank", "month": "monthPopularRank"}
REQUIRED_KEYS = ("project", "startTimeU", "endTimeU", "flag")

BUCKET = 30 * 86400  # campaigns are matched through 30-day buckets
MAX_BROADCAST_BYTES = 64 << 20
SALTS = 128  # beyond the bound; the adaptive skew join splits what is still too large


def board_bit(period: str, gift_class: str) -> int:
    return 1 << list(BOARD_KEYS).index((period, gift_class))


def parse_campaigns(df: DataFrame, kind: str = "gift", key: str = "name", value: str = "config") -> DataFrame:
    """Config strings ``k=v,k=v`` to one typed row per usable, online campaign.

    ``kind='popularity'`` also asks for flag 0 or 1 and for a popularity key to be present.
    The campaign's name is the ``key`` column, not the ``project`` entry of the string.
    """
    pairs = F.transform(F.split(F.col(value), ","), lambda p: F.split(p, "="))
    keys = F.transform(pairs, lambda p: p[0])
    well_formed = F.forall(pairs, lambda p: F.size(p) == 2) & (F.size(F.array_distinct(keys)) == F.size(keys))
    entries = F.when(well_formed, F.map_from_entries(F.transform(pairs, lambda p: F.struct(p[0], p[1]))))
    c = df.select(F.col(key).alias("project"), entries.alias("c")).where(F.col("c").isNotNull())

    def get(name: str) -> Column:
        return F.try_element_at("c", F.lit(name))

    def on(name: str, default: str = "false") -> Column:
        return F.lower(F.coalesce(get(name), F.lit(default))) == "true"

    def names(key: str) -> Column:
        text = F.coalesce(get(key), F.lit(""))
        return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, "-"))

    def epoch(name: str) -> Column:
        # Seconds; of a longer number (milliseconds) the first ten digits.
        return F.substring(get(name), 1, 10).try_cast("bigint")

    mask = F.lit(0)
    for (period, gift_class), name in BOARD_KEYS.items():
        mask = mask + F.when(on(name), board_bit(period, gift_class)).otherwise(0)
    rate = F.coalesce(get("specificExtraRate"), F.lit("0")).try_cast("double")
    gate = on("online", "true")
    for name in REQUIRED_KEYS:
        gate = gate & F.map_contains_key("c", name)
    if kind == "popularity":
        asked = [F.map_contains_key("c", name) for name in POPULARITY_KEYS.values()]
        gate = gate & get("flag").try_cast("int").isin(0, 1) & (asked[0] | asked[1] | asked[2])
    rows = c.where(gate).select(
        "project",
        epoch("startTimeU").alias("start_u"),
        epoch("endTimeU").alias("end_u"),
        names("cates").alias("cates"),
        names("giftIds").alias("gift_ids"),
        get("flag").try_cast("int").alias("flag"),
        on("specificExtraAdd").alias("extra_add"),
        rate.alias("extra_rate"),
        mask.alias("board_mask"),
        *[on(name).alias(f"popular_{period}") for period, name in POPULARITY_KEYS.items()],
        # Hourly boards can be configured but no board is ever produced from them.
        on("hourAllRank").alias("hour_all_rank"),
        on("hourSpecificRank").alias("hour_specific_rank"),
        on("u2q").alias("u2q"),
        on("userLevel").alias("user_level"),
    )
    return rows.where("start_u IS NOT NULL AND end_u IS NOT NULL AND flag IS NOT NULL AND extra_rate IS NOT NULL")


class Span(NamedTuple):
    """First start and last end of a set of campaigns, and the size of their bucket table."""

    first_u: int
    last_u: int
    table_bytes: int


def campaign_span(campaigns: DataFrame) -> Span:
    """Read once per job: the window filters the raw time column at the scan, the size picks the join."""
    live = campaigns.where(F.col("start_u") <= F.col("end_u"))
    buckets = _bucket(F.col("end_u")) - _bucket(F.col("start_u")) + 1
    row_bytes = F.lit(400)  # fixed-width columns, name and row overhead
    for names in ("cates", "gift_ids"):
        row_bytes = row_bytes + F.size(names) * 16 + F.octet_length(F.array_join(names, ""))
    row = live.agg(F.min("start_u"), F.max("end_u"), F.sum(buckets * row_bytes)).first()
    return Span(*row) if row[0] is not None else Span(0, -1, 0)


def _bucket(time: Column) -> Column:
    return F.floor(time / BUCKET)


def match_campaigns(
    events: DataFrame,
    campaigns: DataFrame,
    time_col: str = "time_u",
    cate_col: str = "cate",
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
    span: Span | None = None,
) -> DataFrame:
    """Each event once per campaign it counts for, with the campaign's columns.

    An event counts when start <= time <= end and the category list is empty (all) or
    holds its category. Campaigns are laid out over 30-day buckets, so this is an equi
    join that only meets campaigns of the event's own bucket. The bucket table is
    measured first: up to ``max_broadcast_bytes`` it is broadcast, beyond that both sides
    are shuffled on (bucket, salt) so that one busy month is not one task.

    Pass ``span`` if it is known and the events were already cut to it.
    """
    live = campaigns.where(F.col("start_u") <= F.col("end_u"))
    spans = live.withColumn("_bucket", F.explode(F.sequence(_bucket(F.col("start_u")), _bucket(F.col("end_u")))))
    if span is None:
        span = campaign_span(campaigns)
        events = events.where(F.col(time_col).between(span.first_u, span.last_u))
    keyed = events.withColumn("_bucket", _bucket(F.col(time_col)))
    keys = ["_bucket"]
    if span.table_bytes <= max_broadcast_bytes:
        spans = F.broadcast(spans)
    else:
        keys.append("_salt")
        salt = F.pmod(F.xxhash64(*events.columns), F.lit(SALTS)).cast("int")
        keyed = keyed.withColumn("_salt", salt)
        spans = spans.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).hint("merge")
    e, s = keyed.alias("e"), spans.alias("s")
    on = [F.col(f"e.{k}") == F.col(f"s.{k}") for k in keys]
    on.append(F.col(f"e.{time_col}").between(F.col("s.start_u"), F.col("s.end_u")))
    on.append((F.size("s.cates") == 0) | F.array_contains(F.col("s.cates"), F.col(f"e.{cate_col}")))
    condition = on[0]
    for term in on[1:]:
        condition = condition & term
    carried = [c for c in campaigns.columns if c not in ("end_u", "cates")]
    return e.join(s, condition).select(
        *[F.col(f"e.{c}") for c in events.columns], *[F.col(f"s.{c}") for c in carried]
    )
