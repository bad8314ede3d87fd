"""The query catalogue: one entry per operator, over the whole tables of a folder."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from encore.functions import labels, parse
from encore.functions.calendar import (
    day_key,
    day_number,
    epoch_micros,
    epoch_seconds,
    local_date,
    month_key,
    week_key,
)
from encore.operators import aggregates, asof, boards, enrich, popularity, ranking, tables, watch
from encore.operators.campaigns import Span, parse_campaigns
from encore.plans import fixtures as fx
from encore.session import PART_ROWS, release, roomy, roomy_state, work_dir
from encore.sources import files
from encore.streaming import jobs, ordered, outbox, sinks, state

Query = Callable[[SparkSession, str], DataFrame]
CATALOGUE: dict[str, Query] = {}
RANKED = ("host", "user")
EXPIRY = 6 * 3600  # seconds that a user's clicks are kept in the expiring totals


def query(build: Query) -> Query:
    CATALOGUE[build.__name__] = build
    return build


# --- gift boards -----------------------------------------------------------------------


def _scores(spark, sf, **which) -> DataFrame:
    running, span = fx.running(spark)
    return boards.board_scores(fx.gifts(spark, sf, span), running, fx.host_group(spark, sf), span=span, **which)


def _sum(score: str) -> Column:
    """Whole numbers of parts added up, so that the order does not matter."""
    return (F.sum(F.round(F.col(score) * boards.UNIT).cast("bigint")) / F.lit(float(boards.UNIT))).alias(score)


@query
def board_all(spark, sf):
    return _scores(spark, sf, periods=("all",), classes=("all",), roles=RANKED, scopes=("all",))


@query
def board_day(spark, sf):
    return _scores(spark, sf, periods=("day",), classes=("all",), roles=RANKED, scopes=("all",))


@query
def board_week(spark, sf):
    return _scores(spark, sf, periods=("week",), classes=("all",), roles=RANKED, scopes=("all",))


@query
def board_month(spark, sf):
    return _scores(spark, sf, periods=("month",), classes=("all",), roles=RANKED, scopes=("all",))


@query
def board_special(spark, sf):
    return _scores(spark, sf, classes=("special",), roles=RANKED, scopes=("all",))


@query
def board_group(spark, sf):
    return _scores(spark, sf, roles=RANKED, scopes=("group",))


@query
def board_donor(spark, sf):
    return _scores(spark, sf, roles=("donor",))


@query
def board_every(spark, sf):
    """All families in one pass, summed up per board."""
    scores = _scores(spark, sf)
    return scores.groupBy("project", "scope", "grp", "role", "period", "period_key", "gift_class").agg(
        F.count("*").alias("members"), _sum("score")
    )


@query
def board_fanout(spark, sf):
    """Board rows before any aggregation, counted per family."""
    running, span = fx.running(spark)
    rows = boards.board_rows(fx.gifts(spark, sf, span), running, fx.host_group(spark, sf), span=span)
    return rows.groupBy("project", "scope", "role", "period", "gift_class").agg(
        F.count("*").alias("rows"), _sum("score")
    )


@query
def board_signup(spark, sf):
    running, span = fx.running(spark)
    return boards.signed_up_scores(fx.gifts(spark, sf, span), running, fx.host_pool(spark, sf), classes=("all",), span=span)


def _best_donors(spark, sf) -> DataFrame:
    running, span = fx.running(spark)
    return boards.top_donor(
        fx.gifts(spark, sf, span), running, fx.host_pool(spark, sf), fx.host_group(spark, sf), span=span
    )


@query
def top_donor_map(spark, sf):
    return _best_donors(spark, sf)


@query
def board_topk(spark, sf):
    return _scores(spark, sf, roles=RANKED, top=ranking.TOP_LIST)


@query
def board_lowest(spark, sf):
    return ranking.lowest(_scores(spark, sf, roles=RANKED), boards.BOARD)


@query
def board_listing(spark, sf):
    """Every campaign's host board as a whole, with positions."""
    scores = _scores(spark, sf, periods=("all",), classes=("all",), roles=("host",), scopes=("all",))
    return ranking.board_listing(scores, ["project"]).select("project", "position", "member", "score")


@query
def board_labels(spark, sf):
    """Boards under their published keys, with the key taken apart again."""
    scores = _scores(spark, sf)
    named = scores.select(labels.board_key("live", labels.gift_board_label()).alias("key"), "member", "score")
    rows = named.groupBy("key").agg(F.count("*").alias("members"), _sum("score"))
    parts = labels.split_board_key(F.col("key"))
    return rows.select("key", parts["project"].alias("project"), parts["label"].alias("label"), "members", "score")


@query
def room_latest(spark, sf):
    """Room of each host; rooms here are the category of the newest reading."""
    rows = fx.readings(spark, sf).select("host_id", F.col("cate").alias("room_id"), "time_u")
    return boards.latest_room(rows, host="host_id")


def _touched(spark, sf, days=30) -> DataFrame:
    """Hosts and givers of the last 30 days of the sign-up campaign, with their campaign boards."""
    running = fx.running(spark)[0].where(F.col("project") == "signup")
    recent = fx.gifts(spark, sf, Span(fx.utc(2001, 6, 30) - days * 86400 + 1, fx.utc(2001, 6, 30), 0))
    rows = boards.board_rows(recent, running, periods=("all",), classes=("all",), roles=RANKED, scopes=("all",))
    return rows.select(*boards.BOARD, "member").distinct()


@query
def touched_in_top(spark, sf):
    """Only the touched campaign is scored, and ranked before names are spelled out."""
    campaign = fx.running(spark)[0].where(F.col("project") == "signup")
    top = boards.board_scores(
        fx.gifts(spark, sf, Span(fx.utc(1995, 6, 1), fx.utc(2001, 6, 30), 0)), campaign, periods=("all",),
        classes=("all",), roles=RANKED, scopes=("all",), span=Span(fx.utc(1995, 6, 1), fx.utc(2001, 6, 30), 0),
        top=ranking.TOP_LIST,
    )
    return ranking.touched_of(top, _touched(spark, sf), boards.BOARD)


def _gift_records(rows: DataFrame) -> DataFrame:
    """Gifts as records: envelopes of the columns that boards need."""
    data = F.to_json(F.struct(
        "uid", F.col("qid").alias("anchor"), F.col("room_id").alias("roomid"), F.col("gift_id").alias("giftid"),
        F.col("total").cast("string").alias("total"), "cate", F.col("time_u").cast("string").alias("time")))
    return _as_lines(rows, F.to_json(F.struct(F.lit("gift_donate").alias("name"), data.alias("data"))))


@query
def raw_gift_top(spark, sf):
    """From records to published lists: parse, keep totals above zero, boards and their sign-up copies, top lists."""
    running, span = fx.running(spark)
    gifts = parse.positive_gifts(parse.good(parse.parse_gift(_gift_records(fx.gifts(spark, sf, span)))))
    top = boards.board_scores(
        gifts, running, fx.host_group(spark, sf), classes=("all",), roles=RANKED, scopes=("all",), span=span,
        top=ranking.TOP_LIST, host_pool=fx.host_pool(spark, sf),
    )
    return top.select("project", "scope", "role", "period", "period_key", "member", "score", "rank")


# --- profiles --------------------------------------------------------------------------


def _top_users(spark, sf) -> DataFrame:
    top = _scores(
        spark, sf, periods=("all",), classes=("all",), roles=RANKED, scopes=("all",), top=ranking.TOP_LIST
    )
    return top.select("project", "role", "member", "score", "rank")


@query
def board_with_profile(spark, sf):
    return enrich.with_profile(_top_users(spark, sf), fx.profiles(spark, sf))


@query
def board_with_level(spark, sf):
    return enrich.with_level(
        _top_users(spark, sf), fx.user_level(spark, sf), fx.running(spark)[0]
    ).withColumn("level", F.coalesce("level", F.lit(-1)))


@query
def board_with_dimensions(spark, sf):
    """Profile and level of every user on a campaign board, from bucketed tables that stay where they are."""
    place = work_dir(spark, "dimensions")
    buckets = max(16, roomy(spark, fx.read(spark, sf, "lineitem").count()))
    stored = [
        files.store_dimension(df, f"{name}_{place.rpartition('-')[2]}", "rid", buckets, f"{place}/{name}")
        for name, df in (("profiles", fx.profiles(spark, sf)), ("levels", fx.user_level(spark, sf)))
    ]
    users = _scores(spark, sf, periods=("all",), classes=("all",), roles=("user",), scopes=("all",))
    found = enrich.with_dimensions(users.select("project", "member", "score"), stored)
    return found.withColumn("level", F.coalesce("level", F.lit(-1)))


@query
def top_donor_with_level(spark, sf):
    """Level of every best donor, whatever the campaign asks for."""
    best = _best_donors(spark, sf)
    found = enrich.with_profile(best, fx.user_level(spark, sf), member="uid")
    return found.withColumn("level", F.coalesce("level", F.lit(-1)))


def _order_ids(spark, sf) -> DataFrame:
    return fx.read(spark, sf, "orders").select(F.col("o_custkey").cast("string").alias("rid"))


def _cached(spark, sf) -> DataFrame:
    return fx.profiles(spark, sf).where(F.col("rid").cast("bigint") % 2 == 0)


@query
def profile_enrich_missing(spark, sf):
    found = enrich.fill_missing(_order_ids(spark, sf), _cached(spark, sf), fx.profiles(spark, sf))
    return found.withColumn("value", enrich.profile_json(F.lit(None).cast("string")))


@query
def id_difference(spark, sf):
    return enrich.missing_ids(_order_ids(spark, sf), _cached(spark, sf))


@query
def id_union_distinct(spark, sf):
    members = fx.read(spark, sf, "events").select(F.col("user_id").cast("string").alias("rid"))
    return enrich.union_ids(_order_ids(spark, sf), members)


@query
def id_intersection(spark, sf):
    members = fx.read(spark, sf, "events").select(F.col("user_id").cast("string").alias("rid"))
    return enrich.common_ids(_order_ids(spark, sf), members)


def _changes(spark, sf) -> DataFrame:
    """Change messages (value, at) of some customers: renames, pictures and rooms, repeated, partial and out of order."""
    return _change_records(fx.read(spark, sf, "customer"))


def _change_records(c: DataFrame) -> DataFrame:
    key = F.col("c_custkey")

    def message(at: int, *fields: Column) -> Column:
        return F.struct(F.lit(at).alias("at"), F.to_json(F.struct(*fields)).alias("data"))

    def own(letter: str, name: str) -> Column:
        return F.concat(F.lit(letter), key).alias(name)

    def room(add: int) -> list[Column]:
        return [key.cast("string").alias("hostid"), (key * 10 + add).cast("string").alias("new_id")]

    rid, shift = key.alias("rid"), key % 6
    sent = (
        F.when(shift == 0, F.array(
            message(5, rid, own("m", "nickname")), message(3, rid, own("n", "nickname")), message(4, rid, own("x", "avatar"))))
        .when(shift == 1, F.array(message(2, rid, own("a", "avatar")), message(1, rid, own("b", "avatar"))))
        .when(shift == 2, F.array(message(1, *room(0)), message(7, *room(1))))
        .when(shift == 3, F.array(F.struct(F.lit(1).alias("at"), F.lit("{broken").alias("data"))))
    )
    rows = c.select(F.explode(sent).alias("m")).select("m.*")
    return rows.select("at", F.to_json(F.struct(F.lit("change").alias("name"), "data")).alias("value"))


def _fields(changes: DataFrame) -> DataFrame:
    good = parse.good(parse.parse_profile_change(changes, keep=("at",)))
    return good.select("rid", F.col("nickname").alias("nick_name"), "avatar", "room_id", "at")


def _known(spark, sf) -> DataFrame:
    return fx.profiles(spark, sf).withColumn("room_id", F.lit("none"))


@query
def profile_change_parse(spark, sf):
    return parse.good(parse.parse_profile_change(_changes(spark, sf), keep=("at",)))


@query
def profile_merge(spark, sf):
    return enrich.merge_profile(_known(spark, sf), _fields(_changes(spark, sf)), "at")


def _two_tables(spark, sf):
    customers = fx.read(spark, sf, "customer").select(
        F.col("c_custkey").alias("rid"), F.col("c_mktsegment").alias("label")
    )
    per_order = fx.read(spark, sf, "orders").select(
        F.col("o_custkey").alias("rid"), F.col("o_orderpriority").alias("label")
    )
    return customers.where(F.col("rid") % 3 == 0), per_order


@query
def put_if_absent(spark, sf):
    current, rows = _two_tables(spark, sf)
    return enrich.put_if_absent(current, rows, "rid")


@query
def put_replace(spark, sf):
    current, rows = _two_tables(spark, sf)
    return enrich.put(current, rows, "rid")


@query
def store_profiles(spark, sf):
    """Profiles after a lookup of givers and of every tenth customer as host; cached ones stay, hosts too."""
    everyone = fx.read(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("rid"), F.col("c_name").alias("nick_name"), F.lit("").alias("room_id")
    )
    key = F.col("rid").cast("bigint")
    current = everyone.where(key % 3 == 0).withColumn("nick_name", F.lit("old"))
    hosts = everyone.where(key % 10 == 0).withColumn("room_id", F.concat(F.lit("room"), "rid"))
    users = everyone.join(_order_ids(spark, sf), "rid", "left_semi")
    return enrich.store_profiles(current, hosts, users)


@query
def set_add_new(spark, sf):
    current, rows = _two_tables(spark, sf)
    return enrich.new_members(current, rows, ["rid"])


# --- popularity ------------------------------------------------------------------------


def _peaks(spark, sf) -> tuple[DataFrame, DataFrame]:
    running, span = fx.running(spark, "popularity")
    return popularity.host_day_peak(fx.readings(spark, sf, span), running, span=span), running


def _popularity(spark, sf, period) -> DataFrame:
    return popularity.popularity_scores(*_peaks(spark, sf), periods=(period,))


@query
def pop_day_peak(spark, sf):
    peaks, _ = _peaks(spark, sf)
    return peaks.withColumn("day", day_key(F.col("day")))


@query
def pop_avg_all(spark, sf):
    return _popularity(spark, sf, "all")


@query
def pop_avg_week(spark, sf):
    return _popularity(spark, sf, "week")


@query
def pop_avg_month(spark, sf):
    return _popularity(spark, sf, "month")


@query
def pop_signup(spark, sf):
    scores = popularity.popularity_scores(*_peaks(spark, sf))
    return boards.restrict_to_pool(scores, fx.star_pool(spark, sf), fx.running(spark, "popularity")[0])


@query
def pop_topk(spark, sf):
    scores = popularity.popularity_scores(*_peaks(spark, sf))
    top = ranking.top_k(scores, ["project", "scope", "period", "period_key"])
    return top.withColumn("key", labels.board_key("live", labels.popularity_board_label()))


# --- categories and watch time ---------------------------------------------------------


@query
def category_latest(spark, sf):
    return asof.latest_switch(fx.switches(spark, sf))


@query
def category_full_history(spark, sf):
    intervals = asof.category_intervals(fx.switches(spark, sf))
    return intervals.withColumn("until_u", F.coalesce("until_u", F.lit(9999999999)))


def _asof(spark, sf, **how) -> DataFrame:
    placed = watch.rooms_of(fx.heartbeats(spark, sf), fx.stream_rooms(spark))
    return asof.asof_category(placed, fx.switches(spark, sf), **how).select("event_id", "room_id", "cate")


@query
def asof_category(spark, sf):
    return _asof(spark, sf)


@query
def asof_category_full(spark, sf):
    return _asof(spark, sf, history="full", fallback="null")


def _beats(spark, sf) -> DataFrame:
    return watch.beats_in_category(
        fx.heartbeats(spark, sf), fx.stream_rooms(spark), fx.switches(spark, sf), fx.SIGN_IN_CATES
    )


@query
def watch_minutes(spark, sf):
    return watch.watch_minutes(_beats(spark, sf)).withColumn("day", day_key(F.col("day")))


@query
def watch_minutes_per_day(spark, sf):
    return watch.minutes_per_day(_beats(spark, sf)).withColumn("day", day_key(F.col("day")))


@query
def watch_minutes_approx(spark, sf):
    """Exact minutes, and whether the sketch is within five of a hundred (or one) of them."""
    approx = watch.minutes_per_day_approx(_beats(spark, sf)).withColumnRenamed("minutes", "_approx")
    both = watch.minutes_per_day(_beats(spark, sf)).join(approx, ["uid", "day"], "full")
    error = F.abs(F.col("minutes") - F.col("_approx"))
    within = F.coalesce(error <= F.greatest(F.lit(1.0), 0.05 * F.col("minutes")), F.lit(False))
    return both.select("uid", day_key(F.col("day")).alias("day"), "minutes", within.alias("within"))


@query
def signin_campaigns(spark, sf):
    """Sign-ins by campaign: its own categories and time range, two minutes a day."""
    running = fx.campaigns(spark, configs=fx.WATCH_CONFIGS)
    keys = ("project", "uid")
    beats = watch.beats_of_campaigns(fx.heartbeats(spark, sf), fx.stream_rooms(spark), fx.switches(spark, sf), running)
    minutes = watch.minutes_per_day(beats, keys=keys)
    days = watch.signin_days(minutes, 2, keys)
    told = watch.signin_events(days, keys).drop("value").join(minutes, [*keys, "day"])
    return told.withColumn("day", day_key(F.col("day")))


def _signed(spark, sf) -> DataFrame:
    days = watch.signin_days(watch.minutes_per_day(_beats(spark, sf)), fx.SIGN_IN_THRESHOLD)
    return days.withColumn("day", day_key(F.col("day")))


@query
def signin_days(spark, sf):
    return _signed(spark, sf)


@query
def signin_events(spark, sf):
    return watch.signin_events(_signed(spark, sf))


@query
def signin_fifth_day(spark, sf):
    return watch.nth_signin_day(_signed(spark, sf), 5)


# --- parsing ---------------------------------------------------------------------------


def _as_lines(df: DataFrame, value: Column) -> DataFrame:
    """A made-up line per row; generated, so that parsers read it like a stored column."""
    return df.select(F.explode(F.array(value)).alias("value"))


def _gift_lines(spark, sf) -> DataFrame:
    """Gift envelopes made of order lines; some broken, without category or with numbers that are none or out of range."""
    lines = fx.read_spread(spark, sf, "lineitem", *fx.LINE_COLUMNS)
    kind = F.col("l_orderkey") % 50
    rows = lines.select(
        kind.alias("kind"),
        F.struct(
            F.col("l_orderkey").cast("string").alias("uid"),
            F.col("l_suppkey").cast("string").alias("anchor"),
            F.col("l_suppkey").cast("string").alias("roomid"),
            F.concat(F.lit("g"), F.col("l_partkey") % 25).alias("giftid"),
            F.when(kind == 1, "abc").when(kind == 3, "-1").when(kind == 4, "1.5").when(kind == 7, "3000000000")
            .otherwise(F.col("l_quantity").cast("int").cast("string")).alias("total"),
            F.when(kind == 5, "NaN").when(kind == 6, "1e30")
            .otherwise((epoch_seconds(lines, "l_shipdate") + 0.9594).cast("string")).alias("time"),
            F.when(kind != 2, F.concat(F.lit("c"), F.col("l_partkey") % 6)).alias("cate"),
        ).alias("d"),
    )
    value = F.to_json(F.struct(F.lit("gift_donate").alias("name"), F.to_json("d").alias("data"), F.lit("").alias("key")))
    return _as_lines(rows, F.when(F.col("kind") == 0, F.substring(value, 1, 40)).otherwise(value))


@query
def envelope_parse(spark, sf):
    return parse.positive_gifts(parse.good(parse.parse_gift(_gift_lines(spark, sf))))


@query
def envelope_quarantine(spark, sf):
    bad = parse.quarantine(parse.parse_gift(_gift_lines(spark, sf)))
    return bad.groupBy("error").agg(F.count("*").alias("records"))


def _events(spark, sf) -> DataFrame:
    return fx.read_spread(spark, sf, "events", "event_id", "ts", "user_id", "event_type", "value", "props")


def _popularity_records(events: DataFrame) -> DataFrame:
    """Readings as records; some without a usable time or with numbers out of range."""
    data = F.to_json(
        F.struct(
            F.col("event_type").alias("classification"),
            F.col("user_id").cast("string").alias("hostid"),
            F.when(F.col("event_id") % 20 == 1, "9999999999").otherwise(F.floor("value").cast("int").cast("string")).alias("person_num"),
            (F.col("user_id") * 7).cast("string").alias("roomid"),
            F.when(F.col("event_id") % 20 == 2, "Infinity").otherwise(epoch_seconds(events, "ts").cast("string")).alias("timestamp"),
        )
    )
    stamp = F.when(F.col("event_id") % 20 != 0, F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).otherwise("soon")
    return _as_lines(events, F.to_json(F.struct(data.alias("data"), stamp.alias("time"))))


@query
def popularity_parse(spark, sf):
    return parse.good(parse.parse_popularity(_popularity_records(_events(spark, sf))))


@query
def log_parse(spark, sf):
    events = _events(spark, sf)
    page = F.when(F.col("event_type") == "click", "client_punch").otherwise("player")
    bad = F.col("event_id") % 10
    uid = F.when(bad == 0, "0").when(bad == 1, "-5").when(bad == 2, "x").otherwise(F.col("user_id").cast("string"))
    suffix = F.when(bad == 3, "_hd").otherwise("")
    value = F.concat(
        F.lit("10.0.0.1 - - ["), F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss"), F.lit(' +0800] "GET /'), page,
        F.lit(".gif?uid="), uid, F.lit("&u=http%3A%2F%2Fcdn%2Flive_show%2F"),
        F.get_json_object("props", "$.k"), suffix, F.lit('.flv HTTP/1.1" 200'),
    )
    return parse.good(parse.parse_heartbeat(_as_lines(events, value), "live_show%2F"))


def _switch_records(events: DataFrame) -> DataFrame:
    """Switches as tab-separated lines; some short or without a usable time."""
    cells = [
        F.col("user_id").cast("string"), F.lit("old"), F.lit(""), F.col("event_type"), F.lit("x"),
        F.when(F.col("event_id") % 7 == 0, "yesterday").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")),
    ]
    full = F.concat_ws("\t", *cells)
    short = F.concat_ws("\t", *cells[:5])
    return _as_lines(events, F.when(F.col("event_id") % 11 == 0, short).otherwise(full))


@query
def tsv_parse(spark, sf):
    return parse.good(parse.parse_switch(_switch_records(_events(spark, sf))))


@query
def reading_parse(spark, sf):
    events = _events(spark, sf)
    stamp = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    number = F.when(F.col("event_id") % 9 == 0, "n/a").otherwise(F.floor("value").cast("string"))
    lines = _as_lines(events, F.concat(F.lit(" "), F.concat_ws(",", "event_type", stamp, number)))
    rows = parse.parse_reading(lines).where(F.col("error").isNull())
    return rows.select("id", F.date_format("timestamp", "yyyyMMddHHmmss").alias("stamp"), "value")


@query
def click_parse(spark, sf):
    events = _events(spark, sf)
    message = F.struct(
        F.col("user_id").cast("string").alias("uid"),
        epoch_seconds(events, "ts").cast("string").alias("event_time"),
        F.col("event_type").alias("os_type"),
        F.when(F.col("event_id") % 8 == 1, "3e9").when(F.col("event_id") % 8 == 2, "NaN")
        .when(F.col("event_id") % 8 != 0, F.col("value").cast("string")).alias("click_count"),
    )
    return parse.good(parse.parse_clicks(_as_lines(events, F.to_json(message))))


@query
def people_parse(spark, sf):
    customers = fx.read(spark, sf, "customer")
    age = F.when(F.col("c_custkey") % 13 == 0, "?").otherwise((F.col("c_custkey") % 90).cast("string"))
    return parse.good(parse.parse_people(_as_lines(customers, F.concat("c_name", F.lit(", "), age))))


@query
def config_parse(spark, sf):
    """Config strings made of suppliers: incomplete, offline, malformed and complete ones."""
    key = F.col("s_suppkey")
    shift = key % 8
    value = F.concat(
        F.lit("project=p"), key, F.lit(",startTimeU="), (key + 1500000000).cast("string"),
        F.when(shift != 1, F.concat(F.lit(",endTimeU="), (key + 1600000000).cast("string"), F.lit("000"))).otherwise(""),
        F.lit(",flag="), F.when(shift == 2, "x").otherwise((key % 3).cast("string")),
        F.when(shift == 3, ",online=false").when(shift == 4, ",cates").otherwise(",cates=a-b"),
        F.when(shift == 5, ",allRank=TRUE,specificExtraRate=0.25,giftIds=g1-g2-g3").otherwise(",dayAllRank=true,giftIds="),
    )
    rows = fx.read(spark, sf, "supplier").select(F.concat(F.lit("name"), key).alias("name"), value.alias("config"))
    return parse_campaigns(rows).select(
        "project", "start_u", "end_u", F.size("cates").alias("n_cates"), F.size("gift_ids").alias("n_gifts"),
        "flag", "extra_rate", "board_mask",
    )


@query
def calendar_keys(spark, sf):
    """Day, ISO week and month of every order, and its day number in the year."""
    orders = fx.read(spark, sf, "orders")
    date = local_date(epoch_seconds(orders, "o_orderdate"))
    start = F.trunc(date, "year")
    return orders.select(
        "o_orderkey", day_key(date).alias("day"), week_key(date).alias("week"), month_key(date).alias("month"),
        (F.weekday(date) + 1).alias("day_of_week"), F.dayofmonth(date).alias("day_of_month"),
        day_number(date, start).alias("day_number"),
    )


@query
def calendar_keys_utc8(spark, sf):
    """The same calendar eight hours ahead, where late events belong to the next day."""
    events = fx.read(spark, sf, "events")
    date = local_date(epoch_seconds(events, "ts"), "Asia/Shanghai")
    return events.select("event_id", day_key(date).alias("day"), week_key(date).alias("week"))


# --- aggregates ------------------------------------------------------------------------


@query
def word_count(spark, sf):
    lines = parse.lines(fx.read_spread(spark, sf, "documents", "text"), "text")
    return aggregates.word_count(parse.words(lines))


def _clicks(spark, sf) -> DataFrame:
    return fx.read(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("uid"), F.col("value").cast("int").alias("click_count")
    )


@query
def click_total(spark, sf):
    return aggregates.click_totals(_clicks(spark, sf))


@query
def running_sum(spark, sf):
    lines = parse.lines(fx.read(spark, sf, "conversations"), "text")
    return aggregates.running_sum(parse.words(lines), "value", F.lit(1))


@query
def running_max(spark, sf):
    return aggregates.running_max(_clicks(spark, sf), "uid", "click_count")


@query
def last_put(spark, sf):
    events = fx.read(spark, sf, "events")
    rows = events.select("user_id", "event_type", epoch_seconds(events, "ts").alias("time_u"))
    return aggregates.last_put(rows, ["user_id"], "event_type", "time_u")


@query
def typed_average(spark, sf):
    employees = fx.read(spark, sf, "customer").select(F.round("c_acctbal").cast("bigint").alias("salary"))
    return aggregates.typed_average(employees, "salary")


@query
def user_defined_average(spark, sf):
    employees = fx.read(spark, sf, "customer").select(
        "c_nationkey", F.round("c_acctbal").cast("bigint").alias("salary")
    )

    def reduce(rows: pd.DataFrame) -> dict:
        return {"total": int(rows["salary"].sum()), "count": len(rows)}

    def merge(buffers: pd.DataFrame) -> dict:
        return {"total": int(buffers["total"].sum()), "count": int(buffers["count"].sum())}

    finish = (F.col("total").cast("double") / F.col("count")).alias("average")
    return aggregates.user_aggregate(
        employees, ["c_nationkey"], ["salary"], "total bigint, count bigint", reduce, merge, finish
    )


@query
def user_average_sql(spark, sf):
    """The user-defined average as a function in SQL text."""
    fx.read(spark, sf, "customer").createOrReplaceTempView("employees")
    aggregates.register_average(spark)
    return spark.sql("SELECT c_nationkey, typed_avg(round(c_acctbal)) AS average FROM employees GROUP BY c_nationkey")


def _people(spark, sf) -> DataFrame:
    return fx.read(spark, sf, "customer").select(
        F.col("c_name").alias("name"), (F.col("c_custkey") % 60).alias("age")
    )


@query
def select_filter_between(spark, sf):
    """SQL over a view, with a greeting column and the row as a map."""
    _people(spark, sf).createOrReplaceTempView("people")
    teens = spark.sql("SELECT name, age FROM people WHERE age BETWEEN 13 AND 19")
    row = F.create_map(F.lit("name"), F.col("name"), F.lit("age"), F.col("age").cast("string"))
    return teens.select(
        "name", (F.col("age") + 1).alias("next_age"), F.concat(F.lit("Name:"), "name").alias("greeting"),
        row["age"].alias("age_text"),
    )


@query
def filter_greater(spark, sf):
    return _people(spark, sf).where(F.col("age") > 21)


@query
def group_avg(spark, sf):
    return _people(spark, sf).groupBy("age").agg(F.avg("age").alias("avg_age"), F.count("*").alias("people"))


@query
def global_sum_count(spark, sf):
    return fx.read(spark, sf, "lineitem").agg(
        F.sum(F.col("l_quantity").cast("bigint")).alias("total"), F.count("*").alias("rows")
    )


@query
def topn_per_key(spark, sf):
    lines = fx.read(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("key"), F.col("l_extendedprice").alias("price")
    )
    return ranking.top_n_per_key(lines, "key", "price", 3).select("key", "price")


def _sliding(events: DataFrame, watermark: str | None = None) -> DataFrame:
    rows = events.select(
        F.col("event_type").alias("id"), F.col("ts").cast("timestamp").alias("timestamp"),
        F.floor("value").cast("int").alias("value"),
    )
    return aggregates.sliding_stats(rows, "id", "timestamp", "value", watermark=watermark)


def _sliding_numbers(stats: DataFrame) -> DataFrame:
    """Times as numbers, read as zone-less clock times like the table's own."""
    times = ["window_start", "window_end", "min_timestamp", "max_timestamp"]
    clock = stats.withColumns({t: F.col(t).cast("timestamp_ntz") for t in times})
    return clock.select(*[epoch_micros(clock, t).alias(t) for t in times], "id", "sum_value")


@query
def sliding_minmaxsum(spark, sf):
    return _sliding_numbers(_sliding(fx.read(spark, sf, "events")))


@query
def sliding_panes(spark, sf):
    """The sliding windows by way of panes of a second."""
    events = fx.read(spark, sf, "events")
    rows = events.select(
        F.col("event_type").alias("id"), F.col("ts").cast("timestamp").alias("timestamp"), F.floor("value").cast("int").alias("value")
    )
    return _sliding_numbers(aggregates.sliding_panes(rows, "id", "timestamp", "value"))


# --- tables ----------------------------------------------------------------------------


@query
def offset_resume(spark, sf):
    """Ledger made of events: topic by type, partition by user, one batch per day."""
    events = fx.read(spark, sf, "events")
    ledger = events.groupBy(
        F.col("event_type").alias("topic"), F.lit("boards").alias("group_id"),
        (F.col("user_id") % 4).cast("int").alias("partition"),
        (F.unix_date(F.col("ts").cast("date")).cast("bigint") * 86_400_000).alias("batch_ms"),
    ).agg((F.max("event_id") + 1).alias("until_offset"))
    topics = events.select(F.col("event_type").alias("topic")).distinct()
    partitions = topics.select(
        "topic", F.lit("boards").alias("group_id"), F.explode(F.sequence(F.lit(0), F.lit(5))).alias("partition")
    )
    return tables.resume_offsets(ledger, partitions)


def _similarity(spark, sf) -> DataFrame:
    key = F.col("p_partkey")
    return fx.read(spark, sf, "part").select(
        key.cast("string").alias("aid_type"),
        F.concat_ws(",", key + 1, key * 2, F.col("p_size").cast("string")).alias("aids"),
    )


@query
def similarity_explode(spark, sf):
    return tables.similar_items(_similarity(spark, sf))


@query
def similarity_lookup(spark, sf):
    lines = fx.read(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", (F.col("l_partkey") * 2).cast("string").alias("aid")
    )
    found = tables.with_similar(lines, _similarity(spark, sf), "aid")
    return found.select("l_orderkey", "l_linenumber", "aid", F.concat_ws("|", "similar").alias("similar"))


def _places(spark, sf) -> DataFrame:
    key = F.col("c_custkey")
    return fx.read(spark, sf, "customer").select(
        key.alias("place"),
        ((key * 37) % 1700 / 10.0 - 85).alias("lat"),
        ((key * 101) % 3600 / 10.0 - 180).alias("lon"),
    )


@query
def geo_radius(spark, sf):
    near = tables.within_radius(_places(spark, sf), "place", 7, 1500.0)
    return near.select("place", F.round("distance", 3).alias("distance"))


@query
def geo_pairs(spark, sf):
    """All customers within 400 km of each supplier; suppliers lie up to the poles and on both sides of the date line."""
    key = F.col("s_suppkey")
    centres = fx.read(spark, sf, "supplier").select(
        key.alias("centre"), ((key * 53) % 1801 / 10.0 - 90).alias("lat"), (180 - (key * 71) % 3600 / 10.0).alias("lon")
    )
    near = tables.pairs_within(_places(spark, sf), centres, "place", "centre", 400.0)
    return near.select("centre", "place", F.round("distance", 3).alias("distance"))


@query
def retention_filter(spark, sf):
    """Events younger than the seven days watch minutes are kept, counted from the end of January."""
    events = fx.read(spark, sf, "events").select("event_id", "ts")
    return tables.expire_rows(events, "ts", tables.KEEP["watch_minutes"], fx.utc(2024, 1, 31)).select("event_id")


@query
def top_donor_labels(spark, sf):
    """Best donors under the published names of their maps."""
    best = _best_donors(spark, sf).withColumn("scope", F.lit("all"))
    key = labels.board_key("live", labels.top_donor_label(), "map")
    return best.select(key.alias("key"), "qid", "uid", "score")


# --- sources ---------------------------------------------------------------------------


@query
def source_text(spark, sf):
    """Lines of a table written as text files, read back and counted."""
    place = work_dir(spark, "text")
    lines = parse.lines(fx.read(spark, sf, "conversations"), "text")
    lines.write.option("lineSep", "\n").text(place)
    return files.read_lines(spark, place, "\n").groupBy("value").agg(F.count("*").alias("lines"))


@query
def source_json(spark, sf):
    """Customers written as JSON lines and read back, the schema inferred."""
    place = work_dir(spark, "json")
    fx.read(spark, sf, "customer").select("c_custkey", "c_name", F.struct("c_mktsegment").alias("more")).write.json(place)
    return files.read_json(spark, place).select("c_custkey", "c_name", F.col("more.c_mktsegment").alias("c_mktsegment"))


@query
def source_catalog(spark, sf):
    """Orders loaded into a catalog table and scanned from it."""
    place = work_dir(spark, "orders")
    name = f"orders_{place.rpartition('-')[2]}"
    files.ensure_table(spark, name, "o_orderkey BIGINT, o_custkey BIGINT, o_orderpriority STRING", location=place)
    rows = fx.read(spark, sf, "orders").select("o_orderpriority", "o_custkey", "o_orderkey")
    return files.load_into(rows, name)


@query
def source_memory(spark, sf):
    """A small dimension as rows of the driver, joined with its table; in three partitions."""
    names = [(i, f"class {i}") for i in range(5)]
    classes = files.in_memory(spark, names, "class int, label string", 3)
    nations = fx.read(spark, sf, "customer").select("c_custkey", (F.col("c_nationkey") % 5).cast("int").alias("class"))
    return nations.join(classes, "class").groupBy("label").agg(F.count("*").alias("customers"))


# --- streams ---------------------------------------------------------------------------


def _stream(spark, sf, name, max_files=None) -> DataFrame:
    return files.stream_parquet(spark, sf, f"{name}.parquet", max_files)


def _dealt(spark, rows, batches: int = 2, by: str | None = None) -> DataFrame:
    """Rows as a stream that comes in several micro-batches: as files of which each batch takes its share (the ingest cap), a
    file for each :data:`PART_ROWS` rows, so that a batch has a task for each core however large the table.

    With ``by`` one file after the other is written, in the order of that column, and each batch takes one.
    """
    place, share = work_dir(spark, "arrivals"), 1
    if by is None:
        share = max(1, -(-rows.count() // (batches * PART_ROWS)))
        rows.repartition(batches * share).write.parquet(place)
    else:
        ranges = rows.select(F.min(by), F.max(by)).first()
        cuts = [ranges[0] + (ranges[1] - ranges[0]) * i / batches for i in range(1, batches)]
        for low, high in zip([None, *cuts], [*cuts, None], strict=True):
            part = rows if low is None else rows.where(F.col(by) >= F.lit(low))
            part = part if high is None else part.where(F.col(by) < F.lit(high))
            part.coalesce(1).write.mode("append").parquet(place)
    return files.stream_parquet(spark, place, max_files=share)


def _turns(spark, rows, turns: int = 2) -> Iterator[DataFrame]:
    """Rows that come in several turns: each time the stream of their folder, which has got the files of one more turn, for a job
    that is started again. A row's columns tell its turn; a file has at most :data:`PART_ROWS` rows."""
    place, turn = work_dir(spark, "arrivals"), F.pmod(F.xxhash64(*rows.columns), F.lit(turns))
    for i in range(turns):
        rows.where(turn == i).write.option("maxRecordsPerFile", PART_ROWS).mode("append").parquet(place)
        yield files.stream_parquet(spark, place)


def _half(spark, path: str, batches: int = 2) -> int:
    """Files of a folder that a micro-batch takes, so that their number does not grow with the files'."""
    return max(1, -(-len(spark.read.parquet(path).inputFiles()) // batches))


def _finish(running) -> None:
    running.awaitTermination()


def _gift_stream(spark, sf, lines: int) -> DataFrame:
    """Gifts of a table of so many ``lines``, as files as its parts are read, of which one of two micro-batches takes half."""
    place = work_dir(spark, "arrivals")
    rows = fx.read(spark, sf, "lineitem").select(*fx.LINE_COLUMNS)
    rows.write.option("maxRecordsPerFile", max(1, min(PART_ROWS, -(-lines // 2)))).parquet(place)
    return fx.as_gifts(files.stream_parquet(spark, place, max_files=_half(spark, place)), spark, sf)


@query
def stream_board_scores(spark, sf):
    """Gift boards in the engine's state over several micro-batches, with a restart after the first."""
    progress, lines = work_dir(spark, "boards"), fx.read(spark, sf, "lineitem").select(*fx.LINE_COLUMNS)
    coming = lines.count()
    for arrived in _turns(spark, lines):
        with roomy_state(spark, coming):
            running = jobs.start_boards(
                fx.as_gifts(arrived, spark, sf), lambda: fx.gift_campaigns(spark), progress,
                host_group=lambda: fx.host_group(spark, sf), periods=("all", "month"), roles=RANKED,
            )
        _finish(running)
        del running  # a query that has ended holds its last batch
        release(spark)
    return jobs.read_boards(spark, progress)


@query
def stream_top_lists(spark, sf):
    """Top lists kept over several micro-batches from the members that each touches."""
    place, lines = work_dir(spark, "lists"), fx.read(spark, sf, "lineitem").count()
    sums = jobs.board_sums(
        _gift_stream(spark, sf, lines), fx.gift_campaigns(spark), fx.host_group(spark, sf), periods=("all", "month"), roles=RANKED
    )
    with roomy_state(spark, lines):
        running = jobs.start_changes(sums, f"{place}/changes", f"{place}/progress")
    _finish(running)
    del running
    release(spark)
    _finish(jobs.start_top_lists(spark, f"{place}/changes", f"{place}/touched", f"{place}/lists", slots=2, max_files=_half(spark, f"{place}/changes")))
    return jobs.read_top_lists(spark, f"{place}/lists")


@query
def stream_expiring_clicks(spark, sf):
    """Clicks per user, each kept for six hours after the user's last, over micro-batches in the order of time."""
    progress = work_dir(spark, "expiring")
    events = fx.read(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("uid"), F.col("value").cast("int").alias("clicks"), F.col("ts").cast("timestamp").alias("at")
    )
    sums = state.expiring_sums(_dealt(spark, events, by="at"), ["uid"], "clicks", "at", EXPIRY)
    _finish(state.start_kept(sums, progress))
    return state.read_sums(spark, progress, "uid string")


@query
def stream_board_totals(spark, sf):
    """Campaign boards as one native streaming aggregate in update mode."""
    place = work_dir(spark, "totals")
    lines = _stream(spark, sf, "lineitem").select(*fx.LINE_COLUMNS)
    totals = jobs.board_totals(
        fx.as_gifts(lines, spark, sf), fx.gift_campaigns(spark), host_group=fx.host_group(spark, sf),
        periods=("all",), classes=("all",), roles=RANKED, scopes=("all",),
    )
    _finish(sinks.start_log(totals, f"{place}/log", f"{place}/progress", "update"))
    log = sinks.read_batches(spark, f"{place}/log", totals.schema)
    return sinks.newest(log, [*boards.BOARD, "member"])


@query
def stream_day_peak(spark, sf):
    """Daily peaks in the engine's state over several micro-batches."""
    progress = work_dir(spark, "peaks")
    readings = fx.as_readings(_dealt(spark, fx.read(spark, sf, "events")))
    _finish(jobs.start_peaks(readings, lambda: fx.campaigns(spark, "popularity"), progress))
    return jobs.read_peaks(spark, progress).withColumn("day", day_key(F.col("day")))


@query
def stream_running_max(spark, sf):
    place = work_dir(spark, "max")
    clicks = _stream(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("uid"), F.col("value").cast("int").alias("click_count")
    )
    best = aggregates.running_max(clicks, "uid", "click_count")
    _finish(sinks.start_log(best, f"{place}/log", f"{place}/progress", "update"))
    return sinks.newest(sinks.read_batches(spark, f"{place}/log", "uid string, best int"), ["uid"])


@query
def stream_word_count(spark, sf):
    """Complete mode: every batch writes the whole result, so the newest batch is the answer."""
    place = work_dir(spark, "words")
    words = parse.words(parse.lines(_stream(spark, sf, "conversations"), "text"))
    counts = aggregates.word_count(words)
    _finish(sinks.start_log(counts, f"{place}/log", f"{place}/progress", "complete"))
    return sinks.read_batches(spark, f"{place}/log", "value string, count bigint", last=True).drop("batch_id")


@query
def stream_sliding(spark, sf):
    """Sliding windows with a three-second watermark in update mode."""
    place = work_dir(spark, "sliding")
    stats = _sliding(_stream(spark, sf, "events"), watermark="3 seconds")
    schema = stats.schema
    _finish(sinks.start_log(stats, f"{place}/log", f"{place}/progress", "update"))
    log = sinks.read_batches(spark, f"{place}/log", schema)
    return _sliding_numbers(sinks.newest(log, ["window_start", "window_end", "id"]))


@query
def stream_new_minutes(spark, sf):
    """Distinct watched minutes of a stream: set add within the retention."""
    place = work_dir(spark, "minutes")
    events = _stream(spark, sf, "events").withColumn("at", F.col("ts").cast("timestamp"))
    rows = events.select(
        F.col("user_id").cast("string").alias("uid"),
        (epoch_seconds(events, "ts") - F.second("ts")).alias("minute_u"),
        "at",
    )
    new = jobs.new_rows(rows, ["uid", "minute_u"], "at", "40 days").select("uid", "minute_u")
    _finish(sinks.start_log(new, f"{place}/log", f"{place}/progress"))
    return sinks.read_batches(spark, f"{place}/log", "uid string, minute_u bigint").drop("batch_id")


@query
def stream_signins(spark, sf):
    """Heartbeats to a minute log, and that log to sign-in messages by a stateful stream."""
    place = work_dir(spark, "signins")
    beats = fx.as_heartbeats(_stream(spark, sf, "events"))
    _finish(
        jobs.start_minutes(
            beats, lambda: fx.stream_rooms(spark), lambda: fx.switches(spark, sf), fx.SIGN_IN_CATES,
            f"{place}/minutes", f"{place}/progress",
        )
    )
    _finish(
        jobs.start_signins(
            spark, f"{place}/minutes", f"{place}/messages", f"{place}/told", threshold=fx.SIGN_IN_THRESHOLD, keep="40 days"
        )
    )
    return jobs.read_signins(spark, f"{place}/messages").select("uid", day_key(F.col("day")).alias("day"), "days")


@query
def stream_user_average(spark, sf):
    """The user-defined average kept over several micro-batches."""
    progress = work_dir(spark, "average")
    employees = fx.read(spark, sf, "customer").select("c_nationkey", F.round("c_acctbal").cast("bigint").alias("salary"))

    def reduce(rows: pd.DataFrame) -> dict:
        return {"total": int(rows["salary"].sum()), "count": len(rows)}

    def merge(buffers: pd.DataFrame) -> dict:
        return {"total": int(buffers["total"].sum()), "count": int(buffers["count"].sum())}

    buffer = "total bigint, count bigint"
    sums = aggregates.stream_user_aggregate(_dealt(spark, employees), ["c_nationkey"], ["salary"], buffer, reduce, merge)
    _finish(state.start_kept(sums, progress))
    kept = state.read_kept(spark, progress, f"c_nationkey {dict(employees.dtypes)['c_nationkey']}, {buffer}")
    return kept.select("c_nationkey", (F.col("total").cast("double") / F.col("count")).alias("average"))


@query
def stream_asof(spark, sf):
    """Heartbeats and switches as two streams in any order, joined by event time once each time is complete.

    A row far ahead ends the streams, so that the watermark passes all times.
    """
    place = work_dir(spark, "asof")
    beats = watch.rooms_of(fx.heartbeats(spark, sf), fx.stream_rooms(spark)).select("event_id", "room_id", "time_u")
    end = spark.range(1).select(
        F.lit(None).cast(dict(beats.dtypes)["event_id"]).alias("event_id"), F.lit("").alias("room_id"),  # a room without switches
        F.lit(fx.utc(2024, 12, 31)).cast("bigint").alias("time_u"),
    )
    beats.repartition(3).write.parquet(f"{place}/beats")
    end.coalesce(1).write.mode("append").parquet(f"{place}/beats")
    events = files.stream_parquet(spark, f"{place}/beats", max_files=1)
    found = ordered.asof_stream(events, _dealt(spark, fx.switches(spark, sf), 2), "90 days", fallback="null", slots=2)
    _finish(sinks.start_files(found, f"{place}/found", f"{place}/progress"))
    return spark.read.schema(found.schema).parquet(f"{place}/found").select("event_id", "room_id", "cate")


@query
def outbox_receipts(spark, sf):
    """Sign-in messages sent by a sender that refuses every third at first: each has one receipt, of its first or second attempt."""
    place = work_dir(spark, "outbox")
    beats = _beats(spark, sf)
    days = watch.signin_days(watch.minutes_per_day(beats), fx.SIGN_IN_THRESHOLD)
    messages = watch.signin_events(days).withColumn("day", day_key(F.col("day")))

    def sender(refuse: int):
        def deliver(frame: pd.DataFrame) -> list:
            third = (frame["uid"].astype(int) % refuse == 0) if refuse else [False] * len(frame)
            return [None if no else f"{u}:{d}" for no, u, d in zip(third, frame["uid"], frame["day"], strict=True)]

        return lambda: deliver

    for attempt, refuse in ((1, 3), (2, 0)):
        outbox.send(messages, ["uid", "day"], sender(refuse), place, attempt)
    told = outbox.receipts(spark, place, "uid string, day string, receipt string, sent_u bigint, attempt bigint")
    return told.select("uid", "day", "receipt", "attempt")


@query
def stream_sketches(spark, sf):
    """Minutes of every user and day as sketches of several micro-batches, merged: the sketches' own numbers."""
    place = work_dir(spark, "sketches")
    beats = fx.as_heartbeats(_dealt(spark, fx.read(spark, sf, "events")))
    _finish(
        jobs.start_sketches(
            beats, lambda: fx.stream_rooms(spark), lambda: fx.switches(spark, sf), fx.SIGN_IN_CATES, f"{place}/log", f"{place}/progress"
        )
    )
    return jobs.read_sketches(spark, f"{place}/log").select("uid", day_key(F.col("day")).alias("day"), "minutes", "low", "high")


@query
def stream_raw_top(spark, sf):
    """Gift records, parsed once, to top lists with sign-up copies, by the streaming jobs."""
    place = work_dir(spark, "raw")
    gifts = fx.as_gifts(_stream(spark, sf, "lineitem").select(*fx.LINE_COLUMNS), spark, sf)
    parsed = parse.parse_gift(_gift_records(gifts))
    _finish(jobs.start_parsed(parsed, f"{place}/parsed", f"{place}/parsing"))
    good = parse.positive_gifts(jobs.good_records(spark, f"{place}/parsed", jobs.GIFT, _half(spark, f"{place}/parsed")))
    with roomy_state(spark, fx.read(spark, sf, "lineitem").count()):
        running = jobs.start_boards(
            good, lambda: fx.gift_campaigns(spark), f"{place}/boards", host_group=lambda: fx.host_group(spark, sf),
            host_pool=lambda: fx.host_pool(spark, sf), classes=("all",), roles=RANKED, scopes=("all",),
        )
    _finish(running)
    del running
    release(spark)
    top = jobs.read_top(spark, f"{place}/boards")
    return top.select("project", "scope", "role", "period", "period_key", "member", "score", "rank")


@query
def stream_popularity(spark, sf):
    """Popularity records, parsed once, to boards with sign-up copies, by the streaming jobs."""
    place = work_dir(spark, "popularity")
    parsed = parse.parse_popularity(_popularity_records(_stream(spark, sf, "events")))
    _finish(jobs.start_parsed(parsed, f"{place}/parsed", f"{place}/parsing"))
    good = jobs.good_records(spark, f"{place}/parsed", jobs.READING, _half(spark, f"{place}/parsed"))
    _finish(jobs.start_peaks(good, lambda: fx.campaigns(spark, "popularity"), f"{place}/peaks"))
    return jobs.read_popularity(spark, f"{place}/peaks", fx.campaigns(spark, "popularity"), fx.star_pool(spark, sf))


@query
def stream_profile_merge(spark, sf):
    """Profile changes laid over the profile table, by the streaming job."""
    place = work_dir(spark, "profiles")
    changes = _change_records(_stream(spark, sf, "customer"))
    _finish(jobs.start_profile_changes(changes, "at", f"{place}/log", f"{place}/progress"))
    return jobs.read_profiles(spark, f"{place}/log", _known(spark, sf))


@query
def stream_switches(spark, sf):
    """Switch records to each room's latest switches, by the streaming job."""
    place = work_dir(spark, "switches")
    _finish(jobs.start_switches(_switch_records(_stream(spark, sf, "events")), f"{place}/log", f"{place}/progress"))
    return asof.latest_switch(jobs.read_switches(spark, f"{place}/log"))


@query
def stream_lookup(spark, sf):
    """Lines with their similar items, the lookup table read again in every batch."""
    place = work_dir(spark, "lookup")
    lines = _stream(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", (F.col("l_partkey") * 2).cast("string").alias("aid")
    )

    def combine(batch, lookup):
        found = tables.with_similar(batch, lookup, "aid")
        return found.select("l_orderkey", "l_linenumber", "aid", F.concat_ws("|", "similar").alias("similar"))

    _finish(
        jobs.start_with_lookup(lines, lambda: _similarity(spark, sf), combine, f"{place}/log", f"{place}/progress")
    )
    schema = "l_orderkey bigint, l_linenumber int, aid string, similar string"
    return sinks.read_batches(spark, f"{place}/log", schema).drop("batch_id")
