"""Category lookup and watch time against direct computations."""

from __future__ import annotations

import datetime as dt
from zoneinfo import ZoneInfo

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from encore.operators import asof, watch

SWITCH = "room_id string, cate string, time_u bigint"
EVENT = "id int, room_id string, time_u bigint"
T0 = 1_540_000_000 - 1_540_000_000 % 86400


def direct_category(switches, room, time, history, fallback):
    """The newest switch at or before the time, by a plain scan."""
    own = [(t, c) for r, c, t in switches if r == room]
    if history == "last":
        newest = {}
        for t, c in own:
            newest[c] = max(t, newest.get(c, t))
        own = [(t, c) for c, t in newest.items()]
    if not own:
        return "dropped"
    past = [x for x in own if x[0] <= time]
    return max(past)[1] if past else (min(own)[1] if fallback == "earliest" else None)


moments = st.integers(0, 40).map(lambda i: T0 + i * 900) | st.integers(T0, T0 + 4000)
rooms = st.sampled_from(["a", "a", "a", "b", "c"])


@pytest.mark.parametrize("history, fallback", [("last", "earliest"), ("full", "earliest"), ("full", "null")])
@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    switches=st.lists(st.tuples(rooms, st.sampled_from("xyz"), moments), max_size=25),
    asked=st.lists(st.tuples(rooms, moments), min_size=1, max_size=25),
)
def test_category_matches_a_direct_scan(spark, switches, asked, history, fallback):
    events = [(i, r, t) for i, (r, t) in enumerate(asked)]
    got = asof.asof_category(
        spark.createDataFrame(events, EVENT), spark.createDataFrame(switches, SWITCH), history, fallback
    )
    expected = {i: direct_category(switches, r, t, history, fallback) for i, r, t in events}
    assert {r.id: r.cate for r in got.collect()} == {i: c for i, c in expected.items() if c != "dropped"}


def test_hot_room_is_spread_over_buckets(spark):
    """A third of all events in one room: the join key has one group per room and hour."""
    events = spark.range(3000).selectExpr(
        "cast(id AS int) AS id", "IF(id % 3 = 0, 'hot', concat('r', id % 50)) AS room_id", f"{T0} + id * 60 AS time_u"
    )
    switches = spark.range(500).selectExpr(
        "IF(id % 3 = 0, 'hot', concat('r', id % 50)) AS room_id", "concat('c', id % 5) AS cate", f"{T0} + id * 333 AS time_u"
    )
    out = asof.asof_category(events, switches, history="full")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "[room_id" in plan and "_slot" in plan
    assert out.count() == events.join(switches.select("room_id").distinct(), "room_id").count()
    largest = events.groupBy("room_id", (events.time_u / asof.BUCKET).cast("int")).count().agg({"count": "max"}).first()[0]
    assert largest <= 60


def test_latest_switch_and_intervals(spark):
    rows = [("r", "A", 1), ("r", "B", 5), ("r", "A", 9), ("r", "C", 9)]
    df = spark.createDataFrame(rows, SWITCH)
    assert sorted(map(tuple, asof.latest_switch(df).collect())) == [("r", "A", 9), ("r", "B", 5), ("r", "C", 9)]
    intervals = asof.category_intervals(df).select("cate", "time_u", "until_u")
    assert sorted(map(tuple, intervals.collect()), key=lambda x: x[1]) == [("A", 1, 5), ("B", 5, 9), ("C", 9, None)]


BEAT = "uid string, flag string, time_u bigint"


def test_client_beats_reach_one_minute_back(spark):
    beats = spark.createDataFrame([("u", "p", T0 + 61), ("u", "c", T0 + 5), ("u", "c", T0 + 125)], BEAT)
    got = watch.watch_minutes(beats).collect()
    assert sorted((str(r.day), r.minute_u - T0) for r in got) == [
        (str(dt.datetime.fromtimestamp(T0 - 60, dt.timezone.utc).date()), -60),
        *[(str(dt.datetime.fromtimestamp(T0, dt.timezone.utc).date()), m) for m in (0, 60, 120)],
    ]


@pytest.mark.parametrize(
    "tz, start",
    [
        ("UTC", T0),
        ("Asia/Shanghai", T0),
        ("Asia/Kolkata", T0),
        ("America/New_York", 1_541_260_800),  # over the end of summer time, a day of 25 hours
        ("Australia/Lord_Howe", 1_554_508_800),  # the same by half an hour
    ],
)
def test_words_count_every_minute_of_a_day_once(spark, tz, start):
    seconds = range(start, start + 4 * 86400, 60)
    beats = spark.createDataFrame([("u", "p", s) for s in seconds] * 2, BEAT)
    got = {str(r.day): r.minutes for r in watch.minutes_per_day(beats, tz).collect()}
    expected = {}
    for s in seconds:
        day = str(dt.datetime.fromtimestamp(s, ZoneInfo(tz)).date())
        expected[day] = expected.get(day, 0) + 1
    assert got == expected


def test_words_match_distinct_minutes(spark):
    beats = spark.range(4000).selectExpr(
        "cast(id % 7 AS string) AS uid", "IF(id % 3 = 0, 'c', 'p') AS flag", f"{T0} + (id * 7919) % 260000 AS time_u"
    )
    by_words = {(r.uid, r.day): r.minutes for r in watch.minutes_per_day(beats).collect()}
    by_rows = {(r.uid, r.day): r["count"] for r in watch.watch_minutes(beats).groupBy("uid", "day").count().collect()}
    assert by_words == by_rows


def test_merged_words_equal_words_of_everything(spark):
    beats = spark.range(2000).selectExpr(
        "cast(id % 5 AS string) AS uid", "'p' AS flag", f"{T0} + (id * 613) % 200000 AS time_u"
    )
    minutes = watch.expand_minutes(beats)
    halves = watch.minute_words(minutes.where("minute_u % 120 = 0")).unionByName(
        watch.minute_words(minutes.where("minute_u % 120 <> 0 OR uid = '1'"))
    )
    merged = watch.merge_words(halves)
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, watch.minute_words(minutes).collect()))


def test_rooms_and_range(spark):
    beats = spark.createDataFrame([("s1", 5), ("s2", 5), ("s3", 5)], "stream string, time_u bigint")
    known = spark.createDataFrame([("s1", "r1"), ("s2", ""), ("s3", None)], "stream string, room_id string")
    assert [r.room_id for r in watch.rooms_of(beats, known).collect()] == ["r1"]
    times = spark.createDataFrame([(t,) for t in (9, 10, 20, 21)], "time_u bigint")
    assert [r.time_u for r in watch.in_range(times, 10, 20).collect()] == [10, 20]


def test_category_list_has_no_wildcard(spark):
    beats = spark.createDataFrame([("u", "s", "p", T0)], "uid string, stream string, flag string, time_u bigint")
    known = spark.createDataFrame([("s", "r")], "stream string, room_id string")
    switches = spark.createDataFrame([("r", "A", T0)], SWITCH)
    assert watch.beats_in_category(beats, known, switches, ["A"]).count() == 1
    assert watch.beats_in_category(beats, known, switches, ["default"]).count() == 0


def test_sign_ins_count_up(spark):
    rows = [("u", "20240102", 170), ("u", "20240101", 171), ("u", "20240103", 169), ("v", "20240101", 500)]
    per_day = spark.createDataFrame(rows, "uid string, day string, minutes int")
    days = watch.signin_days(per_day)
    events = watch.signin_events(days).collect()
    assert sorted((r.uid, r.day, r.days, r.value) for r in events) == [
        ("u", "20240101", 1, '{"uid":"u","days":1}'),
        ("u", "20240102", 2, '{"uid":"u","days":2}'),
        ("v", "20240101", 1, '{"uid":"v","days":1}'),
    ]
    assert [tuple(r) for r in watch.nth_signin_day(days, 2).collect()] == [("u", "20240102")]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(switches=st.lists(st.tuples(rooms, st.sampled_from("xyz"), st.integers(T0, T0 + 300)), min_size=1, max_size=30))
def test_intervals_do_not_depend_on_the_bucket(spark, switches):
    df = spark.createDataFrame(switches, SWITCH)
    expected = set()
    for room in {r for r, _, _ in switches}:
        times = sorted({t for r, _, t in switches if r == room})
        for time, after in zip(times, [*times[1:], None]):
            expected.add((room, time, max(c for r, c, t in switches if (r, t) == (room, time)), after))
    got = asof.category_intervals(df, bucket=10).select("room_id", "time_u", "cate", "until_u")
    assert {tuple(r) for r in got.collect()} == expected


def test_sketches_add_up(spark):
    """Sketches of parts that overlap, merged, tell what one of all tells, within their own bound of the true number."""
    from pyspark.sql import functions as F

    minutes = spark.range(60_000).selectExpr(
        "IF(id % 3 = 0, 'hot', concat('u', id % 40)) AS uid", "date'2024-01-01' AS day", "(id * 7919 % 40000) * 60 AS minute_u", "id % 4 AS part"
    )
    whole = watch.estimate_minutes(watch.minute_sketches(minutes))
    both = minutes.where("part <> 0"), minutes.where("part <> 1")
    parts = watch.minute_sketches(both[0]).unionAll(watch.minute_sketches(both[1]))
    merged = {r.uid: r for r in watch.estimate_minutes(watch.merge_sketches(parts)).collect()}
    exact = {r.uid: r.n for r in minutes.groupBy("uid").agg(F.countDistinct("minute_u").alias("n")).collect()}
    assert set(merged) == set(exact) and max(exact.values()) > 10_000
    for r in whole.collect():
        assert r.low <= exact[r.uid] <= r.high and merged[r.uid].low <= exact[r.uid] <= merged[r.uid].high
    assert merged["hot"].minutes != exact["hot"]  # the sketch's own number
    size = watch.merge_sketches(parts).select(F.max(F.octet_length("sketch"))).first()[0]
    assert size < 5000
