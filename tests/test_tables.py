"""Popularity, profiles, aggregates, ledger, distance and retention."""

from __future__ import annotations

import datetime as dt
import math
import random

import pandas as pd
import pytest

from encore.functions import calendar
from encore.operators import aggregates, campaigns, enrich, popularity, tables
from pyspark.sql import functions as F

T0 = 1_543_104_000  # 2018-11-25 00:00 UTC, a Sunday
DAY = 86400


def star(spark, start=T0, end=T0 + 60 * DAY, **more):
    config = {"project": "p", "startTimeU": start, "endTimeU": end, "flag": 0, "popularRank": "true",
              "weekPopularRank": "true", "monthPopularRank": "true", **more}
    text = ",".join(f"{k}={v}" for k, v in config.items())
    return campaigns.parse_campaigns(spark.createDataFrame([("p", text)], "name string, config string"), "popularity")


def direct_popularity(peaks, start, last):
    """Averages over the trailing ranges ending at each day, the last day of a period winning."""
    out = {}
    day = start
    while day <= last:
        if day in peaks:
            size = (day - start).days + 1
            iso = day.isocalendar()
            ranges = {
                ("all", ""): size,
                ("week", f"{iso[0]}-W{iso[1]:02d}"): min(iso[2], size),
                ("month", day.strftime("%Y%m")): min(day.day, size),
            }
            for key, days in ranges.items():
                used = [p for i in range(days) if (p := peaks.get(day - dt.timedelta(days=i), 0)) != 0]
                if used and sum(used) > 0:
                    out[key] = sum(used) // len(used)
        day += dt.timedelta(days=1)
    return out


@pytest.mark.parametrize("seed", range(3))
def test_popularity_matches_the_trailing_ranges(spark, seed):
    rng = random.Random(seed)
    first = dt.date(2018, 11, 25)
    peaks = {first + dt.timedelta(days=d): rng.choice([0, 0, 7, 100, 9000]) for d in range(45) if rng.random() < 0.7}
    df = spark.createDataFrame([("p", "h", d, v) for d, v in peaks.items()], "project string, host_id string, day date, peak int")
    got = popularity.popularity_scores(df, star(spark))
    assert {(r.period, r.period_key): r.score for r in got.collect()} == direct_popularity(peaks, first, max(peaks))


def test_peaks_take_the_day_of_the_clock_text(spark):
    rows = [("h", "c", 5, T0 + 10, "2018-11-26 00:00:01"), ("h", "c", 9, T0 + 20, "2018-11-26 09:00:00"), ("h", "c", 99, T0 - 1, "2018-11-26 00:00:00")]
    df = spark.createDataFrame(rows, "host_id string, cate string, num int, time_u bigint, time string")
    assert [(str(r.day), r.peak) for r in popularity.host_day_peak(df, star(spark)).collect()] == [("2018-11-26", 9)]
    by_epoch = popularity.host_day_peak(df.drop("time"), star(spark), tz="Asia/Shanghai")
    assert [(str(r.day), r.peak) for r in by_epoch.collect()] == [("2018-11-25", 9)]


def test_no_row_for_zero_peaks(spark):
    df = spark.createDataFrame([("p", "h", dt.date(2018, 12, 1), 0)], "project string, host_id string, day date, peak int")
    assert popularity.popularity_scores(df, star(spark)).count() == 0


def test_day_number(spark):
    start = calendar.local_date(F.lit(1543075200).cast("bigint"), "Asia/Shanghai")
    row = spark.range(1).select(calendar.day_number(F.lit("2018-11-29").cast("date"), start).alias("n")).first()
    assert row.n == 5


def test_calendar_does_not_depend_on_the_session_zone(spark):
    try:
        got = []
        for zone in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            df = spark.sql("SELECT TIMESTAMP_NTZ'2018-12-31 23:59:59.25' AS ts")
            row = df.select(
                calendar.epoch_seconds(df, "ts").alias("s"), calendar.epoch_micros(df, "ts").alias("m")
            ).select(
                "s", "m", *[
                    f(calendar.local_date(F.col("s"), tz)).alias(f"{f.__name__}{tz}")
                    for f in (calendar.day_key, calendar.week_key, calendar.month_key) for tz in ("UTC", "Asia/Tokyo")
                ],
            ).first()
            got.append(tuple(row))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got[0] == got[1] == (
        1546300799, 1546300799250000, "20181231", "20190101", "2019-W01", "2019-W01", "201812", "201901"
    )


PROFILE = "rid string, nick_name string, avatar string"


def test_profile_merge_keeps_absent_fields_and_ignores_unknown_ids(spark):
    current = spark.createDataFrame([("1", "a", "x"), ("2", "b", "y")], PROFILE)
    changes = spark.createDataFrame(
        [("1", "new", None, 1), ("1", None, "z", 2), ("1", "newer", None, 3), ("9", "ghost", "g", 1)], PROFILE + ", at int"
    )
    got = enrich.merge_profile(current, changes, order="at")
    assert sorted(map(tuple, got.collect())) == [("1", "newer", "z"), ("2", "b", "y")]


def test_fill_missing_and_json(spark):
    ids = spark.createDataFrame([("1",), ("2",), ("2",), ("3",)], "rid string")
    cache = spark.createDataFrame([("1", "a", "x")], PROFILE)
    known = spark.createDataFrame([("1", "a", "x"), ("2", "b", "y")], PROFILE)
    found = enrich.fill_missing(ids, cache, known).select(enrich.profile_json(F.lit(None).cast("string")).alias("v"))
    assert [r.v for r in found.collect()] == ['{"rid":"2","nickName":"b","avatar":"y","roomId":""}']


def test_puts_and_sets(spark):
    kv = "k string, v int"
    current = spark.createDataFrame([("a", 1)], kv)
    rows = spark.createDataFrame([("a", 5), ("b", 2), ("b", 3)], kv)
    assert sorted(map(tuple, enrich.put_if_absent(current, rows, "k").collect())) == [("a", 1), ("b", 2)]
    assert sorted(map(tuple, enrich.put(current, rows, "k").collect())) == [("a", 5), ("b", 3)]
    assert [r.k for r in enrich.new_members(current, rows, ["k"]).collect()] == ["b"]
    ids = [spark.createDataFrame([(x,) for x in text], "id string") for text in ("aab", "bc")]
    assert sorted(r.id for r in enrich.union_ids(*ids).collect()) == ["a", "b", "c"]
    assert [r.id for r in enrich.common_ids(*ids).collect()] == ["b"]


def test_only_profiles_that_lack_are_added_and_a_host_brings_its_room(spark):
    row = "rid string, nick_name string, room_id string"
    current = spark.createDataFrame([("h", "old", ""), ("u", "old", "7")], row)
    hosts = spark.createDataFrame([("h", "new", "9"), ("w", "new", "8")], row)
    users = spark.createDataFrame([("u", "new", ""), ("h", "newer", ""), ("v", "new", ""), ("w", "new", "")], row)
    got = enrich.store_profiles(current, hosts, users)
    assert sorted(map(tuple, got.collect())) == [("h", "old", ""), ("u", "old", "7"), ("v", "new", ""), ("w", "new", "8")]


def test_user_aggregate_on_a_hot_key(spark):
    """User code over many Arrow batches and partitions of one key."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        df = spark.range(3000, numPartitions=6).selectExpr("IF(id % 3 = 0, 'hot', concat('k', id % 20)) AS k", "id AS v")

        def reduce(rows: pd.DataFrame) -> dict:
            return {"low": int(rows["v"].min()), "n": len(rows)}

        def merge(buffers: pd.DataFrame) -> dict:
            return {"low": int(buffers["low"].min()), "n": int(buffers["n"].sum())}

        got = aggregates.user_aggregate(
            df, ["k"], ["v"], "low bigint, n bigint", reduce, merge, F.concat_ws("/", "low", "n").alias("r")
        )
        expected = df.groupBy("k").agg(F.concat_ws("/", F.min("v"), F.count("*")).alias("r"))
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_typed_average(spark):
    rows = [("Michael", 3000), ("Andy", 4500), ("Justin", 3500), ("Berta", 4000)]
    df = spark.createDataFrame(rows, "name string, salary bigint")
    assert aggregates.typed_average(df, "salary").first().average == 3750.0


def test_running_max_starts_at_zero(spark):
    df = spark.createDataFrame([("a", -5), ("b", 3), ("b", 7)], "k string, v int")
    assert sorted(map(tuple, aggregates.running_max(df, "k", "v").collect())) == [("a", 0), ("b", 7)]


def test_sliding_windows_overlap_unevenly(spark):
    df = spark.sql("SELECT 'a' AS id, timestamp_seconds(t) AS ts, 1 AS v FROM VALUES (9), (10), (11) AS x(t)")
    stats = aggregates.sliding_stats(df, "id", "ts", "v")
    got = {r.s: r.sum_value for r in stats.select(F.unix_seconds("window_start").alias("s"), "sum_value").collect()}
    expected = {}
    for t in (9, 10, 11):
        for s in range(-30, 30, 3):
            if s <= t < s + 10:
                expected[s] = expected.get(s, 0) + 1
    assert got == expected


def test_resume_offsets(spark):
    ledger = spark.createDataFrame(
        [("t", "g", 0, 5, 100), ("t", "g", 1, 7, 100), ("t", "g", 0, 9, 200), ("t", "g", 1, 8, 200), ("t", "h", 0, 99, 900)],
        "topic string, group_id string, partition int, until_offset bigint, batch_ms bigint",
    )
    now = [("t", "g", p) for p in range(3)] + [("new", "g", 0)]
    partitions = spark.createDataFrame(now, "topic string, group_id string, partition int")
    got = {(r.topic, r.partition): r.from_offset for r in tables.resume_offsets(ledger, partitions).collect()}
    assert got == {("t", 0): 9, ("t", 1): 8, ("t", 2): 0, ("new", 0): 0}


def test_radius_against_direct_distances(spark):
    rng = random.Random(3)
    places = [(i, rng.uniform(-85, 85), rng.uniform(-180, 180)) for i in range(300)]
    df = spark.createDataFrame(places, "place int, lat double, lon double")
    got = tables.within_radius(df, "place", 0, 3000.0).collect()
    _, lat, lon = places[0]

    def km(a, b):
        u = math.sin(math.radians(a - lat) / 2) ** 2
        v = math.sin(math.radians(b - lon) / 2) ** 2
        return 2 * tables.EARTH_KM * math.asin(math.sqrt(u + math.cos(math.radians(lat)) * math.cos(math.radians(a)) * v))

    expected = sorted((km(a, b), i) for i, a, b in places if km(a, b) <= 3000)
    assert [r.place for r in got] == [i for _, i in expected]
    assert got[0].place == 0 and got[0].distance == 0
    assert tables.within_radius(df, "place", -1, 10.0).count() == 0


def test_retention(spark):
    df = spark.createDataFrame([(100,), (101,), (200,)], "written bigint")
    assert [r.written for r in tables.expire_rows(df, "written", 100, 200).collect()] == [101, 200]


def test_retention_reaches_the_scan(spark, sf):
    events = spark.read.parquet(f"{sf}/events.parquet").select("event_id", "ts")
    plan = tables.expire_rows(events, "ts", 3600, 1_706_000_000)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(ts" in plan


def test_similar_items(spark):
    table = spark.createDataFrame([("1", "2,3"), ("4", "5")], "aid_type string, aids string")
    assert [tuple(r) for r in tables.similar_items(table).collect()] == [("1", "2"), ("1", "3"), ("4", "5")]
    events = spark.createDataFrame([("1",), ("9",)], "aid string")
    assert {r.aid: r.similar for r in tables.with_similar(events, table, "aid").collect()} == {"1": ["2", "3"], "9": None}


@pytest.mark.parametrize("km", [40.0, 700.0, 9000.0])
def test_pairs_within_any_place(spark, km):
    """Centres and points at the poles, on both sides of the date line, on cell borders and anywhere, against all pairs."""
    rng = random.Random(int(km))
    odd = [(90.0, 0.0), (-90.0, 17.0), (0.0, 180.0), (0.0, -180.0), (0.1, 179.9), (-0.1, -179.9), (89.8, 100.0), (89.9, -80.0), (None, 1.0), (1.0, None)]
    some = lambda n: [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(n)] + odd
    near = [(lat + rng.uniform(-3, 3), lon + rng.uniform(-3, 3)) for lat, lon in odd[2:6] for _ in range(10)]
    places, centres = [*some(150), *near], some(60)
    points = spark.createDataFrame([(i, *p) for i, p in enumerate(places)], "member int, lat double, lon double")
    asked = spark.createDataFrame([(i, *p) for i, p in enumerate(centres)], "centre int, lat double, lon double")
    got = {(r.centre, r.member) for r in tables.pairs_within(points, asked, "member", "centre", km).collect()}

    def far(a, b):
        u, v = (math.sin(math.radians(b[i] - a[i]) / 2) for i in (0, 1))
        return 2 * tables.EARTH_KM * math.asin(min(1.0, math.sqrt(u * u + math.cos(math.radians(a[0])) * math.cos(math.radians(b[0])) * v * v)))

    expected = {
        (i, j) for i, c in enumerate(centres) for j, p in enumerate(places)
        if None not in (*c, *p) and far(c, p) <= km
    }
    assert got == expected and expected
    rows = tables.pairs_within(points, asked, "member", "centre", km)
    assert rows.count() == len(expected)  # no pair twice
    assert "NestedLoop" not in rows._jdf.queryExecution().executedPlan().toString()


def test_pairs_within_refuses_half_the_globe(spark):
    points = spark.createDataFrame([(1, 0.0, 0.0)], "member int, lat double, lon double")
    with pytest.raises(ValueError):
        tables.pairs_within(points, points.withColumnRenamed("member", "centre"), "member", "centre", 15_000.0)


@pytest.mark.parametrize("size, slide", [(10, 3), (9, 3), (4, 4), (3, 10), (7, 5)])
def test_panes_equal_windows(spark, size, slide):
    """Windows that overlap, meet and leave gaps; the shuffle carries a row for a pane and key."""
    df = spark.range(400).selectExpr(
        "IF(id % 3 = 0, 'hot', cast(id % 5 AS string)) AS id", "timestamp_micros(1540000000000000 + (id * 7919 % 90) * 500000) AS ts", "cast(id AS int) AS v"
    )
    got = aggregates.sliding_panes(df, "id", "ts", "v", size, slide)
    if slide <= size:
        wide = aggregates.sliding_stats(df, "id", "ts", "v", f"{size} seconds", f"{slide} seconds")
    else:  # the engine has no windows with gaps between them
        rows = df.selectExpr("*", f"floor(unix_micros(ts) / {slide}000000) * {slide} AS s").where(f"unix_micros(ts) < (s + {size}) * 1000000")
        wide = rows.groupBy("s", "id").agg(F.min("ts").alias("a"), F.max("ts").alias("b"), F.sum("v").alias("c"))
        wide = wide.select(F.timestamp_seconds("s").alias("window_start"), F.timestamp_seconds(F.col("s") + size).alias("window_end"), "id", "a", "b", "c")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, wide.collect()))


def test_bucketed_dimensions_stay_where_they_are(spark, tmp_path):
    """One exchange of the rows serves both dimensions, which have none."""
    from encore.sources import files

    ids = spark.range(500).selectExpr("cast(id AS string) AS rid")
    stored = [
        files.store_dimension(ids.where(f"rid % {n} <> 0").withColumn(name, F.concat(F.lit(name), "rid")), f"dim_{name}", "rid", 8, str(tmp_path / name))
        for n, name in ((3, "profile"), (5, "level"))
    ]
    rows = spark.range(3000).selectExpr("cast(id % 700 AS string) AS member", "id AS score")
    found = enrich.with_dimensions(rows, stored)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" in plan and "Broadcast" not in plan
    expected = sorted(
        (str(i % 700), i, f"profile{i % 700}" if i % 700 < 500 and i % 700 % 3 else None, f"level{i % 700}" if i % 700 < 500 and i % 700 % 5 else None)
        for i in range(3000)
    )
    assert sorted(map(tuple, found.select("member", "score", "profile", "level").collect()), key=repr) == sorted(expected, key=repr)


def test_points_of_pairs_are_dealt_out_evenly(spark):
    points = spark.range(500).selectExpr("id AS p", "0.0 AS lat", "id / 1000.0 AS lon")
    centres = spark.range(3).selectExpr("id AS c", "0.0 AS lat", "0.1D * id AS lon")
    near = tables.pairs_within(points, centres, "p", "c", 400.0)
    assert near.count() == 1500
    assert "REBALANCE_PARTITIONS_BY_NONE" in near._jdf.queryExecution().executedPlan().toString()
