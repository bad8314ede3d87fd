"""Streams against the batch operators: many files, restarts, replays, refreshed lookups."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from encore.operators import aggregates, boards, campaigns, popularity, watch
from encore.sources import files
from encore.streaming import jobs, sinks, state

T0 = 1_540_000_000 - 1_540_000_000 % 86400
DAY = 86400


def config(spark, **more):
    keys = {"project": "p", "startTimeU": T0, "endTimeU": T0 + 30 * DAY, "flag": 0, "allRank": "true",
            "dayAllRank": "true", "popularRank": "true", **more}
    text = ",".join(f"{k}={v}" for k, v in keys.items())
    return campaigns.parse_campaigns(spark.createDataFrame([("p", text)], "name string, config string"))


def gifts(spark):
    return spark.range(600).selectExpr(
        "IF(id % 3 = 0, 'hot', concat('u', id % 11)) AS uid", "concat('q', id % 5) AS qid", "'r' AS room_id",
        "'g' AS gift_id", "cast(id % 9 + 1 AS int) AS total", "'c' AS cate", f"{T0} + (id * 7919) % {5 * DAY} AS time_u",
    )


def in_files(df, folder, count=4):
    """The rows as ``count`` files, one per micro-batch."""
    df.repartition(count).write.mode("append").parquet(str(folder))
    return str(folder)


def stream(spark, folder):
    return files.stream_parquet(spark, folder, max_files=1)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: [(v is None, v) if not isinstance(v, (list, dict)) else (False, str(v)) for v in r])


def test_boards_equal_batch_over_many_batches_and_a_restart(spark, tmp_path):
    """All that is kept lies in the checkpoint; campaigns of the second start have one more board."""
    running, source, progress = config(spark), in_files(gifts(spark), tmp_path / "in", 3), str(tmp_path / "progress")
    assert jobs.read_boards(spark, progress).count() == 0
    jobs.start_boards(stream(spark, source), lambda: running, progress).awaitTermination()
    assert rows(jobs.read_boards(spark, progress).select(*boards.SCORES)) == rows(boards.board_scores(gifts(spark), running))
    more = gifts(spark).withColumn("uid", F.lit("late"))
    in_files(more, source, 2)
    query = jobs.start_boards(stream(spark, source), lambda: config(spark, weekAllRank="true"), progress)
    query.awaitTermination()
    assert query.lastProgress["batchId"] == 4 and {p.name for p in tmp_path.iterdir()} == {"in", "progress"}
    weeks = boards.board_scores(more, config(spark, weekAllRank="true")).where("period = 'week'")
    expected = boards.board_scores(gifts(spark).unionByName(more), running).unionByName(weeks)
    assert rows(jobs.read_boards(spark, progress).select(*boards.SCORES)) == rows(expected)


def test_state_goes_on_after_a_failed_batch(spark, tmp_path):
    running, source, progress = config(spark), in_files(gifts(spark), tmp_path / "in", 3), str(tmp_path / "progress")
    fail = F.udf(lambda v: 1 // (v - 9) and v, "int")  # no total is above 9, so a tenth fails the batch that holds it
    broken = stream(spark, source).withColumn("total", F.when(F.col("uid") == "hot", fail("total")).otherwise(F.col("total")))
    with pytest.raises(Exception, match="ZeroDivisionError"):
        jobs.start_boards(broken, lambda: running, progress).awaitTermination()
    jobs.start_boards(stream(spark, source), lambda: running, progress).awaitTermination()
    assert rows(jobs.read_boards(spark, progress).select(*boards.SCORES)) == rows(boards.board_scores(gifts(spark), running))


def test_rounds_read_dimensions_again(spark, tmp_path):
    source, progress, started = in_files(gifts(spark), tmp_path / "in", 2), str(tmp_path / "progress"), []

    def begin():
        started.append(1)
        return jobs.start_boards(stream(spark, source), lambda: config(spark, online="false" if len(started) == 1 else "true"), progress)

    state.rounds(begin, 0, lambda: len(started) < 1)
    assert jobs.read_boards(spark, progress).count() == 0
    more = in_files(gifts(spark), source, 1)
    assert more == source
    state.rounds(begin, 0, lambda: len(started) < 3)
    assert rows(jobs.read_boards(spark, progress).select(*boards.SCORES)) == rows(boards.board_scores(gifts(spark), config(spark)))


def test_replayed_batch_counts_once(spark, tmp_path):
    log = str(tmp_path / "log")
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v bigint")
    for batch_id in (0, 1, 1, 0):
        sinks.write_batch(df, log, batch_id)
    assert rows(sinks.read_batches(spark, log, df.schema)) == [("a", 1, 0), ("a", 1, 1), ("b", 2, 0), ("b", 2, 1)]


def test_change_log_readers(spark, tmp_path):
    log = str(tmp_path / "log")
    schema = "k string, v int"
    assert sinks.read_batches(spark, log, schema).count() == 0
    for batch_id, batch in enumerate([[("a", 5), ("b", 1)], [("a", 3)], [("c", 9)]]):
        sinks.write_batch(spark.createDataFrame(batch, schema), log, batch_id)
    read = sinks.read_batches(spark, log, schema)
    assert rows(sinks.newest(read, ["k"])) == [("a", 3), ("b", 1), ("c", 9)]
    assert rows(sinks.newest(sinks.read_batches(spark, log, schema, before=1), ["k"])) == [("a", 5), ("b", 1)]
    assert rows(sinks.read_batches(spark, log, schema, last=True).drop("batch_id")) == [("c", 9)]


def expiring(values, keep):
    """uid -> (total, last) of (uid, second, value) rows in order, each kept for ``keep`` seconds after its last write."""
    kept: dict = {}
    for uid, at, value in values:
        total, last = kept.get(uid, (0, at))
        kept[uid] = (value if at - last > keep else total + value, max(at, last))
    newest = max(at for _, at, _ in values)
    return sorted((uid, total, last) for uid, (total, last) in kept.items() if last + keep >= newest)


def test_keys_expire_by_their_own_last_write(spark, tmp_path):
    """Sums that go, come again, or are written to in time, over many batches and a restart; nothing is written anew."""
    at = [0, 100, 250, 400, 1000, 1050, 2000, 2001, 5000, 5090, 5100]
    values = [(f"u{i % 3}", T0 + a, i + 1) for i, a in enumerate(at)] + [("old", T0 + 5000, 7), ("kept", T0 + 5100, 9), ("gone", T0 + 2000, 3)]
    values.sort(key=lambda v: v[1])
    progress, source = str(tmp_path / "progress"), str(tmp_path / "in")
    for turn, part in enumerate((values[:4], values[4:8], values[8:])):
        for some in (part[:2], part[2:]):
            one = spark.createDataFrame(some, "uid string, u bigint, v int").withColumn("at", F.timestamp_seconds("u"))
            one.coalesce(1).write.mode("append").parquet(source)
        sums = state.expiring_sums(stream(spark, source), ["uid"], "v", "at", keep=300, late="1 hour" if turn == 0 else "0 seconds")
        state.start_kept(sums, progress).awaitTermination()
    assert rows(state.read_sums(spark, progress, "uid string")) == expiring(values, 300)
    assert {r.uid for r in state.read_sums(spark, progress, "uid string").collect()} >= {"kept", "old"}
    assert state.read_sums(spark, progress, "uid string").where("uid = 'gone'").count() == 0


def test_top_lists_touch_their_own_boards_alone(spark, tmp_path):
    """Several batches and a restart against the batch operator; a batch of one board updates that board's state only."""
    from encore.operators import ranking

    running, source, place = config(spark), in_files(gifts(spark), tmp_path / "in", 3), str(tmp_path)

    def run(k=3, slots=2):
        sums = jobs.board_sums(stream(spark, source), running)
        sinks.start_log(sums, f"{place}/changes", f"{place}/progress", "update").awaitTermination()
        query = jobs.start_top_lists(spark, f"{place}/changes", f"{place}/touched", f"{place}/lists", k, slots, max_files=1)
        query.awaitTermination()
        return query

    columns = [*boards.SCORES, "rank"]
    run()
    expected = ranking.top_k(boards.board_scores(gifts(spark), running).where("role <> 'donor'"), boards.BOARD, 3)
    assert rows(jobs.read_top_lists(spark, f"{place}/lists", 3).select(columns)) == rows(expected.select(columns))
    one = gifts(spark).where("uid = 'u1' AND qid = 'q1'").limit(1)
    in_files(one, source, 1)
    query = run()
    touched = sum(p["stateOperators"][0]["numRowsUpdated"] for p in query.recentProgress)
    lists = jobs.read_top_lists(spark, f"{place}/lists", 3).select(*boards.BOARD).distinct().count()
    assert 0 < touched <= 4 < lists  # host and user, whole campaign and day
    everything = boards.board_scores(gifts(spark).unionByName(one), running).where("role <> 'donor'")
    expected = ranking.top_k(everything, boards.BOARD, 3)
    assert rows(jobs.read_top_lists(spark, f"{place}/lists", 3).select(columns)) == rows(expected.select(columns))
    told = jobs.read_touched(spark, f"{place}/touched")
    assert set(rows(expected.select(*boards.SCORES))) <= set(rows(told.select(*boards.SCORES)))


def test_native_board_totals(spark, tmp_path):
    running, source = config(spark), in_files(gifts(spark), tmp_path / "in")
    totals = jobs.board_totals(stream(spark, source), running)
    sinks.start_log(totals, str(tmp_path / "log"), str(tmp_path / "progress"), "update").awaitTermination()
    log = sinks.read_batches(spark, str(tmp_path / "log"), totals.schema)
    got = sinks.newest(log, [*boards.BOARD, "member"]).select(*boards.SCORES)
    assert rows(got) == rows(boards.board_scores(gifts(spark), running))


def test_peaks_equal_batch(spark, tmp_path):
    readings = gifts(spark).selectExpr("qid AS host_id", "cate", "total * 13 % 7 AS num", "time_u")
    running, source = config(spark), in_files(readings, tmp_path / "in")
    progress = str(tmp_path / "progress")
    jobs.start_peaks(stream(spark, source), lambda: running, progress).awaitTermination()
    expected = popularity.host_day_peak(readings, running).select("project", "host_id", "day", "peak")
    assert rows(jobs.read_peaks(spark, progress).select("project", "host_id", "day", "peak")) == rows(expected)


def heartbeats(spark):
    return spark.range(900).selectExpr(
        "concat('u', id % 4) AS uid", "cast(id % 3 AS string) AS stream", "IF(id % 5 = 0, 'c', 'p') AS flag",
        f"{T0} + (id * 1013) % {3 * DAY} AS time_u",
    )


def dimensions(spark):
    known = spark.createDataFrame([("0", "a"), ("1", "b")], "stream string, room_id string")
    switches = spark.createDataFrame(
        [("a", "x", T0), ("a", "y", T0 + DAY), ("b", "x", T0 + 2 * DAY)], "room_id string, cate string, time_u bigint"
    )
    return known, switches


def batch_signins(spark, threshold):
    beats = watch.beats_in_category(heartbeats(spark), *dimensions(spark), ["x"])
    return watch.signin_events(watch.signin_days(watch.minutes_per_day(beats), threshold))


def test_signins_equal_batch(spark, tmp_path):
    known, switches = dimensions(spark)
    source = in_files(heartbeats(spark), tmp_path / "in", 5)
    minutes, told = str(tmp_path / "minutes"), str(tmp_path / "told")
    jobs.start_minutes(
        stream(spark, source), lambda: known, lambda: switches, ["x"], minutes, str(tmp_path / "progress")
    ).awaitTermination()
    query = jobs.start_signins(spark, minutes, told, str(tmp_path / "messages"), threshold=60, max_files=2)
    query.awaitTermination()
    assert sum(p["numInputRows"] > 0 for p in query.recentProgress) > 2
    got = jobs.read_signins(spark, told)
    expected = batch_signins(spark, 60)
    assert expected.count() > 3
    assert jobs.read_signins(spark, told, keep=3600).count() == got.count() > jobs.read_signins(spark, told, keep=-10).count() == 0
    # The order in which a user's days are reached may differ from calendar order.
    assert rows(got.select("uid", "day")) == rows(expected.select("uid", "day"))
    assert rows(got.select("uid", "days")) == rows(expected.select("uid", "days"))
    beats = watch.beats_in_category(heartbeats(spark), known, switches, ["x"])
    assert rows(jobs.read_minutes(spark, minutes)) == rows(watch.minutes_per_day(beats))


def test_sign_in_state_goes_with_its_retention(spark, tmp_path):
    """A day that comes again after its words have expired starts anew; days that are kept never count twice."""
    day = 86400
    beats = spark.range(3).selectExpr("'u' AS uid", "id AS stream", "'p' AS flag", f"{T0} + id * 60 AS time_u")
    words = watch.minute_words(watch.expand_minutes(beats.unionAll(beats.withColumn("time_u", F.col("time_u") + 30 * day))))
    words.orderBy("day").coalesce(1).write.parquet(str(tmp_path / "words"))
    told = jobs.sign_ins(spark.readStream.schema(words.schema).parquet(str(tmp_path / "words")), threshold=3)
    sinks.start_files(told, str(tmp_path / "out"), str(tmp_path / "progress")).awaitTermination()
    got = spark.read.schema("uid string, day date, days bigint").parquet(str(tmp_path / "out"))
    assert sorted(r.days for r in got.collect()) == [1, 2]


def test_sign_in_timers_wake_nobody_without_days_to_drop(spark, tmp_path):
    """The batch that moves the watermark calls no user again, as all days are still kept."""
    beats = spark.range(30).selectExpr("cast(id % 10 AS string) AS uid", "id AS stream", "'p' AS flag", f"{T0} + id * 60 AS time_u")
    watch.minute_words(watch.expand_minutes(beats)).write.parquet(str(tmp_path / "words"))
    told = jobs.sign_ins(spark.readStream.schema(jobs.WORD_LOG).parquet(str(tmp_path / "words")), threshold=3)
    query = sinks.start_files(told, str(tmp_path / "out"), str(tmp_path / "progress"))
    query.awaitTermination()
    empty = [p for p in query.recentProgress if not p["numInputRows"]]
    assert empty and sum(p["stateOperators"][0]["numRowsUpdated"] for p in empty) == 0
    assert spark.read.parquet(str(tmp_path / "out")).count() == 10


def test_minute_words_as_a_native_stream(spark, tmp_path):
    beats = heartbeats(spark).withColumn("ts", F.timestamp_seconds("time_u"))
    source = in_files(beats, tmp_path / "in")
    words = jobs.minute_totals(stream(spark, source), keep="7 days")
    sinks.start_log(words, str(tmp_path / "log"), str(tmp_path / "progress"), "update").awaitTermination()
    newest = sinks.newest(sinks.read_batches(spark, str(tmp_path / "log"), jobs.WORD_LOG), ["uid", "day"])
    got = newest.select("uid", "day", watch.count_words().alias("minutes"))
    assert rows(got) == rows(watch.minutes_per_day(heartbeats(spark)))


def test_running_max_and_word_count(spark, tmp_path):
    clicks = spark.range(300).selectExpr("cast(id % 6 AS string) AS uid", "cast((id * 37) % 101 - 50 AS int) AS v")
    source = in_files(clicks, tmp_path / "in")
    best = aggregates.running_max(stream(spark, source), "uid", "v")
    sinks.start_log(best, str(tmp_path / "log"), str(tmp_path / "progress"), "update").awaitTermination()
    got = sinks.newest(sinks.read_batches(spark, str(tmp_path / "log"), "uid string, best int"), ["uid"])
    assert rows(got) == rows(aggregates.running_max(clicks, "uid", "v"))


def test_text_stream_in_complete_mode(spark, tmp_path):
    from encore.functions import parse

    (tmp_path / "in").mkdir()
    for i, text in enumerate(["a b a", "b c", "a"]):
        (tmp_path / "in" / f"{i}.txt").write_text(text + "\n")
    words = parse.words(files.stream_lines(spark, str(tmp_path / "in"), max_files=1))
    sinks.start_log(
        aggregates.word_count(words), str(tmp_path / "log"), str(tmp_path / "progress"), "complete"
    ).awaitTermination()
    got = sinks.newest(sinks.read_batches(spark, str(tmp_path / "log"), "value string, count bigint"), ["value"])
    assert rows(got) == [("a", 3), ("b", 2), ("c", 1)]


def test_sliding_windows_drop_late_rows(spark, tmp_path):
    schema = "id string, ts timestamp, v int"
    for i, second in enumerate([100, 200, 101]):  # the last one is far behind the watermark
        one = spark.range(1).selectExpr("'a' AS id", f"timestamp_seconds({second}) AS ts", "1 AS v")
        one.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stats = aggregates.sliding_stats(
            spark.readStream.schema(schema).parquet(str(tmp_path / "in")), "id", "ts", "v", watermark="3 seconds"
        )
        log = str(tmp_path / "log")
        sinks.start_log(stats, log, str(tmp_path / "progress"), "update").awaitTermination()
    read = sinks.read_batches(spark, log, stats.schema)
    got = sinks.newest(read, ["window_start", "id"])
    assert got.agg(F.sum("sum_value")).first()[0] == 6  # three windows hold second 100, three hold 200, none 101


def test_set_add_within_retention(spark, tmp_path):
    beats = heartbeats(spark).selectExpr("uid", "time_u - time_u % 3600 AS hour_u", "timestamp_seconds(time_u) AS at")
    source = in_files(beats, tmp_path / "in")
    new = jobs.new_rows(stream(spark, source), ["uid", "hour_u"], "at", "10 days").select("uid", "hour_u")
    sinks.start_log(new, str(tmp_path / "log"), str(tmp_path / "progress")).awaitTermination()
    got = sinks.read_batches(spark, str(tmp_path / "log"), new.schema).drop("batch_id")
    assert rows(got) == rows(beats.select("uid", "hour_u").distinct())


def test_lookup_is_read_again_in_every_batch(spark, tmp_path):
    lookup, versions = str(tmp_path / "lookup"), []

    def table():
        versions.append(len(versions))
        return spark.createDataFrame([("a", f"v{versions[-1]}")], "k string, label string")

    source = in_files(spark.createDataFrame([("a",)] * 3, "k string"), tmp_path / "in", 3)
    jobs.start_with_lookup(
        stream(spark, source), table, lambda batch, t: batch.join(t, "k"), lookup, str(tmp_path / "progress")
    ).awaitTermination()
    log = sinks.read_batches(spark, lookup, "k string, label string")
    assert log.select("label").distinct().count() == len(versions) > 1


def test_failed_batch_stops_the_query_and_is_redone(spark, tmp_path):
    source, tries = in_files(gifts(spark), tmp_path / "in", 1), []
    log, progress = str(tmp_path / "log"), str(tmp_path / "progress")

    def handle(batch, batch_id):
        tries.append(batch_id)
        if len(tries) == 1:
            raise RuntimeError("lost")
        sinks.write_batch(batch, log, batch_id)

    with pytest.raises(Exception, match="lost"):
        sinks.start(stream(spark, source), handle, progress).awaitTermination()
    sinks.start(stream(spark, source), handle, progress).awaitTermination()
    assert tries == [0, 0]
    assert spark.read.parquet(log).count() == 600


def test_progress_of_a_real_query(spark, tmp_path):
    source = in_files(gifts(spark), tmp_path / "in", 2)
    query = sinks.start_log(stream(spark, source), str(tmp_path / "log"), str(tmp_path / "progress"))
    query.awaitTermination()
    assert sum(p["numInputRows"] for p in query.recentProgress) == 600
    assert sinks.offset_ranges(query.lastProgress)



def test_raw_records_to_top_lists_popularity_and_tables(spark, tmp_path):
    """The jobs over records, in several batches, against the batch operators; bad records are kept apart."""
    from encore.functions import parse
    from encore.operators import asof, enrich, ranking

    running, good = config(spark, flag=1, u2q="true"), gifts(spark)
    data = F.to_json(F.struct("uid", F.col("qid").alias("anchor"), F.col("room_id").alias("roomid"), F.col("gift_id").alias("giftid"),
                              F.col("total").cast("string").alias("total"), "cate", F.col("time_u").cast("string").alias("time")))
    records = good.select(F.to_json(F.struct(data.alias("data"))).alias("value"))
    bad = spark.createDataFrame([("{x",), ('{"data":"{\\"uid\\":\\"u\\",\\"time\\":\\"NaN\\"}"}',)], "value string")
    source = in_files(records.unionAll(bad), tmp_path / "in", 3)
    pool = spark.createDataFrame([("p", "q1"), ("p", "hot")], "project string, qid string")
    log = str(tmp_path / "log")
    jobs.start_parsed(parse.parse_gift(stream(spark, source)), f"{log}-parsed", f"{log}-parsing").awaitTermination()
    told = parse.positive_gifts(jobs.good_records(spark, f"{log}-parsed", jobs.GIFT, max_files=1))
    jobs.start_boards(told, lambda: running, log, host_pool=lambda: pool).awaitTermination()
    scores = boards.board_scores(good, running)
    both = scores.unionByName(boards.signed_up_scores(good, running, pool))
    columns = [*boards.SCORES, "rank"]
    expected = ranking.top_k(both.where("role <> 'donor'"), boards.BOARD, 3)
    assert rows(jobs.read_top(spark, log, 3).select(columns)) == rows(expected.select(columns))
    assert rows(jobs.read_best_donors(spark, log, pool)) == rows(boards.top_donor(good, running, pool))
    assert jobs.bad_records(spark, f"{log}-parsed").count() == 2
    assert parse.good(parse.parse_gift(bad)).count() == 0

    changes = spark.createDataFrame(
        [(3, '{"data":"{\\"rid\\":\\"1\\",\\"nickname\\":\\"c\\"}"}'), (1, '{"data":"{\\"rid\\":\\"1\\",\\"nickname\\":\\"a\\"}"}'),
         (2, '{"data":"{\\"hostid\\":\\"1\\",\\"new_id\\":\\"7\\"}"}')], "at bigint, value string")
    source = in_files(changes, tmp_path / "changes", 3)
    jobs.start_profile_changes(stream(spark, source), "at", f"{log}-c", str(tmp_path / "progress-c")).awaitTermination()
    current = spark.createDataFrame([("1", "x", "y", "0")], "rid string, nick_name string, avatar string, room_id string")
    assert rows(jobs.read_profiles(spark, f"{log}-c", current)) == [("1", "c", "y", "7")]
    assert rows(enrich.merge_profile(current, current.withColumn("at", F.lit(1)), "at")) == rows(current)

    lines = spark.createDataFrame([("r\t\t\ta\t\t2024-01-01 00:00:01",), ("r\t\t\ta\t\t2024-01-01 00:00:09",), ("r\tx",)], "value string")
    source = in_files(lines, tmp_path / "switches", 2)
    jobs.start_switches(stream(spark, source), f"{log}-s", str(tmp_path / "progress-s")).awaitTermination()
    assert rows(asof.latest_switch(jobs.read_switches(spark, f"{log}-s"))) == [("r", "a", 1704067209)]


@pytest.mark.parametrize("fallback, slots", [("earliest", 3), ("null", 1)])
def test_asof_of_two_streams_in_any_order(spark, tmp_path, fallback, slots):
    """Switches behind and ahead of the beats that they count for, ties of a second, rooms without switches, several batches,
    a restart: the batch operator's rows, and nothing is told before its time is complete."""
    from encore.operators import asof
    from encore.streaming import ordered

    beats = spark.range(400).selectExpr("id", "concat('r', id % 4) AS room_id", f"{T0} + (id * 7919) % 5000 AS time_u", "IF(id % 7 = 0, NULL, 'x') AS note")
    turns = spark.range(60).selectExpr("concat('r', id % 3) AS room_id", "concat('c', id % 5) AS cate", f"{T0} + 300 + (id % 40) * 100 AS time_u")
    end = spark.createDataFrame([(None, "none", T0 + 100_000, None)], "id bigint, room_id string, time_u bigint, note string")
    place, found = str(tmp_path), None

    def run():
        joined = ordered.asof_stream(stream(spark, f"{place}/beats"), stream(spark, f"{place}/turns"), "10000 seconds", fallback, slots)
        sinks.start_files(joined, f"{place}/out", f"{place}/progress").awaitTermination()
        return spark.read.schema(joined.schema).parquet(f"{place}/out")

    in_files(beats.where("id % 2 = 0"), f"{place}/beats", 2)
    in_files(turns.where("time_u % 200 = 0"), f"{place}/turns", 2)
    assert run().count() == 0
    in_files(turns.where("time_u % 200 <> 0"), f"{place}/turns", 1)
    in_files(beats.where("id % 2 = 1"), f"{place}/beats", 1)
    assert run().count() == 0
    in_files(end, f"{place}/beats", 1)
    found = run()
    expected = asof.asof_category(beats, turns, history="full", fallback=fallback)
    assert sorted(map(repr, found.select(expected.columns).collect())) == sorted(map(repr, expected.collect()))


def test_asof_tells_as_the_watermark_goes(spark, tmp_path):
    """In the order of time each batch tells what the one before completed, and only valid switches are kept."""
    from encore.streaming import ordered

    place = str(tmp_path)
    for i in range(3):
        rows = spark.createDataFrame([(i * 10 + j, "r", T0 + i * 1000 + j) for j in (1, 5)], "id bigint, room_id string, time_u bigint")
        rows.coalesce(1).write.mode("append").parquet(f"{place}/beats")
        spark.createDataFrame([("r", f"c{i}", T0 + i * 1000 + 3)], "room_id string, cate string, time_u bigint").coalesce(1).write.mode("append").parquet(f"{place}/turns")
        joined = ordered.asof_stream(stream(spark, f"{place}/beats"), stream(spark, f"{place}/turns"), "0 seconds")
        sinks.start_files(joined, f"{place}/out", f"{place}/progress").awaitTermination()
    got = {r.id: r.cate for r in spark.read.schema(joined.schema).parquet(f"{place}/out").collect()}
    assert got == {1: "c0", 5: "c0", 11: "c0", 15: "c1", 21: "c1", 25: "c2"}
    kept = state.read_kept(spark, f"{place}/progress", f"room_id string, slot int, {ordered.STATE}").first()
    assert kept.times == [T0 + 2003] and kept.first == "c0" and kept.waiting == []


def test_outbox_sends_again_what_has_no_receipt(spark, tmp_path):
    """A sender that fails for good in one run and refuses some in the next; a message with a receipt is never sent again."""
    from encore.streaming import outbox

    path, log = str(tmp_path / "receipts"), tmp_path / "sent.txt"
    messages = spark.createDataFrame([(f"u{i}", i % 3, f"m{i}") for i in range(30)] * 2, "uid string, day int, value string")
    schema = "uid string, day int, receipt string, sent_u bigint, attempt bigint"

    def sender(how):
        where = str(log)

        def deliver(frame):
            if how == "broken":
                raise RuntimeError("no connection")
            taken = [how == "all" or int(u[1:]) % 4 != 0 for u in frame["uid"]]
            with open(where, "a") as out:
                out.writelines(f"{u}\n" for u, t in zip(frame["uid"], taken, strict=True) if t)
            return [f"ok-{v}" if t else None for v, t in zip(frame["value"], taken, strict=True)]

        return lambda: deliver

    with pytest.raises(Exception, match="no connection"):
        outbox.send(messages, ["uid", "day"], sender("broken"), path, 1)
    assert outbox.receipts(spark, path, schema).count() == 0
    assert outbox.send(messages, ["uid", "day"], sender("some"), path, 1).count() == 22
    assert outbox.pending(messages, ["uid", "day"], path).select("uid", "day").distinct().count() == 8
    assert outbox.send(messages, ["uid", "day"], sender("all"), path, 2).count() == 8
    assert outbox.send(messages, ["uid", "day"], sender("all"), path, 3).count() == 0
    told = outbox.receipts(spark, path, schema).collect()
    assert sorted((r.uid, r.receipt, r.attempt) for r in told) == sorted((f"u{i}", f"ok-m{i}", 2 if i % 4 == 0 else 1) for i in range(30))
    assert sorted(log.read_text().split()) == sorted(f"u{i}" for i in range(30))


def test_outbox_of_a_stream(spark, tmp_path):
    from encore.streaming import outbox

    place = str(tmp_path)
    source = in_files(spark.range(40).selectExpr("concat('u', id) AS uid", "concat('m', id) AS value"), f"{place}/in", 2)

    def sender():
        calls = []

        def deliver(frame):
            calls.append(1)
            return [None if u == "u7" else f"ok-{u}" for u in frame["uid"]]

        return deliver

    outbox.start_sending(stream(spark, source), ["uid"], sender, f"{place}/log", f"{place}/receipts", f"{place}/progress").awaitTermination()
    schema = "uid string, receipt string, sent_u bigint, attempt bigint"
    assert sorted(r.uid for r in outbox.receipts(spark, f"{place}/receipts", schema).collect()) == sorted(f"u{i}" for i in range(40) if i != 7)


def test_user_aggregates_in_sql_and_on_a_stream(spark, tmp_path):
    rows_ = spark.range(200).selectExpr("id % 7 AS k", "IF(id % 11 = 0, NULL, id) AS v")
    rows_.createOrReplaceTempView("numbers")
    aggregates.register_average(spark, "own_avg")
    text = "SELECT k, {}(v) AS a FROM (SELECT * FROM numbers UNION ALL SELECT -1, NULL) GROUP BY k"
    assert rows(spark.sql(text.format("own_avg"))) == rows(spark.sql(text.format("avg")))

    def reduce(frame):
        return {"total": float(frame["v"].sum()), "n": int(frame["v"].notna().sum())}

    def merge(buffers):
        return {"total": float(buffers["total"].sum()), "n": int(buffers["n"].sum())}

    source, progress = in_files(rows_, tmp_path / "in", 3), str(tmp_path / "progress")
    kept = aggregates.stream_user_aggregate(stream(spark, source), ["k"], ["v"], "total double, n bigint", reduce, merge)
    state.start_kept(kept, progress).awaitTermination()
    told = state.read_kept(spark, progress, "k bigint, total double, n bigint").selectExpr("k", "total / n AS a")
    assert rows(told) == rows(rows_.groupBy("k").agg(F.avg("v").alias("a")))


def test_a_batch_of_a_large_table_is_many_files(spark, monkeypatch, tmp_path):
    from encore.plans import queries

    monkeypatch.setattr(queries, "PART_ROWS", 10)
    stream = queries._dealt(spark, spark.range(95))
    seen = []
    running = sinks.start(stream, lambda df, i: seen.append((df.count(), df.select(F.input_file_name()).distinct().count())), str(tmp_path / "seen"))
    running.awaitTermination()
    assert len(seen) == 2 and sum(n for n, _ in seen) == 95
    assert [files for _, files in seen] == [5, 5]


def test_batches_stay_few_however_many_files_a_log_has(spark, tmp_path):
    from encore.plans import queries

    place = str(tmp_path / "log")
    for files_of in (37, 6):
        spark.range(100).repartition(files_of).write.mode("overwrite").parquet(place)
        stream = spark.readStream.schema("id bigint").option("maxFilesPerTrigger", queries._half(spark, place)).parquet(place)
        seen = []
        sinks.start(stream, lambda df, i: seen.append(df.count()), str(tmp_path / f"seen{files_of}")).awaitTermination()
        assert len(seen) == 2 and sum(seen) == 100


def gift_tables(spark, folder, lines=400):
    """Small tables that gifts are made of, over the years of the campaigns."""
    tables = {
        "lineitem": spark.range(lines).selectExpr(
            "id % 90 AS l_orderkey", "id % 11 AS l_partkey", "id % 9 AS l_suppkey", "id AS l_linenumber",
            "cast(id % 13 + 1 AS double) AS l_quantity", "timestamp_ntz '1997-01-01' + make_dt_interval(id * 7 % 1200) AS l_shipdate",
        ),
        "orders": spark.range(90).selectExpr("id AS o_orderkey", "id % 17 AS o_custkey"),
        "part": spark.range(11).selectExpr("id AS p_partkey", "concat('Brand#', id % 5) AS p_brand", "IF(id % 2 = 0, 'PROMO', 'SMALL') AS p_type"),
        "supplier": spark.range(9).selectExpr("id AS s_suppkey", "cast(id % 5 AS int) AS s_nationkey"),
    }
    for name, table in tables.items():
        table.coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_board_scores_are_restarted_after_the_first_batch(spark, monkeypatch, tmp_path):
    """Two runs of one query: the first ends after a batch, and what comes afterwards adds to the state that it left."""
    from encore.plans import fixtures as fx
    from encore.plans import queries

    sf, started, start = gift_tables(spark, tmp_path), [], jobs.start_boards
    monkeypatch.setattr(jobs, "start_boards", lambda *a, **b: started.append(start(*a, **b)) or started[-1])
    got = queries.stream_board_scores(spark, sf)
    assert [q.lastProgress["batchId"] for q in started] == [0, 1] and len({q.id for q in started}) == 1 < len({q.runId for q in started})
    assert all(q.lastProgress["numInputRows"] > 100 for q in started) and sum(q.lastProgress["numInputRows"] for q in started) == 400
    expected = boards.board_scores(
        fx.gifts(spark, sf), fx.gift_campaigns(spark), fx.host_group(spark, sf), periods=("all", "month"), roles=queries.RANKED
    )
    assert expected.count() > 100
    assert rows(got.select(*boards.SCORES)) == rows(expected.select(*boards.SCORES))


def test_boards_are_kept_in_narrow_rows_and_compressed_snapshots(spark, tmp_path):
    """A job that ends uploads sorted files, not its changes; one with an interval goes on from them, and by its changes."""
    running, source, progress = config(spark, flag=2, u2q="true"), in_files(gifts(spark), tmp_path / "in", 2), tmp_path / "progress"
    groups = spark.createDataFrame([("p", "q0", "a"), ("p", "q1", "b"), ("p", "q2", "a"), ("p", "q3", "")], "project string, qid string, grp string")
    coded = boards.coded_rows(gifts(spark), running, groups)
    assert coded.select("role").distinct().count() == 3 and coded.select("grp").distinct().count() == 3
    assert rows(boards.wide(boards.narrow(coded))) == rows(coded.select(*boards.CODES, "score"))
    jobs.start_boards(stream(spark, source), lambda: running, str(progress), host_group=lambda: groups).awaitTermination()
    stored = {p.suffix for p in (progress / "state" / "0").rglob("*") if p.is_file() and p.parent.name.isdigit()}
    assert ".zip" in stored and ".changelog" not in stored
    assert spark.conf.get("spark.sql.streaming.stateStore.rocksdb.compression") == "zstd"
    columns = spark.read.format("statestore").load(str(progress)).schema["key"].dataType.names
    assert columns == boards.NARROW
    in_files(gifts(spark), source, 1)
    query = jobs.start_boards(stream(spark, source), lambda: running, str(progress), host_group=lambda: groups, every="1 second")
    query.processAllAvailable()
    query.stop()
    assert [p for p in (progress / "state" / "0").rglob("*.changelog")]
    expected = boards.board_scores(gifts(spark).unionByName(gifts(spark)), running, groups)
    assert rows(jobs.read_boards(spark, str(progress)).select(*boards.SCORES)) == rows(expected)


def test_shuffle_files_of_a_stream_that_has_ended_go_when_released(spark, tmp_path):
    import time

    from encore import session

    def kept():
        return spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().size()

    def settled(most):
        for _ in range(40):
            if kept() <= most:
                break
            time.sleep(0.25)
        return kept()

    def run():
        jobs.start_boards(stream(spark, source), lambda: config(spark), str(tmp_path / "progress")).awaitTermination()
        return kept()

    source = in_files(gifts(spark), tmp_path / "in", 2)
    session.release(spark)
    settled(0)  # what other tests have left
    held = run()
    session.release(spark)
    assert settled(held - 1) < held


def test_changed_scores_are_summed_up_outside_the_heap(spark, tmp_path):
    """Whatever the session's own store is; the log holds every changed score."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before, source = spark.conf.get(name), in_files(gifts(spark), tmp_path / "in", 2)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider")
    try:
        jobs.start_changes(jobs.board_sums(stream(spark, source), config(spark)), f"{tmp_path}/log", f"{tmp_path}/progress").awaitTermination()
    finally:
        spark.conf.set(name, before)
    stored = {p.suffix for p in (tmp_path / "progress" / "state" / "0").rglob("*") if p.is_file()}
    assert ".zip" in stored and ".delta" not in stored
    log = sinks.newest(sinks.read_batches(spark, f"{tmp_path}/log", jobs.BOARD_LOG), boards.CODES)
    assert rows(boards.named(log).select(*boards.SCORES)) == rows(boards.board_scores(gifts(spark), config(spark)))


@pytest.mark.parametrize("k, at_most", [(1, 10), (3, 40), (5, 1000)])
def test_tasks_send_what_can_be_on_a_list(k, at_most):
    """Equal scores, members that come twice, nulls; boards with more members than fit are handed on."""
    import random

    import pyarrow as pa

    by, rng = ["code", "at"], random.Random(k)
    scores = [
        {"code": rng.randrange(3), "at": rng.choice(["", "a", None]), "member": rng.choice([None, *(f"m{i}" for i in range(25))]),
         "score": rng.choice([None, *range(1, 20)])}
        for _ in range(600)
    ]
    table = pa.Table.from_pylist(scores, pa.schema({"code": pa.int64(), "at": pa.string(), "member": pa.string(), "score": pa.int64()}))
    sent = [r for b in state._foremost_of_parts(by, k, at_most)(iter(table.to_batches(max_chunksize=7))) for r in b.to_pylist()]

    def lists(found):
        held: dict = {}
        for r in found:
            if r["member"] is not None and r["score"] is not None:
                board = held.setdefault((r["code"], r["at"]), {})
                board[r["member"]] = max(r["score"], board.get(r["member"], 0))
        return {b: sorted(((s, m) for m, s in board.items()), reverse=True)[:k] for b, board in held.items()}

    assert lists(sent) == lists(scores) and len(lists(sent)) == 9
    assert len(sent) < len(scores) - 100
    empty = [r for r in scores if r["member"] is None or r["score"] is None]
    assert sorted(map(repr, (r for r in sent if r["member"] is None or r["score"] is None))) == sorted(map(repr, empty))


def test_state_of_raw_records_grows_with_the_lines(spark, monkeypatch, tmp_path):
    from encore import session
    from encore.plans import queries

    sf = gift_tables(spark, tmp_path / "tables")
    monkeypatch.setattr(session, "STATE_ROWS", 50)
    monkeypatch.setattr(queries, "work_dir", lambda spark, purpose: str(tmp_path / purpose))
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    assert rows(queries.stream_raw_top(spark, sf)) == rows(queries.raw_gift_top(spark, sf))
    assert len([p for p in (tmp_path / "raw" / "boards" / "state" / "0").iterdir() if p.name.isdigit()]) == 8
    assert spark.conf.get("spark.sql.shuffle.partitions") == partitions
