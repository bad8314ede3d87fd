"""Campaign rules and boards against a direct computation."""

from __future__ import annotations

import datetime as dt
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from encore.operators import boards, campaigns, ranking

NOW = 1_540_000_000  # 2018-10-20 01:46:40 UTC, a Saturday
DAY = 86400
GIFTS = "uid string, qid string, room_id string, gift_id string, total int, cate string, time_u bigint"


def config(spark, *rows, kind="gift"):
    return campaigns.parse_campaigns(spark.createDataFrame(rows, "name string, config string"), kind)


def text(project="p", start=NOW, end=NOW + 30 * DAY, flag=0, **more):
    return project, ",".join(
        f"{k}={v}" for k, v in {"project": project, "startTimeU": start, "endTimeU": end, "flag": flag, **more}.items()
    )


def gifts(spark, *rows):
    """Rows of (uid, qid, gift, total, cate, time)."""
    return spark.createDataFrame([(u, q, f"r{q}", g, n, c, t) for u, q, g, n, c, t in rows], GIFTS)


def totals(df, *keys):
    return {tuple(r[k] for k in keys): r.score for r in df.collect()}


def test_config_gates(spark):
    rows = config(
        spark,
        text("ok", cates="a-b", giftIds="x-y", allRank="TRUE", dayAllRank="false", hourAllRank="true"),
        text("off", online="false"),
        ("noend", "project=noend,startTimeU=1540000000,flag=0"),
        ("twice", text("twice")[1] + ",flag=1"),
        ("loose", text("loose")[1] + ",cates"),
        ("nan", text("nan", flag="x")[1]),
        ("rate", text("rate", specificExtraRate="much")[1]),
        ("renamed", text("other", start="1540000000123", cates="", giftIds="")[1]),
    )
    got = {r.project: r for r in rows.collect()}
    assert set(got) == {"ok", "renamed"}
    assert (got["ok"].cates, got["ok"].gift_ids) == (["a", "b"], ["x", "y"])
    assert (got["ok"].board_mask, got["ok"].hour_all_rank) == (campaigns.board_bit("all", "all"), True)
    assert (got["renamed"].start_u, got["renamed"].cates, got["renamed"].gift_ids) == (1540000000, [], [])


def test_popularity_gates(spark):
    rows = config(
        spark,
        text("all", popularRank="true"),
        text("present", weekPopularRank="false"),
        text("none", allRank="true"),
        text("grouped", flag=2, popularRank="true"),
        kind="popularity",
    )
    assert sorted(r.project for r in rows.collect()) == ["all", "present"]


def test_match_bounds_and_categories(spark):
    running = config(spark, text("any", end=NOW + 100), text("only", cates="a-b", end=NOW + 400 * DAY))
    events = gifts(
        spark,
        ("u", "q", "g", 1, "a", NOW - 1), ("u", "q", "g", 1, "a", NOW), ("u", "q", "g", 1, "c", NOW + 100),
        ("u", "q", "g", 1, "b", NOW + 101), ("u", "q", "g", 1, "b", NOW + 400 * DAY),
    )
    hits = campaigns.match_campaigns(events, running).select("project", "time_u").collect()
    assert sorted((r.project, r.time_u - NOW) for r in hits) == [
        ("any", 0), ("any", 100), ("only", 0), ("only", 101), ("only", 400 * DAY)
    ]


def test_match_beyond_the_broadcast_bound(spark):
    rng = random.Random(1)
    running = config(spark, *[text(f"p{i}", start=NOW + i * DAY, end=NOW + (i * 7 % 90) * DAY) for i in range(40)])
    events = gifts(
        spark, *[("u", str(i % 9), "g", i, "c", NOW + rng.randrange(90 * DAY)) for i in range(500)]
    )
    small = campaigns.match_campaigns(events, running)
    large = campaigns.match_campaigns(events, running, max_broadcast_bytes=0)
    assert "SortMergeJoin" in large._jdf.queryExecution().executedPlan().toString()
    key = ["project", "total", "time_u"]
    assert sorted(map(tuple, small.select(key).collect())) == sorted(map(tuple, large.select(key).collect()))
    assert small.count() > 0


def test_no_campaign_matches_nothing(spark):
    assert boards.board_scores(gifts(spark, ("u", "q", "g", 1, "c", NOW)), config(spark, text("p"))).count() == 0


@pytest.mark.parametrize(
    "more, special, score",
    [
        ({"specificExtraAdd": "true", "specificExtraRate": "0.5", "giftIds": "g"}, True, 15.0),
        ({"specificExtraAdd": "true", "specificExtraRate": "-0.5", "giftIds": "g"}, True, 5.0),
        ({"specificExtraAdd": "true", "specificExtraRate": "1.0", "giftIds": "g"}, True, 10.0),
        ({"specificExtraAdd": "true", "specificExtraRate": "0.5", "giftIds": "h"}, False, 10.0),
        ({"specificExtraAdd": "true", "specificExtraRate": "0.5"}, False, 10.0),
        ({"specificExtraRate": "0.5", "giftIds": "g"}, True, 10.0),
    ],
)
def test_weights_and_special_boards(spark, more, special, score):
    running = config(spark, text(allRank="true", specificRank="true", **more))
    got = boards.board_scores(gifts(spark, ("u", "q", "g", 10, "c", NOW)), running, roles=("host",))
    expected = {("all",): score, **({("special",): score} if special else {})}
    assert totals(got, "gift_class") == expected


def test_hour_boards_are_never_made(spark):
    running = config(spark, text(hourAllRank="true", hourSpecificRank="true", giftIds="g"))
    assert boards.board_scores(gifts(spark, ("u", "q", "g", 1, "c", NOW)), running).count() == 0


def test_groups(spark):
    running = config(spark, text(flag=2, allRank="true", u2q="true"))
    groups = spark.createDataFrame([("p", "q1", "A"), ("p", "q2", ""), ("x", "q3", "A")], "project string, qid string, grp string")
    rows = gifts(spark, *[("u", q, "g", 1, "c", NOW) for q in ("q1", "q2", "q3")])
    got = boards.board_scores(rows, running, groups)
    assert sorted(totals(got, "scope", "grp", "role", "owner", "member")) == [
        ("all", "", "donor", "q1", "u"), ("all", "", "host", "", "q1"), ("all", "", "user", "", "u"),
        ("group", "A", "host", "", "q1"), ("group", "A", "user", "", "u"),
    ]
    assert boards.board_scores(rows, running).count() == 0


def test_most_rows_one_gift_can_make(spark):
    every = {key: "true" for key in campaigns.BOARD_KEYS.values()}
    running = config(spark, text(flag=2, u2q="true", giftIds="g", **every))
    groups = spark.createDataFrame([("p", "q", "A")], "project string, qid string, grp string")
    one = gifts(spark, ("u", "q", "g", 1, "c", NOW))
    assert boards.board_rows(one, running, groups).count() == 40
    assert boards.board_scores(one, running, groups).count() == 40


def test_week_of_two_years_stays_apart(spark):
    running = config(spark, text(start=1_546_300_800, end=1_600_000_000, weekAllRank="true"))  # from 2019-01-01
    first, second = 1_546_300_800, 1_546_300_800 + 364 * DAY  # 2019-W01 and 2020-W01 (2019-12-31)
    got = boards.board_scores(
        gifts(spark, ("u", "q", "g", 1, "c", first), ("u", "q", "g", 1, "c", second)), running, roles=("host",)
    )
    assert sorted(r.period_key for r in got.collect()) == ["2019-W01", "2020-W01"]


def test_calendar_zone(spark):
    running = config(spark, text(dayAllRank="true"))
    late = NOW - NOW % DAY + DAY + 17 * 3600  # 17:00 UTC is already tomorrow eight hours east
    row = gifts(spark, ("u", "q", "g", 1, "c", late))
    days = [
        boards.board_scores(row, running, roles=("host",), tz=tz).first().period_key for tz in ("UTC", "Asia/Shanghai")
    ]
    assert days == ["20181021", "20181022"]


def direct(rows, boards_on, special_gifts, rate, u2q):
    """The same boards by a plain loop."""
    out = defaultdict(float)
    for uid, qid, gift, total, _, time in rows:
        day = dt.datetime.fromtimestamp(time, dt.timezone.utc).date()
        iso = day.isocalendar()
        keys = {"all": "", "day": day.strftime("%Y%m%d"), "week": f"{iso[0]}-W{iso[1]:02d}", "month": day.strftime("%Y%m")}
        special = gift in special_gifts
        worth = total * (1 + rate) if special else total
        for period, gift_class in boards_on:
            if gift_class == "special" and not special:
                continue
            where = (period, keys[period], gift_class)
            out["host", "", *where, qid] += worth
            out["user", "", *where, uid] += worth
            if u2q:
                out["donor", qid, *where, uid] += worth
    return dict(out)


@pytest.mark.parametrize("seed", range(3))
def test_boards_match_a_direct_loop(spark, seed):
    rng = random.Random(seed)
    on = [key for key in campaigns.BOARD_KEYS if rng.random() < 0.6] or [("all", "all")]
    # A third of all gifts go to one host, from one user.
    rows = [
        ("hot" if i % 3 == 0 else str(rng.randrange(6)), "star" if i % 3 == 0 else str(rng.randrange(4)),
         rng.choice("ghk"), rng.randrange(1, 9), "c", NOW + rng.randrange(60 * DAY))
        for i in range(400)
    ]
    more = {campaigns.BOARD_KEYS[key]: "true" for key in on}
    running = config(
        spark,
        text(end=NOW + 90 * DAY, u2q="true", giftIds="g-h", specificExtraAdd="true", specificExtraRate="0.25", **more),
    )
    events = gifts(spark, *rows)
    keys = ("role", "owner", "period", "period_key", "gift_class", "member")
    expected = direct(rows, on, {"g", "h"}, 0.25, True)
    assert totals(boards.board_scores(events, running), *keys) == pytest.approx(expected)
    flat = boards.board_rows(events, running).groupBy(*keys).sum("score").withColumnRenamed("sum(score)", "score")
    assert totals(flat, *keys) == pytest.approx(expected)


SCORES = "project string, scope string, role string, member string, score double"


def test_leaderboard_order_breaks_ties_by_text_descending(spark):
    df = spark.createDataFrame([("p", "all", "host", m, s) for m, s in [("9", 5.0), ("10", 5.0), ("b", 7.0), ("a", 1.0)]], SCORES)
    top = ranking.top_k(df, ["project"], 3).collect()
    assert [(r["rank"], r.member) for r in sorted(top, key=lambda r: r["rank"])] == [(1, "b"), (2, "9"), (3, "10")]
    assert ranking.lowest(df, ["project"]).first().member == "a"
    two = df.unionAll(df.withColumn("project", F.lit("q")).where("member <> '9'"))
    listed = sorted((r.project, r.position, r.member) for r in ranking.board_listing(two.repartition(5), ["project"]).collect())
    assert listed == [("p", 1, "b"), ("p", 2, "9"), ("p", 3, "10"), ("p", 4, "a"), ("q", 1, "b"), ("q", 2, "10"), ("q", 3, "a")]


def test_top_list_has_101_rows_by_default(spark):
    df = spark.range(500).selectExpr("'p' AS project", "cast(id AS string) AS member", "cast(id AS double) AS score")
    assert ranking.top_k(df, ["project"]).count() == 101


def test_top_scores_equal_the_ranked_scores(spark):
    rng = random.Random(5)
    rows = [(str(rng.randrange(200)), str(rng.randrange(3)), "g", rng.randrange(1, 4), "c", NOW + rng.randrange(9 * DAY)) for _ in range(600)]
    running = config(spark, text(allRank="true", dayAllRank="true", u2q="true"))
    events = gifts(spark, *rows)
    one = boards.board_scores(events, running, top=5)
    two = ranking.top_k(boards.board_scores(events, running), boards.BOARD, 5)
    columns = [*boards.SCORES, "rank"]
    assert sorted(map(tuple, one.select(columns).collect())) == sorted(map(tuple, two.select(columns).collect()))


def test_sign_up_copies_and_top_donors(spark):
    running = config(spark, text("p", flag=1, allRank="true", u2q="true"), text("q", allRank="true", u2q="true"))
    rows = gifts(
        spark, ("1", "2", "g", 5, "c", NOW), ("3", "2", "g", 5, "c", NOW), ("3", "4", "g", 1, "c", NOW),
    )
    pool = spark.createDataFrame([("p", "2"), ("p", "3"), ("q", "4")], "project string, qid string")
    signed = boards.signed_up_scores(rows, running, pool)
    # The user 3 is in the host pool, so the user board is copied for them too.
    assert totals(signed, "project", "scope", "role", "member") == {
        ("p", "signUp", "host", "2"): 10.0, ("p", "signUp", "user", "3"): 6.0
    }
    later = boards.restrict_to_pool(boards.board_scores(rows, running), pool, running)
    assert sorted(map(tuple, later.select(boards.SCORES).collect())) == sorted(map(tuple, signed.select(boards.SCORES).collect()))
    best = boards.top_donor(rows, running, pool).collect()
    assert sorted((r.project, r.qid, r.uid, r.score) for r in best) == [("p", "2", "3", 5.0), ("q", "4", "3", 1.0)]


def test_top_n_per_key(spark):
    rows = [("a", 110), ("b", 122), ("c", 123), ("a", 210), ("b", 212), ("a", 310), ("b", 312), ("a", 410), ("b", 412)]
    top = ranking.top_n_per_key(spark.createDataFrame(rows, "key string, v int").repartition(5), "key", "v", 3)
    # Once before and once after the shuffle.
    assert top._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") == 2
    assert sorted((r.key, r.v) for r in top.collect()) == [
        ("a", 210), ("a", 310), ("a", 410), ("b", 212), ("b", 312), ("b", 412), ("c", 123)
    ]


def test_latest_room_and_touched(spark):
    rows = gifts(spark, ("u", "q", "g", 1, "c", 5), ("u", "q", "g", 1, "c", 9)).selectExpr(
        "qid", "concat(room_id, time_u) AS room_id", "time_u"
    )
    assert boards.latest_room(rows).first().room_id == "rq9"
    scores = spark.createDataFrame([("p", "all", "host", str(i), float(i)) for i in range(10)], SCORES)
    touched = spark.createDataFrame([("p", "9"), ("p", "1"), ("p", "77")], "project string, member string")
    assert [r.member for r in ranking.touched_of(ranking.top_k(scores, ["project"], 3), touched, ["project"]).collect()] == ["9"]


def test_restrictions_and_groups_lie_where_they_save_most(spark, sf):
    """Pool and campaign restrictions below the first sum; group names above it."""
    from encore.plans.queries import CATALOGUE

    def first_sum(name: str) -> tuple[str, str]:
        lines = CATALOGUE[name](spark, sf)._jdf.queryExecution().optimizedPlan().toString().split("\n")
        at = max(i for i, line in enumerate(lines) if "Aggregate [" in line and "sum(score" in line)
        return "\n".join(lines[:at]), "\n".join(lines[at:])

    for name in ("board_signup", "top_donor_map"):
        above, below = first_sum(name)
        assert "LeftSemi" in below and "LeftSemi" not in above
    above, below = first_sum("board_group")
    assert "LeftOuter" in above and "LeftOuter" not in below


def test_sums_do_not_depend_on_the_order(spark):
    running = config(spark, text(allRank="true", giftIds="g", specificExtraAdd="true", specificExtraRate=0.1))
    rows = [("u", "q", "g", 3, "c", NOW + i) for i in range(1000)]
    scores = {r.score for n in (1, 7) for r in boards.board_scores(gifts(spark, *rows).repartition(n), running).collect()}
    assert scores == {3300.0}


def _many(spark):
    run = config(spark, text("p", allRank="true", weekAllRank="true", u2q="true"), text("s", flag=1, allRank="true", dayAllRank="true"),
                 text("t", flag=2, giftIds="g1", specificRank="true", monthAllRank="true"))
    rows = [(f"u{i % 7}", f"h{i % 5}" if i % 3 else "u1", f"g{i % 2}", 1 + i % 9, "c", NOW + i * 7_000) for i in range(300)]
    groups = spark.createDataFrame([("t", "h1", "a"), ("t", "h2", "b"), ("t", "h3", "")], "project string, qid string, grp string")
    pool = spark.createDataFrame([("s", "h1"), ("s", "u1"), ("s", "u1"), ("p", "h2")], "project string, qid string")
    return gifts(spark, *rows), run, groups, pool


def test_copies_and_combined_sums_in_one_pass(spark):
    given, run, groups, pool = _many(spark)
    apart = boards.board_scores(given, run, groups).unionByName(boards.signed_up_scores(given, run, pool))
    rows = boards.board_rows(given, run, groups).groupBy(*boards.BOARD, "member").agg(F.sum("score").alias("score"))
    for combine in (False, True):
        scores = boards.board_scores(given, run, groups, combine=combine)
        assert scores.exceptAll(rows).isEmpty() and rows.exceptAll(scores).isEmpty()
        once = boards.board_scores(given, run, groups, host_pool=pool, combine=combine)
        assert once.exceptAll(apart).isEmpty() and apart.exceptAll(once).isEmpty()
        assert once.where("scope = 'signUp'").count() > 10


def test_board_sums_need_one_shuffle(spark):
    given, run, _, _ = _many(spark)
    plan = boards.board_scores(given, run)._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(exchanges) == 1 and "REPARTITION_BY_COL" in exchanges[0]


def test_sorts_of_boards_begin_with_a_number(spark):
    """Of scores with eight text columns, 8 bytes are compared first."""
    from encore.operators import ranking

    scores = spark.createDataFrame([("a", "x", "u", 1.0), ("a", "x", "v", 2.0), ("b", None, "u", 3.0)], "p string, g string, member string, score double")
    for got, expected in (
        (ranking.top_k(scores, ["p", "g"], 1), [("a", None, "v"), ("b", None, "u")]),
        (ranking.lowest(scores, ["p", "g"]), [("a", None, "u"), ("b", None, "u")]),
    ):
        assert "xxhash64(p" in got._jdf.queryExecution().optimizedPlan().toString()
        assert sorted((r.p, None, r.member) for r in got.collect()) == expected
        assert "_board" not in got.columns


def test_group_boards_take_gifts_of_grouped_campaigns_only(spark, monkeypatch):
    """Others would be summed up and dropped afterwards."""
    given, run, groups, _ = _many(spark)
    expected = boards.board_scores(given, run, groups).where("scope = 'group'")
    taken, weighted = [], boards._weighted
    monkeypatch.setattr(boards, "_weighted", lambda gifts, campaigns, *more: taken.append(campaigns) or weighted(gifts, campaigns, *more))
    scores = boards.board_scores(given, run, groups, scopes=("group",))
    assert [r.flag for r in taken[0].collect()] == [2]
    assert scores.count() > 10
    assert scores.exceptAll(expected).isEmpty() and expected.exceptAll(scores).isEmpty()
