"""Wire formats: sample payloads of each stream, and records that must not stop a batch."""

from __future__ import annotations

import json

import pytest

from encore.functions import labels, parse
from pyspark.sql import functions as F


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def envelope(data, **outer) -> str:
    text = data if isinstance(data, str) else json.dumps(data)
    return json.dumps({"name": "n", "data": text, "host": "h", "time": "2018-10-29 15:08:34", **outer})


GIFT = {
    "uid": "146", "anchor": "507", "roomid": "594", "giftid": "5aba", "price": "50", "count": "1", "total": "50",
    "time": 1540796914.9594, "cate": "dnf", "channel": "",
}


def test_gift(spark):
    rows = parse.good(parse.parse_gift(lines(spark, envelope(GIFT)))).collect()
    assert rows[0].asDict() == {
        "uid": "146", "qid": "507", "room_id": "594", "gift_id": "5aba", "total": 50, "cate": "dnf",
        "time_u": 1540796914,
    }


def test_gift_numbers_as_numbers(spark):
    row = parse.good(parse.parse_gift(lines(spark, envelope({**GIFT, "uid": 146, "total": 50, "time": "1540796914"})))).first()
    assert (row.uid, row.total, row.time_u) == ("146", 50, 1540796914)


@pytest.mark.parametrize(
    "line, error",
    [
        ("not json", "uid"),
        (None, "uid"),
        ('{"data": "{broken', "uid"),
        (envelope("{broken"), "uid"),
        (envelope({k: v for k, v in GIFT.items() if k != "cate"}), "cate"),
        (envelope({**GIFT, "total": "1.5"}), "total"),
        (envelope({**GIFT, "total": "abc"}), "total"),
        (envelope({**GIFT, "time": "soon"}), "time_u"),
    ],
)
def test_bad_gifts_are_quarantined(spark, line, error):
    parsed = parse.parse_gift(lines(spark, line, envelope(GIFT)))
    assert parse.good(parsed).count() == 1
    assert [tuple(r) for r in parse.quarantine(parsed).collect()] == [(line, error)]


def test_gift_needs_a_positive_total(spark):
    parsed = parse.parse_gift(lines(spark, *[envelope({**GIFT, "total": t}) for t in ("0", "-1", "2")]))
    assert [r.total for r in parse.positive_gifts(parse.good(parsed)).collect()] == [2]


def test_popularity(spark):
    data = {"classification": "star", "hostid": "82", "person_num": 184, "roomid": "42", "timestamp": 1542618451}
    good = envelope(data, time="2018-11-19 17:07:31")
    parsed = parse.parse_popularity(lines(spark, good, envelope(data, time="yesterday"), envelope({"hostid": "1"})))
    assert [tuple(r) for r in parse.good(parsed).collect()] == [
        ("82", "42", "star", 184, 1542618451, "2018-11-19 17:07:31")
    ]
    assert sorted(r.error for r in parse.quarantine(parsed).collect()) == ["room_id", "time"]


def test_profile_change_routes_by_id(spark):
    parsed = parse.parse_profile_change(
        lines(
            spark,
            envelope({"rid": 154, "nickname": "田果"}),
            envelope({"rid": 155, "avatar": "a.png", "hostid": "9"}),
            envelope({"hostid": "77", "new_id": "1001"}),
            envelope({"hostid": "78"}),
            envelope({"other": 1}),
        )
    )
    assert [tuple(r) for r in parse.good(parsed).collect()] == [
        ("profile", "154", "田果", None, None),
        ("profile", "155", None, "a.png", None),
        ("room", "77", None, None, "1001"),
    ]
    assert [r.error for r in parse.quarantine(parsed).collect()] == ["new_id", "rid"]


def beat(uid="7", page="x", stream="abc_hd", stamp="10/Oct/2018:13:55:36 +0800", head="") -> str:
    return (
        f'{head}1.2.3.4 - - [{stamp}] "GET /{page}.gif?uid={uid}&u=http%3A%2F%2Fh%2Flive_show%2F{stream}.flv&z=1 HTTP/1.1"'
    )


def test_heartbeat(spark):
    parsed = parse.parse_heartbeat(
        lines(spark, beat(), beat(page="client_punch", uid="077", stream="xyz"), beat(stream="a-b_c_d")),
        "live_show%2F",
    )
    at = 1539150936
    assert [tuple(r) for r in parse.good(parsed).collect()] == [
        ("7", "abc", "p", at), ("077", "xyz", "c", at), ("7", "a-b", "p", at)
    ]


@pytest.mark.parametrize(
    "line, error",
    [
        (beat(uid="0"), "uid"), (beat(uid="-5"), "uid"), (beat(uid="x"), "uid"), (beat(stamp="today"), "time_u"),
        (beat(stream="_hd"), "stream"), (beat().replace("live_show", "other"), "stream"), ("", "time_u"),
    ],
)
def test_bad_heartbeats(spark, line, error):
    parsed = parse.parse_heartbeat(lines(spark, line), "live_show%2F")
    assert parse.good(parsed).count() == 0
    assert parse.quarantine(parsed).first().error == error


def test_heartbeat_reads_its_own_u(spark):
    line = beat().replace("?uid", "?menu=1&uid")
    assert parse.good(parse.parse_heartbeat(lines(spark, line), "live_show%2F")).first().stream == "abc"


def test_switch(spark):
    full = "11\ta\tb\tmoba\tc\t2018-10-10 00:00:08\textra"
    parsed = parse.parse_switch(
        lines(spark, full, "11\ta\tb\tmoba\tc", "11\ta\tb\tmoba\tc\tnow"), tz="Asia/Shanghai"
    )
    assert [tuple(r) for r in parse.good(parsed).collect()] == [("11", "moba", 1539100808)]
    assert [r.error for r in parse.quarantine(parsed).collect()] == ["fields", "time_u"]


def test_clicks_readings_people(spark):
    click = parse.parse_clicks(lines(spark, '{"uid":"u1","event_time":"1","os_type":"x","click_count":3.9}', "{}"))
    assert [tuple(r) for r in parse.good(click).collect()] == [("u1", "1", "x", 3)]
    reading = parse.parse_reading(lines(spark, " a,2019-01-01 00:00:01,5 ", "a,b,c"))
    assert [(r.id, r.value, r.error) for r in reading.collect()] == [("a", 5, None), ("a", None, "timestamp")]
    people = parse.parse_people(lines(spark, "Justin, 19", "Ann", "Bob,x"))
    assert [tuple(r) for r in parse.good(people).collect()] == [("Justin", 19)]


def test_words_keep_inner_blanks_and_drop_trailing_ones(spark):
    out = [r.value for r in parse.words(lines(spark, "a  b ", "", "   ", " c")).collect()]
    assert out == ["a", "", "b", "", "", "c"]


def test_options():
    assert parse.options("name=uwd,cates=a-b,empty=") == {"name": "uwd", "cates": "a-b", "empty": ""}


def test_labels_and_keys(spark):
    columns = "project string, scope string, grp string, role string, owner string, period string, period_key string, gift_class string"
    df = spark.createDataFrame(
        [
            ("dance", "all", "", "host", "", "all", "", "all"),
            ("dance", "all", "", "user", "", "day", "20181010", "special"),
            ("dance", "group", "3", "host", "", "month", "201810", "all"),
            ("dance", "all", "", "donor", "77", "week", "2019-W05", "all"),
            ("dance", "signUp", "", "host", "", "week", "2019-W41", "all"),
        ],
        columns,
    )
    key = labels.board_key("live", labels.gift_board_label())
    assert [r.key for r in df.select(key.alias("key")).collect()] == [
        "live:dance:ancAlGf:rank",
        "live:dance:usrDySpecGf20181010:rank",
        "live:dance:ancGrp3MthAlGf201810:rank",
        "live:dance:u2q77_WkAlGf5:rank",
        "live:dance:signUp:ancWkAlGf41:rank",
    ]
    donors = df.where("role = 'donor'").select(labels.board_key("live", labels.top_donor_label(), "map").alias("key"))
    assert donors.first().key == "live:dance:u2qWkAlGf5:map"
    parts = df.select(labels.split_board_key(key).alias("k")).select("k.*").collect()
    assert tuple(parts[4]) == ("live", "dance", "signUp", "ancWkAlGf41", "rank")
    assert spark.range(1).select(labels.split_board_key(F.lit("a:b")).alias("k")).first().k is None
