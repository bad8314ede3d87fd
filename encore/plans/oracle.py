"""Independent SQL for the catalogue, in DuckDB's dialect, over the same tables.

Written from the definitions of the operators, not from the Spark plans: no shared
pre-aggregation, buckets or words.
"""

from __future__ import annotations

from encore.plans.fixtures import utc

CAMPAIGNS = [
    # project, start, end, categories, gifts, flag, extra rate (null: off), donors, levels, boards
    ("opening", utc(1996, 1, 1), utc(1999, 12, 31, 23, 59, 59), [], [], 0, None, False, False,
     ["all-all", "day-all", "week-all", "month-all"]),
    ("dance", utc(1997, 1, 1), utc(1998, 12, 31), ["PROMO", "SMALL"], [], 0, None, False, False,
     ["all-all", "month-all"]),
    ("bonus", utc(1998, 6, 1), utc(2000, 6, 30), [], ["Brand#1", "Brand#2", "Brand#13"], 0, 0.1, True, False,
     ["all-all", "all-special", "day-special", "week-special", "month-special"]),
    ("signup", utc(1995, 6, 1), utc(2001, 6, 30), [], [], 1, None, True, True,
     ["all-all", "week-all", "month-all"]),
    ("teams", utc(1996, 3, 1), utc(2000, 2, 29), [], ["Brand#3", "Brand#4"], 2, None, False, False,
     ["all-all", "all-special", "month-all"]),
]
STARS = [
    ("stars", utc(2024, 1, 5), utc(2024, 1, 28, 12), [], 0, ["all", "week", "month"]),
    ("stars_signup", utc(2024, 1, 3), utc(2024, 1, 25), ["click", "view", "purchase"], 1, ["all", "week"]),
]


def _sql(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).upper()
    if isinstance(value, list):
        return "[" + ", ".join(map(_sql, value)) + "]::VARCHAR[]"
    return f"'{value}'" if isinstance(value, str) else str(value)


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(map(_sql, row)) + ")" for row in rows)


PERIOD_KEY = """CASE b.period WHEN 'day' THEN strftime({d}, '%Y%m%d') WHEN 'week' THEN strftime({d}, '%G-W%V')
    WHEN 'month' THEN strftime({d}, '%Y%m') ELSE '' END"""

GIFT = f"""
gift AS (
  SELECT o_custkey::VARCHAR AS uid, l_suppkey::VARCHAR AS qid, p_brand AS gift_id, l_quantity::INT AS total,
         p_type AS cate, epoch_us(l_shipdate) // 1000000 AS time_u, l_shipdate::DATE AS d
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey),
camp(project, start_u, end_u, cates, gifts, flag, rate, u2q, lvl, boards) AS (VALUES {_values(CAMPAIGNS)}),
host_pool AS (SELECT project, s_suppkey::VARCHAR AS qid FROM supplier, camp WHERE s_suppkey % 3 = 0),
host_group AS (
  SELECT 'teams' AS project, s_suppkey::VARCHAR AS qid, (s_nationkey % 4)::VARCHAR AS grp
  FROM supplier WHERE s_suppkey % 7 <> 0),
won AS (
  SELECT c.project, c.u2q, c.boards, g.uid, g.qid, g.d, list_contains(c.gifts, g.gift_id) AS special,
         coalesce(h.grp, '') AS hg,
         g.total * CASE WHEN c.rate IS NOT NULL AND list_contains(c.gifts, g.gift_id) THEN 1 + c.rate ELSE 1 END AS w
  FROM gift g JOIN camp c ON g.time_u BETWEEN c.start_u AND c.end_u
       AND (len(c.cates) = 0 OR list_contains(c.cates, g.cate))
  LEFT JOIN host_group h ON h.project = c.project AND h.qid = g.qid
  WHERE g.total > 0 AND (c.flag <> 2 OR h.grp IS NOT NULL)),
board(period, gift_class) AS (VALUES ('all','all'), ('all','special'), ('day','all'), ('day','special'),
  ('week','all'), ('week','special'), ('month','all'), ('month','special')),
placed AS (
  SELECT w.project, w.hg, w.u2q, w.uid, w.qid, w.w, b.period, b.gift_class,
         {PERIOD_KEY.format(d="w.d")} AS period_key
  FROM won w JOIN board b ON list_contains(w.boards, b.period || '-' || b.gift_class)
       AND (b.gift_class = 'all' OR w.special)),
entry AS (
  SELECT project, 'all' AS scope, '' AS grp, 'host' AS role, '' AS owner, period, period_key, gift_class,
         qid AS member, w FROM placed
  UNION ALL SELECT project, 'all', '', 'user', '', period, period_key, gift_class, uid, w FROM placed
  UNION ALL SELECT project, 'all', '', 'donor', qid, period, period_key, gift_class, uid, w FROM placed WHERE u2q
  UNION ALL SELECT project, 'group', hg, 'host', '', period, period_key, gift_class, qid, w FROM placed WHERE hg <> ''
  UNION ALL SELECT project, 'group', hg, 'user', '', period, period_key, gift_class, uid, w FROM placed WHERE hg <> ''),
scores AS (
  SELECT project, scope, grp, role, owner, period, period_key, gift_class, member, sum(w)::DOUBLE AS score
  FROM entry GROUP BY ALL)"""

BOARD = "project, scope, grp, role, owner, period, period_key, gift_class"
TOP = f"""
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY {BOARD} ORDER BY score DESC, member DESC)::INT AS rank FROM scores)"""
CAMPAIGN_BOARDS = "period = 'all' AND gift_class = 'all' AND role <> 'donor' AND scope = 'all'"

POP = f"""
camp(project, start_u, end_u, cates, flag, periods) AS (VALUES {_values(STARS)}),
peak AS (
  SELECT c.project, c.periods, user_id::VARCHAR AS host_id, ts::DATE AS day, max(floor(value))::INT AS peak
  FROM events e JOIN camp c ON epoch_us(ts) // 1000000 BETWEEN c.start_u AND c.end_u
       AND (len(c.cates) = 0 OR list_contains(c.cates, event_type))
  GROUP BY ALL),
b(period) AS (VALUES ('all'), ('week'), ('month')),
scores AS (
  SELECT project, 'all' AS scope, b.period, {PERIOD_KEY.format(d="day")} AS period_key, host_id AS member,
         (sum(peak) // count(*))::BIGINT AS score
  FROM peak JOIN b ON list_contains(periods, b.period) WHERE peak <> 0 GROUP BY ALL HAVING sum(peak) > 0)"""

WATCH = """
sw_full AS (
  SELECT ((props->>'k')::INT % 40)::VARCHAR AS room_id, 'cat' || (floor(value)::INT % 5) AS cate,
         epoch_us(ts) // 1000000 AS time_u
  FROM events WHERE event_type = 'error' AND (props->>'k')::INT % 40 < 38),
sw AS (SELECT room_id, cate, max(time_u) AS time_u FROM sw_full GROUP BY ALL),
beat AS (
  SELECT event_id, user_id::VARCHAR AS uid, ((props->>'k')::INT % 40)::VARCHAR AS room_id,
         event_type IN ('purchase', 'signup') AS client, epoch_us(ts) // 1000000 AS time_u
  FROM events WHERE (props->>'k')::INT % 10 <> 9),
earliest AS (SELECT room_id, arg_min(cate, (time_u, cate)) AS cate FROM sw GROUP BY ALL),
past AS (
  SELECT event_id, arg_max(s.cate, (s.time_u, s.cate)) AS cate
  FROM beat b JOIN sw s ON s.room_id = b.room_id AND s.time_u <= b.time_u GROUP BY ALL),
placed AS (
  SELECT b.*, coalesce(p.cate, f.cate) AS cate
  FROM beat b JOIN earliest f USING (room_id) LEFT JOIN past p USING (event_id)),
minute AS (
  SELECT DISTINCT uid, unnest(CASE WHEN client THEN [time_u // 60 * 60 - 60, time_u // 60 * 60]
                              ELSE [time_u // 60 * 60] END) AS minute_u
  FROM placed WHERE cate IN ('cat0', 'cat1', 'cat2')),
watched AS (SELECT uid, strftime(make_timestamp(minute_u * 1000000), '%Y%m%d') AS day, minute_u FROM minute),
per_day AS (SELECT uid, day, count(*) AS minutes FROM watched GROUP BY ALL),
signed AS (SELECT uid, day FROM per_day WHERE minutes >= 3)"""

ORDER_IDS = """
ids AS (SELECT DISTINCT o_custkey::VARCHAR AS rid FROM orders),
members AS (SELECT DISTINCT user_id::VARCHAR AS rid FROM events),
profile AS (SELECT c_custkey::VARCHAR AS rid, c_name AS nick_name, c_mktsegment AS avatar
            FROM customer WHERE c_custkey % 5 <> 0),
cached AS (SELECT * FROM profile WHERE rid::BIGINT % 2 = 0),
missing AS (SELECT rid FROM ids ANTI JOIN cached USING (rid))"""

TWO_TABLES = """
kept AS (SELECT c_custkey AS rid, c_mktsegment AS label FROM customer WHERE c_custkey % 3 = 0),
put AS (SELECT o_custkey AS rid, o_orderpriority AS label FROM orders)"""

PEOPLE = "people AS (SELECT c_name AS name, c_custkey % 60 AS age FROM customer)"

WINDOWS = """
SELECT s * 3000000 AS window_start, s * 3000000 + 10000000 AS window_end, event_type AS id,
       min(epoch_us(ts)) AS min_timestamp, max(epoch_us(ts)) AS max_timestamp,
       sum(floor(value)::INT)::BIGINT AS sum_value
FROM (SELECT *, unnest(generate_series((epoch_us(ts) - 10000000) // 3000000 + 1, epoch_us(ts) // 3000000)) AS s
      FROM events)
GROUP BY s, event_type"""

SIMILAR_LINES = """
SELECT l_orderkey, l_linenumber, (l_partkey * 2)::VARCHAR AS aid,
       CASE WHEN p_partkey IS NULL THEN ''
            ELSE (p_partkey + 1) || '|' || (p_partkey * 2) || '|' || p_size END AS similar
FROM lineitem LEFT JOIN part ON p_partkey = l_partkey * 2"""


def _words(table: str) -> str:
    return f"""
line AS (SELECT unnest(string_split(text, chr(10))) AS line FROM {table}),
word AS (SELECT unnest(CASE WHEN line <> '' AND rtrim(line, ' ') = '' THEN []::VARCHAR[]
                            ELSE string_split(rtrim(line, ' '), ' ') END) AS value FROM line)"""


def _gift(select: str, more: str = "") -> str:
    return f"WITH {GIFT}{',' + more if more else ''} {select}"


def _labels() -> str:
    suffix = "CASE period WHEN 'week' THEN (regexp_extract(period_key, 'W(\\d+)', 1)::INT)::VARCHAR ELSE period_key END"
    family = f"""CASE period WHEN 'day' THEN 'Dy' WHEN 'week' THEN 'Wk' WHEN 'month' THEN 'Mth' ELSE '' END
        || CASE gift_class WHEN 'all' THEN 'AlGf' ELSE 'SpecGf' END || {suffix}"""
    label = f"""CASE role WHEN 'donor' THEN 'u2q' || owner || '_' WHEN 'host' THEN 'anc' ELSE 'usr' END
        || CASE scope WHEN 'group' THEN 'Grp' || grp ELSE '' END || {family}"""
    return f"""SELECT 'live:' || project || ':' || label || ':rank' AS key, project, label,
        count(*) AS members, sum(score)::DOUBLE AS score
        FROM (SELECT project, {label} AS label, score FROM scores) GROUP BY ALL"""


ORACLE: dict[str, str] = {
    "board_all": _gift(f"SELECT * FROM scores WHERE {CAMPAIGN_BOARDS}"),
    **{
        f"board_{p}": _gift(
            f"SELECT * FROM scores WHERE period = '{p}' AND gift_class = 'all' AND role <> 'donor' AND scope = 'all'"
        )
        for p in ("day", "week", "month")
    },
    "board_special": _gift("SELECT * FROM scores WHERE gift_class = 'special' AND role <> 'donor' AND scope = 'all'"),
    "board_group": _gift("SELECT * FROM scores WHERE scope = 'group'"),
    "board_donor": _gift("SELECT * FROM scores WHERE role = 'donor'"),
    "board_every": _gift(
        """SELECT project, scope, grp, role, period, period_key, gift_class, count(*) AS members,
        sum(score)::DOUBLE AS score FROM scores GROUP BY ALL"""
    ),
    "board_fanout": _gift(
        """SELECT project, scope, role, period, gift_class, count(*) AS rows, sum(w)::DOUBLE AS score
        FROM entry GROUP BY ALL"""
    ),
    "board_signup": _gift(
        """SELECT * REPLACE ('signUp' AS scope) FROM scores s
        WHERE project = 'signup' AND gift_class = 'all' AND role <> 'donor' AND scope = 'all'
          AND EXISTS (SELECT 1 FROM host_pool p WHERE p.project = s.project AND p.qid = s.member)"""
    ),
    "top_donor_map": _gift(
        """SELECT project, period, period_key, gift_class, owner AS qid, member AS uid, score FROM ranked r
        WHERE role = 'donor' AND rank = 1
          AND EXISTS (SELECT 1 FROM host_pool p WHERE p.project = r.project AND p.qid = r.owner)""",
        TOP,
    ),
    "top_donor_with_level": _gift(
        """SELECT project, period, period_key, gift_class, owner AS qid, member AS uid, score,
          coalesce(floor(greatest(c_acctbal, 0) / 1000)::INT, -1) AS level
        FROM ranked r LEFT JOIN customer ON c_custkey::VARCHAR = member
        WHERE role = 'donor' AND rank = 1
          AND EXISTS (SELECT 1 FROM host_pool p WHERE p.project = r.project AND p.qid = r.owner)""",
        TOP,
    ),
    "board_topk": _gift("SELECT * FROM ranked WHERE rank <= 101 AND role <> 'donor'", TOP),
    "board_lowest": _gift(
        f"""SELECT * FROM scores WHERE role <> 'donor'
        QUALIFY row_number() OVER (PARTITION BY {BOARD} ORDER BY score, member) = 1"""
    ),
    "board_listing": _gift(f"""SELECT project, row_number() OVER (PARTITION BY project ORDER BY score DESC, member DESC) AS position, member, score
        FROM scores WHERE {CAMPAIGN_BOARDS} AND role = 'host'"""),
    "board_labels": _gift(_labels()),
    "room_latest": """
        SELECT user_id::VARCHAR AS host_id, arg_max(event_type, (epoch_us(ts) // 1000000, event_type)) AS room_id
        FROM events GROUP BY ALL""",
    "touched_in_top": _gift(
        f"""SELECT * FROM ranked WHERE rank <= 101 AND {CAMPAIGN_BOARDS} AND project = 'signup' AND member IN (
          SELECT CASE ranked.role WHEN 'host' THEN qid ELSE uid END FROM gift
          WHERE time_u > {utc(2001, 6, 30) - 30 * 86400} AND time_u <= {utc(2001, 6, 30)})""",
        TOP,
    ),
    "board_with_profile": _gift(
        f"""SELECT project, role, member, score, rank, c_name AS nick_name, c_mktsegment AS avatar
        FROM ranked LEFT JOIN customer ON c_custkey::VARCHAR = member AND c_custkey % 5 <> 0
        WHERE rank <= 101 AND {CAMPAIGN_BOARDS}""",
        TOP,
    ),
    "board_with_level": _gift(
        f"""SELECT project, role, member, score, rank,
          CASE WHEN project = 'signup' AND role = 'user' THEN floor(greatest(c_acctbal, 0) / 1000)::INT ELSE -1 END AS level
        FROM ranked LEFT JOIN customer ON c_custkey::VARCHAR = member WHERE rank <= 101 AND {CAMPAIGN_BOARDS}""",
        TOP,
    ),
    "board_with_dimensions": _gift(
        f"""SELECT project, member, score, CASE WHEN c_custkey % 5 <> 0 THEN c_name END AS nick_name,
          CASE WHEN c_custkey % 5 <> 0 THEN c_mktsegment END AS avatar,
          coalesce(floor(greatest(c_acctbal, 0) / 1000)::INT, -1) AS level
        FROM scores LEFT JOIN customer ON c_custkey::VARCHAR = member WHERE {CAMPAIGN_BOARDS} AND role = 'user'"""
    ),
    "profile_enrich_missing": f"""WITH {ORDER_IDS}
        SELECT p.*, '{{"rid":"' || rid || '","nickName":"' || nick_name || '","avatar":"' || avatar || '","roomId":""}}'
          AS value
        FROM profile p SEMI JOIN missing USING (rid)""",
    "id_difference": f"WITH {ORDER_IDS} SELECT rid FROM missing",
    "id_union_distinct": f"WITH {ORDER_IDS} SELECT rid FROM ids UNION SELECT rid FROM members",
    "id_intersection": f"WITH {ORDER_IDS} SELECT rid FROM ids INTERSECT SELECT rid FROM members",
    "profile_change_parse": """
        SELECT CASE WHEN shift = 2 THEN 'room' ELSE 'profile' END AS kind, c_custkey::VARCHAR AS rid,
          nick || c_custkey AS nickname, pic || c_custkey AS avatar, (c_custkey * 10 + room)::VARCHAR AS room_id, seen AS "at"
        FROM customer JOIN (VALUES (0, 'm', NULL, NULL, 5), (0, 'n', NULL, NULL, 3), (0, NULL, 'x', NULL, 4),
            (1, NULL, 'a', NULL, 2), (1, NULL, 'b', NULL, 1), (2, NULL, NULL, 0, 1), (2, NULL, NULL, 1, 7))
          AS t(shift, nick, pic, room, seen) ON c_custkey % 6 = shift""",
    "profile_merge": """
        SELECT c_custkey::VARCHAR AS rid,
          CASE WHEN c_custkey % 6 = 0 THEN 'm' || c_custkey ELSE c_name END AS nick_name,
          CASE c_custkey % 6 WHEN 0 THEN 'x' || c_custkey WHEN 1 THEN 'a' || c_custkey ELSE c_mktsegment END AS avatar,
          CASE WHEN c_custkey % 6 = 2 THEN (c_custkey * 10 + 1)::VARCHAR ELSE 'none' END AS room_id
        FROM customer WHERE c_custkey % 5 <> 0""",
    "put_if_absent": f"""WITH {TWO_TABLES}
        SELECT * FROM kept UNION ALL
        SELECT rid, min(label) FROM put WHERE rid NOT IN (SELECT rid FROM kept) GROUP BY rid""",
    "put_replace": f"""WITH {TWO_TABLES}
        SELECT rid, max(label) AS label FROM put GROUP BY rid UNION ALL
        SELECT * FROM kept WHERE rid NOT IN (SELECT rid FROM put)""",
    "store_profiles": """
        SELECT c_custkey::VARCHAR AS rid, CASE WHEN c_custkey % 3 = 0 THEN 'old' ELSE c_name END AS nick_name,
          CASE WHEN c_custkey % 3 <> 0 AND c_custkey % 10 = 0 THEN 'room' || c_custkey ELSE '' END AS room_id
        FROM customer WHERE c_custkey % 3 = 0 OR c_custkey % 10 = 0 OR c_custkey IN (SELECT o_custkey FROM orders)""",
    "set_add_new": f"WITH {TWO_TABLES} SELECT DISTINCT rid FROM put WHERE rid NOT IN (SELECT rid FROM kept)",
    "pop_day_peak": f"""WITH {POP} SELECT project, host_id, strftime(day, '%Y%m%d') AS day, peak FROM peak""",
    **{f"pop_avg_{p}": f"WITH {POP} SELECT * FROM scores WHERE period = '{p}'" for p in ("all", "week", "month")},
    "pop_signup": f"""WITH {POP} SELECT * REPLACE ('signUp' AS scope) FROM scores
        WHERE project = 'stars_signup' AND member::BIGINT % 3 = 0
          AND member IN (SELECT c_custkey::VARCHAR FROM customer)""",
    "pop_topk": f"""WITH {POP}, ranked AS (
          SELECT *, row_number() OVER (PARTITION BY project, period, period_key
                                       ORDER BY score DESC, member DESC)::INT AS rank FROM scores)
        SELECT *, 'live:' || project || ':anc' || CASE period WHEN 'week' THEN
            'WkPop' || regexp_extract(period_key, 'W(\\d+)', 1)::INT
            WHEN 'month' THEN 'MthPop' || period_key ELSE 'Pop' END || ':rank' AS key
        FROM ranked WHERE rank <= 101""",
    "category_latest": f"WITH {WATCH} SELECT room_id, cate, time_u FROM sw",
    "category_full_history": f"""WITH {WATCH}, single AS (
          SELECT room_id, time_u, max(cate) AS cate FROM sw_full GROUP BY ALL)
        SELECT room_id, cate, time_u, lead(time_u, 1, 9999999999) OVER (PARTITION BY room_id ORDER BY time_u) AS until_u FROM single""",
    "asof_category": f"WITH {WATCH} SELECT event_id, room_id, cate FROM placed",
    "asof_category_full": f"""WITH {WATCH}, single AS (
          SELECT room_id, time_u, max(cate) AS cate FROM sw_full GROUP BY ALL)
        SELECT event_id, b.room_id, s.cate
        FROM (SELECT * FROM beat WHERE room_id IN (SELECT room_id FROM sw_full)) b
        ASOF LEFT JOIN single s ON s.room_id = b.room_id AND b.time_u >= s.time_u""",
    "watch_minutes": f"WITH {WATCH} SELECT * FROM watched",
    "watch_minutes_per_day": f"WITH {WATCH} SELECT * FROM per_day",
    "watch_minutes_approx": f"WITH {WATCH} SELECT uid, day, minutes, TRUE AS within FROM per_day",
    "signin_campaigns": f"""WITH {WATCH},
        c(project, start_u, end_u, cates) AS (VALUES
          ('night', {utc(2024, 1, 3, 18)}, {utc(2024, 1, 20, 6, 30)}, ['cat0', 'cat1', 'cat2']),
          ('day', {utc(2024, 1, 10)}, {utc(2024, 1, 25, 12)}, ['cat3', 'cat2'])),
        m AS (SELECT DISTINCT project, uid, unnest(CASE WHEN client THEN [time_u // 60 * 60 - 60, time_u // 60 * 60]
                ELSE [time_u // 60 * 60] END) AS minute_u
              FROM placed p JOIN c ON p.time_u BETWEEN c.start_u AND c.end_u AND list_contains(c.cates, p.cate)),
        d AS (SELECT project, uid, strftime(make_timestamp(minute_u * 1000000), '%Y%m%d') AS day, count(*) AS minutes
              FROM m GROUP BY ALL HAVING count(*) >= 2)
        SELECT project, uid, day, minutes, count(*) OVER (PARTITION BY project, uid ORDER BY day) AS days FROM d""",
    "signin_days": f"WITH {WATCH} SELECT * FROM signed",
    "signin_events": f"""WITH {WATCH}, n AS (
          SELECT uid, day, count(*) OVER (PARTITION BY uid ORDER BY day) AS days FROM signed)
        SELECT *, '{{"uid":"' || uid || '","days":' || days || '}}' AS value FROM n""",
    "signin_fifth_day": f"""WITH {WATCH}
        SELECT uid, day FROM signed QUALIFY row_number() OVER (PARTITION BY uid ORDER BY day) = 5""",
    "raw_gift_top": _gift(
        """SELECT project, scope, role, period, period_key, member, score, rank FROM (
          SELECT *, row_number() OVER (PARTITION BY project, scope, role, period, period_key ORDER BY score DESC, member DESC)::INT AS rank
          FROM (SELECT project, scope, role, period, period_key, member, score FROM scores
                WHERE gift_class = 'all' AND scope = 'all' AND role <> 'donor'
                UNION ALL SELECT project, 'signUp', role, period, period_key, member, score FROM scores s
                WHERE project = 'signup' AND gift_class = 'all' AND scope = 'all' AND role <> 'donor'
                  AND EXISTS (SELECT 1 FROM host_pool p WHERE p.project = s.project AND p.qid = s.member)))
        WHERE rank <= 101"""
    ),
    "envelope_parse": """
        SELECT l_orderkey::VARCHAR AS uid, l_suppkey::VARCHAR AS qid, l_suppkey::VARCHAR AS room_id,
          'g' || (l_partkey % 25) AS gift_id, l_quantity::INT AS total, 'c' || (l_partkey % 6) AS cate,
          epoch_us(l_shipdate) // 1000000 AS time_u
        FROM lineitem WHERE l_orderkey % 50 > 7""",
    "envelope_quarantine": """
        SELECT CASE l_orderkey % 50 WHEN 0 THEN 'uid' WHEN 2 THEN 'cate' WHEN 5 THEN 'time_u' WHEN 6 THEN 'time_u' ELSE 'total' END
          AS error, count(*) AS records
        FROM lineitem WHERE l_orderkey % 50 IN (0, 1, 2, 4, 5, 6, 7) GROUP BY ALL""",
    "popularity_parse": """
        SELECT user_id::VARCHAR AS host_id, (user_id * 7)::VARCHAR AS room_id, event_type AS cate,
          floor(value)::INT AS num, epoch_us(ts) // 1000000 AS time_u, strftime(ts, '%Y-%m-%d %H:%M:%S') AS time
        FROM events WHERE event_id % 20 > 2""",
    "log_parse": """
        SELECT user_id::VARCHAR AS uid, props->>'k' AS stream, CASE event_type WHEN 'click' THEN 'c' ELSE 'p' END AS flag,
          epoch_us(ts) // 1000000 - 28800 AS time_u
        FROM events WHERE event_id % 10 > 2 AND user_id > 0""",
    "tsv_parse": """
        SELECT user_id::VARCHAR AS room_id, event_type AS cate, epoch_us(ts) // 1000000 AS time_u
        FROM events WHERE event_id % 11 <> 0 AND event_id % 7 <> 0""",
    "reading_parse": """
        SELECT event_type AS id, strftime(ts, '%Y%m%d%H%M%S') AS stamp, floor(value)::INT AS value
        FROM events WHERE event_id % 9 <> 0""",
    "click_parse": """
        SELECT user_id::VARCHAR AS uid, (epoch_us(ts) // 1000000)::VARCHAR AS event_time, event_type AS os_type,
          trunc(value)::INT AS click_count
        FROM events WHERE event_id % 8 > 2""",
    "people_parse": "SELECT c_name AS name, c_custkey % 90 AS age FROM customer WHERE c_custkey % 13 <> 0",
    "config_parse": """
        SELECT 'name' || s_suppkey AS project, s_suppkey + 1500000000 AS start_u, s_suppkey + 1600000000 AS end_u,
          2 AS n_cates, CASE WHEN s_suppkey % 8 = 5 THEN 3 ELSE 0 END AS n_gifts, (s_suppkey % 3)::INT AS flag,
          CASE WHEN s_suppkey % 8 = 5 THEN 0.25 ELSE 0 END::DOUBLE AS extra_rate,
          CASE WHEN s_suppkey % 8 = 5 THEN 1 ELSE 4 END AS board_mask
        FROM supplier WHERE s_suppkey % 8 NOT IN (1, 2, 3, 4)""",
    "calendar_keys": """
        SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS day, strftime(o_orderdate, '%G-W%V') AS week,
          strftime(o_orderdate, '%Y%m') AS month, isodow(o_orderdate)::INT AS day_of_week,
          day(o_orderdate)::INT AS day_of_month, dayofyear(o_orderdate)::INT AS day_number
        FROM orders""",
    "calendar_keys_utc8": """
        SELECT event_id, strftime(ts + INTERVAL 8 HOUR, '%Y%m%d') AS day, strftime(ts + INTERVAL 8 HOUR, '%G-W%V') AS week
        FROM events""",
    "word_count": f"WITH {_words('documents')} SELECT value, count(*) AS count FROM word GROUP BY ALL",
    "click_total": "SELECT user_id::VARCHAR AS uid, sum(trunc(value)::INT)::BIGINT AS clicks FROM events GROUP BY ALL",
    "running_sum": f"WITH {_words('conversations')} SELECT value, count(*) AS total FROM word GROUP BY ALL",
    "running_max": """
        SELECT user_id::VARCHAR AS uid, greatest(max(trunc(value)::INT), 0) AS best FROM events GROUP BY ALL""",
    "last_put": """
        SELECT user_id, arg_max(event_type, (epoch_us(ts) // 1000000, event_type)) AS event_type
        FROM events GROUP BY ALL""",
    "typed_average": "SELECT sum(round(c_acctbal)::BIGINT)::DOUBLE / count(*) AS average FROM customer",
    "user_defined_average": """
        SELECT c_nationkey, sum(round(c_acctbal)::BIGINT)::DOUBLE / count(*) AS average FROM customer GROUP BY ALL""",
    "select_filter_between": f"""WITH {PEOPLE}
        SELECT name, age + 1 AS next_age, 'Name:' || name AS greeting, age::VARCHAR AS age_text
        FROM people WHERE age BETWEEN 13 AND 19""",
    "filter_greater": f"WITH {PEOPLE} SELECT * FROM people WHERE age > 21",
    "group_avg": f"WITH {PEOPLE} SELECT age, avg(age) AS avg_age, count(*) AS people FROM people GROUP BY ALL",
    "global_sum_count": "SELECT sum(l_quantity::BIGINT)::BIGINT AS total, count(*) AS rows FROM lineitem",
    "topn_per_key": """
        SELECT l_suppkey AS key, l_extendedprice AS price FROM lineitem
        QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC) <= 3""",
    "sliding_minmaxsum": WINDOWS,
    "offset_resume": """
        WITH ledger AS (
          SELECT event_type AS topic, (user_id % 4)::INT AS partition, epoch_ms(date_trunc('day', ts)) AS batch_ms,
            max(event_id) + 1 AS until_offset FROM events GROUP BY ALL),
        newest AS (SELECT * FROM ledger QUALIFY batch_ms = max(batch_ms) OVER (PARTITION BY topic)),
        part AS (SELECT topic, unnest(range(6))::INT AS partition FROM (SELECT DISTINCT topic FROM ledger))
        SELECT topic, 'boards' AS group_id, partition, coalesce(until_offset, 0) AS from_offset
        FROM part LEFT JOIN newest USING (topic, partition)""",
    "similarity_explode": """
        SELECT p_partkey::VARCHAR AS aid, unnest([p_partkey + 1, p_partkey * 2, p_size])::VARCHAR AS similar_aid
        FROM part""",
    "similarity_lookup": SIMILAR_LINES,
    "geo_radius": """
        WITH p AS (SELECT c_custkey AS place, radians((c_custkey * 37) % 1700 / 10.0 - 85) AS lat,
                     radians((c_custkey * 101) % 3600 / 10.0 - 180) AS lon FROM customer),
        d AS (SELECT p.place, 2 * 6372.797560856 * asin(sqrt(sin((p.lat - c.lat) / 2) ** 2
                + cos(c.lat) * cos(p.lat) * sin((p.lon - c.lon) / 2) ** 2)) AS distance
              FROM p, (SELECT * FROM p WHERE place = 7) c)
        SELECT place, round(distance, 3) AS distance FROM d WHERE distance <= 1500""",
    "geo_pairs": """
        WITH p AS (SELECT c_custkey AS place, radians((c_custkey * 37) % 1700 / 10.0 - 85) AS lat,
                     radians((c_custkey * 101) % 3600 / 10.0 - 180) AS lon FROM customer),
        c AS (SELECT s_suppkey AS centre, radians((s_suppkey * 53) % 1801 / 10.0 - 90) AS lat,
                radians(180 - (s_suppkey * 71) % 3600 / 10.0) AS lon FROM supplier),
        d AS (SELECT c.centre, p.place, 2 * 6372.797560856 * asin(sqrt(sin((p.lat - c.lat) / 2) ** 2
                + cos(c.lat) * cos(p.lat) * sin((p.lon - c.lon) / 2) ** 2)) AS distance FROM p, c)
        SELECT centre, place, round(distance, 3) AS distance FROM d WHERE distance <= 400""",
    "top_donor_labels": _gift(
        """SELECT 'live:' || project || ':u2q' || CASE period WHEN 'day' THEN 'Dy' WHEN 'week' THEN 'Wk' WHEN 'month' THEN 'Mth' ELSE '' END
          || CASE gift_class WHEN 'all' THEN 'AlGf' ELSE 'SpecGf' END
          || CASE period WHEN 'week' THEN (regexp_extract(period_key, 'W(\\d+)', 1)::INT)::VARCHAR ELSE period_key END || ':map' AS key,
          owner AS qid, member AS uid, score FROM ranked r
        WHERE role = 'donor' AND rank = 1
          AND EXISTS (SELECT 1 FROM host_pool p WHERE p.project = r.project AND p.qid = r.owner)""",
        TOP,
    ),
    "source_text": """
        SELECT value, count(*) AS lines FROM (SELECT unnest(string_split(text, chr(10))) AS value FROM conversations)
        GROUP BY value""",
    "source_json": "SELECT c_custkey, c_name, c_mktsegment FROM customer",
    "source_catalog": "SELECT o_orderkey, o_custkey, o_orderpriority FROM orders",
    "source_memory": """
        SELECT 'class ' || (c_nationkey % 5) AS label, count(*) AS customers FROM customer GROUP BY ALL""",
    "retention_filter": "SELECT event_id FROM events WHERE ts > TIMESTAMP '2024-01-24 00:00:00'",
    "stream_board_scores": _gift(
        "SELECT * FROM scores WHERE period IN ('all', 'month') AND role <> 'donor'"
    ),
    "stream_board_totals": _gift(f"SELECT * FROM scores WHERE {CAMPAIGN_BOARDS}"),
    "stream_day_peak": f"WITH {POP} SELECT project, host_id, strftime(day, '%Y%m%d') AS day, peak FROM peak",
    "stream_top_lists": _gift(
        "SELECT * FROM ranked WHERE rank <= 101 AND period IN ('all', 'month') AND role <> 'donor'", TOP
    ),
    "stream_expiring_clicks": """
        WITH e AS (SELECT user_id::VARCHAR AS uid, epoch_us(ts) // 1000000 AS u, trunc(value)::BIGINT AS clicks FROM events),
        g AS (SELECT *, coalesce(u - lag(u) OVER (PARTITION BY uid ORDER BY u) > 21600, false)::INT AS fresh FROM e),
        r AS (SELECT *, sum(fresh) OVER (PARTITION BY uid ORDER BY u) AS run FROM g)
        SELECT uid, sum(clicks)::BIGINT AS total, max(u) AS last_u FROM r
        GROUP BY uid, run HAVING max(u) + 21600 >= (SELECT max(u) FROM e)
        QUALIFY run = max(run) OVER (PARTITION BY uid)""",
    "stream_running_max": """
        SELECT user_id::VARCHAR AS uid, greatest(max(trunc(value)::INT), 0) AS best FROM events GROUP BY ALL""",
    "stream_word_count": f"WITH {_words('conversations')} SELECT value, count(*) AS count FROM word GROUP BY ALL",
    "outbox_receipts": f"""WITH {WATCH}
        SELECT uid, day, uid || ':' || day AS receipt, CASE WHEN uid::BIGINT % 3 = 0 THEN 2 ELSE 1 END::BIGINT AS attempt FROM signed""",
    "stream_sliding": WINDOWS,
    "sliding_panes": WINDOWS,
    # Of so few minutes a sketch lists all, so its numbers are the exact ones.
    "stream_sketches": f"""WITH {WATCH}
        SELECT uid, day, minutes, floor(minutes / (1 + 3 * 1.04 / 64))::BIGINT AS low, ceil(minutes / (1 - 3 * 1.04 / 64))::BIGINT AS high
        FROM per_day""",
    "stream_new_minutes": """
        SELECT DISTINCT user_id::VARCHAR AS uid, epoch_us(ts) // 60000000 * 60 AS minute_u FROM events""",
    "stream_signins": f"""WITH {WATCH}
        SELECT uid, day, count(*) OVER (PARTITION BY uid ORDER BY day) AS days FROM signed""",
    "stream_lookup": SIMILAR_LINES,
    "stream_popularity": f"""WITH {POP.replace("FROM events e", "FROM (SELECT * FROM events WHERE event_id % 20 > 2) e")}
        SELECT * FROM scores UNION ALL
        SELECT * REPLACE ('signUp' AS scope) FROM scores
        WHERE project = 'stars_signup' AND member::BIGINT % 3 = 0
          AND member IN (SELECT c_custkey::VARCHAR FROM customer)""",
    "stream_switches": """
        SELECT user_id::VARCHAR AS room_id, event_type AS cate, max(epoch_us(ts) // 1000000) AS time_u
        FROM events WHERE event_id % 11 <> 0 AND event_id % 7 <> 0 GROUP BY ALL""",
}
ORACLE["stream_asof"] = ORACLE["asof_category_full"]
ORACLE["user_average_sql"] = ORACLE["stream_user_average"] = ORACLE["user_defined_average"]
ORACLE["stream_raw_top"] = ORACLE["raw_gift_top"]
ORACLE["stream_profile_merge"] = ORACLE["profile_merge"]
