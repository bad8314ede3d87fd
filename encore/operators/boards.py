"""Gift leaderboards.

A board is identified by columns, never by a composed key:

``project, scope (all|group), grp, role (host|user|donor), owner, period, period_key, gift_class``

``owner`` is the host whose donors are ranked (donor boards only), ``grp`` the group of a
group board; both are empty elsewhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from encore.functions.calendar import ONE_PERIOD, local_date, period_key
from encore.operators.campaigns import BOARD_KEYS, Span, board_bit, match_campaigns
from encore.operators.ranking import top_k

BOARD = ["project", "scope", "grp", "role", "owner", "period", "period_key", "gift_class"]
SCORES = [*BOARD, "member", "score"]
PERIODS = ("all", "day", "week", "month")
CLASSES = ("all", "special")
ROLES = ("host", "user", "donor")
SCOPES = ("all", "group")
SIGN_UP = len(SCOPES)  # code of the scope of sign-up copies
CODES = ["project", "board", "grp", "role", "owner", "date", "member"]  # a board and its member in codes
NARROW = ["code", "project", "at", "member"]  # the same in fewer columns
UNIT = 10_000  # parts of a point that scores are summed up in


def _mask(periods, classes) -> int:
    return sum(board_bit(p, c) for p, c in BOARD_KEYS if p in periods and c in classes)


def _any(mask: Column, bits: int) -> Column:
    return mask.bitwiseAND(F.lit(bits)) != 0


def weigh_gifts(matched: DataFrame) -> DataFrame:
    """Add ``special`` (gift on the campaign's list; an empty list has none) and ``score``.

    With the extra switched on, a special gift is worth total * (1 + rate) on every
    board of the campaign, provided |rate| < 1. Scores are whole numbers of :data:`UNIT`
    parts, so that sums do not depend on their order.
    """
    special = F.coalesce(F.array_contains(F.col("gift_ids"), F.col("gift_id")), F.lit(False))
    total = F.col("total").cast("bigint") * UNIT
    extra = F.col("extra_add") & special & (F.abs("extra_rate") < 1)
    weighted = F.round(total * (1 + F.col("extra_rate"))).cast("bigint")
    return matched.withColumn("special", special).withColumn("score", F.when(extra, weighted).otherwise(total))


def _weighted(gifts, campaigns, tz, periods, classes, span) -> DataFrame:
    wanted = _mask(periods, classes)
    campaigns = campaigns.withColumn("board_mask", F.col("board_mask").bitwiseAND(F.lit(wanted)))
    matched = match_campaigns(gifts, campaigns.where(F.col("board_mask") != 0), span=span)
    rows = weigh_gifts(matched)
    on_a_board = _any(F.col("board_mask"), _mask(PERIODS, ("all",))) | (
        F.col("special") & _any(F.col("board_mask"), _mask(PERIODS, ("special",)))
    )
    return rows.where(on_a_board).withColumn("date", local_date(F.col("time_u"), tz))


def _by_role(rows: DataFrame, roles) -> DataFrame:
    """One row per gift and role: the host's, the giver's, and the giver's at that host.

    ``host`` is the host whose group counts, in grouped campaigns (flag 2), and empty elsewhere.
    """
    coded = rows.withColumn("role", F.explode(F.array(*[F.lit(ROLES.index(r)) for r in roles])))
    host, donor = F.col("role") == ROLES.index("host"), F.col("role") == ROLES.index("donor")
    grouped = F.col("flag") == 2
    return coded.where(~donor | F.col("u2q")).select(
        "project",
        "board_mask",
        grouped.alias("grouped"),
        (F.col("flag") == 1).alias("signs"),
        F.when(grouped, F.col("qid")).otherwise("").alias("host"),
        "role",
        F.when(donor, F.col("qid")).otherwise("").alias("owner"),
        F.when(host, F.col("qid")).otherwise(F.col("uid")).alias("member"),
        "special",
        "date",
        "score",
    )


def assign_groups(rows: DataFrame, host_group: DataFrame | None) -> DataFrame:
    """Add ``grp``: the host's group in grouped campaigns, empty elsewhere and on donor boards, which have no group form.

    What a host without a group got in a grouped campaign is dropped.
    """
    if host_group is None:
        return rows.where(~F.col("grouped")).withColumn("grp", F.lit("")).drop("host", "grouped")
    groups = host_group.where(F.col("grp") != "").select("project", F.col("qid").alias("host"), F.col("grp").alias("_grp"))
    joined = rows.join(groups, ["project", "host"], "left").where(~F.col("grouped") | F.col("_grp").isNotNull())
    named = F.when(F.col("grouped") & (F.col("role") != ROLES.index("donor")), F.col("_grp")).otherwise("")
    return joined.withColumn("grp", named).drop("_grp", "host", "grouped")


def _by_board(rows: DataFrame, periods, classes, scopes) -> DataFrame:
    """One row per board a (role, date) row belongs to.

    The board is one small number, ``scope * 8 + family``, with the family counted as in
    the mask: cheap to generate, filter and group by. :func:`named` spells it out.
    """
    families = [i for i, (p, c) in enumerate(BOARD_KEYS) if p in periods and c in classes]
    wanted = [SCOPES.index(s) for s in scopes] + ([SIGN_UP] if "pooled" in rows.columns else [])
    codes = [scope * len(BOARD_KEYS) + i for scope in wanted for i in families]
    coded = rows.withColumn("board", F.explode(F.array(*[F.lit(code) for code in codes])))
    family, scope = F.col("board") % len(BOARD_KEYS), F.floor(F.col("board") / len(BOARD_KEYS))
    grouped = scope == SCOPES.index("group")
    bit = F.expr(f"shiftright(board_mask, board % {len(BOARD_KEYS)})").bitwiseAND(F.lit(1))
    placed = coded.where((bit == 1) & ((family % 2 == 0) | F.col("special")) & (~grouped | (F.col("grp") != "")))
    if "pooled" in rows.columns:
        signed = F.col("pooled") & F.col("signs") & (F.col("role") != ROLES.index("donor"))
        placed = placed.where((scope != SIGN_UP) | F.coalesce(signed, F.lit(False)))
    return placed.select(
        "project",
        "board",
        F.when(grouped, F.col("grp")).otherwise("").alias("grp"),
        "role",
        "owner",
        _start(family, F.col("date")).alias("date"),
        "member",
        "score",
    )


def _start(family: Column, date: Column) -> Column:
    """First date of the family's period: families come in pairs of all, day, week, month."""
    return (
        F.when(family < 2, F.lit(ONE_PERIOD).cast("date"))
        .when(family < 4, date)
        .when(family < 6, F.trunc(date, "week"))
        .otherwise(F.trunc(date, "month"))
    )


def _spell(code: Column, names) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), (code + 1).cast("int"))


def named(rows: DataFrame) -> DataFrame:
    """Codes to names, parts to points, and the period's start date to its key."""
    family = F.col("board") % len(BOARD_KEYS)
    spelled = rows.select(
        "project",
        _spell(F.floor(F.col("board") / len(BOARD_KEYS)), [*SCOPES, "signUp"]).alias("scope"),
        "grp",
        _spell(F.col("role"), ROLES).alias("role"),
        "owner",
        _spell(family, [p for p, _ in BOARD_KEYS]).alias("period"),
        "date",
        _spell(family, [c for _, c in BOARD_KEYS]).alias("gift_class"),
        "member",
        (F.col("score") / F.lit(float(UNIT))).alias("score"),
        *[c for c in ("rank",) if c in rows.columns],
    )
    keyed = spelled.withColumn("period_key", period_key(F.col("period"), F.col("date")))
    return keyed.select(*SCORES, *[c for c in ("rank",) if c in rows.columns])


def narrow(rows: DataFrame) -> DataFrame:
    """Coded rows in fewer and shorter columns: board, role and date as one number, and as ``at`` the owner of a donor board or
    the group of another one, as donor boards have none. What is sent, sorted and kept is half as wide; :func:`wide` undoes it."""
    code = F.unix_date("date").cast("bigint") * 128 + F.col("role") * 32 + F.col("board")
    at = F.when(F.col("role") == ROLES.index("donor"), F.col("owner")).otherwise(F.col("grp"))
    return rows.select(code.alias("code"), "project", at.alias("at"), "member", "score")


def wide(rows: DataFrame) -> DataFrame:
    """Rows of :func:`narrow` under :data:`CODES`."""
    role = F.shiftright("code", 5).bitwiseAND(F.lit(3)).cast("int")
    donor = role == ROLES.index("donor")
    return rows.select(
        "project", F.col("code").bitwiseAND(F.lit(31)).cast("int").alias("board"), F.when(donor, "").otherwise(F.col("at")).alias("grp"),
        role.alias("role"), F.when(donor, F.col("at")).otherwise("").alias("owner"),
        F.date_from_unix_date(F.shiftright("code", 7).cast("int")).alias("date"), "member", "score",
    )


def coded_rows(
    gifts: DataFrame,
    campaigns: DataFrame,
    host_group: DataFrame | None = None,
    tz: str = "UTC",
    periods=PERIODS,
    classes=CLASSES,
    roles=ROLES,
    scopes=SCOPES,
    span: Span | None = None,
    host_pool: DataFrame | None = None,
) -> DataFrame:
    """Every (:data:`CODES`, score in parts) a gift adds to, without aggregating: up to 40 per campaign.

    With ``host_pool`` the sign-up copies are among them: rows of scope all, of hosts and users in the pool, in sign-up
    campaigns. No row meets another, so this runs on a stream as it is; :func:`named` spells the codes out.
    """
    rows = _by_role(_weighted(gifts, campaigns, tz, periods, classes, span), roles)
    if host_pool is not None:
        pool = host_pool.select("project", F.col("qid").alias("member"), F.lit(True).alias("pooled")).distinct()
        rows = rows.join(pool, ["project", "member"], "left")
    return _by_board(assign_groups(rows, host_group), periods, classes, scopes)


def board_rows(gifts: DataFrame, campaigns: DataFrame, host_group: DataFrame | None = None, **which) -> DataFrame:
    """:func:`coded_rows` under their names; a batch should call :func:`board_scores`."""
    return named(coded_rows(gifts, campaigns, host_group, **which))


def _finest(mask: Column, date: Column) -> Column:
    """The coarsest date that still tells every enabled period of the campaign apart."""
    day = _any(mask, _mask(("day",), CLASSES))
    week = _any(mask, _mask(("week",), CLASSES))
    month = _any(mask, _mask(("month",), CLASSES))
    return (
        F.when(day | (week & month), date)
        .when(week, F.trunc(date, "week"))
        .when(month, F.trunc(date, "month"))
        .otherwise(F.lit(ONE_PERIOD).cast("date"))
    )


def _at_host() -> Column:
    """The host of a row that has one: of a grouped campaign, or of a donor board, where both are the gift's."""
    return F.when(F.col("grouped"), F.col("host")).otherwise(F.col("owner"))


def _packed() -> Column:
    """Mask, role, flags and date as one number."""
    flags = (
        F.col("board_mask").cast("bigint")
        + F.col("role") * 256
        + F.col("special").cast("int") * 1024
        + F.col("grouped").cast("int") * 2048
    )
    return F.unix_date("date").cast("bigint") * 4096 + flags


def _unpacked(rows: DataFrame) -> DataFrame:
    def bits(at: int, n: int) -> Column:
        return F.shiftright("code", at).bitwiseAND(F.lit((1 << n) - 1)).cast("int")

    role, grouped = bits(8, 2), bits(11, 1) == 1
    return rows.select(
        "project", bits(0, 8).alias("board_mask"), grouped.alias("grouped"), F.when(grouped, F.col("at")).otherwise("").alias("host"),
        role.alias("role"), F.when(role == ROLES.index("donor"), F.col("at")).otherwise("").alias("owner"), "member",
        (bits(10, 1) == 1).alias("special"), F.date_from_unix_date(F.shiftright("code", 12).cast("int")).alias("date"), "score",
    )


def board_scores(
    gifts: DataFrame,
    campaigns: DataFrame,
    host_group: DataFrame | None = None,
    tz: str = "UTC",
    periods=PERIODS,
    classes=CLASSES,
    roles=ROLES,
    scopes=SCOPES,
    span: Span | None = None,
    top: int | None = None,
    members: DataFrame | None = None,
    owners: DataFrame | None = None,
    host_pool: DataFrame | None = None,
    combine: bool = False,
) -> DataFrame:
    """Leaderboard scores: sum per board and member; with ``top`` only each board's top list, ranked.

    ``members`` (project, member) and ``owners`` (project, owner) restrict the boards to such rows, below the
    first sum. With ``host_pool`` the sign-up copies are among them: of boards of scope all, the members in the pool, in sign-up
    campaigns; a project has one configuration.

    Sums compose, so gifts are first added up per (role, owner, member, date) at the
    finest date the campaign's boards need, and only those sums fan out to week, month
    and campaign boards. All of a member's rows of a campaign are brought together by one
    shuffle, of 3 narrow rows for a gift and not 40, so both sums and the copies need no
    other. A member with very many gifts is added up by one task, which holds a number for
    each of its dates; ``combine`` adds up before that shuffle, by another one. Names are
    spelled out last, so the ranking handles small codes.
    """
    if "all" not in scopes:
        campaigns = campaigns.where(F.col("flag") == 2)  # others have no board with a group
    rows = _weighted(gifts, campaigns, tz, periods, classes, span)
    rows = _by_role(rows.withColumn("date", _finest(F.col("board_mask"), F.col("date"))), roles)
    for wanted, keys in ((members, ["project", "member"]), (owners, ["project", "owner"])):
        rows = rows if wanted is None else rows.join(wanted.select(*keys).distinct(), keys, "left_semi")
    keys = ["project", "member", "at", "code"]
    coded = rows.select("project", "member", _at_host().alias("at"), _packed().alias("code"), "score")
    if combine:
        coded = coded.groupBy(*keys).agg(F.sum("score").alias("score"))
    daily = coded.repartition("project", "member").groupBy(*keys).agg(F.sum("score").alias("score"))
    # Groups meet the sums of grouped campaigns' hosts, not their gifts.
    placed = _by_board(assign_groups(_unpacked(daily), host_group), periods, classes, scopes)
    # The most telling column first: sorts compare its 8-byte prefix before anything else.
    board = ["date", "board", "role", "project", "grp", "owner"]
    scores = placed.groupBy(*board, "member").agg(F.sum("score").alias("score"))
    if host_pool is not None:
        scores = _with_copies(scores, host_pool, campaigns)
    return named(scores if top is None else top_k(scores, board, top))


def _with_copies(scores: DataFrame, host_pool: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Coded scores and, under the code of scope ``signUp``, those of scope all whose member is in the pool of a sign-up campaign."""
    asked = campaigns.where(F.col("flag") == 1).select("project")
    pool = host_pool.select("project", F.col("qid").alias("member")).distinct().join(asked, "project", "left_semi")
    found = scores.join(pool.withColumn("pooled", F.lit(True)), ["project", "member"], "left")
    signed = F.col("pooled") & (F.col("role") != ROLES.index("donor")) & (F.col("board") < len(BOARD_KEYS))
    both = F.array(F.col("board"), F.col("board") + SIGN_UP * len(BOARD_KEYS))
    copied = F.when(signed, both).otherwise(F.array("board"))
    return found.withColumn("board", F.explode(copied)).drop("pooled")


def restrict_to_pool(scores: DataFrame, host_pool: DataFrame, campaigns: DataFrame | None = None) -> DataFrame:
    """Rows whose member signed up, as scope ``signUp``, of the boards of sign-up campaigns (flag 1)."""
    rows = scores.where(F.col("role") != "donor") if "role" in scores.columns else scores
    if campaigns is not None:
        rows = rows.join(campaigns.where(F.col("flag") == 1).select("project"), "project", "left_semi")
    pool = host_pool.select("project", F.col("qid").alias("member"))
    return rows.join(pool, ["project", "member"], "left_semi").withColumn("scope", F.lit("signUp"))


def signed_up_scores(gifts: DataFrame, campaigns: DataFrame, host_pool: DataFrame, roles=("host", "user"), **which) -> DataFrame:
    """The sign-up copies of boards: scores of sign-up campaigns (flag 1) whose member is in the pool, as scope ``signUp``.

    User boards are restricted the same way: by whether the *user* is in the pool. Donor boards have no sign-up copy.
    """
    pool = host_pool.select("project", F.col("qid").alias("member"))
    asked = campaigns.where(F.col("flag") == 1)
    scores = board_scores(gifts, asked, roles=roles, scopes=("all",), members=pool, **which)
    return scores.withColumn("scope", F.lit("signUp"))


def top_donor(gifts: DataFrame, campaigns: DataFrame, host_pool: DataFrame, host_group: DataFrame | None = None, **which) -> DataFrame:
    """Each signed-up host's best donor per donor board: (project, period, period_key, gift_class, qid, uid, score).

    Asks for pool membership whatever the campaign's flag, and only of campaigns with donor boards.
    """
    pool = host_pool.select("project", F.col("qid").alias("owner"))
    asked = campaigns.where("u2q")
    return best_donor(board_scores(gifts, asked, host_group, roles=("donor",), owners=pool, **which))


def best_donor(scores: DataFrame) -> DataFrame:
    """The best donor of every donor board. Equal scores go to the higher uid in text order. A ``max`` aggregate, so busy
    hosts are combined map-side."""
    donors = scores.where(F.col("role") == "donor")
    best = donors.groupBy("project", "period", "period_key", "gift_class", F.col("owner").alias("qid")).agg(
        F.max(F.struct("score", "member")).alias("b")
    )
    return best.select(
        "project", "period", "period_key", "gift_class", "qid",
        F.col("b.member").alias("uid"), F.col("b.score").alias("score"),
    )


def latest_room(gifts: DataFrame, host: str = "qid", room: str = "room_id", time: str = "time_u") -> DataFrame:
    """Room of each host's newest record (equal times: the higher room id).

    Hosts seldom change rooms, so the times are first combined per (host, room).
    """
    per_room = gifts.groupBy(host, room).agg(F.max(time).alias(time))
    newest = F.max(F.struct(F.col(time), F.col(room))).alias("n")
    return per_room.groupBy(host).agg(newest).select(host, F.col(f"n.{room}").alias(room))
