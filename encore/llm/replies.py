"""Chat formatting: reply trees to conversations.

Messages name the message that they reply to. Self-joins that double the way in every round find each message's root;
branches (root to leaf) are ranked by the sum of their messages' scores; the chosen ones are laid out by the same doubling,
again in few rounds however long a branch is, and formatted by a template whose control strings texts cannot forge.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from encore.llm.common import map_batches, map_rows, saved, slices

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
#: The control strings of common templates, none of which may stand in a text as it is.
CONTROL = [OPEN, CLOSE, "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]
_REST = "|".join(sorted({re.escape(c[1:]) for c in CONTROL}))
#: A control string with any number of backslashes behind its first character.
_ESCAPE, _UNESCAPE = re.compile(rf"([<\[])(\\*)({_REST})"), re.compile(rf"([<\[])\\(\\*)({_REST})")
#: Turns of a row of the output; a longer conversation goes on in the next row.
TURNS = 1024
#: Rows of one key that a join leaves in one task.
SPREAD = 50_000
MESSAGE = ["node", "tree", "id", "parent", "role", "text", "score"]


def escape(text: str) -> str:
    """Control strings get a backslash behind their first character, and escaped ones one more."""
    return _ESCAPE.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1\2\3", text)


def turn(role: str | None, text: str | None) -> tuple[str, int, int]:
    """A formatted turn, and from where to where in it the text reaches."""
    name = (role or "").replace("\\", "\\\\").replace("\n", "\\n")
    head = f"{OPEN}{escape(name)}\n"
    body = escape(text or "")
    return f"{head}{body}{CLOSE}\n", len(head), len(head) + len(body)


def read(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) of every turn of a formatted conversation, or of whole rows of one."""
    turns = []
    for piece in formatted.split(OPEN)[1:]:
        name, _, body = piece.partition("\n")
        name = re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(name))
        turns.append((name, unescape(body.removesuffix(f"{CLOSE}\n"))))
    return turns


def look_up(left: DataFrame, key: str, right: DataFrame, rows: int) -> DataFrame:
    """Inner join of ``left`` on ``key`` with ``right``, whose column ``at`` is unique.

    Keys with more than a thousandth of the ``rows`` of ``left`` (so a thousand at most) are dealt over many tasks, and
    their row of ``right`` goes along.
    """
    often = max(SPREAD, rows // 1000)
    hot = left.groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") > often).collect() if rows > often else []
    if not hot:
        return left.join(right, F.col(key) == F.col("at")).drop("at")
    spark = left.sparkSession
    told = spark.createDataFrame([(r[0], r.n // SPREAD + 1) for r in hot], "hot long, cuts long")
    one = F.coalesce("cuts", F.lit(1).cast("long"))
    cut = left.join(F.broadcast(told), F.col(key) == F.col("hot"), "left")
    cut = cut.withColumn("cut", F.pmod(F.xxhash64(*(c for c in left.columns)), one)).drop("hot", "cuts")
    copies = right.join(F.broadcast(told), F.col("at") == F.col("hot"), "left")
    copies = copies.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), one - 1))).drop("hot", "cuts")
    return cut.join(copies, (F.col(key) == F.col("at")) & (F.col("cut") == F.col("copy"))).drop("at", "cut", "copy")


def messages(
    rows: DataFrame, tree: str = "tree", id: str = "id", parent: str = "parent", role: str = "role", text: str = "text", score: str | None = "score"
) -> DataFrame:
    """The messages of reply trees, each once, with a number.

    Of rows that share tree and id, the one of highest score, then smallest parent, role and text is the message. Rows
    without an id are messages that nothing replies to. A null tree is a tree, a null score counts as 0, other columns
    are not read.
    """
    told = F.coalesce(F.col(score).cast("double"), F.lit(0.0)) if score else F.lit(0.0)
    rows = rows.select(
        F.col(tree).alias("tree"), F.col(id).alias("id"), F.col(parent).alias("parent"), F.col(role).alias("role"),
        F.col(text).alias("text"), told.alias("score"),
    )
    first = F.min(F.struct((-F.col("score")).alias("less"), "parent", "role", "text")).alias("m")
    one = rows.where("id is not null").groupBy("tree", "id").agg(first)
    one = one.select("tree", "id", "m.parent", "m.role", "m.text", (-F.col("m.less")).alias("score"))
    every = one.unionByName(rows.where("id is null")).withColumn("node", F.monotonically_increasing_id())
    return saved(every.select(MESSAGE), "messages")


def chains(rows: DataFrame, tree: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Messages of plain conversations: every row replies to the one before it, by ``turn`` (nulls first), then role, then
    the text's md5. Repeated rows are turns of their own; rows of a null conversation are one conversation.

    Positions come from a sort over the whole table and the counts of its partitions, so that no conversation is one task.
    """
    told = rows.select(F.col(tree).alias("tree"), F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).alias("text"))
    told = saved(told.withColumn("node", F.monotonically_increasing_id()), "turns")
    order = ["tree", "turn", "role", "mark", "node"]
    placed = told.select("node", "tree", "turn", "role", F.md5("text").alias("mark")).repartitionByRange(*order).sortWithinPartitions(*order)
    placed = placed.select("node", "tree", F.monotonically_increasing_id().alias("at"))
    placed = saved(placed.withColumn("part", F.shiftright("at", 33)), "places")
    parts = placed.groupBy("tree", "part").agg(F.min("at").alias("start"), F.count("*").alias("n"))
    before = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        F.col("tree").alias("t"), F.col("part").alias("p"), (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("start")).alias("shift")
    )
    places = placed.join(parts, placed["tree"].eqNullSafe(parts["t"]) & (F.col("part") == F.col("p")))
    places = places.select(F.col("node").alias("at"), (F.col("at") + F.col("shift")).alias("id"))
    out = look_up(told, "node", places, 0)
    parent = F.when(F.col("id") > 0, F.col("id") - 1)
    return saved(out.withColumn("parent", parent).withColumn("score", F.lit(0.0)).select(MESSAGE), "messages")


def branches(found: DataFrame, top: int | None = 1) -> tuple[DataFrame, list[DataFrame], int]:
    """Of :func:`messages`, the branches that rank ``top`` or better in their tree (all if null): ``tree``, ``branch`` (the
    rank, from 1), ``path`` (the leaf's node), ``score`` and ``depth``; each message's ancestors at distance 1, 2, 4, ...;
    and the number of messages.

    A message whose parent is null or not there is a root. Messages on a circle of replies, or below one, have no root and
    are in no branch. Branches of higher score come first, then those of smaller leaf id, then node.
    """
    places = found.select(F.col("tree").alias("t"), F.col("id").alias("i"), F.col("node").alias("up")).where("i is not null")
    rows = found.count()
    own = found.select("node", "tree", "id", "parent", "score")
    first = _with_parent(own, places, rows)
    state = saved(first.select("node", "up", F.when(F.col("up").isNotNull(), 1).otherwise(0).cast("long").alias("depth"), "score"), "ways")
    inner = saved(state.where("up is not null").select(F.col("up").alias("at")).distinct(), "inner")
    ups: list[DataFrame] = []
    while 2 ** len(ups) <= max(rows, 1):
        active = state.where("up is not null")
        if active.isEmpty():
            break
        ups.append(active.select("node", "up"))
        right = state.select(F.col("node").alias("at"), F.col("up").alias("next"), F.col("depth").alias("more"), F.col("score").alias("plus"))
        moved = look_up(active, "up", right, rows)
        moved = moved.select("node", F.col("next").alias("up"), (F.col("depth") + F.col("more")).alias("depth"), (F.col("score") + F.col("plus")).alias("score"))
        state = saved(state.where("up is null").unionByName(moved), "ways")
    ends = state.where("up is null").select("node", "depth", "score").join(inner, F.col("node") == F.col("at"), "left_anti")
    ends = ends.join(own.select(F.col("node").alias("at"), "tree", "id"), F.col("node") == F.col("at")).drop("at")
    order = Window.partitionBy("tree").orderBy(F.desc("score"), "id", "node")
    ends = ends.withColumn("branch", F.row_number().over(order))
    if top is not None:
        ends = ends.where(F.col("branch") <= top)
    return saved(ends.select("tree", "branch", F.col("node").alias("path"), "score", "depth"), "branches"), ups, rows


def _with_parent(own: DataFrame, places: DataFrame, rows: int) -> DataFrame:
    """``own`` with ``up``, the parent's node, or null. A parent with many replies is dealt over many tasks."""
    often = max(SPREAD, rows // 1000)
    hot = own.where("parent is not null").groupBy("tree", "parent").agg(F.count("*").alias("n")).where(F.col("n") > often)
    hot = hot.select(F.col("tree").alias("ht"), F.col("parent").alias("hp"), F.floor(F.col("n") / SPREAD + 1).alias("cuts"))
    one = F.coalesce("cuts", F.lit(1).cast("long"))
    if rows > often:
        hot = F.broadcast(saved(hot, "hot"))  # a thousand rows at most
        cut = own.join(hot, own["tree"].eqNullSafe(hot["ht"]) & (own["parent"] == hot["hp"]), "left").withColumn("cut", F.pmod("node", one)).drop("ht", "hp", "cuts")
        copies = places.join(hot, places["t"].eqNullSafe(hot["ht"]) & (places["i"] == hot["hp"]), "left")
        copies = copies.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), one - 1))).drop("ht", "hp", "cuts")
        met = cut["cut"] == copies["copy"]
    else:
        cut, copies, met = own, places, F.lit(True)
    has = F.col("parent").isNotNull()
    joined = cut.where(has).join(copies, cut["tree"].eqNullSafe(copies["t"]) & (cut["parent"] == copies["i"]) & met, "left")
    return joined.select(*own.columns, "up").unionByName(own.where(~has).withColumn("up", F.lit(None).cast("long")))


def lay_out(found: DataFrame, top: int | None = 1) -> DataFrame:
    """The messages of the chosen branches: ``tree``, ``branch``, ``path``, ``score``, ``position`` (the root's is 0),
    ``turns`` (of the branch), ``node``. The set of a branch's messages doubles in each round."""
    chosen, ups, rows = branches(found, top)
    way = chosen.select("*", F.col("path").alias("node"), F.col("depth").alias("position"))
    for k, up in enumerate(ups):
        before = up.select(F.col("node").alias("at"), "up")
        more = look_up(way, "node", before, rows).drop("node").withColumnRenamed("up", "node")
        way = saved(way.unionByName(more.withColumn("position", F.col("position") - 2**k)), "way")
    return way.withColumn("turns", F.col("depth") + 1).drop("depth")


def conversations(found: DataFrame, top: int | None = 1, bears: tuple[str, ...] = ("assistant",), turns: int = TURNS) -> DataFrame:
    """The chosen branches of :func:`messages`, formatted.

    One row for every ``turns`` turns of a branch: ``tree``, ``branch``, ``path``, ``score``, ``part`` (from 0), ``parts``,
    ``n_turns`` and ``text`` of this row, and ``loss``: from where to where in ``text``, in code points, the escaped texts of
    roles in ``bears`` stand. A branch is the rows of its parts, in their order, end to end. Null roles and texts are empty.
    """
    way = lay_out(found, top)
    rows = way.withColumn("part", F.floor(F.col("position") / turns)).withColumn("parts", F.floor((F.col("turns") - 1) / turns) + 1)
    texts = found.select(F.col("node").alias("at"), "role", "text")
    told = look_up(rows, "node", texts, found.count())
    keys = ["tree", "branch", "path", "score", "part", "parts"]
    parts = told.groupBy(keys).agg(F.sort_array(F.collect_list(F.struct("position", "role", "text"))).alias("said"))

    def make():
        def work(said: list[list[dict]]) -> dict:
            out: dict[str, list] = {"n_turns": [], "text": [], "loss": []}
            for some in said:
                pieces, loss, at = [], [], 0
                for one in some:
                    piece, start, end = turn(one["role"], one["text"])
                    if one["role"] in bears:
                        loss.append({"start": at + start, "end": at + end})
                    pieces.append(piece)
                    at += len(piece)
                out["n_turns"].append(len(some))
                out["text"].append("".join(pieces))
                out["loss"].append(loss)
            return out

        return work

    new = "n_turns long, text string, loss array<struct<start: long, `end`: long>>"
    return map_rows(parts, ["said"], new, make).drop("said")


def digests(formatted: DataFrame, tree: str = "tree") -> DataFrame:
    """What :func:`conversations` says, read back from its output: one row for each branch with ``n_turns``, ``turns_sha256``
    (of role, line break, text, line break for every turn), ``loss_chars``, ``loss_sha256`` and ``formatted_chars``.

    Rows that are a whole branch are summed up where they are; parts of longer ones are read apart and meet in their order,
    one at a time.
    """
    head = ["tree", "branch", "parts"]
    kind = dict(formatted.dtypes)[tree]
    schema = f"tree {kind}, branch int, part long, parts long, n_turns long, told binary, lost binary, loss_chars long, formatted_chars long"

    def apart(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in slices(batches):
            out: dict[str, list] = {c: batch.column(c).to_pylist() for c in ("tree", "branch", "part", "parts")}
            out |= {c: [] for c in ("n_turns", "told", "lost", "loss_chars", "formatted_chars")}
            for text, loss, parts in zip(*(batch.column(c).to_pylist() for c in ("text", "loss")), out["parts"], strict=True):
                turns = read(text)
                told = "".join(f"{role}\n{body}\n" for role, body in turns).encode()
                lost = "".join(unescape(text[s["start"] : s["end"]]) for s in loss)
                out["n_turns"].append(len(turns))
                out["loss_chars"].append(len(lost))
                out["formatted_chars"].append(len(text))
                for name, value in (("told", told), ("lost", lost.encode())):
                    out[name].append(hashlib.sha256(value).digest() if parts == 1 else value)
            yield out

    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        names = ("tree", "branch", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
        last, state = None, None
        for batch in slices(batches):
            out: dict[str, list] = {c: [] for c in names}

            def close(done: list, out: dict = out) -> None:
                for name, value in zip(names, done, strict=True):
                    out[name].append(value.hexdigest() if hasattr(value, "hexdigest") else value)

            for row in batch.to_pylist():
                if row["parts"] == 1:
                    close([row["tree"], row["branch"], row["n_turns"], row["told"].hex(), row["loss_chars"], row["lost"].hex(), row["formatted_chars"]])
                    continue
                key = (row["tree"], row["branch"])
                if state is None or key != last:
                    if state:
                        close(state)
                    last, state = key, [*key, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                state[3].update(row["told"])
                state[5].update(row["lost"])
                for at, name in ((2, "n_turns"), (4, "loss_chars"), (6, "formatted_chars")):
                    state[at] += row[name]
            yield out
        if state:
            out = {c: [] for c in names}
            for name, value in zip(names, state, strict=True):
                out[name].append(value.hexdigest() if hasattr(value, "hexdigest") else value)
            yield out

    pieces = map_batches(formatted.select(F.col(tree).alias("tree"), "branch", "part", "parts", "text", "loss"), schema, apart)
    pieces = pieces.repartition("tree", "branch").sortWithinPartitions(*head, "part")
    return map_batches(
        pieces, f"tree {kind}, branch int, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long", together
    )


def oracle_sql() -> str:
    """The digests of all conversations and of one whose texts are control strings, for DuckDB."""
    rest = "|".join(sorted({re.sub(r"([|\[\]/])", r"\\\1", c[1:]) for c in CONTROL}))
    marks = len(OPEN) + 1 + len(CLOSE) + 1

    def escaped(what: str) -> str:
        return f"regexp_replace({what}, '([<\\[])(\\\\*)({rest})', '\\1\\\\\\2\\3', 'g')"

    name = escaped("replace(replace(role, '\\', '\\\\'), chr(10), '\\n')")
    return f"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]'))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, md5(text))) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, md5(text)) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum({marks} + length({name}) + length({escaped("text")}))::BIGINT AS formatted_chars
FROM rows GROUP BY conv_id
"""
