"""Leaderboard order, top lists and top-N per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from encore.session import saved

TOP_LIST = 101  # published top lists are indices 0 to 100 inclusive


def leaderboard_order(score: str = "score", member: str = "member") -> list[Column]:
    """Score descending, then member descending in byte order of its text."""
    return [F.col(score).desc(), F.col(member).cast("string").desc()]


def _sorted_by(by: list[str]) -> Column:
    """A number for each board. Before a board's own columns it spares sorts nearly all comparisons of their texts, as a sort compares
    the first column's 8 bytes first; boards that share a number are told apart by those columns."""
    return F.xxhash64(*by)


def top_k(scores: DataFrame, by: list[str], k: int = TOP_LIST, score: str = "score", member: str = "member") -> DataFrame:
    """The first ``k`` members of every board, with their ``rank``.

    ``row_number() <= k`` plans as a group limit before and after the shuffle, so a task
    never receives more than k rows of a board from each upstream partition, up to the session's
    ``spark.sql.optimizer.windowGroupLimitThreshold``.
    """
    order = Window.partitionBy("_board", *by).orderBy(*leaderboard_order(score, member))
    ranked = scores.withColumn("_board", _sorted_by(by)).withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= k).drop("_board")


def lowest(scores: DataFrame, by: list[str], score: str = "score", member: str = "member") -> DataFrame:
    """The last member of every board (lowest score, then lowest member)."""
    best = scores.groupBy(_sorted_by(by).alias("_board"), *by).agg(F.min(F.struct(F.col(score), F.col(member))).alias("b"))
    return best.select(*by, F.col(f"b.{member}").alias(member), F.col(f"b.{score}").alias(score))


def board_listing(scores: DataFrame, by: list[str], score: str = "score", member: str = "member") -> DataFrame:
    """Whole boards in leaderboard order, with each member's ``position`` from 1.

    Positions need no board in one task: the boards are sorted as one table, every part of it counts its rows of each
    board, and the counts of the parts before are added.
    """
    board = F.struct(*by)
    order = [*by, *leaderboard_order(score, member)]
    dealt = saved(scores.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "listing")
    inside = Window.partitionBy("_part", *by).orderBy(*leaderboard_order(score, member))
    ordered = dealt.withColumn("_at", F.row_number().over(inside))
    counts = ordered.groupBy("_part", *by).agg(F.count("*").alias("_n"))  # one row for each board and part of it
    upto = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(F.col("_part").alias("_p"), board.alias("_b"), F.coalesce(F.sum("_n").over(upto), F.lit(0)).alias("_before"))
    found = ordered.join(before, (F.col("_part") == F.col("_p")) & (board == F.col("_b")))
    return found.withColumn("position", F.col("_at") + F.col("_before")).drop("_part", "_at", "_p", "_b", "_before")


def top_n_per_key(df: DataFrame, key: str, value: str, n: int = 3, tie: str | None = None) -> DataFrame:
    """The ``n`` largest values of each key; duplicates count, ties fall to the larger ``tie``."""
    order = [F.col(value).desc()] + ([F.col(tie).desc()] if tie else [])
    ranked = df.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy(*order)))
    return ranked.where(F.col("rank") <= n)


def touched_of(top: DataFrame, touched: DataFrame, by: list[str], member: str = "member") -> DataFrame:
    """Rows of top lists whose members were just touched."""
    return top.join(touched.select(*by, member), [*by, member], "left_semi")
