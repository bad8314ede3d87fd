"""Profiles and levels: lookups, merges and id sets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def missing_ids(ids: DataFrame, cache: DataFrame, key: str = "rid") -> DataFrame:
    """Distinct ids that the cache does not hold yet."""
    return ids.select(key).distinct().join(cache.select(key), key, "left_anti")


def fill_missing(ids: DataFrame, cache: DataFrame, profiles: DataFrame, key: str = "rid") -> DataFrame:
    """Profiles of the ids missing from the cache; an id without a profile stays out."""
    return profiles.join(missing_ids(ids, cache, key), key, "left_semi")


def with_profile(rows: DataFrame, profiles: DataFrame, member: str = "member", key: str = "rid") -> DataFrame:
    """Profile columns of each row's member, null where there is no profile.

    Meant for top lists, so that only their rows meet the profiles.
    """
    return rows.join(profiles.withColumnRenamed(key, member), member, "left")


def with_level(rows: DataFrame, levels: DataFrame, campaigns: DataFrame, member: str = "member") -> DataFrame:
    """Add ``level`` to user rows of campaigns that ask for it; null elsewhere."""
    asked = campaigns.where("user_level").select("project", F.lit(True).alias("_asked"))
    flagged = rows.join(asked, "project", "left")
    joined = with_profile(flagged, levels.select("rid", F.col("level").alias("_level")), member)
    level = F.when(F.col("_asked") & (F.col("role") == "user"), F.col("_level"))
    return joined.withColumn("level", level).drop("_asked", "_level")


def with_dimensions(rows: DataFrame, dimensions: list[DataFrame], member: str = "member", key: str = "rid") -> DataFrame:
    """Columns of several keyed dimensions beside each row, null where one lacks the member.

    Meant for tables of ``files.store_dimension`` and many rows: the rows are dealt out by the member once and merged with
    each dimension where it lies. No side is broadcast, whatever it holds.
    """
    for dimension in dimensions:
        rows = rows.join(dimension.withColumnRenamed(key, member).hint("merge"), member, "left")
    return rows


def profile_json(room_id: Column) -> Column:
    """Profile as stored: rid, nickName, avatar, roomId (empty where unknown)."""
    return F.to_json(
        F.struct("rid", F.col("nick_name").alias("nickName"), "avatar", F.coalesce(room_id, F.lit("")).alias("roomId"))
    )


def merge_profile(current: DataFrame, changes: DataFrame, order: str, key: str = "rid") -> DataFrame:
    """Lay changes over the current rows of known ids; an absent field keeps its old value.

    Several changes of one id are folded field by field, the newest non-null by ``order``.
    Changes of unknown ids are ignored.
    """
    fields = [c for c in changes.columns if c in current.columns and c not in (key, order)]

    def newest(name):
        return F.max_by(F.col(name), F.when(F.col(name).isNotNull(), F.struct(order, name)))

    folded = changes.groupBy(key).agg(*[newest(f).alias(f"_{f}") for f in fields])
    joined = current.join(folded, key, "left")
    return joined.select(
        *[F.coalesce(f"_{c}", c).alias(c) if c in fields else F.col(c) for c in current.columns]
    )


def put_if_absent(current: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """The table after adding rows whose key it does not have (one per key: the smallest row)."""
    added = rows.select(*current.columns).join(current.select(key), key, "left_anti")
    rest = [c for c in current.columns if c != key]
    single = added.groupBy(key).agg(F.min(F.struct(*rest)).alias("r")).select(key, "r.*")
    return current.unionByName(single)


def put(current: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """The table after replacing the rows of the given keys (one new row per key: the largest)."""
    rest = [c for c in current.columns if c != key]
    single = rows.groupBy(key).agg(F.max(F.struct(*rest)).alias("r")).select(key, "r.*")
    return current.join(single.select(key), key, "left_anti").unionByName(single)


def union_ids(*sets: DataFrame) -> DataFrame:
    """Distinct union."""
    return reduce(lambda a, b: a.unionByName(b), sets).distinct()


def common_ids(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct intersection."""
    return left.intersect(right)


def store_profiles(current: DataFrame, hosts: DataFrame, users: DataFrame, key: str = "rid") -> DataFrame:
    """The profile table after a lookup: only ids that it lacks are added, whatever their role. Of an id that was host and
    user in the batch the host's row counts, which knows the room."""
    return put_if_absent(put_if_absent(current, hosts, key), users, key)


def new_members(existing: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """Set add: the distinct keys that were not there before."""
    return rows.select(*keys).distinct().join(existing.select(*keys), keys, "left_anti")
