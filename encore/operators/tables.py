"""Small table operators: retention, progress ledger, similar items, distance search."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from encore.functions.calendar import ntz_literal

# Seconds each kind of state is kept after its last write.
KEEP = {
    "board_scores": 7776000,
    "watch_minutes": 604800,
    "signin_days": 5184000,
    "emissions": 5184000,
    "profiles": 86000 * 40,
    "user_level": 86000 * 40,
}
EARTH_KM = 6372.797560856  # Fixed value: sphere radius of the distances


def expire_rows(df: DataFrame, written: str, ttl_seconds: int, now_u: int) -> DataFrame:
    """Rows last written less than ``ttl_seconds`` before ``now_u``.

    The bound is a literal on the bare column, so it reaches the scan.
    """
    bound = now_u - ttl_seconds
    kind = df.schema[written].dataType
    if isinstance(kind, T.TimestampNTZType):
        limit = ntz_literal(bound)
    elif isinstance(kind, T.TimestampType):
        limit = F.timestamp_seconds(F.lit(bound))
    else:
        limit = F.lit(bound)
    return df.where(F.col(written) > limit)


def resume_offsets(ledger: DataFrame, partitions: DataFrame) -> DataFrame:
    """Offset to resume every current (topic, group_id, partition) from.

    That of the newest ledger batch of the topic and group; 0 for partitions it lacks
    and for topics without a ledger.
    """
    newest = ledger.groupBy("topic", "group_id", "partition").agg(
        F.max(F.struct("batch_ms", "until_offset")).alias("n")
    )
    batch = F.max("n.batch_ms").over(Window.partitionBy("topic", "group_id"))
    last = newest.withColumn("_batch", batch).where(F.col("n.batch_ms") == F.col("_batch"))
    offsets = last.select("topic", "group_id", "partition", F.col("n.until_offset").alias("_offset"))
    joined = partitions.join(offsets, ["topic", "group_id", "partition"], "left")
    return joined.withColumn("from_offset", F.coalesce("_offset", F.lit(0).cast("bigint"))).drop("_offset")


def similar_items(similarity: DataFrame) -> DataFrame:
    """(aid_type, aids comma list) to one (aid, similar_aid) row per entry."""
    return similarity.select(F.col("aid_type").alias("aid"), F.explode(F.split("aids", ",")).alias("similar_aid"))


def with_similar(events: DataFrame, similarity: DataFrame, key: str) -> DataFrame:
    """Each event with its item's ``similar`` list, null for unknown items."""
    lists = similarity.select(F.col("aid_type").alias(key), F.split("aids", ",").alias("similar"))
    return events.join(lists, key, "left")


def distance_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance of points in degrees."""
    u = F.sin((F.radians(lat2) - F.radians(lat1)) / 2)
    v = F.sin((F.radians(lon2) - F.radians(lon1)) / 2)
    return 2 * EARTH_KM * F.asin(F.sqrt(u * u + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * v * v))


def within_radius(points: DataFrame, member: str, center, km: float, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Points within ``km`` of the member ``center`` (itself included), nearest first.

    The centre is one row, read first; its latitude band then is a plain range filter
    that a scan can use.
    """
    row = points.where(F.col(member) == center).select(lat, lon).first()
    if row is None:
        return points.withColumn("distance", F.lit(None).cast("double")).where(F.lit(False))
    degrees = km / EARTH_KM * 57.29577951308232
    band = points.where(F.col(lat).between(row[0] - degrees * 1.000001, row[0] + degrees * 1.000001))
    found = band.withColumn("distance", distance_km(F.lit(row[0]), F.lit(row[1]), F.col(lat), F.col(lon)))
    return found.where(F.col("distance") <= km).orderBy("distance", member)


def _band(lat: Column, height: float) -> Column:
    """Number of the band of latitudes, from the south pole."""
    last = math.ceil(180 / height) - 1
    return F.least(F.greatest(F.floor((lat + 90) / height), F.lit(0)), F.lit(last)).cast("int")


def _cells(band: Column, height: float) -> Column:
    """Cells of a band: as wide as it is high where it is narrowest, so the fewer the nearer to a pole."""
    south = band * height - 90
    edge = F.greatest(F.abs(south), F.abs(south + height))
    return F.greatest(F.floor(F.cos(F.radians(F.least(edge, F.lit(90.0)))) * (360 / height)), F.lit(1)).cast("int")


def _cell(lon: Column, cells: Column) -> Column:
    """The cell that holds a longitude; whole turns count as none, so cells wrap at the date line."""
    return F.pmod(F.floor((lon + 180) / 360 * cells), cells).cast("int")


def pairs_within(
    points: DataFrame, centres: DataFrame, member: str, centre: str, km: float, lat: str = "lat", lon: str = "lon"
) -> DataFrame:
    """Every (``centre``, ``member``, ``distance``) of points within ``km`` of a centre, in one equi join.

    Points lie in cells of a grid: bands of latitude as high as ``km``, cut into cells that get wider towards the poles
    and wrap at the date line. A centre asks for the cells that its circle can reach, a handful whatever its place, and
    only points of those cells meet it for the exact distance. Rows without a place are in no pair; ``km`` is less than
    a quarter of the way round. Points are dealt out evenly first, as the pairs are many times the bytes of either side.
    """
    height = max(km / EARTH_KM * 180 / math.pi * 1.000001, 1e-4)
    if height > 90:
        raise ValueError("a circle of more than a quarter of the way round has no grid")
    here = points.where(F.col(lat).isNotNull() & F.col(lon).isNotNull()).withColumn("_band", _band(F.col(lat), height))
    here = here.select(member, F.col(lat).alias("_lat"), F.col(lon).alias("_lon"), "_band", _cell(F.col(lon), _cells(F.col("_band"), height)).alias("_cell"))
    # The circle's reach in longitude: all of it where it holds a pole.
    reach = F.degrees(F.asin(F.least(F.lit(math.sin(math.radians(height))) / F.cos(F.radians(lat)), F.lit(1.0)))) * 1.000001
    reach = F.when(F.abs(lat) + height >= 90, F.lit(180.0)).otherwise(reach)
    last = math.ceil(180 / height) - 1
    asked = centres.where(F.col(lat).isNotNull() & F.col(lon).isNotNull()).select(centre, F.col(lat).alias("_clat"), F.col(lon).alias("_clon"), reach.alias("_reach"))
    band = _band(F.col("_clat"), height)
    asked = asked.withColumn("_band", F.explode(F.sequence(F.greatest(band - 1, F.lit(0)), F.least(band + 1, F.lit(last)))))
    asked = asked.withColumn("_n", _cells(F.col("_band"), height))
    first, end = (F.floor((F.col("_clon") + way * F.col("_reach") + 180) / 360 * F.col("_n")) for way in (-1, 1))
    steps = F.sequence(first, F.least(end, first + F.col("_n") - 1))
    asked = asked.withColumn("_cell", F.explode(steps)).withColumn("_cell", F.pmod("_cell", F.col("_n")).cast("int")).drop("_n", "_reach")
    met = here.hint("rebalance").join(asked, ["_band", "_cell"])
    found = met.withColumn("distance", distance_km(F.col("_clat"), F.col("_clon"), F.col("_lat"), F.col("_lon")))
    return found.where(F.col("distance") <= km).select(centre, member, "distance")
