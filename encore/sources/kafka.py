"""Kafka as source and sink. Needs the Spark Kafka connector on the class path; no default endpoints."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.readwriter import DataStreamWriter


def subscribe_options(
    servers: str,
    topics: str | list[str],
    group_id: str | None = None,
    starting: str = "earliest",
    max_records: int | None = None,
    separator: str = ",",
) -> dict[str, str]:
    """Options for whole topics; ``topics`` may be a list or text split on ``separator``."""
    names = topics.split(separator) if isinstance(topics, str) else topics
    out = {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(name.strip() for name in names),
        "startingOffsets": starting,
    }
    if group_id:
        out["groupIdPrefix"] = group_id
    if max_records:
        out["maxOffsetsPerTrigger"] = str(max_records)
    return out


def assign_options(servers: str, offsets: dict[str, dict[int, int]], max_records: int | None = None) -> dict[str, str]:
    """Options for chosen partitions, each from its own offset."""
    partitions = {topic: sorted(parts) for topic, parts in offsets.items()}
    starts = {topic: {str(p): parts[p] for p in sorted(parts)} for topic, parts in offsets.items()}
    out = {
        "kafka.bootstrap.servers": servers,
        "assign": json.dumps(partitions),
        "startingOffsets": json.dumps(starts),
    }
    if max_records:
        out["maxOffsetsPerTrigger"] = str(max_records)
    return out


def offsets_of(resumed: DataFrame) -> dict[str, dict[int, int]]:
    """Resume offsets (one row per topic partition) as :func:`assign_options` wants them."""
    out: dict[str, dict[int, int]] = {}
    for row in resumed.select("topic", "partition", "from_offset").collect():
        out.setdefault(row.topic, {})[row.partition] = row.from_offset
    return out


def read_stream(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Record values as text, column ``value``."""
    stream = spark.readStream.format("kafka").options(**options).load()
    return stream.select(F.col("value").cast("string").alias("value"))


def read_batch(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """The same records as a bounded table."""
    return spark.read.format("kafka").options(**options).load().select(F.col("value").cast("string").alias("value"))


def write_stream(messages: DataFrame, servers: str, topic: str, checkpoint: str) -> DataStreamWriter:
    """Writer sending column ``value`` to a topic; call ``start()`` on it."""
    return (
        messages.select("value")
        .writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
    )
