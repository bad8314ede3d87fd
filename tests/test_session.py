"""Sizes of shuffles."""

from __future__ import annotations

from encore.session import PART_ROWS, STATE_ROWS, roomy, roomy_state


def test_shuffle_partitions_grow_with_the_rows(spark):
    few = roomy(spark, 10)
    assert few == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert roomy(spark, 7_000 * PART_ROWS + 1) == 7_001
    assert spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum") == "7001"
    assert roomy(spark, 10) == few
    assert spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum") == str(few)


def test_state_partitions_grow_with_the_rows(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with roomy_state(spark, 9 * STATE_ROWS + 1) as parts:
        assert parts == 10 and spark.conf.get("spark.sql.shuffle.partitions") == "10"
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    with roomy_state(spark, 1) as parts:
        assert parts == int(before)
