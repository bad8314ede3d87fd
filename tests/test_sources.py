"""Sources and session; nothing here opens a port."""

from __future__ import annotations

import json

import pytest

from encore import session
from encore.sources import files, kafka
from encore.operators import tables
from encore.streaming import sinks


def test_subscribe_options():
    got = kafka.subscribe_options("h:1", "a, b", group_id="g", starting="latest", max_records=500)
    assert got == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "a,b", "startingOffsets": "latest",
        "groupIdPrefix": "g", "maxOffsetsPerTrigger": "500",
    }
    assert kafka.subscribe_options("h:1", "a-b", separator="-")["subscribe"] == "a,b"


def test_assign_from_resumed_offsets(spark):
    ledger = spark.createDataFrame(
        [("t", "g", 0, 5, 1)], "topic string, group_id string, partition int, until_offset bigint, batch_ms bigint"
    )
    now = spark.createDataFrame([("t", "g", 0), ("t", "g", 1)], "topic string, group_id string, partition int")
    got = kafka.assign_options("h:1", kafka.offsets_of(tables.resume_offsets(ledger, now)))
    assert json.loads(got["assign"]) == {"t": [0, 1]}
    assert json.loads(got["startingOffsets"]) == {"t": {"0": 5, "1": 0}}


def test_files_and_memory(spark, tmp_path):
    (tmp_path / "a.txt").write_text("x\ny\n")
    (tmp_path / "a.json").write_text('{"name":"Ann","age":20}\n{"name":"Bob"}\n')
    assert [r.value for r in files.read_lines(spark, str(tmp_path / "a.txt")).collect()] == ["x", "y"]
    people = files.read_json(spark, str(tmp_path / "a.json"))
    assert [(r.name, r.age) for r in people.collect()] == [("Ann", 20), ("Bob", None)]
    assert files.in_memory(spark, [(1,), (2,), (3,)], "v int", partitions=3).rdd.getNumPartitions() == 3


def test_table_is_created_loaded_and_scanned(spark, tmp_path):
    (tmp_path / "kv.txt").write_text("238\u0001val_238\n86\u0001val_86\n")
    spark.sql("DROP TABLE IF EXISTS src")
    for _ in range(2):
        files.ensure_table(spark, "src", "key INT, value STRING")
    rows = files.load_into(files.read_key_values(spark, str(tmp_path / "kv.txt")), "src")
    assert sorted(map(tuple, rows.collect())) == [(86, "val_86"), (238, "val_238")]
    spark.sql("DROP TABLE src")


def test_jdbc_options():
    got = files.jdbc_options("jdbc:x:y", "select aid_type, aids from similarity", user="u")
    assert got == {"url": "jdbc:x:y", "query": "select aid_type, aids from similarity", "user": "u"}


def test_dealing_out_is_adaptive(spark):
    dealt = files.dealt(spark.range(0, 100, 1, 1), "id")
    plan = dealt._jdf.queryExecution().executedPlan().toString()
    assert "REBALANCE_PARTITIONS_BY_COL" in plan and "REPARTITION_BY_NUM" not in plan
    assert dealt.count() == 100


def test_streams_read_a_table_that_is_a_file_or_a_folder(spark, tmp_path):
    rows = spark.range(60).selectExpr("id", "id % 7 AS v")
    rows.repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    rows.limit(5).write.parquet(str(tmp_path / "revents.parquet"))
    stream = files.stream_parquet(spark, str(tmp_path), "events.parquet", max_files=1)
    query = sinks.start_log(stream, str(tmp_path / "log"), str(tmp_path / "progress"))
    query.awaitTermination()
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == 3
    got = sinks.read_batches(spark, str(tmp_path / "log"), "id bigint, v bigint").drop("batch_id")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, rows.collect()))


def test_work_folder_is_below_the_shared_one(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = session.work_dir(spark, "x"), session.work_dir(spark, "x")
    assert first.startswith(root) and first != second


def test_work_folder_needs_a_shared_one_on_a_cluster():
    class Conf:
        def get(self, key, default):
            return default

    class Context:
        master = "yarn"

    class Cluster:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError):
        session.work_dir(Cluster(), "x")
