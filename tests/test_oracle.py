"""Every catalogue query against DuckDB, and the shape of its plan."""

from __future__ import annotations

import pytest
from compare import difference, oracle_connection

import __spark_entry__ as entry_points
from encore.plans.oracle import ORACLE
from encore.plans.queries import CATALOGUE as QUERIES


@pytest.fixture(scope="module")
def con(sf):
    return oracle_connection(sf)


def test_every_oracle_has_a_query():
    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(entry_points.queries()) and set(ORACLE) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle(spark, sf, con, name):
    result = QUERIES[name](spark, sf).toPandas()
    assert len(result) > 0
    assert difference(result, con.execute(ORACLE[name]).fetchdf()) is None


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith("stream_")))
def test_plan_has_no_cross_join(spark, sf, name):
    plan = QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "NestedLoopJoin" not in plan
    assert "REPARTITION_BY_NUM" not in plan or name == "source_memory"  # its partition count is the feature


def test_entry(spark):
    assert entry_points.entry(spark).limit(5).count() == 5


@pytest.fixture(scope="module")
def folders(spark, sf, tmp_path_factory):
    """The tables as folders of three part files each."""
    place = tmp_path_factory.mktemp("parts")
    for name in ("lineitem", "orders", "part", "supplier", "customer", "events", "conversations"):
        spark.read.parquet(f"{sf}/{name}.parquet").repartition(3).write.parquet(f"{place}/{name}.parquet")
    return str(place)


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n.startswith("stream_")))
def test_streams_read_folder_tables(spark, sf, con, folders, name):
    result = QUERIES[name](spark, folders).toPandas()
    assert difference(result, con.execute(ORACLE[name]).fetchdf()) is None
