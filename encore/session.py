"""Session settings and the shared work folder."""

from __future__ import annotations

import atexit
import gc
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


#: Input rows of one shuffle partition of the boards: a row of a table becomes tens of rows of short, well packed columns, so
#: that a task holds many times the bytes it reads.
PART_ROWS, PART_BYTES = 100_000, "16m"
#: Input rows of one partition of a stream's state, over all its batches: fewer and larger ones, as each is a store of its own.
STATE_ROWS = 500_000
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(app: str = "encore", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are tuned for.

    Adaptive execution sizes the shuffles (and splits skewed join partitions), so
    ``spark.sql.shuffle.partitions`` is only the upper bound it starts from.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.ui.enabled", "false")
        # Python workers and state processors talk over files of the machine, not ports.
        .config("spark.python.unix.domain.socket.enabled", "true")
        # Streaming state outside the heap; top lists keep their group limit up to this length.
        .config("spark.sql.streaming.stateStore.providerClass", ROCKS)
        .config("spark.sql.optimizer.windowGroupLimitThreshold", "100000")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the cluster's shared ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of its own machine, which goes when the driver ends.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="encore-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
    return os.path.join(root, f"{purpose}-{uuid.uuid4().hex}")


def roomy(spark: SparkSession, rows: int) -> int:
    """Shuffles of batch queries begin with a partition for every :data:`PART_ROWS` of ``rows``, or the session's number if that
    is larger, and adaptive execution merges them up to :data:`PART_BYTES` unless the session has a size of its own.

    So what a task holds stays the same while the tables grow. Returns that number.
    """
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // PART_ROWS))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(parts))
    if spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", None) is None:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", PART_BYTES)
    return parts


@contextmanager
def roomy_state(spark: SparkSession, rows: int) -> Iterator[int]:
    """Streams started inside have a state partition for every :data:`STATE_ROWS` of the ``rows`` that are to come, or the session's
    number if that is larger: a stream has no adaptive execution, so its tasks would grow with the table, and spill. The session's
    number is as before afterwards; a checkpoint keeps the number that it was begun with.
    """
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    parts = max(int(before), -(-rows // STATE_ROWS))
    spark.conf.set(name, str(parts))
    try:
        yield parts
    finally:
        spark.conf.set(name, before)


def release(spark: SparkSession) -> None:
    """Let the shuffle files of jobs that have ended go now: Spark removes them as the driver's garbage is collected, which a roomy
    heap puts off for the whole session."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def saved(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared folder and read again, so that its rows and their parts stay what they are."""
    path = work_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def importable(spark: SparkSession) -> None:
    """Let Python workers on machines that have this package where the driver has it import it, from whatever folder the
    driver was started. Elsewhere ship the package with the job."""
    root, env = os.path.dirname(os.path.dirname(os.path.abspath(__file__))), spark.sparkContext.environment
    places = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in places:
        env["PYTHONPATH"] = os.pathsep.join([*places, root])
