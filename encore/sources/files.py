"""Files, tables, sockets and in-memory rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """Deal rows out by ``keys`` ahead of heavy per-row work, in partitions that adaptive execution sizes and, where a
    key is hot, splits."""
    return df.hint("rebalance", *keys)


def read_lines(spark: SparkSession, path: str, ends: str | None = None) -> DataFrame:
    """Lines of text files; ``ends`` is what ends a line (else each of line feed, carriage return and both)."""
    return (spark.read.option("lineSep", ends) if ends else spark.read).text(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """JSON lines; without a schema Spark infers it, which costs a pass over the files."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.json(path)


def stream_lines(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """New text files of a folder as they appear, at most ``max_files`` per batch."""
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def stream_parquet(spark: SparkSession, path: str, table: str | None = None, max_files: int | None = None) -> DataFrame:
    """New parquet files of a folder, or of a table in it that is one file or a folder of part files.

    The schema is that of the files already there. The file source takes folders and globs only, so the table's name
    goes in as a glob that matches nothing else.
    """
    target = f"{path}/{table}" if table else path
    reader = spark.readStream.schema(spark.read.parquet(target).schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(f"{path}/[{table[0]}]{table[1:]}" if table else path)


def stream_socket(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Lines of a text socket (development only: a socket cannot be replayed)."""
    return spark.readStream.format("socket").option("host", host).option("port", port).load()


def in_memory(spark: SparkSession, rows: list, schema: T.StructType | str, partitions: int | None = None) -> DataFrame:
    df = spark.createDataFrame(rows, schema)
    return df.repartition(partitions) if partitions else df


def jdbc_options(url: str, query: str, **more: str) -> dict[str, str]:
    """Options to read a query; pass user, password, driver and fetchsize as keywords."""
    return {"url": url, "query": query, **more}


def read_jdbc(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return spark.read.format("jdbc").options(**options).load()


def ensure_table(spark: SparkSession, name: str, columns: str, using: str = "parquet", location: str | None = None) -> None:
    """Create the catalog table unless it exists; ``using='hive'`` needs Hive support. With ``location`` its files lie there
    and stay when it is dropped."""
    at = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING {using}{at}")


def load_into(rows: DataFrame, name: str) -> DataFrame:
    """Append rows to a catalog table by column name, and scan it."""
    spark = rows.sparkSession
    columns = spark.table(name).columns
    rows.select(*columns).write.insertInto(name)
    return spark.table(name)


def store_dimension(rows: DataFrame, name: str, key: str, buckets: int, location: str | None = None) -> DataFrame:
    """A dimension as a catalog table, cut and sorted by its key into ``buckets`` files, and a scan of it.

    Joins on the key read it as it lies, without an exchange, and several such tables of the same number of buckets meet
    the same exchange of the other side. ``buckets`` is to be at least the session's number of shuffle partitions, or Spark
    prefers to exchange both sides; the rows of a bucket should fit an executor's share of memory.
    """
    spark = rows.sparkSession
    writer = rows.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).format("parquet").mode("overwrite")
    (writer.option("path", location) if location else writer).saveAsTable(name)
    return spark.table(name)


def read_key_values(spark: SparkSession, path: str, separator: str = "\u0001") -> DataFrame:
    """Delimited ``key, value`` text (key INT, value STRING)."""
    return spark.read.schema("key INT, value STRING").option("sep", separator).csv(path)
