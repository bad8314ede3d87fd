"""The corpus pipeline: filter by quality, keep one of near copies, decontaminate, redact personal data, pack."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from encore.llm import decontaminate, jaccard, packing, personal, quality
from encore.llm.common import fold, saved, table

DOCUMENT = ["doc_id", "text", "lang", "source", "n_chars"]


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score at least the threshold; the classifier learns from the labels of its input."""
    scored = quality.classify(docs, table(spark, sf_dir, "labels"), learn=fold("doc_id", 5) != 0, keep=DOCUMENT)
    return scored.where(F.col("score") >= quality.THRESHOLD).select(DOCUMENT)


def keep_one(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near copies the document with the smallest id.

    Repeated rows count as copies; rows without an id or without words stay. Rows of one id with different texts are judged
    each by its own text. Texts are shuffled only where a table of
    fixed size tells that their id may be one to drop or to look at twice.
    """
    docs = docs.select(DOCUMENT)
    found = saved(jaccard.join(docs, key="key"), "components")
    rows = found.where("doc_id is not null").groupBy("doc_id", "key").agg(F.count("*").alias("rows"), F.min("component_id").alias("component_id"))
    touched = saved(rows.where("rows > 1 or component_id <> doc_id"), "touched")
    # None for rows without an id, so they are clear.
    mark = F.when(F.col("doc_id").isNotNull(), F.pmod(F.xxhash64("doc_id"), F.lit(jaccard.MARKS)))
    marks = F.broadcast(touched.select(mark.alias("mark")).distinct())  # at most MARKS rows
    marked = docs.withColumn("mark", mark)
    clear = marked.join(marks, "mark", "left_anti").drop("mark")
    looked = marked.join(marks, "mark", "left_semi").drop("mark")
    gone = touched.where("component_id <> doc_id").select("doc_id", "key")
    looked = looked.withColumn("key", F.xxhash64("text")).join(gone, ["doc_id", "key"], "left_anti").drop("key")
    return clear.unionByName(looked.dropDuplicates(["doc_id", "text"])).select(DOCUMENT)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    found = decontaminate.decontaminate(docs.select(DOCUMENT), table(spark, sf_dir, "benchmark"))
    return found.where(~F.col("contaminated")).select(DOCUMENT)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    found = personal.find(docs.select(DOCUMENT), detector=personal.learn(docs), redact="text")
    return found.withColumn("n_chars", F.length("text").cast("long")).select(DOCUMENT)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents, placed in sequences."""
    return packing.pack(docs).drop("bears_loss")


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", keep_one),
    ("decontamination", drop_contaminated),
    ("personal_data", redact),
    ("packing", pack),
]

#: SQL expresses neither the classifier nor the tokenizer; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
