"""Corpus pipeline: quality rules, near-duplicates, repeated passages, benchmark passages, token encoding.

Every stage takes ``(spark, docs, sf_dir)``, works on all that its predecessor kept, and all but the last
return the columns of ``documents``. The first two leave out documents; the next two take passages out of
texts, and rows stay; the last returns the token ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourglass.llm import bpe, decontaminate, line_rules, lsh_forest, substring
from hourglass.llm.storage import decided, written
from hourglass.llm.text import row_key
from hourglass.session import configure


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules, or that frequent lines deplete, go. A group of near copies, of which the
    next stage keeps one, counts once for a line."""
    rejected = decided(spark, "rejected", lambda: line_rules.line_rules(docs, near_copies=True).filter("NOT kept").select(
        F.col("row_key").alias("__rejected")))
    keyed = docs.withColumn("__row_key", F.xxhash64("doc_id", "source", "text"))
    return keyed.join(rejected, F.col("__row_key") == F.col("__rejected"), "left_anti").drop("__row_key")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group stays, the one with the smallest id (and row key); rows of equal id and text are one.
    Rows without words belong to no group."""
    decisions = decided(spark, "gone", lambda: _row_decisions(docs))
    keyed = docs.withColumn("__row_key", row_key("doc_id", "text"))
    once = keyed.join(decisions, F.col("__row_key") == F.col("__key"), "left_anti")
    again = decisions.filter("NOT __gone")
    if not again.isEmpty():
        # the rows that are listed more than once and stay, by partial aggregation
        once = once.unionByName(keyed.join(again, F.col("__row_key") == F.col("__key"), "left_semi").dropDuplicates(["__row_key"]))
    return once.drop("__row_key")


def _row_decisions(docs: DataFrame) -> DataFrame:
    """``__key`` of the rows that go (``__gone``) and of those that stay once of several."""
    rows = lsh_forest.near_duplicates(docs, idless=True).filter("n_shingles > 0")
    gone = rows.filter("NOT chosen").select("row_key").distinct().withColumn("__gone", F.lit(True))
    again = lsh_forest.repeated_keys(rows.filter("chosen")).withColumn("__gone", F.lit(False))
    return gone.unionByName(again).withColumnRenamed("row_key", "__key")


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 35 words and more that occur elsewhere are taken out."""
    return substring.remove_repeats(docs).withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of benchmark items are taken out."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.decontaminate(docs, benchmark).withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, with the digests of the ids and of what they decode to."""
    return bpe.encode(docs)


STAGES = [("quality_rules", quality_rules), ("near_duplicates", near_duplicates), ("substring_dedup", substring_dedup),
          ("decontamination", decontamination), ("byte_bpe", byte_bpe)]

#: SQL cannot express the byte pair merges; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
