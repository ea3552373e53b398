"""The corpus pipeline: quality, exact and near copies, benchmark leaks, tokens.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept
and returns a DataFrame that is written as Parquet and read again as the next
stage's docs.  All stages but the last return the columns of ``documents``.

Rows with null or empty texts pass like any other row: the quality stage scores
them, exact copies of the empty text leave one row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickframe.llm import bpe, decontaminate, exact_dedup, near_dup, quality
from tickframe.llm.common import crc_mod, kept, split_by_keys, stored, table
from tickframe.llm.registry import vocabulary

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    # rows are told apart by id and text; rows that repeat both share one score
    bad = kept(lambda: quality.quality_scores(
        docs, table(spark, sf_dir, "labels"), crc_mod("doc_id", 4) == 2).where(
        "predicted = 0").select(F.col("doc_id").alias("__bad_id"),
                                F.col("text_hash").alias("__bad_hash")).distinct(), "rejected")
    text_hash = F.xxhash64(F.col("text"))
    some, rest = split_by_keys(docs, F.xxhash64(F.col("doc_id"), text_hash), bad.select(
        F.xxhash64("__bad_id", "__bad_hash").alias("key")), "doubted")
    good = some.join(bad, F.col("doc_id").eqNullSafe(F.col("__bad_id"))
                     & (text_hash == F.col("__bad_hash")), "left_anti")
    return rest.unionByName(good).select(*COLUMNS)


def drop_exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, that with the largest id."""
    return exact_dedup.drop_exact_copies(docs).select(*COLUMNS)


def drop_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies, that with the smallest id."""
    return near_dup.one_of_each(docs).select(*COLUMNS)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids of every document left."""
    return bpe.encode(docs, vocabulary("word_bpe_49k.json")).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("quality", keep_good),
    ("exact_dedup", drop_exact),
    ("near_dedup", drop_near),
    ("decontaminate", drop_leaks),
    ("bpe", tokenize),
]

# the quality classifier's fit is no SQL; tests/llm compare each stage with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs


def queries() -> dict:
    return {"pipeline": run}


def oracle_sql() -> dict:
    return {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
