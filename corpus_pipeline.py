"""The corpus pipeline: five operators of ``orderlens.llm`` one after the other.

``STAGES`` lists (name, function).  Each function takes (spark, docs, sf_dir) and returns a
DataFrame, which is written as Parquet and read again as the next one's ``docs``; all but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.llm import byte_bpe, decontaminate, language_id, line_dedup, near_dups
from orderlens.llm.common import materialise, read_table, ship


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is rejected go."""
    ship(spark)
    return language_id.keep_identified(docs, language_id.fit(docs))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs are deleted; documents that this empties go."""
    ship(spark)
    out = line_dedup.clean(docs, drop_emptied=True)
    if "n_chars" in out.columns:                    # the length of the text that is left
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out


def near_dup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (similarity 0.8 or more) stays."""
    ship(spark)
    return near_dups.keep_one(docs, percent=80)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    ship(spark)
    return decontaminate.clean(docs, read_table(spark, sf_dir, "benchmark"))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of what is left."""
    ship(spark)
    return byte_bpe.round_trip(docs)


STAGES = [
    ("language_id", language_stage),
    ("line_dedup", line_stage),
    ("near_dups", near_dup_stage),
    ("decontaminate", benchmark_stage),
    ("byte_bpe", token_stage),
]

# Language, near-duplicate and tokenizer stages are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = materialise(docs, f"pipeline_{name}")
    return docs
