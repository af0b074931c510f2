"""Registered queries of the operators: each applies its operator, with production
parameters, to the whole of its tables, and derives the digest columns."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.llm import (byte_bpe, decontaminate, hard_negatives, html_extract, language_id, line_dedup, near_dups,
                           periodic_runs, quality_rules, secret_scan, sharding, token_files, toxicity)
from orderlens.llm.common import read_table

Query = Callable[[SparkSession, str], DataFrame]


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip(_documents(spark, sf_dir))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(_documents(spark, sf_dir), read_table(spark, sf_dir, "benchmark"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(_documents(spark, sf_dir))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(_documents(spark, sf_dir))


def op5_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.groups(_documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id", "kept")


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(_documents(spark, sf_dir))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    return language_id.predict(docs, language_id.fit(docs))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.report(_documents(spark, sf_dir))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    return toxicity.score(docs, toxicity.fit(docs, read_table(spark, sf_dir, "labels")))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(_documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "posterior")


def op11_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(read_table(spark, sf_dir, "pages"))


def _planted(doc_id: object, n: int) -> np.ndarray | None:
    """The contract's periodic tail: in a tenth of the documents words repeat from some place on."""
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    i = np.arange(n)
    return np.where(i < a, i, a + (i - a) % (1 + (n - a) // (3 + g % 8)))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.find(_documents(spark, sf_dir), rewrite=_planted)
    # the longest run; ties: smallest start, then period
    best = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", *(
        r[k].cast("string") for k in ("start", "length", "period"))), F.lit("\n")))
    return (found.withColumn("best", best)
            .withColumns({"start": -F.col("best.start"), "length": F.col("best.length"), "period": -F.col("best.period")})
            .select("doc_id", F.size("runs").cast("long").alias("n_runs"), "start", "length", "period",
                    F.expr("1000 * length div period").alias("exponent_milli"),
                    F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
                    F.sha2("collapsed", 256).alias("collapsed_sha256")))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(vectors.withColumn("label", moved), F.col("id") % 100 == 0)


QUERIES: dict[str, Query] = {q.__name__: q for q in (
    op1_byte_bpe, op2_decontaminate, op3_secret_scan, op4_token_files, op5_near_dups, op6_sharding,
    op7_language_id, op8_line_dedup, op9_toxicity, op10_quality_rules, op11_html_extract,
    op12_periodic_runs, op13_hard_negatives)}

ORACLES: dict[str, str] = {"op2_decontaminate": decontaminate.ORACLE_SQL, "op5_near_dups": near_dups.ORACLE_SQL,
                           "op8_line_dedup": line_dedup.ORACLE_SQL,
                           "op13_hard_negatives": hard_negatives.ORACLE_SQL}
