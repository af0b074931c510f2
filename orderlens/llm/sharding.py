"""Operator 6: rendezvous sharding of stable keys over weighted shards (DataFrame functions only).

Each (key, shard) pair has a hash ``u`` in (0, 1); the key goes to the shard with the least
``-ln(u) / weight``.  Shares follow the weights, and a further shard only takes the keys for
which its own score is the least: no key moves between the old shards.

``slot`` numbers the rows of a shard without gaps.  Rows are spread over ``BINS`` bins per shard
by a hash of the whole record, the counts of the bins give each bin's first slot, and rows are
numbered inside their bin: no task sees a whole shard.  Equal records are counted first and
expanded last, so any number of repeated rows costs one row in the shuffles.

Cases: a null key is the empty key; a null text has no bytes (size 1, crc32 0); rows that
share a key share a shard and have slots of their own; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.llm.common import id_and_text

SHARDS = 8
# Bins per shard; a bin is numbered in one task.
BINS = 4096


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """The shard (0 to ``len(weights) - 1``) of a key."""
    if not weights or min(weights) <= 0:
        raise ValueError("weights must be positive")
    text = F.coalesce(key.cast("string"), F.lit(""))
    scores = []
    for s, w in enumerate(weights):
        u = (F.shiftrightunsigned(F.xxhash64(F.lit(s), text), 11) + F.lit(0.5)) / F.lit(float(1 << 53))
        scores.append(F.struct((-F.ln(u) / F.lit(float(w))).alias("score"), F.lit(s).alias("shard")))
    return (F.least(*scores) if len(scores) > 1 else scores[0])["shard"]


def assign(docs: DataFrame, shards: int = SHARDS, weights: Sequence[float] | None = None,
           grown_weight: float = 1.0, bins: int = BINS, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` for every row."""
    weights = list(weights or [1.0] * shards)
    raw = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    rows = id_and_text(docs, id_col, text_col).select(
        "doc_id", (F.octet_length(raw) + 1).cast("bigint").alias("size"), F.crc32(raw).alias("text_crc32"))
    placed = rows.select(
        "*", rendezvous(F.col("doc_id"), weights).alias("shard"),
        rendezvous(F.col("doc_id"), [*weights, grown_weight]).alias("grown_shard"),
        F.pmod(F.xxhash64("doc_id", "size", "text_crc32"), F.lit(bins)).cast("int").alias("bin"))
    totals = placed.groupBy("shard", "bin").agg(F.count("*").alias("in_bin"))
    # at most len(weights) * bins rows
    firsts = totals.select("shard", "bin", (F.sum("in_bin").over(
        Window.partitionBy("shard").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0))
        - F.col("in_bin")).alias("first"))
    same = placed.groupBy(*placed.columns).agg(F.count("*").alias("copies"))
    in_bin = Window.partitionBy("shard", "bin").orderBy(
        F.col("doc_id").asc_nulls_first(), "size", "text_crc32").rowsBetween(Window.unboundedPreceding, 0)
    numbered = same.withColumn("before", F.sum("copies").over(in_bin) - F.col("copies"))
    return (numbered.join(F.broadcast(firsts), ["shard", "bin"])
            .select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "grown_shard",
                    F.col("first"), F.col("before"),
                    F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("copies") - 1)).alias("k"))
            .select("doc_id", "size", "text_crc32", "law", "shard",
                    (F.col("first") + F.col("before") + F.col("k")).alias("slot"), "grown_shard"))
