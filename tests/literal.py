"""Literal forms of the operators (one task or quadratic per key): for small inputs and equivalence tests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def window_ntile(df: DataFrame, n: int, order: Sequence[Column], out: str) -> DataFrame:
    """Reference form (single partition); for small inputs and equivalence tests."""
    return df.withColumn(out, F.ntile(n).over(Window.orderBy(*order)).cast("bigint"))


def item_pairs_join(tx: DataFrame, band_days: int = 30, min_keys: int = 10) -> DataFrame:
    """Literal self-join (quadratic per customer): small inputs and equivalence tests only."""
    t1 = tx.select(F.col("customer_id").alias("k"), F.col("cuisine_type").alias("item_1"),
                   F.col("order_value").alias("v1"), F.col("order_date").alias("t1"))
    t2 = tx.select(F.col("customer_id").alias("k2"), F.col("cuisine_type").alias("item_2"),
                   F.col("order_value").alias("v2"), F.col("order_date").alias("t2"))
    j = t1.join(t2, (F.col("k") == F.col("k2")) & (F.col("item_1") != F.col("item_2"))
                & (F.abs(F.datediff("t1", "t2")) <= band_days))
    v = F.col("v1") + F.col("v2")
    return (j.groupBy("item_1", "item_2")
            .agg(F.count_distinct("k").alias("keys"), F.count(F.lit(1)).alias("pairs"),
                 F.count(v).alias("valued_pairs"), F.sum(v).alias("value_sum"))
            .filter(F.col("keys") >= min_keys))


def previous_event_window(df: DataFrame, key: str, ts: str, tiebreak: str,
                          out: str = "previous") -> DataFrame:
    """Literal single-window form (for small inputs and equivalence tests)."""
    w = Window.partitionBy(key).orderBy(F.col(ts).asc_nulls_first(), F.col(tiebreak))
    return df.withColumn(out, F.lag(ts).over(w))
