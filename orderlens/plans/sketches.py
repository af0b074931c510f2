"""Distinct counts from mergeable sketches, an opt-in beside the exact ones.

Exact distinct customers of a window need the facts of that window each time.  ``write_sketches`` keeps one row per
(day, city) with theta sketches of the customers, restaurants and orders seen; a window of any length is the
union of its rows, and what is new in a window the difference of two unions.  The sketches hold at most
``2 ** NOMINAL`` hashes, so a row's size is bounded, and the relative standard error of a union is about
``2 ** (-NOMINAL / 2)`` (0.8 % at 14; exact below that many keys).  The table is partitioned by month: a window reads its
sketch rows only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates as D

NOMINAL = 14
_KEYS = {"customers": "customer_id", "restaurants": "restaurant_id", "orders": "order_id"}


def sketches(tx: DataFrame) -> DataFrame:
    """One row per (day, city): a sketch per kind of key, with the month for partitioning."""
    rows = tx.filter(F.col("order_date").isNotNull())
    return (rows.groupBy(F.to_date("order_date").alias("order_day"), "city")
            .agg(*[F.theta_sketch_agg(c, NOMINAL).alias(k) for k, c in _KEYS.items()])
            .withColumn(D.PARTITION_COLUMN, F.date_format("order_day", "yyyy-MM")))


def write_sketches(tx: DataFrame, path: str) -> None:
    (sketches(tx).hint("rebalance", D.PARTITION_COLUMN).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(D.PARTITION_COLUMN).parquet(path))


def read_sketches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def _window(rows: DataFrame, lower, upper=None) -> DataFrame:
    out = rows.filter((F.col("order_day") >= lower) & (F.col(D.PARTITION_COLUMN) >= F.date_format(lower, "yyyy-MM")))
    if upper is not None:
        out = out.filter((F.col("order_day") < upper) & (F.col(D.PARTITION_COLUMN) <= F.date_format(upper, "yyyy-MM")))
    return out


def _estimate(c: str) -> F.Column:
    return F.theta_sketch_estimate(F.theta_union_agg(c, NOMINAL))


def distinct_counts(rows: DataFrame, as_of, months: int = 12) -> DataFrame:
    """Per city: estimated distinct customers, restaurants and orders of the trailing window."""
    w = _window(rows, D.months_back(as_of, months))
    return w.groupBy("city").agg(*[_estimate(k).alias(k) for k in _KEYS])


def monthly_counts(rows: DataFrame, as_of, months: int = 12) -> DataFrame:
    """The same per city and month (the distinct counts behind the growth table)."""
    w = _window(rows, D.months_back(as_of, months))
    return w.groupBy("city", F.col(D.PARTITION_COLUMN).alias("month")).agg(*[_estimate(k).alias(k) for k in _KEYS])


def new_customers(rows: DataFrame, as_of, days: int = 30, months: int = 12) -> DataFrame:
    """Per city: customers of the last ``days`` that did not order in the ``months`` before."""
    since, start = D.days_back(as_of, days), D.months_back(as_of, months)
    recent = _window(rows, since).groupBy("city").agg(F.theta_union_agg("customers", NOMINAL).alias("recent"))
    before = (_window(rows, start, since).groupBy(F.col("city").alias("_c"))
              .agg(F.theta_union_agg("customers", NOMINAL).alias("before")))
    both = recent.join(before, F.col("city").eqNullSafe(F.col("_c")), "left")
    new = F.when(F.col("before").isNull(), F.theta_sketch_estimate("recent")).otherwise(
        F.theta_sketch_estimate(F.theta_difference("recent", "before")))
    return both.select("city", F.theta_sketch_estimate("recent").alias("customers"), new.alias("new_customers"))
