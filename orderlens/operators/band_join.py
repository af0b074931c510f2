"""Cuisine pairs ordered by one customer within a day band.

Reference semantics: self-join of the orders on ``customer_id``, different
cuisines, ``|DATEDIFF(d1, d2)| <= band``; per ordered cuisine pair: distinct
customers, and the mean of ``v1 + v2`` over the joined order pairs.

Scalable form (no order pairs are materialised):

1. pre-aggregate orders into day cells ``(customer, cuisine, day)`` with row
   count, valued-row count and value sum.  This combines map-side, so a
   customer holding a third of all orders still yields at most
   days x cuisines cells;
2. band-join cells on ``(customer, day bucket)``: buckets are ``band + 1``
   days wide and each right cell is copied to its neighbour buckets, so every
   pair of cells within the band meets exactly once and a hot customer is
   spread over its buckets;
3. pair statistics follow from cell statistics:
   pairs = n1*n2, value sum = s1*m2 + m1*s2 over valued rows (m).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def day_cells(tx: DataFrame, key: str = "customer_id", item: str = "cuisine_type",
              value: str = "order_value", ts: str = "order_date", keep_nulls: bool = False) -> DataFrame:
    """(key, item, day) cells: rows ``n``, valued rows ``m``, value sum ``s``.

    ``keep_nulls=True`` keeps NULL keys/items/days as their own cells, so the
    same cells can also feed a SQL ``GROUP BY`` (which groups NULLs).
    """
    src = tx if keep_nulls else tx.filter(F.col(key).isNotNull() & F.col(item).isNotNull()
                                          & F.col(ts).isNotNull())
    return (src.groupBy(F.col(key).alias("k"), F.col(item).alias("item"),
                        F.unix_date(F.to_date(ts)).alias("day"))
            .agg(F.count(F.lit(1)).alias("n"), F.count(value).alias("m"),
                 F.sum(value).alias("s")))


def item_pairs_per_key(tx: DataFrame | None = None, band_days: int = 30, cells: DataFrame | None = None,
                       **cols) -> DataFrame:
    """Per (key, item_1, item_2): joined order pairs, valued pairs, value sum."""
    if cells is None:
        cells = day_cells(tx, **cols)
    else:
        cells = cells.filter(F.col("k").isNotNull() & F.col("item").isNotNull() & F.col("day").isNotNull())
    width = band_days + 1
    bucket = F.floor(F.col("day") / width)
    left = cells.select("k", F.col("item").alias("item_1"), F.col("day").alias("d1"),
                        F.col("n").alias("n1"), F.col("m").alias("m1"),
                        F.col("s").alias("s1"),
                        # exploded like the other side: both then read one exchange of cells
                        F.explode(F.array(bucket)).alias("b"))
    right = cells.select("k", F.col("item").alias("item_2"), F.col("day").alias("d2"),
                         F.col("n").alias("n2"), F.col("m").alias("m2"),
                         F.col("s").alias("s2"),
                         F.explode(F.array(bucket - 1, bucket, bucket + 1)).alias("b"))
    joined = left.join(right, ["k", "b"]).filter(
        (F.col("item_1") != F.col("item_2")) & (F.abs(F.col("d1") - F.col("d2")) <= band_days))
    return (joined.groupBy("k", "item_1", "item_2")
            .agg(F.sum(F.col("n1") * F.col("n2")).alias("pairs"),
                 F.sum(F.col("m1") * F.col("m2")).alias("valued_pairs"),
                 F.sum(F.col("s1") * F.col("m2") + F.col("s2") * F.col("m1")).alias("value_sum")))


def item_pairs(tx: DataFrame | None = None, band_days: int = 30, min_keys: int = 10,
               cells: DataFrame | None = None, **cols) -> DataFrame:
    """Per ordered item pair: distinct keys, pairs, and exact pair value sum."""
    per_key = item_pairs_per_key(tx, band_days, cells, **cols)
    return (per_key.groupBy("item_1", "item_2")
            .agg(F.count(F.lit(1)).alias("keys"), F.sum("pairs").alias("pairs"),
                 F.sum("valued_pairs").alias("valued_pairs"),
                 F.sum("value_sum").alias("value_sum"))
            .filter(F.col("keys") >= min_keys))
