"""RANK inside groups without one task per group.

``RANK() OVER (PARTITION BY g ORDER BY x)`` sends all rows of a group to one task.  Here the distinct
values of each (group, measure) are counted first, so ties of any size are one row, and the values are cut
into buckets by approximate quantiles of the whole column (only the cuts, a fixed number, are looked at
beforehand).  A rank is then one plus the rows in the group's lower buckets (a table of at most groups x
buckets rows, prefix sums in an array per group) plus the rows below it in its own bucket (a window by group
*and* bucket).  A group that holds nearly all rows is thus spread over all buckets.  Equal values share a
bucket, so the cuts decide only the balance, never a rank.

All measures of a call go through the same exchanges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKETS = 128
_LAST = float("inf")


def ascending(c: Column) -> Column:
    """Sort key of a finite number, smallest first, NULL before all."""
    return F.coalesce(c.cast("double"), F.lit(-_LAST))


def descending(c: Column) -> Column:
    """Sort key of a finite number, largest first, NULL after all."""
    return F.coalesce(F.lit(0.0) - c.cast("double"), F.lit(_LAST))


def _lower_rows(values: DataFrame, group: str) -> DataFrame:
    """``_below``: rows of the group's lower buckets, for each (group, measure, bucket)."""
    sums = values.groupBy(group, "_w", "_b").agg(F.sum("_n").alias("_s"))
    lists = sums.groupBy(group, "_w").agg(F.sort_array(F.collect_list(F.struct("_b", "_s"))).alias("_l"))  # at most BUCKETS
    before = F.transform("_l", lambda e, i: F.struct(e["_b"].alias("_b"), F.aggregate(
        F.slice("_l", F.lit(1), i), F.lit(0).cast("bigint"), lambda a, x: a + x["_s"]).alias("_below")))
    return lists.select(F.col(group).alias("_og"), F.col("_w").alias("_ow"), F.explode(before).alias("_e")).select(
        "_og", "_ow", F.col("_e._b").alias("_ob"), F.col("_e._below").alias("_below"))


def ranks_within(df: DataFrame, keys: list[str], group: str, measures: dict[str, Column], buckets: int = BUCKETS) -> DataFrame:
    """``df`` with a BIGINT rank per entry of ``measures`` (name -> sort key, see ``ascending``/``descending``).

    ``keys`` identify a row; NULL groups and keys are values like any other."""
    names = list(measures)
    at = [k / buckets for k in range(1, buckets)]
    cuts = df.agg(F.array(*[F.percentile_approx(m, at, 1000) for m in measures.values()]).alias("_c")).select(
        F.posexplode("_c").alias("_cw", "_cuts"))                     # a row per measure
    entries = F.array(*[F.struct(F.lit(k).alias("_w"), m.alias("_x")) for k, m in enumerate(measures.values())])
    long = df.withColumn("_e", F.explode(entries)).select(*df.columns, "_e._w", "_e._x")
    bucket = F.size(F.filter("_cuts", lambda c: c < F.col("_x")))
    values = (long.groupBy(group, "_w", "_x").agg(F.count(F.lit(1)).alias("_n"))
              .join(F.broadcast(cuts), F.col("_w") == F.col("_cw")).withColumn("_b", bucket).drop("_cw", "_cuts"))
    inside = Window.partitionBy(group, "_w", "_b").orderBy("_x").rowsBetween(Window.unboundedPreceding, -1)
    lower = _lower_rows(values, group)
    ranked = (values.withColumn("_inside", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
              .join(lower, F.col(group).eqNullSafe(F.col("_og")) & (F.col("_w") == F.col("_ow")) & (F.col("_b") == F.col("_ob")))
              .select(F.col(group).alias("_rg"), F.col("_w").alias("_rw"), F.col("_x").alias("_rx"),
                      (F.col("_below") + F.col("_inside") + 1).cast("bigint").alias("_rank")))
    back = long.join(ranked, F.col(group).eqNullSafe(F.col("_rg")) & (F.col("_w") == F.col("_rw"))
                     & (F.col("_x") == F.col("_rx")), "left")
    if len(names) == 1:
        return back.select(*df.columns, F.col("_rank").alias(names[0]))
    rest = [c for c in df.columns if c not in keys]
    whole = F.first(F.when(F.col("_w") == 0, F.struct(*rest)), ignorenulls=True).alias("_rest") if rest else F.lit(None).alias("_rest")
    out = back.groupBy(*keys).agg(whole, *[F.max(F.when(F.col("_w") == k, F.col("_rank"))).alias(n)
                                           for k, n in enumerate(names)])
    columns = [F.col(c) if c in keys else F.col(f"_rest.{c}").alias(c) for c in df.columns]
    return out.select(*columns, *names)
