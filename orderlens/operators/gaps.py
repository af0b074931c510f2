"""Previous event per key (LAG) without one task per hot key.

``LAG(ts) OVER (PARTITION BY key ORDER BY ts, tiebreak)`` sends every row of a
key to one task.  Here the window runs per ``(key, day)``; the first row of
a day takes the last event of the key's previous non-empty day, found by a
window over per-day maxima (one row per key and day, from the same shuffle).  A key with a third of all rows is thus spread over its days.
Rows with a NULL timestamp sort first, as in the SQL (ASC = NULLS FIRST).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def previous_event(df: DataFrame, key: str, ts: str, tiebreak: str, out: str = "previous") -> DataFrame:
    """Add column ``out`` = the previous ``ts`` of the same ``key`` (NULL for the first)."""
    day = F.to_date(F.col(ts))
    rows = df.withColumn("_day", day)
    within = Window.partitionBy(key, "_day").orderBy(F.col(ts).asc_nulls_first(), F.col(tiebreak))
    rows = rows.withColumn("_prev_in_day", F.lag(ts).over(within)) \
               .withColumn("_first_in_day", F.row_number().over(within) == 1)
    # the last event of a day, from the same shuffled rows: one row per day goes on
    whole = within.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    days = Window.partitionBy(key).orderBy(F.col("_day").asc_nulls_first())
    per_day = rows.withColumn("_last", F.max(ts).over(whole)).filter("_first_in_day")
    carry = per_day.select(key, "_day", F.lag("_last").over(days).alias("_prev_day_last"))
    # NULL-date rows form their own (first) day; a NULL key or day needs a null-safe join
    joined = rows.join(carry, rows[key].eqNullSafe(carry[key]) & rows["_day"].eqNullSafe(carry["_day"]),
                       "left").drop(carry[key]).drop(carry["_day"])
    prev = F.when(F.col("_first_in_day"), F.col("_prev_day_last")).otherwise(F.col("_prev_in_day"))
    return joined.withColumn(out, prev).drop("_day", "_prev_in_day", "_first_in_day", "_prev_day_last")
