"""The tables behind each dashboard chart and card.

``dashboard_frame`` reproduces the page's data: the last 90 days before
``as_of``, then the selected calendar-day range and city.  Means follow
pandas (NULLs skipped); ``.round(2)`` is exact half-even on DECIMAL.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions.rounding import exact_mean, round_half_even
from ..operators.percentile import percentiles
from .api import daily_summary, filter_orders

# pandas' day names, Monday first (the heatmap row order), and the
# delivery status bands of the insights card (<= 30 min, <= 40 min, else).
DAY_NAMES = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
DELIVERY_STATUS = [(30, "Excellent"), (40, "Good")]
DELIVERY_STATUS_DEFAULT = "Needs Improvement"


def dashboard_frame(tx: DataFrame, as_of, start=None, end=None, city=None,
                    load_days: int = 90, range_days: int = 30) -> DataFrame:
    """90-day load, then the date-range (default: last 30 days to ``as_of``) and city filters."""
    as_of_d = D.as_date(as_of)
    loaded = D.since(tx, D.days_back(as_of_d, load_days))
    start = start if start is not None else as_of_d - dt.timedelta(days=range_days)
    end = end if end is not None else as_of_d
    return filter_orders(loaded, city, start, end)


def kpi_cards(df: DataFrame, as_of) -> DataFrame:
    """Today's orders, revenue, mean delivery time, distinct customers, growth vs yesterday."""
    return daily_summary(df, as_of, with_customers=True)


def daily_revenue(df: DataFrame, as_of, days: int = 30) -> DataFrame:
    w = D.since(df, D.days_back(as_of, days))
    return (w.groupBy(F.to_date("order_date").alias("date"))
            .agg(F.sum("order_value").cast("double").alias("revenue"),
                 F.count("order_id").alias("orders"))
            .orderBy("date"))


def city_performance(df: DataFrame) -> DataFrame:
    """Sum, mean and count of order value and mean delivery time per city, 2 decimals."""
    return (df.filter(F.col("city").isNotNull()).groupBy("city").agg(
        F.sum("order_value").cast("double").alias("total_revenue"),
        round_half_even(exact_mean("order_value")).alias("avg_order_value"),
        F.count("order_value").alias("total_orders"),
        round_half_even(exact_mean("delivery_time", integral=True)).alias("avg_delivery_time")))


def box_stats(df: DataFrame, group: str, value: str) -> DataFrame:
    """Box-plot numbers per group: linear quartiles, 1.5 IQR whiskers, mean, overall mean.

    Built from a (group, value) histogram, which combines map-side and is
    bounded by the number of distinct values; quartiles use ``percentile``
    with frequencies, whiskers the histogram joined to its group's quartiles.
    """
    hist = (df.filter(F.col(group).isNotNull() & F.col(value).isNotNull())
            .groupBy(group, value).agg(F.count(F.lit(1)).alias("n")))
    q = hist.groupBy(group).agg(
        F.percentile(value, [0.25, 0.5, 0.75], F.col("n")).alias("q"),
        F.sum("n").alias("count"),
        F.sum(F.col(value) * F.col("n")).alias("_sum"),
        F.min(value).alias("min"), F.max(value).alias("max"))
    q = q.select(group, "count", "min", "max", "_sum",
                 F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3"))
    iqr = F.col("q3") - F.col("q1")
    lo, hi = F.col("q1") - 1.5 * iqr, F.col("q3") + 1.5 * iqr
    v = F.col(value)
    whiskers = hist.join(q.select(group, "q1", "q3"), group).groupBy(group).agg(
        F.min(F.when(v >= lo, v)).alias("whisker_low"), F.max(F.when(v <= hi, v)).alias("whisker_high"))
    everything = Window.partitionBy()      # one row per group: bounded
    return (q.join(whiskers, group)
            .withColumn("mean", F.col("_sum") / F.col("count"))
            .withColumn("overall_mean", F.sum("_sum").over(everything) / F.sum("count").over(everything))
            .drop("_sum"))


def box_stats_wide(df: DataFrame, group: str, value: str) -> DataFrame:
    """The same numbers for values of a wide range (money): quartiles by radix selection, so no buffer grows
    with the distinct values; whiskers and sums in one more aggregate."""
    q = percentiles(df, group, value, {"q1": 0.25, "median": 0.5, "q3": 0.75})
    iqr = F.col("q3") - F.col("q1")
    fences = q.select(F.col(group).alias("_bg"), (F.col("q1") - 1.5 * iqr).alias("_lo"), (F.col("q3") + 1.5 * iqr).alias("_hi"))
    v = F.col(value).cast("double")
    rows = df.filter(F.col(value).isNotNull()).join(fences, F.col(group) == F.col("_bg"))      # one row per group
    ends = rows.groupBy("_bg").agg(
        F.min(v).alias("min"), F.max(v).alias("max"), F.sum(value).alias("_sum"),
        F.min(F.when(v >= F.col("_lo"), v)).alias("whisker_low"), F.max(F.when(v <= F.col("_hi"), v)).alias("whisker_high"))
    everything = Window.partitionBy()      # one row per group: bounded
    return (q.join(ends, F.col(group) == F.col("_bg")).drop("_bg")
            .withColumn("mean", F.col("_sum").cast("double") / F.col("count"))
            .withColumn("overall_mean", F.sum("_sum").over(everything).cast("double") / F.sum("count").over(everything))
            .drop("_sum"))


def spend_box_stats(tx: DataFrame, as_of) -> DataFrame:
    """Box-plot numbers of customers' total spend per value band (the fixed grouping of the segment rules)."""
    from .customers import clv
    from .features import segmentation_features
    bands = clv(tx, as_of, ordered=False).select("customer_id", "customer_segment")
    spend = segmentation_features(tx).select("customer_id", F.col("total_spent").cast("decimal(18,2)").alias("total_spent"))
    return box_stats_wide(spend.join(bands, "customer_id"), "customer_segment", "total_spent")


def delivery_box_stats(df: DataFrame) -> DataFrame:
    return box_stats(df, "city", "delivery_time")


def _hour_col(h: int) -> str:
    return f"h{h:02d}"


def hourly_heatmap(df: DataFrame) -> DataFrame:
    """Weekday x hour order counts, 0-filled; Monday..Sunday rows, absent days all NULL."""
    spark: SparkSession = df.sparkSession
    counts = (df.filter(F.col("order_date").isNotNull())
              .withColumn("hour", F.hour("order_date"))
              .groupBy(D.weekday_mon0(F.col("order_date")).cast("bigint").alias("day_index"))
              .pivot("hour", list(range(24))).count())
    counts = counts.select("day_index", *[F.coalesce(F.col(str(h)), F.lit(0)).alias(_hour_col(h))
                                          for h in range(24)])
    days = spark.createDataFrame([(i, n) for i, n in enumerate(DAY_NAMES)],
                                 "day_index bigint, day_name string")
    return days.join(F.broadcast(counts), "day_index", "left").orderBy("day_index")


def repeat_rate(df: DataFrame) -> DataFrame:
    """Share of customers with more than one order (two-level aggregate)."""
    per_customer = (df.filter(F.col("customer_id").isNotNull()).groupBy("customer_id")
                    .agg(F.count(F.lit(1)).alias("n")))
    repeat = per_customer.agg(F.count_if(F.col("n") > 1).alias("repeat_customers"),
                              F.count(F.lit(1)).alias("total_customers"))
    return repeat.withColumn("repeat_rate",
                             F.try_divide(F.col("repeat_customers"), F.col("total_customers")) * 100)


def _insight_sets(df: DataFrame, full: bool) -> DataFrame:
    """Hour, city, (customer and grand-total) groups of the selection in one aggregate."""
    sets = [["h"], ["city"]] + ([["customer_id"], []] if full else [])
    rows = df.withColumn("h", F.hour("order_date"))
    if not full:
        rows = rows.withColumn("customer_id", F.lit(None).cast("string"))
    aggs = [F.count(F.lit(1)).alias("n"), F.sum("order_value").alias("rev")]
    if full:
        aggs.append(F.avg("delivery_time").alias("avg_dt"))
    return (rows.groupingSets(sets, "h", "city", "customer_id")
            .agg(*aggs, F.grouping_id().alias("gid")))


# grouping_id bits over (h, city, customer_id): 1 = not grouped
_HOUR, _CITY, _CUSTOMER, _TOTAL = 0b011, 0b101, 0b110, 0b111


def _insight_columns(with_delivery: bool, with_repeat: bool) -> list:
    gid, n = F.col("gid"), F.col("n")
    hour_rows = (gid == _HOUR) & F.col("h").isNotNull()
    city_rows = (gid == _CITY) & F.col("city").isNotNull()
    peak = F.max(F.when(hour_rows, F.struct(n.alias("n"), (-F.col("h")).alias("neg_h"))))
    cols = [(-peak.getField("neg_h")).cast("bigint").alias("peak_hour"),
            peak.getField("n").alias("peak_orders"),
            F.min_by(F.col("city"), F.when(city_rows, F.struct(-F.col("rev"), F.col("city"))))
            .alias("best_city"),
            F.max(F.when(city_rows, F.col("rev"))).cast("double").alias("best_city_revenue")]
    if with_delivery:
        cols.append(F.max(F.when(gid == _TOTAL, F.col("avg_dt"))).alias("avg_delivery_time"))
    if with_repeat:
        cust_rows = (gid == _CUSTOMER) & F.col("customer_id").isNotNull()
        cols += [F.count_if(cust_rows & (n > 1)).alias("repeat_customers"),
                 F.count_if(cust_rows).alias("total_customers")]
    return cols


def operational_insights(df: DataFrame) -> DataFrame:
    """Peak hour, best city, delivery status and repeat rate as one row, from one scan.

    Grouping sets (hour), (city), (customer) and () share one aggregate; a
    second, global aggregate picks the arg-maxes (smallest key on ties, like
    ``idxmax`` over sorted groups) and counts repeat customers.
    """
    out = _insight_sets(df, True).agg(*_insight_columns(True, True))
    avg_dt = F.col("avg_delivery_time")
    (fast, fast_label), (ok, ok_label) = DELIVERY_STATUS
    return (out.withColumn("delivery_status", F.when(avg_dt <= fast, fast_label)
                           .when(avg_dt <= ok, ok_label).otherwise(DELIVERY_STATUS_DEFAULT))
            .withColumn("repeat_rate",
                        F.try_divide(F.col("repeat_customers"), F.col("total_customers")) * 100))


def peak_hour_and_best_city(df: DataFrame) -> DataFrame:
    return _insight_sets(df, False).agg(*_insight_columns(False, False))


def dataset_overview(df: DataFrame) -> DataFrame:
    """Record count, first and last order time, number of cities.

    The sorted city list for the selector is ``distinct_cities`` (a distributed
    DataFrame), so no array of keys is gathered into one row.
    """
    return df.agg(F.count(F.lit(1)).alias("total_records"),
                  F.min("order_date").alias("min_date"), F.max("order_date").alias("max_date"),
                  F.count_distinct("city").alias("cities"))


def export_csv(df: DataFrame, base_path: str, as_of, prefix: str = "orders_") -> str:
    """Write the current selection as CSV under a dated folder; returns the folder."""
    from ..sources.files import write_csv
    path = f"{base_path.rstrip('/')}/{prefix}{D.as_date(as_of):%Y%m%d}"
    write_csv(df, path)
    return path


def distinct_cities(df: DataFrame) -> DataFrame:
    return df.select("city").filter(F.col("city").isNotNull()).distinct().orderBy("city")
