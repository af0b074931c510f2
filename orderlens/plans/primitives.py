"""Single operators of the analyses, exposed on their own (scans, filters, joins,
aggregates, windows, scalar functions).  Each takes ``transactions``."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions.rounding import exact_mean, percent, round_half_even, round_half_up
from ..operators.band_join import item_pairs_per_key
from ..operators.cutpoints import Measure, ntiles
from ..operators.gaps import previous_event
from ..operators.rank import descending, ranks_within
from ..sources import files
from .customers import cuisine_preferences

SEGMENT_COLUMNS = ["customer_id", "city", "order_value", "delivery_time", "order_date",
                   "restaurant_id", "cuisine_type"]


def scan_pruned(tx: DataFrame) -> DataFrame:
    """The segmentation endpoint's explicit column list (becomes the Parquet ReadSchema)."""
    return tx.select(*SEGMENT_COLUMNS)


def recent_orders(tx: DataFrame, as_of, days: int = 90) -> DataFrame:
    return D.trailing(tx, as_of, days=days).orderBy(F.col("order_date").desc(), "order_id")


def csv_round_trip(tx: DataFrame, path: str) -> DataFrame:
    """Write as CSV with a header, read back with the explicit schema."""
    files.write_csv(tx, path)
    return files.read_csv(tx.sparkSession, path)


def trailing_window(tx: DataFrame, as_of) -> DataFrame:
    """Rows inside each trailing window used by the analyses, in one pass."""
    def since(lower):
        return F.count_if(F.col("order_date") >= lower.cast("timestamp_ntz"))
    return tx.agg(since(D.months_back(as_of, 12)).alias("orders_12_months"),
                  since(D.months_back(as_of, 6)).alias("orders_6_months"),
                  since(D.months_back(as_of, 3)).alias("orders_3_months"),
                  since(D.days_back(as_of, 30)).alias("orders_30_days"))


def having_filter(tx: DataFrame, min_orders: int = 10) -> DataFrame:
    g = tx.groupBy("customer_id").agg(F.count_distinct("order_id").alias("total_orders"))
    return g.filter(F.col("total_orders") >= min_orders)


def on_time_rate(tx: DataFrame, minutes: int = 30) -> DataFrame:
    """Per city: share of orders delivered within ``minutes`` (missing times count as late)."""
    return tx.groupBy("city").agg(
        F.count(F.lit(1)).alias("orders"),
        F.count_if(F.col("delivery_time") <= minutes).alias("on_time_orders"),
        percent(F.count_if(F.col("delivery_time") <= minutes), F.count(F.lit(1))).alias("on_time_rate"))


def band_self_join(tx: DataFrame, band_days: int = 30) -> DataFrame:
    """Per customer and ordered cuisine pair: order pairs within the band and their value sum."""
    p = item_pairs_per_key(tx, band_days)
    return p.select(F.col("k").alias("customer_id"), F.col("item_1").alias("cuisine_1"),
                    F.col("item_2").alias("cuisine_2"), F.col("pairs").alias("order_pairs"),
                    F.col("valued_pairs"), F.col("value_sum").cast("double").alias("pair_value_sum"))


def anti_join_unseen(tx: DataFrame, as_of, recent_days: int = 30, history_months: int = 6) -> DataFrame:
    """Recent orders in a cuisine the customer had not ordered in the months before (NOT EXISTS)."""
    recent_from = D.days_back(as_of, recent_days).cast("timestamp_ntz")
    hist_from = D.months_back(as_of, history_months).cast("timestamp_ntz")
    recent = tx.filter(F.col("order_date") >= recent_from).select("order_id", "customer_id", "cuisine_type")
    before = (tx.filter((F.col("order_date") >= hist_from) & (F.col("order_date") < recent_from))
              .select(F.col("customer_id").alias("_c"), F.col("cuisine_type").alias("_k")))
    return recent.join(before, (F.col("customer_id") == F.col("_c")) & (F.col("cuisine_type") == F.col("_k")),
                       "left_anti")


def group_city_month(tx: DataFrame) -> DataFrame:
    return tx.groupBy("city", D.month_label(F.col("order_date")).alias("month")).agg(
        F.count(F.lit(1)).alias("orders"), F.sum("order_value").alias("revenue"))


def distinct_counts(tx: DataFrame, approximate: bool = False) -> DataFrame:
    """Distinct customers, restaurants and orders per city (exact by default)."""
    cd = (lambda c: F.approx_count_distinct(c, 0.01)) if approximate else F.count_distinct
    return tx.groupBy("city").agg(cd("customer_id").alias("customers"),
                                  cd("restaurant_id").alias("restaurants"),
                                  cd("order_id").alias("orders"))


def delivery_percentiles(tx: DataFrame, approximate: bool = False, accuracy: int = 10000) -> DataFrame:
    """Median and p95 delivery time per city: exact (linear interpolation) or opt-in approximate."""
    dt = F.col("delivery_time")
    if approximate:
        q = F.percentile_approx(dt, [0.5, 0.95], accuracy)
        return (tx.groupBy("city").agg(q.alias("q"))
                .select("city", F.col("q")[0].cast("double").alias("median_delivery_time"),
                        F.col("q")[1].cast("double").alias("p95_delivery_time")))
    return tx.groupBy("city").agg(F.percentile(dt, 0.5).alias("median_delivery_time"),
                                  F.percentile(dt, 0.95).alias("p95_delivery_time"))


def latest_order_attrs(tx: DataFrame) -> DataFrame:
    """City and cuisine of each customer's latest order (ties: larger order_id), one aggregate."""
    latest = F.max_by(F.struct("city", "cuisine_type"), F.struct("order_date", "order_id"))
    return (tx.groupBy("customer_id").agg(latest.alias("l"))
            .select("customer_id", F.col("l.city").alias("city"), F.col("l.cuisine_type").alias("cuisine_type")))


def ntile_scores(tx: DataFrame, n: int = 5) -> DataFrame:
    """Spend quintile of every customer (global NTILE by exact cut points)."""
    spend = tx.groupBy("customer_id").agg(F.sum("order_value").alias("total_spent"))
    return ntiles(spend, "customer_id", {"spend_quintile": Measure("total_spent", ascending=False)}, n)


def rank_in_city(tx: DataFrame) -> DataFrame:
    """Rank of each restaurant's revenue in its city (ties share a rank), spread over value buckets."""
    g = tx.groupBy("city", "restaurant_id").agg(F.sum("order_value").alias("revenue"))
    return ranks_within(g, ["city", "restaurant_id"], "city", {"revenue_rank": descending(F.col("revenue"))})


def value_counts(values: DataFrame, column: str) -> DataFrame:
    """Rows per value with their share, most frequent first (NULLs do not count)."""
    g = values.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    total = F.sum("count").over(Window.partitionBy())           # one row per value of a category
    return g.withColumn("pct", percent(F.col("count"), total)).orderBy(F.col("count").desc(), column)


def top_preference(tx: DataFrame, as_of, months: int = 6) -> DataFrame:
    """Rank-1 cuisines per customer (ties kept; Spark plans a WindowGroupLimit)."""
    p = cuisine_preferences(tx, as_of, months)
    return p.filter(F.col("preference_rank") == 1).drop("preference_rank")


def order_gaps(tx: DataFrame) -> DataFrame:
    """Days since the customer's previous order (LAG), skew-safe."""
    p = previous_event(tx.select("order_id", "customer_id", "order_date"),
                       "customer_id", "order_date", "order_id", "previous_order_date")
    return p.withColumn("days_since_previous",
                        F.datediff("order_date", "previous_order_date").cast("bigint"))


def share_of_day(tx: DataFrame) -> DataFrame:
    """Orders per hour as a share of the day name's orders (window SUM over a partition)."""
    g = tx.groupBy(D.day_name(F.col("order_date")).alias("day_of_week"),
                   F.hour("order_date").cast("bigint").alias("order_hour")).agg(
        F.count(F.lit(1)).alias("order_count"))
    total = F.sum("order_count").over(Window.partitionBy("day_of_week"))   # <= 24 rows each
    return g.withColumn("pct_of_daily_orders", percent(F.col("order_count"), total))


def fn_dates(tx: DataFrame, as_of) -> DataFrame:
    """The date functions of the analyses, per order."""
    ts = F.col("order_date")
    return tx.select(
        "order_id",
        F.datediff(D.lit_date(as_of), ts).cast("bigint").alias("days_before_as_of"),
        D.month_label(ts).alias("month"),
        F.trunc(ts.cast("date"), "MM").alias("month_start"),
        D.day_name(ts).alias("day_name"),
        F.hour(ts).cast("bigint").alias("hour_of_day"),
        D.weekday_mon0(ts).cast("bigint").alias("day_of_week"),
        F.to_date(ts).alias("order_day"),
        F.timestamp_diff("MONTH", F.trunc(ts.cast("date"), "MM").cast("timestamp_ntz"), ts)
        .cast("bigint").alias("months_since_month_start"))


def fn_elapsed_days(tx: DataFrame) -> DataFrame:
    """Calendar-day difference (SQL DATEDIFF) next to elapsed whole days (pandas .dt.days)."""
    g = tx.groupBy("customer_id").agg(F.min("order_date").alias("first"), F.max("order_date").alias("last"))
    return g.select("customer_id",
                    D.calendar_days(F.col("last"), F.col("first")).cast("bigint").alias("calendar_days"),
                    D.elapsed_days(F.col("last"), F.col("first")).cast("bigint").alias("elapsed_days"))


def fn_rounding(tx: DataFrame) -> DataFrame:
    """Mean order value per customer rounded both ways (SQL half-up, Python half-even)."""
    g = tx.groupBy("customer_id").agg(exact_mean("order_value").alias("m"))
    return g.select("customer_id", round_half_up(F.col("m")).alias("mean_half_up"),
                    round_half_even(F.col("m")).alias("mean_half_even"))


# Order-value bins (right-closed) and their labels.
COMPLEXITY_BINS = [(0, 100, "Simple"), (100, 300, "Medium"), (300, 500, "Complex"),
                   (500, None, "Very Complex")]


def complexity(value) -> F.Column:
    """Right-closed bins (0,100], (100,300], (300,500], (500,inf); outside -> 'nan'."""
    v = F.col(value) if isinstance(value, str) else value
    expr = None
    for lo, hi, label in COMPLEXITY_BINS:
        cond = (v > lo) if hi is None else (v > lo) & (v <= hi)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise("nan")


def order_complexity(tx: DataFrame) -> DataFrame:
    return tx.select("order_id", "order_value", complexity("order_value").alias("order_complexity"))
