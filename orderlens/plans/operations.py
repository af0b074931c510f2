"""Operational analyses: delivery performance, peak hours, restaurants, city growth, summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions.rounding import (as_dec, exact_mean, exact_ratio, mean_as_double, percent,
                                  percent_change, round_half_up)
from ..operators.rank import ascending, descending, ranks_within


# The labels and thresholds the analyses must output, in rule order.
DEMAND_LEVELS = ["Peak", "Normal", "Low"]               # >= 1.5 x mean cell count, >= mean, else
PEAK_FACTOR = 1.5
RESTAURANT_CATEGORIES = ["Top Performer", "High Revenue", "Fast Delivery", "High Volume", "Standard"]
GROWTH_BANDS = [(10, "High Growth"), (5, "Moderate Growth"), (0, "Stable")]
GROWTH_DEFAULT = "Declining"
DELIVERY_BANDS = [(25, "Excellent"), (35, "Good"), (45, "Average")]
DELIVERY_DEFAULT = "Needs Improvement"


def _bands(value: Column, bands, default: str, at_least: bool) -> Column:
    """First matching (threshold, label): value >= threshold (or <= threshold), else default."""
    expr = None
    for threshold, label in bands:
        cond = value >= threshold if at_least else value <= threshold
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(default)


def _double(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("double")


def _distinct(c: str, approximate: bool) -> Column:
    """Exact COUNT(DISTINCT) by default; HyperLogLog++ (1 % error) as an opt-in for large scale."""
    return F.approx_count_distinct(c, 0.01) if approximate else F.count_distinct(c)


# ---------------------------------------------------------------- Q4
def delivery_performance(tx: DataFrame, as_of, months: int = 6, on_time_minutes: int = 30,
                         ordered: bool = True) -> DataFrame:
    """Per city and month: orders, mean / median / p95 delivery time, on-time rate, revenue.

    One scan, two grouping sets: ``(city, month, order_id)`` gives the distinct
    order count, ``(city, month, delivery_time)`` a histogram of delivery
    minutes plus the additive sums.  Every buffer in the first aggregate is a
    fixed-width counter; the exact percentiles then read the histogram with
    frequencies (``percentile(value, p, n)``), so no group holds raw values and
    no buffer exists per order.  The on-time rate divides by all orders, so a
    missing delivery time counts as late.
    """
    w = (D.trailing(tx, as_of, months=months)
         .withColumn("month", D.month_label(F.col("order_date"))))
    dt = F.col("delivery_time")
    sets = (w.groupingSets([["city", "month", "order_id"], ["city", "month", "delivery_time"]],
                           "city", "month", "order_id", "delivery_time")
            .agg(F.count(F.lit(1)).alias("n"), F.count_if(dt <= on_time_minutes).alias("on_time"),
                 F.sum(dt).alias("dsum"), F.count(dt).alias("dcnt"),
                 F.sum("order_value").alias("rev"), F.count("order_value").alias("nv"),
                 F.grouping_id().alias("gid")))
    by_order, by_minute = F.col("gid") == 1, F.col("gid") == 2

    def hist(c: str):
        return F.sum(F.when(by_minute, F.col(c)))

    minute = F.when(by_minute, dt)
    out = sets.groupBy("city", "month").agg(
        F.count_if(by_order & F.col("order_id").isNotNull()).alias("total_orders"),
        (hist("dsum") / hist("dcnt")).alias("avg_delivery_time"),
        F.percentile(minute, 0.5, F.col("n")).alias("median_delivery_time"),
        F.percentile(minute, 0.95, F.col("n")).alias("p95_delivery_time"),
        (hist("on_time") / hist("n") * 100).alias("on_time_delivery_rate"),
        _double(hist("rev")).alias("total_revenue"),
        F.try_divide(hist("rev").cast("double"), hist("nv")).alias("avg_order_value"))
    if ordered:
        out = out.orderBy(F.col("city").asc_nulls_first(), F.col("month").desc())
    return out


# ---------------------------------------------------------------- Q5
def hourly_cells(tx: DataFrame, as_of, days: int = 30) -> DataFrame:
    w = D.trailing(tx, as_of, days=days)
    return w.groupBy(F.hour("order_date").cast("bigint").alias("order_hour"),
                     D.day_name(F.col("order_date")).alias("day_of_week")).agg(
        F.count(F.lit(1)).alias("order_count"),
        exact_mean("delivery_time", integral=True).alias("_dt"),
        F.sum("order_value").alias("_rev"))


def peak_hours(tx: DataFrame, as_of, days: int = 30, peak_factor: float = PEAK_FACTOR,
               ordered: bool = True) -> DataFrame:
    """Hour x day-name demand over the last ``days`` days.

    Peak >= 1.5 x the mean cell count, Normal >= the mean, else Low (mean over
    the cells that exist).  The cell table has at most 7 x 24 rows, so the
    whole-table mean and the per-day share are windows over a bounded input.
    """
    cells = hourly_cells(tx, as_of, days)
    mean = F.avg("order_count").over(Window.partitionBy())
    day_total = F.sum("order_count").over(Window.partitionBy("day_of_week"))
    peak, normal, low = DEMAND_LEVELS
    level = (F.when(F.col("order_count") >= F.col("_mean") * peak_factor, peak)
             .when(F.col("order_count") >= F.col("_mean"), normal).otherwise(low))
    out = (cells.withColumn("_mean", mean).withColumn("_day", day_total)
           .select("day_of_week", "order_hour", "order_count",
                   round_half_up(F.col("_dt")).alias("avg_delivery_time"),
                   round_half_up(F.col("_rev")).alias("hourly_revenue"),
                   level.alias("demand_level"),
                   percent(F.col("order_count"), F.col("_day")).alias("pct_of_daily_orders")))
    return out.orderBy("day_of_week", "order_hour") if ordered else out


def demand_level(tx: DataFrame, as_of, days: int = 30) -> DataFrame:
    """Cells with their demand threshold (the uncorrelated scalar subquery, as a column)."""
    cells = hourly_cells(tx, as_of, days)
    return cells.select("order_hour", "day_of_week", "order_count",
                        F.avg("order_count").over(Window.partitionBy()).alias("mean_order_count"))


# ---------------------------------------------------------------- Q6
def restaurant_performance(tx: DataFrame, as_of, months: int = 3, ordered: bool = True,
                           approximate: bool = False) -> DataFrame:
    """Restaurant x cuisine x city metrics with three RANKs inside the city.

    Ranks are taken over restaurant aggregates (far fewer rows than orders), spread over buckets of the
    measure (``operators.rank``), so a city with nearly all restaurants is no hot task;
    the mean delivery time ranks ascending with missing means first.
    """
    w = D.trailing(tx, as_of, months=months)
    m = w.groupBy("restaurant_id", "cuisine_type", "city").agg(
        _distinct("order_id", approximate).alias("total_orders"),
        F.avg("delivery_time").alias("_dt"),
        exact_mean("delivery_time", integral=True).alias("_dt_exact"),
        F.sum("order_value").alias("_rev"),
        exact_mean("order_value").alias("_aov"),
        _distinct("customer_id", approximate).alias("unique_customers"))
    ranked = ranks_within(m, ["restaurant_id", "cuisine_type", "city"], "city", {
        "revenue_rank": descending(F.col("_rev")), "order_rank": descending(F.col("total_orders")),
        "delivery_rank": ascending(F.col("_dt"))})
    rev, dlv = F.col("revenue_rank"), F.col("delivery_rank")
    top, high_revenue, fast, high_volume, standard = RESTAURANT_CATEGORIES
    category = (F.when((rev <= 5) & (dlv <= 10), top).when(rev <= 10, high_revenue)
                .when(dlv <= 5, fast).when(F.col("total_orders") >= 100, high_volume)
                .otherwise(standard))
    out = ranked.select(
        "restaurant_id", "cuisine_type", "city", "total_orders",
        round_half_up(F.col("_dt_exact")).alias("avg_delivery_time"),
        round_half_up(F.col("_rev")).alias("total_revenue"),
        round_half_up(F.col("_aov")).alias("avg_order_value"),
        "unique_customers",
        round_half_up(exact_ratio(as_dec("total_orders"), F.col("unique_customers")))
        .alias("avg_orders_per_customer"),
        "revenue_rank", "order_rank", "delivery_rank",
        category.alias("performance_category"))
    if ordered:
        out = out.orderBy(F.col("city").asc_nulls_first(), F.col("total_revenue").desc(),
                          "restaurant_id", "cuisine_type")
    return out


# ---------------------------------------------------------------- Q9
def monthly_city_metrics(tx: DataFrame, as_of, months: int = 12, approximate: bool = False) -> DataFrame:
    w = D.trailing(tx, as_of, months=months)
    return w.groupBy("city", D.month_label(F.col("order_date")).alias("month")).agg(
        _distinct("order_id", approximate).alias("orders"),
        _distinct("customer_id", approximate).alias("customers"),
        F.sum("order_value").alias("revenue"),
        F.round(exact_mean("delivery_time", integral=True), 2).alias("avg_delivery_time"))


def month_over_month(tx: DataFrame, as_of, months: int = 12, approximate: bool = False) -> DataFrame:
    """Growth against the previous month *present* for the city (gaps are not filled)."""
    m = monthly_city_metrics(tx, as_of, months, approximate)
    w = Window.partitionBy("city").orderBy("month")     # <= months rows per city
    prev_o = F.lag("orders").over(w)
    prev_r = F.lag("revenue").over(w)
    return m.select(
        "city", "month", "orders", "customers", "revenue", "avg_delivery_time",
        F.when(prev_o > 0, percent_change(as_dec("orders"), prev_o)).alias("orders_growth_rate"),
        F.when(prev_r > 0, percent_change(F.col("revenue"), prev_r)).alias("revenue_growth_rate"))


def city_growth(tx: DataFrame, as_of, months: int = 12, ordered: bool = True,
                approximate: bool = False) -> DataFrame:
    """Per city: months with a previous month, totals, mean growth and bands.

    As written: the first month of each city has no growth and is dropped
    before the totals; customers are summed over months (a customer active in
    two months counts twice); the delivery mean is the mean of rounded means.
    """
    g = month_over_month(tx, as_of, months, approximate).filter(F.col("orders_growth_rate").isNotNull())
    agg = g.groupBy("city").agg(
        F.count(F.lit(1)).alias("months_of_data"),
        F.sum("orders").alias("total_orders"),
        F.sum("customers").alias("total_customers"),
        _double(F.sum("revenue")).alias("total_revenue"),
        mean_as_double("avg_delivery_time").alias("overall_avg_delivery_time"),
        mean_as_double("orders_growth_rate").alias("avg_monthly_orders_growth"),
        mean_as_double("revenue_growth_rate").alias("avg_monthly_revenue_growth"))
    og, dt = F.col("avg_monthly_orders_growth"), F.col("overall_avg_delivery_time")
    out = agg.withColumns({
        "growth_category": _bands(og, GROWTH_BANDS, GROWTH_DEFAULT, at_least=True),
        "delivery_performance": _bands(dt, DELIVERY_BANDS, DELIVERY_DEFAULT, at_least=False)})
    if ordered:
        out = out.orderBy(F.col("avg_monthly_revenue_growth").desc_nulls_last(), "city")
    return out


# ---------------------------------------------------------------- Q10
def executive_summary(tx: DataFrame, as_of, days: int = 30, as_json: bool = False,
                      approximate: bool = False) -> DataFrame:
    """Six 30-day KPIs in one scan and one aggregate (the SQL runs six subqueries)."""
    w = D.trailing(tx, as_of, days=days)
    k = w.agg(
        F.count(F.lit(1)).alias("total_orders_last_30_days"),
        round_half_up(F.sum("order_value")).alias("total_revenue_last_30_days"),
        round_half_up(exact_mean("order_value")).alias("avg_order_value_last_30_days"),
        round_half_up(exact_mean("delivery_time", integral=True)).alias("avg_delivery_time_last_30_days"),
        _distinct("customer_id", approximate).alias("active_customers_last_30_days"),
        _distinct("restaurant_id", approximate).alias("active_restaurants_last_30_days"))
    out = k.select(F.lit("Overall Performance").alias("metric_category"), "*")
    if as_json:
        metrics = F.to_json(F.struct(*[c for c in k.columns]), {"ignoreNullFields": "false"})
        out = out.select("metric_category", metrics.alias("metrics"))
    return out


def parse_summary(summary: DataFrame) -> DataFrame:
    """The JSON form of ``executive_summary`` read back into columns."""
    fields = ("total_orders_last_30_days bigint, total_revenue_last_30_days double, "
              "avg_order_value_last_30_days double, avg_delivery_time_last_30_days double, "
              "active_customers_last_30_days bigint, active_restaurants_last_30_days bigint")
    return summary.select("metric_category", F.from_json("metrics", fields).alias("m")).select(
        "metric_category", "m.*")
