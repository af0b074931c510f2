"""The REST endpoints' metrics, as batch DataFrames (no server).

``as_of`` stands for "today"; optional filters are bound as values, never
spliced into SQL text.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions.rounding import exact_mean, mean_as_double, percent, round_half_up
from .customers import cohort_retention


def filter_orders(tx: DataFrame, city: str | None = None, date_from=None, date_to=None,
                  exact: bool = False) -> DataFrame:
    """Optional city equality ('all'/None = no filter) and calendar-day bounds.

    ``exact=True`` keeps the database's text comparison (``date_to`` stops at
    midnight); the default includes the whole ``date_to`` day.
    """
    if city not in (None, "all", "All"):
        tx = tx.filter(F.col("city") == F.lit(city))
    return D.day_range(tx, date_from, date_to, end_inclusive_day=not exact)


def has_rows(df: DataFrame) -> bool:
    """Is there any row: reads as far as the first one (the check before an endpoint's work)."""
    return bool(any_row(df).first()["has_rows"])


def any_row(df: DataFrame) -> DataFrame:
    """One row: whether there is any (LIMIT 1 below the count)."""
    return df.select(F.lit(1)).limit(1).agg((F.count(F.lit(1)) > 0).alias("has_rows"))


def _growth(cur: Column, prev: Column) -> Column:
    """Percent change when the previous value is positive, else 0 (DOUBLE arithmetic)."""
    c, p = cur.cast("double"), prev.cast("double")
    return F.when(p > 0, (c - p) / p * 100).otherwise(F.lit(0.0))


# ---------------------------------------------------------------- segments endpoint
def segment_summary(tx: DataFrame, city: str | None = None, date_from=None, date_to=None,
                    k: int | None = None, max_k: int = 10, n_init: int = 10, model=None) -> DataFrame:
    """Segment profiles of the filtered orders, with the number of customers segmented.

    Fits the filtered customers when called (searching for k unless it is given); ``model``
    scores them with a saved segmentation instead.
    """
    from .models import customer_segments, profiles
    seg = customer_segments(filter_orders(tx, city, date_from, date_to), k=k, max_k=max_k, n_init=n_init,
                            model=model)
    prof = profiles(seg).withColumn("segment", F.concat(F.lit("Segment_"), F.col("segment")))
    total = F.sum("size").over(Window.partitionBy())          # one row per segment: bounded
    return prof.withColumn("total_customers", total)


# ---------------------------------------------------------------- retention endpoint
def retention_summary(tx: DataFrame, as_of, city: str | None = None, period: str = "monthly",
                      churn_days: int = 30, clv_months: int = 12) -> DataFrame:
    """One row: average churn rate and average CLV next to the cohort table's settings.

    Churn rate = % of customers with no order in the ``churn_days`` before
    ``as_of``; average CLV = mean of the rounded annualised CLV (12 months).
    Both come from one aggregation by customer with conditional aggregates.
    """
    tx = filter_orders(tx, city).filter(F.col("customer_id").isNotNull())
    recent_from = D.days_back(as_of, churn_days).cast("timestamp_ntz")
    clv_from = D.months_back(as_of, clv_months).cast("timestamp_ntz")
    in_clv = F.col("order_date") >= clv_from
    per = tx.groupBy("customer_id").agg(
        F.max("order_date").alias("last"),
        F.count_if(in_clv).alias("n12"),
        F.sum(F.when(in_clv, F.col("order_value"))).alias("s12"),
        (F.datediff(F.max(F.when(in_clv, F.col("order_date"))),
                    F.min(F.when(in_clv, F.col("order_date")))) + 1).alias("life"))
    clv = F.round(F.col("s12") * F.lit(Decimal("365.25")) / F.col("life"), 2)
    per = per.select(F.coalesce(F.col("last") < recent_from, F.lit(True)).alias("churned"),
                     F.when(F.col("n12") > 0, clv).alias("clv"))
    out = per.agg(
        percent(F.count_if("churned"), F.count(F.lit(1))).alias("average_churn_rate"),
        round_half_up(exact_mean("clv")).alias("average_clv"))
    return out.select(F.lit(period).alias("cohort_period"), F.lit(city or "all").alias("city"), "*")


def retention_cohorts(tx: DataFrame, city: str | None = None, period: str = "monthly") -> DataFrame:
    return cohort_retention(filter_orders(tx, city), period=period)


# ---------------------------------------------------------------- operations endpoint
def ops_window(tx: DataFrame, as_of, date_from=None, date_to=None, city=None,
               days: int = 30) -> DataFrame:
    date_from = date_from if date_from is not None else D.as_date(as_of) - _days(days)
    date_to = date_to if date_to is not None else D.as_date(as_of)
    return filter_orders(tx, city, date_from, date_to)


def _days(n: int):
    import datetime as dt
    return dt.timedelta(days=n)


def city_breakdown(tx: DataFrame, as_of, date_from=None, date_to=None, city=None) -> DataFrame:
    """Per city in the date range: mean delivery time, orders, revenue, mean order value."""
    w = ops_window(tx, as_of, date_from, date_to, city).filter(F.col("city").isNotNull())
    return w.groupBy("city").agg(
        F.avg("delivery_time").alias("avg_delivery_time"),
        F.count(F.lit(1)).alias("total_orders"),
        F.coalesce(F.sum("order_value"), F.lit(0)).cast("double").alias("total_revenue"),
        mean_as_double("order_value").alias("avg_order_value"))


def operational_metrics(tx: DataFrame, as_of, date_from=None, date_to=None, city=None,
                        on_time_minutes: int = 30) -> DataFrame:
    """Overall KPIs of the range: volume, value, delivery time, on-time share.

    One scan, grouping sets ``(customer)``, ``(restaurant)``, ``(minutes)`` and
    ``()``: the distinct counts are the numbers of key groups, the exact
    percentiles read the minute histogram with frequencies, the rest comes from
    the grand-total row.  All first-level buffers are fixed-width counters.
    """
    w = ops_window(tx, as_of, date_from, date_to, city)
    dt = F.col("delivery_time")
    sets = (w.groupingSets([["customer_id"], ["restaurant_id"], ["delivery_time"], []],
                           "customer_id", "restaurant_id", "delivery_time")
            .agg(F.count(F.lit(1)).alias("n"), F.count_if(dt <= on_time_minutes).alias("on_time"),
                 F.sum(dt).alias("dsum"), F.count(dt).alias("dcnt"),
                 F.sum("order_value").alias("rev"), F.count("order_value").alias("nv"),
                 F.grouping_id().alias("gid")))
    gid = F.col("gid")

    def total(c: str):
        return F.max(F.when(gid == 7, F.col(c)))

    minute = F.when(gid == 6, dt)
    return sets.agg(
        F.coalesce(total("n"), F.lit(0)).alias("total_orders"),
        F.count_if((gid == 3) & F.col("customer_id").isNotNull()).alias("active_customers"),
        F.count_if((gid == 5) & F.col("restaurant_id").isNotNull()).alias("active_restaurants"),
        total("rev").cast("double").alias("total_revenue"),
        round_half_up(F.try_divide(total("rev"), total("nv"))).alias("avg_order_value"),
        round_half_up(F.try_divide(total("dsum").cast("decimal(20,0)"), total("dcnt"))).alias("avg_delivery_time"),
        F.percentile(minute, 0.5, F.col("n")).alias("median_delivery_time"),
        F.percentile(minute, 0.95, F.col("n")).alias("p95_delivery_time"),
        percent(total("on_time"), total("n")).alias("on_time_rate"))


def status_breakdown(tx: DataFrame, as_of, date_from=None, date_to=None, city=None) -> DataFrame:
    """Orders by delivery status and by payment method (one scan: unpivot, then group)."""
    w = ops_window(tx, as_of, date_from, date_to, city)
    long = w.select(F.expr("stack(2, 'delivery_status', delivery_status, "
                           "'payment_method', payment_method) AS (dimension, value)"),
                    "delivery_time")
    g = long.groupBy("dimension", "value").agg(
        F.count(F.lit(1)).alias("orders"),
        round_half_up(exact_mean("delivery_time", integral=True)).alias("avg_delivery_time"))
    total = F.sum("orders").over(Window.partitionBy("dimension"))   # few values per dimension
    return g.withColumn("pct_of_orders", percent(F.col("orders"), total))


# ---------------------------------------------------------------- dashboard endpoint
def daily_summary(tx: DataFrame, as_of, with_customers: bool = False) -> DataFrame:
    """Today vs yesterday in one conditional aggregate over a two-day range."""
    today = D.lit_date(as_of)
    w = D.day_range(tx, D.as_date(as_of) - _days(1), as_of)
    is_today = F.to_date("order_date") == today
    is_prev = ~is_today
    t_orders = F.count_if(is_today)
    y_orders = F.count_if(is_prev)
    t_rev = F.coalesce(F.sum(F.when(is_today, F.col("order_value"))), F.lit(Decimal("0.00")))
    y_rev = F.coalesce(F.sum(F.when(is_prev, F.col("order_value"))), F.lit(Decimal("0.00")))
    cols = [t_orders.alias("today_orders"), t_rev.cast("double").alias("today_revenue"),
            F.coalesce(F.avg(F.when(is_today, F.col("delivery_time"))), F.lit(0.0)).alias("avg_delivery_time"),
            _growth(t_orders, y_orders).alias("orders_growth"),
            _growth(t_rev, y_rev).alias("revenue_growth")]
    if with_customers:
        cols.insert(3, F.count_distinct(F.when(is_today, F.col("customer_id"))).alias("today_customers"))
        cols += [y_orders.alias("yesterday_orders"), y_rev.cast("double").alias("yesterday_revenue")]
    return w.agg(*cols)


def weekly_trend(tx: DataFrame, as_of, days: int = 7) -> DataFrame:
    w = D.day_range(tx, D.as_date(as_of) - _days(days), None)
    return (w.groupBy(F.to_date("order_date").alias("date"))
            .agg(F.count(F.lit(1)).alias("orders"), F.sum("order_value").cast("double").alias("revenue"))
            .orderBy("date"))


def weekly_trend_json(tx: DataFrame, as_of, days: int = 7) -> DataFrame:
    """The trend as JSON records (the endpoint's ``to_dict('records')``)."""
    t = weekly_trend(tx, as_of, days)
    return t.select(F.to_json(F.struct(F.date_format("date", "yyyy-MM-dd").alias("date"),
                                       "orders", "revenue")).alias("record"))


def parse_trend(records: DataFrame) -> DataFrame:
    """The JSON records read back into columns."""
    return (records.select(F.from_json("record", "date date, orders bigint, revenue double").alias("r"))
            .select("r.*"))


def top_cities(tx: DataFrame, as_of, days: int = 30, k: int = 5) -> DataFrame:
    """Top ``k`` cities by revenue over the last ``days`` days (ties by city name)."""
    w = D.day_range(tx, D.as_date(as_of) - _days(days), None)
    g = w.groupBy("city").agg(F.count(F.lit(1)).alias("orders"),
                              F.sum("order_value").alias("_rev"),
                              F.avg("delivery_time").alias("avg_delivery_time"))
    return (g.orderBy(F.col("_rev").desc_nulls_last(), F.col("city").asc_nulls_first()).limit(k)
            .select("city", "orders", F.col("_rev").cast("double").alias("revenue"),
                    "avg_delivery_time"))
