"""A third of all orders moved onto one customer: the scalable operators still equal the literal forms."""

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_SMALL
from literal import item_pairs_join, previous_event_window, window_ntile
from orderlens.operators.band_join import item_pairs
from orderlens.operators.gaps import previous_event
from orderlens.operators.ntile import global_ntile
from orderlens.plans import customers as C
from orderlens.sources.fixture import transactions


def _rows(df, cols):
    return sorted((tuple(r[c] for c in cols) for r in df.select(*cols).collect()),
                  key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.fixture(scope="module")
def skewed(spark):
    tx = transactions(spark, SF_SMALL)
    hot = F.pmod(F.xxhash64("order_id"), F.lit(3)) == 0
    df = tx.withColumn("customer_id", F.when(hot, F.lit("HOT")).otherwise(F.col("customer_id"))).cache()
    yield df
    df.unpersist()


def test_hot_customer_holds_a_third(skewed):
    share = skewed.filter(F.col("customer_id") == "HOT").count() / skewed.count()
    assert 0.28 < share < 0.38


def test_band_join_under_skew(skewed):
    cols = ["item_1", "item_2", "keys", "pairs", "valued_pairs", "value_sum"]
    assert _rows(item_pairs(skewed, 30, 1), cols) == _rows(item_pairs_join(skewed, 30, 1), cols)


def test_split_lag_under_skew(skewed):
    a = previous_event(skewed, "customer_id", "order_date", "order_id", "p")
    b = previous_event_window(skewed, "customer_id", "order_date", "order_id", "p")
    assert _rows(a, ["order_id", "p"]) == _rows(b, ["order_id", "p"])


def test_churn_telescoping_under_skew(skewed):
    w = Window.partitionBy("customer_id").orderBy("order_date")
    lagged = skewed.withColumn("gap", F.datediff("order_date", F.lag("order_date").over(w)))
    literal = (lagged.groupBy("customer_id").agg(F.count_distinct("order_id").alias("n"),
                                                 F.avg("gap").alias("g"))
               .filter("n >= 2 AND g IS NOT NULL")
               .select("customer_id", F.round(F.col("g").cast("decimal(38,18)"), 2).cast("double").alias("a")))
    ours = C.churn_risk(skewed, dt.date(2001, 8, 1), ordered=False).select(
        "customer_id", F.col("avg_days_between_orders").alias("a"))
    assert _rows(ours, ["customer_id", "a"]) == _rows(literal, ["customer_id", "a"])


def test_ntile_under_heavy_ties(skewed):
    per = skewed.groupBy("customer_id").agg(F.count("*").alias("n"), F.sum("order_value").alias("s"))
    order = [F.col("n").desc(), F.col("customer_id")]
    assert _rows(global_ntile(per, 5, order, "q"), ["customer_id", "q"]) == \
        _rows(window_ntile(per, 5, order, "q"), ["customer_id", "q"])
