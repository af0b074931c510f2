"""The scalable rewrites equal the literal SQL forms on the sf0.01 fixture."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_MID
from literal import item_pairs_join, previous_event_window, window_ntile
from orderlens.operators.band_join import item_pairs
from orderlens.operators.gaps import previous_event
from orderlens.operators.ntile import global_ntile
from orderlens.plans import customers as C
from orderlens.sources.fixture import transactions
import __spark_entry__ as E


def _rows(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())


def test_global_ntile_equals_window_ntile(spark):
    tx = transactions(spark, SF_MID, ["customer_id", "order_value"])
    spend = tx.groupBy("customer_id").agg(F.sum("order_value").alias("s")).repartition(4)
    order = [F.col("s").desc(), F.col("customer_id")]
    a = global_ntile(spend, 5, order, "q")
    b = window_ntile(spend, 5, order, "q")
    assert _rows(a, ["customer_id", "q"]) == _rows(b, ["customer_id", "q"])


def test_bucketed_band_join_equals_self_join(spark):
    tx = transactions(spark, SF_MID, ["customer_id", "cuisine_type", "order_value", "order_date"])
    cols = ["item_1", "item_2", "keys", "pairs", "valued_pairs", "value_sum"]
    assert _rows(item_pairs(tx, 30, 10), cols) == _rows(item_pairs_join(tx, 30, 10), cols)


def test_split_lag_equals_window_lag(spark):
    tx = transactions(spark, SF_MID, ["order_id", "customer_id", "order_date"])
    a = previous_event(tx, "customer_id", "order_date", "order_id", "prev")
    b = previous_event_window(tx, "customer_id", "order_date", "order_id", "prev")
    assert _rows(a, ["order_id", "prev"]) == _rows(b, ["order_id", "prev"])


def test_churn_mean_gap_telescopes(spark):
    tx = transactions(spark, SF_MID, E._CLV_COLS)
    w = Window.partitionBy("customer_id").orderBy("order_date")
    lagged = tx.withColumn("gap", F.datediff("order_date", F.lag("order_date").over(w)))
    literal = (lagged.groupBy("customer_id")
               .agg(F.count_distinct("order_id").alias("n"), F.avg("gap").alias("mean_gap"))
               .filter("n >= 2 AND mean_gap IS NOT NULL")
               .select("customer_id", F.round(F.col("mean_gap").cast("decimal(38,18)"), 2)
                       .cast("double").alias("avg_days_between_orders")))
    ours = C.churn_risk(tx, E.AS_OF, ordered=False)
    cols = ["customer_id", "avg_days_between_orders"]
    assert _rows(ours, cols) == _rows(literal, cols)
