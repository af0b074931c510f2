"""Corner cases of the custom operators against their literal forms."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from helpers import make_tx
from literal import item_pairs_join, previous_event_window, window_ntile
from orderlens.operators.band_join import item_pairs
from orderlens.operators.gaps import previous_event
from orderlens.operators.ntile import global_ntile
from orderlens.operators.split import hash_split


def _rows(df, cols):
    return sorted((tuple(r[c] for c in cols) for r in df.select(*cols).collect()),
                  key=lambda t: tuple((x is None, str(x)) for x in t))


def test_ntile_more_buckets_than_rows_and_empty(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "k string, v int")
    order = [F.col("v"), F.col("k")]
    assert _rows(global_ntile(df, 5, order, "q"), ["k", "q"]) == [("a", 1), ("b", 2), ("c", 3)]
    empty = df.filter("v > 10")
    assert global_ntile(empty, 5, order, "q").count() == 0


def test_ntile_with_ties_and_nulls_matches_window(spark):
    rows = [(f"c{i:02d}", None if i % 7 == 0 else i % 3) for i in range(23)]
    df = spark.createDataFrame(rows, "k string, v int").repartition(5)
    order = [F.col("v").asc_nulls_first(), F.col("k")]
    assert _rows(global_ntile(df, 4, order, "q"), ["k", "q"]) == _rows(window_ntile(df, 4, order, "q"), ["k", "q"])


def test_split_lag_with_null_dates_and_keys(spark):
    t = dt.datetime
    rows = [("o1", "a", t(2024, 1, 1, 10)), ("o2", "a", None), ("o3", "a", t(2024, 1, 1, 9)),
            ("o4", "a", t(2024, 1, 3, 8)), ("o5", None, t(2024, 1, 2, 8)), ("o6", None, t(2024, 1, 2, 7)),
            ("o7", "b", t(2024, 1, 5, 1)), ("o8", "a", t(2024, 1, 3, 8))]
    df = spark.createDataFrame(rows, "order_id string, customer_id string, order_date timestamp_ntz")
    a = previous_event(df, "customer_id", "order_date", "order_id", "p")
    b = previous_event_window(df, "customer_id", "order_date", "order_id", "p")
    assert _rows(a, ["order_id", "p"]) == _rows(b, ["order_id", "p"])


def test_band_join_with_null_values_and_same_day(spark):
    rows = []
    for c in range(12):                      # 12 customers so pairs pass the 10-customer bar
        cid = f"c{c}"
        rows += [{"customer_id": cid, "cuisine_type": "A", "order_value": 10, "order_date": "2024-01-01 10:00:00"},
                 {"customer_id": cid, "cuisine_type": "B", "order_value": None, "order_date": "2024-01-01 11:00:00"},
                 {"customer_id": cid, "cuisine_type": "B", "order_value": 5, "order_date": "2024-01-31 11:00:00"},
                 {"customer_id": cid, "cuisine_type": "C", "order_value": 7, "order_date": "2024-03-15 11:00:00"},
                 {"customer_id": cid, "cuisine_type": None, "order_value": 7, "order_date": "2024-01-01 11:00:00"}]
    tx = make_tx(spark, rows)
    cols = ["item_1", "item_2", "keys", "pairs", "valued_pairs", "value_sum"]
    got = _rows(item_pairs(tx, 30, 10), cols)
    assert got == _rows(item_pairs_join(tx, 30, 10), cols)
    ab = [r for r in got if r[:2] == ("A", "B")][0]
    assert ab[3] == 24 and ab[4] == 12 and ab[5] == Decimal("180.00")     # 2 pairs each, 1 valued (10+5)


def test_hash_split_is_partitioning_independent(spark):
    df = spark.range(2000).select(F.col("id").cast("string").alias("k"))
    a = _rows(hash_split(df.repartition(3), "k"), ["k", "is_test"])
    b = _rows(hash_split(df.repartition(7), "k"), ["k", "is_test"])
    assert a == b
    share = sum(1 for _, t in a if t) / len(a)
    assert 0.15 < share < 0.25
