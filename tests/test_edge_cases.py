"""Hand-made tables for the edge cases of FIXTURES.md section 4."""

import datetime as dt

from pyspark.sql import functions as F

from helpers import make_tx
from orderlens.functions import dates as D
from literal import window_ntile
from orderlens.operators.ntile import global_ntile
from orderlens.plans import api as A
from orderlens.plans import customers as C
from orderlens.plans import features as FE
from orderlens.plans import operations as O
from orderlens.plans import primitives as P

AS_OF = dt.date(2024, 3, 31)


def by(df, key):
    return {r[key]: r for r in df.collect()}


def test_one_order_customer(spark):
    tx = make_tx(spark, [
        {"customer_id": "solo", "order_value": 100, "order_date": "2024-03-01 10:00:00", "delivery_time": 20},
        {"customer_id": "duo", "order_value": 10, "order_date": "2024-03-01 10:00:00", "delivery_time": 20},
        {"customer_id": "duo", "order_value": 30, "order_date": "2024-03-11 10:00:00", "delivery_time": 40},
    ])
    clv = by(C.clv(tx, AS_OF), "customer_id")
    assert clv["solo"]["customer_lifetime_days"] == 1
    assert clv["solo"]["customer_lifetime_value"] == 36525.0          # 100 / 1 * 365.25
    churn = by(C.churn_risk(tx, AS_OF), "customer_id")
    assert "solo" not in churn and churn["duo"]["avg_days_between_orders"] == 10.0
    rest, _ = FE.delivery_stats(tx.filter("customer_id = 'solo'").withColumn("restaurant_id", F.lit("r")))
    assert rest.first()["restaurant_delivery_time_std"] is None        # sample std of one row


def test_same_day_boundary_pair(spark):
    tx = make_tx(spark, [
        {"customer_id": "c", "order_value": 1, "order_date": "2024-03-01 23:59:00"},
        {"customer_id": "c", "order_value": 1, "order_date": "2024-03-02 00:01:00"},
    ])
    r = P.fn_elapsed_days(tx).first()
    assert (r["calendar_days"], r["elapsed_days"]) == (1, 0)
    seg = FE.segmentation_features(tx).first()
    assert seg["orders_per_day"] == 2.0                                # elapsed 0 days + 1


def test_complexity_bins_right_closed(spark):
    values = ["0", "100", "100.01", "300", "500", "500.01", "-5"]
    tx = make_tx(spark, [{"order_value": v} for v in values])
    got = [r["order_complexity"] for r in P.order_complexity(tx).orderBy("order_id").collect()]
    assert got == ["nan", "Simple", "Medium", "Medium", "Complex", "Very Complex", "nan"]


def test_half_cent_rounding(spark):
    tx = make_tx(spark, [
        {"customer_id": "a", "order_value": "1.24"}, {"customer_id": "a", "order_value": "1.25"},
        {"customer_id": "b", "order_value": "1.25"}, {"customer_id": "b", "order_value": "1.26"},
    ])
    r = by(P.fn_rounding(tx), "customer_id")
    assert (r["a"]["mean_half_up"], r["a"]["mean_half_even"]) == (1.25, 1.24)   # 1.245
    assert (r["b"]["mean_half_up"], r["b"]["mean_half_even"]) == (1.26, 1.26)   # 1.255


def test_window_bounds(spark):
    lower = "2023-03-31 00:00:00"          # as_of - 12 months
    tx = make_tx(spark, [
        {"order_id": "at", "order_date": lower},
        {"order_id": "before", "order_date": "2023-03-30 23:59:59"},
        {"order_id": "after_as_of", "order_date": "2024-04-02 08:00:00"},
    ])
    kept = {r["order_id"] for r in D.trailing(tx, AS_OF, months=12).collect()}
    assert kept == {"at", "after_as_of"}


def test_month_end_arithmetic(spark):
    r = spark.range(1).select(D.months_back(dt.date(2024, 3, 31), 1).alias("a"),
                              D.months_back(dt.date(2024, 2, 29), 12).alias("b")).first()
    assert r["a"] == dt.date(2024, 2, 29) and r["b"] == dt.date(2023, 2, 28)


def test_null_groups_and_on_time_denominator(spark):
    tx = make_tx(spark, [
        {"city": None, "order_value": 10, "order_date": "2024-03-10 10:00:00", "delivery_time": 20},
        {"city": "X", "order_value": 10, "order_date": "2024-03-10 10:00:00", "delivery_time": None},
        {"city": "X", "order_value": 10, "order_date": "2024-03-10 11:00:00", "delivery_time": 25},
    ])
    perf = {r["city"]: r for r in O.delivery_performance(tx, AS_OF).collect()}
    assert None in perf                                                # SQL keeps the NULL group
    assert perf["X"]["on_time_delivery_rate"] == 50.0                   # NULL time counts as late
    assert perf["X"]["avg_delivery_time"] == 25.0


def test_month_gap_and_zero_revenue(spark):
    tx = make_tx(spark, [
        {"city": "X", "order_value": 0, "order_date": "2024-01-10 10:00:00"},
        {"city": "X", "order_value": 50, "order_date": "2024-03-10 10:00:00"},
        {"city": "X", "order_value": 60, "order_date": "2024-03-11 10:00:00"},
    ])
    m = by(O.month_over_month(tx, AS_OF), "month")
    assert m["2024-03"]["orders_growth_rate"] == 100                    # vs January, the previous present month
    assert m["2024-03"]["revenue_growth_rate"] is None                  # previous revenue 0 -> NULL


def test_rank_ties_leave_gaps(spark):
    rows = []
    for rid, value in [("r1", 100), ("r2", 100), ("r3", 50)]:
        rows.append({"restaurant_id": rid, "city": "X", "cuisine_type": "K", "order_value": value,
                     "order_date": "2024-03-20 10:00:00", "customer_id": rid, "delivery_time": 10})
    r = by(O.restaurant_performance(make_tx(spark, rows), AS_OF), "restaurant_id")
    assert [r[k]["revenue_rank"] for k in ("r1", "r2", "r3")] == [1, 1, 3]


def test_tied_primary_cuisines_are_all_kept(spark):
    tx = make_tx(spark, [
        {"customer_id": "c", "cuisine_type": "A", "order_date": "2024-03-01 10:00:00"},
        {"customer_id": "c", "cuisine_type": "B", "order_date": "2024-03-02 10:00:00"},
    ])
    top = {r["cuisine_type"] for r in P.top_preference(tx, AS_OF).collect()}
    assert top == {"A", "B"}


def test_uneven_ntile(spark):
    df = spark.createDataFrame([(f"c{i}", i) for i in range(7)], "customer_id string, v int")
    order = [F.col("v"), F.col("customer_id")]
    for fn in (global_ntile, window_ntile):
        sizes = [r["n"] for r in fn(df.repartition(3), 5, order, "q").groupBy("q")
                 .agg(F.count("*").alias("n")).orderBy("q").collect()]
        assert sizes == [2, 2, 1, 1, 1]


def test_unseen_category_encodes_to_minus_one(spark):
    train = spark.createDataFrame([("A",), ("B",)], "city string")
    model = FE.fit_label_encoders(train, ["city"])
    test = spark.createDataFrame([("B",), ("Z",), (None,)], "city string")
    got = {r["city"]: r["city_encoded"] for r in FE.apply_label_encoders(model, test, ["city"]).collect()}
    assert got == {"B": 1, "Z": -1, None: -1}


def test_rfm_new_customers_branch_is_unreachable(spark):
    rows = [{"customer_id": f"c{i}", "order_value": 10 * (i + 1),
             "order_date": f"2024-03-{(i % 28) + 1:02d} 10:00:00"} for i in range(40)]
    cats = {r["customer_category"] for r in C.rfm(make_tx(spark, rows), AS_OF).collect()}
    assert "New Customers" not in cats


def test_city_filter_is_bound_not_spliced(spark):
    tx = make_tx(spark, [{"city": "X' OR '1'='1", "order_date": "2024-03-01 10:00:00"},
                         {"city": "Y", "order_date": "2024-03-01 10:00:00"}])
    assert A.filter_orders(tx, "X' OR '1'='1").count() == 1
    assert A.filter_orders(tx, "all").count() == 2
