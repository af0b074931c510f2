"""Ranks, tiles and percentiles against the window and library forms."""

import random
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from helpers import make_tx
from orderlens.operators.cutpoints import Measure, cut_rows, ntiles
from orderlens.operators.percentile import percentiles
from orderlens.operators.rank import ascending, descending, ranks_within
from orderlens.plans import customers as C
from orderlens.plans import dashboard as DB
from orderlens.plans import operations as O
from orderlens.plans import primitives as P


@pytest.fixture(scope="module")
def places(spark):
    """Nine tenths of the rows in one city, many ties, missing values and a missing city."""
    rnd = random.Random(3)
    rows = []
    for i in range(3000):
        city = "hot" if i % 10 else rnd.choice(["a", "b", None])
        rows.append((f"r{i}" if i % 500 else None, f"c{i % 7}", city, rnd.choice([None, *range(40)]),
                     None if rnd.random() < .02 else Decimal(rnd.randrange(10 ** 6)) / 100,
                     None if rnd.random() < .3 else rnd.choice([1.5, 2.5, rnd.random()])))
    return spark.createDataFrame(rows, "restaurant string, kind string, city string, n int, money decimal(20,2), minutes double").cache()


def test_ranks_equal_the_window_form(places):
    keys = ["restaurant", "kind", "city", "n"]
    unique = places.dropDuplicates(keys)
    got = ranks_within(unique, keys, "city", {"r1": descending(F.col("n")), "r2": descending(F.col("money")),
                                              "r3": ascending(F.col("minutes"))}, buckets=16)
    w = Window.partitionBy("city")
    want = unique.select("*", F.rank().over(w.orderBy(F.col("n").desc_nulls_last())).cast("bigint").alias("r1"),
                         F.rank().over(w.orderBy(F.col("money").desc_nulls_last())).cast("bigint").alias("r2"),
                         F.rank().over(w.orderBy(F.col("minutes").asc_nulls_first())).cast("bigint").alias("r3"))
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    one = ranks_within(unique, keys, "city", {"r1": descending(F.col("n"))})
    assert sorted(map(str, one.collect())) == sorted(map(str, want.drop("r2", "r3").collect()))
    assert ranks_within(unique.limit(0), keys, "city", {"r1": descending(F.col("n"))}).count() == 0


def _plan(df):
    return df._jdf.queryExecution().toString()


def test_no_window_by_city_alone(spark):
    tx = make_tx(spark, [{"city": "X", "restaurant_id": "r", "order_date": "2024-03-01 10:00:00", "order_value": 1}])
    for df in (P.rank_in_city(tx), O.restaurant_performance(tx, "2024-03-31")):
        windows = [line for line in _plan(df).split("== Physical Plan ==")[1].splitlines() if "Window [" in line]
        assert windows and all("_b#" in line for line in windows)


def _tiles(df, n):
    w = lambda c, asc: Window.orderBy(F.col(c).asc_nulls_first() if asc else F.col(c).desc_nulls_last(),
                                      F.col("id").asc_nulls_first())
    return df.select("*", F.ntile(n).over(w("money", False)).cast("bigint").alias("t1"),
                     F.ntile(n).over(w("n", True)).cast("bigint").alias("t2"))


@pytest.mark.parametrize("rows, n, few, sample", [(3000, 5, 20_000, 64), (3000, 5, 400, 256), (2999, 3, 300, 128),
                                                  (3, 5, 100, 8), (0, 5, 100, 8)])
def test_tiles_equal_the_window_form(places, rows, n, few, sample):
    own = places.limit(rows).withColumn("id", F.when(F.col("money") != 5, F.concat("kind", F.coalesce("restaurant", F.lit("-")))))
    own = own.dropDuplicates(["id"]).cache()
    measures = {"t1": Measure("money", False), "t2": Measure("n", True)}
    got = ntiles(own, "id", measures, n, few=few, sample=sample)
    assert sorted(map(str, got.collect())) == sorted(map(str, _tiles(own, n).collect()))


def test_tiles_with_one_value_everywhere(spark):
    """All rows tie: the key alone decides, and the intervals must still shrink."""
    df = spark.range(5000).select(F.format_string("k%05d", "id").alias("id"), F.lit(1).alias("v"))
    got = ntiles(df, "id", {"t": Measure("v")}, 5, few=500, sample=256)
    assert [r["count"] for r in got.groupBy("t").count().orderBy("t").collect()] == [1000] * 5
    assert got.groupBy("t").agg(F.max("id").alias("m")).orderBy("t").first().m == "k00999"
    assert [r[3] for r in cut_rows(df, "id", [Measure("v")], 5, few=500, sample=256)[0]] == ["k01000", "k02000", "k03000", "k04000"]


def test_rfm_has_one_range_exchange_and_no_checkpoint(spark):
    tx = make_tx(spark, [{"customer_id": f"c{i}", "order_date": "2024-03-01 10:00:00", "order_value": i} for i in range(9)])
    plan = _plan(C.rfm(tx, "2024-03-31")).split("== Physical Plan ==")[1]
    assert plan.count("rangepartitioning") == 1 and "Scan ExistingRDD" not in plan.replace("Scan ExistingRDD[order", "")
    assert "Window" not in plan


def _numbers(values, q):
    return float(np.percentile(np.array(values, float), 100 * q))


def test_percentiles_equal_linear_interpolation(places):
    rows = places.withColumn("money", (F.col("money") - 3000).cast("decimal(12,2)"))
    for value in ("money", "n"):
        got = {r.city: r for r in percentiles(rows, "city", value, {"q1": 0.25, "m": 0.5, "p95": 0.95, "top": 1.0}).collect()}
        by = {}
        for r in rows.filter(f"city is not null and {value} is not null").collect():
            by.setdefault(r.city, []).append(r[value])
        assert set(got) == set(by)
        for city, own in by.items():
            assert got[city]["count"] == len(own)
            for name, q in (("q1", 0.25), ("m", 0.5), ("p95", 0.95), ("top", 1.0)):
                assert abs(got[city][name] - _numbers(own, q)) < 1e-9
    assert percentiles(rows.limit(0), "city", "n", {"m": 0.5}).count() == 0


def test_percentiles_keep_no_counter_per_value(places):
    plan = _plan(percentiles(places.withColumn("money", F.col("money").cast("decimal(12,2)")), "city", "money", {"m": 0.5}))
    assert "percentile(" not in plan and "ObjectHashAggregate" not in plan


def test_wide_box_statistics_equal_the_histogram_form(places):
    rows = places.withColumn("money", F.col("money").cast("decimal(12,2)"))
    wide = {r.city: r.asDict() for r in DB.box_stats_wide(rows, "city", "money").collect()}
    narrow = {r.city: r.asDict() for r in DB.box_stats(rows, "city", "money").collect()}
    assert wide.keys() == narrow.keys()
    for city in wide:
        assert all(abs(float(wide[city][c]) - float(narrow[city][c])) < 1e-6 for c in narrow[city] if c != "city")


def _cohorts(rows, horizon, index):
    """(cohort, n) -> customers, from sets of periods."""
    periods = {}
    for c, p in rows:
        periods.setdefault(c, set()).add(p)
    out = {}
    for own in periods.values():
        for p in own:
            if p - min(own) <= horizon:
                out[min(own), p - min(own)] = out.get((min(own), p - min(own)), 0) + 1
    return out


@pytest.mark.parametrize("period, horizon", [("monthly", 12), ("monthly", 32), ("weekly", 12), ("weekly", 31)])
def test_cohorts_from_bitmaps(spark, period, horizon):
    import datetime as dt
    rnd = random.Random(4)
    start = dt.datetime(1968, 11, 20, 5)
    rows = [(f"c{rnd.randrange(60)}", start + dt.timedelta(days=rnd.randrange(1800), hours=rnd.randrange(24))) for _ in range(900)]
    tx = make_tx(spark, [{"customer_id": c, "order_date": str(t)} for c, t in rows])
    if period == "monthly":
        number, label = (lambda t: t.year * 12 + t.month - 1), (lambda p: f"{p // 12:04d}-{p % 12 + 1:02d}")
    else:
        number = lambda t: (t.date() - dt.date(1970, 1, 5)).days // 7
        label = lambda p: str(dt.date(1970, 1, 5) + dt.timedelta(days=7 * p))
    want = {(label(p), n): k for (p, n), k in _cohorts([(c, number(t)) for c, t in rows], horizon, number).items()}
    df = C.cohort_retention(tx, period=period, horizon=horizon)
    assert {(r[0], r[1]): r.customers_retained for r in df.collect()} == want
    plan = _plan(df).split("== Physical Plan ==")[1]
    assert "ObjectHashAggregate" not in plan and "SortAggregate" not in plan and "HashAggregate" in plan
