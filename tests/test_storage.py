"""Bucketed layout, day partials, sketches, the CSV reader's flags, the job runner's checks, the reconciled stream."""

import datetime as dt
import os
import random
import uuid

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from helpers import make_tx
from orderlens.plans import api as A
from orderlens.plans import customers as C
from orderlens.plans import dashboard as DB
from orderlens.plans import features as FE
from orderlens.plans import primitives as P
from orderlens.plans import rollup as RU
from orderlens.plans import sketches as SK
from orderlens.sources import files
from orderlens.sources.fixture import transactions
from orderlens.sources.schema import conform
from orderlens.streaming import kpis as ST
from orderlens.streaming import reconciled as RC

AS_OF = dt.date(2001, 8, 1)


def plan(df):
    return df._jdf.queryExecution().toString().split("== Physical Plan ==")[1]


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.fixture(scope="module")
def tx(spark):
    return transactions(spark, SF_SMALL).cache()


# ---- bucketed layout

@pytest.fixture(params=["even", "skewed"])
def bucketed(spark, tx, tmp_path, request):
    """The orders as they are, and with two thirds of them by one customer."""
    own = tx if request.param == "even" else tx.withColumn("customer_id", F.when(
        F.pmod(F.xxhash64("order_id"), F.lit(3)) > 0, "1").otherwise(F.col("customer_id")))
    name = f"orders_{uuid.uuid4().hex}"
    files.write_bucketed(own, name, str(tmp_path / "t"), buckets=4)
    yield own, spark.table(name)
    spark.sql(f"DROP TABLE {name}")


def test_customer_aggregates_read_buckets_without_an_exchange(bucketed):
    own, table = bucketed
    for analysis in (lambda t: C.clv(t, AS_OF, ordered=False), lambda t: C.churn_risk(t, AS_OF, ordered=False),
                     FE.segmentation_features):
        df = analysis(conform(table))
        assert "Exchange hashpartitioning" not in plan(df) and "Bucketed: true" in plan(df)
        assert rows(df) == rows(analysis(own))
    gaps = P.order_gaps(conform(table))
    lines = plan(gaps).splitlines()
    depth = [len(x) - len(x.lstrip(" :+-")) for x in lines]
    windows = [k for k, x in enumerate(lines) if "Window [" in x]
    assert len(windows) >= 3
    for k in windows:                                       # the lines below a window, up to one at its own depth
        end = next((j for j in range(k + 1, len(lines)) if depth[j] <= depth[k]), len(lines))
        assert not any("Exchange" in x for x in lines[k:end])
    assert rows(gaps) == rows(P.order_gaps(own))


def test_one_file_per_bucket(spark, tx, tmp_path):
    name = f"orders_{uuid.uuid4().hex}"
    files.write_bucketed(tx.repartition(16), name, str(tmp_path / "t"), buckets=4)
    assert len([f for f in os.listdir(tmp_path / "t") if f.endswith(".parquet")]) <= 4
    spark.sql(f"DROP TABLE {name}")


# ---- day partials

def _compare(spark, table, full):
    days = RU.read_days(spark, table)
    frame = DB.dashboard_frame(full, AS_OF)
    assert rows(RU.kpi_cards(days, AS_OF)) == rows(DB.kpi_cards(frame, AS_OF))
    assert rows(RU.daily_revenue(days, AS_OF)) == rows(DB.daily_revenue(frame, AS_OF))
    assert rows(RU.city_performance(days, AS_OF)) == rows(DB.city_performance(frame))


def test_day_partials_follow_new_late_changed_and_removed_files(spark, tmp_path):
    rnd = random.Random(2)
    def orders(n, first, last, tag):
        return make_tx(spark, [{"order_id": f"{tag}{i}", "customer_id": f"c{rnd.randrange(30)}", "city": rnd.choice(["X", "Y", None]),
                                "order_value": rnd.choice([None, rnd.randrange(1, 9000) / 100]), "delivery_time": rnd.choice([None, 20, 35]),
                                "order_date": str(dt.datetime(2001, 7, 1) + dt.timedelta(days=rnd.randrange(first, last), hours=rnd.randrange(24)))}
                               for i in range(n)])
    landing, table = str(tmp_path / "landing"), str(tmp_path / "table")

    def load(name, df):
        df.coalesce(1).write.mode("overwrite").parquet(f"{landing}/{name}")

    def full():
        return conform(spark.read.option("recursiveFileLookup", True).parquet(landing))

    def stamps():
        return {p: os.stat(p).st_mtime_ns for d, _, fs in os.walk(f"{table}/days") for f in fs if f.endswith(".parquet")
                for p in [os.path.join(d, f)]}

    load("a", orders(300, 0, 33, "a"))
    assert len(RU.refresh(spark, landing, table)) == 33
    _compare(spark, table, full())
    before = stamps()
    assert RU.refresh(spark, landing, table) == [] and stamps() == before          # nothing new
    load("late", orders(9, 3, 5, "l"))                                             # days that are already there
    touched = RU.refresh(spark, landing, table)
    assert set(touched) <= {dt.date(2001, 7, 4), dt.date(2001, 7, 5)}
    after = stamps()
    assert len(before.keys() - after.keys()) == len(touched)                       # only their partitions
    _compare(spark, table, full())
    # a run that died before the ledger was written is repeated
    versions = sorted(os.listdir(f"{table}/ledger"))
    os.remove(f"{table}/ledger/{versions[-1]}/_SUCCESS")
    assert RU.refresh(spark, landing, table) == touched
    _compare(spark, table, full())
    load("a", orders(50, 20, 33, "b"))                                             # replaced by another file
    RU.refresh(spark, landing, table)
    _compare(spark, table, full())
    assert RU.read_days(spark, table).filter("order_day = date'2001-07-02'").agg(F.sum("orders")).first()[0] == 0


# ---- sketches

def test_sketches_merge_to_the_distinct_counts(spark, tx, tmp_path):
    """Few keys per city: the sketches still hold all of them, so the merged counts are exact."""
    SK.write_sketches(tx, str(tmp_path / "s"))
    own = SK.read_sketches(spark, str(tmp_path / "s"))
    exact = P.distinct_counts(tx.filter(F.col("order_date") >= F.add_months(F.lit(AS_OF), -12).cast("timestamp_ntz")))
    assert rows(SK.distinct_counts(own, AS_OF)) == rows(exact)
    got = SK.distinct_counts(own, AS_OF)
    assert "PartitionFilters" in plan(got) and "order_month" in plan(got).split("PartitionFilters")[1][:80]
    months = {(r.city, r.month): r.customers for r in SK.monthly_counts(own, AS_OF).collect()}
    want = (tx.filter(F.col("order_date") >= F.add_months(F.lit(AS_OF), -12).cast("timestamp_ntz"))
            .groupBy("city", F.date_format("order_date", "yyyy-MM").alias("m")).agg(F.count_distinct("customer_id").alias("k")).collect())
    assert months == {(r.city, r.m): r.k for r in want}


def test_sketch_error_on_many_keys(spark):
    many = spark.range(200_000).select(F.col("id").cast("string").alias("order_id"), (F.col("id") % 90_000).cast("string").alias("customer_id"),
                                       (F.col("id") % 7).cast("string").alias("restaurant_id"), F.lit("X").alias("city"),
                                       (F.lit("2001-01-01").cast("timestamp") + F.make_dt_interval((F.col("id") % 200).cast("int"))).cast("timestamp_ntz").alias("order_date"))
    r = SK.distinct_counts(SK.sketches(many), AS_OF).first()
    assert r.restaurants == 7
    assert abs(r.customers - 90_000) <= 0.02 * 90_000 and abs(r.orders - 200_000) <= 0.02 * 200_000


# ---- CSV

HEAD = "order_id,customer_id,restaurant_id,city,order_value,delivery_time,order_date,cuisine_type,payment_method,delivery_status"


def test_csv_flags_do_not_depend_on_the_columns_read(spark, tmp_path):
    path = tmp_path / "o.csv"
    path.write_text("\n".join([HEAD, "o1,c1,r1,X,10.00,20,2024-03-10T10:00:00,A,card,done", "o2,c1,r1,X,ten,20,2024-03-10T10:00:00,A,card,done",
                               "o3,c1,r1,X,10.00,20,yesterday,A,card,done", "o4,c1,r1,X,10.00", "o5,c1,r1,X,,,,,,",
                               "o6,c1,r1,X,1,2,2024-03-10T10:00:00,A,card,done,more"]) + "\n")
    df = files.read_csv(spark, str(path))
    bad = F.col(files.CORRUPT).isNotNull()
    assert df.agg(F.count_if(bad)).first()[0] == 4
    for c in df.columns:
        assert df.agg(F.count_if(bad), F.count(c)).first()[0] == 4
    assert sorted(r.order_id for r in df.filter(bad).select("order_id").collect()) == ["o2", "o3", "o4", "o6"]
    assert [r.order_id for r in df.filter(~bad).select("order_id").orderBy("order_id").collect()] == ["o1", "o5"]
    assert "ten" in df.filter("order_id = 'o2'").first()[files.CORRUPT]


# ---- job runner

def test_job_runner_refuses_an_empty_selection_and_writes_buckets(spark, tx, tmp_path):
    from orderlens.__main__ import main
    src = str(tmp_path / "tx")
    tx.write.parquet(src)
    base = ["clv_simple", "--input", src, "--as-of", "2001-08-01", "--output", str(tmp_path / "out")]
    with pytest.raises(SystemExit, match="no orders"):
        main([*base, "--city", "ATLANTIS"])
    assert main([*base, "--city", "ASIA", "--date-from", "1990-01-01"]) == 0
    want = C.clv_simple(A.filter_orders(tx, "ASIA", "1990-01-01"))
    assert rows(spark.read.parquet(str(tmp_path / "out"))) == rows(want)
    assert "LocalLimit 1" in A.any_row(tx)._jdf.queryExecution().optimizedPlan().toString()


# ---- stream

def _source(spark, folder, loads):
    for k, own in enumerate(loads):
        (spark.createDataFrame(own, "event_id bigint, ts string, user_id bigint, event_type string, value double, props string")
         .withColumn("ts", F.col("ts").cast("timestamp_ntz")).coalesce(1).write.mode("overwrite").parquet(f"{folder}/load_{k}"))


def _event(i, ts, value=1.0):
    return (i, ts, 7, "purchase", value, "")


LOADS = [[_event(1, "2024-01-01 10:00:00"), _event(2, "2024-01-02 10:00:00", 2.0), _event(2, "2024-01-02 10:00:00", 2.0),
          _event(3, "2024-01-02 11:30:00")],
         [_event(3, "2024-01-02 11:30:00"), _event(4, "2024-01-02 11:40:00", 4.0)],
         [_event(5, "2024-01-01 09:00:00", 5.0), _event(6, "2024-01-02 11:50:00"), _event(1, "2024-01-01 10:00:00")]]


def _tables(spark, out):
    return (rows(RC.windows(spark, out)), rows(RC.late_rows(spark, out).select("order_id", "order_value")),
            rows(RC.repeats(spark, out).select("order_id", "order_value")), RC.balance(spark, out).collect())


def test_stream_accounts_for_every_row_and_restarts(spark, tmp_path):
    _source(spark, str(tmp_path / "source"), LOADS)
    out = str(tmp_path / "out")
    RC.run(ST.purchases(ST.read_event_stream(spark, str(tmp_path / "source/*"), 1)), out)
    windows, late, again, balance = _tables(spark, out)
    assert [r.asDict() for r in balance] == [{"source_rows": 9, "window_rows": 5, "window_revenue": 9.0, "late_rows": 2,
                                              "repeated_rows": 2, "balanced": True}]
    assert [x.split("'")[1] for x in late] == ["1", "5"] and [x.split("'")[1] for x in again] == ["2", "3"]
    assert len(windows) == 2
    # load by load, each in a run of its own that goes on from the checkpoint
    import shutil
    step = str(tmp_path / "step")
    for k in range(3):
        shutil.copytree(tmp_path / f"source/load_{k}", tmp_path / f"growing/load_{k}")
        RC.run(ST.purchases(ST.read_event_stream(spark, str(tmp_path / "growing/*"), 1)), step)
    got = RC.balance(spark, step).first()
    assert got.balanced and got.source_rows == 9 and got.window_rows + got.late_rows + got.repeated_rows == 9
    assert rows(RC.windows(spark, step)) == windows
    RC.run(ST.purchases(ST.read_event_stream(spark, str(tmp_path / "growing/*"), 1)), step)        # nothing new
    assert RC.balance(spark, step).first() == got


def test_rollup_rebuild_is_not_narrowed_to_a_few_tasks(spark):
    """The landing of the first load has a file per task that rebuilds it, not four."""
    import __spark_entry__ as E
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "12")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        table = E._rollup(spark, "/root/testdata/sf0.001//")
        first = spark.read.parquet(table.removesuffix("/table") + "/landing/first")
        assert len(first.inputFiles()) == 12
        assert E.RU.read_days(spark, table).filter("is_total").agg(F.sum("orders")).first()[0] == 1500
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
