"""Non-default paths: filters, options, sources and validation."""

import datetime as dt

from pyspark.sql import functions as F

from helpers import make_tx
from orderlens.plans import api as A
from orderlens.plans import customers as C
from orderlens.plans import dashboard as DB
from orderlens.session import scratch_dir
from orderlens.sources import files
from orderlens.sources.schema import conform, validate

AS_OF = dt.date(2024, 3, 31)


def test_date_to_includes_whole_day_unless_exact(spark):
    tx = make_tx(spark, [{"order_date": "2024-03-10 12:00:00"}, {"order_date": "2024-03-11 00:00:00"}])
    assert A.filter_orders(tx, date_from="2024-03-10", date_to="2024-03-10").count() == 1
    assert A.filter_orders(tx, date_from="2024-03-10", date_to="2024-03-10", exact=True).count() == 0


def test_city_breakdown_respects_range_and_city(spark):
    tx = make_tx(spark, [
        {"city": "X", "order_value": 10, "delivery_time": 20, "order_date": "2024-03-30 10:00:00"},
        {"city": "X", "order_value": 30, "delivery_time": 40, "order_date": "2024-03-31 23:00:00"},
        {"city": "Y", "order_value": 99, "delivery_time": 10, "order_date": "2024-03-30 10:00:00"},
        {"city": "X", "order_value": 50, "delivery_time": 10, "order_date": "2024-01-01 10:00:00"},
    ])
    r = A.city_breakdown(tx, AS_OF, city="X").collect()
    assert len(r) == 1 and r[0]["total_orders"] == 2 and r[0]["avg_delivery_time"] == 30.0
    assert r[0]["total_revenue"] == 40.0 and r[0]["avg_order_value"] == 20.0


def test_growth_is_zero_without_previous_day(spark):
    tx = make_tx(spark, [{"order_value": 10, "order_date": "2024-03-31 10:00:00"}])
    r = A.daily_summary(tx, AS_OF).first()
    assert (r["today_orders"], r["orders_growth"], r["revenue_growth"]) == (1, 0.0, 0.0)


def test_rfm_orientations_mirror(spark):
    rows = [{"customer_id": f"c{i}", "order_value": 10 * (i + 1), "order_id": f"o{i}",
             "order_date": f"2024-03-{i + 1:02d} 10:00:00"} for i in range(10)]
    tx = make_tx(spark, rows)
    written = {r["customer_id"]: r["monetary_score"] for r in C.rfm(tx, AS_OF).collect()}
    conventional = {r["customer_id"]: r["monetary_score"]
                    for r in C.rfm(tx, AS_OF, orientation="conventional").collect()}
    assert written["c9"] == 1 and conventional["c9"] == 5           # the biggest spender


def test_weekly_cohorts_start_monday(spark):
    tx = make_tx(spark, [
        {"customer_id": "a", "order_date": "2024-03-06 10:00:00"},     # Wednesday
        {"customer_id": "a", "order_date": "2024-03-11 10:00:00"},     # next Monday
    ])
    rows = {r["week_number"]: r for r in C.cohort_retention(tx, period="weekly").collect()}
    assert rows[0]["cohort_week"] == "2024-03-04" and rows[1]["retention_rate"] == 100.0


def test_validate_reports_duplicates_and_null_keys(spark):
    tx = make_tx(spark, [{"order_id": "a"}, {"order_id": "a"}, {"order_id": "b"}])
    tx = tx.unionByName(make_tx(spark, [{"order_id": None}]))
    r = validate(tx).first()
    assert (r["rows"], r["null_keys"], r["duplicate_keys"]) == (4, 1, 1)


def test_conform_casts_and_adds_missing_columns(spark):
    raw = spark.createDataFrame([("o1", "12.50", "2024-03-01 10:00:00", "x")],
                                "order_id string, order_value string, order_date string, extra string")
    df = conform(raw, with_optional=True)
    r = df.first()
    assert str(r["order_value"]) == "12.50" and r["order_date"] == dt.datetime(2024, 3, 1, 10)
    assert r["city"] is None and "weather_condition" in df.columns and r["extra"] == "x"


def test_csv_keeps_bad_lines_in_corrupt_column(spark):
    path = scratch_dir(spark, "test_csv_corrupt")
    good = make_tx(spark, [{"order_id": "o1", "order_value": 5, "order_date": "2024-03-01 10:00:00"}])
    files.write_csv(good, path)
    local = path[len("file:"):] if path.startswith("file:") else path
    with open(f"{local}/part-bad.csv", "w") as f:
        f.write("order_id,customer_id,restaurant_id,city,order_value,delivery_time,order_date,"
                "cuisine_type,payment_method,delivery_status\n")
        f.write("o2,c,r,X,not-a-number,5,2024-03-01T10:00:00,K,P,S\n")
    back = {r["order_id"]: r for r in files.read_csv(spark, path).select("order_id", "order_value", files.CORRUPT).collect()}
    assert back["o1"][files.CORRUPT] is None and back["o1"]["order_value"] is not None
    assert back["o2"][files.CORRUPT] is not None and back["o2"]["order_value"] is None


def test_dashboard_frame_default_selection(spark):
    tx = make_tx(spark, [{"order_date": "2024-03-01 00:00:00"}, {"order_date": "2024-02-29 23:59:59"},
                         {"order_date": "2024-03-31 23:59:59"}, {"order_date": "2024-04-01 00:00:00"}])
    assert DB.dashboard_frame(tx, AS_OF).count() == 2


def test_month_partitioned_table_prunes_and_agrees(spark):
    from conftest import SF_SMALL
    from orderlens.sources.fixture import transactions
    tx = transactions(spark, SF_SMALL)
    path = scratch_dir(spark, "test_partitioned_table")
    files.write_table(tx, path)
    stored = spark.read.parquet(path)
    as_of = dt.date(2001, 8, 1)
    plain = C.clv(tx, as_of, ordered=False)
    pruned = C.clv(stored, as_of, ordered=False)
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    import re
    assert re.search(r"PartitionFilters: \[isnotnull\(order_month#\d+\), \(order_month#\d+ >= 2000-08\)\]", plan)
    assert sorted(plain.collect()) == sorted(pruned.collect())
    win = A.filter_orders(stored, date_from="2001-07-01", date_to="2001-07-31")
    assert win.count() == A.filter_orders(tx, date_from="2001-07-01", date_to="2001-07-31").count()


def test_approximate_distinct_counts_close_to_exact(spark):
    from conftest import SF_MID
    from orderlens.plans import operations as O
    from orderlens.sources.fixture import transactions
    tx = transactions(spark, SF_MID)
    as_of = dt.date(2001, 8, 1)
    exact = O.executive_summary(tx, as_of).first()
    approx = O.executive_summary(tx, as_of, approximate=True).first()
    for c in ("active_customers_last_30_days", "active_restaurants_last_30_days"):
        assert abs(approx[c] - exact[c]) <= max(2, 0.03 * exact[c])


def test_command_line_job_writes_output(spark, capsys):
    from conftest import SF_SMALL
    from orderlens.__main__ import main
    assert main(["--list"]) == 0 and "clv" in capsys.readouterr().out.split()
    out = scratch_dir(spark, "test_cli_clv")
    assert main(["clv", "--fixture", SF_SMALL, "--as-of", "2001-08-01", "--output", out]) == 0
    assert spark.read.parquet(out).count() > 0
    table = scratch_dir(spark, "test_cli_prepare")
    assert main(["prepare", "--fixture", SF_SMALL, "--output", table]) == 0
    assert "order_month" in spark.read.parquet(table).columns


def test_jdbc_options_partition_the_read():
    o = files.jdbc_options("jdbc:postgresql://db/x", "transactions", lower="2020-01-01",
                           upper="2024-01-01", partitions=32)
    assert o["partitionColumn"] == "order_date" and o["numPartitions"] == "32"
    assert "partitionColumn" not in files.jdbc_options("jdbc:postgresql://db/x", "t")


def test_export_csv_uses_dated_folder_and_json_records(spark):
    tx = make_tx(spark, [{"order_id": "o1", "order_value": 5, "order_date": "2024-03-10 10:00:00"}])
    path = DB.export_csv(tx, scratch_dir(spark, "test_export"), AS_OF)
    assert path.endswith("/orders_20240331")
    assert files.read_csv(spark, path).select("order_id").first()["order_id"] == "o1"
    rec = files.json_records(tx.select("order_id", "order_value")).first()["record"]
    assert rec == '{"order_id":"o1","order_value":5.00}'


def test_analyses_as_sql_views(spark):
    from conftest import SF_SMALL
    from orderlens.plans.views import register_views
    from orderlens.sources.fixture import transactions
    tx = transactions(spark, SF_SMALL)
    names = register_views(tx, "2001-08-01", ["clv", "peak_hours", "city_growth"], prefix="v_")
    assert names == ["v_clv", "v_peak_hours", "v_city_growth"]
    n = spark.sql("SELECT count(*) AS n FROM v_clv WHERE customer_segment IS NOT NULL").first()["n"]
    assert n == C.clv(tx, dt.date(2001, 8, 1)).count()
    assert spark.sql("SELECT count(*) FROM v_transactions").first()[0] == tx.count()


def test_table_has_few_files(spark, tmp_path):
    """Many tasks times many months still give about one file per month."""
    import pathlib
    rows = [{"order_id": f"o{i}", "order_date": f"2024-{i % 12 + 1:02d}-10 10:00:00"} for i in range(240)]
    files.write_table(make_tx(spark, rows).repartition(16), str(tmp_path / "t"))
    assert 12 <= len(list(pathlib.Path(tmp_path / "t").rglob("part-*.parquet"))) <= 24


def test_job_runner_quarantines_bad_rows(spark, tmp_path, capsys):
    import pytest
    from orderlens.__main__ import main
    src = tmp_path / "orders.csv"
    head = ("order_id,customer_id,restaurant_id,city,order_value,delivery_time,order_date,cuisine_type,"
            "payment_method,delivery_status")
    src.write_text("\n".join([head, "o1,c1,r1,X,10.00,20,2024-03-10T10:00:00,A,card,done",
                              "o2,c1,r1,X,ten,20,2024-03-10T10:00:00,A,card,done",
                              "o3,c1,r1,X,10.00,20,yesterday,A,card,done"]) + "\n")
    args = ["executive_summary", "--input", str(src), "--input-format", "csv", "--as-of", "2024-03-31",
            "--quarantine", str(tmp_path / "bad"), "--output", str(tmp_path / "out"), "--format", "json"]
    with pytest.raises(SystemExit):
        main(args)
    assert main([*args, "--max-bad-rows", "2"]) == 0
    assert "2" in capsys.readouterr().err
    assert spark.read.json(str(tmp_path / "bad")).count() == 2
    with pytest.raises(SystemExit):
        main([a for a in args if a not in ("--as-of", "2024-03-31")])
