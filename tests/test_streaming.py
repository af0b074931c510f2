"""The stream against its batch twin; late rows are dropped after the watermark."""

import datetime as dt
import os
import uuid

from pyspark.sql import functions as F

from conftest import SF_MID
from orderlens.session import scratch_dir
from orderlens.sources.fixture import read_table
from orderlens.streaming import kpis as ST


def test_stream_equals_batch_with_the_open_window(spark):
    batch = ST.daily_kpis(ST.purchases(read_table(spark, SF_MID, "events")))
    out = scratch_dir(spark, f"test_stream_twin_{uuid.uuid4().hex}")
    streamed = ST.stream_daily_kpis(spark, f"{SF_MID}/events.parquet", out)
    assert sorted(streamed.collect()) == sorted(batch.collect())
    # a second run over the same checkpoint changes nothing
    again = ST.stream_daily_kpis(spark, f"{SF_MID}/events.parquet", out)
    assert sorted(again.collect()) == sorted(batch.collect())


def test_append_mode_writes_closed_windows_once(spark):
    base = scratch_dir(spark, f"test_stream_append_{uuid.uuid4().hex}")
    agg = ST.daily_kpis(ST.purchases(ST.read_event_stream(spark, f"{SF_MID}/events.parquet")))
    ST.run_available(agg, f"{base}/sink", f"{base}/ckpt")
    batch = ST.daily_kpis(ST.purchases(read_table(spark, SF_MID, "events")))
    last = batch.agg(F.max("window_start")).first()[0]
    assert sorted(spark.read.parquet(f"{base}/sink").collect()) == sorted(
        batch.filter(F.col("window_start") < last).collect())


def test_late_event_is_dropped(spark):
    base = scratch_dir(spark, f"test_stream_late_{uuid.uuid4().hex}")
    src = os.path.join(base, "src")
    schema = ST.EVENTS

    def write(rows, name):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(os.path.join(src, name))

    t = dt.datetime
    write([(1, t(2024, 1, 1, 10), 1, "purchase", 10.0, "{}"),
           (2, t(2024, 1, 3, 10), 2, "purchase", 20.0, "{}")], "a")
    agg = ST.daily_kpis(ST.purchases(ST.read_event_stream(spark, f"{src}/*")))
    ST.run_available(agg, f"{base}/sink", f"{base}/ckpt")
    write([(3, t(2024, 1, 1, 12), 3, "purchase", 99.0, "{}"),          # older than the watermark
           (4, t(2024, 1, 5, 10), 4, "purchase", 5.0, "{}")], "b")
    agg = ST.daily_kpis(ST.purchases(ST.read_event_stream(spark, f"{src}/*")))
    ST.run_available(agg, f"{base}/sink", f"{base}/ckpt")
    got = {r["window_start"].day: (r["orders"], r["revenue"]) for r in spark.read.parquet(f"{base}/sink").collect()}
    assert got[1] == (1, 10.0)                       # the late 99.0 never reached day 1
    assert 5 not in got                              # day 5 is still open


def test_windows_do_not_depend_on_session_time_zone(spark):
    def starts():
        return [r["window_start"] for r in
                ST.daily_kpis(ST.purchases(read_table(spark, SF_MID, "events"))).orderBy("window_start").collect()]
    utc = starts()
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        assert starts() == utc
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert utc[0] == dt.datetime(2024, 1, 1)
