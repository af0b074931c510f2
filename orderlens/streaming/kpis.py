"""Live order KPIs with Structured Streaming.

The reference refreshes its daily numbers by re-querying on every request.
Here purchases are read as a stream and tumbling windows are aggregated with a
watermark (rows later than the watermark are dropped).  In update mode each
micro-batch upserts the windows it changed, the open one included; in append
mode a window is written once, when it is closed.  The batch twin
``daily_kpis`` computes the same numbers over a table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import instant_as_ntz, ntz_as_instant

EVENTS = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType()),
])


def purchases(events: DataFrame) -> DataFrame:
    """Purchase events in the order vocabulary; event time must be TIMESTAMP for watermarks."""
    return (events.filter(F.col("event_type") == "purchase")
            .select(F.col("event_id").cast("string").alias("order_id"),
                    F.col("user_id").cast("string").alias("customer_id"),
                    F.col("value").cast("decimal(18,2)").alias("order_value"),
                    ntz_as_instant(F.col("ts")).alias("order_date")))


def daily_kpis(orders: DataFrame, window: str = "1 day", watermark: str | None = "1 hour") -> DataFrame:
    """Orders and revenue per tumbling window (streaming or batch input)."""
    src = orders.withWatermark("order_date", watermark) if watermark and orders.isStreaming else orders
    return (src.groupBy(F.window("order_date", window))
            .agg(F.count(F.lit(1)).alias("orders"), F.sum("order_value").alias("revenue"))
            .select(instant_as_ntz(F.col("window.start")).alias("window_start"),
                    instant_as_ntz(F.col("window.end")).alias("window_end"),
                    "orders", F.col("revenue").cast("double").alias("revenue")))


def read_event_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream the files of a folder or pattern, or one file."""
    if path.endswith(".parquet"):        # a stream takes no plain file: a pattern that fits this name only
        path = path[:-1] + "[t]"
    reader = spark.readStream.schema(EVENTS)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def run_available(agg: DataFrame, sink: str, checkpoint: str) -> None:
    """Process everything available now (restartable from ``checkpoint``), then stop."""
    q = (agg.writeStream.outputMode("append").format("parquet")
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(sink))
    q.awaitTermination()
    if q.exception():
        raise q.exception()


def run_upserts(agg: DataFrame, sink: str, checkpoint: str) -> None:
    """Update mode with an idempotent sink: a batch overwrites its own folder of changed windows,
    so a repeated batch changes nothing; ``read_upserts`` takes the latest state of each window."""

    def upsert(changed: DataFrame, batch_id: int) -> None:
        changed.write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}")

    q = (agg.writeStream.outputMode("update").foreachBatch(upsert)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception():
        raise q.exception()


def read_upserts(spark: SparkSession, sink: str) -> DataFrame:
    """The current value of every window, closed or open."""
    rows = spark.read.parquet(sink)
    return (rows.groupBy("window_start", "window_end")
            .agg(F.max_by(F.struct("orders", "revenue"), "batch_id").alias("k"))
            .select("window_start", "window_end", "k.orders", "k.revenue"))


def stream_daily_kpis(spark: SparkSession, events_path: str, out_dir: str,
                      window: str = "1 day", watermark: str = "1 hour") -> DataFrame:
    """Run the stream over the available events (a job of its own, when called) and return the
    current windows, the still open one included."""
    stream = purchases(read_event_stream(spark, events_path))
    run_upserts(daily_kpis(stream, window, watermark), f"{out_dir}/sink", f"{out_dir}/checkpoint")
    return read_upserts(spark, f"{out_dir}/sink")
