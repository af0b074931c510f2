"""Live KPIs over a source that redelivers events and sends some too late, with nothing lost unseen.

``kpis.daily_kpis`` counts a redelivered event again and drops late rows silently.  Here repeats are found by Spark's
own state, ``dropDuplicatesWithinWatermark`` on the event id (its size is bounded by the watermark), and the
stream carries the raw rows beside the kept ones, so that each micro-batch can account for every row it read:

* kept rows are summed into the windows of their event time (a small table of partial sums per batch),
* rows that were not kept go to a table of late rows (older than the watermark, whatever their id) or of
  repeats, in the same batch.

Source rows = rows in windows + late rows + repeats, at any time.  Every table has a folder per batch that a
repeated batch overwrites, and the largest event time seen is part of it, so a restart from the checkpoint gives the
same tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.dates import instant_as_ntz
from ..sources.files import path_exists

_PROGRESS = "source_rows bigint, kept_rows bigint, last timestamp"


def _seen_before(spark: SparkSession, out: str, batch_id: int):
    """The largest event time that the watermark for this batch's input knows.

    A batch moves the watermark of the next one, and input is held against the watermark of the batch before its
    own (so that operators further down still get what their state can take): two batches back."""
    if not path_exists(spark, f"{out}/progress"):
        return None
    rows = spark.read.schema(_PROGRESS + ", batch_id bigint").parquet(f"{out}/progress")
    return rows.filter(F.col("batch_id") < batch_id - 1).agg(F.max("last")).first()[0]


def _account(spark: SparkSession, batch: DataFrame, batch_id: int, out: str, window: str, watermark: str) -> None:
    last = _seen_before(spark, out, batch_id)
    batch = batch.persist()
    try:
        columns = [c for c in batch.columns if c != "_kept"]
        raw, kept = (batch.filter(F.col("_kept") == k).select(*columns) for k in (False, True))

        def put(rows: DataFrame, name: str) -> None:
            rows.write.mode("overwrite").parquet(f"{out}/{name}/batch_id={batch_id}")

        put(kept.groupBy(F.window("order_date", window).alias("w")).agg(
            F.count(F.lit(1)).alias("orders"), F.sum("order_value").alias("revenue")).select("w.start", "w.end", "orders", "revenue"),
            "windows")
        # of equal rows as many are left as were not kept
        order = Window.partitionBy("order_id", "order_date").orderBy(F.col("order_value"))
        copies = kept.groupBy("order_id", "order_date").agg(F.count(F.lit(1)).alias("_n"))
        left = (raw.withColumn("_r", F.row_number().over(order)).alias("r")
                .join(copies.alias("k"), F.col("r.order_id").eqNullSafe(F.col("k.order_id"))
                      & F.col("r.order_date").eqNullSafe(F.col("k.order_date")), "left")
                .filter(F.col("_r") > F.coalesce(F.col("_n"), F.lit(0))).select("r.*").drop("_r"))
        late = (F.col("order_date") <= F.lit(last) - F.expr(f"INTERVAL {watermark}")) if last is not None else F.lit(False)
        put(left.filter(late), "late")
        put(left.filter(~late), "repeats")
        put(batch.agg(F.count_if(~F.col("_kept")).alias("source_rows"), F.count_if("_kept").alias("kept_rows"),
                      F.max("order_date").alias("last")), "progress")
    finally:
        batch.unpersist()


def run(orders: DataFrame, out: str, window: str = "1 day", watermark: str = "1 hour", key: str = "order_id") -> None:
    """Process everything available of the stream ``orders (order_id, order_date, order_value, ...)``; restartable
    from ``out/checkpoint``."""
    spark = orders.sparkSession
    kept = orders.withWatermark("order_date", watermark).dropDuplicatesWithinWatermark([key])
    both = orders.withColumn("_kept", F.lit(False)).unionByName(kept.withColumn("_kept", F.lit(True)))
    q = (both.writeStream.outputMode("append").option("checkpointLocation", f"{out}/checkpoint")
         .foreachBatch(lambda batch, n: _account(batch.sparkSession, batch, n, out, window, watermark))
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception():
        raise q.exception()


def windows(spark: SparkSession, out: str) -> DataFrame:
    """Orders and revenue of every window so far."""
    return (spark.read.parquet(f"{out}/windows").groupBy("start", "end")
            .agg(F.sum("orders").alias("orders"), F.sum("revenue").cast("double").alias("revenue"))
            .select(instant_as_ntz(F.col("start")).alias("window_start"), instant_as_ntz(F.col("end")).alias("window_end"),
                    "orders", "revenue"))


def late_rows(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.parquet(f"{out}/late").drop("batch_id")


def repeats(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.parquet(f"{out}/repeats").drop("batch_id")


def balance(spark: SparkSession, out: str) -> DataFrame:
    """One row: rows read, rows in windows, late rows, repeats, and whether they add up."""
    nothing = F.lit(0).cast("bigint")
    source = spark.read.parquet(f"{out}/progress").agg(F.sum("source_rows").alias("source_rows"))
    counted = spark.read.parquet(f"{out}/windows").agg(F.sum("orders").alias("window_rows"), F.sum("revenue").alias("window_revenue"))
    late = late_rows(spark, out).agg(F.count(F.lit(1)).alias("late_rows"))
    again = repeats(spark, out).agg(F.count(F.lit(1)).alias("repeated_rows"))
    parts = source
    for part in (counted, late, again):                  # one row each
        parts = parts.unionByName(part, allowMissingColumns=True)
    row = parts.agg(*[F.coalesce(F.sum(c), nothing).alias(c) for c in ("source_rows", "window_rows", "late_rows", "repeated_rows")],
                    F.sum("window_revenue").cast("double").alias("window_revenue"))
    return row.withColumn("balanced", F.col("source_rows") == F.col("window_rows") + F.col("late_rows") + F.col("repeated_rows"))
