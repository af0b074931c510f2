"""Dashboard numbers from day partials, kept current file by file.

The dashboard and its endpoint ask for the same sums again on every refresh.  ``refresh`` keeps a table of mergeable
partials per (day, city), plus one row per day over all cities, next to a ledger of the fact files it has taken:

* a file that is new (or has another size or time than in the ledger, or is gone) touches the days of its
  orders; only these days are recomputed, from the files that the ledger knows to hold them, and replace
  their partitions (dynamic partition overwrite);
* the ledger is written last, as a version of its own.  A run that died before that is simply repeated, and a run
  without news reads no facts and writes nothing.

Distinct customers of a day cannot be added up, so they are counted when the day is computed, per city and in
total.  Sums are integers and DECIMAL, so partials merge exactly.  One refresh of a table runs at a time.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions.rounding import round_half_even
from ..sources.files import path_exists
from ..sources.schema import conform
from .api import _growth

LEDGER = "path string, stamp string, days array<date>"
_SUMS = ["orders", "with_id", "revenue", "valued", "delivery_sum", "delivery_count"]


def partials(tx: DataFrame) -> DataFrame:
    """One row per (day, city) and, with ``is_total``, one per day: counts, exact sums, distinct customers."""
    rows = tx.filter(F.col("order_date").isNotNull()).withColumn("order_day", F.to_date("order_date"))
    return (rows.groupingSets([["order_day", "city"], ["order_day"]], "order_day", "city").agg(
        F.count(F.lit(1)).alias("orders"), F.count("order_id").alias("with_id"),
        F.sum("order_value").cast("decimal(28,2)").alias("revenue"), F.count("order_value").alias("valued"),
        F.sum("delivery_time").alias("delivery_sum"), F.count("delivery_time").alias("delivery_count"),
        F.count_distinct("customer_id").alias("customers"), (F.grouping("city") == 1).alias("is_total")))


def _files(spark: SparkSession, landing: str) -> dict[str, str]:
    """path -> size and time of every fact file (the listing a scan makes anyway)."""
    rows = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True)
            .load(landing).select("path", "length", "modificationTime").collect())
    return {r.path: f"{r.length}-{r.modificationTime.timestamp()}" for r in rows}


def _ledger(spark: SparkSession, table: str) -> tuple[int, list]:
    """The last complete version and its entries."""
    version = 0
    while path_exists(spark, f"{table}/ledger/{version + 1}/_SUCCESS"):
        version += 1
    return version, spark.read.schema(LEDGER).parquet(f"{table}/ledger/{version}").collect() if version else []


def _days_of(spark: SparkSession, paths: list[str]) -> dict[str, list]:
    """path -> the days of its orders (bounded by the calendar)."""
    if not paths:
        return {}
    rows = (spark.read.parquet(*paths).select(F.col("_metadata.file_path").alias("path"), F.to_date("order_date").alias("day"))
            .groupBy("path").agg(F.sort_array(F.collect_set("day")).alias("days")).collect())
    found = {_plain(r.path): r.days for r in rows}
    return {p: found.get(_plain(p), []) for p in paths}


def _plain(path: str) -> str:
    """``file:/x`` and ``file:///x`` are the same file."""
    return path.replace(":///", ":/")


def refresh(spark: SparkSession, landing: str, table: str) -> list:
    """Bring ``table`` up to date with the Parquet files under ``landing``; returns the days rewritten."""
    files = _files(spark, landing)
    version, entries = _ledger(spark, table)
    known = {(e.path, e.stamp) for e in entries}
    fresh = sorted(p for p, stamp in files.items() if (p, stamp) not in known)
    gone = [e for e in entries if files.get(e.path) != e.stamp]
    if not fresh and not gone:
        return []
    kept = [e for e in entries if files.get(e.path) == e.stamp]
    new = [(p, files[p], days) for p, days in _days_of(spark, fresh).items()]
    ledger = [(e.path, e.stamp, e.days) for e in kept] + new
    touched = sorted({d for _, _, days in new for d in days} | {d for e in gone for d in e.days})
    if touched:
        days = spark.createDataFrame([(d,) for d in touched], "order_day date")
        holders = [p for p, _, own in ledger if not set(touched).isdisjoint(own)]
        if holders:
            facts = conform(spark.read.parquet(*holders))
            rows = partials(facts.join(F.broadcast(days), F.to_date("order_date") == F.col("order_day"), "left_semi"))
            # a day that lost all its orders keeps an empty total, so that its partition is replaced too
            rows = rows.unionByName(_empty(days.join(rows.select("order_day").distinct(), "order_day", "left_anti")))
        else:
            rows = _empty(days)
        tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))      # a day goes to one task, so to one file
        (rows.repartition(tasks, "order_day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("order_day").parquet(f"{table}/days"))
    spark.createDataFrame(ledger, LEDGER).coalesce(1).write.mode("overwrite").parquet(f"{table}/ledger/{version + 1}")
    return touched


def _empty(days: DataFrame) -> DataFrame:
    zero = F.lit(0).cast("bigint")
    return days.select("order_day", F.lit(None).cast("string").alias("city"), zero.alias("orders"), zero.alias("with_id"),
                       F.lit(None).cast("decimal(28,2)").alias("revenue"), zero.alias("valued"),
                       F.lit(None).cast("bigint").alias("delivery_sum"), zero.alias("delivery_count"),
                       zero.alias("customers"), F.lit(True).alias("is_total"))


def read_days(spark: SparkSession, table: str) -> DataFrame:
    return spark.read.parquet(f"{table}/days")


def _selection(days: DataFrame, as_of, back: int) -> DataFrame:
    """The ``back`` days before ``as_of`` and that day (partition filters)."""
    return days.filter(F.col("order_day").between(D.days_back(as_of, back), D.lit_date(as_of)))


def kpi_cards(days: DataFrame, as_of) -> DataFrame:
    """``dashboard.kpi_cards`` from two partitions."""
    w = _selection(days, as_of, 1).filter("is_total")
    today = F.col("order_day") == D.lit_date(as_of)

    def of(c: str, when) -> F.Column:
        return F.coalesce(F.sum(F.when(when, F.col(c))), F.lit(0))

    def money(when) -> F.Column:
        return F.coalesce(F.sum(F.when(when, F.col("revenue"))), F.lit(Decimal("0.00")))

    t, y, tr, yr = of("orders", today), of("orders", ~today), money(today), money(~today)
    mean = F.try_divide(of("delivery_sum", today).cast("double"), of("delivery_count", today))
    return w.agg(t.alias("today_orders"), tr.cast("double").alias("today_revenue"),
                 F.coalesce(mean, F.lit(0.0)).alias("avg_delivery_time"), of("customers", today).alias("today_customers"),
                 _growth(t, y).alias("orders_growth"), _growth(tr, yr).alias("revenue_growth"),
                 y.alias("yesterday_orders"), yr.cast("double").alias("yesterday_revenue"))


def daily_revenue(days: DataFrame, as_of, back: int = 30) -> DataFrame:
    """``dashboard.daily_revenue``: the total row of each day."""
    return (_selection(days, as_of, back).filter("is_total AND orders > 0")
            .select(F.col("order_day").alias("date"), F.col("revenue").cast("double").alias("revenue"),
                    F.col("with_id").alias("orders")).orderBy("date"))


def city_performance(days: DataFrame, as_of, back: int = 30) -> DataFrame:
    """``dashboard.city_performance`` from the city rows."""
    rows = _selection(days, as_of, back).filter(~F.col("is_total") & F.col("city").isNotNull())
    g = rows.groupBy("city").agg(*[F.sum(c).alias(c) for c in _SUMS])
    value = F.try_divide(F.col("revenue"), F.col("valued").cast("decimal(20,0)"))
    minutes = F.try_divide(F.col("delivery_sum").cast("decimal(20,0)"), F.col("delivery_count"))
    return g.select("city", F.col("revenue").cast("double").alias("total_revenue"),
                    round_half_even(value).alias("avg_order_value"), F.col("valued").alias("total_orders"),
                    round_half_even(minutes).alias("avg_delivery_time"))
