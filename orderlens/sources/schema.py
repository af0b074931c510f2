"""The one fact table every analysis reads: ``transactions`` (one row per order)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TRANSACTIONS = T.StructType([
    T.StructField("order_id", T.StringType(), False),
    T.StructField("customer_id", T.StringType(), True),
    T.StructField("restaurant_id", T.StringType(), True),
    T.StructField("city", T.StringType(), True),
    T.StructField("order_value", T.DecimalType(10, 2), True),
    T.StructField("delivery_time", T.IntegerType(), True),
    T.StructField("order_date", T.TimestampNTZType(), True),
    T.StructField("cuisine_type", T.StringType(), True),
    T.StructField("payment_method", T.StringType(), True),
    T.StructField("delivery_status", T.StringType(), True),
])

# Columns outside the DDL that some callers send; added as typed NULL when absent.
OPTIONAL = T.StructType([
    T.StructField("peak_hour", T.IntegerType(), True),
    T.StructField("weather_condition", T.StringType(), True),
    T.StructField("distance_km", T.DoubleType(), True),
    T.StructField("customer_location", T.StringType(), True),
])

COLUMNS = [f.name for f in TRANSACTIONS.fields]


def conform(df: DataFrame, with_optional: bool = False) -> DataFrame:
    """Cast known columns to the fact-table types; add missing ones as NULL.

    Bad values become NULL (``try_cast``); ``bad_rows`` finds them beforehand.
    """
    fields = list(TRANSACTIONS.fields) + (list(OPTIONAL.fields) if with_optional else [])
    present = set(df.columns)
    cols: list[Column] = []
    for f in fields:
        if f.name in present:
            c = F.col(f.name)
            if df.schema[f.name].dataType != f.dataType:
                c = c.try_cast(f.dataType)
            cols.append(c.alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    extra = [c for c in df.columns if c not in {f.name for f in fields}]
    return df.select(*cols, *extra)


def bad_rows(df: DataFrame) -> Column:
    """True for rows with a value that ``conform`` would turn into NULL."""
    flag = F.lit(False)
    for f in [*TRANSACTIONS.fields, *OPTIONAL.fields]:
        if f.name in df.columns and df.schema[f.name].dataType != f.dataType:
            flag = flag | (F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull())
    return flag


def validate(df: DataFrame) -> DataFrame:
    """Primary-key report: one row with total rows, NULL keys and duplicate keys.

    One aggregation over a partial count per key; no driver-side sets.
    """
    per_key = df.groupBy("order_id").agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.sum("n").alias("rows"),
        F.coalesce(F.sum(F.when(F.col("order_id").isNull(), F.col("n"))), F.lit(0)).alias("null_keys"),
        F.count_if(F.col("order_id").isNotNull() & (F.col("n") > 1)).alias("duplicate_keys"),
    )
