"""Build ``transactions`` from the TPC-H-like test tables.

Mapping (one row per order):

* order_id / customer_id  <- o_orderkey / o_custkey as text
* city                    <- region name of the customer's nation
* restaurant_id, delivery_time, cuisine_type <- the order's primary line
  (smallest ``l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice``)
  and its part type; NULL for orders without lines
* order_value             <- floor(o_totalprice / 10) cents
* order_date              <- o_orderdate plus (o_orderkey * 37 mod 1440) minutes
* payment_method / delivery_status <- o_orderpriority / o_orderstatus

Plan shape: nation and region are TPC-H constants (25 and 5 rows), so they are
broadcast.  The primary line is a ``min(struct)`` aggregate, which combines
map-side, instead of a ``row_number`` window that would shuffle every line.
Lines and parts are only joined when a requested column needs them, so an
analysis that never reads restaurant, delivery time or cuisine scans no
``lineitem``.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .schema import COLUMNS

LINE_COLUMNS = {"restaurant_id", "delivery_time", "cuisine_type"}


# Declared schemas of the test tables: no footer inference on every read.
TABLE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": ("p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
             "p_retailprice double"),
    "orders": ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
               "o_orderdate timestamp_ntz, o_orderpriority string"),
    "lineitem": ("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                 "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                 "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"),
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in TABLE_SCHEMAS:
        reader = reader.schema(TABLE_SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def primary_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    first = F.min(F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                           "l_extendedprice")).alias("line")
    return (li.groupBy("l_orderkey").agg(first)
            .select(F.col("l_orderkey"),
                    F.col("line.l_partkey").alias("l_partkey"),
                    F.col("line.l_suppkey").alias("l_suppkey"),
                    F.col("line.l_quantity").alias("l_quantity")))


def transactions(spark: SparkSession, sf_dir: str,
                 columns: Iterable[str] | None = None) -> DataFrame:
    wanted = list(columns) if columns is not None else list(COLUMNS)
    need_lines = bool(LINE_COLUMNS & set(wanted))
    need_part = "cuisine_type" in wanted

    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
        "o_orderpriority")
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    geo = nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey)

    df = (orders.join(customer, orders.o_custkey == customer.c_custkey)
          .join(F.broadcast(geo), F.col("c_nationkey") == F.col("n_nationkey")))
    if need_lines:
        df = df.join(primary_lines(spark, sf_dir),
                     F.col("o_orderkey") == F.col("l_orderkey"), "left")
    if need_part:
        part = read_table(spark, sf_dir, "part").select("p_partkey", "p_type")
        df = df.join(part, F.col("l_partkey") == F.col("p_partkey"), "left")

    cents = F.floor(F.col("o_totalprice") / 10).cast("bigint")
    exprs = {
        "order_id": F.col("o_orderkey").cast("string"),
        "customer_id": F.col("o_custkey").cast("string"),
        "restaurant_id": F.col("l_suppkey").cast("string") if need_lines else None,
        "city": F.col("r_name"),
        "order_value": (cents.cast("decimal(10,0)") * F.lit(0.01).cast("decimal(3,2)"))
        .cast("decimal(10,2)"),
        "delivery_time": F.col("l_quantity").cast("int") if need_lines else None,
        "order_date": F.timestamp_add(
            "MINUTE", F.pmod(F.col("o_orderkey") * 37, F.lit(1440)).cast("int"),
            F.col("o_orderdate").cast("timestamp_ntz")),
        "cuisine_type": F.col("p_type") if need_part else None,
        "payment_method": F.col("o_orderpriority"),
        "delivery_status": F.col("o_orderstatus"),
    }
    return df.select(*[exprs[c].alias(c) for c in wanted])

