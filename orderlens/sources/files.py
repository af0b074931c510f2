"""File and database sources / sinks for the fact table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .schema import TRANSACTIONS

CORRUPT = "_corrupt_record"


def write_csv(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """CSV with a header (the reference's ``to_csv``); optional dated sub-folders."""
    if partition_by:
        df = df.hint("rebalance", partition_by)
    w = df.write.mode("overwrite").option("header", True)
    if partition_by:
        w = w.partitionBy(partition_by)
    w.csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType = TRANSACTIONS) -> DataFrame:
    """CSV with an explicit schema; the text of malformed lines lands in ``_corrupt_record``, not errors.

    Every column is read as text and cast here, so whether a row is flagged depends on named columns and
    not on which of them a query goes on to read; the parser itself only counts the fields of a line.
    """
    texts = T.StructType([*(T.StructField(f.name, T.StringType(), True) for f in schema.fields),
                          T.StructField(CORRUPT, T.StringType(), True)])
    raw = (spark.read.schema(texts).option("header", True).option("mode", "PERMISSIVE")
           .option("columnPruning", False)           # else a line is only parsed as far as it is read
           .option("columnNameOfCorruptRecord", CORRUPT).csv(path))
    bad = F.col(CORRUPT).isNotNull()
    for f in schema.fields:
        bad = bad | (F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull())
    line = F.when(bad, F.coalesce(F.col(CORRUPT), F.to_csv(F.struct(*[f.name for f in schema.fields]))))
    return raw.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields], line.alias(CORRUPT))


def write_bucketed(df: DataFrame, table: str, path: str | None = None, buckets: int = 64, key: str = "customer_id",
                   sort: tuple[str, ...] = ("order_date",)) -> None:
    """Parquet table of the session's catalog, bucketed by ``key`` and sorted inside: aggregates and windows by
    ``key`` read it without an exchange.  Rows are dealt by the same hash first, so each bucket is one file.

    A bucket holds whole keys, so one very frequent key makes one large file (and later one long task); the
    month-partitioned layout of ``write_table`` has no such file and suits analyses over recent windows.
    """
    w = (df.repartition(buckets, key).write.mode("overwrite").format("parquet")
         .bucketBy(buckets, key).sortBy(key, *sort))
    if path:
        w = w.option("path", path)
    w.saveAsTable(table)


def write_table(df: DataFrame, path: str, partition_by: str | None = "order_month") -> None:
    """Parquet fact table partitioned by order month (enables partition pruning on windows).

    Rows are rebalanced by the partition column first: small months land in one
    file each, large ones are split, instead of one file per task and month.
    """
    out = df
    if partition_by == "order_month" and "order_month" not in df.columns:
        out = df.withColumn("order_month", F.date_format("order_date", "yyyy-MM"))
    if partition_by:
        out = out.hint("rebalance", partition_by)
    w = out.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(partition_by)
    w.parquet(path)


def jdbc_options(url: str, table: str, partition_column: str = "order_date",
                 lower: str | None = None, upper: str | None = None, partitions: int = 64,
                 fetchsize: int = 10000) -> dict:
    """Options for a parallel ``spark.read.jdbc`` of the fact table (bounded ranges per task)."""
    opts = {"url": url, "dbtable": table, "fetchsize": str(fetchsize)}
    if lower is not None and upper is not None:
        opts.update({"partitionColumn": partition_column, "lowerBound": lower,
                     "upperBound": upper, "numPartitions": str(partitions)})
    return opts


def read_jdbc(spark: SparkSession, **kwargs) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(**kwargs)).load()


def path_exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def json_records(df: DataFrame) -> DataFrame:
    """Each row as one JSON object (the reference's ``to_dict('records')``)."""
    return df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("record"))
