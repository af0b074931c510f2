"""Run one analysis as a Spark job: ``python -m orderlens`` (or ``spark-submit orderlens/__main__.py``).

    python -m orderlens clv --input s3://bucket/transactions --as-of 2001-08-01 \\
        --output s3://bucket/reports/clv --format parquet
    python -m orderlens --list
    python -m orderlens prepare --input raw/ --input-format csv --output warehouse/transactions
    python -m orderlens prepare --input raw/ --output orders_by_customer --buckets 256

``--input`` is any Parquet / CSV / JSON source with the fact-table columns
(conformed to the schema); ``--fixture DIR`` builds ``transactions`` from the
TPC-H-like test tables instead.  Rows that do not fit the schema are counted,
written to ``--quarantine`` when it is given, and fail the job above
``--max-bad-rows`` (default 0).  The result is written with the DataFrame
writer (nothing is collected to the driver); ``--show N`` prints N rows instead.  ``--city``,
``--date-from`` and ``--date-to`` filter the orders; a job without any order left fails before it starts.
``prepare`` writes the table partitioned by order month, or, with ``--buckets``, as a catalog table
bucketed by customer (``--input-format table`` reads it).
The jobs ``train_delivery``, ``train_churn`` and ``train_segments`` save a model to
``--output``; ``score_delivery``, ``score_churn`` and ``score_segments`` read it from ``--model``.
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.plans.api import filter_orders, has_rows
from orderlens.plans.catalog import jobs, scoring_jobs, training_jobs
from orderlens.session import BASE_CONF
from orderlens.sources.files import CORRUPT, read_csv
from orderlens.sources.schema import bad_rows, conform


def _read(spark: SparkSession, args) -> DataFrame:
    if args.fixture:
        from orderlens.sources.fixture import transactions
        return transactions(spark, args.fixture)
    if args.input_format == "table":
        return conform(spark.table(args.input))
    if args.input_format == "csv":
        raw = read_csv(spark, args.input)
        flagged = F.col(CORRUPT).isNotNull()
    else:
        raw = getattr(spark.read, args.input_format)(args.input)
        flagged = bad_rows(raw)
    if args.quarantine:
        raw.filter(flagged).write.mode("overwrite").json(args.quarantine)
    n = raw.agg(F.count_if(flagged)).first()[0]
    good = conform(raw.filter(~flagged).drop(CORRUPT))
    if n:
        print(f"rows that do not fit the schema: {n}", file=sys.stderr)
    if n > args.max_bad_rows:
        raise SystemExit(f"{n} rows do not fit the schema; --max-bad-rows is {args.max_bad_rows}")
    return good


def _orders(spark: SparkSession, args) -> DataFrame:
    """The rows that the filters leave; none at all ends the job."""
    rows = filter_orders(_read(spark, args), args.city, args.date_from, args.date_to)
    if not has_rows(rows):
        raise SystemExit("no orders to work on")
    return rows


def main(argv: list[str] | None = None) -> int:
    table = jobs()
    p = argparse.ArgumentParser(prog="orderlens", description=__doc__,
                                formatter_class=argparse.RawDescriptionHelpFormatter)
    train, score = training_jobs(), scoring_jobs()
    p.add_argument("analysis", nargs="?", choices=sorted([*table, *train, *score]) + ["prepare"],
                   help="an analysis, or 'prepare' to write the conformed fact table "
                        "as Parquet partitioned by order month")
    p.add_argument("--list", action="store_true", help="list the analyses")
    src = p.add_mutually_exclusive_group()
    src.add_argument("--input", help="fact table path")
    src.add_argument("--fixture", help="folder of the TPC-H-like test tables")
    p.add_argument("--input-format", default="parquet", choices=["parquet", "csv", "json", "orc", "table"])
    p.add_argument("--city", help="only orders of this city")
    p.add_argument("--date-from", help="only orders from this day on (YYYY-MM-DD)")
    p.add_argument("--date-to", help="only orders up to this day (YYYY-MM-DD)")
    p.add_argument("--buckets", type=int, help="prepare: write a catalog table with so many buckets by customer")
    p.add_argument("--as-of", help="reference date (YYYY-MM-DD); needed by the analyses")
    p.add_argument("--model", help="folder of a trained model (scoring jobs)")
    p.add_argument("--quarantine", help="folder for rows that do not fit the schema (JSON lines)")
    p.add_argument("--max-bad-rows", type=int, default=0, help="fail above this many such rows")
    p.add_argument("--output", help="output path")
    p.add_argument("--format", default="parquet", choices=["parquet", "csv", "json"])
    p.add_argument("--show", type=int, default=0, help="print N rows instead of writing")
    p.add_argument("--explain", action="store_true", help="print the formatted physical plan instead")
    args = p.parse_args(argv)
    if args.list or not args.analysis:
        print("\n".join(sorted([*table, *train, *score])))
        return 0
    if not (args.input or args.fixture) or not (args.output or args.show or args.explain):
        p.error("need --input or --fixture, and --output, --show or --explain")
    if args.analysis in table and not args.as_of:
        p.error("the analyses need --as-of")
    if args.analysis in score and not args.model:
        p.error("scoring needs --model")
    spark = SparkSession.builder.appName(f"orderlens-{args.analysis}").config(map=BASE_CONF).getOrCreate()
    for k, v in BASE_CONF.items():
        if spark.conf.isModifiable(k):
            spark.conf.set(k, v)
    if args.analysis == "prepare":
        from orderlens.sources.files import write_bucketed, write_table
        if not args.output:
            p.error("prepare needs --output")
        if args.buckets:
            write_bucketed(_orders(spark, args), args.output, buckets=args.buckets)
        else:
            write_table(_orders(spark, args), args.output)
        return 0
    if args.analysis in train:
        if not args.output:
            p.error("training needs --output")
        train[args.analysis](_orders(spark, args), args.output)
        return 0
    if args.analysis in score:
        result = score[args.analysis](_orders(spark, args), args.model)
    else:
        result = table[args.analysis](_orders(spark, args), dt.date.fromisoformat(args.as_of))
    if args.explain:
        result.explain("formatted")
    elif args.show:
        result.show(args.show, truncate=False)
    else:
        w = result.write.mode("overwrite")
        if args.format == "csv":
            w = w.option("header", True)
        getattr(w, args.format)(args.output)
    return 0


if __name__ == "__main__":
    sys.exit(main())
