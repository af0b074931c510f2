"""Every analysis as a Spark SQL temporary view, for users who query in SQL.

    register_views(spark.table("transactions"), as_of="2001-08-01")
    spark.sql("SELECT customer_segment, count(*) FROM clv GROUP BY 1")

Views are lazy DataFrames; only the distributed RFM scores run jobs when
registered (their numbering is checkpointed).  ``names`` limits the set.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

from ..functions.dates import as_date
from .catalog import jobs


def register_views(tx: DataFrame, as_of, names: Iterable[str] | None = None,
                   prefix: str = "") -> list[str]:
    table = jobs()
    chosen = list(names) if names is not None else sorted(table)
    unknown = [n for n in chosen if n not in table]
    if unknown:
        raise ValueError(f"unknown analyses: {unknown}")
    day = as_date(as_of)
    tx.createOrReplaceTempView(f"{prefix}transactions")
    for name in chosen:
        table[name](tx, day).createOrReplaceTempView(f"{prefix}{name}")
    return [f"{prefix}{n}" for n in chosen]
