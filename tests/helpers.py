"""Small hand-made transactions tables for edge cases."""

import datetime as dt
from decimal import Decimal

from orderlens.sources.schema import TRANSACTIONS


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


def make_tx(spark, rows):
    """rows: dicts with any subset of the fact-table columns (the rest NULL)."""
    names = [f.name for f in TRANSACTIONS.fields]
    out = []
    for i, r in enumerate(rows):
        r = dict(r)
        r.setdefault("order_id", f"o{i:04d}")
        if isinstance(r.get("order_value"), (int, float, str)):
            r["order_value"] = Decimal(str(r["order_value"]))
        if isinstance(r.get("order_date"), str):
            r["order_date"] = ts(r["order_date"])
        out.append(tuple(r.get(n) for n in names))
    nullable = TRANSACTIONS.__class__([f.__class__(f.name, f.dataType, True) for f in TRANSACTIONS.fields])
    return spark.createDataFrame(out, nullable)
