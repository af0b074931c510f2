"""Every registered query against its DuckDB oracle (row count, columns, exact values)."""

import datetime as dt
import decimal
import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

# trained models: rows and invariants only, or slow to train
SLOW = {"choose_k", "customer_segments", "segment_profiles", "segment_summary", "segment_totals", "model_round_trip",
        "delivery_model_metrics", "score_delivery", "delivery_round_trip", "churn_model_metrics", "score_churn",
        "churn_round_trip", "delivery_grid_totals", "segment_summary_totals", "choose_k_totals", "churn_score_totals"}
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def _norm(v):
    if isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def _key(row):
    return tuple((x is None, str(x)) for x in row)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


@pytest.mark.parametrize("key", sorted(k for k in E.table_queries() if k in E.oracle_sql() and k not in SLOW))
def test_matches_oracle(spark, duck, key):
    df = E.queries()[key](spark, SF_SMALL)
    rows, cols = df.collect(), df.columns
    rel = duck.sql(E.oracle_sql()[key])
    ocols, orows = rel.columns, rel.fetchall()
    assert sorted(cols) == sorted(ocols)
    assert len(rows) == len(orows)
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    pos = {c: i for i, c in enumerate(ocols)}
    a = sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=_key)
    b = sorted((tuple(_norm(r[pos[cols[i]]]) for i in order) for r in orows), key=_key)
    assert a == b


def test_every_query_has_oracle_or_is_declared_rows_only():
    no_oracle = set(E.table_queries()) - set(E.oracle_sql())
    assert no_oracle == {"choose_k", "customer_segments", "segment_profiles", "segment_summary",
                         "delivery_grid", "delivery_model_metrics", "score_delivery", "churn_model_metrics", "score_churn"}


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "customer_lifetime_value" in df.columns
