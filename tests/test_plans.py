"""Plan shape: no Python in the hot path, one scan where the SQL had six, pruned reads."""

import re

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from orderlens.plans import operations as O
from orderlens.sources.fixture import transactions
from test_oracle import SLOW

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
                "PythonUDF")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(k for k in E.table_queries() if k not in SLOW))
def test_no_python_udf(spark, key):
    p = plan(E.queries()[key](spark, SF_SMALL))
    assert not any(node in p for node in PYTHON_NODES)


def test_executive_summary_scans_orders_once(spark):
    tx = transactions(spark, SF_SMALL)
    p = plan(O.executive_summary(tx, E.AS_OF))
    assert p.count("orders.parquet") == 1


def test_clv_reads_no_lineitem_and_prunes_columns(spark):
    df = E.queries()["clv"](spark, SF_SMALL)
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "lineitem.parquet" not in p
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_totalprice:double,o_orderdate:timestamp_ntz>" in p


def test_distributed_ntile_has_no_ntile_window(spark):
    p = plan(E.queries()["rfm"](spark, SF_SMALL))
    assert "ntile(" not in p.lower()


@pytest.mark.parametrize("key", sorted(k for k in E.table_queries() if k not in SLOW))
def test_no_cross_or_nested_loop_join(spark, key):
    p = plan(E.queries()[key](spark, SF_SMALL))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_percentile_buffers_are_not_per_order(spark):
    import re
    p = plan(E.queries()["delivery_performance"](spark, SF_SMALL))
    for keys in re.findall(r"ObjectHashAggregate\(keys=\[([^\]]*)\]", p):
        assert "order_id" not in keys


def test_band_join_equi_keys_include_time_bucket(spark):
    """The band join is an equi-join on (customer, day bucket) with the band as residual."""
    p = plan(E.queries()["cuisine_pairs"](spark, SF_SMALL))
    assert re.search(r"Join \[k#\d+, b#\d+L?\], \[k#\d+, b#\d+L?\], Inner, .*<= 30\)", p)


@pytest.mark.parametrize("key", sorted(k for k in E.table_queries() if k not in SLOW))
def test_output_columns_unique_and_named(spark, key):
    cols = E.queries()[key](spark, SF_SMALL).columns
    assert len(cols) == len(set(cols)) and all(re.fullmatch(r"[a-z][a-z0-9_]*", c) for c in cols), cols


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    from orderlens.sources.files import write_table
    path = str(tmp_path_factory.mktemp("stored") / "transactions")
    write_table(transactions(spark, SF_SMALL), path)
    return spark.read.parquet(path)


def final_plan(df) -> str:
    """The adaptive plan that ran."""
    df.collect()
    p = df._jdf.queryExecution().executedPlan().toString()
    return p.split("== Initial Plan ==")[0]


def scans(df) -> int:
    """Scans of the fact table that were executed (a reused exchange scans nothing)."""
    return len(re.findall(r"FileScan parquet", final_plan(df)))


def test_churn_features_scan_is_pruned(spark, stored):
    from orderlens.plans import features as FE
    old = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        df = FE.churn_features(stored)
        df.collect()
        p = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.maxMetadataStringLength", old)
    main = [x for x in re.findall(r"FileScan parquet[^\n]*", p) if "customer_id" in x]
    assert main and all(re.search(r"PartitionFilters: \[.*order_month#\d+ >= date_format", x) for x in main)
    assert len({x.split("Batched")[0] for x in main}) == 1              # one scan, in the final and the initial plan


def test_delivery_features_scan_at_most_twice(spark, stored):
    from orderlens.plans import features as FE
    assert scans(FE.delivery_features(stored)) <= 2


def test_cross_sell_aggregates_cells_once(spark, stored):
    from orderlens.plans import customers as C
    assert scans(C.cuisine_pairs(stored, min_customers=1)) == 1
    assert scans(C.cross_sell(stored, E.AS_OF, min_customers=1)) <= 2


def test_order_gaps_scan_once(spark, stored):
    from orderlens.plans import primitives as P
    assert scans(P.order_gaps(stored)) == 1
