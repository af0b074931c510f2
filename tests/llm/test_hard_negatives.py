"""Operator 13 against SQL and against plain inner products."""

import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from orderlens.llm import hard_negatives, queries

SF_SMALL, SF_MID = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


@pytest.mark.parametrize("sf", [SF_SMALL, SF_MID])
def test_oracle(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{sf}/embeddings.parquet')")
    rel = con.sql(hard_negatives.ORACLE_SQL)
    df = queries.op13_hard_negatives(spark, sf)
    want = sorted(rel.fetchall())
    assert sorted(map(tuple, df.select(*rel.columns).collect())) == want and len(want) > 50


def test_scores_are_exact_inner_products():
    rnd = np.random.default_rng(3)
    for dims, top in ((1, 3), (7, 300), (8, 1), (64, 256), (70, 1 << 20)):
        a = rnd.integers(-top, top + 1, (300, dims))
        c = rnd.integers(-top, top + 1, (700, dims))
        got = hard_negatives.scores(a, hard_negatives.bit_planes(c))
        assert (got == c @ a.T).all()
    assert hard_negatives.scores(np.zeros((2, 3), np.int64), hard_negatives.bit_planes(np.zeros((4, 3), np.int64))).tolist() == [[0, 0]] * 4


def brute(rows, anchors, k=5):
    own = [(i, y, [math.floor(256 * float(x)) for x in v]) for i, y, v in rows
           if i is not None and y is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    dot = lambda a, b: sum(p * q for p, q in zip(a, b))
    out = []
    for i, y, v in {(i, y, tuple(v)) for i, y, v in own if anchors(i)}:
        scored = sorted((-dot(v, w), j, z) for j, z, w in own if j != i)
        for s, j, _ in [x for x in scored if x[2] == y][:k]:
            negs = [x for x in scored if x[2] != y and 80 * -s <= 100 * -x[0] <= 100 * -s][:k]
            out += [(i, j, r + 1, n, -s, -t) for r, (t, n, _) in enumerate(negs)]
    return sorted(out)


@pytest.mark.parametrize("block", [3, 4096])
def test_ties_odd_rows_and_many_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(hard_negatives, "ROWS", block)
    monkeypatch.setattr(hard_negatives, "ANCHORS", block)
    rnd = random.Random(5)
    rows = [(i, rnd.randrange(3), [rnd.choice([-.5, 0.0, .25, .5, .7]) for _ in range(5)]) for i in range(60)]
    rows += [(100, 1, [.5, .5]), (101, 1, []), (102, None, [1.0]), (None, 1, [1.0]), (103, 2, None),
             (104, 2, [float("nan")] * 5), (105, 2, [float("inf")] * 5), (106, 1, [None, 1.0]), (20, rows[20][1], rows[20][2])]
    d = spark.createDataFrame([(i, y, v, "x") for i, y, v in rows], "vec_id bigint, label int, embedding array<float>, id string")
    got = sorted(map(tuple, hard_negatives.mine(d, F.col("id") % 10 == 0).collect()))
    exact = [(i, y, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, y, v in rows]
    assert got == brute(exact, lambda i: i % 10 == 0) and len(got) > 20
    assert hard_negatives.mine(d.limit(0), F.col("id") % 10 == 0).count() == 0
    assert hard_negatives.mine(d, F.col("id") < 0).count() == 0


def test_large_component_is_an_error(spark):
    d = spark.createDataFrame([(0, 1, [1e9]), (1, 1, [1.0])], "vec_id bigint, label int, embedding array<float>")
    with pytest.raises(Exception, match="bits"):
        hard_negatives.mine(d, F.col("id") == 0).collect()
