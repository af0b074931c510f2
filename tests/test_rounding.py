"""Exact rounding helpers against Python's Decimal on seeded random cases (one Spark job each)."""

import random
from decimal import ROUND_HALF_EVEN, ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F

from orderlens.functions.rounding import (exact_ratio, percent, percent_change, round_half_even,
                                          round_half_up)

RNG = random.Random(20261202)


def _q(x: Decimal, digits: int, mode) -> float:
    return float(x.quantize(Decimal(1).scaleb(-digits), rounding=mode))


def test_percent_matches_decimal(spark):
    pairs = [(RNG.randint(0, 10**6), RNG.randint(1, 10**6)) for _ in range(2000)]
    pairs += [(1, 8), (1, 16), (5, 8), (1, 400), (3, 400), (7, 200)]        # exact ties
    df = spark.createDataFrame(pairs, "a long, b long")
    got = {(r["a"], r["b"]): r["p"] for r in df.select("a", "b", percent(F.col("a"), F.col("b")).alias("p")).collect()}
    for a, b in pairs:
        assert got[(a, b)] == _q(Decimal(100 * a) / Decimal(b), 2, ROUND_HALF_UP), (a, b)


def test_money_means_match_decimal(spark):
    cases = [(RNG.randint(-10**9, 10**9), RNG.randint(1, 5000)) for _ in range(2000)]
    cases += [(125, 1), (1245, 10), (-1255, 10), (2505, 2)]
    df = spark.createDataFrame(cases, "cents long, n long").select(
        "cents", "n", (F.col("cents").cast("decimal(20,0)") / 100).cast("decimal(20,2)").alias("s"))
    m = exact_ratio(F.col("s"), F.col("n"))
    rows = df.select("cents", "n", round_half_up(m).alias("up"), round_half_even(m).alias("even")).collect()
    for r in rows:
        exact = Decimal(r["cents"]) / Decimal(100) / Decimal(r["n"])
        assert r["up"] == _q(exact, 2, ROUND_HALF_UP), (r["cents"], r["n"])
        assert r["even"] == _q(exact, 2, ROUND_HALF_EVEN), (r["cents"], r["n"])


def test_percent_change_signs_match_decimal(spark):
    cases = [(RNG.randint(0, 10**7), RNG.randint(1, 10**7)) for _ in range(2000)]
    df = spark.createDataFrame(cases, "cur long, prev long")
    ch = percent_change(F.col("cur").cast("decimal(20,0)"), F.col("prev").cast("decimal(20,0)"))
    rows = df.select("cur", "prev", ch.cast("double").alias("g")).collect()
    for r in rows:
        exact = (Decimal(r["cur"]) - Decimal(r["prev"])) / Decimal(r["prev"]) * 100
        assert r["g"] == _q(exact, 2, ROUND_HALF_UP), (r["cur"], r["prev"])
