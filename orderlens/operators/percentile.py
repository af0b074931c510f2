"""Exact percentiles of wide values by radix selection.

``percentile`` keeps a counter per distinct value, which is fine for minutes but not for money.  Here a value
is an order-preserving whole number, and the wanted positions of each group are found 16 bits at a time:
one pass counts the rows of each group by their next 16 bits, among the rows that share the bits found so
far.  A pass keeps at most 2 ** 16 counters per group and prefix, whatever the number of distinct values,
and combines map-side, so a group with nearly all rows costs no more than another.  Money up to DECIMAL(10,2)
takes three passes, 64-bit values four.  The pairs of group and value are written once under the checkpoint
folder, and the passes read that slim table; nothing is collected.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_dir

DIGIT = 16


def _whole(df: DataFrame, value: str) -> tuple[Column, int, Column]:
    """The value as a non-negative whole number that keeps its order, its bits, and the way back (of ``_w``)."""
    kind = df.schema[value].dataType
    c = F.col(value)
    if isinstance(kind, T.DecimalType):
        if kind.precision > 18:
            raise ValueError("percentiles take DECIMAL values of at most 18 digits")
        bits = (2 * 10 ** kind.precision).bit_length()
        shift = 1 << (bits - 1)
        unscaled = (c.cast(f"decimal({kind.precision},{kind.scale})") * F.lit(10 ** kind.scale)).cast("bigint")
        return unscaled + F.lit(shift), bits, (F.col("_w") - F.lit(shift)).cast("double") / F.lit(float(10 ** kind.scale))
    bits = {"tinyint": 8, "smallint": 16, "int": 32}.get(kind.simpleString())
    if bits is None:
        raise ValueError(f"percentiles take whole numbers up to INT and DECIMAL values, not {kind.simpleString()}")
    shift = 1 << (bits - 1)
    return c.cast("bigint") + F.lit(shift), bits, (F.col("_w") - F.lit(shift)).cast("double")


def percentiles(df: DataFrame, group: str, value: str, at: dict[str, float]) -> DataFrame:
    """``group``, ``count`` and a DOUBLE column per entry of ``at`` (name -> share): linear interpolation between
    the two values around position ``share * (count - 1)``.  NULL values and groups do not count.  Runs a job when
    it is called."""
    whole, bits, back = _whole(df, value)
    path = scratch_dir(df.sparkSession, f"percentiles/{uuid.uuid4().hex}")
    df.filter(F.col(group).isNotNull() & F.col(value).isNotNull()).select(F.col(group).alias("_g"), whole.alias("_w")).write.parquet(path)
    rows = df.sparkSession.read.parquet(path)
    names = list(at)
    sizes = rows.groupBy("_g").agg(F.count(F.lit(1)).alias("_n"))
    place = {q: F.lit(at[q]) * (F.col("_n") - 1) for q in names}
    # both neighbours of every position; an entry is found digit by digit (_rest: rows still to pass)
    wanted = F.array(*[F.struct(F.lit(2 * i + j).alias("_t"),
                                F.least(F.floor(place[q]) + j, F.col("_n") - 1).cast("bigint").alias("_rest"))
                       for i, q in enumerate(names) for j in (0, 1)])
    targets = sizes.select("_g", F.explode(wanted).alias("_e")).select("_g", "_e._t", "_e._rest", F.lit(0).cast("bigint").alias("_p"))
    passes = -(-bits // DIGIT)
    for k in range(passes):
        low = DIGIT * (passes - 1 - k)
        digit = F.shiftright("_w", low).bitwiseAND(F.lit((1 << DIGIT) - 1))
        prefix = F.shiftright("_w", low + DIGIT) if k else F.lit(0).cast("bigint")
        here = rows.select("_g", prefix.alias("_p"), digit.alias("_d"))
        if k:                                        # groups x positions prefixes at most
            open_ones = targets.select(F.col("_g").alias("_tg"), F.col("_p").alias("_tp")).distinct()
            here = here.join(open_ones, (F.col("_g") == F.col("_tg")) & (F.col("_p") == F.col("_tp")), "left_semi")
        counts = here.groupBy("_g", "_p", "_d").agg(F.count(F.lit(1)).alias("_c"))
        upto = Window.partitionBy("_g", "_p").orderBy("_d")              # at most 2 ** DIGIT rows
        counts = counts.withColumn("_upto", F.sum("_c").over(upto)).select(
            F.col("_g").alias("_cg"), F.col("_p").alias("_cp"), "_d", "_c", "_upto")
        targets = (targets.join(counts, (F.col("_g") == F.col("_cg")) & (F.col("_p") == F.col("_cp"))
                                & (F.col("_rest") >= F.col("_upto") - F.col("_c")) & (F.col("_rest") < F.col("_upto")))
                   .select("_g", "_t", (F.col("_rest") - F.col("_upto") + F.col("_c")).alias("_rest"),
                           (F.shiftleft("_p", DIGIT) + F.col("_d")).alias("_p")))
    found = targets.withColumn("_w", F.col("_p")).withColumn("_v", back)
    flat = found.groupBy("_g").agg(*[F.max(F.when(F.col("_t") == t, F.col("_v"))).alias(f"_v{t}") for t in range(2 * len(names))])
    out = flat.join(sizes, "_g")
    share = {q: place[q] - F.floor(place[q]) for q in names}
    cols = [(F.col(f"_v{2 * i}") + (F.col(f"_v{2 * i + 1}") - F.col(f"_v{2 * i}")) * share[q]).alias(q) for i, q in enumerate(names)]
    return out.select(F.col("_g").alias(group), F.col("_n").alias("count"), *cols)
