"""NTILE by exact cut points: no sort of the whole table, no numbering, no checkpoint.

A row's tile follows from comparing its (value, key) with the ``n - 1`` rows that begin the other tiles.  Those
rows are found by exact selection, for all measures in the same passes:

1. A sample of the rows inside each open interval (one row, the least hash, per hash bucket: bounded however
   large the table is) gives two pivots around every wanted position.
2. One counting pass tells how many rows lie below each pivot; the position lies between two neighbours,
   which are the new interval.  Each round shrinks an interval to a few per cent.
3. When the intervals together hold at most ``FEW`` rows, these are collected and the rows picked exactly.

Only samples, counts and at most ``FEW`` rows reach the driver; a table of a billion rows takes three rounds.
Ties are broken by the key (NULL first), so tiles are those of ``NTILE(n) OVER (ORDER BY value, key)``.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SAMPLE = 4096                 # hash buckets, so rows sampled at most per interval
FEW = 20_000
_SPREAD = 4.0                 # pivots lie this many standard deviations of a sampled position apart


class Measure(NamedTuple):
    """A numeric column in the order of its tiles; NULL is first when rising and last when falling."""
    column: str
    ascending: bool = True


def _key(m: Measure, tie: str) -> Column:
    c = F.col(m.column)
    flag = c.isNotNull() if m.ascending else c.isNull()
    value = c if m.ascending else -c
    return F.struct(flag.cast("int").alias("f"), F.coalesce(value, F.lit(0)).alias("v"),
                    F.col(tie).isNotNull().cast("int").alias("g"), F.coalesce(F.col(tie), F.lit("")).alias("k"))


def _literal(row, kind: T.DataType) -> Column:
    flag, value, tie_flag, tie = row
    return F.struct(F.lit(flag).alias("f"), F.lit(value).cast(kind).alias("v"), F.lit(tie_flag).alias("g"), F.lit(tie).alias("k"))


def _kind(df: DataFrame, key: Column) -> T.DataType:
    """The type of a key's value (a sum's DECIMAL keeps its width)."""
    return df.select(key.alias("k")).schema["k"].dataType["v"].dataType


class _Target:
    """The search for one row: the interval [low, high) that holds it, and the rows below ``low``."""

    def __init__(self, measure: Measure, kind: T.DataType, position: int):
        self.measure, self.kind, self.position = measure, kind, position
        self.low = self.high = None
        self.below, self.inside = 0, None

    def holds(self, key: Column) -> Column:
        cond = F.lit(True)
        if self.low is not None:
            cond = cond & (key >= _literal(self.low, self.kind))
        if self.high is not None:
            cond = cond & (key < _literal(self.high, self.kind))
        return cond


def cut_rows(df: DataFrame, tie: str, measures: list[Measure], n: int, few: int = FEW, sample: int = SAMPLE) -> list[list]:
    """For each measure the keys (struct rows) that begin the tiles 2 to n; fewer if there are fewer rows.

    Runs jobs when it is called: one for small tables, else two a round and one more.
    """
    keys = {m: _key(m, tie) for m in measures}
    first = df.select(*[k.alias(f"k{i}") for i, k in enumerate(keys.values())]).limit(few + 1).collect()
    if len(first) <= few:
        return [[rows[p] for p in _positions(len(rows), n)]
                for rows in (sorted(r[i] for r in first) for i in range(len(measures)))]
    total = df.count()
    targets = [[_Target(m, _kind(df, keys[m]), p) for p in _positions(total, n)] for m in measures]
    flat = [t for own in targets for t in own]
    for t in flat:
        t.inside = total
    while sum(t.inside for t in flat) > few:
        _narrow(df, tie, keys, [t for t in flat if t.inside > 1], sample)
    found = _collect(df, tie, keys, flat)
    return [[found[t][t.position - t.below] for t in own] for own in targets]


def _positions(total: int, n: int) -> list[int]:
    """0-based positions at which the tiles 2 to n begin."""
    q, r = divmod(total, n)
    return [p for p in (j * q + min(j, r) for j in range(1, n)) if p < total]


def _tagged(df: DataFrame, tie: str, keys: dict, targets: list[_Target]) -> DataFrame:
    """``t, h, k0, k1, ...`` for every row inside an interval: the target's number, a hash of the row, all its keys."""
    inside = F.array_compact(F.array(*[F.when(t.holds(keys[t.measure]), F.lit(i)) for i, t in enumerate(targets)]))
    return df.select(F.explode(inside).alias("t"), F.xxhash64(tie, *[m.column for m in keys]).alias("h"),
                     *[k.alias(f"k{j}") for j, k in enumerate(keys.values())])


def _own(row, keys: dict, target: _Target):
    return row[f"k{list(keys).index(target.measure)}"]


def _narrow(df: DataFrame, tie: str, keys: dict, targets: list[_Target], sample: int) -> None:
    rows = (_tagged(df, tie, keys, targets).groupBy("t", F.pmod("h", F.lit(sample)).alias("b"))
            .agg(F.min_by(F.struct(*[f"k{j}" for j in range(len(keys))]), F.xxhash64("h", F.lit(29))).alias("row")).collect())
    drawn: dict[int, list] = {}
    for r in rows:
        drawn.setdefault(r.t, []).append(_own(r.row, keys, targets[r.t]))
    pivots = []
    for i, t in enumerate(targets):
        own = sorted(drawn.get(i, []))
        share = (t.position - t.below) / t.inside
        near = share * len(own)
        apart = _SPREAD * max(1.0, (len(own) * share * (1 - share)) ** 0.5)
        low, high = int(near - apart), int(near + apart) + 1
        pivots.append([own[k] for k in sorted({max(low, 0), min(high, len(own) - 1)}) if own])
    counts = [F.count_if(t.holds(keys[t.measure]) & (keys[t.measure] < _literal(p, t.kind))).alias(f"c{i}_{j}")
              for i, t in enumerate(targets) for j, p in enumerate(pivots[i])]
    got = df.agg(*counts).first()
    for i, t in enumerate(targets):
        low, high, below, upto = t.low, t.high, t.below, t.below + t.inside
        for j, p in enumerate(pivots[i]):
            under = t.below + got[f"c{i}_{j}"]
            if under <= t.position and under >= below:
                low, below = p, under
            elif under > t.position and under <= upto:
                high, upto = p, under
        t.low, t.high, t.below, t.inside = low, high, below, upto - below


def _collect(df: DataFrame, tie: str, keys: dict, targets: list[_Target]) -> dict[_Target, list]:
    out: dict[_Target, list] = {t: [] for t in targets}
    for r in _tagged(df, tie, keys, targets).collect():        # at most FEW rows
        out[targets[r.t]].append(_own(r, keys, targets[r.t]))
    return {t: sorted(rows) for t, rows in out.items()}


def ntiles(df: DataFrame, tie: str, measures: dict[str, Measure], n: int, few: int = FEW, sample: int = SAMPLE) -> DataFrame:
    """``df`` with a BIGINT tile 1..n per entry of ``measures`` (name of the new column -> measure).

    ``tie`` is a text column that tells rows apart."""
    source = df.select(tie, *{m.column for m in measures.values()})
    cuts = cut_rows(source, tie, list(measures.values()), n, few, sample)
    columns = {}
    for (name, m), own in zip(measures.items(), cuts):
        key = _key(m, tie)
        kind, tile = _kind(source, key), F.lit(1)
        for c in own:
            tile = tile + (key >= _literal(c, kind)).cast("int")
        columns[name] = tile.cast("bigint")
    return df.withColumns(columns)
