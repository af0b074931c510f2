"""Many KMeans runs over the same points, with the draws and steps of MLlib's.

A search over k with restarts is many small fits; run one by one, each step of each fit is a Spark job of its own
that reads all points.  Here a run is the same one, in other jobs: first centres by k-means|| with MLlib's random
numbers (``operators.draws``), then Lloyd's iterations, which end when none of its centres moved by more than ``tol`` or
after ``max_iter``; a cluster without points keeps its centre; the cost is that of the last pass.

1. Up to ``LOCAL_BYTES`` of points, a task reads them from the shared folder and makes a whole run.
2. More points are read once a step for every run that still moves: each task sums its points per run and cluster, and
   only sums (one row per run and cluster) or drawn points come to the driver, where the centres move.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import StorageLevel, TaskContext
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir, ship
from .draws import local_centres, one_of, seed_of, uniform
from .forest import _filesystem, _selector

BLOCK_ROWS = 4096
LOCAL_BYTES = 64 << 20
DRAWS = 2                          # MLlib's default of initSteps
_BLOCK = "part int, first bigint, n int, points binary"


class Block(NamedTuple):
    """Points that follow each other in a partition, from its ``first``."""
    part: int
    first: int
    points: np.ndarray


class Fit(NamedTuple):
    centres: np.ndarray
    cost: float
    iterations: int


def nearest(points: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centre of each point and the squared distance to it."""
    d, own = np.zeros((len(centres), len(points))), np.empty((len(centres), len(points)))
    for x, c in zip(points.T, centres.T):
        np.subtract(x, c[:, None], out=own)
        d += np.multiply(own, own, out=own)
    least, at = d[0], np.zeros(len(points), np.int64)
    for k in range(1, len(d)):                        # of equal distances the first centre's
        at[d[k] < least] = k
        least = np.minimum(least, d[k])
    return at, least


# ---------------------------------------------------------------- what a step does with a block, for every run
def _assigned(block: Block, centres: np.ndarray) -> np.ndarray:
    """Number, cost and sums of the points of each cluster."""
    at, d = nearest(block.points, centres)
    return np.stack([np.bincount(at, x, len(centres)) for x in (None, d, *block.points.T)], axis=1)


def _drawn(block: Block, sent: tuple) -> np.ndarray:
    """Points drawn in proportion to their squared distance from the centres, about 2 k of all points."""
    k, seed, centres, total = sent
    _, d = nearest(block.points, centres)
    with np.errstate(divide="ignore", invalid="ignore"):
        return block.points[uniform(seed ^ block.part, block.first, len(d)) < 2.0 * d * k / total]


def _placed(block: Block, at: tuple[int, int]) -> np.ndarray:
    """The point of a partition and position."""
    k = at[1] - block.first
    return block.points[k:k + 1] if block.part == at[0] and 0 <= k < len(block.points) else block.points[:0]


Step = Callable[[Callable, dict], dict]            # (what to do with a block, run -> what it is sent) -> run -> result


def _starts(jobs: dict[int, tuple[int, int]], sizes: list[int], sums: Step, rows: Step) -> dict[int, np.ndarray]:
    """run -> first centres of the (k, seed)."""
    seeds = {run: seed_of(seed) for run, (_, seed) in jobs.items()}
    centres = rows(_placed, {run: one_of(sizes, seed) for run, seed in seeds.items()})
    for step in range(DRAWS):
        totals = {run: s[:, 1].sum() for run, s in sums(_assigned, centres).items()}
        new = rows(_drawn, {run: (k, seeds[run] ^ (step << 16), centres[run], totals[run]) for run, (k, _) in jobs.items()})
        centres = {run: np.concatenate([c, new[run]]) for run, c in centres.items()}
    centres = {run: np.array(list(dict.fromkeys(map(tuple, c.tolist())))) for run, c in centres.items()}
    many = {run: c for run, c in centres.items() if len(c) > jobs[run][0]}
    for run, s in sums(_assigned, many).items() if many else ():
        centres[run] = local_centres(many[run], s[:, 0], jobs[run][0], nearest)
    return centres


def _moved(starts: dict[int, np.ndarray], sums: Step, max_iter: int, tol: float) -> dict[int, Fit]:
    """Lloyd's iterations of all runs."""
    centres = {run: np.array(c, np.float64) for run, c in starts.items()}
    fits = {run: Fit(c, 0.0, 0) for run, c in centres.items()}
    moving = list(centres)
    for _ in range(max_iter):
        got, still = sums(_assigned, {run: centres[run] for run in moving}), []
        for run in moving:
            c, s = centres[run], got[run]
            on = s[:, 0] > 0
            new = s[on, 2:] / s[on, :1]
            if (((new - c[on]) ** 2).sum(axis=1) > tol * tol).any():
                still.append(run)
            c[on] = new
            fits[run] = Fit(c, float(s[:, 1].sum()), fits[run].iterations + 1)
        moving = still
        if not moving:
            break
    return fits


# ---------------------------------------------------------------- blocks
def packed(rows: DataFrame, values: Column) -> DataFrame:
    """Points (arrays of doubles) packed to a binary per ``BLOCK_ROWS``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, first = TaskContext.get().partitionId(), 0
        for b in batches:
            for lo in range(0, b.num_rows, BLOCK_ROWS):
                some = b.column(0).slice(lo, BLOCK_ROWS)
                points = some.flatten().to_numpy(zero_copy_only=False).reshape(len(some), -1).T     # input by input
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part], pa.int32()), pa.array([first], pa.int64()), pa.array([len(some)], pa.int32()),
                     pa.array([points.tobytes()], pa.binary())], names=["part", "first", "n", "points"])
                first += len(some)

    return rows.select(values.alias("v")).mapInArrow(run, _BLOCK)


def _unpack(table) -> Iterator[Block]:
    for part, first, n, points in zip(*(table.column(c).to_pylist() for c in ("part", "first", "n", "points"))):
        yield Block(part, first, np.frombuffer(points, np.float64).reshape(-1, n).T)


def stored(folder: str) -> list[Block]:
    """All blocks of a folder, in the order of the points."""
    fs, base = _filesystem(folder)
    files = [f.path for f in fs.get_file_info(_selector(base)) if f.path.endswith(".parquet")]
    return sorted((b for f in files for b in _unpack(pq.ParquetFile(fs.open_input_file(f)).read())), key=lambda b: b[:2])


def _here(blocks: list[Block]) -> tuple[Step, Step]:
    """Sums of the blocks' results, and their results one after the other."""
    def sums(what, sent: dict) -> dict:
        return {run: sum(what(b, x) for b in blocks) for run, x in sent.items()}

    def rows(what, sent: dict) -> dict:
        return {run: np.concatenate([what(b, x) for b in blocks]) for run, x in sent.items()}

    return sums, rows


def _jobs_over(blocks: DataFrame, size: int) -> tuple[Step, Step]:
    """The same by a job over the blocks."""
    sc = blocks.sparkSession.sparkContext
    cols = [f"c{i}" for i in range(size + 2)]

    def sums(what, sent: dict) -> dict:
        given = sc.broadcast(sent)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found: dict = {}
            for b in (b for batch in batches for b in _unpack(batch)):
                for r, x in given.value.items():
                    one = what(b, x)
                    found[r] = found[r] + one if r in found else one
            if found:
                runs = pa.array(np.repeat(list(found), [len(x) for x in found.values()]), pa.int32())
                at = pa.array(np.concatenate([np.arange(len(x)) for x in found.values()]), pa.int32())
                yield pa.RecordBatch.from_arrays([runs, at, *map(pa.array, np.concatenate(list(found.values())).T.copy())],
                                                 names=["run", "at", *cols])

        got = (blocks.mapInArrow(run, "run int, at int, " + ", ".join(f"{c} double" for c in cols)).groupBy("run", "at")
               .agg(*[F.sum(c).alias(c) for c in cols]).collect())
        given.destroy()
        out: dict = {}
        for r in sorted(got, key=lambda r: (r.run, r["at"])):
            out.setdefault(r.run, []).append(r[2:])
        return {r: np.array(x) for r, x in out.items()}

    def rows(what, sent: dict) -> dict:
        given = sc.broadcast(sent)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in (b for batch in batches for b in _unpack(batch)):
                found = [(r, x) for r, x in ((r, what(b, x)) for r, x in given.value.items()) if len(x)]
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r for r, _ in found], pa.int32()), pa.array([b.part] * len(found), pa.int32()),
                         pa.array([b.first] * len(found), pa.int64()), pa.array([x.tobytes() for _, x in found], pa.binary())],
                        names=["run", "part", "first", "points"])

        got = blocks.mapInArrow(run, "run int, part int, first bigint, points binary").collect()
        given.destroy()
        out = {r: [np.zeros((0, size))] for r in sent}
        for r in sorted(got, key=lambda r: (r.part, r.first)):
            out[r.run].append(np.frombuffer(r.points, np.float64).reshape(-1, size))
        return {r: np.concatenate(x) for r, x in out.items()}

    return sums, rows


# ---------------------------------------------------------------- runs
def sizes_of(found: list[tuple[int, int]]) -> list[int]:
    """Points per partition, from (partition, points)."""
    out = [0] * (1 + max((part for part, _ in found), default=-1))
    for part, n in found:
        out[part] += n
    return out


def fits(rows: DataFrame, vectors: str, jobs: list[tuple[int, int]], max_iter: int, tol: float,
         local_bytes: int = LOCAL_BYTES) -> list[Fit]:
    """MLlib's fit of each (k, seed)."""
    spark = rows.sparkSession
    ship(spark)
    folder = scratch_dir(spark, f"points/{uuid.uuid4().hex}")
    packed(rows, vector_to_array(F.col(vectors))).write.mode("overwrite").parquet(folder)
    blocks = spark.read.schema(_BLOCK).parquet(folder)
    found = blocks.groupBy("part").agg(F.sum("n").alias("n"), F.sum(F.octet_length("points")).alias("bytes")).collect()
    n, held = (sum(r[c] for r in found) for c in ("n", "bytes"))
    if not n:
        raise ValueError("no points to cluster")
    if held <= local_bytes:
        return _whole_runs(spark, folder, jobs, max_iter, tol)
    blocks = blocks.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        sums, rows_of = _jobs_over(blocks, held // n // 8)
        starts = _starts(dict(enumerate(jobs)), sizes_of([(r.part, r.n) for r in found]), sums, rows_of)
        done = _moved(starts, sums, max_iter, tol)
    finally:
        blocks.unpersist()
    return [done[run] for run in range(len(jobs))]


def _whole_runs(spark: SparkSession, folder: str, jobs: list[tuple[int, int]], max_iter: int, tol: float) -> list[Fit]:
    order = sorted(range(len(jobs)), key=lambda run: -jobs[run][0])        # long runs first

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in (order[i] for b in batches for i in b.column("id").to_pylist()):
            blocks = stored(folder)
            sums, rows = _here(blocks)
            starts = _starts({r: jobs[r]}, sizes_of([(b.part, len(b.points)) for b in blocks]), sums, rows)
            fit = _moved(starts, sums, max_iter, tol)[r]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r], pa.int32()), pa.array([fit.cost]), pa.array([fit.iterations], pa.int32()),
                 pa.array([len(fit.centres)], pa.int32()), pa.array([fit.centres.tobytes()], pa.binary())],
                names=["run", "cost", "iterations", "n", "centres"])

    got = spark.range(0, len(jobs), 1, len(jobs)).mapInArrow(
        run, "run int, cost double, iterations int, n int, centres binary").collect()
    return [Fit(np.frombuffer(r.centres, np.float64).reshape(r.n, -1), r.cost, r.iterations)
            for r in sorted(got, key=lambda r: r.run)]


def lloyd(rows: DataFrame, vectors: str, starts: list[list[np.ndarray]], max_iter: int, tol: float) -> list[float]:
    """The cost that each run ends with, from its first centres."""
    ship(rows.sparkSession)
    blocks = packed(rows, vector_to_array(F.col(vectors))).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        sums, _ = _jobs_over(blocks, len(starts[0][0]))
        return [f.cost for f in _moved(dict(enumerate(starts)), sums, max_iter, tol).values()]
    finally:
        blocks.unpersist()
