"""Random forest regression for a whole parameter grid and all folds at once.

A grid search over trees x depth x split size x leaf size with k folds needs one forest per leaf size
and fold only, because the rest nests:

* the split of a node does not depend on the depth limit or on the least rows of a split, so a tree grown
  without them, cut at a depth or at nodes of too few rows, is the tree fitted with that limit;
* the forest of 100 trees is the first 100 of 200 (a tree depends on its number only).

So ``fit`` grows ``leaves x folds x trees`` trees and reads every grid point off them; they are used and dropped,
as all of them together are far larger than the data.  What is kept is a few sums per left-out row; the forest of the
chosen point is grown afterwards, within its limits (``keep_forest``).  Inputs are binned once to one byte each.
Row weights of a tree are Poisson(1) draws from a hash of the row and the tree's number: the bootstrap, known
everywhere without being stored.  Labels are taken to ``LABEL_STEP``, so that sums are exact and equally good splits
are told apart the same way whatever else a task holds.

Growing has two forms, so that neither data nor trees pass through one task or pile up on disk:

1. Up to ``LOCAL_ROWS`` training rows, a task reads them from the shared folder and grows the trees of a leaf size,
   fold and part (the trees between two forest sizes of the grid), so no row is sent.  Parts of a fold meet block by
   block, as sums of predictions; a job holds as many leaf sizes as send ``SEARCH_BYTES`` of them, one at least.
2. More rows go in rounds of a few trees.  While a node holds more than ``LOCAL_ROWS`` rows its split comes from
   histograms: every task sums its rows per open node, input and bin (a job a level), histograms of a node meet in
   one group, and only the chosen splits come to the driver.  The rows of a smaller node (a cell) meet in one task,
   which grows the whole subtree with numpy.  A round sends ``ROUND_BYTES`` of rows, or those of one tree in all folds
   if that is more, and adds its predictions to a running sum per left-out row.

Models are Parquet tables of packed trees (``_packed``: the sums of the leaves, from which those of the nodes above
follow); scoring tasks read them from the shared folder part by part, ``PART_NODES`` nodes at most at once.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import free, ship

BINS, COARSE = 256, 8              # histograms of large nodes join 8 neighbouring bins
LOCAL_ROWS = 1_000_000
TREES = 5                          # trees of a task that share rows
AT_ONCE = 1 << 21                  # (row, input) pairs that a search for splits holds
ROUND_BYTES = 256 << 20            # rows sent in a round
SEARCH_BYTES = 64 << 20            # sums of predictions sent in a job
BLOCK_ROWS = 8192
PART_NODES = 2_000_000
LABEL_STEP = 2.0 ** -16
NO_LIMIT = 1 << 20                 # a depth that no tree reaches

_POISSON = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(18)])


def weights(rows: np.ndarray, tree: int) -> np.ndarray:
    """Poisson(1) draws for (row hash, tree)."""
    x = rows.view(np.uint64) + np.uint64((tree + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    x ^= x >> np.uint64(31)
    return np.searchsorted(_POISSON, (x >> np.uint64(11)) * 2.0 ** -53, side="right").astype(np.uint8)


class Tree(NamedTuple):
    """Nodes by number: ``feature`` (-1: leaf, -2: goes on in cell ``left``), rows with a bin up to ``cut`` go to
    ``left``, others to ``left + 1``; ``value`` is the weighted mean, ``count`` the distinct rows, ``weight`` their
    weights (not known in an upper part)."""
    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    value: np.ndarray
    count: np.ndarray
    gain: np.ndarray
    weight: np.ndarray = np.zeros(0, np.int64)


_KINDS = Tree(np.int16, np.uint8, np.int32, np.float64, np.int64, np.float64, np.int64)


def _best(lc, lw, ly, rc, rw, ry, min_leaf: int) -> np.ndarray:
    """Sum of squares explained by a split, -1 where a side has too few rows."""
    with np.errstate(divide="ignore", invalid="ignore"):
        s = ly * ly / lw + ry * ry / rw
    return np.where((lc >= min_leaf) & (rc >= min_leaf), s, -1.0)


def _from_histograms(hc, hw, hy, min_leaf: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best score of each node, its feature and its cut, from ``[node, feature, bin]`` counts and sums."""
    c, w, y = (np.cumsum(h, axis=2) for h in (hc, hw, hy))
    s = _best(c, w, y, c[:, :, -1:] - c, w[:, :, -1:] - w, y[:, :, -1:] - y, min_leaf)
    flat = s.reshape(len(s), -1)
    at = flat.argmax(axis=1)
    return flat[np.arange(len(s)), at], at // s.shape[2], at % s.shape[2]


def _from_rows(bins, w, wy, node, nodes: int, min_leaf: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same by sorting (node, feature, bin), for nodes of few rows."""
    n, features = bins.shape
    group = (node[:, None] * features + np.arange(features)).astype(np.int64)
    key = np.sort((((group * BINS + bins) * n) + np.arange(n)[:, None]).ravel())
    row, key = key % n, key // n
    group = key // BINS
    first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    size = np.diff(np.concatenate([first, [len(key)]]))
    which = np.repeat(np.arange(len(first)), size)
    cw, cy = np.cumsum(w[row]), np.cumsum(wy[row])
    before_w, before_y = (np.concatenate([[0.0], x])[first] for x in (cw, cy))
    last = first + size - 1
    at = np.flatnonzero(np.concatenate([(key[1:] != key[:-1]) & (group[1:] == group[:-1]), [False]]))
    g = which[at]
    lc = at - first[g] + 1
    lw, ly = cw[at] - before_w[g], cy[at] - before_y[g]
    s = _best(lc, lw, ly, size[g] - lc, cw[last][g] - before_w[g] - lw, cy[last][g] - before_y[g] - ly, min_leaf)
    score, feature, cut = np.full(nodes, -1.0), np.zeros(nodes, np.int64), np.zeros(nodes, np.int64)
    if len(at):
        own = group[at] // features
        start = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        most = np.maximum.reduceat(s, start)
        span = np.diff(np.concatenate([start, [len(at)]]))
        best = np.minimum.reduceat(np.where(s == np.repeat(most, span), np.arange(len(at)), len(at)), start)
        here = own[start]
        score[here], feature[here], cut[here] = most, group[at][best] % features, key[at][best] % BINS
    return score, feature, cut


def _splits(bins, w, wy, node, nodes: int, min_leaf: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best score, feature and cut of each node, over as many inputs at once as ``AT_ONCE`` allows."""
    n, features = bins.shape
    step = max(1, AT_ONCE // max(n, nodes))
    score, feature, cut = np.full(nodes, -1.0), np.zeros(nodes, np.int64), np.zeros(nodes, np.int64)
    for first in range(0, features, step):
        own = bins[:, first:first + step]
        if nodes * BINS < n // 2:
            some = own.shape[1]
            key = ((node[:, None] * some + np.arange(some)) * BINS + own).ravel()
            got = _from_histograms(*(np.bincount(key, x, nodes * some * BINS).reshape(nodes, some, BINS) for x in (
                None, np.repeat(w, some), np.repeat(wy, some))), min_leaf)
        else:
            got = _from_rows(own, w, wy, node, nodes, min_leaf)
        on = got[0] > score                           # of equal scores the first input's
        score[on], feature[on], cut[on] = got[0][on], got[1][on] + first, got[2][on]
    return score, feature, cut


def grow(bins: np.ndarray, y: np.ndarray, w: np.ndarray, min_leaf: int, max_depth: int = NO_LIMIT,
         min_split: int = 2) -> Tree:
    """A tree over rows of bins, level by level; without limits it can be cut to any of them."""
    bins, y, w = bins[w > 0], y[w > 0], w[w > 0].astype(np.float64)
    parts, node, nodes, total, depth = [], np.zeros(len(y), np.int64), 1, 1, 0
    while nodes:
        wy = w * y
        c = np.bincount(node, minlength=nodes)
        sw, sy = np.bincount(node, w, nodes), np.bincount(node, wy, nodes)
        spread = np.bincount(node, wy * y, nodes) - sy * sy / np.maximum(sw, 1e-300)
        can = (c >= max(2 * min_leaf, min_split)) & (spread > 1e-9 * (1 + np.abs(sy))) & (depth < max_depth)
        number = np.cumsum(can) - 1                   # nodes that may split, renumbered
        keep = can[node]
        bins, y, w, wy, node = bins[keep], y[keep], w[keep], wy[keep], number[node[keep]]
        m = int(can.sum())
        feature, cut, left, gain = np.full(nodes, -1), np.zeros(nodes), np.full(nodes, -1), np.zeros(nodes)
        if m:
            score, best, at = _splits(bins, w, wy, node, m, min_leaf)
            split = score >= 0
            where = np.flatnonzero(can)[split]
            child = 2 * np.arange(len(where))
            feature[where], cut[where], left[where] = best[split], at[split], total + child
            gain[where] = np.maximum(score[split] - (sy * sy / np.maximum(sw, 1e-300))[where], 0.0)
            keep = split[node]
            bins, y, w, node = bins[keep], y[keep], w[keep], node[keep]
            right = bins[np.arange(len(node)), best[node]] > at[node]
            node = 2 * (np.cumsum(split) - 1)[node] + right
        parts.append((feature, cut, left, sy / np.maximum(sw, 1e-300), c, gain, sw))
        nodes = 2 * int((feature >= 0).sum())
        total += nodes
        depth += 1
    return Tree(*(np.concatenate(x).astype(k) for x, k in zip(zip(*parts), _KINDS)))


def predictions(tree: Tree, bins: np.ndarray, cuts: list[tuple[int, int]], path: tuple = ()) -> np.ndarray:
    """``[cut, row]``: the value where each row stops in the tree cut at (depth, least rows of a split).
    ``path`` holds the values of the nodes above the tree's root."""
    out = np.empty((len(cuts), len(bins)))
    at, rows, depth = np.zeros(len(bins), np.int64), np.arange(len(bins)), len(path)
    going = np.ones(out.shape, bool)
    for k, (most, _) in enumerate(cuts):
        if most < depth:
            out[k], going[k] = path[most], False
    while len(rows):
        inner = tree.feature[at] >= 0
        for k, (most, least) in enumerate(cuts):
            stop = going[k, rows] & (~inner | (tree.count[at] < least) | (depth >= most))
            out[k, rows[stop]] = tree.value[at[stop]]
            going[k, rows[stop]] = False
        on = inner & going[:, rows].any(axis=0)
        rows, at = rows[on], at[on]
        at = tree.left[at] + (bins[rows, tree.feature[at]] > tree.cut[at])
        depth += 1
    return out


def _ends(tree: Tree, bins: np.ndarray) -> np.ndarray:
    """The node where each row stops."""
    at, rows = np.zeros(len(bins), np.int64), np.arange(len(bins))
    while len(rows):
        rows = rows[tree.feature[at[rows]] >= 0]
        own = at[rows]
        at[rows] = tree.left[own] + (bins[rows, tree.feature[own]] > tree.cut[own])
    return at


# ---------------------------------------------------------------- binned rows, in blocks
_BLOCK = "h binary, fold binary, y binary, bins binary"


class Rows(NamedTuple):
    h: np.ndarray
    fold: np.ndarray
    y: np.ndarray
    bins: np.ndarray

    def pack(self) -> list[bytes]:
        return [np.ascontiguousarray(x).tobytes() for x in self]

    def take(self, on: np.ndarray) -> Rows:
        return Rows(*(x[on] for x in self))


def _unpack(batch, features: int) -> Rows:
    parts = [b"".join(batch[c].to_pylist()) for c in ("h", "fold", "y", "bins")]
    h, fold, y, bins = (np.frombuffer(x, k) for x, k in zip(parts, (np.int64, np.int8, np.float64, np.uint8)))
    return Rows(h, fold, y, bins.reshape(-1, features))


def cut_points(rows: DataFrame, inputs: list[str], accuracy: int = 10_000) -> list[list[float]]:
    """At most ``BINS - 1`` increasing cuts per input (approximate quantiles), the only thing that is collected."""
    at = [k / BINS for k in range(1, BINS)]
    got = rows.agg(*[F.percentile_approx(F.col(c).cast("double"), at, accuracy).alias(c) for c in inputs]).first()
    return [sorted(set(got[c] or [])) for c in inputs]


def binned(values: np.ndarray, cuts: list[list[float]]) -> np.ndarray:
    """Bins of all inputs; an input of few cuts has its bins spread over the byte, so joining neighbours keeps them apart."""
    out = np.empty(values.shape, np.uint8)
    for k, own in enumerate(cuts):
        out[:, k] = np.searchsorted(own, values[:, k], side="left") * (BINS // (len(own) + 1))
    return out


def _values(batch: pa.RecordBatch, inputs: list[str]) -> np.ndarray:
    return np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in inputs], axis=1).astype(np.float64)


def _blocks(rows: DataFrame, key: str, label: str, inputs: list[str], cuts, folds: int, seed: int) -> DataFrame:
    h = F.xxhash64(F.col(key), F.col(label).cast("double"), *[F.col(c).cast("double") for c in inputs], F.lit(seed))
    fold = F.pmod(F.xxhash64(F.col(key), F.lit(seed + 1)), F.lit(folds)).cast("int")
    y = F.round(F.col(label).cast("double") / LABEL_STEP) * LABEL_STEP

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, BLOCK_ROWS):
                part = b.slice(lo, BLOCK_ROWS)
                own = Rows(part.column("_h").to_numpy(), part.column("_fold").to_numpy().astype(np.int8),
                           part.column("_y").to_numpy(), binned(_values(part, inputs), cuts))
                yield pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in own.pack()],
                                                 names=["h", "fold", "y", "bins"])

    return (rows.select(h.alias("_h"), fold.alias("_fold"), y.alias("_y"),
                        *[F.col(c).cast("double").alias(c) for c in inputs]).mapInArrow(run, _BLOCK))


# ---------------------------------------------------------------- tops: nodes of many rows
class _Top:
    """The upper part of one tree while it grows: node lists, and the nodes that are still open."""

    def __init__(self):
        self.nodes = [[-2, 0, 0, 0.0, 0, 0.0]]
        self.up = [-1]
        self.open = [0]

    def tree(self) -> Tree:
        return Tree(*(np.array(x, k) for x, k in zip(zip(*self.nodes), _KINDS)))

    def path(self, node: int) -> tuple:
        out = []
        while self.up[node] >= 0:
            node = self.up[node]
            out.append(self.nodes[node][3])
        return tuple(reversed(out))

    def cells(self) -> list[int]:
        return [k for k, n in enumerate(self.nodes) if n[0] == -2]


def _tops(blocks: DataFrame, keys: list[tuple[int, int, int]], features: int, local_rows: int) -> dict:
    """(leaf, fold, tree) -> the upper part of the tree, split until every node has at most ``local_rows`` rows."""
    tops = {k: _Top() for k in keys}
    coarse = BINS // COARSE
    shape = (features, coarse, 3)
    sc = blocks.sparkSession.sparkContext
    while any(t.open for t in tops.values()):
        sent = sc.broadcast([(key, t.tree(), t.open) for key, t in tops.items() if t.open])

        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: dict = {}

            def flush() -> pa.RecordBatch:
                where = [[*key, node] for key, node in held]
                out = pa.RecordBatch.from_arrays(
                    [*(pa.array(x, pa.int32()) for x in zip(*where)),
                     pa.array([x.tobytes() for x in held.values()], pa.binary())],
                    names=["leaf", "fold", "tree", "node", "sums"])
                held.clear()
                return out

            for b in batches:
                rows = _unpack(b, features)
                for key, tree, opened in sent.value:
                    w = weights(rows.h, key[2])
                    on = np.flatnonzero((rows.fold != key[1]) & (w > 0))
                    at = _ends(tree, rows.bins[on])
                    for node in opened:
                        own = on[at == node]
                        if not len(own):
                            continue
                        place = (np.arange(features) * coarse + rows.bins[own] // COARSE).ravel()
                        ww, y = w[own].astype(np.float64), rows.y[own]
                        one = np.stack([np.bincount(place, None if x is None else np.repeat(x, features), features * coarse)
                                        for x in (None, ww, ww * y)], axis=1).reshape(shape)
                        one = np.concatenate([one.ravel(), [(ww * y * y).sum()]])
                        held[key, node] = held[key, node] + one if (key, node) in held else one
                        if len(held) >= 2048:
                            yield flush()
            if held:
                yield flush()

        def chosen(key: tuple, group: pa.Table) -> pa.Table:
            total = sum(np.frombuffer(x, np.float64) for x in group["sums"].to_pylist())
            hc, hw, hy = np.moveaxis(total[:-1].reshape(1, *shape), 3, 0)
            c, w, y = hc[0, 0].sum(), hw[0, 0].sum(), hy[0, 0].sum()
            score, feature, cut = _from_histograms(hc, hw, hy, key[0].as_py())
            f, k = int(feature[0]), int(cut[0])
            split = score[0] >= 0 and total[-1] - y * y / w > 1e-9 * (1 + abs(y))
            return pa.table({
                **{name: pa.array([x.as_py()], pa.int32()) for name, x in zip(("leaf", "fold", "tree", "node"), key)},
                "feature": pa.array([f if split else -1], pa.int32()), "cut": pa.array([(k + 1) * COARSE - 1], pa.int32()),
                "value": [y / w], "gain": [max(score[0] - y * y / w, 0.0) if split else 0.0],
                "count": [int(c)], "left": [int(hc[0, f, :k + 1].sum())]})

        got = (blocks.mapInArrow(sums, "leaf int, fold int, tree int, node int, sums binary")
               .groupBy("leaf", "fold", "tree", "node")
               .applyInArrow(chosen, "leaf int, fold int, tree int, node int, feature int, cut int, value double, "
                                     "gain double, count bigint, left bigint").collect())
        sent.destroy()
        for t in tops.values():
            t.open = []
        for r in got:
            t = tops[r.leaf, r.fold, r.tree]
            if r.feature >= 0:
                t.nodes[r.node] = [r.feature, r.cut, len(t.nodes), r.value, r["count"], r.gain]
                for n in (r.left, r["count"] - r.left):
                    if n > local_rows:
                        t.open.append(len(t.nodes))
                    t.nodes.append([-2, 0, 0, 0.0, 0, 0.0])
                    t.up.append(r.node)
            else:
                t.nodes[r.node] = [-1, 0, -1, r.value, r["count"], 0.0]
    return tops


# ---------------------------------------------------------------- growing
_TREE = "tree int, cell int, nodes int, " + ", ".join(f"{f} binary" for f in Tree._fields)
_ERRORS = "leaf int, fold int, part int, mae array<double>"


def _trees_table(trees: list[tuple[int, int, Tree]]) -> pa.RecordBatch:
    """Packed trees: number, cell (-1: upper part, whole), nodes, and the node lists."""
    own = [g if c < 0 else _packed(g) for _, c, g in trees]
    ids = [pa.array([int(v) for v in x], pa.int32()) for x in (
        [t for t, _, _ in trees], [c for _, c, _ in trees], [len(g.feature) for g in own])]
    lists = [pa.array([x.astype(k).tobytes() for x in some], pa.binary()) for some, k in zip(zip(*own), _KINDS)]
    return pa.RecordBatch.from_arrays([*ids, *lists], names=["tree", "cell", "nodes", *Tree._fields])


def _tree_of(row) -> Tree:
    own = Tree(*(np.frombuffer(row[f], k) for f, k in zip(Tree._fields, _KINDS)))
    return own if row["cell"] < 0 else _unpacked(own)


def _packed(tree: Tree) -> Tree:
    """A tree of ``grow`` without what follows from the rest: children are numbered in the order of their parents, and
    sums of inner nodes are those of their leaves."""
    leaf, none = tree.feature < 0, np.zeros(0)
    return Tree(tree.feature, tree.cut[~leaf], none, tree.value[leaf], tree.count[leaf], none, tree.weight[leaf])


def _unpacked(tree: Tree) -> Tree:
    n, inner, leaf = len(tree.feature), np.flatnonzero(tree.feature >= 0), np.flatnonzero(tree.feature < 0)
    left, cut, gain = np.full(n, -1), np.zeros(n), np.zeros(n)
    left[inner], cut[inner] = 1 + 2 * np.arange(len(inner)), tree.cut
    c, w, y = sums = np.zeros(n), np.zeros(n), np.zeros(n)
    c[leaf], w[leaf] = tree.count, tree.weight
    y[leaf] = np.rint(tree.value * tree.weight / LABEL_STEP) * LABEL_STEP         # labels are whole steps
    levels = [0, 1]
    while levels[-1] < n:
        levels.append(1 + 2 * int(np.searchsorted(inner, levels[-1])))
    for lo, hi in reversed(list(zip(levels, levels[1:]))):
        own = inner[slice(*np.searchsorted(inner, (lo, hi)))]
        for x in sums:
            x[own] = x[left[own]] + x[left[own] + 1]
    value = y / np.maximum(w, 1e-300)
    value[leaf] = tree.value
    lc, rc = left[inner], left[inner] + 1
    gain[inner] = np.maximum(y[lc] * y[lc] / w[lc] + y[rc] * y[rc] / w[rc] - y[inner] * y[inner] / w[inner], 0.0)
    return Tree(*(x.astype(k) for x, k in zip((tree.feature, cut, left, value, c, gain, w), _KINDS)))


def _parts_of(grid: dict) -> list[tuple[int, int]]:
    """First and last + 1 tree between two forest sizes: a size's forest is its part and all before."""
    sizes = sorted(grid["trees"])
    return list(zip([0, *sizes], sizes))


def _stored(folder: str, features: int) -> Rows:
    """All binned rows of a folder, in an order that does not depend on the blocks (equal hashes are equal rows)."""
    fs, base = _filesystem(folder)
    files = sorted(f.path for f in fs.get_file_info(_selector(base)) if f.path.endswith(".parquet"))
    own = _unpack(pa.concat_tables([pq.ParquetFile(fs.open_input_file(f)).read() for f in files]), features)
    return own.take(np.argsort(own.h, kind="stable"))


def fit(rows: DataFrame, key: str, label: str, inputs: list[str], grid: dict, folds: int, seed: int, path: str,
        local_rows: int = LOCAL_ROWS) -> list[list[float]]:
    """Search the grid; the errors of its points go to ``path`` (``scores``).  Returns the cuts of the inputs.

    ``grid`` has lists ``trees``, ``depths``, ``splits`` and ``leaves``.
    """
    spark, features = rows.sparkSession, len(inputs)
    ship(spark)
    cuts = cut_points(rows, inputs)
    blocks = _blocks(rows, key, label, inputs, cuts, folds, seed)
    blocks.write.mode("overwrite").parquet(f"{path}/rows")
    blocks = spark.read.schema(_BLOCK).parquet(f"{path}/rows")
    n = int(blocks.agg(F.sum(F.octet_length("y") / 8)).first()[0] or 0)
    facts = {"features": features, "rows": n, "local_rows": local_rows}
    spark.createDataFrame([(json.dumps(facts),)], "facts string").coalesce(1).write.mode("overwrite").text(f"{path}/facts")
    if n <= local_rows:
        _search_whole(spark, path, features, grid, folds, n)
    else:
        _search_rounds(spark, path, features, grid, folds, n, local_rows)
    return cuts


def _leaf_jobs(grid: dict, n: int) -> list[list[int]]:
    """Leaf sizes in jobs that send ``SEARCH_BYTES`` of sums, one leaf size at least."""
    leaves, own = grid["leaves"], n * 8 * (len(grid_cuts(grid)) + 1) * len(grid["trees"])
    some = max(1, SEARCH_BYTES // max(1, own))
    return [leaves[k:k + some] for k in range(0, len(leaves), some)]


def _search_whole(spark: SparkSession, path: str, features: int, grid: dict, folds: int, n: int) -> None:
    points, parts = grid_cuts(grid), _parts_of(grid)
    spark.createDataFrame([], _ERRORS).write.mode("overwrite").parquet(f"{path}/errors")
    for leaves in _leaf_jobs(grid, n):
        _search_leaves(spark, path, features, points, parts, leaves, folds)
        free(spark)


def _search_leaves(spark: SparkSession, path: str, features: int, points: list, parts: list, leaves: list[int], folds: int) -> None:
    keys = [(leaf, fold, k) for leaf in leaves for fold in range(folds) for k in range(len(parts))]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for leaf, fold, k in (keys[i] for b in batches for i in b.column("id").to_pylist()):
            own = _stored(f"{path}/rows", features)
            train, held = own.take(own.fold != fold), own.take(own.fold == fold)
            total = np.zeros((len(points), len(held.y)))
            for t in range(*parts[k]) if len(held.y) else ():
                total += predictions(grow(train.bins, train.y, weights(train.h, t), leaf), held.bins, points)
            for lo in range(0, len(held.y), BLOCK_ROWS):
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array([v], pa.int32()) for v in (leaf, fold, k, lo)),
                     *(pa.array([np.ascontiguousarray(x[..., lo:lo + BLOCK_ROWS]).tobytes()], pa.binary()) for x in (held.y, total))],
                    names=["leaf", "fold", "part", "block", "y", "sums"])

    def errors(k: tuple, group: pa.Table) -> pa.Table:
        """Summed absolute errors of a block's rows in the forest of each size."""
        found, total = [], 0.0
        for r in sorted(group.to_pylist(), key=lambda r: r["part"]):
            y = np.frombuffer(r["y"], np.float64)
            total = total + np.frombuffer(r["sums"], np.float64).reshape(len(points), len(y))
            found.append(np.abs(total / parts[r["part"]][1] - y).sum(axis=1).tolist())
        return pa.table({
            **{c: pa.array([k[i].as_py()] * len(found), pa.int32()) for i, c in enumerate(("leaf", "fold"))},
            "part": pa.array(range(len(found)), pa.int32()), "rows": pa.array([len(y)] * len(found), pa.int64()),
            "error": pa.array(found, pa.list_(pa.float64()))})

    (spark.range(0, len(keys), 1, len(keys))
     .mapInArrow(sums, "leaf int, fold int, part int, block int, y binary, sums binary").groupBy("leaf", "fold", "block")
     .applyInArrow(errors, "leaf int, fold int, part int, rows bigint, error array<double>").groupBy("leaf", "fold", "part")
     .agg(F.array(*[F.sum(F.col("error")[i]) / F.sum("rows") for i in range(len(points))]).alias("mae"))
     .write.mode("append").parquet(f"{path}/errors"))


def _batches(first: int, last: int, n: int, features: int, folds: int) -> list[range]:
    """Trees in rounds that send ``ROUND_BYTES`` of rows, one tree at least."""
    some = max(1, ROUND_BYTES // max(1, n * (features + 17) * folds))
    return [range(t, min(t + some, last)) for t in range(first, last, some)]


def _search_rounds(spark: SparkSession, path: str, features: int, grid: dict, folds: int, n: int, local_rows: int) -> None:
    points = grid_cuts(grid)
    cols = [f"s{k}" for k in range(len(points))]
    kinds = "fold int, h bigint, many bigint, y double, " + ", ".join(f"{c} double" for c in cols)
    spark.createDataFrame([], _ERRORS).write.mode("overwrite").parquet(f"{path}/errors")
    for leaf in grid["leaves"]:
        state, round_no = None, 0                     # sums of the trees so far, a row per left-out row
        for part, (first, last) in enumerate(_parts_of(grid)):
            for trees in _batches(first, last, n, features, folds):
                dealt, cell, _ = _cells(spark, path, features, [(leaf, f, t) for f in range(folds) for t in trees], local_rows)

                def said(k: tuple, group: pa.Table) -> pa.Table:
                    _, fold, _, _ = (x.as_py() for x in k)
                    own, grown, path_of = cell(k, group, leaf)
                    held = own.take(own.fold == fold)
                    h, at, many = np.unique(held.h, return_index=True, return_counts=True)
                    held = held.take(at)              # rows of one hash are equal: one stands for all of them
                    s = predictions(grown, held.bins, points, path_of)
                    return pa.table([pa.array(np.full(len(h), fold), pa.int32()), pa.array(h), pa.array(many, pa.int64()),
                                     pa.array(held.y), *map(pa.array, s)], names=["fold", "h", "many", "y", *cols])

                new = dealt.groupBy("leaf", "fold", "tree", "cell").applyInArrow(said, kinds)
                if state is not None:
                    new = new.unionByName(spark.read.schema(kinds).parquet(state))
                state = f"{path}/state_{round_no % 2}"
                (new.groupBy("fold", "h").agg(F.first("many").alias("many"), F.first("y").alias("y"), *[F.sum(c).alias(c) for c in cols])
                 .write.mode("overwrite").parquet(state))
                round_no += 1
                free(spark)
            errors = spark.read.schema(kinds).parquet(state).groupBy("fold").agg(F.array(*[
                F.sum(F.abs(F.col(c) / last - F.col("y")) * F.col("many")) / F.sum("many") for c in cols]).alias("mae"))
            (errors.select(F.lit(leaf).alias("leaf"), "fold", F.lit(part).alias("part"), "mae")
             .write.mode("append").parquet(f"{path}/errors"))


def _cells(spark: SparkSession, path: str, features: int, keys: list[tuple[int, int, int]], local_rows: int):
    """Grow the upper parts of some trees and deal their rows to cells.  Returns the dealt rows, a function for the group
    of a cell (its rows, the tree that goes on there and the values above it), and the upper parts."""
    blocks = spark.read.schema(_BLOCK).parquet(f"{path}/rows")
    tops = _tops(blocks, keys, features, local_rows)
    sent = spark.sparkContext.broadcast({k: (t.tree(), {c: t.path(c) for c in t.cells()}) for k, t in tops.items()})

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own = _unpack(b, features)
            for (leaf, fold, t), (top, cells) in sent.value.items():
                here = (own.fold == fold) | (weights(own.h, t) > 0)
                end = np.where(here, _ends(top, own.bins), -1)
                got = [(c, own.take(end == c)) for c in [*cells, *np.flatnonzero(top.feature == -1).tolist()]]
                got = [(c, x.pack()) for c, x in got if len(x.y)]
                if got:
                    ids = [pa.array([v] * len(got), pa.int32()) for v in (leaf, fold, t)]
                    yield pa.RecordBatch.from_arrays(
                        [*ids, pa.array([c for c, _ in got], pa.int32()),
                         *(pa.array([x[i] for _, x in got], pa.binary()) for i in range(4))],
                        names=["leaf", "fold", "tree", "cell", "h", "fold_of", "y", "bins"])

    def cell(k: tuple, group: pa.Table, min_leaf: int, most: int = NO_LIMIT, least: int = 2) -> tuple[Rows, Tree, tuple]:
        leaf, fold, t, c = (x.as_py() for x in k)
        own = _unpack(group.drop_columns(["fold"]).rename_columns({"fold_of": "fold"}), features)
        own = own.take(np.argsort(own.h, kind="stable"))
        top, cells = sent.value[leaf, fold, t]
        if c not in cells:                            # a leaf of the upper part: only the rows left out matter
            return own, top, ()
        train = own.take(own.fold != fold)
        return own, grow(train.bins, train.y, weights(train.h, t), min_leaf, most - len(cells[c]), least), cells[c]

    return blocks.mapInArrow(deal, "leaf int, fold int, tree int, cell int, h binary, fold_of binary, y binary, bins binary"), cell, {
        k: t.tree() for k, t in tops.items()}


def grid_cuts(grid: dict) -> list[tuple[int, int]]:
    """(depth, least rows of a split) of the grid, in its order; no depth is ``NO_LIMIT``."""
    return [(d or NO_LIMIT, s) for d in grid["depths"] for s in grid["splits"]]


def scores(spark: SparkSession, path: str, grid: dict, folds: int) -> DataFrame:
    """``trees, depth, min_split, min_leaf, point, cv_mae_mean, cv_mae_std`` per grid point, from the rows left out.

    A fold's score is the mean absolute error of its rows; ``point`` numbers the grid in its order."""
    points, sizes = grid_cuts(grid), sorted(grid["trees"])

    def at(values: list, k: str) -> Column:
        return F.element_at(F.array(*[F.lit(v).cast("int") for v in values]), F.col(k) + 1)

    flat = spark.read.schema(_ERRORS).parquet(f"{path}/errors").select("leaf", "fold", "part", F.posexplode("mae").alias("cut", "mae"))
    flat = flat.select("leaf", "fold", "cut", "mae", at(sizes, "part").alias("trees"), at([s for _, s in points], "cut").alias("min_split"),
                       at([d if d < NO_LIMIT else None for d, _ in points], "cut").alias("depth"))
    order = (F.array_position(F.array(*map(F.lit, grid["trees"])), F.col("trees")) * len(points) + F.col("cut")) * len(
        grid["leaves"]) + F.array_position(F.array(*map(F.lit, grid["leaves"])), F.col("min_leaf"))
    return (flat.groupBy("trees", "depth", "min_split", F.col("leaf").alias("min_leaf"), "cut")
            .agg(F.avg("mae").alias("cv_mae_mean"), F.stddev_pop("mae").alias("cv_mae_std"))
            .withColumn("point", order.cast("int")).drop("cut"))


def keep_forest(spark: SparkSession, path: str, out: str, leaf: int, trees: int, folds: int, depth: int | None = None,
                min_split: int = 2) -> None:
    """Grow the trees of all rows of a search with this leaf size as a table of their own, no deeper than ``depth``
    and ``min_split`` allow (cuts apply again when they are read)."""
    facts = json.loads(spark.read.text(f"{path}/facts").first()[0])
    features, n, most = facts["features"], facts["rows"], depth or NO_LIMIT
    if n <= facts["local_rows"]:
        def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for first in (i * TREES for b in batches for i in b.column("id").to_pylist()):
                own = _stored(f"{path}/rows", features)
                for t in range(first, min(first + TREES, trees)):
                    yield _trees_table([(t, 0, grow(own.bins, own.y, weights(own.h, t), leaf, most, min_split))])

        # a file a task, so trees lie in order and each in one file
        tasks = math.ceil(trees / TREES)
        spark.range(0, tasks, 1, tasks).mapInArrow(whole, _TREE).write.mode("overwrite").parquet(out, compression="zstd")
        return
    spark.createDataFrame([], _TREE).write.mode("overwrite").parquet(f"{path}/kept")
    for some in _batches(0, trees, n, features, 1):
        dealt, cell, tops = _cells(spark, path, features, [(leaf, folds, t) for t in some], facts["local_rows"])
        leaves = {t: set(np.flatnonzero(top.feature == -1).tolist()) for (_, _, t), top in tops.items()}

        def pieces(k: tuple, group: pa.Table) -> pa.Table:
            t, c = k[2].as_py(), k[3].as_py()
            if c in leaves[t]:
                return pa.Table.from_batches([_trees_table([(t, -1, tops[leaf, folds, t])])]).slice(0, 0)
            return pa.Table.from_batches([_trees_table([(t, c, cell(k, group, leaf, most, min_split)[1])])])

        spark.createDataFrame(pa.Table.from_batches([_trees_table([(t, -1, top) for (_, _, t), top in tops.items()])]),
                              _TREE).write.mode("append").parquet(f"{path}/kept", compression="zstd")
        (dealt.groupBy("leaf", "fold", "tree", "cell").applyInArrow(pieces, _TREE).write.mode("append").parquet(f"{path}/kept", compression="zstd"))
        free(spark)
    write_forest(spark.read.schema(_TREE).parquet(f"{path}/kept"), out)


def write_forest(rows: DataFrame, out: str) -> None:
    """Trees in order, each in one file."""
    (rows.select("tree", "cell", "nodes", *Tree._fields).repartitionByRange(8, "tree")
     .sortWithinPartitions("tree", "cell").write.mode("overwrite").parquet(out, compression="zstd"))


class Forest(NamedTuple):
    """A stored forest with its cuts of the inputs and of the trees."""
    folder: str
    inputs: list[str]
    cuts: list[list[float]]
    trees: int
    depth: int | None
    min_split: int

    def predict(self, rows: DataFrame, out: str = "prediction") -> DataFrame:
        """``rows`` with the mean of the trees' values."""
        ship(rows.sparkSession)
        names = [f"_in_{k}" for k in range(len(self.inputs))]
        keyed = rows.withColumns({n: F.col(c).cast("double") for n, c in zip(names, self.inputs)})
        columns = rows.columns
        schema = T.StructType([*rows.schema.fields, T.StructField(out, T.DoubleType())])
        cut = [(self.depth or NO_LIMIT, self.min_split)]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            whole = None                              # a forest of one part is read once
            for b in batches:
                bins = binned(_values(b, names), self.cuts)
                total, parts = np.zeros(len(bins)), 0
                for part in self._parts() if whole is None else [whole]:
                    parts += 1
                    for top, cells in part:
                        total += _value(top, cells, bins, cut)
                whole = part if parts == 1 else None
                arrays = [b.column(i) for i in range(len(columns))]
                yield pa.RecordBatch.from_arrays([*arrays, pa.array(total / self.trees)], names=[*columns, out])

        return keyed.select(*columns, *names).mapInArrow(run, schema)

    def _files(self) -> list[str]:
        fs, base = _filesystem(self.folder)
        return sorted(f.path for f in fs.get_file_info(_selector(base)) if f.path.endswith(".parquet"))

    def _parts(self, files: list[str] | None = None) -> Iterator[list[tuple[Tree, dict[int, Tree]]]]:
        """(upper part or whole tree, its cells) of whole trees, about ``PART_NODES`` nodes at once."""
        fs, _ = _filesystem(self.folder)
        files = self._files() if files is None else files
        part: dict[int, dict[int, Tree]] = {}
        nodes = 0
        for file in files:                            # a tree lies in one file, trees in order
            for batch in pq.ParquetFile(fs.open_input_file(file)).iter_batches(batch_size=16):
                for row in batch.to_pylist():
                    if row["tree"] not in part and nodes >= PART_NODES:
                        yield [_joined(x) for x in part.values()]
                        part, nodes = {}, 0
                    part.setdefault(row["tree"], {})[row["cell"]] = _tree_of(row)
                    nodes += row["nodes"]
        if part:
            yield [_joined(x) for x in part.values()]

    def importance(self, spark: SparkSession) -> list[float]:
        """Share of each input in the explained sum of squares, mean over the trees (a task reads a file of them)."""
        ship(spark)
        features, most, least, files = len(self.inputs), self.depth or NO_LIMIT, self.min_split, self._files()

        def shares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for file in (files[i] for b in batches for i in b.column("id").to_pylist()):
                for top, cells in (x for part in self._parts([file]) for x in part):
                    own = np.zeros(features)
                    for tree, depth in [(top, 0), *((t, len(_path_of(top, c))) for c, t in cells.items())]:
                        on = _inner(tree, most, least, depth)
                        np.add.at(own, tree.feature[on], tree.gain[on])
                    yield pa.RecordBatch.from_arrays([pa.array([(own / (own.sum() or 1.0)).tolist()])], names=["share"])

        got = spark.range(0, len(files), 1, len(files)).mapInArrow(shares, "share array<double>").collect()
        total = np.sum([r.share for r in got], axis=0)
        return (total / (total.sum() or 1.0)).tolist()


def _joined(pieces: dict[int, Tree]) -> tuple[Tree, dict[int, Tree]]:
    return (pieces[0], {}) if -1 not in pieces else (pieces[-1], {c: t for c, t in pieces.items() if c >= 0})


def _value(top: Tree, cells: dict[int, Tree], bins: np.ndarray, cut: list) -> np.ndarray:
    if not cells:
        return predictions(top, bins, cut)[0]
    end, out = _ends(top, bins), np.empty(len(bins))
    for node in np.unique(end):
        on = end == node
        tree, path = (cells[node], _path_of(top, node)) if node in cells else (top, ())
        out[on] = predictions(tree, bins[on], cut, path)[0]
    return out


def _path_of(top: Tree, node: int) -> tuple:
    """Values of the nodes above ``node``, from the root."""
    up = {int(c): k for k, left in enumerate(top.left.tolist()) if top.feature[k] >= 0 for c in (left, left + 1)}
    out = []
    while node in up:
        node = up[node]
        out.append(float(top.value[node]))
    return tuple(reversed(out))


def _inner(tree: Tree, most: int, least: int, depth: int) -> np.ndarray:
    """Nodes that still split in the cut tree."""
    on, level = np.zeros(len(tree.left), bool), np.array([0])
    while len(level) and depth < most:
        level = level[(tree.feature[level] >= 0) & (tree.count[level] >= least)]
        on[level] = True
        level = np.concatenate([tree.left[level], tree.left[level] + 1])
        depth += 1
    return on


def _filesystem(folder: str):
    from pyarrow import fs
    if folder.startswith("file:"):
        folder = "file:///" + folder[5:].lstrip("/")
    return fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")


def _selector(base: str):
    from pyarrow import fs
    return fs.FileSelector(base)
