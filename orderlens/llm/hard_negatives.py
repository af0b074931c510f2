"""Operator 13: hard negatives by exact inner products, scored the Four-Russians way.

Components become integers, ``floor(scale * x)``.  For a block of anchors and every group of eight
dimensions a table holds the sum of each of the 256 subsets of the anchor's eight components, each
entry made from an earlier one by one addition.  A candidate is kept as bit planes in two's
complement: one byte per plane and group says which of the eight components have that bit.  A score
is then the sum over planes of ``+-2 ** plane`` times the entries that the plane's bytes look up:
no multiplication, and exact.

Anchors and candidates are dealt into blocks, and every pair of blocks (a cell) meets in one task
(``cogroup``), which holds at most about ``ANCHORS`` anchors and ``ROWS`` candidates; it emits only the
best few per anchor, and a window keeps the best of these.  Two passes: the best ``positives``
rows of the anchor's label, then per positive the best ``negatives`` rows of other labels whose
score is at most the positive's and at least ``least`` hundredths of it.  The first pass is written
under the checkpoint folder.  Nothing is broadcast, and no list per anchor is collected.

Cases: rows with a null id, label or vector, or a null, NaN or infinite component take no part;
an empty vector and a shorter one count as filled up with zeros; ties go by the smaller id;
rows with the anchor's id are not its positives or negatives; exactly repeated anchor rows
count once, repeated candidates each take a place; an empty table gives no rows; other columns are not
read.  A component whose integer needs more than ``MOST_BITS`` bits is an error, since scores would
not fit a long.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.llm.common import materialise

SCALE = 256
POSITIVES = NEGATIVES = 5
LEAST = 80                       # a negative's score in hundredths of the positive's
ANCHORS, ROWS = 4096, 4096       # of a cell, about
MOST_BITS = 26
_STEP_ANCHORS, _STEP_ROWS = 256, 512        # scored at once: fits the processor's cache
_NONE = np.iinfo(np.int64).min


def subset_tables(anchors: np.ndarray) -> np.ndarray:
    """``[group, byte, anchor]``: the sum of the components that the byte's bits choose."""
    a, dims = anchors.shape
    groups = -(-dims // 8)
    filled = np.zeros((groups * 8, a), anchors.dtype)
    filled[:dims] = anchors.T
    out = np.zeros((groups, 256, a), anchors.dtype)
    for g in range(groups):
        for j in range(8):
            out[g, 1 << j:2 << j] = out[g, :1 << j] + filled[8 * g + j]
    return out


def bit_planes(rows: np.ndarray) -> np.ndarray:
    """``[plane, row, group]`` bytes; the last plane is the sign's (weight ``-2 ** plane``)."""
    top = int(max(rows.max(initial=0), -(rows.min(initial=0) + 1)))
    bits = max(top, 0).bit_length() + 1
    return np.stack([np.packbits((rows >> b & 1).astype(np.uint8), axis=1, bitorder="little")
                     for b in range(bits)])


def scores(anchors: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """Inner products ``[row, anchor]`` of integer anchors with rows given by their planes."""
    bits, n, groups = planes.shape
    worst = int(np.abs(anchors).sum(axis=1).max(initial=0)) << bits
    kind = np.int32 if worst < 1 << 31 else np.int64
    out = np.empty((n, len(anchors)), np.int64)
    for s in range(0, len(anchors), _STEP_ANCHORS):
        tables = subset_tables(anchors[s:s + _STEP_ANCHORS].astype(kind))
        for r in range(0, n, _STEP_ROWS):
            part = planes[:, r:r + _STEP_ROWS]
            total = np.zeros((part.shape[1], tables.shape[2]), kind)
            for b in range(bits):
                plane = np.zeros_like(total)
                for g in range(groups):
                    plane += tables[g].take(part[b, :, g], axis=0)
                plane <<= kind(b)
                total += plane if b < bits - 1 else -plane
            out[r:r + _STEP_ROWS, s:s + _STEP_ANCHORS] = total
    return out


def _matrix(column: pa.ChunkedArray, dims: int) -> np.ndarray:
    rows = column.combine_chunks()
    size = rows.value_lengths().to_numpy(zero_copy_only=False)
    flat = rows.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(size), dims), np.int64)
    out[np.arange(dims) < size[:, None]] = flat
    return out


def _best(key: np.ndarray, allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(anchor, row) of the at most ``k`` allowed rows with the largest keys of each anchor."""
    key = np.where(allowed, key, _NONE)
    k = min(k, key.shape[1])
    at = np.argpartition(key, key.shape[1] - k, axis=1)[:, key.shape[1] - k:]
    anchor = np.repeat(np.arange(len(key)), k)
    row = at.ravel()
    on = key[anchor, row] != _NONE
    return anchor[on], row[on]


def _cell(anchors: pa.Table, rows: pa.Table):
    """Blocks of a cell: (first anchor, ids and labels, candidates by id, scores ``[anchor, row]``)."""
    if not anchors.num_rows or not rows.num_rows:
        return
    rows = rows.sort_by("id")
    dims = max(int(t["v"].combine_chunks().value_lengths().to_numpy(zero_copy_only=False).max(initial=0))
               for t in (anchors, rows))
    a, c = (_matrix(t["v"], max(dims, 1)) for t in (anchors, rows))
    ids, labels = (rows[x].to_numpy() for x in ("id", "label"))
    planes = bit_planes(c)
    for s in range(0, len(a), _STEP_ANCHORS):
        got = scores(a[s:s + _STEP_ANCHORS], planes).T.copy()
        # unique keys: the higher score first, then the earlier row, and rows are ordered by id
        key = got * len(ids) + (len(ids) - 1 - np.arange(len(ids)))
        yield anchors.slice(s, len(got)), ids, labels, got, key


def _paired(left: DataFrame, right: DataFrame, n_left: int, n_right: int):
    """Both sides with the cell number: every pair of blocks meets in exactly one cell."""
    a = left.withColumn("cell", F.explode(F.sequence(F.lit(0), F.lit(n_right - 1)))).withColumn(
        "cell", F.pmod(F.xxhash64("id", "label", "v"), F.lit(n_left)) * n_right + F.col("cell"))
    # rows are dealt by their place, so that one id that many rows share is spread as well
    b = right.withColumn("_b", F.pmod(F.monotonically_increasing_id(), F.lit(n_right))).withColumn(
        "cell", F.explode(F.sequence(F.lit(0), F.lit(n_left - 1)))).withColumn(
        "cell", F.col("cell") * n_right + F.col("_b")).drop("_b")
    parts = min(4 * n_left * n_right, 20_000)
    return a.repartition(parts, "cell").groupBy("cell"), b.repartition(parts, "cell").groupBy("cell")


def usable(vectors: DataFrame, scale: int = SCALE, id_col: str = "vec_id", label_col: str = "label",
           vector_col: str = "embedding") -> DataFrame:
    """``id, label, v`` of the rows that take part, components as integers."""
    sound = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    most = (1 << MOST_BITS) - 1

    def whole(x: Column) -> Column:
        y = F.floor(x.cast("double") * F.lit(float(scale)))
        return F.when(F.abs(x.cast("double") * F.lit(float(scale))) < most, y.cast("int")).otherwise(
            F.raise_error(F.lit(f"a component needs more than {MOST_BITS} bits")).cast("int"))

    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
                          F.col(vector_col).alias("v")).filter(
        F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & F.forall("v", sound))
    return rows.withColumn("v", F.transform("v", whole))


def mine(vectors: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
         least: int = LEAST, scale: int = SCALE, id_col: str = "vec_id", label_col: str = "label",
         vector_col: str = "embedding") -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.  ``is_anchor`` is a
    condition over the column ``id``.  Runs jobs when it is called."""
    rows = usable(vectors, scale, id_col, label_col, vector_col)
    count = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(is_anchor).alias("a")).first()
    n_rows, n_anchors = (max(1, -(-count[k] // size)) for k, size in (("n", ROWS), ("a", ANCHORS)))
    anchors = rows.filter(is_anchor).distinct()

    def nearest(a: pa.Table, c: pa.Table) -> pa.Table:
        parts = []
        for block, ids, labels, got, key in _cell(a, c):
            own, label = block["id"].to_numpy(), block["label"].to_numpy()
            i, j = _best(key, (labels == label[:, None]) & (ids != own[:, None]), positives)
            parts.append(block.take(i).select(["id", "label", "v"]).append_column("score", pa.array(got[i, j]))
                         .append_column("other", pa.array(ids[j])))
        return pa.concat_tables(parts) if parts else _empty("id label score other", v=True)

    near = "id bigint, label bigint, v array<int>, score bigint, other bigint"
    a, c = _paired(anchors, rows, n_anchors, n_rows)
    best = Window.partitionBy("id", "label", "v").orderBy(F.desc("score"), "other")
    found = (a.cogroup(c).applyInArrow(lambda x, y: nearest(x, y).select(["id", "label", "v", "score", "other"]), near)
             .withColumn("place", F.row_number().over(best)).filter(F.col("place") <= positives)
             .groupBy("id", "label", "v").agg(F.sort_array(F.collect_list(F.struct("place", "score", "other"))).alias("pos"))
             .select("id", "label", "v", F.col("pos.score").alias("scores"), F.col("pos.other").alias("others")))
    found = materialise(found, "hard_negatives")

    def below(a: pa.Table, c: pa.Table) -> pa.Table:
        parts = []
        for block, ids, labels, got, key in _cell(a, c):
            label, own = block["label"].to_numpy(), block["id"].to_numpy()
            lists, others = block["scores"].to_pylist(), block["others"].to_pylist()
            differ = labels != label[:, None]
            for k in range(positives):
                on = np.array([i for i, s in enumerate(lists) if len(s) > k], int)
                if not len(on):
                    break
                limit = np.array([lists[i][k] for i in on], np.int64)
                other = np.array([others[i][k] for i in on], np.int64)
                s = got[on]
                ok = differ[on] & (s <= limit[:, None]) & (100 * s >= least * limit[:, None]) & (ids != own[on][:, None])
                i, j = _best(key[on], ok, negatives)
                parts.append(pa.table({"id": own[on][i], "label": label[on][i], "other": other[i],
                                       "place": np.full(len(i), k + 1), "limit": limit[i],
                                       "negative": ids[j], "score": s[i, j]}))
        return pa.concat_tables(parts) if parts else _empty("id label other place limit negative score")

    a, c = _paired(found, rows, n_anchors, n_rows)
    pairs = a.cogroup(c).applyInArrow(
        lambda x, y: below(x, y), "id bigint, label bigint, other bigint, place bigint, limit bigint, negative bigint, score bigint")
    rank = Window.partitionBy("id", "label", "place").orderBy(F.desc("score"), "negative")
    return pairs.withColumn("rank", F.row_number().over(rank)).filter(F.col("rank") <= negatives).select(
        F.col("id").alias("anchor_id"), F.col("other").alias("positive_id"), "rank",
        F.col("negative").alias("negative_id"), F.col("limit").alias("positive_score"),
        F.col("score").alias("negative_score"))


def _empty(names: str, v: bool = False) -> pa.Table:
    cols = {n: pa.array([], pa.int64()) for n in names.split()}
    return pa.table(cols | ({"v": pa.array([], pa.list_(pa.int32()))} if v else {}))


ORACLE_SQL = """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, a.label AS anchor_label, b.vec_id AS other_id, b.label AS other_label,
         CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM e a JOIN e b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE anchor_label = other_label
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id) AS INTEGER) AS rank,
       s.other_id AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND s.anchor_label <> s.other_label
  AND 80 * p.positive_score <= 100 * s.score AND s.score <= p.positive_score
QUALIFY rank <= 5
"""
