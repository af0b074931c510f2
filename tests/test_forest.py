"""The grid forest: nesting of the grid, best splits, the two ways of growing, cross-validation."""

import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderlens.operators import forest as R
from orderlens.session import scratch_dir

GRID = {"trees": [3, 7], "depths": [2, 4, None], "splits": [2, 5], "leaves": [1, 3]}


def data(n, features=5, seed=0, levels=256):
    rng = np.random.default_rng(seed)
    bins = (rng.integers(0, levels, (n, features)) * (256 // levels)).astype(np.uint8)
    y = np.round((bins[:, 0] / 20 + (bins[:, 1] > 100) * 10 + rng.normal(0, 2, n)) * 65536) / 65536
    return bins, y, rng.integers(-2 ** 62, 2 ** 62, n)


@pytest.mark.parametrize("leaf", [1, 3])
def test_a_cut_tree_is_the_tree_fitted_with_that_limit(leaf):
    bins, y, h = data(1500)
    w = R.weights(h, 4)
    cuts = [(d, s) for d in (1, 3, 10, R.NO_LIMIT) for s in (2, 5, 10)]
    whole = R.predictions(R.grow(bins, y, w, leaf), bins, cuts)
    for k, (depth, split) in enumerate(cuts):
        fitted = R.grow(bins, y, w, leaf, depth, split)
        assert (R.predictions(fitted, bins, [(R.NO_LIMIT, 2)])[0] == whole[k]).all()


def test_splits_are_the_best_ones():
    rng = np.random.default_rng(1)
    for _ in range(20):
        b = (rng.integers(0, 6, (40, 3)) * 40).astype(np.uint8)
        y, w = rng.integers(0, 9, 40).astype(float), rng.integers(0, 4, 40).astype(np.uint8)
        t = R.grow(b, y, w, 2)
        on = w > 0
        best = max([(w * y)[on & l].sum() ** 2 / w[on & l].sum() + (w * y)[on & ~l].sum() ** 2 / w[on & ~l].sum()
                    for f in range(3) for c in range(255) for l in [b[:, f] <= c]
                    if (on & l).sum() >= 2 and (on & ~l).sum() >= 2])
        assert abs(t.gain[0] - (best - (w * y).sum() ** 2 / w.sum())) < 1e-6
        assert t.count[0] == on.sum() and abs(t.value[0] - (w * y).sum() / w.sum()) < 1e-12


def test_weights_are_poisson_draws():
    w = np.concatenate([R.weights(np.arange(20_000), t) for t in range(5)])
    assert abs(w.mean() - 1) < 0.02 and abs(w.var() - 1) < 0.03 and abs((w == 0).mean() - np.exp(-1)) < 0.01


def test_equal_rows_and_labels_do_not_split():
    same = np.zeros((50, 2), np.uint8)
    assert len(R.grow(same, np.arange(50.0), np.ones(50, np.uint8), 1).left) == 1
    bins, y, _ = data(50)
    assert len(R.grow(bins, y * 0 + 3, np.ones(50, np.uint8), 1).left) == 1
    assert len(R.grow(bins[:0], y[:0], np.ones(0, np.uint8), 1).left) == 1


@pytest.fixture(scope="module")
def rows(spark):
    bins, y, _ = data(700, 4, 2, levels=16)
    values = [(f"o{i}", float(v), *map(float, b)) for i, (b, v) in enumerate(zip(bins, y))]
    values += values[:20]                                # rows that occur twice
    return spark.createDataFrame(values, "order_id string, label double, a double, b double, c double, d double").cache()


INPUTS = ["a", "b", "c", "d"]


def searched(spark, rows, **options):
    path = scratch_dir(spark, f"test_forest/{uuid.uuid4().hex}")
    cuts = R.fit(rows, "order_id", "label", INPUTS, GRID, 3, 11, path, **options)
    return path, cuts, {tuple(r)[:4]: (r.cv_mae_mean, r.cv_mae_std) for r in R.scores(spark, path, GRID, 3).collect()}


@pytest.fixture(scope="module")
def whole(spark, rows):
    return searched(spark, rows)


def test_grid_scores_against_plain_cross_validation(spark, rows, whole):
    _, cuts, got = whole
    assert len(got) == 2 * 3 * 2 * 2
    blocks = R._blocks(rows, "order_id", "label", INPUTS, cuts, 3, 11).collect()
    own = R.Rows(*(np.concatenate([np.frombuffer(b[c], k) for b in blocks]) for c, k in (
        ("h", np.int64), ("fold", np.int8), ("y", np.float64), ("bins", np.uint8))))
    own = own._replace(bins=own.bins.reshape(-1, 4))
    for trees, depth, split, leaf in [(3, 2, 2, 1), (7, None, 2, 1), (7, 4, 5, 3), (3, None, 5, 3)]:
        maes = []
        for fold in range(3):
            train, held = own.take(own.fold != fold), own.take(own.fold == fold)
            p = np.mean([R.predictions(R.grow(train.bins, train.y, R.weights(train.h, t), leaf, depth or R.NO_LIMIT, split),
                                       held.bins, [(R.NO_LIMIT, 2)])[0] for t in range(trees)], axis=0)
            maes.append(np.abs(p - held.y).mean())
        assert np.allclose(got[trees, depth, split, leaf], (np.mean(maes), np.std(maes)))


@pytest.mark.parametrize("local_rows", [60, 250])
def test_growing_large_nodes_from_histograms_gives_the_same_trees(spark, rows, whole, local_rows, monkeypatch):
    path, cuts, want = whole
    other, _, got = searched(spark, rows, local_rows=local_rows)
    assert got.keys() == want.keys()
    assert all(np.allclose(got[k], want[k]) for k in want)
    predicted = []
    for folder in (path, other):
        R.keep_forest(spark, folder, f"{folder}/forest", 1, 7, 3)
        forest = R.Forest(f"{folder}/forest", INPUTS, cuts, 7, 4, 5)
        predicted.append({r.order_id: r.prediction for r in forest.predict(rows).collect()})
        assert abs(sum(forest.importance(spark)) - 1) < 1e-9
    assert predicted[0].keys() == predicted[1].keys()
    assert all(abs(predicted[0][k] - predicted[1][k]) < 1e-9 for k in predicted[0])
    assert np.allclose(R.Forest(f"{path}/forest", INPUTS, cuts, 7, 4, 5).importance(spark),
                       R.Forest(f"{other}/forest", INPUTS, cuts, 7, 4, 5).importance(spark))


def test_scoring_reads_a_forest_in_parts(spark, rows, whole):
    path, cuts, _ = whole
    R.keep_forest(spark, path, f"{path}/parts", 3, 7, 3)
    forest = R.Forest(f"{path}/parts", INPUTS, cuts, 7, None, 2)
    want = forest.predict(rows).agg(F.sum("prediction")).first()[0]
    values = np.array([list(r)[2:] for r in rows.collect()])
    bins = R.binned(values, cuts)
    before = R.PART_NODES
    try:
        R.PART_NODES = 1
        parts = list(forest._parts())
    finally:
        R.PART_NODES = before
    assert len(parts) == 7
    total = sum(R._value(top, cells, bins, [(R.NO_LIMIT, 2)]) for part in parts for top, cells in part) / 7
    assert abs(total.sum() - want) < 1e-6


def test_splits_of_a_few_inputs_at_once_are_those_of_all(monkeypatch):
    bins, y, h = data(2000, features=6, levels=8)
    w = R.weights(h, 1)
    want = R.grow(bins, y, w, 2)
    for pairs in (1, 4000):
        monkeypatch.setattr(R, "AT_ONCE", pairs)
        assert all((a == b).all() for a, b in zip(R.grow(bins, y, w, 2), want))


@pytest.mark.parametrize("local_rows", [10_000, 250])
def test_a_search_leaves_no_trees_behind(spark, rows, local_rows):
    """What a search keeps grows with the rows and the grid's limits, not with rows times trees."""
    path, _, _ = searched(spark, rows, local_rows=local_rows)
    kept = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True).load(path)
    columns = [c for folder in {r.path.rpartition("/")[0] for r in kept.select("path").collect()} for c in spark.read.parquet(folder).columns]
    assert "feature" not in columns and "sums" not in columns
    own = [r for r in kept.select("path", "length").collect() if "/rows/" in r.path or "/state_" in r.path]
    assert sum(r.length for r in own) < 300 * rows.count() + 8_000 * len(own)
    R.keep_forest(spark, path, f"{path}/short", 1, 3, 3, 2, 5)              # a kept forest is no larger than its limits
    short = spark.read.parquet(f"{path}/short").filter("cell >= 0")
    assert sorted(r.tree for r in short.select("tree").distinct().collect()) == [0, 1, 2]
    assert local_rows < 700 or short.agg(F.max("nodes")).first()[0] <= 7


@pytest.mark.parametrize("limits", [(1, R.NO_LIMIT, 2), (3, 4, 9), (400, R.NO_LIMIT, 2)])
def test_a_packed_tree_reads_back_as_it_was_grown(limits):
    bins, y, h = data(600, levels=16)
    for t in range(3):
        tree = R.grow(bins, np.round(y / R.LABEL_STEP) * R.LABEL_STEP, R.weights(h, t), *limits)
        row = R._trees_table([(t, 0, tree)]).to_pylist()[0]
        assert row["nodes"] == len(tree.feature)
        for name, a, b, kind in zip(R.Tree._fields, tree, R._tree_of(row), R._KINDS):
            assert b.dtype == kind and (a == b).all(), name


def test_a_kept_forest_of_unlimited_depth_is_small(spark):
    """Disk of the forest: a few bytes per node, though gains and means of inner nodes are kept as doubles in a task."""
    rows = spark.range(6000).selectExpr("cast(id as string) order_id", "cast(pmod(xxhash64(id), 50) as double) label",
                                        *[f"cast(pmod(xxhash64(id, {k}), 1000) as double) {c}" for k, c in enumerate(INPUTS)])
    path = scratch_dir(spark, f"test_forest/{uuid.uuid4().hex}")
    cuts = R.fit(rows, "order_id", "label", INPUTS, {"trees": [1], "depths": [2], "splits": [2], "leaves": [1]}, 2, 11, path)
    R.keep_forest(spark, path, f"{path}/deep", 1, 10, 2)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(f"{path}/deep")
    length = files.agg(F.sum("length")).first()[0]
    nodes = spark.read.parquet(f"{path}/deep").agg(F.sum("nodes")).first()[0]
    assert nodes > 10 * 4000 and length < 6 * nodes
    assert abs(sum(R.Forest(f"{path}/deep", INPUTS, cuts, 10, None, 2).importance(spark)) - 1) < 1e-9


def test_leaf_sizes_searched_in_jobs_of_their_own_score_the_same(spark, rows, whole, monkeypatch):
    """A job of the search sends no more than SEARCH_BYTES of sums, or those of one leaf size."""
    one = 100_000 * 8 * (3 * 2 + 1) * len(GRID["trees"])
    for most, sizes in ((10 * one, [GRID["leaves"]]), (one, [[x] for x in GRID["leaves"]]), (1, [[x] for x in GRID["leaves"]])):
        monkeypatch.setattr(R, "SEARCH_BYTES", most)
        assert R._leaf_jobs(GRID, 100_000) == sizes
    _, _, got = searched(spark, rows)
    assert got == whole[2]
