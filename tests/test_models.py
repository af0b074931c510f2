"""Models: determinism, persistence, invariants (metrics are not compared bit for bit)."""

import uuid

from pyspark.sql import functions as F

from conftest import SF_MID, SF_SMALL
from orderlens.plans import features as FE
from orderlens.plans import models as M
from orderlens.session import scratch_dir
from orderlens.sources.fixture import transactions


def test_segmentation_deterministic_and_complete(spark):
    tx = transactions(spark, SF_SMALL)
    a = M.customer_segments(tx, k=3, n_init=2).select("customer_id", "segment")
    b = M.customer_segments(tx, k=3, n_init=2).select("customer_id", "segment")
    assert sorted(a.collect()) == sorted(b.collect())
    sizes = M.profiles(M.customer_segments(tx, k=3, n_init=2)).agg(F.sum("size")).first()[0]
    assert sizes == FE.segmentation_features(tx).count()


def test_model_round_trip(spark):
    tx = transactions(spark, SF_SMALL)
    r = M.model_round_trip(tx, scratch_dir(spark, "test_round_trip"), k=3, n_init=1).first()
    assert r["rows"] == r["equal_rows"] > 0


def test_choose_k_flags_one(spark):
    tx = transactions(spark, SF_SMALL)
    ks = M.choose_k(tx, max_k=4, n_init=2).collect()
    assert [r["k"] for r in ks] == [2, 3, 4] and sum(r["chosen"] for r in ks) == 1


SMALL_GRID = {"trees": [10], "depths": [4, 6], "splits": [2], "leaves": [1]}


def test_full_search_is_the_default():
    import inspect
    p = inspect.signature(M.train_delivery_model).parameters
    assert p["grid"].default is None and p["folds"].default == 5
    assert [len(v) for v in M.REFERENCE_GRID.values()] == [2, 3, 3, 3]
    p = inspect.signature(M.choose_k).parameters
    assert (p["max_k"].default, p["n_init"].default, M.MAX_ITER) == (10, 10, 300)
    assert inspect.signature(M.customer_segments).parameters["k"].default is None


def test_delivery_model_trains_saves_and_scores(spark):
    tx = transactions(spark, SF_SMALL)
    path = scratch_dir(spark, f"test_delivery_model_{uuid.uuid4().hex}")
    model = M.train_delivery_model(tx, grid=SMALL_GRID, folds=2, path=path)
    m = M.model_metrics(spark, model).first()
    assert 0 <= m["test_mae"] <= 50 and m["cv_mae_mean"] > 0 and (m["grid_points"], m["folds"]) == (2, 2)
    assert not m["full_grid"]
    grid = M.delivery_grid(spark, path).collect()
    assert sorted(r.depth for r in grid) == [4, 6] and [r.cv_mae_mean for r in grid if r.chosen] == [min(r.cv_mae_mean for r in grid)]
    scored = M.score_delivery(model, tx)
    assert scored.filter(F.col("predicted_delivery_time") < 10).count() == 0
    assert scored.filter(F.col("lower_bound") < 10).count() == 0
    assert scored.filter(F.abs(F.col("predicted_delivery_time") - F.col("predicted_delivery_time_1dp")) > 0.05001).count() == 0
    again = M.score_delivery(M.load_model(spark, path), tx)
    assert M.compare_scores(scored, again, "order_id", "predicted_delivery_time").first()["equal_rows"] == tx.count()
    assert M.trained_at(spark, path, None).facts == model.facts          # found, not trained again


def test_unseen_category_and_optional_columns(spark):
    tx = transactions(spark, SF_SMALL)
    path = scratch_dir(spark, f"test_delivery_model_{uuid.uuid4().hex}")
    model = M.train_delivery_model(tx, grid=SMALL_GRID, folds=2, path=path)
    other = tx.limit(50).withColumn("city", F.lit("Atlantis")).withColumn("distance_km", F.lit(7.5)).withColumn(
        "weather_condition", F.lit("storm"))
    rows = M._delivery_rows(other, model.stats, model.encoders).select(
        "city_encoded", "weather_condition_encoded", "estimated_distance_km").distinct().collect()
    assert [tuple(r) for r in rows] == [(-1.0, -1.0, 7.5)]
    known = M._delivery_rows(tx, model.stats, model.encoders)
    assert known.filter("city_encoded < 0 or estimated_distance_km <> 3.0").count() == 0
    assert M.score_delivery(model, other).count() == 50


def test_churn_model_metrics_in_range(spark):
    tx = transactions(spark, SF_MID)
    model = M.train_churn_model(tx, max_iter=10)
    m = M.model_metrics(spark, model).first()
    for k in ("train_accuracy", "test_accuracy", "precision", "recall", "f1_score", "roc_auc"):
        assert 0.0 <= m[k] <= 1.0
    probs = M.score_churn(model, tx)
    assert probs.filter((F.col("churn_probability") < 0) | (F.col("churn_probability") > 1)).count() == 0


def test_stratified_split_exact_per_class(spark):
    tx = transactions(spark, SF_MID)
    from orderlens.operators.split import stratified_split
    f = FE.churn_features(tx).select("customer_id", "churned")
    s = stratified_split(f, "customer_id", "churned", 0.2, 42)
    for r in s.groupBy("churned").agg(F.count("*").alias("n"), F.count_if("is_test").alias("t")).collect():
        assert r["t"] == -(-r["n"] * 2 // 10)          # ceil(0.2 n)


def test_kmeans_restarts_keep_lowest_cost(spark):
    tx = transactions(spark, SF_SMALL)
    one = M.fit_segmentation(tx, k=3, n_init=1).stages[-1].summary.trainingCost
    best = M.fit_segmentation(tx, k=3, n_init=3).stages[-1].summary.trainingCost
    assert best <= one + 1e-9


def test_required_field_report_counts_absent_columns(spark):
    tx = transactions(spark, SF_SMALL)
    r = M.required_field_report(tx).first()
    assert r["missing_weather_condition"] == r["rows"] and r["missing_order_value"] == 0


def test_same_seed_same_churn_metrics(spark):
    tx = transactions(spark, SF_MID)
    a = M.train_churn_model(tx, max_iter=5).facts["metrics"]
    b = M.train_churn_model(tx, max_iter=5).facts["metrics"]
    assert a == b


def test_registered_delivery_model_searches_the_whole_grid(spark, monkeypatch):
    """The keys leave grid and folds at their defaults."""
    import __spark_entry__ as E
    passed = []
    monkeypatch.setattr(M, "train_delivery_model", lambda tx, **options: passed.append(options))
    monkeypatch.setattr(M, "trained_at", lambda spark, path, train: train(path))
    E._trained("delivery", spark, SF_SMALL, transactions(spark, SF_SMALL))
    assert [set(options) for options in passed] == [{"path"}]


def test_registered_segment_summary_fits_the_city(spark, monkeypatch):
    """Scaling, search and starts see the filtered orders only (a short search here)."""
    import __spark_entry__ as E
    from orderlens.plans import api as A
    train, cities = M.train_segmentation, []

    def short(tx, path):
        cities.extend(r.city for r in tx.select("city").distinct().collect())
        train(tx, path, max_k=3, n_init=1)

    folder = scratch_dir(spark, f"test_segment_summary_{uuid.uuid4().hex}")
    monkeypatch.setattr(E, "_model_path", lambda spark, sf_dir, kind: f"{folder}/{kind}")
    monkeypatch.setattr(M, "train_segmentation", short)
    got = E.queries()["segment_summary"](spark, SF_SMALL).collect()
    assert cities == ["ASIA"]
    want = E._final(A.segment_summary(transactions(spark, SF_SMALL), city="ASIA", max_k=3, n_init=1)).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))


def test_search_of_seeds_in_joint_passes_finds_mllibs_best_fits(spark):
    from orderlens.operators import lloyd as L
    rows = M._segment_input(transactions(spark, SF_SMALL))
    scaled = M._scaling().fit(rows).transform(rows).select("customer_id", "features").cache()
    jobs = [(k, 42 + i) for k in (2, 4) for i in range(3)]
    plain = [M._kmeans(*j).fit(scaled) for j in jobs]
    starts = [M._kmeans(*j).setMaxIter(0).fit(scaled).clusterCenters() for j in jobs]
    costs = L.lloyd(scaled, "features", starts, M.MAX_ITER, 1e-4)
    assert all(abs(c - m.summary.trainingCost) < 1e-6 * c for c, m in zip(costs, plain))
    best = M._best_fits(scaled, [2, 4], 42, 3, 2)
    for k in (2, 4):
        assert abs(best[k].summary.trainingCost - min(m.summary.trainingCost for (j, _), m in zip(jobs, plain) if j == k)) < 1e-9
