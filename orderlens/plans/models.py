"""Models: customer segmentation (MLlib's KMeans), delivery time (random forest, ``operators.forest``),
churn (MLlib's gradient-boosted trees).  Training, evaluation and scoring are Spark jobs
over DataFrames; only metrics, parameters and label lists reach the driver.

Trained models are folders (``save_model`` / ``load_model``): encoders, fitted
pipeline, statistics as Parquet, and one JSON row with inputs, importances and
version.  Scoring reads only that folder.  Training functions, ``choose_k`` and
``customer_segments`` run Spark jobs when they are called.
"""

from __future__ import annotations

import json
import math
import uuid
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import (BinaryClassificationEvaluator, ClusteringEvaluator,
                                   RegressionEvaluator)
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.rounding import mean_as_double, round_half_up
from ..operators import boosting, forest
from ..operators.forest import Forest, write_forest
from ..operators.lloyd import Fit, fits
from ..operators.split import hash_split, stratified_split
from ..session import free, scratch_dir
from ..sources.files import path_exists
from . import features as FE

MODEL_VERSION = "1.0"


def _doubles(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in cols})


def _stable(df: DataFrame, key: str) -> DataFrame:
    """Fix row placement before fitting: MLlib results depend on partitioning."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, key).sortWithinPartitions(key)


def _one_row(spark: SparkSession, row: dict) -> DataFrame:
    """Metrics (already computed by Spark jobs) as a one-row DataFrame."""
    return spark.createDataFrame([row])


# ================================================================ segmentation (M1-M3)
CHARACTERISTICS = [
    # fixed values: (min avg spent, min avg frequency, min avg order value, label), first match wins
    (2000, 15, None, "High-Value Frequent Customers"),
    (1000, 10, None, "Medium-Value Regular Customers"),
    (None, 20, None, "High-Frequency Low-Spend Customers"),
    (None, None, 150, "High-Ticket Occasional Customers"),
]
DEFAULT_CHARACTERISTIC = "Low-Value Infrequent Customers"


def characteristics(spent: Column, freq: Column, aov: Column) -> Column:
    expr = None
    for s, f, v, label in CHARACTERISTICS:
        cond = F.lit(True)
        if s is not None:
            cond = cond & (spent > s)
        if f is not None:
            cond = cond & (freq > f)
        if v is not None:
            cond = cond & (aov > v)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(DEFAULT_CHARACTERISTIC)


# Restarts and iterations of KMeans, and the largest k tried.
N_INIT, MAX_ITER, MAX_K = 10, 300, 10
SAME_COST = 1e-12                          # sums of the same costs in another order differ by less


def _kmeans(k: int, seed: int) -> KMeans:
    return KMeans(k=k, seed=seed, maxIter=MAX_ITER, featuresCol="features", predictionCol="segment")


def _scaling() -> Pipeline:
    return Pipeline(stages=[
        VectorAssembler(inputCols=FE.SEGMENT_FEATURES, outputCol="raw"),
        StandardScaler(inputCol="raw", outputCol="features", withMean=True, withStd=True)])


def _segment_input(tx: DataFrame) -> DataFrame:
    return _stable(_doubles(FE.segmentation_features(tx), FE.SEGMENT_FEATURES), "customer_id")


def _best_fits(scaled: DataFrame, ks: list[int], seed: int, n_init: int, parallelism: int) -> dict:
    """k -> the KMeans model of lowest cost over ``n_init`` seeds: MLlib's runs, made side by side (``operators.lloyd``)."""
    jobs = [(k, seed + i) for k in ks for i in range(n_init)]
    runs = list(zip(jobs, fits(scaled, "features", jobs, MAX_ITER, _kmeans(*jobs[0]).getTol())))

    def best(k: int) -> KMeansModel:
        own = [(s, fit) for (j, s), fit in runs if j == k]
        least = min(fit.cost for _, fit in own)
        return _kmeans_model(scaled, k, *next(x for x in own if x[1].cost <= least * (1 + SAME_COST)))   # the first of equal costs wins

    return {k: best(k) for k in ks}


def _kmeans_model(scaled: DataFrame, k: int, seed: int, fit: Fit) -> KMeansModel:
    """The model that MLlib's fit of ``scaled`` leaves, of a run's centres, cost and iterations."""
    sc = scaled.sparkSession.sparkContext
    jvm, kind = sc._jvm, sc._jvm.org.apache.spark.mllib.linalg.Vector
    centres = sc._gateway.new_array(kind, len(fit.centres))
    for i, c in enumerate(fit.centres.tolist()):
        values = sc._gateway.new_array(jvm.double, len(c))
        for j, x in enumerate(c):
            values[j] = x
        centres[i] = jvm.org.apache.spark.mllib.linalg.Vectors.dense(values)
    estimator = _kmeans(k, seed)
    estimator._transfer_params_to_java()
    inner = jvm.org.apache.spark.mllib.clustering.KMeansModel(centres, estimator.getDistanceMeasure(), fit.cost, fit.iterations)
    java = jvm.org.apache.spark.ml.clustering.KMeansModel(estimator.uid, inner)
    estimator._java_obj.copyValues(java, jvm.org.apache.spark.ml.param.ParamMap.empty())
    model = estimator._create_model(java)
    scored = model.transform(scaled)
    java.setSummary(jvm.scala.Option.apply(jvm.org.apache.spark.ml.clustering.KMeansSummary(
        scored._jdf, "segment", "features", k, fit.iterations, fit.cost)))
    return estimator._copyValues(model)


def _search(tx: DataFrame, ks: list[int], seed: int, n_init: int, parallelism: int):
    """Scaler, model of the best k, and a row per k; the customers are evaluated once."""
    data = _segment_input(tx).persist(StorageLevel.MEMORY_AND_DISK)
    scaled = None
    try:
        scaling = _scaling().fit(data)
        scaled = scaling.transform(data).select("customer_id", "features").persist(StorageLevel.MEMORY_AND_DISK)
        models = _best_fits(scaled, ks, seed, n_init, parallelism)
        evaluator = ClusteringEvaluator(featuresCol="features", predictionCol="segment")
        with ThreadPool(max(1, parallelism)) as pool:
            rows = pool.map(lambda k: {
                "k": k, "silhouette": float(evaluator.evaluate(models[k].transform(scaled))) if len(ks) > 1 else None,
                "training_cost": float(models[k].summary.trainingCost)}, ks, chunksize=1)
    finally:
        data.unpersist()
        if scaled is not None:
            scaled.unpersist()
    best = max(rows, key=lambda r: (r["silhouette"] or 0.0, -r["k"]))["k"]
    return PipelineModel(stages=[*scaling.stages, models[best]]), rows, best


def _choices(spark: SparkSession, rows: list[dict], best: int) -> DataFrame:
    return spark.createDataFrame([{**r, "chosen": r["k"] == best} for r in rows],
                                 "k int, silhouette double, training_cost double, chosen boolean")


def choose_k(tx: DataFrame, max_k: int = MAX_K, seed: int = 42, n_init: int = N_INIT,
             parallelism: int = 4) -> DataFrame:
    """Silhouette for k = 2..max_k (MLlib's squared-Euclidean silhouette, linear cost).

    The scaled vectors are persisted for the loop (recomputable if an executor
    is lost); the first k with the best silhouette is flagged ``chosen``.
    """
    _, rows, best = _search(tx, list(range(2, max_k + 1)), seed, n_init, parallelism)
    return _choices(tx.sparkSession, rows, best)


def train_segmentation(tx: DataFrame, path: str, max_k: int = MAX_K, seed: int = 42, n_init: int = N_INIT,
                       parallelism: int = 4) -> None:
    """The whole search once: the chosen model to ``path/model``, the row per k to ``path/choose_k``."""
    model, rows, best = _search(tx, list(range(2, max_k + 1)), seed, n_init, parallelism)
    model.write().overwrite().save(f"{path}/model")
    _choices(tx.sparkSession, rows, best).coalesce(1).write.mode("overwrite").parquet(f"{path}/choose_k")


def fit_segmentation(tx: DataFrame, k: int | None = None, seed: int = 42, n_init: int = N_INIT,
                     max_k: int = MAX_K, parallelism: int = 4) -> PipelineModel:
    """Scaler and KMeans; without ``k`` the search over 2..max_k decides.  ``n_init`` restarts with
    seeds seed..seed+n_init-1 keep the lowest training cost."""
    ks = [k] if k else list(range(2, max_k + 1))
    return _search(tx, ks, seed, n_init, parallelism)[0]


def customer_segments(tx: DataFrame, k: int | None = None, max_k: int = MAX_K, seed: int = 42,
                      model: PipelineModel | None = None, n_init: int = N_INIT) -> DataFrame:
    """Customers with their segment; fits a model (searching for k unless given) when none is passed."""
    model = model or fit_segmentation(tx, k, seed, n_init, max_k)
    scored = model.transform(_segment_input(tx))
    return scored.select("customer_id", *FE.SEGMENT_FEATURES, F.col("segment").cast("int"))


def profiles(segmented: DataFrame, group: str = "segment") -> DataFrame:
    """Per group: size, mean features and the ordered characteristic rules."""
    p = segmented.groupBy(group).agg(
        F.count(F.lit(1)).alias("size"),
        mean_as_double("total_spent").alias("avg_total_spent"),
        mean_as_double("order_frequency").alias("avg_order_frequency"),
        mean_as_double("avg_order_value").alias("avg_order_value"),
        F.round(F.avg("orders_per_day"), 6).alias("avg_orders_per_day"),
        mean_as_double("avg_delivery_time").alias("avg_delivery_time"))
    return p.withColumn("characteristics", characteristics(
        F.col("avg_total_spent"), F.col("avg_order_frequency"), F.col("avg_order_value")))


def segment_profiles(tx: DataFrame, k: int | None = None, seed: int = 42,
                     model: PipelineModel | None = None, n_init: int = N_INIT) -> DataFrame:
    seg = customer_segments(tx, k=k, seed=seed, model=model, n_init=n_init)
    return (profiles(seg).withColumn("segment", F.concat(F.lit("Segment_"), F.col("segment")))
            .orderBy("segment"))


def segment_totals(model: PipelineModel, tx: DataFrame) -> DataFrame:
    """One row of invariants: customers and spend over the segments, the customers of the profiles,
    and whether the number of segments lies in 2..``MAX_K``."""
    seg = customer_segments(tx, model=model)
    sizes = profiles(seg).agg(F.sum("size").alias("profiled_customers"))
    return seg.agg(F.count(F.lit(1)).alias("customers"), F.sum(F.col("total_spent").cast("decimal(20,2)")).alias("total_spent"),
                   F.count_distinct("segment").between(2, MAX_K).alias("segments_in_range")).crossJoin(
        F.broadcast(sizes))                                    # one row each


def segment_rules(tx: DataFrame, as_of) -> DataFrame:
    """The characteristic rules on a fixed grouping: the CLV value band of each customer."""
    from .customers import clv
    bands = clv(tx, as_of, ordered=False).select("customer_id", "customer_segment")
    feats = FE.segmentation_features(tx)
    return profiles(feats.join(bands, "customer_id"), "customer_segment")


def characteristic_sizes(profiled: DataFrame) -> DataFrame:
    """Customers per characteristic: groups that the rules name alike are one."""
    return profiled.groupBy("characteristics").agg(F.sum("size").alias("customers"), F.count(F.lit(1)).alias("segments"))


def model_round_trip(tx: DataFrame, path: str, k: int | None = None, seed: int = 42,
                     n_init: int = N_INIT, model: PipelineModel | None = None) -> DataFrame:
    """Save the fitted pipeline, load it back and score with both (must agree)."""
    model = model or fit_segmentation(tx, k, seed, n_init)
    model.write().overwrite().save(path)
    return compare_scores(model.transform(_segment_input(tx)), PipelineModel.load(path).transform(_segment_input(tx)),
                          "customer_id", "segment")


def compare_scores(a: DataFrame, b: DataFrame, key: str, score: str) -> DataFrame:
    """One row: how many keys both scorings have, and for how many the score is equal."""
    both = a.select(key, F.col(score).alias("_a")).join(b.select(key, F.col(score).alias("_b")), key)
    return both.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("_a").eqNullSafe(F.col("_b"))).alias("equal_rows"))


# ================================================================ delivery time (M4-M7)
DELIVERY_CATEGORICAL = ["city", "cuisine_type", "order_complexity", "weather_condition"]
DELIVERY_INPUTS = [*FE.DELIVERY_FEATURES, *FE.OPTIONAL_DELIVERY_FEATURES]
DELIVERY_NUMERIC = [c for c in DELIVERY_INPUTS if not c.endswith("_encoded")]

# The grid that is searched (None: no limit of depth) and the number of folds.
REFERENCE_GRID = {"trees": [100, 200], "depths": [10, 20, None], "splits": [2, 5, 10], "leaves": [1, 2, 4]}
FOLDS = 5


@dataclass
class TrainedModel:
    """What scoring needs: encoders, fitted pipeline or forest, statistics frames, and a record of facts."""
    encoders: PipelineModel
    pipeline: PipelineModel | Forest
    stats: tuple[DataFrame, ...]
    facts: dict


def save_model(spark: SparkSession, model: TrainedModel, path: str) -> None:
    model.encoders.write().overwrite().save(f"{path}/encoders")
    facts = dict(model.facts)
    if isinstance(model.pipeline, Forest):
        if model.pipeline.folder != f"{path}/forest":
            write_forest(spark.read.parquet(model.pipeline.folder), f"{path}/forest")
        facts["forest"] = model.pipeline._asdict() | {"folder": None}
    else:
        model.pipeline.write().overwrite().save(f"{path}/pipeline")
    for i, frame in enumerate(model.stats):
        frame.write.mode("overwrite").parquet(f"{path}/stats_{i}")
    facts["stats"] = len(model.stats)
    spark.range(0, 1, 1, 1).select(F.lit(json.dumps(facts, sort_keys=True)).alias("facts")).write.mode("overwrite").text(f"{path}/facts")


def load_model(spark: SparkSession, path: str) -> TrainedModel:
    facts = json.loads(spark.read.text(f"{path}/facts").first()[0])
    stats = tuple(spark.read.parquet(f"{path}/stats_{i}") for i in range(facts["stats"]))
    if "forest" in facts:
        predictor = Forest(**facts["forest"] | {"folder": f"{path}/forest"})
    else:
        predictor = PipelineModel.load(f"{path}/pipeline")
    return TrainedModel(PipelineModel.load(f"{path}/encoders"), predictor, stats, facts)


def model_metrics(spark: SparkSession, model: TrainedModel) -> DataFrame:
    """The metrics of the training run, one row; lists and maps as JSON."""
    return _one_row(spark, {k: json.dumps(v, sort_keys=True) if isinstance(v, (dict, list)) else v
                            for k, v in model.facts["metrics"].items()})


def _delivery_rows(tx: DataFrame, stats, encoders: PipelineModel) -> DataFrame:
    """Encoded, null-filled inputs; a category the training data did not hold becomes -1."""
    f = FE.apply_label_encoders(encoders, FE.delivery_features(tx, stats, optional=True), DELIVERY_CATEGORICAL)
    return _doubles(f, DELIVERY_INPUTS)


def train_delivery_model(tx: DataFrame, grid: dict | None = None, folds: int = FOLDS, seed: int = 42,
                         path: str | None = None, local_rows: int = forest.LOCAL_ROWS) -> TrainedModel:
    """Grid-searched random forest for delivery minutes, saved to ``path`` and loaded from there.

    Restaurant/city statistics and encoders are fitted on the training split only.  One growth of all folds, leaf
    sizes and trees (``operators.forest``) gives every point of the grid, and the forest of the best one is grown
    after it; every split looks at all features.  Trees compare an input with cuts of its own values, so inputs are
    not scaled.  ``path/grid`` holds a row per grid point.
    """
    spark = tx.sparkSession
    grid = grid or REFERENCE_GRID
    path = path or scratch_dir(spark, f"models/delivery/{uuid.uuid4().hex}")
    labelled = hash_split(tx.filter(F.col("delivery_time").isNotNull()), "order_id", 0.2, seed)
    train_tx = labelled.filter(~F.col("is_test")).drop("is_test")
    test_tx = labelled.filter(F.col("is_test")).drop("is_test")
    stats = []
    for i, frame in enumerate(FE.delivery_stats(train_tx)):
        frame.write.mode("overwrite").parquet(f"{path}/training_stats_{i}")
        stats.append(spark.read.parquet(f"{path}/training_stats_{i}"))
        free(spark)
    encoders = FE.fit_label_encoders(FE.delivery_features(train_tx, tuple(stats), optional=True), DELIVERY_CATEGORICAL)

    def rows(t: DataFrame) -> DataFrame:
        return _delivery_rows(t, tuple(stats), encoders).select(
            "order_id", F.col("delivery_time").cast("double").alias("label"), *DELIVERY_INPUTS)

    rows(train_tx).write.mode("overwrite").parquet(f"{path}/training_rows")
    free(spark)
    train, test = spark.read.parquet(f"{path}/training_rows"), rows(test_tx)
    cuts = forest.fit(train, "order_id", "label", DELIVERY_INPUTS, grid, folds, seed, f"{path}/search", local_rows)
    forest.scores(spark, f"{path}/search", grid, folds).coalesce(1).write.mode("overwrite").parquet(f"{path}/grid")
    points = spark.read.parquet(f"{path}/grid").orderBy("cv_mae_mean", "point")      # one row per grid point
    best = points.first()
    forest.keep_forest(spark, f"{path}/search", f"{path}/forest", best.min_leaf, best.trees, folds, best.depth, best.min_split)
    predictor = Forest(f"{path}/forest", DELIVERY_INPUTS, cuts, best.trees, best.depth, best.min_split)
    mae = RegressionEvaluator(labelCol="label", metricName="mae")
    rmse = RegressionEvaluator(labelCol="label", metricName="rmse")
    p_train, p_test = (predictor.predict(t).select("label", "prediction").persist(StorageLevel.MEMORY_AND_DISK)
                       for t in (train, test))
    metrics = {
        "train_mae": round(mae.evaluate(p_train), 2), "test_mae": round(mae.evaluate(p_test), 2),
        "train_rmse": round(rmse.evaluate(p_train), 2), "test_rmse": round(rmse.evaluate(p_test), 2),
        "cv_mae_mean": round(best.cv_mae_mean, 2), "cv_mae_std": round(best.cv_mae_std, 2),
        "best_params": {"n_estimators": best.trees, "max_depth": best.depth, "min_samples_split": best.min_split,
                        "min_samples_leaf": best.min_leaf},
        "feature_importance": dict(zip(DELIVERY_INPUTS, [round(x, 6) for x in predictor.importance(spark)])),
        "grid_points": math.prod(map(len, grid.values())), "folds": folds,
        "full_grid": grid == REFERENCE_GRID and folds == FOLDS, "model_version": MODEL_VERSION}
    p_train.unpersist()
    p_test.unpersist()
    free(spark)
    trained = TrainedModel(encoders, predictor, tuple(stats),
                           {"kind": "delivery", "inputs": DELIVERY_INPUTS, "version": MODEL_VERSION, "metrics": metrics})
    save_model(spark, trained, path)
    return load_model(spark, path)


def delivery_grid(spark: SparkSession, path: str) -> DataFrame:
    """The grid of a training run, a row per point: mean and deviation of the folds' mean absolute errors."""
    rows = spark.read.parquet(f"{path}/grid")
    first = F.row_number().over(Window.orderBy("cv_mae_mean", "point")) == 1       # one row per grid point
    return rows.withColumn("chosen", first).drop("point")


# The fields a delivery-time request must carry (the prediction endpoint's check).
REQUIRED_FIELDS = ["restaurant_id", "customer_location", "order_value", "cuisine_type", "peak_hour",
                   "weather_condition"]


def required_field_report(orders: DataFrame) -> DataFrame:
    """Per required field, the rows that lack it (absent columns count every row)."""
    present = set(orders.columns)
    n = F.count(F.lit(1))
    cols = [(n - F.count(F.col(c))) if c in present else n for c in REQUIRED_FIELDS]
    return orders.agg(n.alias("rows"), *[c.alias(f"missing_{f}") for c, f in zip(cols, REQUIRED_FIELDS)])


def score_delivery(model: TrainedModel, orders: DataFrame, floor_minutes: float = 10.0,
                   confidence: float = 0.95) -> DataFrame:
    """Batch scoring: prediction floored at 10 minutes, the fixed-width interval around it, the rounded
    one-decimal figures of a response, and the model version."""
    rows = _delivery_rows(orders, model.stats, model.encoders).select("order_id", *DELIVERY_INPUTS)
    scored = model.pipeline.predict(rows)
    pred = F.greatest(F.col("prediction"), F.lit(floor_minutes))
    out = prediction_interval(scored.select("order_id", pred.alias("predicted_delivery_time")),
                              "predicted_delivery_time", confidence, floor_minutes)
    shown = {f"{c}_1dp": F.bround(F.col(c).cast("decimal(20,10)"), 1).cast("double")
             for c in ("predicted_delivery_time", "lower_bound", "upper_bound")}
    return out.withColumns(shown).withColumn("model_version", F.lit(model.facts["version"]))


def interval_margin(confidence: float = 0.95, std_error: float = 5.0) -> float:
    z = 1.96 if confidence == 0.95 else 2.58
    return z * std_error


def prediction_interval(df: DataFrame, prediction: str, confidence: float = 0.95,
                        floor_minutes: float = 10.0) -> DataFrame:
    """``[max(p - z*5, 10), p + z*5]`` with z = 1.96 at 95 % else 2.58."""
    m = F.lit(interval_margin(confidence))
    p = F.col(prediction)
    return df.withColumns({"lower_bound": F.greatest(p - m, F.lit(floor_minutes)), "upper_bound": p + m})


def rule_prediction(tx: DataFrame) -> DataFrame:
    """A transparent baseline: the restaurant's mean delivery time, else the city's."""
    f = FE.delivery_features(tx)
    pred = F.coalesce(F.col("restaurant_delivery_time_mean"), F.col("city_delivery_time_mean"))
    return f.select("order_id", "delivery_time", pred.alias("prediction"))


def regression_metrics(pred: DataFrame, label: str = "delivery_time", prediction: str = "prediction") -> DataFrame:
    """MAE and RMSE over a prediction table, exact sums (DECIMAL), 4 decimals."""
    rows = pred.filter(F.col(label).isNotNull() & F.col(prediction).isNotNull())
    err = F.col(label).cast("decimal(20,2)") - F.col(prediction).cast("decimal(20,2)")
    g = rows.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.abs(err)).alias("_abs"),
                 F.sum(err * err).alias("_sq"))
    return g.select("rows", round_half_up(F.try_divide(F.col("_abs"), F.col("rows")), 4).alias("mae"),
                    F.round(F.sqrt(F.try_divide(F.col("_sq").cast("double"), F.col("rows"))), 4).alias("rmse"))


# ================================================================ churn (M8-M10)
CHURN_CATEGORICAL = ["city", "cuisine_type"]
CHURN_NUMERIC = [c for c in FE.CHURN_FEATURES if not c.endswith("_encoded")]


def _churn_rows(tx: DataFrame) -> DataFrame:
    f = FE.churn_features(tx)
    return _doubles(f, CHURN_NUMERIC).withColumn("label", F.col("churned").cast("double"))


def _churn_inputs(rows: DataFrame, encoders: PipelineModel) -> DataFrame:
    return _doubles(FE.apply_label_encoders(encoders, rows, CHURN_CATEGORICAL), FE.CHURN_FEATURES)


def train_churn_model(tx: DataFrame, max_iter: int = 100, seed: int = 42, path: str | None = None) -> TrainedModel:
    """Gradient-boosted churn classifier (``operators.boosting``) on a stratified 80/20 split, saved to ``path`` and
    loaded from there."""
    spark = tx.sparkSession
    path = path or scratch_dir(spark, f"models/churn/{uuid.uuid4().hex}")
    split = stratified_split(_churn_rows(tx), "customer_id", "churned", 0.2, seed).persist(StorageLevel.MEMORY_AND_DISK)
    encoders = FE.fit_label_encoders(split.filter(~F.col("is_test")), CHURN_CATEGORICAL)
    rows = _churn_inputs(split, encoders)
    train = _stable(rows.filter(~F.col("is_test")), "customer_id").persist(StorageLevel.MEMORY_AND_DISK)
    test = rows.filter(F.col("is_test"))
    scaling = Pipeline(stages=[
        VectorAssembler(inputCols=FE.CHURN_FEATURES, outputCol="raw"),
        StandardScaler(inputCol="raw", outputCol="features", withMean=True, withStd=True)])
    boosted = GBTClassifier(featuresCol="features", labelCol="label", maxIter=max_iter, maxDepth=3, stepSize=0.1, seed=seed)
    try:
        scaled = scaling.fit(train)
        model = PipelineModel(stages=[*scaled.stages, boosting.fit(scaled.transform(train), boosted)])
        p_train, p_test = model.transform(train), model.transform(test)
        m_train = classification_counts(p_train).first()
        m_test = classification_counts(p_test).first()
        auc = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="rawPrediction",
                                            metricName="areaUnderROC").evaluate(p_test)
        metrics = {"train_accuracy": m_train["accuracy"], "test_accuracy": m_test["accuracy"],
                   "precision": m_test["precision"], "recall": m_test["recall"], "f1_score": m_test["f1_score"],
                   "roc_auc": round(float(auc), 3), "rounds": max_iter,
                   "feature_importance": dict(zip(FE.CHURN_FEATURES, [
                       round(float(x), 6) for x in model.stages[-1].featureImportances.toArray()])),
                   "model_version": MODEL_VERSION}
    finally:
        train.unpersist()
        split.unpersist()
    trained = TrainedModel(encoders, model, (), {"kind": "churn", "inputs": FE.CHURN_FEATURES,
                                                 "version": MODEL_VERSION, "metrics": metrics})
    save_model(spark, trained, path)
    return load_model(spark, path)


def classification_counts(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Confusion counts and accuracy / precision / recall / F1 of class 1 (exact, 3 decimals)."""
    y, p = F.col(label).cast("int"), F.col(prediction).cast("int")
    g = pred.agg(F.count_if((y == 1) & (p == 1)).alias("tp"), F.count_if((y == 0) & (p == 1)).alias("fp"),
                 F.count_if((y == 1) & (p == 0)).alias("fn"), F.count_if((y == 0) & (p == 0)).alias("tn"))

    def ratio(num: Column, den: Column) -> Column:
        return F.coalesce(round_half_up(F.try_divide(num.cast("decimal(20,0)"), den), 3), F.lit(0.0))

    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return g.select("tp", "fp", "fn", "tn",
                    ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"),
                    ratio(tp, tp + fp).alias("precision"), ratio(tp, tp + fn).alias("recall"),
                    ratio(2 * tp, 2 * tp + fp + fn).alias("f1_score"))


def rule_churn_prediction(tx: DataFrame, days: int = 30) -> DataFrame:
    """Baseline: churned if the last order is more than ``days`` before the window end."""
    f = FE.churn_features(tx)
    return f.select("customer_id", F.col("churned").cast("int").alias("label"),
                    (F.col("days_since_last_order") > days).cast("int").alias("prediction"))


def score_churn(model: TrainedModel, tx: DataFrame) -> DataFrame:
    """Churn probability per customer, 3 decimals."""
    scored = model.pipeline.transform(_churn_inputs(_churn_rows(tx), model.encoders))
    prob = vector_to_array(F.col("probability"))[1]
    return scored.select("customer_id", F.round(prob, 3).alias("churn_probability"))


def trained_at(spark: SparkSession, path: str, train) -> TrainedModel:
    """The model saved at ``path``; the one that ``train`` saves there if there is none."""
    if path_exists(spark, f"{path}/facts/_SUCCESS"):          # written last
        return load_model(spark, path)
    return train(path)
