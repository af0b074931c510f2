"""

Every query reads the test tables of ``sf_dir`` whole, rebuilds the
``transactions`` fact table from them (``orderlens.sources.fixture``) and runs
one analysis at the fixed reference date ``AS_OF``.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import os
import sys
import uuid
from collections.abc import Callable

# the package and the oracles live next to this file
_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.plans import customers as C
from orderlens.plans import api as A
from orderlens.plans import dashboard as DB
from orderlens.plans import features as FE
from orderlens.plans import models as M
from orderlens.plans import operations as O
from orderlens.plans import primitives as P
from orderlens.plans import rollup as RU
from orderlens.plans import sketches as SK
from orderlens.operators.split import stratified_split
from orderlens.functions.dates import days_back, trailing
from orderlens.session import scratch_dir
from orderlens.sources.files import CORRUPT, path_exists, read_csv
from orderlens.sources.fixture import read_table, transactions
from orderlens.sources.schema import COLUMNS as TX_COLUMNS
from orderlens.sources.schema import validate
from orderlens.streaming import kpis as ST
from orderlens.streaming import reconciled as RC

AS_OF = dt.date(2001, 8, 1)
SMOKE_DIR = "/root/testdata/sf0.001"

_ALL = None
# Columns each query reads: `transactions` joins lines / parts only when a listed
# column needs them (a left join cannot be pruned by the optimizer).
_CLV_COLS = ["order_id", "customer_id", "order_value", "order_date"]
_DT = ["order_date", "order_value", "delivery_time"]
_ORDER_STATS = ["city", "order_date", "order_id", "customer_id", "order_value", "delivery_time"]


def _tx(spark: SparkSession, sf_dir: str, cols=_ALL) -> DataFrame:
    return transactions(spark, sf_dir, cols)


def _final(df: DataFrame) -> DataFrame:
    """Report types: DECIMAL money and rates become DOUBLE (exact values, cast last)."""
    from pyspark.sql.types import DecimalType
    return df.select(*[F.col(f.name).cast("double").alias(f.name)
                       if isinstance(f.dataType, DecimalType) else F.col(f.name)
                       for f in df.schema.fields])


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: annualised customer lifetime value with value bands (sf0.001)."""
    return C.clv(_tx(spark, SMOKE_DIR, _CLV_COLS), AS_OF)


def _model_path(spark: SparkSession, sf_dir: str, kind: str) -> str:
    """Where this application saves the model of a data folder; the keys of a kind share it."""
    name = hashlib.md5(sf_dir.encode()).hexdigest()[:12]
    return scratch_dir(spark, f"models/{spark.sparkContext.applicationId}/{name}/{kind}")


def _trained(kind: str, spark: SparkSession, sf_dir: str, tx: DataFrame) -> M.TrainedModel:
    def train(path: str) -> M.TrainedModel:
        if kind == "churn":
            return M.train_churn_model(tx, path=path)
        return M.train_delivery_model(tx, path=path)
    return M.trained_at(spark, _model_path(spark, sf_dir, kind), train)


def _segmentation_path(spark: SparkSession, sf_dir: str, tx: DataFrame, city: str | None = None) -> str:
    """The segmentation of a data folder or of one city's orders in it (search for k, ten starts),
    trained once per application."""
    path = _model_path(spark, sf_dir, f"segmentation_{city}" if city else "segmentation")
    if not path_exists(spark, f"{path}/choose_k/_SUCCESS"):        # written last
        M.train_segmentation(A.filter_orders(tx, city), path)
    return path


def _segmentation(spark: SparkSession, sf_dir: str, tx: DataFrame, city: str | None = None):
    return M.PipelineModel.load(f"{_segmentation_path(spark, sf_dir, tx, city)}/model")


def _derived(spark: SparkSession, sf_dir: str, kind: str, build) -> str:
    """A folder that the first key of this application that needs it builds (``build(path)``)."""
    path = f"{_model_path(spark, sf_dir, kind)}"
    if not path_exists(spark, f"{path}/done"):
        build(path)
        spark.range(1).write.mode("overwrite").parquet(f"{path}/done")
    return path


def _rollup(spark: SparkSession, sf_dir: str) -> str:
    """Day partials after two loads: most orders first, then a file of orders of days already taken."""
    def build(path: str) -> None:
        tx = _tx(spark, sf_dir, ["order_id", "customer_id", "city", "order_value", "delivery_time", "order_date"])
        late = F.pmod(F.xxhash64("order_id"), F.lit(97)) == 0
        # a file per task of the rebuild; the few late orders are dealt to files of their own after it
        for name, rows in (("first", tx.filter(~late)), ("late", tx.filter(late).repartition(4))):
            rows.write.mode("overwrite").parquet(f"{path}/landing/{name}")
            RU.refresh(spark, f"{path}/landing", f"{path}/table")
    return _derived(spark, sf_dir, "rollup", build) + "/table"


def _sketches(spark: SparkSession, sf_dir: str) -> str:
    return _derived(spark, sf_dir, "sketches", lambda path: SK.write_sketches(_tx(
        spark, sf_dir, ["order_id", "customer_id", "restaurant_id", "city", "order_date"]), f"{path}/table")) + "/table"


def _close(estimate: str, exact: str, share: float = 0.02):
    return (F.abs(F.col(estimate) - F.col(exact)) <= share * F.col(exact)).alias(f"{exact}_close")


def _sketch_counts(rows: DataFrame, tx: DataFrame) -> DataFrame:
    """Exact counts of the window, and whether the merged sketches are within two per cent of them."""
    got = SK.distinct_counts(rows, AS_OF).select("city", *[F.col(k).alias(f"{k}_est") for k in ("customers", "restaurants", "orders")])
    want = P.distinct_counts(trailing(tx, AS_OF, months=12))
    return want.join(got, "city").select("city", "customers", "restaurants", "orders",
                                         *[_close(f"{k}_est", k) for k in ("customers", "restaurants", "orders")])


def _sketch_new(rows: DataFrame, tx: DataFrame) -> DataFrame:
    """Customers of the last 30 days without an order in the year before, per city: exact, and whether the sketches agree."""
    recent = F.col("order_date") >= days_back(AS_OF, 30).cast("timestamp_ntz")
    per = trailing(tx, AS_OF, months=12).groupBy("city", "customer_id").agg(
        F.bool_or(recent).alias("r"), F.bool_or(~recent).alias("b"))
    want = per.filter(F.col("customer_id").isNotNull()).groupBy("city").agg(
        F.count_if("r").alias("customers"), F.count_if(F.col("r") & ~F.col("b")).alias("new_customers"))
    got = SK.new_customers(rows, AS_OF).select("city", F.col("customers").alias("customers_est"), F.col("new_customers").alias("new_est"))
    # the error of a difference is relative to the sets that it is taken of
    near = (F.abs(F.col("new_est") - F.col("new_customers")) <= 0.02 * F.col("customers")).alias("new_customers_close")
    return want.join(got, "city").select("city", "customers", "new_customers", _close("customers_est", "customers"), near)


def _event_loads(spark: SparkSession, sf_dir: str, folder: str) -> None:
    """The purchases as a source sends them: some twice at once, some again within the hour, some held back too long."""
    events = read_table(spark, sf_dir, "events").filter("event_type = 'purchase'")
    last = events.agg(F.max("ts").alias("m")).select(F.col("m") - F.expr("INTERVAL 1 HOUR")).scalar()
    held = (F.col("event_id") % 50 == 1) & (F.col("ts") <= last)
    first = events.filter(~held)
    loads = [first.unionByName(first.filter("event_id % 100 = 3")),
             events.filter((F.col("ts") > last) & (F.col("event_id") % 2 == 0)), events.filter(held)]
    for k, rows in enumerate(loads):
        rows.coalesce(1).write.mode("overwrite").parquet(f"{folder}/load_{k}")


# key -> (analysis over a transactions frame, columns it reads); filled by _registry
ANALYSES: dict[str, tuple[Callable[[DataFrame], DataFrame], list[str] | None]] = {}


def _registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    q: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

    def reg(name: str, cols=_ALL):
        def deco(fn):
            q[name] = lambda spark, sf_dir: _final(fn(_tx(spark, sf_dir, cols)))
            ANALYSES[name] = (fn, cols)
            return fn
        return deco

    # ---- the SQL analyses (2.9)
    reg("clv", _CLV_COLS)(lambda tx: C.clv(tx, AS_OF))
    reg("clv_simple", _CLV_COLS)(C.clv_simple)
    reg("cohort_retention", ["customer_id", "order_date"])(lambda tx: C.cohort_retention(tx))
    reg("cohort_retention_weekly", ["customer_id", "order_date"])(
        lambda tx: C.cohort_retention(tx, period="weekly"))
    reg("rfm", _CLV_COLS)(lambda tx: C.rfm(tx, AS_OF))
    reg("churn_risk", _CLV_COLS)(lambda tx: C.churn_risk(tx, AS_OF))
    reg("cuisine_pairs", _CLV_COLS + ["cuisine_type"])(lambda tx: C.cuisine_pairs(tx))
    reg("cross_sell", _CLV_COLS + ["cuisine_type"])(lambda tx: C.cross_sell(tx, AS_OF))
    reg("delivery_performance", _ORDER_STATS)(lambda tx: O.delivery_performance(tx, AS_OF))
    reg("peak_hours", _DT)(lambda tx: O.peak_hours(tx, AS_OF))
    reg("demand_level", _DT)(lambda tx: O.demand_level(tx, AS_OF))
    reg("restaurant_performance", _ORDER_STATS + ["restaurant_id", "cuisine_type"])(
        lambda tx: O.restaurant_performance(tx, AS_OF))
    reg("month_over_month", _ORDER_STATS)(lambda tx: O.month_over_month(tx, AS_OF))
    reg("city_growth", _ORDER_STATS)(lambda tx: O.city_growth(tx, AS_OF))
    reg("executive_summary", _DT + ["customer_id", "restaurant_id"])(
        lambda tx: O.executive_summary(tx, AS_OF))

    reg("executive_summary_json", _DT + ["customer_id", "restaurant_id"])(
        lambda tx: O.parse_summary(O.executive_summary(tx, AS_OF, as_json=True)))

    # ---- API metrics (2.12)
    reg("retention_summary", _CLV_COLS)(lambda tx: A.retention_summary(tx, AS_OF))
    reg("retention_cohorts", ["customer_id", "order_date", "city"])(
        lambda tx: A.retention_cohorts(tx, city="ASIA"))
    reg("city_breakdown", _DT + ["city"])(lambda tx: A.city_breakdown(tx, AS_OF))
    reg("operational_metrics", _DT + ["customer_id", "restaurant_id"])(
        lambda tx: A.operational_metrics(tx, AS_OF))
    reg("status_breakdown", _DT + ["delivery_status", "payment_method"])(
        lambda tx: A.status_breakdown(tx, AS_OF))
    reg("daily_summary", _DT)(lambda tx: A.daily_summary(tx, AS_OF))
    reg("weekly_trend", ["order_date", "order_value"])(lambda tx: A.weekly_trend(tx, AS_OF))
    reg("weekly_trend_json", ["order_date", "order_value"])(
        lambda tx: A.parse_trend(A.weekly_trend_json(tx, AS_OF)))
    reg("top_cities", _DT + ["city"])(lambda tx: A.top_cities(tx, AS_OF))

    # ---- dashboard tables (2.13), over the page's default selection
    def dash(name, fn, cols):
        reg(name, cols)(lambda tx: fn(DB.dashboard_frame(tx, AS_OF)))

    dash("kpi_cards", lambda df: DB.kpi_cards(df, AS_OF), _DT + ["customer_id"])
    dash("daily_revenue", lambda df: DB.daily_revenue(df, AS_OF), ["order_id", "order_date", "order_value"])
    dash("city_performance", DB.city_performance, _DT + ["city"])
    dash("delivery_box_stats", DB.delivery_box_stats, ["city", "order_date", "delivery_time"])
    dash("hourly_heatmap", DB.hourly_heatmap, ["order_date"])
    dash("operational_insights", DB.operational_insights, _DT + ["city", "customer_id"])
    dash("peak_hour_and_best_city", DB.peak_hour_and_best_city, ["order_date", "order_value", "city"])
    dash("repeat_rate", DB.repeat_rate, ["customer_id", "order_date"])
    reg("spend_box_stats", _CLV_COLS + ["delivery_time"])(lambda tx: DB.spend_box_stats(tx, AS_OF))

    def dated_export(spark, sf_dir):
        """The selection written as CSV under its dated folder, and read back from there."""
        folder = DB.export_csv(DB.dashboard_frame(_tx(spark, sf_dir), AS_OF),
                               scratch_dir(spark, f"dated_export/{uuid.uuid4().hex}"), AS_OF)
        return _final(read_csv(spark, folder).drop(CORRUPT))

    q["dated_export"] = dated_export
    dash("dataset_overview", DB.dataset_overview, ["order_date", "city"])
    dash("distinct_cities", DB.distinct_cities, ["order_date", "city"])

    # ---- the same tables from day partials and sketches
    def rolled(name, use):
        q[name] = lambda spark, sf_dir: _final(use(RU.read_days(spark, _rollup(spark, sf_dir))))

    rolled("kpi_cards_rollup", lambda days: RU.kpi_cards(days, AS_OF))
    rolled("daily_revenue_rollup", lambda days: RU.daily_revenue(days, AS_OF))
    rolled("city_performance_rollup", lambda days: RU.city_performance(days, AS_OF))

    def sketched(name, use):
        q[name] = lambda spark, sf_dir: use(SK.read_sketches(spark, _sketches(spark, sf_dir)), _tx(
            spark, sf_dir, ["order_id", "customer_id", "restaurant_id", "city", "order_date"]))

    sketched("sketch_distinct_counts", _sketch_counts)
    sketched("sketch_new_customers", _sketch_new)

    # ---- single operators (2.1-2.8)
    reg("scan_transactions")(lambda tx: tx)
    reg("scan_pruned", P.SEGMENT_COLUMNS)(P.scan_pruned)
    reg("recent_orders")(lambda tx: P.recent_orders(tx, AS_OF))
    reg("validate_keys", ["order_id"])(validate)
    q["csv_round_trip"] = lambda spark, sf_dir: _final(P.csv_round_trip(
        _tx(spark, sf_dir), scratch_dir(spark, f"csv_round_trip/{uuid.uuid4().hex}")).drop("_corrupt_record"))
    reg("trailing_window", ["order_date"])(lambda tx: P.trailing_window(tx, AS_OF))
    reg("filter_city_dates")(lambda tx: A.filter_orders(tx, "ASIA", "2001-01-01", "2001-03-31"))
    reg("any_row", ["order_id", "city", "order_date"])(
        lambda tx: A.any_row(A.filter_orders(tx, "ASIA", "2001-01-01", "2001-03-31")))
    reg("value_counts", _CLV_COLS)(lambda tx: P.value_counts(C.clv(tx, AS_OF, ordered=False), "customer_segment"))
    reg("having_filter", ["order_id", "customer_id"])(P.having_filter)
    reg("on_time_rate", ["city", "delivery_time"])(P.on_time_rate)
    reg("band_self_join", _CLV_COLS + ["cuisine_type"])(P.band_self_join)
    reg("anti_join_unseen", _CLV_COLS + ["cuisine_type"])(lambda tx: P.anti_join_unseen(tx, AS_OF))
    reg("group_city_month", ["city", "order_date", "order_value"])(P.group_city_month)
    reg("distinct_counts", ["city", "customer_id", "restaurant_id", "order_id"])(P.distinct_counts)
    reg("delivery_percentiles", ["city", "delivery_time"])(P.delivery_percentiles)
    reg("latest_order_attrs", ["order_id", "customer_id", "order_date", "city", "cuisine_type"])(
        P.latest_order_attrs)
    reg("ntile_scores", ["customer_id", "order_value"])(P.ntile_scores)
    reg("rank_in_city", ["city", "restaurant_id", "order_value"])(P.rank_in_city)
    reg("top_preference", _CLV_COLS + ["cuisine_type"])(lambda tx: P.top_preference(tx, AS_OF))
    reg("order_gaps", _CLV_COLS)(P.order_gaps)
    reg("share_of_day", ["order_date"])(P.share_of_day)
    reg("fn_dates", ["order_id", "order_date"])(lambda tx: P.fn_dates(tx, AS_OF))
    reg("fn_elapsed_days", ["customer_id", "order_date"])(P.fn_elapsed_days)
    reg("fn_rounding", ["customer_id", "order_value"])(P.fn_rounding)
    reg("order_complexity", ["order_id", "order_value"])(P.order_complexity)

    # ---- features (2.10)
    reg("segmentation_features", _DT + ["customer_id"])(FE.segmentation_features)
    reg("delivery_features")(FE.delivery_features)
    reg("churn_features")(FE.churn_features)
    reg("churn_label")(lambda tx: FE.churn_features(tx).select("customer_id", "churned"))
    reg("label_encoding", ["order_id", "city", "cuisine_type"])(FE.label_encoding)
    reg("standardize", _DT + ["customer_id"])(
        lambda tx: FE.standardize(FE.segmentation_features(tx), FE.SEGMENT_FEATURES, "customer_id"))
    reg("train_test_split")(lambda tx: stratified_split(
        FE.churn_features(tx).select("customer_id", "churned"), "customer_id", "churned")
        .groupBy("churned", "is_test").agg(F.count(F.lit(1)).alias("customers")))
    reg("delivery_features_full")(lambda tx: FE.delivery_features(tx, optional=True))

    # ---- models (2.11); trained models are checked by rows and invariants
    def choose_k(spark, sf_dir):
        return spark.read.parquet(f"{_segmentation_path(spark, sf_dir, _tx(spark, sf_dir))}/choose_k")

    q["choose_k"] = choose_k

    def segmented(name, use, city=None):
        def run(spark, sf_dir):
            tx = _tx(spark, sf_dir)
            return _final(use(_segmentation(spark, sf_dir, tx, city), tx))
        q[name] = run

    segmented("customer_segments", lambda model, tx: M.customer_segments(tx, model=model))
    segmented("segment_profiles", lambda model, tx: M.segment_profiles(tx, model=model))
    segmented("segment_summary", lambda model, tx: A.segment_summary(tx, city="ASIA", model=model),
              city="ASIA")
    segmented("segment_totals", M.segment_totals)
    # what holds whatever the models are: every customer once, shares in range, one choice
    segmented("segment_summary_totals", lambda model, tx: A.segment_summary(tx, city="ASIA", model=model).agg(
        F.sum("size").alias("customers"), F.max("total_customers").alias("total_customers"),
        F.count(F.lit(1)).between(2, M.MAX_K).alias("segments_in_range")), city="ASIA")
    q["choose_k_totals"] = lambda spark, sf_dir: choose_k(spark, sf_dir).agg(
        F.count(F.lit(1)).alias("ks"), F.count_if("chosen").alias("chosen"),
        (F.max(F.when(F.col("chosen"), F.col("silhouette"))) == F.max("silhouette")).alias("best_chosen"))
    reg("segment_rules", _CLV_COLS + ["delivery_time"])(lambda tx: M.segment_rules(tx, AS_OF))
    reg("characteristic_sizes", _CLV_COLS + ["delivery_time"])(
        lambda tx: M.characteristic_sizes(M.segment_rules(tx, AS_OF)))

    def round_trip(spark, sf_dir):
        """Scores of the saved segmentation against those of the same model saved and loaded once more."""
        tx = _tx(spark, sf_dir)
        return M.model_round_trip(tx, scratch_dir(spark, f"segmentation_model/{uuid.uuid4().hex}"),
                                  model=_segmentation(spark, sf_dir, tx))

    q["model_round_trip"] = round_trip

    def model_key(name, kind, use):
        def run(spark, sf_dir):
            tx = _tx(spark, sf_dir)
            return _final(use(_trained(kind, spark, sf_dir, tx), tx))
        q[name] = run

    def again(score, key, col):
        """A model saved to a second folder and loaded from it gives equal scores."""
        def use(model, tx):
            path = scratch_dir(tx.sparkSession, f"model_copy/{uuid.uuid4().hex}")
            M.save_model(tx.sparkSession, model, path)
            return M.compare_scores(score(model, tx), score(M.load_model(tx.sparkSession, path), tx), key, col)
        return use

    def delivery_grid(spark, sf_dir):
        _trained("delivery", spark, sf_dir, _tx(spark, sf_dir))
        return M.delivery_grid(spark, _model_path(spark, sf_dir, "delivery"))

    q["delivery_grid"] = delivery_grid
    q["delivery_grid_totals"] = lambda spark, sf_dir: delivery_grid(spark, sf_dir).agg(
        F.count(F.lit(1)).alias("points"), F.count_if("chosen").alias("chosen"),
        (F.max(F.when(F.col("chosen"), F.col("cv_mae_mean"))) == F.min("cv_mae_mean")).alias("least_chosen"))
    model_key("delivery_model_metrics", "delivery", lambda model, tx: M.model_metrics(tx.sparkSession, model))
    reg("regression_metrics")(lambda tx: M.regression_metrics(M.rule_prediction(tx)))
    reg("scoring_input_report")(M.required_field_report)
    model_key("score_delivery", "delivery", M.score_delivery)
    model_key("delivery_round_trip", "delivery", again(M.score_delivery, "order_id", "predicted_delivery_time"))
    reg("prediction_interval")(lambda tx: M.prediction_interval(
        M.rule_prediction(tx).filter(F.col("prediction").isNotNull()).select(
            "order_id", F.greatest(F.col("prediction").cast("double"), F.lit(10.0))
            .alias("predicted_delivery_time")), "predicted_delivery_time"))
    model_key("churn_model_metrics", "churn", lambda model, tx: M.model_metrics(tx.sparkSession, model))
    reg("classification_metrics")(lambda tx: M.classification_counts(M.rule_churn_prediction(tx)))
    model_key("score_churn", "churn", M.score_churn)
    model_key("churn_score_totals", "churn", lambda model, tx: M.score_churn(model, tx).agg(
        F.count(F.lit(1)).alias("customers"), F.count_if(F.col("churn_probability").between(0, 1)).alias("in_range")))
    model_key("churn_round_trip", "churn", again(M.score_churn, "customer_id", "churn_probability"))

    # ---- streaming (2.14): the streams (rows) and their batch twins (oracle)
    q["stream_daily_kpis"] = lambda spark, sf_dir: ST.stream_daily_kpis(
        spark, f"{sf_dir.rstrip('/')}/events.parquet",
        scratch_dir(spark, f"stream_daily_kpis/{uuid.uuid4().hex}"))
    def stream_reconciled(spark, sf_dir):
        out = scratch_dir(spark, f"stream_reconciled/{uuid.uuid4().hex}")
        _event_loads(spark, sf_dir, f"{out}/source")
        RC.run(ST.purchases(ST.read_event_stream(spark, f"{out}/source/*", 1)), out)
        return RC.balance(spark, out)

    q["stream_reconciled"] = stream_reconciled
    q["daily_kpis_events"] = lambda spark, sf_dir: ST.daily_kpis(
        ST.purchases(read_table(spark, sf_dir, "events")))
    q["stream_hourly_kpis"] = lambda spark, sf_dir: ST.stream_daily_kpis(
        spark, f"{sf_dir.rstrip('/')}/events.parquet",
        scratch_dir(spark, f"stream_hourly_kpis/{uuid.uuid4().hex}"), window="1 hour", watermark="10 minutes")
    q["hourly_kpis_events"] = lambda spark, sf_dir: ST.daily_kpis(
        ST.purchases(read_table(spark, sf_dir, "events")), window="1 hour")
    return q


def _corpus() -> tuple[dict[str, Callable[[SparkSession, str], DataFrame]], dict[str, str]]:
    """Queries and oracles of the ``llm`` subpackage and its pipeline; none where they are not installed."""
    try:
        import corpus_pipeline
        from orderlens.llm.queries import ORACLES, QUERIES
    except ModuleNotFoundError as e:
        if e.name == "corpus_pipeline" or (e.name or "").startswith("orderlens.llm"):
            return {}, {}
        raise
    oracles = dict(ORACLES) | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
    return QUERIES | {"pipeline": corpus_pipeline.run}, oracles


def table_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """The queries over ``transactions``, without the corpus operators."""
    return _registry()


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return _registry() | _corpus()[0]


def analyses() -> dict[str, tuple[Callable[[DataFrame], DataFrame], list[str] | None]]:
    """The same analyses as functions of a ``transactions`` frame (e.g. a stored table)."""
    _registry()
    return dict(ANALYSES)


def oracle_sql() -> dict[str, str]:
    from oracle.sql import ORACLES
    return {k: v for k, v in ORACLES.items() if k in _registry()} | _corpus()[1]
