"""Feature tables for segmentation, delivery-time and churn models.

pandas semantics are kept where the reference relies on them: NULL keys are
dropped by ``groupby``, ``count`` skips NULLs, ``std`` is the sample standard
deviation (NULL for one row), ``.round(2)`` is half-even (done exactly on
DECIMAL; standard deviations are doubles and rounded as doubles), elapsed
days are floored.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import StringIndexer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions.rounding import exact_mean
from ..session import free
from .primitives import complexity

PEAK_HOURS = [12, 13, 19, 20, 21]          # fixed values: lunch and dinner hours
WEEKEND_DAYS = [5, 6]                      # Monday = 0

SEGMENT_FEATURES = ["total_spent", "order_frequency", "avg_order_value", "orders_per_day",
                    "avg_delivery_time"]

DELIVERY_FEATURES = [
    "order_value", "hour_of_day", "day_of_week", "is_weekend", "is_peak_hour",
    "restaurant_delivery_time_mean", "restaurant_delivery_time_std",
    "restaurant_delivery_time_count", "restaurant_order_value_mean", "city_delivery_time_mean",
    "city_delivery_time_std", "city_order_value_mean", "city_encoded", "cuisine_type_encoded",
    "order_complexity_encoded"]

# Used in addition when the fact table may carry them.
OPTIONAL_DELIVERY_FEATURES = ["estimated_distance_km", "weather_condition_encoded"]
DEFAULT_DISTANCE_KM = 3.0                  # fixed value

CHURN_FEATURES = ["total_orders", "total_spent", "avg_order_value", "order_value_variability",
                  "avg_delivery_time", "delivery_consistency", "days_active", "order_frequency",
                  "days_since_last_order", "city_encoded", "cuisine_type_encoded"]


def _bround(c: Column) -> Column:
    return F.bround(c, 2)


# ---------------------------------------------------------------- F1
def segmentation_features(tx: DataFrame) -> DataFrame:
    """Customer features for clustering: one aggregation by customer, NULL -> 0."""
    g = tx.filter(F.col("customer_id").isNotNull()).groupBy("customer_id").agg(
        F.sum("order_value").alias("total_spent"),
        _bround(exact_mean("order_value")).alias("avg_order_value"),
        F.count("order_value").alias("order_frequency"),
        _bround(exact_mean("delivery_time", integral=True)).alias("avg_delivery_time"),
        (D.elapsed_days(F.max("order_date"), F.min("order_date")) + 1).alias("lifetime"))
    per_day = F.coalesce(F.try_divide(F.col("order_frequency").cast("double"), F.col("lifetime")),
                         F.col("order_frequency").cast("double"))
    return g.select(
        "customer_id",
        F.coalesce(F.col("total_spent"), F.lit(0).cast("decimal(20,2)")).alias("total_spent"),
        "order_frequency",
        F.coalesce(F.col("avg_order_value"), F.lit(0).cast("decimal(20,2)")).alias("avg_order_value"),
        F.coalesce(per_day, F.lit(0.0)).alias("orders_per_day"),
        F.coalesce(F.col("avg_delivery_time"), F.lit(0).cast("decimal(20,2)")).alias("avg_delivery_time"))


# ---------------------------------------------------------------- F2
def time_features(ts: Column) -> list[Column]:
    dow = D.weekday_mon0(ts)
    hour = F.hour(ts)
    return [hour.alias("hour_of_day"), dow.alias("day_of_week"),
            dow.isin(WEEKEND_DAYS).cast("int").alias("is_weekend"),
            hour.isin(PEAK_HOURS).cast("int").alias("is_peak_hour")]


def delivery_features(tx: DataFrame, stats: tuple[DataFrame, DataFrame] | None = None,
                      optional: bool = False) -> DataFrame:
    """Order features for the delivery-time model.

    Restaurant and city statistics are aggregates joined back by key: the
    restaurant table grows with the data, so the join strategy is left to
    AQE (broadcast when measured small, skew-split otherwise).  Pass ``stats``
    fitted on a training split to avoid target leakage.

    ``optional`` adds the distance and weather features: the columns
    ``distance_km`` and ``weather_condition`` where ``tx`` has them, else the
    default distance and a NULL weather.
    """
    rest, city = stats if stats is not None else delivery_stats(tx)
    extra = optional_inputs(tx) if optional else []
    base = tx.select("order_id", "restaurant_id", "city", "cuisine_type", "order_value",
                     "delivery_time", *time_features(F.col("order_date")),
                     complexity("order_value").alias("order_complexity"), *extra)
    return base.join(rest, "restaurant_id", "left").join(city, "city", "left")


def optional_inputs(tx: DataFrame) -> list[Column]:
    """``estimated_distance_km`` (default 3.0) and ``weather_condition`` from the columns present."""
    present = set(tx.columns)
    distance = F.col("distance_km").cast("double") if "distance_km" in present else F.lit(None).cast("double")
    weather = F.col("weather_condition").cast("string") if "weather_condition" in present \
        else F.lit(None).cast("string")
    return [F.coalesce(distance, F.lit(DEFAULT_DISTANCE_KM)).alias("estimated_distance_km"),
            weather.alias("weather_condition")]


def delivery_stats(tx: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Restaurant and city statistics, both rolled up from one table of mergeable partials.

    The orders are reduced once to counts, sums and sums of squares per
    (restaurant, city); both roll-ups start from that exchange, which Spark
    reuses.  Sums are exact (integers and DECIMAL), so the order of merging
    does not matter; the sample deviation of one row is NULL.
    """
    t = F.col("delivery_time").cast("decimal(10,0)")
    partial = tx.groupBy("restaurant_id", "city").agg(
        F.count("delivery_time").alias("_n"), F.sum(t).alias("_s"), F.sum(t * t).alias("_q"),
        F.count("order_value").alias("_vn"), F.sum("order_value").alias("_v"))

    def roll(key: str, prefix: str, with_count: bool) -> DataFrame:
        # an exploded key: filters on it stay above, so both roll-ups read the same exchange
        rows = partial.select(F.explode(F.array(F.col(key))).alias(key), "_n", "_s", "_q", "_vn", "_v")
        g = rows.filter(F.col(key).isNotNull()).groupBy(key).agg(
            F.sum("_n").alias("n"), F.sum("_s").cast("decimal(20,0)").alias("s"),
            F.sum("_q").cast("decimal(24,0)").alias("q"), F.sum("_vn").alias("vn"), F.sum("_v").alias("v"))
        n = F.col("n").cast("double")
        spread = F.col("q").cast("double") - F.col("s").cast("double") * F.col("s").cast("double") / n
        std = F.when(F.col("n") > 1, F.sqrt(F.greatest(spread, F.lit(0.0)) / (n - 1)))
        mean = F.try_divide(F.col("s"), F.col("n").cast("decimal(20,0)"))
        value = F.try_divide(F.col("v"), F.col("vn").cast("decimal(20,0)"))
        cols = [_bround(mean).cast("decimal(20,2)").alias(f"{prefix}delivery_time_mean"),
                F.bround(std, 2).alias(f"{prefix}delivery_time_std")]
        if with_count:
            cols.append(F.col("n").alias(f"{prefix}delivery_time_count"))
        return g.select(key, *cols, _bround(value).cast("decimal(20,2)").alias(f"{prefix}order_value_mean"))

    return roll("restaurant_id", "restaurant_", True), roll("city", "city_", False)


# ---------------------------------------------------------------- F3
def churn_features(tx: DataFrame, prediction_window_days: int = 30,
                   observation_days: int = 90) -> DataFrame:
    """Customer features over a 90-day observation window ending 30 days before the last order.

    The window end comes from an uncorrelated scalar subquery (the last order
    minus the prediction window; no driver round trip).  Only orders from the
    window start on can matter, for the statistics as for the label (an order
    after the window), so everything else is one aggregation over that range,
    which prunes a table partitioned by month.
    """
    last = tx.agg(F.max("order_date")).scalar()
    back = F.make_dt_interval(F.lit(prediction_window_days))
    start = last - F.make_dt_interval(F.lit(prediction_window_days + observation_days))
    known = (D.since(tx.filter(F.col("customer_id").isNotNull()), start)
             .withColumn("_end", (last - back).cast("timestamp_ntz")))
    obs = F.col("order_date") <= F.col("_end")

    def o(c: str) -> Column:
        return F.when(obs, F.col(c))

    g = (known.groupBy("customer_id").agg(
        F.count(o("order_id")).alias("total_orders"),
        F.sum(o("order_value")).alias("total_spent"),
        _bround(exact_mean(o("order_value"))).alias("avg_order_value"),
        F.bround(F.stddev_samp(o("order_value")), 2).alias("order_value_variability"),
        _bround(exact_mean(o("delivery_time"), integral=True)).alias("avg_delivery_time"),
        F.bround(F.stddev_samp(o("delivery_time")), 2).alias("delivery_consistency"),
        F.min(o("order_date")).alias("_first"), F.max(o("order_date")).alias("_last"),
        F.count_if(obs).alias("_in_window"), F.max("_end").alias("_end"),
        F.max("order_date").alias("_latest_any"),
        F.max_by(F.struct("city", "cuisine_type"),
                 F.when(obs, F.struct("order_date", "order_id"))).alias("_cat"))
         .filter(F.col("_in_window") > 0))
    end = F.col("_end")
    days_active = D.elapsed_days(F.col("_last"), F.col("_first")) + 1
    zero2 = F.lit(0).cast("decimal(20,2)")
    return g.select(
        "customer_id", "total_orders",
        F.coalesce("total_spent", zero2).alias("total_spent"),
        F.coalesce("avg_order_value", zero2).alias("avg_order_value"),
        F.coalesce("order_value_variability", F.lit(0.0)).alias("order_value_variability"),
        F.coalesce("avg_delivery_time", zero2).alias("avg_delivery_time"),
        F.coalesce("delivery_consistency", F.lit(0.0)).alias("delivery_consistency"),
        days_active.alias("days_active"),
        (F.col("total_orders") / days_active).alias("order_frequency"),
        D.elapsed_days(end, F.col("_last")).alias("days_since_last_order"),
        F.coalesce(F.col("_cat.city"), F.lit("0")).alias("city"),
        F.coalesce(F.col("_cat.cuisine_type"), F.lit("0")).alias("cuisine_type"),
        (~(F.col("_latest_any") > end)).alias("churned"))


# ---------------------------------------------------------------- F4
def fit_label_encoders(df: DataFrame, columns: list[str]) -> PipelineModel:
    """Sorted-label encoders (0..n-1).  Only the label list reaches the driver.

    NULL is encoded as the text 'nan', like ``astype(str)`` on a missing value.
    """
    stages = [StringIndexer(inputCol=f"_{c}_txt", outputCol=f"_{c}_idx",
                            stringOrderType="alphabetAsc", handleInvalid="keep") for c in columns]
    text, fitted = _as_text(df, columns), []
    for stage in stages:                       # a pass each; the shuffle files of one go before the next
        fitted.append(stage.fit(text))
        free(df.sparkSession)
    return PipelineModel(fitted)


def _as_text(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({f"_{c}_txt": F.coalesce(F.col(c).cast("string"), F.lit("nan"))
                           for c in columns})


def apply_label_encoders(model: PipelineModel, df: DataFrame, columns: list[str]) -> DataFrame:
    """``<col>_encoded``; an unseen label becomes -1 (the indexer's 'keep' bucket n)."""
    out = model.transform(_as_text(df, columns))
    for c, stage in zip(columns, model.stages):
        n = len(stage.labelsArray[0])
        idx = F.col(f"_{c}_idx")
        out = out.withColumn(f"{c}_encoded", F.when(idx >= n, F.lit(-1)).otherwise(idx.cast("int")))
    return out.drop(*[f"_{c}_txt" for c in columns], *[f"_{c}_idx" for c in columns])


def label_encoding(tx: DataFrame, columns: tuple[str, ...] = ("city", "cuisine_type")) -> DataFrame:
    cols = list(columns)
    model = fit_label_encoders(tx, cols)
    out = apply_label_encoders(model, tx.select("order_id", *cols), cols)
    return out.select("order_id", *cols, *[F.col(f"{c}_encoded").cast("bigint").alias(f"{c}_encoded")
                                           for c in cols])


# ---------------------------------------------------------------- F5
def standardize(df: DataFrame, columns: list[str], key: str, digits: int = 6) -> DataFrame:
    """z = (x - mean) / population std; all statistics come from one scalar subquery."""
    stats = df.agg(F.struct(*[F.avg(F.col(c).cast("double")).alias(f"m_{c}") for c in columns],
                            *[F.stddev_pop(F.col(c).cast("double")).alias(f"s_{c}") for c in columns])
                   ).scalar()

    def z(c: str) -> Column:
        x = F.col(c).cast("double")
        return F.round(F.try_divide(x - stats.getField(f"m_{c}"), stats.getField(f"s_{c}")), digits)

    return df.select(key, *[z(c).alias(f"{c}_z") for c in columns])
