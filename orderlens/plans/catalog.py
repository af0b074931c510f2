"""The analyses by name, each as ``function(tx, as_of) -> DataFrame``.

Used by the job runner (``python -m orderlens``) and the SQL views.
"""

from __future__ import annotations

from . import api as A
from . import customers as C
from . import dashboard as DB
from . import features as FE
from . import models as M
from . import operations as O


def jobs():
    """name -> function(tx, as_of) -> DataFrame (every analysis over a transactions frame)."""
    return {
        "clv": C.clv, "clv_simple": lambda tx, _: C.clv_simple(tx),
        "cohort_retention": lambda tx, _: C.cohort_retention(tx),
        "cohort_retention_weekly": lambda tx, _: C.cohort_retention(tx, period="weekly"),
        "rfm": C.rfm, "churn_risk": C.churn_risk, "cross_sell": C.cross_sell,
        "cuisine_pairs": lambda tx, _: C.cuisine_pairs(tx),
        "delivery_performance": O.delivery_performance, "peak_hours": O.peak_hours,
        "restaurant_performance": O.restaurant_performance, "city_growth": O.city_growth,
        "month_over_month": O.month_over_month,
        "executive_summary": lambda tx, d: O.executive_summary(tx, d, as_json=True),
        "retention_summary": A.retention_summary, "city_breakdown": A.city_breakdown,
        "operational_metrics": A.operational_metrics, "status_breakdown": A.status_breakdown,
        "daily_summary": A.daily_summary, "weekly_trend": A.weekly_trend, "top_cities": A.top_cities,
        "kpi_cards": lambda tx, d: DB.kpi_cards(DB.dashboard_frame(tx, d), d),
        "daily_revenue": lambda tx, d: DB.daily_revenue(DB.dashboard_frame(tx, d), d),
        "city_performance": lambda tx, d: DB.city_performance(DB.dashboard_frame(tx, d)),
        "delivery_box_stats": lambda tx, d: DB.delivery_box_stats(DB.dashboard_frame(tx, d)),
        "hourly_heatmap": lambda tx, d: DB.hourly_heatmap(DB.dashboard_frame(tx, d)),
        "operational_insights": lambda tx, d: DB.operational_insights(DB.dashboard_frame(tx, d)),
        "segmentation_features": lambda tx, _: FE.segmentation_features(tx),
        "delivery_features": lambda tx, _: FE.delivery_features(tx),
        "churn_features": lambda tx, _: FE.churn_features(tx),
    }


def training_jobs():
    """name -> function(tx, path): train and save a model."""
    return {
        "train_delivery": lambda tx, path: M.train_delivery_model(tx, path=path),
        "train_churn": lambda tx, path: M.train_churn_model(tx, path=path),
        "train_segments": lambda tx, path: M.train_segmentation(tx, path),
    }


def scoring_jobs():
    """name -> function(tx, path) -> DataFrame: score with a saved model."""
    return {
        "score_delivery": lambda tx, path: M.score_delivery(M.load_model(tx.sparkSession, path), tx),
        "score_churn": lambda tx, path: M.score_churn(M.load_model(tx.sparkSession, path), tx),
        "score_segments": lambda tx, path: M.customer_segments(tx, model=M.PipelineModel.load(f"{path}/model")),
    }
