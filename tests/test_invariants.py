
from collections import defaultdict

from conftest import SF_MID
import __spark_entry__ as E


def _rows(spark, key):
    return E.queries()[key](spark, SF_MID).collect()


def test_cohort_month_zero_is_everyone(spark):
    rows = _rows(spark, "cohort_retention")
    zero = [r for r in rows if r["month_number"] == 0]
    assert zero and all(r["retention_rate"] == 100.0 and r["customers_retained"] == r["cohort_size"] for r in zero)
    assert all(r["customers_retained"] <= r["cohort_size"] for r in rows)


def test_daily_shares_sum_to_hundred(spark):
    total = defaultdict(float)
    for r in _rows(spark, "peak_hours"):
        total[r["day_of_week"]] += r["pct_of_daily_orders"]
    assert total and all(abs(v - 100.0) <= 0.01 * 24 for v in total.values())


def test_every_city_has_a_top_restaurant(spark):
    cities = defaultdict(list)
    for r in _rows(spark, "restaurant_performance"):
        cities[r["city"]].append(r["revenue_rank"])
    assert cities and all(min(v) == 1 for v in cities.values())


def test_rfm_quintiles_are_balanced(spark):
    rows = _rows(spark, "rfm")
    for score in ("recency_score", "frequency_score", "monetary_score"):
        sizes = defaultdict(int)
        for r in rows:
            sizes[r[score]] += 1
        assert set(sizes) == {1, 2, 3, 4, 5} and max(sizes.values()) - min(sizes.values()) <= 1


def test_clv_bands_match_fixture_notes(spark):
    bands = defaultdict(int)
    for r in _rows(spark, "clv"):
        bands[r["customer_segment"]] += 1
    assert dict(bands) == {"High Value": 780, "Medium Value": 241, "Low Value": 113, "Very Low Value": 44}


def test_churn_levels_match_fixture_notes(spark):
    levels = defaultdict(int)
    for r in _rows(spark, "churn_risk"):
        levels[r["churn_risk_level"]] += 1
    assert dict(levels) == {"Active": 905, "Low Risk": 346, "Medium Risk": 133, "High Risk": 114}


def test_cuisine_pairs_match_fixture_notes(spark):
    rows = _rows(spark, "cuisine_pairs")
    assert len(rows) == 30 and all(76 <= r["customers_ordering_both"] <= 115 for r in rows)


def test_cohorts_match_fixture_notes(spark):
    zero = [r for r in _rows(spark, "cohort_retention") if r["month_number"] == 0]
    assert len(zero) == 51 and sum(r["cohort_size"] for r in zero) == 1500
