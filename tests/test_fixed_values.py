"""Limits and texts as literals: the SQL checks import these values, so a wrong one would not show there."""

import hashlib

from spendgrid.functions import labels
from spendgrid.operators import ml, staging
from spendgrid.params import Params


def test_bands_and_levels():
    assert staging.AGE_BANDS == [(25, "18-25"), (35, "26-35"), (45, "36-45"), (60, "46-60"), (None, "60+")]
    assert [limit for limit, _ in staging.INCOME_BANDS] == [5500, 13500, 23500, 32500, 56000, None]
    assert labels.SEGMENTS == ["Champions", "Loyal High Value", "Steady Mid-Tier", "At Risk", "Dormant"]
    assert [x for x, _ in labels.CHURN_LEVELS] == [0.8, 0.6, 0.4, 0.2, None]
    assert [n for _, n in labels.CHURN_LEVELS] == ["Critical", "High", "Medium", "Low", "Stable"]
    assert labels.CLV_TIERS == ["Platinum", "Gold", "Silver", "Bronze", "Basic"]
    assert labels.MOMENTUM == [(0.2, "Accelerating"), (-0.05, "Steady"), (-0.3, "Slowing"), (None, "Declining")]
    assert labels.HEALTH == [(0.1, "Growing"), (-0.05, "Stable"), (-0.15, "Slowing"), (None, "Declining")]
    assert labels.PROPENSITY == [(60, "Very High"), (40, "High"), (20, "Medium"), (10, "Low"), (None, "Very Low")]
    assert [x for x, _ in labels.WALLET_BANDS] == [80, 50, 20, None]


def test_audience_rules():
    assert {a: rule[1:] for a, rule in labels.LIFESTYLE.items()} == {
        "L01": (0.4, 5000.0),
        "L02": (0.25, 3000.0),
        "L03": (0.3, 5000.0),
        "L04": (0.15, 2000.0),
        "L05": (0.2, 3000.0),
        "L06": (0.2, 2000.0),
        "L07": (0.15, 3000.0),
    }
    assert labels.SEASONAL == {"S01": (11, 2.0, 1000.0), "S02": (12, 1.5, 1000.0), "S03": (1, 1.5, 500.0)}
    assert labels.PROVINCE_AUDIENCES == {"G01": "GAUTENG", "G02": "WESTERN CAPE", "G03": "KWAZULU-NATAL", "G04": "EASTERN CAPE"}
    assert labels.PREMIUM_CATEGORIES == ["Clothing & Apparel", "Travel", "Restaurants", "Health", "Electronics"]
    assert len(labels.AUDIENCES) == 31 and sorted({t for _, t, _ in labels.AUDIENCES.values()}) == [
        "Behavioral",
        "Cross-category",
        "Demographic",
        "Geographic",
        "Lifestyle",
        "Seasonal",
    ]


def test_production_parameters():
    p = Params()
    assert (p.window_months, p.min_feature_txns, p.min_model_txns, p.segments, p.quantiles) == (12, 2, 3, 5, 5)
    assert (p.churn_outcome_months, p.churn_early_months, p.clv_future_months, p.clv_observation_start) == (3, 6, 6, 18)
    assert (p.clv_cap_percentile, p.kmeans_iterations, p.model_iterations) == (0.99, 20, 50)
    assert (p.min_shared_customers, p.min_store_customers, p.min_store_txns, p.min_client_customers) == (100, 100, 1000, 1000)
    assert (p.min_audience_size, p.min_momentum_months, p.max_adoption_pct, p.frequent_txns) == (1000, 3, 90.0, 500)
    assert ml.CHURN_FEATURES[-5:] == ["pct_evening", "txn_trend", "age", "estimated_income", "main_banked"]


def test_long_texts_have_not_changed():
    texts = [labels.SEGMENT_TEXTS, labels.PITCH_ACTIONS, labels.AUDIENCES]
    digests = [hashlib.sha256(repr(sorted(t.items())).encode()).hexdigest()[:12] for t in texts]
    assert digests == DIGESTS


DIGESTS = ["c421dc0c86ea", "a4d38307fa0f", "f8d877318558"]
