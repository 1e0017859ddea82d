"""All thresholds in one frozen object; the defaults are the production values."""

from dataclasses import dataclass


@dataclass(frozen=True)
class Params:
    window_months: int = 12
    min_feature_txns: int = 2
    min_model_txns: int = 3
    churn_outcome_months: int = 3
    churn_early_months: int = 6
    clv_future_months: int = 6
    clv_observation_start: int = 18
    trend_recent_months: int = 3
    trend_early_months: int = 9
    segments: int = 5
    quantiles: int = 5
    kmeans_iterations: int = 20
    model_iterations: int = 50
    seed: int = 42
    clv_cap_percentile: float = 0.99
    median_accuracy: int = 10_000
    quartile_accuracy: int = 100_000
    retention_horizon: int = 12
    min_shared_customers: int = 100
    min_store_customers: int = 100
    min_store_txns: int = 1000
    min_client_customers: int = 1000
    min_audience_size: int = 1000
    min_momentum_months: int = 3
    max_adoption_pct: float = 90.0
    frequent_txns: int = 500
    min_cohort_size: int = 1000
    min_breakdown_customers: int = 50
    seasonal_months: int = 14
    customer_buckets: int = 400


# The test tables hold about a hundred stores and a thousand customers, so the
# size floors and the number of buckets are lowered there; every other value stays at its default.
SMALL_DATA = Params(
    min_shared_customers=20,
    min_client_customers=10,
    min_audience_size=20,
    min_store_customers=10,
    min_store_txns=10,
    frequent_txns=15,
    min_cohort_size=10,
    min_breakdown_customers=10,
    customer_buckets=8,
)
