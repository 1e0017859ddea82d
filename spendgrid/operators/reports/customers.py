"""Segments, churn, retention and lifetime value."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from spendgrid.functions.bands import at_least, position_in
from spendgrid.functions.dialect import exact_avg, exact_sum, ratio, round_half, share_of_total
from spendgrid.functions.labels import AT_RISK, CHURN_LEVELS
from spendgrid.operators.reports.common import is_value, mean_pct

# --- segments and churn --------------------------------------------------------


def segment_radar(profiles):
    """Segment means as an index of the best segment."""
    everything = Window.partitionBy()

    def index(column):
        return ratio(column, F.max(column).over(everything))

    return profiles.select(
        "segment_name",
        round_half(index("avg_total_spend") * F.lit(100.0), 0).alias("spend_index"),
        round_half(index("avg_transactions") * F.lit(100.0), 0).alias("frequency_index"),
        round_half((F.lit(1.0) - index("avg_recency_days")) * F.lit(100.0), 0).alias("recency_index"),
        round_half(index("avg_merchants") * F.lit(100.0), 0).alias("diversity_index"),
        round_half(index("avg_active_months") * F.lit(100.0), 0).alias("consistency_index"),
    )


def revenue_concentration(segments):
    return (
        segments.groupBy("segment_name")
        .agg(F.count("*").alias("customers"), exact_sum("val_trns").alias("_spend"))
        .select(
            "segment_name",
            "customers",
            share_of_total("customers").alias("pct_customers"),
            round_half("_spend", 0).alias("total_spend"),
            share_of_total("_spend").alias("pct_revenue"),
        )
    )


def probability_bands(churn):
    """Customers per tenth of the churn probability."""
    table = [(i / 10, f"{i * 10}-{i * 10 + 10}%") for i in range(9, 0, -1)] + [(None, "0-10%")]
    return churn.groupBy(at_least(F.col("churn_probability"), table).alias("probability_band")).agg(
        F.count("*").alias("customers")
    )


def risk_by_demographics(churn):
    return (
        churn.dropna(subset=["age_group", "income_group"])
        .groupBy("age_group", "income_group", "churn_risk_level")
        .agg(
            F.count("*").alias("customers"),
            mean_pct().alias("avg_churn_pct"),
            round_half(exact_sum("total_spend"), 0).alias("total_spend"),
        )
    )


def churn_levels(churn):
    """Customers, spend and inactivity per level, from the highest risk down."""
    levels = [name for _, name in CHURN_LEVELS]
    return (
        churn.groupBy("churn_risk_level")
        .agg(
            F.count("*").alias("customers"),
            mean_pct().alias("avg_churn_pct"),
            round_half(exact_sum("total_spend"), 0).alias("spend"),
            round_half(exact_avg("days_since_last"), 0).alias("avg_days"),
        )
        .withColumn("level_order", position_in(F.col("churn_risk_level"), levels).cast("bigint"))
        .orderBy("level_order")
    )


def win_back(churn):
    """At-risk customers who spend more than the average scored customer."""
    mean = churn.agg(exact_avg("total_spend"))
    return (
        churn.where(F.col("churn_risk_level").isin(AT_RISK) & (F.col("total_spend") > mean.scalar()))
        .groupBy("churn_risk_level")
        .agg(
            F.count("*").alias("customers"),
            round_half(exact_avg("total_spend"), 0).alias("avg_spend"),
            round_half(exact_sum("total_spend"), 0).alias("total_spend_at_risk"),
            mean_pct().alias("avg_churn_pct"),
        )
    )


def churn_reasons(explained, n=None):
    reasons = explained.groupBy(F.col("reason_1").alias("reason")).agg(
        F.count("*").alias("customers"),
        mean_pct().alias("avg_churn_pct"),
        round_half(exact_sum("total_spend"), 0).alias("spend"),
    )
    return reasons if n is None else reasons.orderBy(F.desc("customers"), "reason").limit(n)


def at_risk_profile(explained):
    return explained.agg(
        F.count("*").alias("total_at_risk"),
        mean_pct().alias("avg_churn_pct"),
        round_half(exact_avg("total_spend"), 0).alias("avg_spend"),
        round_half(exact_sum("total_spend"), 0).alias("total_spend_at_risk"),
        round_half(exact_avg("days_since_last"), 0).alias("avg_days_inactive"),
        round_half(exact_avg("txns_last_3m"), 1).alias("avg_recent_txns"),
        round_half(exact_avg("txns_prev_3m"), 1).alias("avg_prior_txns"),
    )


def churn_samples(explained, n=10):
    """Largest customers at critical risk with their reasons."""
    return (
        explained.where(is_value("churn_risk_level", "Critical"))
        .orderBy(F.desc("total_spend"), "UNIQUE_ID")
        .limit(n)
        .select(
            "churn_risk_level",
            round_half(F.col("churn_probability") * F.lit(100.0), 1).alias("churn_pct"),
            round_half("total_spend", 0).alias("total_spend"),
            "days_since_last",
            "reason_1",
            "reason_2",
            "reason_3",
        )
    )


def momentum_mix(momentum, statuses=None):
    rows = momentum if statuses is None else momentum.where(F.col("momentum_status").isin(statuses))
    return rows.groupBy("momentum_status").agg(
        F.count("*").alias("customers"),
        round_half(exact_avg("total_spend_12m"), 0).alias("avg_spend"),
        round_half(exact_avg("spend_change_pct"), 1).alias("avg_spend_change"),
        round_half(exact_avg("urgency_score"), 2).alias("avg_urgency"),
        round_half(exact_sum("total_spend_12m"), 0).alias("total_spend"),
    )


def churn_by(churn, other, key):
    """Mean churn and customers per value of another customer table's column."""
    return (
        other.select("UNIQUE_ID", key)
        .join(churn.select("UNIQUE_ID", "churn_probability"), "UNIQUE_ID")
        .groupBy(key)
        .agg(mean_pct().alias("avg_churn_pct"), F.count("*").alias("customers"))
    )


# --- retention -----------------------------------------------------------------


def retention_pivot(cohorts, min_size=1000, horizon=12):
    """Cohorts as rows, months since the first purchase as columns."""
    return (
        cohorts.where(F.col("cohort_size") >= min_size)
        .groupBy(F.date_format("cohort_month", "yyyy-MM").alias("cohort"))
        .pivot("months_since_first", list(range(horizon + 1)))
        .agg(F.max("retention_pct"))
        .withColumnsRenamed({str(i): f"m{i}" for i in range(horizon + 1)})
    )


def retention_milestones(cohorts, min_size=1000, months=(1, 3, 6, 12)):
    return (
        cohorts.where((F.col("cohort_size") >= min_size) & F.col("months_since_first").isin(list(months)))
        .groupBy(F.col("months_since_first").alias("months"))
        .agg(round_half(exact_avg("retention_pct"), 2).alias("avg_retention_pct"))
    )


def retention_curve(cohorts, min_size=1000):
    return (
        cohorts.where((F.col("cohort_size") >= min_size) & F.col("months_since_first").between(0, 12))
        .groupBy("months_since_first")
        .agg(round_half(exact_avg("retention_pct"), 1).alias("ret"))
    )


def recent_cohorts(cohorts, min_size=1000, n=6):
    """Retention of the n newest cohorts."""
    large = cohorts.where(F.col("cohort_size") >= min_size)
    newest = large.select("cohort_month").distinct().orderBy(F.desc("cohort_month")).limit(n)
    return large.join(newest, "cohort_month", "left_semi").select(
        F.date_format("cohort_month", "yyyy-MM").alias("cohort"), "months_since_first", "retention_pct"
    )


def cohort_sizes(cohorts, min_size=1000):
    """New customers per month."""
    return cohorts.where((F.col("cohort_size") >= min_size) & (F.col("months_since_first") == 0)).select(
        F.date_format("cohort_month", "yyyy-MM").alias("cohort"), "cohort_size"
    )


def best_and_worst_cohorts(cohorts, min_size=1000, at_month=6, n=5):
    """The n best and n worst cohorts at one age."""
    rows = cohorts.where((F.col("cohort_size") >= min_size) & (F.col("months_since_first") == at_month)).select(
        F.date_format("cohort_month", "yyyy-MM").alias("cohort"), "cohort_size", "retention_pct"
    )
    best = rows.orderBy(F.desc("retention_pct"), "cohort").limit(n).withColumn("rank_group", F.lit("best"))
    worst = rows.orderBy("retention_pct", F.desc("cohort")).limit(n).withColumn("rank_group", F.lit("worst"))
    return best.unionByName(worst)


# --- lifetime value ------------------------------------------------------------


def clv_by_tier(clv):
    return clv.groupBy("clv_tier").agg(
        F.count("*").alias("customers"),
        round_half(exact_avg("predicted_clv"), 0).alias("avg_clv"),
        round_half(exact_sum("predicted_clv"), 0).alias("total_projected_value"),
        round_half(exact_avg("historical_spend"), 0).alias("avg_historical"),
    )


def clv_by_segment(clv, segments):
    return (
        segments.select("UNIQUE_ID", "segment_name")
        .join(clv.select("UNIQUE_ID", "predicted_clv"), "UNIQUE_ID")
        .groupBy("segment_name")
        .agg(
            F.count("*").alias("customers"),
            round_half(exact_avg("predicted_clv"), 0).alias("avg_clv"),
            exact_sum("predicted_clv").alias("_total"),
        )
        .select(
            "segment_name",
            "customers",
            "avg_clv",
            round_half("_total", 0).alias("total_clv"),
            share_of_total("_total").alias("pct_of_total_value"),
        )
    )


def clv_by_band(clv, band):
    return (
        clv.dropna(subset=[band])
        .groupBy(band)
        .agg(F.count("*").alias("customers"), round_half(exact_avg("predicted_clv"), 0).alias("avg_clv"))
    )


def value_at_risk(clv, churn):
    return (
        clv.where(F.col("clv_tier").isin("Platinum", "Gold"))
        .select("UNIQUE_ID", "clv_tier", "predicted_clv")
        .join(
            churn.where(F.col("churn_risk_level").isin(AT_RISK)).select("UNIQUE_ID", "churn_risk_level"), "UNIQUE_ID"
        )
        .groupBy("clv_tier", "churn_risk_level")
        .agg(
            F.count("*").alias("customers"),
            round_half(exact_sum("predicted_clv"), 0).alias("projected_value_at_risk"),
        )
    )
