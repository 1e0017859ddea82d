"""Presentation tables over the marts."""

from pyspark.sql import functions as F

from spendgrid.functions.bands import lookup_text
from spendgrid.functions.dialect import (
    count_where,
    exact_avg,
    exact_sum,
    null_safe_join,
    pct,
    ratio,
    ratio_avg,
    round_half,
    share_of_total,
    top_value,
)
from spendgrid.functions.labels import AT_RISK, SEGMENTS


def _one_row(spark, **parts):
    """One-row frames side by side, as scalar subqueries."""
    return spark.range(1, numPartitions=1).select(*[df.scalar().alias(name) for name, df in parts.items()])


def _rows(df):
    return df.agg(F.count("*"))


def executive_summary(spark, customers, txns, segments, benchmarks, churn):
    champions = segments.where(F.col("segment_name") == SEGMENTS[0])
    at_risk = churn.where(F.col("churn_risk_level").isin(AT_RISK))
    return _one_row(
        spark,
        total_customers=_rows(customers),
        total_transactions=_rows(txns),
        total_spend=segments.agg(exact_sum("val_trns")),
        total_destinations=benchmarks.agg(F.count_distinct("DESTINATION")),
        champion_customers=_rows(champions),
        champion_spend=champions.agg(round_half(exact_sum("val_trns"), 0)),
        at_risk_customers=_rows(at_risk),
        at_risk_spend=at_risk.agg(round_half(exact_sum("total_spend"), 0)),
    )


def dashboard_overview(spark, customers, txns, segments, benchmarks, churn):
    return _one_row(
        spark,
        total_transactions=_rows(txns),
        total_customers=_rows(customers),
        segmented_customers=_rows(segments),
        churn_scored=_rows(churn),
        destinations=benchmarks.agg(F.count_distinct("DESTINATION")),
    )


def customer_segments(segments):
    return (
        segments.groupBy("segment_name")
        .agg(
            F.count("*").alias("customers"),
            exact_sum("val_trns").alias("_spend"),
            round_half(exact_avg("val_trns"), 0).alias("avg_spend"),
            round_half(exact_avg("nr_trns"), 0).alias("avg_transactions"),
            round_half(exact_avg("lst_trns_days"), 0).alias("avg_recency_days"),
            round_half(exact_avg("active_destinations"), 1).alias("avg_merchants"),
            round_half(exact_avg("active_months"), 1).alias("avg_active_months"),
        )
        .withColumn("pct_customers", share_of_total("customers"))
        .withColumn("pct_revenue", share_of_total("_spend"))
        .withColumn("total_spend", round_half("_spend", 0))
        .drop("_spend")
    )


def churn_risk_summary(churn):
    return (
        churn.groupBy("churn_risk_level")
        .agg(
            F.count("*").alias("customers"),
            round_half(exact_avg("churn_probability") * F.lit(100.0), 1).alias("avg_churn_pct"),
            round_half(exact_sum("total_spend"), 0).alias("total_spend_at_risk"),
            round_half(exact_avg("total_spend"), 0).alias("avg_spend"),
            round_half(exact_avg("days_since_last"), 0).alias("avg_days_since_last"),
            round_half(exact_avg("txns_last_3m"), 1).alias("avg_recent_txns"),
        )
        .withColumn("pct_of_total", share_of_total("customers"))
    )


def geo_insights(geo):
    return geo.withColumn("pct_of_category", share_of_total("total_spend", by=["CATEGORY_TWO"]))


def dashboard_segments(segments, summary):
    """Segment card with texts; demographics come with the segment table."""
    stats = segments.groupBy("segment_name").agg(
        F.count("*").alias("customers"),
        round_half(exact_avg("val_trns"), 0).alias("avg_spend"),
        round_half(exact_avg("nr_trns"), 0).alias("avg_txns"),
        round_half(exact_avg("lst_trns_days"), 0).alias("avg_recency_days"),
        round_half(exact_avg("active_destinations"), 1).alias("avg_merchants"),
        round_half(exact_avg("active_months"), 1).alias("avg_active_months"),
        round_half(
            ratio_avg(
                ratio(F.col("NR_TRNS_WEEKEND") * F.lit(100.0), F.col("NR_TRNS_WEEKEND") + F.col("NR_TRNS_WEEK"))
            ),
            1,
        ).alias("pct_weekend"),
        round_half(exact_avg("age"), 1).alias("avg_age"),
        round_half(exact_avg("estimated_income"), 0).alias("avg_income"),
        pct(count_where(F.col("gender_label") == "Female"), F.count("*")).alias("pct_female"),
    )
    cube = segments.groupBy("segment_name", "age_group", "income_group").agg(F.count("*").alias("n"))
    texts = summary.select("segment_name", "business_description", "recommended_action")
    for part in (
        top_value(cube, ["segment_name"], "age_group"),
        top_value(cube, ["segment_name"], "income_group"),
        texts,
    ):
        stats = null_safe_join(stats, part, ["segment_name"])
    return stats


def dashboard_churn(churn, segments, explained, clv, momentum):
    """One row per scored customer; every side is unique per customer, so the joins
    share one partitioning by customer."""
    return (
        churn.select(
            "UNIQUE_ID",
            "churn_risk_level",
            "churn_probability",
            "total_spend",
            "days_since_last",
            "age",
            "age_group",
            "gender_label",
            "income_group",
        )
        .join(segments.select("UNIQUE_ID", "segment_name"), "UNIQUE_ID", "left")
        .join(explained.select("UNIQUE_ID", "reason_1", "reason_2", "reason_3"), "UNIQUE_ID", "left")
        .join(clv.select("UNIQUE_ID", "clv_tier", "predicted_clv", "historical_spend"), "UNIQUE_ID", "left")
        .join(
            momentum.select("UNIQUE_ID", "momentum_status", "spend_change_pct", "urgency_score"), "UNIQUE_ID", "left"
        )
    )


_LOYALTY = [
    "avg_loyalty_pct",
    "pct_loyal_50",
    "pct_loyal_80",
    "band_1_store",
    "band_2_stores",
    "band_3_4_stores",
    "band_5_7_stores",
    "band_8_plus",
]
_TIME = [
    "pct_early_morning",
    "pct_mid_morning",
    "pct_afternoon",
    "pct_late_afternoon",
    "pct_evening",
    "pct_weekend",
    "pct_weekday",
    "peak_hour",
    "peak_day_number",
    "pct_sunday",
    "pct_monday",
    "pct_tuesday",
    "pct_wednesday",
    "pct_thursday",
    "pct_friday",
    "pct_saturday",
]


def client_pitch_flat(benchmarks, loyalty, time_patterns):
    keys = ["CATEGORY_TWO", "DESTINATION"]
    return (
        benchmarks.drop("transactions")
        .join(loyalty.select(*keys, *_LOYALTY), keys, "left")
        .join(time_patterns.select(*keys, *_TIME), keys, "left")
    )


def client_segment_view(mix, summary):
    texts = summary.select("segment_name", "business_description", "recommended_action")
    order = {name: i + 1 for i, name in enumerate(SEGMENTS)}
    return mix.join(texts, "segment_name", "left").withColumn(
        "segment_order", lookup_text(F.col("segment_name"), order, len(SEGMENTS) + 1).cast("bigint")
    )


_PITCH = [
    "CATEGORY_TWO",
    "DESTINATION",
    "customers",
    "total_spend",
    "market_share_pct",
    "penetration_pct",
    "avg_txn_value",
    "spend_per_customer",
    "avg_share_of_wallet",
    "spend_rank",
    "transactions",
]


def pitch_internal(benchmarks):
    return benchmarks.select(*_PITCH, F.col("DESTINATION").alias("display_name"), F.lit("internal").alias("view_mode"))


def pitch_external(benchmarks):
    """Names replaced by the rank, for showing to other merchants."""
    rank = F.col("spend_rank").cast("string")
    masked = F.when(
        F.col("spend_rank") == 1, F.concat(F.lit("Market Leader (#"), rank, F.lit(")"))
    ).otherwise(F.concat(F.lit("Competitor #"), rank))
    return benchmarks.select(*_PITCH, masked.alias("display_name"), F.lit("external").alias("view_mode"))


# Presentation name -> table.
VIEW_TABLES = {
    "v_spend_share": "benchmarks",
    "v_demographics": "demographic_summary",
    "v_monthly_trends": "monthly_trends",
    "v_churn_detail": "churn",
    "v_behavioral": "behavioral_summary",
    "v_cluster_profiles": "cluster_profiles",
    "v_cohort_retention": "cohort_retention",
    "v_category_affinity": "category_affinity",
    "v_category_scorecard": "category_scorecard",
    "v_pitch_opportunities": "pitch_opportunities",
    "v_spend_momentum": "momentum",
    "v_churn_explained": "churn_explained",
    "v_category_propensity": "category_propensity",
    "v_customer_clv": "clv",
    "v_cluster_summary": "cluster_summary",
    "v_audience_catalog": "audience_catalog",
    "v_audience_client_overlap": "audience_client_overlap",
}


def register_views(warehouse, names=tuple(VIEW_TABLES)):
    """Session temp views for the plain tables, by presentation name; only the named ones are built."""
    for view in names:
        warehouse.table(VIEW_TABLES[view]).createOrReplaceTempView(view)
    return sorted(names)
