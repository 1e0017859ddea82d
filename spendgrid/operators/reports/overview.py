"""Row counts, profiles and feature statistics."""

from pyspark.sql import functions as F

from spendgrid.functions.dialect import (
    count_where,
    exact_avg,
    exact_sum,
    month_span,
    month_start,
    pct,
    ratio,
    round_half,
    spread,
)
from spendgrid.operators.reports.common import is_value
from spendgrid.operators.staging import UNKNOWN, last_months

# The features that segments are built on, and the compared pairs below.
FEATURES = [
    "val_trns",
    "nr_trns",
    "lst_trns_days",
    "avg_val",
    "active_months",
    "active_destinations",
    "active_nav_categories",
    "NR_TRNS_WEEKEND",
    "NR_TRNS_WEEK",
]

# --- overview of the raw and staged data ---------------------------------------


def data_overview(txns):
    """One row of totals; names are counted on rows reduced to distinct names."""
    spend, n = exact_sum("spend"), F.sum("n")
    reduced = txns.groupBy("CATEGORY_TWO", "DESTINATION", "PROVINCE").agg(
        F.count("*").alias("n"),
        exact_sum("trns_amt").alias("spend"),
        F.min("EFF_DATE").alias("first"),
        F.max("EFF_DATE").alias("last"),
    )
    first, last = F.min("first"), F.max("last")
    return reduced.agg(
        n.alias("total_transactions"),
        first.alias("earliest_date"),
        last.alias("latest_date"),
        month_span(last, first).cast("bigint").alias("months_of_data"),
        round_half(spend, 0).alias("total_spend"),
        round_half(ratio(spend, n), 2).alias("avg_transaction"),
        F.count_distinct("CATEGORY_TWO").alias("distinct_categories"),
        F.count_distinct("DESTINATION").alias("distinct_destinations"),
        F.count_distinct("PROVINCE").alias("distinct_provinces"),
    ).withColumn("unique_customers", txns.agg(F.count_distinct("UNIQUE_ID")).scalar())


def top_categories(txns, n=20):
    return (
        txns.dropna(subset=["CATEGORY_TWO"])
        .groupBy("CATEGORY_TWO")
        .agg(
            F.count("*").alias("transactions"),
            F.count_distinct("UNIQUE_ID").alias("customers"),
            round_half(exact_sum("trns_amt"), 0).alias("total_spend"),
            round_half(exact_avg("trns_amt"), 2).alias("avg_txn"),
        )
        .orderBy(F.desc("total_spend"), "CATEGORY_TWO")
        .limit(n)
    )


def top_destinations(txns, n=20):
    return (
        txns.dropna(subset=["DESTINATION"])
        .groupBy("DESTINATION", "CATEGORY_TWO")
        .agg(
            F.count_distinct("UNIQUE_ID").alias("customers"),
            round_half(exact_sum("trns_amt"), 0).alias("total_spend"),
            round_half(exact_avg("trns_amt"), 2).alias("avg_txn"),
        )
        .orderBy(F.desc("total_spend"), "DESTINATION", "CATEGORY_TWO")
        .limit(n)
    )


def customer_profile(customers):
    return customers.agg(
        F.count("*").alias("total_customers"),
        round_half(exact_avg("age"), 1).alias("avg_age"),
        round_half(exact_avg("estimated_income"), 0).alias("avg_income"),
        count_where(is_value("gender", 0)).alias("males"),
        count_where(is_value("gender", 1)).alias("females"),
        count_where(is_value("main_banked", 1)).alias("main_banked"),
        count_where(F.col("age").isNull()).alias("null_age"),
        count_where(F.col("estimated_income").isNull()).alias("null_income"),
    )


def value_counts(customers, column):
    """Customers per value, unknown ones included."""
    return customers.groupBy(column).agg(F.count("*").alias("customers"))


def income_range(customers):
    """Smallest, largest and mean income of customers that have one."""
    income = F.col("estimated_income")
    return customers.where(income > 0).agg(F.min(income).alias("min_inc"), F.max(income).alias("max_inc"), round_half(exact_avg(income), 0).alias("avg_inc"))


def band_distribution(customers, band):
    return customers.where(F.col(band) != UNKNOWN).groupBy(band).agg(F.count("*").alias("customers"))


def null_profile(df, columns):
    """Rows, NULL count and NULL share per column, from one pass."""
    counts = df.agg(
        F.count("*").alias("total_rows"), *[count_where(F.col(c).isNull()).alias(c) for c in columns]
    )
    return counts.unpivot("total_rows", columns, "column_name", "null_count").withColumn(
        "null_pct", pct("null_count", "total_rows", 2)
    )


def monthly_volume(txns):
    return txns.groupBy(month_start("EFF_DATE").alias("month")).agg(
        F.count("*").alias("transactions"),
        F.count_distinct("UNIQUE_ID").alias("customers"),
        round_half(exact_sum("trns_amt"), 0).alias("spend"),
    )


def analysis_window(txns, as_of, months=12):
    """First and last day of the analysis window, also as display text."""
    text = "dd MMM yyyy"
    first, last = F.min("EFF_DATE"), F.max("EFF_DATE")
    return last_months(txns, as_of, months).agg(
        first.alias("data_from"),
        last.alias("data_to"),
        F.datediff(last, first).cast("bigint").alias("days_span"),
        F.date_format(first, text).alias("from_str"),
        F.date_format(last, text).alias("to_str"),
        F.date_format(F.add_months(last, -months), text).alias("analysis_from_str"),
    )


# --- feature statistics --------------------------------------------------------


def feature_stats(features, columns=FEATURES, accuracy=100_000):
    """Mean, spread, extremes and quartiles per feature, from one unpivot."""
    # every feature has at most two decimals
    long = features.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        [], columns, "feature", "value"
    )
    quartiles = F.percentile_approx("value", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), accuracy)
    return (
        long.groupBy("feature")
        .agg(
            round_half(exact_avg("value"), 2).alias("mean"),
            round_half(spread("value"), 2).alias("std"),
            round_half(F.min("value"), 2).alias("min_val"),
            round_half(F.max("value"), 2).alias("max_val"),
            quartiles.alias("q"),
        )
        .select(
            "feature",
            "mean",
            "std",
            F.col("q")[1].alias("median"),
            "min_val",
            "max_val",
            round_half(F.col("q")[0], 2).alias("q25"),
            round_half(F.col("q")[2], 2).alias("q75"),
            round_half(F.col("q")[2] - F.col("q")[0], 2).alias("iqr"),
        )
    )


CORRELATIONS = {
    "spend_vs_freq": ("val_trns", "nr_trns"),
    "spend_vs_recency": ("val_trns", "lst_trns_days"),
    "spend_vs_avg_txn": ("val_trns", "avg_val"),
    "spend_vs_merchants": ("val_trns", "active_destinations"),
    "freq_vs_merchants": ("nr_trns", "active_destinations"),
    "freq_vs_recency": ("nr_trns", "lst_trns_days"),
    "weekend_vs_weekday": ("NR_TRNS_WEEKEND", "NR_TRNS_WEEK"),
    "months_vs_freq": ("active_months", "nr_trns"),
}


def feature_correlations(features):
    return features.agg(*[round_half(F.corr(a, b), 3).alias(name) for name, (a, b) in CORRELATIONS.items()])


def outlier_counts(features, sigmas=3.0):
    """Customers beyond mean + 3 standard deviations; the limits are one row."""
    columns = {"val_trns": "spend_outliers", "nr_trns": "freq_outliers", "avg_val": "avg_val_outliers"}
    limits = features.agg(
        *[(exact_avg(c) + F.lit(sigmas) * spread(c)).alias(c) for c in columns]
    ).first()
    return features.agg(
        F.count("*").alias("total_customers"),
        *[count_where(F.col(c) > F.lit(limits[c])).alias(name) for c, name in columns.items()],
    )


def quintile_distribution(scores):
    dimensions = {"r_score": "Recency", "f_score": "Frequency", "m_score": "Monetary"}
    renamed = scores.select(*[F.col(c).alias(name) for c, name in dimensions.items()])
    return (
        renamed.unpivot([], list(dimensions.values()), "dimension", "score")
        .groupBy("dimension", "score")
        .agg(F.count("*").alias("customers"))
    )


def sample_rows(df, n, seed=42, columns=FEATURES, key="UNIQUE_ID"):
    """Exactly n rows (all, if fewer), every row as likely as any other: the smallest hashes of seed and key.

    A top-n plan: each task keeps n rows, none are sorted globally.
    """
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    return df.orderBy(digest, key).limit(n).select(*columns)
