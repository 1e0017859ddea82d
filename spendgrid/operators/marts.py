"""Reusable summary tables built from the staged and feature tables."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from spendgrid.functions.bands import above, at_least, lookup_text
from spendgrid.functions.dialect import (
    count_where,
    distinct_months,
    exact_avg,
    exact_sum,
    exact_sum_over,
    month_number,
    month_start,
    months_before,
    null_safe_join,
    pct,
    pick_mode,
    plain_number,
    ratio,
    round_half,
    share_of_total,
    strict_greatest,
    strict_least,
    sum_where,
    top_value,
    totals_within,
    weigh_modes,
)
from spendgrid.functions.labels import (
    AT_RISK,
    HEALTH,
    MOMENTUM,
    PITCH_ACTIONS,
    PROPENSITY,
    SEGMENT_TEXTS,
)
from spendgrid.functions.ordering import exclusive_rank
from spendgrid.operators.features import category_customers
from spendgrid.operators.staging import last_months

# --- segments ---------------------------------------------------------------


def cluster_profiles(segments):
    """Averages, ranges and demographic counts per segment."""
    keys = ["segment_name", "cluster_id"]
    age = F.col("age")
    stats = segments.groupBy(*keys).agg(
        F.count("*").alias("customer_count"),
        round_half(exact_avg("val_trns"), 2).alias("avg_total_spend"),
        round_half(F.min("val_trns"), 2).alias("min_total_spend"),
        round_half(F.max("val_trns"), 2).alias("max_total_spend"),
        round_half(exact_sum("val_trns"), 0).alias("total_segment_spend"),
        round_half(exact_avg("nr_trns"), 1).alias("avg_transactions"),
        round_half(exact_avg("mnthly_avg_nr"), 1).alias("avg_monthly_txns"),
        round_half(exact_avg("lst_trns_days"), 1).alias("avg_recency_days"),
        round_half(exact_avg("days_between"), 1).alias("avg_days_between_txns"),
        round_half(exact_avg("avg_val"), 2).alias("avg_txn_value"),
        round_half(exact_avg("active_destinations"), 1).alias("avg_merchants"),
        round_half(exact_avg("active_nav_categories"), 1).alias("avg_categories"),
        round_half(exact_avg("active_months"), 1).alias("avg_active_months"),
        round_half(exact_avg("NR_TRNS_WEEKEND"), 1).alias("avg_weekend_txns"),
        round_half(exact_avg("NR_TRNS_WEEK"), 1).alias("avg_weekday_txns"),
        round_half(exact_avg("age"), 1).alias("avg_age"),
        round_half(exact_avg("estimated_income"), 0).alias("avg_income"),
        count_where(age.between(18, 25)).alias("age_18_25"),
        count_where(age.between(26, 35)).alias("age_26_35"),
        count_where(age.between(36, 45)).alias("age_36_45"),
        count_where(age.between(46, 60)).alias("age_46_60"),
        count_where(age > 60).alias("age_over_60"),
        count_where(F.col("gender") == 0).alias("male_count"),
        count_where(F.col("gender") == 1).alias("female_count"),
    )
    bands = segments.groupBy(*keys, "age_group", "income_group").agg(F.count("*").alias("n"))
    return null_safe_join(
        null_safe_join(
            stats.withColumn("pct_of_total", share_of_total("customer_count")),
            top_value(bands, keys, "age_group"),
            keys,
        ),
        top_value(bands, keys, "income_group"),
        keys,
    )


SUMMARY_COLUMNS = [
    "segment_name",
    "cluster_id",
    "customer_count",
    "pct_of_total",
    "avg_total_spend",
    "total_segment_spend",
    "avg_transactions",
    "avg_recency_days",
    "avg_txn_value",
    "avg_merchants",
    "avg_categories",
    "avg_age",
    "avg_income",
    "top_age_group",
    "top_income_group",
]


def cluster_summary(profiles):
    name = F.col("segment_name")
    return profiles.select(
        *SUMMARY_COLUMNS,
        lookup_text(name, {k: t[0] for k, t in SEGMENT_TEXTS.items()}).alias("business_description"),
        lookup_text(name, {k: t[1] for k, t in SEGMENT_TEXTS.items()}).alias("recommended_action"),
    )


def behavioral_summary(txns, segments):
    """Time-of-day mix per segment over the whole history; unknown hours are late night."""
    hour = F.col("trns_hour")
    per_customer = txns.groupBy("UNIQUE_ID").agg(
        count_where(hour.between(6, 10)).alias("morning"),
        count_where(hour.between(11, 16)).alias("afternoon"),
        count_where(hour.between(17, 21)).alias("evening"),
        F.count("*").alias("total"),
    )
    members = segments.select(
        "UNIQUE_ID",
        "segment_name",
        "NR_TRNS_WEEKEND",
        "NR_TRNS_WEEK",
        "active_nav_categories",
        "active_destinations",
        "avg_val",
    )
    total = F.sum("total")
    late = total - F.sum("morning") - F.sum("afternoon") - F.sum("evening")
    return (
        members.join(per_customer, "UNIQUE_ID")
        .groupBy("segment_name")
        .agg(
            F.count("*").alias("customers"),
            pct(F.sum("morning"), total).alias("pct_morning"),
            pct(F.sum("afternoon"), total).alias("pct_afternoon"),
            pct(F.sum("evening"), total).alias("pct_evening"),
            pct(late, total).alias("pct_late_night"),
            pct(F.sum("NR_TRNS_WEEKEND"), F.sum(F.col("NR_TRNS_WEEKEND") + F.col("NR_TRNS_WEEK"))).alias("pct_weekend"),
            round_half(exact_avg("active_nav_categories"), 1).alias("avg_categories"),
            round_half(exact_avg("active_destinations"), 1).alias("avg_merchants"),
            round_half(exact_avg("avg_val"), 2).alias("avg_txn_value"),
            round_half(ratio(total, F.count("*")), 1).alias("avg_txns_per_customer"),
        )
    )


# --- categories, places, months ---------------------------------------------


def customers_per(rows, keys, name):
    """Distinct customers per group, from rows reduced to one per group and customer before the shuffle."""
    return rows.select(*keys, "UNIQUE_ID").distinct().groupBy(*keys).agg(F.count("UNIQUE_ID").alias(name))


def geo_summary(txns):
    """Spend per province, municipality and category.

    Two narrow scans: totals per place, category and merchant shrink on the map side to a few
    rows a task, and customers are counted on three columns.
    """
    keys = ["PROVINCE", "MUNICIPALITY", "CATEGORY_TWO"]
    placed = txns.dropna(subset=["PROVINCE", "CATEGORY_TWO"])
    totals = (
        placed.groupBy(*keys, "DESTINATION")
        .agg(F.count("*").alias("n"), exact_sum("trns_amt").alias("spend"))
        .groupBy(*keys)
        .agg(
            F.sum("n").alias("transactions"),
            round_half(exact_sum("spend"), 0).alias("total_spend"),
            round_half(ratio(exact_sum("spend"), F.sum("n")), 2).alias("avg_txn"),
            F.count("DESTINATION").alias("distinct_merchants"),
        )
    )
    return null_safe_join(totals, customers_per(placed, keys, "customers"), keys)


def monthly_trends(txns):
    return (
        txns.dropna(subset=["CATEGORY_TWO", "DESTINATION"])
        .groupBy(month_start("EFF_DATE").alias("month"), "CATEGORY_TWO", "DESTINATION")
        .agg(
            F.count("*").alias("txn_count"),
            F.count_distinct("UNIQUE_ID").alias("customer_count"),
            round_half(exact_sum("trns_amt"), 0).alias("total_spend"),
            round_half(exact_avg("trns_amt"), 2).alias("avg_txn"),
        )
    )


DEMOGRAPHIC_KEYS = ["gender_label", "age_group", "income_group", "income_segment", "credit_risk_class"]


def demographic_summary(ccs, customers):
    """Category totals per demographic group; customers without a snapshot form a NULL group."""
    per_customer = ccs.groupBy("UNIQUE_ID", "CATEGORY_TWO").agg(
        F.sum("dest_txn_count").alias("txns"), exact_sum("dest_spend").alias("spend")
    )
    return (
        per_customer.join(customers.select("UNIQUE_ID", *DEMOGRAPHIC_KEYS), "UNIQUE_ID", "left")
        .groupBy("CATEGORY_TWO", *DEMOGRAPHIC_KEYS)
        .agg(
            F.count("*").alias("customers"),
            F.sum("txns").alias("total_txns"),
            round_half(exact_sum("spend"), 0).alias("total_spend"),
            round_half(exact_avg("spend"), 0).alias("avg_spend_per_customer"),
        )
    )


def destination_benchmarks(metrics):
    return metrics.where(F.col("total_spend") > 0)


def cohort_retention(txns, horizon=12):
    """Share of each first-month cohort active 0..horizon months later.

    One aggregation gathers the distinct months per customer (bounded by the months
    of history); cohorts and offsets follow from that set without a second pass.
    """
    month = month_number("EFF_DATE")
    per_customer = txns.groupBy("UNIQUE_ID").agg(
        F.min(month_start("EFF_DATE")).alias("cohort_month"), F.collect_set(month).alias("months")
    )
    first = month_number("cohort_month")
    active = (
        per_customer.select("cohort_month", F.explode("months").alias("month"))
        .select("cohort_month", (F.col("month") - first).cast("bigint").alias("months_since_first"))
        .where(F.col("months_since_first") <= horizon)
        .groupBy("cohort_month", "months_since_first")
        .agg(F.count("*").alias("active_customers"))
    )
    size = F.max(F.when(F.col("months_since_first") == 0, F.col("active_customers"))).over(
        Window.partitionBy("cohort_month")
    )
    return active.withColumn("cohort_size", size).withColumn("retention_pct", pct("active_customers", "cohort_size"))


def window_categories(txns, as_of, months):
    """Distinct categories per customer of the last months."""
    return last_months(txns, as_of, months).dropna(subset=["CATEGORY_TWO"]).select("UNIQUE_ID", "CATEGORY_TWO").distinct()


def category_affinity(txns, as_of, months=12, min_shared=100):
    """Lift and overlap of every pair of categories.

    Customers are first reduced to their set of categories and equal sets are
    counted, so pairs are formed once per distinct set instead of once per
    customer; a set is no longer than the category list.
    """
    sets = (
        last_months(txns, as_of, months)
        .dropna(subset=["CATEGORY_TWO"])
        .groupBy("UNIQUE_ID")
        .agg(F.array_sort(F.collect_set("CATEGORY_TWO")).alias("categories"))
        .groupBy("categories")
        .agg(F.count("*").alias("n"))
    )
    single = sets.select(F.explode("categories").alias("category"), "n").groupBy("category").agg(F.sum("n").alias("n"))
    later = F.slice("categories", F.col("i") + 2, F.greatest(F.size("categories") - F.col("i") - 1, F.lit(0)))
    pairs = (
        sets.select("categories", "n", F.posexplode("categories").alias("i", "category_a"))
        .select("category_a", F.explode(later).alias("category_b"), "n")
        .groupBy("category_a", "category_b")
        .agg(F.sum("n").alias("shared_customers"))
        .where(F.col("shared_customers") >= min_shared)
    )
    total = sets.agg(F.sum("n")).scalar()
    shared = F.col("shared_customers")
    in_a, in_b = F.col("customers_in_a"), F.col("customers_in_b")
    return (
        pairs.join(single.select(F.col("category").alias("category_a"), F.col("n").alias("customers_in_a")), "category_a")
        .join(single.select(F.col("category").alias("category_b"), F.col("n").alias("customers_in_b")), "category_b")
        .select(
            "category_a",
            "category_b",
            "shared_customers",
            "customers_in_a",
            "customers_in_b",
            pct(shared, in_a).alias("pct_a_also_shops_b"),
            pct(shared, in_b).alias("pct_b_also_shops_a"),
            round_half(ratio(shared * total, in_a.cast("double") * in_b), 2).alias("lift"),
            round_half(ratio(shared, in_a + in_b - shared) * F.lit(100.0), 1).alias("jaccard_pct"),
        )
    )


def category_scorecard(txns, ccs, benchmarks, churn, segments, as_of):
    """Size, growth, leader, churn exposure and segment mix per category."""
    recent = F.col("EFF_DATE") >= months_before(as_of, 3)
    trend = (
        last_months(txns, as_of, 6)
        .dropna(subset=["CATEGORY_TWO"])
        .groupBy("CATEGORY_TWO")
        .agg(sum_where(recent, "trns_amt").alias("_recent"), sum_where(~recent, "trns_amt").alias("_prior"))
    )
    size = benchmarks.groupBy("CATEGORY_TWO").agg(
        F.count("*").alias("num_destinations"),
        round_half(exact_sum("total_spend"), 0).alias("total_spend"),
        round_half(exact_avg("avg_txn_value"), 2).alias("avg_txn_value"),
        round_half(exact_avg("spend_per_customer"), 0).alias("avg_spend_per_customer"),
    )
    leader = benchmarks.where(F.col("spend_rank") == 1).select(
        "CATEGORY_TWO",
        F.col("DESTINATION").alias("top_destination_name"),
        F.col("market_share_pct").alias("top_dest_market_share"),
    )
    # One pass over distinct customer x category rows serves churn and segment mix.
    scored = F.col("churn_probability").isNotNull() | F.col("churn_risk_level").isNotNull()
    labelled = F.col("cluster_id").isNotNull()
    risky = F.col("churn_risk_level").isin(AT_RISK)
    exposure = (
        ccs.select("UNIQUE_ID", "CATEGORY_TWO")
        .distinct()
        .join(churn.select("UNIQUE_ID", "churn_probability", "churn_risk_level"), "UNIQUE_ID", "left")
        .join(segments.select("UNIQUE_ID", "cluster_id", "segment_name"), "UNIQUE_ID", "left")
        .groupBy("CATEGORY_TWO")
        .agg(
            F.count("*").alias("total_customers"),
            round_half(exact_avg("churn_probability") * F.lit(100.0), 1).alias("avg_churn_pct"),
            count_where(risky).alias("high_risk_customers"),
            pct(count_where(risky), count_where(scored)).alias("high_risk_pct"),
            pct(count_where(F.col("segment_name") == "Champions"), count_where(labelled)).alias("pct_champions"),
            pct(count_where(F.col("segment_name") == "Dormant"), count_where(labelled)).alias("pct_dormant"),
        )
    )
    growth = ratio(F.col("_recent") - F.col("_prior"), "_prior")
    return (
        size.join(exposure, "CATEGORY_TWO")
        .join(trend, "CATEGORY_TWO", "left")
        .join(leader, "CATEGORY_TWO", "left")
        .select(
            "CATEGORY_TWO",
            "num_destinations",
            "total_customers",
            "total_spend",
            "avg_txn_value",
            "avg_spend_per_customer",
            round_half("_recent", 0).alias("spend_recent_3m"),
            round_half("_prior", 0).alias("spend_prior_3m"),
            round_half(growth * F.lit(100.0), 1).alias("growth_pct"),
            "top_destination_name",
            "top_dest_market_share",
            *[F.coalesce(c, F.lit(0.0)).alias(c) for c in ("avg_churn_pct",)],
            F.coalesce("high_risk_customers", F.lit(0)).alias("high_risk_customers"),
            *[F.coalesce(c, F.lit(0.0)).alias(c) for c in ("high_risk_pct", "pct_champions", "pct_dormant")],
            above(growth, HEALTH).alias("health_status"),
        )
    )


def pitch_opportunities(benchmarks, ccs, churn):
    """Addressable market, gaps, composite score and action per merchant."""
    market = benchmarks.groupBy("CATEGORY_TWO").agg(
        exact_sum("total_spend").alias("category_total_spend"),
        F.max("market_share_pct").alias("_leader_share"),
        F.max("penetration_pct").alias("_leader_penetration"),
        exact_avg("market_share_pct").alias("_mean_share"),
        exact_avg("spend_per_customer").alias("_mean_spend"),
        F.count("*").alias("total_competitors"),
    )
    n = Window.partitionBy()
    market = market.join(exclusive_rank(market, "category_total_spend", "total_competitors"), "category_total_spend")
    market = market.withColumn("_merchants", F.sum("total_competitors").over(n))
    exposure = (
        ccs.select("UNIQUE_ID", "CATEGORY_TWO", "DESTINATION")
        .join(churn.select("UNIQUE_ID", "churn_probability", "churn_risk_level"), "UNIQUE_ID")
        .groupBy("CATEGORY_TWO", "DESTINATION")
        .agg(
            round_half(exact_avg("churn_probability"), 4).alias("_churn"),
            count_where(F.col("churn_risk_level").isin(AT_RISK)).alias("_risky"),
        )
    )
    share, spend = F.col("market_share_pct"), F.col("spend_per_customer")
    churn_rate = F.coalesce("_churn", F.lit(0.0))
    strong = share >= F.col("_mean_share")
    score = (
        ratio("rows_below", F.col("_merchants") - 1) * F.lit(30.0)
        + ratio(F.col("_leader_share") - share, "_leader_share") * F.lit(30.0)
        + (F.lit(1.0) - churn_rate) * F.lit(20.0)
        + strict_least(ratio(spend, "_mean_spend"), F.lit(1.0)) * F.lit(20.0)
    )
    action = (
        F.when(F.col("spend_rank") == 1, PITCH_ACTIONS["leader"])
        .when(strong & (churn_rate < 0.3), PITCH_ACTIONS["grow"])
        .when(strong, PITCH_ACTIONS["protect"])
        .when(~strong & (spend > F.col("_mean_spend")), PITCH_ACTIONS["attack"])
        .when(~strong, PITCH_ACTIONS["opportunity"])
        .otherwise(PITCH_ACTIONS["other"])
    )
    return (
        benchmarks.join(market, "CATEGORY_TWO")
        .join(exposure, ["CATEGORY_TWO", "DESTINATION"], "left")
        .select(
            "CATEGORY_TWO",
            "DESTINATION",
            "customers",
            "total_spend",
            "market_share_pct",
            "penetration_pct",
            "spend_per_customer",
            "spend_rank",
            "category_total_spend",
            "total_competitors",
            round_half(F.col("category_total_spend") * (F.lit(1.0) - share / F.lit(100.0)), 0).alias(
                "addressable_market"
            ),
            round_half(F.col("_leader_share") - share, 2).alias("gap_to_leader_pct"),
            round_half(F.col("_leader_penetration") - F.col("penetration_pct"), 2).alias("penetration_gap_pct"),
            round_half(ratio(spend, "_mean_spend") * F.lit(100.0) - F.lit(100.0), 1).alias("spend_vs_avg_pct"),
            churn_rate.alias("avg_churn_probability"),
            F.coalesce("_risky", F.lit(0)).alias("high_risk_customers"),
            round_half(score, 2).alias("pitch_score"),
            action.alias("recommended_action"),
        )
    )


# --- customers --------------------------------------------------------------


def churn_explained(churn):
    """Up to three rule-based reasons for customers at critical or high risk."""
    days, destinations = F.col("days_since_last"), F.col("active_destinations")
    now, before, months, trend = (F.col(c) for c in ("txns_last_3m", "txns_prev_3m", "active_months", "txn_trend"))
    inactive = days > 90
    dropped = now < before * 0.5
    narrow = destinations <= 2

    def text(template, *values):
        return F.format_string(template, *values)

    reason_1 = (
        F.when(inactive, text("Inactive for %d days", days))
        .when(dropped, "Transaction frequency dropped >50%")
        .when(months <= 3, text("Only active %d months", months))
        .otherwise("Declining overall activity pattern")
    )
    reason_2 = (
        F.when(dropped & ~inactive, text("Frequency dropped from %d to %d txns", before, now))
        .when(narrow, text("Only visiting %d merchants", destinations))
        .when(days > 60, text("Last seen %d days ago", days))
        .otherwise("Spending trend declining")
    )
    reason_3 = (
        F.when(narrow & ~dropped, text("Low merchant diversity (%d)", destinations))
        .when(trend < 0.5, F.concat(F.lit("Spend trend ratio: "), plain_number(round_half(trend, 2))))
        .when(months <= 6, text("Low engagement: %d active months", months))
        .otherwise("Multiple declining signals")
    )
    return churn.where(F.col("churn_risk_level").isin(AT_RISK)).select(
        "UNIQUE_ID",
        round_half("churn_probability", 4).alias("churn_probability"),
        "churn_risk_level",
        "total_spend",
        "days_since_last",
        "txns_last_3m",
        "txns_prev_3m",
        "active_months",
        "active_destinations",
        F.coalesce("txn_trend", F.lit(0.0)).alias("txn_trend"),
        round_half(ratio(now, before), 2).alias("frequency_ratio"),
        reason_1.alias("reason_1"),
        reason_2.alias("reason_2"),
        reason_3.alias("reason_3"),
    )


def spend_momentum(txns, customers, as_of, months=12, min_months=3):
    """Recent against prior half-year of mean monthly spend.

    The mean over active months is the sum divided by the number of distinct active
    months, so one aggregation per customer replaces month-then-customer steps. A
    month belongs to the recent half when its first day reaches the middle date.
    """
    middle = months_before(as_of, 6)
    recent = month_start("EFF_DATE") >= middle
    day = F.lit(as_of)

    def monthly_mean(total, where):
        return ratio(total, distinct_months("EFF_DATE", day, months, where))

    halves = (
        last_months(txns, as_of, months)
        .groupBy("UNIQUE_ID")
        .agg(
            exact_sum("trns_amt").alias("total_spend_12m"),
            distinct_months("EFF_DATE", day, months).alias("active_months"),
            round_half(monthly_mean(sum_where(recent, "trns_amt"), recent), 2).alias("avg_recent_6m"),
            round_half(monthly_mean(sum_where(~recent, "trns_amt"), ~recent), 2).alias("avg_prior_6m"),
            round_half(monthly_mean(count_where(recent), recent), 1).alias("avg_recent_txns"),
            round_half(monthly_mean(count_where(~recent), ~recent), 1).alias("avg_prior_txns"),
        )
        .where(F.col("active_months") >= min_months)
    )
    now, before = F.col("avg_recent_6m"), F.col("avg_prior_6m")
    change = ratio(now - before, before)
    txn_change = ratio(F.col("avg_recent_txns") - F.col("avg_prior_txns"), "avg_prior_txns")
    shortfall = strict_greatest(F.coalesce(F.lit(1.0) - ratio(now, before), F.lit(0.0)), F.lit(0.0))
    status = F.when(before.isNull() | (before == 0), "New").otherwise(above(change, MOMENTUM))
    return halves.select(
        "*",
        round_half(change * F.lit(100.0), 1).alias("spend_change_pct"),
        round_half(txn_change * F.lit(100.0), 1).alias("txn_change_pct"),
        status.alias("momentum_status"),
        round_half(F.col("total_spend_12m") / F.lit(1000.0) * shortfall, 2).alias("urgency_score"),
    ).join(customers.select("UNIQUE_ID", "age", "gender_label", "income_segment", "age_group"), "UNIQUE_ID", "left")


def category_propensity(txns, segments, ccs, as_of, months=12, max_adoption=90.0):
    """How far each segment has adopted each category and what is left."""
    sizes = segments.groupBy("segment_name").agg(F.count("*").alias("segment_size"))
    adoption = (
        window_categories(txns, as_of, months)
        .join(segments.select("UNIQUE_ID", "segment_name"), "UNIQUE_ID")
        .groupBy("segment_name", "CATEGORY_TWO")
        .agg(F.count("*").alias("segment_cat_customers"))
        .join(sizes, "segment_name")
        .withColumn("adoption_rate_pct", pct("segment_cat_customers", "segment_size", 2))
        .where(F.col("adoption_rate_pct") < max_adoption)
    )
    totals = ccs.groupBy("CATEGORY_TWO").agg(
        round_half(exact_sum("dest_spend"), 0).alias("total_cat_spend"),
        round_half(exact_avg("dest_spend"), 2).alias("avg_spend_per_customer"),
    )
    people = category_customers(ccs).withColumnRenamed("cat_total_customers", "total_cat_customers")
    unadopted = F.col("segment_size") - F.col("segment_cat_customers")
    return (
        adoption.join(totals, "CATEGORY_TWO")
        .join(people, "CATEGORY_TWO")
        .select(
            "segment_name",
            "CATEGORY_TWO",
            "segment_cat_customers",
            "segment_size",
            "adoption_rate_pct",
            "total_cat_customers",
            "total_cat_spend",
            "avg_spend_per_customer",
            unadopted.alias("unadopted_customers"),
            round_half(unadopted * F.col("avg_spend_per_customer"), 0).alias("potential_revenue"),
            at_least(F.col("adoption_rate_pct"), PROPENSITY).alias("propensity_level"),
        )
    )


# --- merchants --------------------------------------------------------------


def store_loyalty(ccs, min_customers=100):
    """Share-of-wallet loyalty and number of stores visited, per merchant."""
    rows = totals_within(
        ccs.select(
            "UNIQUE_ID",
            "CATEGORY_TWO",
            "DESTINATION",
            "dest_spend",
            round_half("share_of_wallet_pct", 1).alias("loyalty_pct"),
        ),
        ["UNIQUE_ID", "CATEGORY_TWO"],
        stores=F.count("*"),
    )
    n, loyalty, stores = F.count("*"), F.col("loyalty_pct"), F.col("stores")
    return (
        rows.groupBy("CATEGORY_TWO", "DESTINATION")
        .agg(
            n.alias("customers"),
            round_half(exact_avg("loyalty_pct"), 1).alias("avg_loyalty_pct"),
            round_half(exact_avg("stores"), 1).alias("avg_stores_visited"),
            count_where(loyalty >= 50).alias("loyal_customers_50pct"),
            pct(count_where(loyalty >= 50), n).alias("pct_loyal_50"),
            count_where(loyalty >= 80).alias("loyal_customers_80pct"),
            pct(count_where(loyalty >= 80), n).alias("pct_loyal_80"),
            count_where(stores == 1).alias("band_1_store"),
            count_where(stores == 2).alias("band_2_stores"),
            count_where(stores.between(3, 4)).alias("band_3_4_stores"),
            count_where(stores.between(5, 7)).alias("band_5_7_stores"),
            count_where(stores >= 8).alias("band_8_plus"),
            round_half(exact_sum("dest_spend"), 0).alias("total_spend"),
            round_half(exact_avg("dest_spend"), 0).alias("avg_spend_per_customer"),
        )
        .where(F.col("customers") >= min_customers)
    )


# Hour ranges of the shares and of the mean baskets, day numbers.
HOUR_SHARES = {
    "pct_early_morning": (6, 9),
    "pct_mid_morning": (10, 12),
    "pct_afternoon": (13, 15),
    "pct_late_afternoon": (16, 18),
    "pct_evening": (19, 21),
}
BASKETS = {
    "avg_basket_early": (6, 9),
    "avg_basket_midday": (10, 14),
    "avg_basket_afternoon": (15, 18),
    "avg_basket_evening": (19, 23),
}
DAYS = ["sunday", "monday", "tuesday", "wednesday", "thursday", "friday", "saturday"]


def store_time_patterns(txns, as_of, months=12, min_txns=1000):
    """Hour and weekday profile per merchant.

    Two narrow scans: a merchant has at most 25 x 7 cells, which shrink on the map side, and its
    customers are counted on three columns.
    """
    keys = ["CATEGORY_TWO", "DESTINATION"]
    rows = last_months(txns, as_of, months)
    cells = rows.groupBy(*keys, "trns_hour", "trns_dow").agg(F.count("*").alias("n"), exact_sum("trns_amt").alias("spend"))
    hour, dow = F.col("trns_hour"), F.col("trns_dow")

    def weight(where, value="n"):
        return F.coalesce(F.sum(F.when(where, F.col(value))), F.lit(0))

    def spend_where(where):
        return F.coalesce(exact_sum("spend", where), F.lit(0.0))

    total = F.sum("n")
    shares = [pct(weight(hour.between(*span)), total).alias(name) for name, span in HOUR_SHARES.items()]
    days = [pct(weight(dow == i + 1), total).alias(f"pct_{day}") for i, day in enumerate(DAYS)]
    baskets = [
        round_half(ratio(spend_where(hour.between(*span)), weight(hour.between(*span))), 2).alias(name)
        for name, span in BASKETS.items()
    ]
    profile = (
        weigh_modes(cells, keys, ["trns_hour", "trns_dow"])
        .groupBy(*keys)
        .agg(
            total.alias("total_transactions"),
            round_half(exact_sum("spend"), 0).alias("total_spend"),
            *shares,
            pct(weight((hour >= 22) | (hour < 6)), total).alias("pct_late_night"),
            *days,
            pct(weight(dow.isin(1, 7)), total).alias("pct_weekend"),
            pct(weight(dow.between(2, 6)), total).alias("pct_weekday"),
            *baskets,
            pick_mode("trns_hour").alias("peak_hour"),
            pick_mode("trns_dow").alias("peak_day_number"),
        )
        .where(F.col("total_transactions") >= min_txns)
    )
    return null_safe_join(profile, customers_per(rows, keys, "unique_customers"), keys)


def client_segment_mix(ccs, segments, min_customers=1000):
    """Segment mix of each merchant against the whole customer base.

    Customers without a segment count in the merchant totals but form no row.
    """
    keys = ["DESTINATION", "CATEGORY_TWO"]
    base = segments.groupBy("segment_name").agg(F.count("*").alias("_n"))
    base = base.select(
        "segment_name", ratio("_n", F.sum("_n").over(Window.partitionBy())).alias("_base_share")
    )
    mix = (
        ccs.select(*keys, "UNIQUE_ID", "dest_spend")
        .join(segments.select("UNIQUE_ID", "segment_name"), "UNIQUE_ID", "left")
        .groupBy(*keys, "segment_name")
        .agg(F.count("*").alias("segment_customers"), exact_sum("dest_spend").alias("_spend"))
    )
    client = Window.partitionBy(*keys)
    return (
        mix.withColumn("client_total_customers", F.sum("segment_customers").over(client))
        .withColumn("client_total_spend", exact_sum_over("_spend", client))
        .where(F.col("segment_name").isNotNull() & (F.col("client_total_customers") >= min_customers))
        .join(base, "segment_name", "left")
        .withColumn("segment_spend", round_half("_spend", 0))
        .select(
            *keys,
            "segment_name",
            "segment_customers",
            "segment_spend",
            "client_total_customers",
            "client_total_spend",
            pct("segment_customers", "client_total_customers", 2).alias("pct_of_client_customers"),
            pct("segment_spend", "client_total_spend", 2).alias("pct_of_client_spend"),
            round_half(F.col("_base_share") * F.lit(100.0), 2).alias("population_pct_of_customers"),
            round_half(
                ratio(ratio("segment_customers", "client_total_customers"), "_base_share") * F.lit(100.0), 0
            ).alias("index_vs_population"),
        )
    )
