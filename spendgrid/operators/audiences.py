"""Rule-based audiences: membership, catalogue and overlap with merchants."""

from functools import reduce

from pyspark.sql import functions as F

from spendgrid.functions.bands import lookup_text
from spendgrid.functions.dialect import (
    count_where,
    months_before,
    pct,
    pick_mode,
    ratio,
    round_half,
    exact_sum,
    sum_where,
    weigh_modes,
)
from spendgrid.functions.labels import (
    AT_RISK,
    AUDIENCES,
    LIFESTYLE,
    PREMIUM_CATEGORIES,
    PROVINCE_AUDIENCES,
    SEASONAL,
)
from spendgrid.operators.staging import last_months


def _matches(source, rules):
    """UNIQUE_ID and audience_id for every rule that holds, in one pass over source."""
    hits = F.array(*[F.when(rule, F.lit(audience)) for audience, rule in rules.items()])
    return source.select("UNIQUE_ID", F.explode(F.array_compact(hits)).alias("audience_id"))


def demographic_members(customers):
    age, income, gender = F.col("age"), F.col("estimated_income"), F.col("gender_label")
    rules = {
        "D01": (income >= 56000) & age.between(25, 55),
        "D02": income.between(23000, 56000),
        "D03": age.between(18, 25),
        "D04": age >= 55,
        "D05": (income >= 56000) & (gender == "Female"),
        "D06": (income >= 56000) & (gender == "Male"),
        "D07": age.between(26, 40) & (income >= 23000),
    }
    return _matches(customers, rules)


def spending_members(ccs):
    """Lifestyle shares and cross-category rules from one aggregate per customer."""
    category, spend = F.col("CATEGORY_TWO"), F.col("dest_spend")
    groups = [
        sum_where(category.isin(categories), "dest_spend").alias(audience)
        for audience, (categories, _, _) in LIFESTYLE.items()
    ]
    per_customer = ccs.groupBy("UNIQUE_ID").agg(
        exact_sum("dest_spend").alias("total"),
        *groups,
        F.size(F.collect_set(F.when(category.isin(PREMIUM_CATEGORIES) & (spend >= 2000), category))).alias("premium"),
        F.max((category == "Groceries") & (spend >= 5000)).alias("big_grocery"),
        F.max((category == "Clothing & Apparel") & (spend >= 2000)).alias("big_clothing"),
    )
    rules = {}
    for audience, (_, share, minimum) in LIFESTYLE.items():
        # the food rule tests the customer's whole spend, the others the group's
        tested = F.col("total") if audience == "L01" else F.col(audience)
        rules[audience] = (ratio(audience, "total") >= share) & (tested >= minimum)
    rules["X01"] = F.col("premium") >= 3
    rules["X02"] = F.col("big_grocery") & F.col("big_clothing")
    return _matches(per_customer, rules)


def segment_members(segments):
    name = F.col("segment_name")
    return _matches(segments, {"B01": name == "Champions", "B02": name == "Loyal High Value"})


def feature_members(features, churn, frequent_txns=500):
    risk = churn.select("UNIQUE_ID", "churn_risk_level")
    source = features.select("UNIQUE_ID", "nr_trns", "val_trns", "active_nav_categories").join(risk, "UNIQUE_ID", "left")
    rules = {
        "B03": F.col("churn_risk_level").isin(AT_RISK) & (F.col("val_trns") >= 50000),
        "B06": F.col("nr_trns") >= frequent_txns,
        "B07": F.col("active_nav_categories") >= 8,
    }
    return _matches(source, rules)


def momentum_members(momentum):
    status, spend = F.col("momentum_status"), F.col("total_spend_12m")
    rules = {
        "B04": (status == "Accelerating") & (spend >= 10000),
        "B05": (status == "Declining") & (spend >= 50000),
    }
    return _matches(momentum, rules)


def place_and_season_members(txns, as_of, months=12, seasonal_months=14):
    """Home province, seasonal and pay-day rules from one scan of the longer window.

    Rows are reduced to customer x province first; the home province is the most
    frequent one of the shorter window.
    """
    in_year = F.col("EFF_DATE") >= months_before(as_of, months)
    day = F.dayofmonth("EFF_DATE")
    pay_day = day.between(25, 31) | day.between(1, 3)
    season_sums = [
        sum_where(F.month("EFF_DATE") == month, "trns_amt").alias(audience)
        for audience, (month, _, _) in SEASONAL.items()
    ]
    by_province = (
        last_months(txns, as_of, seasonal_months)
        .groupBy("UNIQUE_ID", "PROVINCE")
        .agg(
            count_where(in_year).alias("year_rows"),
            count_where(in_year & pay_day).alias("pay_day_rows"),
            F.count("*").alias("rows"),
            exact_sum("trns_amt").alias("spend"),
            *season_sums,
        )
    )
    placed = F.col("PROVINCE").isNotNull() & (F.col("year_rows") > 0)
    home = F.min(F.when(placed, F.struct((-F.col("year_rows")).alias("n"), F.col("PROVINCE").alias("p"))))
    per_customer = by_province.groupBy("UNIQUE_ID").agg(
        home["p"].alias("home"),
        *[F.sum(c).alias(c) for c in ("year_rows", "pay_day_rows", "rows")],
        *[exact_sum(c).alias(c) for c in ("spend", *SEASONAL)],
    )
    rules = {audience: F.col("home") == province for audience, province in PROVINCE_AUDIENCES.items()}
    mean = ratio("spend", "rows")
    for audience, (_, multiple, minimum) in SEASONAL.items():
        spend = F.col(audience)
        rules[audience] = (spend >= mean * F.lit(multiple)) & (spend >= minimum)
    rules["S04"] = (ratio("pay_day_rows", "year_rows") >= 0.5) & (F.col("year_rows") >= 12)
    return _matches(per_customer, rules)


def audience_members(customers, ccs, segments, churn, features, momentum, txns, as_of, params):
    """One row per audience and customer.

    Each source is read once and yields all of its rules; the parts are appended, so
    no wide outer join is needed and a customer missing from one source still
    qualifies through another.
    """
    parts = [
        demographic_members(customers),
        spending_members(ccs),
        segment_members(segments),
        feature_members(features, churn, params.frequent_txns),
        momentum_members(momentum),
        place_and_season_members(txns, as_of, params.window_months, params.seasonal_months),
    ]
    members = reduce(lambda a, b: a.unionByName(b), parts)
    audience = F.col("audience_id")
    return members.select(
        "audience_id",
        lookup_text(audience, {k: v[0] for k, v in AUDIENCES.items()}).alias("audience_name"),
        lookup_text(audience, {k: v[1] for k, v in AUDIENCES.items()}).alias("audience_type"),
        "UNIQUE_ID",
    )


def _audiences_per_customer(members):
    """One row per customer with the list of audiences (at most one per rule)."""
    return members.groupBy("UNIQUE_ID").agg(F.collect_list("audience_id").alias("audiences"))


def audience_catalog(members, customers, features, segments, churn, min_size=1000):
    """Size, spend, demographics and text per audience.

    The joins run on one row per customer; exploding afterwards feeds straight into a
    partial aggregation on a small cube from which means and modes are read.
    """
    person = customers.select("UNIQUE_ID", "age", "estimated_income", "gender_label", "age_group", "income_group")
    rows = (
        _audiences_per_customer(members)
        .join(person, "UNIQUE_ID", "left")
        .join(features.select("UNIQUE_ID", "val_trns"), "UNIQUE_ID", "left")
        .join(segments.select("UNIQUE_ID", "segment_name"), "UNIQUE_ID", "left")
        .join(churn.select("UNIQUE_ID", "churn_probability"), "UNIQUE_ID", "left")
        .withColumn("audience_id", F.explode("audiences"))
    )
    measures = ["val_trns", "age", "estimated_income", "churn_probability"]
    cube = rows.groupBy("audience_id", "age_group", "income_group", "segment_name").agg(
        F.count("*").alias("n"),
        count_where(F.col("gender_label") == "Female").alias("women"),
        *[exact_sum(c).alias(f"{c}_sum") for c in measures],
        *[F.count(c).alias(f"{c}_n") for c in measures],
    )

    def mean(c):
        return ratio(exact_sum(f"{c}_sum"), F.sum(f"{c}_n"))

    audience = F.col("audience_id")
    modes = {"age_group": "top_age_group", "income_group": "top_income_group", "segment_name": "top_segment"}
    catalog = (
        weigh_modes(cube, ["audience_id"], modes)
        .groupBy("audience_id")
        .agg(
            F.sum("n").alias("audience_size"),
            round_half(mean("val_trns"), 0).alias("avg_spend"),
            round_half(mean("age"), 1).alias("avg_age"),
            pct(F.sum("women"), F.sum("n")).alias("pct_female"),
            round_half(mean("estimated_income"), 0).alias("avg_income"),
            round_half(mean("churn_probability"), 3).alias("avg_churn_prob"),
            *[pick_mode(value).alias(name) for value, name in modes.items()],
        )
        .where(F.col("audience_size") >= min_size)
    )
    return catalog.select(
        "*",
        lookup_text(audience, {k: v[0] for k, v in AUDIENCES.items()}).alias("audience_name"),
        lookup_text(audience, {k: v[1] for k, v in AUDIENCES.items()}).alias("audience_type"),
        lookup_text(audience, PROVINCE_AUDIENCES, "Mixed").alias("top_province"),
        lookup_text(audience, {k: v[2] for k, v in AUDIENCES.items()}, "Custom audience segment.").alias("description"),
    )


def audience_client_overlap(ccs, members, catalog, min_customers=1000):
    """Members of each audience among the customers of each merchant.

    Merchants below the floor are dropped before the join; audiences travel as one
    array per customer and are exploded into the partial aggregation.
    """
    keys = ["DESTINATION", "CATEGORY_TWO"]
    clients = (
        ccs.groupBy(*keys)
        .agg(F.count("*").alias("client_total_customers"))
        .where(F.col("client_total_customers") >= min_customers)
    )
    overlap = (
        ccs.select(*keys, "UNIQUE_ID")
        .join(clients, keys, "left_semi")
        .join(_audiences_per_customer(members), "UNIQUE_ID")
        .select(*keys, F.explode("audiences").alias("audience_id"))
        .groupBy(*keys, "audience_id")
        .agg(F.count("*").alias("overlap_customers"))
    )
    names = catalog.select("audience_id", "audience_name", "audience_type")
    return (
        overlap.join(clients, keys)
        .join(names, "audience_id", "left")
        .select(
            *keys,
            "audience_id",
            "audience_name",
            "audience_type",
            "overlap_customers",
            "client_total_customers",
            pct("overlap_customers", "client_total_customers", 2).alias("pct_of_client"),
        )
    )
