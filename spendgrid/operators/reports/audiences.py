"""Audience breakdowns, brand audiences and category pitches."""

from functools import reduce

from pyspark.sql import functions as F

from spendgrid.functions.dialect import count_where, exact_avg, exact_sum, local_frame, pct, round_half
from spendgrid.operators.reports.common import is_value
from spendgrid.operators.staging import UNKNOWN, last_months

# --- audiences -----------------------------------------------------------------


def audience_spend_breakdown(members, ccs, by, min_customers=50):
    """Customers and spend per audience and category or merchant.

    Spend is first reduced to one row per customer and value and the audiences to
    one array per customer, so the join carries no duplicates.
    """
    spend = ccs.groupBy("UNIQUE_ID", by).agg(exact_sum("dest_spend").alias("spend"))
    lists = members.groupBy("UNIQUE_ID").agg(F.collect_list("audience_id").alias("audiences"))
    return (
        spend.join(lists, "UNIQUE_ID")
        .select(by, "spend", F.explode("audiences").alias("audience_id"))
        .groupBy("audience_id", by)
        .agg(F.count("*").alias("customers"), round_half(exact_sum("spend"), 0).alias("spend"))
        .where(F.col("customers") >= min_customers)
    )


def audience_band_breakdown(members, customers, band, keep_unknown=False):
    bands = customers.dropna(subset=[band]).select("UNIQUE_ID", band)
    if not keep_unknown:
        bands = bands.where(F.col(band) != UNKNOWN)
    return (
        members.select("audience_id", "UNIQUE_ID")
        .join(bands, "UNIQUE_ID")
        .groupBy("audience_id", band)
        .agg(F.count("*").alias("customers"))
    )


def audience_provinces(catalog):
    return catalog.select(
        "audience_id",
        "audience_name",
        "audience_type",
        F.col("top_province").alias("PROVINCE"),
        F.col("audience_size").alias("customers"),
        round_half(F.col("avg_spend") * F.col("audience_size"), 0).alias("spend"),
    )


def brand_predicates():
    """Named customer filters used for brand audiences; the limits are fixed values."""
    female, age, income = is_value("gender_label", "Female"), F.col("age"), F.col("income_group")
    middle = ["R5.5k-R13.5k", "R13.5k-R23.5k", "R23.5k-R32.5k"]
    return {
        "mass_makeup": female & income.isin(middle) & age.between(18, 40),
        "premium_skincare": female & income.isin("R32.5k-R56k", "R56k+") & age.between(25, 55),
        "supplements": ~income.isin("R0-R5.5k", UNKNOWN) & age.between(30, 60),
        "textured_hair": female & age.between(18, 45),
    }


def _brand_rows(ccs, customers, client, predicate):
    """Spend rows of the client's customers that satisfy the predicate."""
    people = customers if predicate is None else customers.where(predicate)
    return ccs.where(is_value("DESTINATION", client)).join(
        people.select("UNIQUE_ID", "age", "estimated_income", "gender_label", "age_group", "income_group"), "UNIQUE_ID"
    )


def brand_profile(ccs, customers, client, predicate=None):
    return _brand_rows(ccs, customers, client, predicate).agg(
        F.count_distinct("UNIQUE_ID").alias("audience_size"),
        round_half(exact_avg("age"), 1).alias("avg_age"),
        round_half(exact_avg("estimated_income"), 0).alias("avg_income"),
        pct(count_where(is_value("gender_label", "Female")), F.count("*")).alias("pct_female"),
        round_half(exact_sum("dest_spend"), 0).alias("total_spend"),
        round_half(exact_avg("dest_spend"), 0).alias("avg_spend"),
    )


def brand_bands(ccs, customers, client, predicate, band):
    return (
        _brand_rows(ccs, customers, client, predicate)
        .where(F.col(band).isNotNull() & (F.col(band) != UNKNOWN))
        .groupBy(band)
        .agg(F.count_distinct("UNIQUE_ID").alias("n"))
    )


def brand_other_categories(ccs, customers, client, predicate, n=8):
    """Where the audience shops besides the client."""
    audience = _brand_rows(ccs, customers, client, predicate).select("UNIQUE_ID")
    return _cross_shop(ccs.where(~is_value("DESTINATION", client)), audience, ["CATEGORY_TWO"], n)


def brand_segments(ccs, customers, segments, client, predicate):
    audience = _brand_rows(ccs, customers, client, predicate).select("UNIQUE_ID")
    return segments.join(audience, "UNIQUE_ID", "left_semi").groupBy("segment_name").agg(F.count("*").alias("n"))


def _cross_shop(rows, audience, keys, n):
    """Customers and spend per key for rows of the audience, largest n by spend."""
    return (
        rows.join(audience.select("UNIQUE_ID"), "UNIQUE_ID", "left_semi")
        .groupBy("UNIQUE_ID", *keys)
        .agg(exact_sum("dest_spend").alias("spend"))
        .groupBy(*keys)
        .agg(F.count("*").alias("customers"), round_half(exact_sum("spend"), 0).alias("spend"))
        .orderBy(F.desc("spend"), *keys)
        .limit(n)
    )


# --- category pitch ------------------------------------------------------------


def category_size(ccs, category):
    return ccs.where(is_value("CATEGORY_TWO", category)).agg(
        F.count_distinct("UNIQUE_ID").alias("shoppers"),
        round_half(exact_sum("dest_spend"), 0).alias("spend"),
        round_half(exact_avg("dest_spend"), 0).alias("avg_spend"),
    )


def category_leaders(benchmarks, category, n=8):
    return (
        benchmarks.where(is_value("CATEGORY_TWO", category))
        .orderBy("spend_rank")
        .limit(n)
        .select(
            "DESTINATION",
            "customers",
            F.col("total_spend").alias("spend"),
            round_half("market_share_pct", 1).alias("share"),
            F.col("spend_per_customer").alias("per_cust"),
            F.col("avg_share_of_wallet").alias("sow"),
            "spend_rank",
        )
    )


def category_months(txns, as_of, category, months=12):
    return (
        last_months(txns, as_of, months)
        .where(is_value("CATEGORY_TWO", category))
        .groupBy(F.date_format("EFF_DATE", "yyyy-MM").alias("month"), F.date_format("EFF_DATE", "MMM yyyy").alias("month_label"))
        .agg(
            F.count_distinct("UNIQUE_ID").alias("customers"),
            round_half(exact_sum("trns_amt"), 0).alias("spend"),
            F.count("*").alias("txns"),
        )
    )


def category_demographics(ccs, customers, category, band, keep_unknown=False):
    bands = customers.dropna(subset=[band]).select("UNIQUE_ID", band)
    if not keep_unknown:
        bands = bands.where(F.col(band) != UNKNOWN)
    return (
        ccs.where(is_value("CATEGORY_TWO", category))
        .groupBy("UNIQUE_ID")
        .agg(exact_sum("dest_spend").alias("spend"))
        .join(bands, "UNIQUE_ID")
        .groupBy(band)
        .agg(F.count("*").alias("customers"), round_half(exact_sum("spend"), 0).alias("spend"))
    )


def category_cross_shop(ccs, category, n=10):
    audience = ccs.where(is_value("CATEGORY_TWO", category))
    return _cross_shop(ccs.where(~is_value("CATEGORY_TWO", category)), audience, ["CATEGORY_TWO"], n)


def category_segments(ccs, segments, category):
    audience = ccs.where(is_value("CATEGORY_TWO", category)).select("UNIQUE_ID")
    return segments.join(audience, "UNIQUE_ID", "left_semi").groupBy("segment_name").agg(F.count("*").alias("n"))


def store_overlap(ccs, client, pattern):
    """Customers of a merchant who also visit a merchant whose name matches the pattern."""
    flags = (
        ccs.select("UNIQUE_ID", "DESTINATION")
        .groupBy("UNIQUE_ID")
        .agg(
            F.max(is_value("DESTINATION", client)).alias("a"), F.max(F.upper("DESTINATION").like(pattern)).alias("b")
        )
    )
    return flags.agg(count_where(F.col("a") & F.col("b")).alias("shared_customers"))


def season_skewed_audience(txns, as_of, category, season=(5, 6, 7, 8), share=0.45, months=12):
    """Customers of a category with more than `share` of their spend in the season."""
    in_season = F.month("EFF_DATE").isin(list(season))
    per_customer = (
        last_months(txns, as_of, months)
        .where(is_value("CATEGORY_TWO", category))
        .groupBy("UNIQUE_ID")
        .agg(
            exact_sum("trns_amt").alias("year"),
            exact_sum("trns_amt", where=in_season).alias("season"),
        )
    )
    return per_customer.where(F.col("season") > F.col("year") * F.lit(share)).agg(
        F.count("*").alias("audience_size"), round_half(exact_avg("year"), 0).alias("avg_annual_spend")
    )


def multi_category_audience(ccs, category, others, at_least_n=2):
    """Shoppers of a category active in at least n of the other categories."""
    per_customer = ccs.groupBy("UNIQUE_ID").agg(
        F.max(is_value("CATEGORY_TWO", category)).alias("base"),
        F.size(F.collect_set(F.when(F.col("CATEGORY_TWO").isin(others), F.col("CATEGORY_TWO")))).alias("n"),
    )
    return per_customer.agg(count_where(F.col("base") & (F.col("n") >= at_least_n)).alias("audience_size"))


def category_pair_overlap(ccs, first, second, customers=None, predicate=None):
    """Customers active in any category of both lists, optionally filtered by person."""
    flags = ccs.groupBy("UNIQUE_ID").agg(
        F.max(F.col("CATEGORY_TWO").isin(first)).alias("a"), F.max(F.col("CATEGORY_TWO").isin(second)).alias("b")
    )
    both = flags.where(F.col("a") & F.col("b"))
    if predicate is not None:
        both = both.join(customers.where(predicate).select("UNIQUE_ID"), "UNIQUE_ID", "left_semi")
    return both.agg(F.count("*").alias("audience_size"))


def search_names(benchmarks, column, patterns, excluding=(), n=15):
    """Merchants whose upper-cased name or category matches a pattern.

    `excluding` binds to the last pattern only, as AND does before OR.
    """
    name = F.upper(column)
    tests = [name.like(p) for p in patterns]
    for pattern in excluding:
        tests[-1] = tests[-1] & ~name.like(pattern)
    return (
        benchmarks.where(reduce(lambda a, b: a | b, tests))
        .select("DESTINATION", "CATEGORY_TWO", "customers", "total_spend", "market_share_pct", "spend_rank")
        .orderBy(F.desc("total_spend"), "DESTINATION", "CATEGORY_TWO")
        .limit(n)
    )


def search_categories(benchmarks, patterns):
    """Distinct categories whose upper-cased name matches any pattern."""
    name = F.upper("CATEGORY_TWO")
    tests = [name.like(p) for p in patterns]
    return benchmarks.where(reduce(lambda a, b: a | b, tests)).select("CATEGORY_TWO").distinct()


def destination_spellings(ccs, pattern):
    """Merchant names matching a pattern, with their number of spend rows."""
    return (
        ccs.where(F.upper("DESTINATION").like(pattern))
        .groupBy("DESTINATION")
        .agg(F.count("*").alias("n"))
    )


def client_categories(ccs, client):
    """Customers of a merchant per category."""
    return (
        ccs.where(is_value("DESTINATION", client)).groupBy("CATEGORY_TWO").agg(F.count("*").alias("customers"))
    )


def client_demographics(ccs, customers, client):
    buyers = ccs.where(is_value("DESTINATION", client)).select("UNIQUE_ID")
    return (
        customers.join(buyers, "UNIQUE_ID", "left_semi")
        .groupBy("age_group", "income_group", "gender_label")
        .agg(
            F.count("*").alias("customers"),
            round_half(exact_avg("age"), 1).alias("avg_age"),
            round_half(exact_avg("estimated_income"), 0).alias("avg_income"),
        )
    )


def pattern_shoppers(ccs, pattern):
    """Customers of any merchant whose name matches a LIKE pattern, in any case."""
    return ccs.where(F.upper("DESTINATION").like(pattern.upper())).select("UNIQUE_ID").distinct()


def pattern_audience(ccs, customers, pattern, band):
    """Shoppers of all merchants that match the pattern, per value of a band; a shopper counts once."""
    people = customers.select("UNIQUE_ID", band)
    return pattern_shoppers(ccs, pattern).join(people, "UNIQUE_ID").groupBy(band).agg(F.count("*").alias("customers"))


def client_cross_shop(ccs, client, excluded_category, n=50):
    """Merchants outside the client's own category that its customers use."""
    buyers = ccs.where(is_value("DESTINATION", client))
    rows = ccs.where(~is_value("CATEGORY_TWO", excluded_category))
    return _cross_shop(rows, buyers, ["CATEGORY_TWO", "DESTINATION"], n)


def brand_coverage(ccs, brands):
    """Customers per listed brand, 0 where the data has none; names match in any case."""
    listed = local_frame(ccs.sparkSession, [(b,) for b in brands], ["brand"])
    found = (
        ccs.where(F.upper("DESTINATION").isin([b.upper() for b in brands]))
        .groupBy(F.upper("DESTINATION").alias("_name"))
        .agg(F.count_distinct("UNIQUE_ID").alias("customers"))
    )
    return (
        listed.join(found, F.upper("brand") == F.col("_name"), "left")
        .select("brand", F.coalesce("customers", F.lit(0)).alias("customers"))
    )
