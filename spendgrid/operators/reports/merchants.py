"""Merchant pitches: wallet share, competitors, scenarios, affinity and propensity."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from spendgrid.functions.bands import at_least
from spendgrid.functions.dialect import (
    count_where,
    exact_avg,
    exact_sum,
    money_label,
    pct,
    round_half,
    share_of_total,
)
from spendgrid.functions.labels import WALLET_BANDS
from spendgrid.operators.reports.common import is_value

# --- merchant pitch ------------------------------------------------------------


def pick_default_client(benchmarks, category=None):
    """Largest category (unless given) and its largest merchant, as plain values."""
    if category is None:
        spend = benchmarks.groupBy("CATEGORY_TWO").agg(exact_sum("total_spend").alias("spend"))
        category = spend.orderBy(F.desc("spend"), "CATEGORY_TWO").first()["CATEGORY_TWO"]
    leader = benchmarks.where(is_value("CATEGORY_TWO", category)).orderBy(F.desc("total_spend"), "DESTINATION").first()
    return category, leader["DESTINATION"]


def client_kpis(benchmarks, category, client):
    return benchmarks.where(is_value("CATEGORY_TWO", category) & is_value("DESTINATION", client)).select(
        "customers",
        "transactions",
        "total_spend",
        "avg_txn_value",
        "spend_per_customer",
        "market_share_pct",
        "penetration_pct",
        "spend_rank",
    )


def wallet_summary(ccs, category, client):
    """Category and client customers, penetration and mean share of wallet, one row."""
    of_client = is_value("DESTINATION", client)
    per_customer = (
        ccs.where(is_value("CATEGORY_TWO", category))
        .groupBy("UNIQUE_ID")
        .agg(
            exact_sum("dest_spend").alias("category_spend"),
            exact_sum("dest_spend", where=of_client).alias("client_spend"),
            exact_avg("share_of_wallet_pct", where=of_client).alias("share"),
        )
    )
    buys = F.col("client_spend") > 0
    return per_customer.agg(
        F.count("*").alias("category_customers"),
        count_where(buys).alias("client_customers"),
        pct(count_where(buys), F.count("*")).alias("penetration"),
        round_half(exact_avg("share", where=buys), 1).alias("avg_share"),
        round_half(exact_sum("client_spend"), 0).alias("total_client_spend"),
        round_half(exact_sum("category_spend"), 0).alias("total_category_spend"),
    )


def wallet_bands(ccs, category, client):
    return (
        ccs.where(is_value("CATEGORY_TWO", category) & is_value("DESTINATION", client))
        .groupBy(at_least(F.col("share_of_wallet_pct"), WALLET_BANDS).alias("wallet_band"))
        .agg(F.count("*").alias("customers"), round_half(exact_sum("dest_spend"), 0).alias("client_spend"))
    )


def benchmark_vs_competitors(benchmarks, category, client, n=5):
    """The client by name and its n largest competitors by number."""
    rows = benchmarks.where(is_value("CATEGORY_TWO", category))
    mine = is_value("DESTINATION", client)
    others = rows.where(~mine).orderBy(F.desc("total_spend"), "DESTINATION").limit(n)
    few = rows.where(mine).unionByName(others)  # a top-n plan; the window sees n + 1 rows
    place = F.row_number().over(Window.partitionBy("CATEGORY_TWO", mine).orderBy(F.desc("total_spend"), "DESTINATION"))
    return (
        few.withColumn("_place", place)
        .select(
            F.when(mine, F.lit(client))
            .otherwise(F.concat(F.lit("Competitor "), F.col("_place").cast("string")))
            .alias("display_name"),
            F.when(mine, "Client").otherwise("Competitor").alias("entity_type"),
            "customers",
            "total_spend",
            "market_share_pct",
            "penetration_pct",
            "spend_per_customer",
            "avg_txn_value",
        )
    )


def share_verdict(benchmarks, category, client, n=5):
    """Whether the client's market share leads or trails its competitors' mean."""
    field = benchmark_vs_competitors(benchmarks, category, client, n)
    is_client = is_value("entity_type", "Client")
    share = F.col("client_share")
    mean = F.col("competitor_mean")
    return field.agg(
        F.max(F.when(is_client, F.col("market_share_pct"))).alias("client_share"),
        exact_avg("market_share_pct", where=~is_client).alias("competitor_mean"),
    ).select(
        "client_share",
        round_half(mean, 1).alias("competitor_mean"),
        F.when(share > mean, "leads").otherwise("trails").alias("verdict"),
    )


def client_vs_category_trend(trends, category, client):
    """Monthly client and category totals with the client's share; no sale counts as 0."""
    mine = is_value("DESTINATION", client)

    def sums(prefix, where):
        return [
            F.coalesce(F.sum(F.when(where, F.col("txn_count"))), F.lit(0)).alias(f"{prefix}_txns"),
            F.coalesce(F.sum(F.when(where, F.col("customer_count"))), F.lit(0)).alias(f"{prefix}_customers"),
            F.coalesce(exact_sum("total_spend", where=where), F.lit(0.0)).alias(f"{prefix}_spend"),
        ]

    return (
        trends.where(is_value("CATEGORY_TWO", category))
        .groupBy("month")
        .agg(*sums("category", F.lit(True)), *sums("client", mine))
        .withColumn("client_share_pct", F.coalesce(pct("client_spend", "category_spend"), F.lit(0.0)))
    )


def roi_scenarios(ccs, category, client, percentages=(5, 10, 20), campaign_cost=500_000.0):
    """Extra revenue from more customers or more spend per customer, per percentage."""
    base = ccs.where(is_value("CATEGORY_TWO", category) & is_value("DESTINATION", client)).agg(
        F.count("*").alias("total_customers"),
        F.coalesce(round_half(exact_sum("dest_spend"), 0), F.lit(0.0)).alias("total_revenue"),
        F.coalesce(round_half(exact_avg("dest_spend"), 0), F.lit(0.0)).alias("revenue_per_customer"),
    )
    share = F.col("percentage") / F.lit(100.0)
    extra = F.col("new_customer_revenue") + F.col("extra_spend")
    return (
        base.withColumn("percentage", F.explode(F.array(*[F.lit(p).cast("bigint") for p in percentages])))
        .withColumn("new_customers", F.floor(F.col("total_customers") * F.col("percentage") / F.lit(100.0)))
        .withColumn("new_customer_revenue", F.col("new_customers") * F.col("revenue_per_customer"))
        .withColumn("extra_spend", round_half(F.col("total_revenue") * share, 2))
        .withColumn("roi_pct", pct(extra - F.lit(campaign_cost), F.lit(campaign_cost)))
        .withColumn("total_revenue_label", money_label("total_revenue"))
    )


def province_rollup(geo, category):
    return (
        geo.where(is_value("CATEGORY_TWO", category))
        .groupBy("PROVINCE")
        .agg(
            F.sum("customers").alias("customers"),
            F.sum("transactions").alias("transactions"),
            exact_sum("total_spend").alias("total_spend"),
        )
        .withColumn("pct", share_of_total("total_spend"))
    )


def top_municipalities(geo, category, n=15):
    return (
        geo.where(is_value("CATEGORY_TWO", category))
        .groupBy("PROVINCE", "MUNICIPALITY")
        .agg(F.sum("customers").alias("customers"), exact_sum("total_spend").alias("total_spend"))
        .orderBy(F.desc("total_spend"), "PROVINCE", "MUNICIPALITY")
        .limit(n)
    )


def demographic_rollup(demographics, category, by):
    """Customers and spend of one category by one or more demographic columns."""
    return (
        demographics.where(is_value("CATEGORY_TWO", category))
        .groupBy(*([by] if isinstance(by, str) else by))
        .agg(F.sum("customers").alias("customers"), exact_sum("total_spend").alias("spend"))
    )


def category_list(benchmarks, n=20):
    return (
        benchmarks.groupBy("CATEGORY_TWO")
        .agg(F.count("*").alias("destinations"), exact_sum("total_spend").alias("total_spend"))
        .orderBy(F.desc("total_spend"), "CATEGORY_TWO")
        .limit(n)
    )


def destination_list(benchmarks, category, n=20):
    return (
        benchmarks.where(is_value("CATEGORY_TWO", category))
        .select("DESTINATION", "customers", "total_spend", "market_share_pct", "spend_rank")
        .orderBy(F.desc("total_spend"), "DESTINATION")
        .limit(n)
    )


# --- pitches, affinity, scorecard, propensity ----------------------------------


def pitch_ranking(pitch, n=20):
    return (
        pitch.orderBy(F.desc("pitch_score"), "CATEGORY_TWO", "DESTINATION")
        .limit(n)
        .select(
            "CATEGORY_TWO",
            "DESTINATION",
            "customers",
            "total_spend",
            "market_share_pct",
            "penetration_pct",
            "addressable_market",
            "gap_to_leader_pct",
            round_half(F.col("avg_churn_probability") * F.lit(100.0), 1).alias("churn_risk_pct"),
            "pitch_score",
            "recommended_action",
        )
    )


def pitch_by_action(pitch):
    return pitch.groupBy("recommended_action").agg(
        F.count("*").alias("num_clients"),
        exact_sum("total_spend").alias("total_spend"),
        exact_sum("addressable_market").alias("total_addressable"),
        round_half(exact_avg("pitch_score"), 2).alias("avg_pitch_score"),
    )


def best_pitch_per_category(pitch, n=20):
    """Best-scored merchant of each category that does not already lead it."""
    columns = [
        "DESTINATION",
        "total_spend",
        "market_share_pct",
        "gap_to_leader_pct",
        "addressable_market",
        "pitch_score",
        "recommended_action",
    ]
    order = F.struct(-F.col("pitch_score"), "DESTINATION")  # a minimum combines on the map side
    return (
        pitch.where(F.col("spend_rank") > 1)
        .groupBy("CATEGORY_TWO")
        .agg(F.min_by(F.struct(*columns), order).alias("best"))
        .select("CATEGORY_TWO", "best.*")
        .orderBy(F.desc("addressable_market"), "CATEGORY_TWO")
        .limit(n)
    )


def defend_list(pitch, top_ranks=3, min_churn=0.2, n=15):
    return (
        pitch.where((F.col("spend_rank") <= top_ranks) & (F.col("avg_churn_probability") > min_churn))
        .orderBy(F.desc("high_risk_customers"), "CATEGORY_TWO", "DESTINATION")
        .limit(n)
        .select(
            "CATEGORY_TWO",
            "DESTINATION",
            "customers",
            "total_spend",
            "market_share_pct",
            round_half(F.col("avg_churn_probability") * F.lit(100.0), 1).alias("churn_risk_pct"),
            "high_risk_customers",
            "recommended_action",
        )
    )


def strongest_affinities(affinity, min_lift=1.0, n=30):
    return (
        affinity.where(F.col("lift") > min_lift).orderBy(F.desc("lift"), "category_a", "category_b").limit(n)
    )


def largest_pairs(affinity, n=15):
    """Pairs that share the most customers."""
    return (
        affinity.orderBy(F.desc("shared_customers"), "category_a", "category_b")
        .limit(n)
        .select("category_a", "category_b", "shared_customers", "lift", "pct_a_also_shops_b", "pct_b_also_shops_a")
    )


def affinity_matrix(affinity, categories):
    """Symmetric lift matrix for a given list of categories; missing pairs are 0."""
    swapped = affinity.select(
        F.col("category_b").alias("category_a"), F.col("category_a").alias("category_b"), "lift"
    )
    both = affinity.select("category_a", "category_b", "lift").unionByName(swapped)
    inside = F.col("category_a").isin(categories) & F.col("category_b").isin(categories)
    return (
        both.where(inside)
        .groupBy(F.col("category_a").alias("category"))
        .pivot("category_b", categories)
        .agg(F.max("lift"))
        .na.fill(0.0)
    )


def largest_categories(affinity, top=15):
    """Categories that occur in most pairs; ties go by name."""
    names = affinity.select(F.explode(F.array("category_a", "category_b")).alias("category"))
    return names.groupBy("category").agg(F.count("*").alias("pairs")).orderBy(F.desc("pairs"), "category").limit(top)


def affinity_cells(affinity, top=15):
    """Symmetric lift matrix of the categories in most pairs, a row per cell; missing pairs are 0."""
    largest = largest_categories(affinity, top).agg(F.sort_array(F.collect_list("category")).alias("all"))
    cells = largest.select(F.explode("all").alias("category"), "all").select("category", F.explode("all").alias("other"))
    swapped = affinity.select(F.col("category_b").alias("category"), F.col("category_a").alias("other"), "lift")
    both = affinity.select(F.col("category_a").alias("category"), F.col("category_b").alias("other"), "lift").union(swapped)
    return cells.join(both, ["category", "other"], "left").na.fill(0.0, ["lift"])


def adoption_pivot(propensity, top=15):
    """Adoption rates with segments as rows and the categories of largest potential as columns.

    At most `top` names come to the driver, to name the columns.
    """
    largest = (
        propensity.groupBy("CATEGORY_TWO")
        .agg(exact_sum("potential_revenue").alias("_potential"))
        .orderBy(F.desc("_potential"), "CATEGORY_TWO")
        .limit(top)
        .collect()
    )
    return propensity_pivot(propensity, [r["CATEGORY_TWO"] for r in largest])


def cross_sell(affinity, min_lift=1.2, max_jaccard=30.0, n=15):
    """Pairs with high lift and low overlap, with the customers still missing on each side."""
    return (
        affinity.where((F.col("lift") > min_lift) & (F.col("jaccard_pct") < max_jaccard))
        .withColumn("gap_a", F.col("customers_in_a") - F.col("shared_customers"))
        .withColumn("gap_b", F.col("customers_in_b") - F.col("shared_customers"))
        .orderBy(F.desc("shared_customers"), "category_a", "category_b")
        .limit(n)
    )


def health_counts(scorecard):
    return scorecard.groupBy("health_status").agg(
        F.count("*").alias("categories"), exact_sum("total_spend").alias("total_spend")
    )


def scorecard_top(scorecard, by, n=10):
    return (
        scorecard.where(F.col(by).isNotNull())
        .orderBy(F.desc(by), "CATEGORY_TWO")
        .limit(n)
        .select("CATEGORY_TWO", by, "total_spend", "health_status")
    )


def scorecard_mix(scorecard, n=20):
    """Share of first and last segment in the n largest categories."""
    return (
        scorecard.orderBy(F.desc("total_spend"), "CATEGORY_TWO")
        .limit(n)
        .select("CATEGORY_TWO", "total_spend", "pct_champions", "pct_dormant")
    )


def top_propensity(propensity, n=20):
    return (
        propensity.where(F.col("propensity_level").isin("Very High", "High"))
        .orderBy(F.desc("potential_revenue"), "segment_name", "CATEGORY_TWO")
        .limit(n)
        .select(
            "segment_name",
            "CATEGORY_TWO",
            "adoption_rate_pct",
            "unadopted_customers",
            "potential_revenue",
            "propensity_level",
        )
    )


def propensity_heatmap(propensity, top=15):
    """Adoption rates for the categories with the largest potential."""
    largest = (
        propensity.groupBy("CATEGORY_TWO")
        .agg(exact_sum("potential_revenue").alias("_potential"))
        .orderBy(F.desc("_potential"), "CATEGORY_TWO")
        .limit(top)
    )
    return propensity.join(largest, "CATEGORY_TWO", "left_semi").select(
        "segment_name", "CATEGORY_TWO", "adoption_rate_pct"
    )


def propensity_pivot(propensity, categories):
    """Adoption rates with segments as rows and the given categories as columns."""
    return (
        propensity.where(F.col("CATEGORY_TWO").isin(categories))
        .groupBy("segment_name")
        .pivot("CATEGORY_TWO", categories)
        .agg(F.max("adoption_rate_pct"))
    )


def propensity_by_segment(propensity):
    return (
        propensity.where(F.col("propensity_level").isin("Very High", "High", "Medium"))
        .groupBy("segment_name")
        .agg(
            F.sum("unadopted_customers").alias("total_unadopted"),
            exact_sum("potential_revenue").alias("total_potential"),
        )
    )
