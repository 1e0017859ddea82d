"""Queries for sources and sinks, profiles, table health and checks of fitted models."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from spendgrid.functions.dialect import round_half
from spendgrid.operators import ml, quality
from spendgrid.operators.reports import audiences, merchants, overview
from spendgrid.plans.oracle import mean, n_where, rnd, text
from spendgrid.plans.queries_core import _monthly_drop, _scratch, _DROP
from spendgrid.plans.registry import OTHER_CLIENTS, add
from spendgrid.sources import ingest, jdbc, tables
from spendgrid.sources.schemas import TRANSACTIONS, schema_diff

# --- sources and sinks ----------------------------------------------------------


def _stored_raw(w):
    """The raw tables written as one folder each."""
    folder, raw = _scratch(w, "raw"), w.raw
    raw.transactions.write.parquet(f"{folder}/transaction_data")
    raw.snapshots.write.parquet(f"{folder}/base_data")
    for name, lookup in raw.lookups.items():
        lookup.write.parquet(f"{folder}/{name}")
    return tables.load_raw(w.spark, folder)


add("source_load_raw", lambda w: _stored_raw(w).transactions, "select * from raw_txn")
add("source_load_snapshots", lambda w: _stored_raw(w).snapshots, "select * from raw_base")


def _csv_roundtrip(w):
    """Test target, dry run and production target of the CSV writer; reads back what production has."""
    test, live = _scratch(w, "csv_test"), _scratch(w, "csv_live")
    tables.write_csv(w.geo_summary, test, live, dry_run=True)
    path = tables.write_csv(w.geo_summary, test, live, test=False)
    return w.spark.read.option("header", True).schema(w.geo_summary.schema).csv(path)


add("sink_csv", _csv_roundtrip, "select * from geo")


def _monthly_parquet(w):
    path = ingest.write_monthly_parquet(_monthly_drop(w), _scratch(w, "monthly"))
    return w.spark.read.parquet(path)


add("sink_monthly_parquet", _monthly_parquet, f"select * from {_DROP}")


def _limited_drop(w):
    """Row-limit mode of the ingestion: ten rows, all of them rows of the file."""
    whole = _monthly_drop(w)
    some = ingest.read_monthly_csv(w.spark, whole.inputFiles()[0].rsplit("/", 1)[0], limit=10)
    return some.agg(F.count("*").alias("row_count"), F.count_if(F.col("cust_id_reg_no").isNull()).alias("not_read"))


add("ingest_row_limit", _limited_drop, f"select least(10, count(*)) as row_count, 0::bigint as not_read from {_DROP}")
add(
    "source_schema_diff",
    lambda w: schema_diff(w.spark, w.transactions.schema, TRANSACTIONS),
    "select column_name, case when r and t then 'both' when t then 'actual only' else 'expected only' end as side from ("
    "select column_name, bool_or(src = 't') as t, bool_or(src = 'r') as r from ("
    "select column_name, 't' as src from (describe select * from txn) union all "
    "select column_name, 'r' from (describe select * from raw_txn)) group by 1)",
)
add(
    "source_preview",
    lambda w: tables.preview(w.benchmarks.orderBy("CATEGORY_TWO", "spend_rank", "DESTINATION"), 5),
    "select * from bench order by CATEGORY_TWO, spend_rank, DESTINATION limit 5",
)


def _catalog_check(w):
    """Which of a present and two absent tables the session catalog lacks."""
    w.geo_summary.createOrReplaceTempView("catalog_check_geo")
    missing = jdbc.missing_in_catalog(w.spark, ["catalog_check_geo", "catalog_check_a", "catalog_check_b"])
    return w.geo_summary.agg(F.count("*").alias("row_count")).select("row_count", F.explode(F.array(*map(F.lit, missing))).alias("missing"))


add(
    "source_catalog_check",
    _catalog_check,
    "select (select count(*) from geo) as row_count, unnest(['catalog_check_a', 'catalog_check_b']) as missing",
)

# Layer of each table in the health report, and its relation in the checks.
HEALTH = {
    "staging": {"transactions": "txn", "customers": "cust"},
    "analytics": {
        "rfm_features": "rfm",
        "rfm_scores": "scores",
        "customer_category_spend": "ccs",
        "destination_metrics": "metrics",
    },
    "marts": {
        "segments": "seg",
        "cluster_profiles": "profiles",
        "cluster_summary": "summary",
        "behavioral_summary": "behav",
        "geo_summary": "geo",
        "churn": "churn",
        "monthly_trends": "trends",
        "demographic_summary": "demo",
        "benchmarks": "bench",
    },
}


def _health(w):
    """Rows of every table as counted by its write; the benchmarks are a view of the merchant metrics."""
    count = lambda t: w.measures("destination_metrics")[t] if t == "benchmarks" else w.measures(t)["row_count"]
    return quality.measured_health(w.spark, {layer: {t: count(t) for t in names} for layer, names in HEALTH.items()})


add(
    "report_table_health",
    _health,
    " union all ".join(
        f"select '{layer}' as layer, '{t}' as table_name, count(*) as row_count, "
        f"case when count(*) > 0 then 'populated' else 'empty' end as status from {rel}"
        for layer, names in HEALTH.items()
        for t, rel in names.items()
    ),
)
_LISTED = {t: rel for names in HEALTH.values() for t, rel in names.items() if t != "benchmarks"}
add(
    "report_count_listing",
    lambda w: quality.count_listing(w.spark, {t: w.measures(t)["row_count"] for t in _LISTED}),
    " union all ".join(f"select '{t}' as table_name, count(*) as row_count, format('{{:,}}', count(*)) as row_label from {rel}" for t, rel in _LISTED.items()),
)


def _json_of_all(w):
    """Every mart as JSON lines; rows read back per table."""
    marts = {t: w.table(t) for t in HEALTH["marts"]}
    paths = tables.export_json(marts, _scratch(w, "json_all"))
    return tables.table_overview(w.spark, {t: w.spark.read.schema(marts[t].schema).json(p) for t, p in paths.items()})


add(
    "sink_json_export_all",
    _json_of_all,
    " union all ".join(
        f"select '{t}' as table_name, (select count(*) from {rel}) as row_count, "
        f"(select count(*) from (describe select * from {rel})) as column_count"
        for t, rel in HEALTH["marts"].items()
    ),
)

# --- profiles and matrices ------------------------------------------------------

for _band in ("gender_label", "age_group", "income_group"):
    add(
        f"report_values_{_band}",
        lambda w, band=_band: overview.value_counts(w.customers, band),
        f"select {_band}, count(*) as customers from cust group by all",
    )
add(
    "report_income_range",
    lambda w: overview.income_range(w.customers),
    f"""select min(estimated_income) as min_inc, max(estimated_income) as max_inc,
      {rnd(mean('estimated_income'))} as avg_inc from cust where estimated_income > 0""",
)
for _band in ("gender_label", "age_group"):
    add(
        f"report_pattern_audience_{_band}",
        lambda w, band=_band: audiences.pattern_audience(w.customer_category_spend, w.customers, OTHER_CLIENTS, band),
        f"""select {_band}, count(distinct UNIQUE_ID) as customers from ccs join cust using (UNIQUE_ID)
          where upper(DESTINATION) like upper({text(OTHER_CLIENTS)}) group by all""",
    )
add(
    "report_affinity_cells",
    lambda w: merchants.affinity_cells(w.category_affinity),
    """with both_ways as (select category_a as category, category_b as other, lift from affinity union all
      select category_b, category_a, lift from affinity),
      largest as (select category from both_ways group by 1 order by count(*) desc, category limit 15)
      select a.category, b.category as other, coalesce(lift, 0) as lift from largest a join largest b on true
      left join both_ways w on w.category = a.category and w.other = b.category""",
)
add(
    "report_adoption_pivot",
    lambda w: merchants.adoption_pivot(w.category_propensity).unpivot("segment_name", None, "CATEGORY_TWO", "adoption_rate_pct").where(
        "adoption_rate_pct IS NOT NULL"
    ),
    """select segment_name, CATEGORY_TWO, max(adoption_rate_pct) as adoption_rate_pct from propensity
      where CATEGORY_TWO in (select CATEGORY_TWO from propensity group by all
        order by sum(potential_revenue) desc, CATEGORY_TWO limit 15) group by all""",
)
_FEATURES_LONG = " union all ".join(f"select '{f}' as feature" for f in ml.SEGMENT_FEATURES)
add(
    "report_centroid_pivot",
    lambda w: ml.centroid_pivot(ml.centroid_table(w.clustered)),
    " union all ".join(
        f"select '{f}' as feature, "
        + ", ".join(f"{rnd(mean(f'case when m_score = {i} then {f} end'), 2)} as cluster_{i}" for i in range(1, 6))
        + " from scores"
        for f in ml.SEGMENT_FEATURES
    ),
)

# --- fitted models --------------------------------------------------------------
# The fits have no counterpart in SQL; what must hold for any right fit has one.


def _segment_checks(w):
    """One row per customer, five named ranks by mean spend, every row at its nearest centre."""
    centres = w.model("segments").stages[-1].clusterCenters()
    x = vector_to_array("features")
    distances = [ml.squared_distance(x, F.array(*[F.lit(float(v)) for v in c])) for c in centres]
    own = F.element_at(F.array(*distances), F.col("centroid_id") + 1)
    nearest = w.clustered.agg(F.count_if(own > F.least(*distances) + 1e-9).alias("not_nearest"))
    spend = w.segments.groupBy("cluster_id", "segment_name").agg(F.avg("val_trns").alias("spend"), F.count("*").alias("n"))
    ranks = F.sort_array(F.collect_list(F.struct("cluster_id", "spend")))
    falls = F.forall(F.zip_with(ranks, F.slice(ranks, 2, 10), lambda a, b: a["spend"] >= b["spend"]), lambda ok: F.coalesce(ok, F.lit(True)))
    rows = spend.agg(F.sum("n").alias("row_count"), F.count("*").alias("clusters"), falls.alias("ranked_by_spend"))
    people = w.segments.agg(F.count_distinct("UNIQUE_ID").alias("customers"))
    return rows.join(people, F.lit(True)).join(nearest, F.lit(True))


add(
    "check_model_segments",
    _segment_checks,
    "select count(*) as row_count, 5::bigint as clusters, true as ranked_by_spend, count(distinct UNIQUE_ID) as customers, "
    "0::bigint as not_nearest from scores",
    modelled=True,
)


def _churn_checks(w):
    """One row per scored customer; levels are the bands of the probability, labels its half."""
    p = F.col("churn_probability")
    band = F.when(p >= 0.8, "Critical").when(p >= 0.6, "High").when(p >= 0.4, "Medium").when(p >= 0.2, "Low").otherwise("Stable")
    return w.churn.agg(
        F.count("*").alias("row_count"),
        F.count_distinct("UNIQUE_ID").alias("customers"),
        F.count_if(~p.between(0, 1)).alias("outside"),
        F.count_if(F.col("churn_risk_level") != band).alias("wrong_level"),
        F.count_if((F.abs(p - 0.5) > 1e-4) & (F.col("predicted_label") != (p > 0.5).cast("bigint"))).alias("wrong_label"),
    )


add(
    "check_model_churn",
    _churn_checks,
    "select count(*) as row_count, count(distinct UNIQUE_ID) as customers, 0::bigint as outside, 0::bigint as wrong_level, "
    "0::bigint as wrong_label from churn",
    modelled=True,
)
add(
    "check_model_clv_tiers",
    lambda w: w.clv.groupBy("clv_tier").agg(F.count("*").alias("customers"), F.count_if(F.col("predicted_clv") < 0).alias("negative")),
    "select clv_tier, count(*) as customers, 0::bigint as negative from clv group by all",
    modelled=True,
)
add(
    "check_model_fits",
    lambda w: ml.fit_checks(w.model("churn"), w.churn_training, w.model("clv"), w.clv_training),
    "select 'churn' as model, true as at_optimum union all select 'clv', true",
    modelled=True,
)


def _metric_ranges(w):
    """Metrics within the values they can take, curves and elbow complete and in order."""
    churn = ml.evaluate_churn(w.model("churn"), w.churn_training)
    clusters, clv = ml.evaluate_clusters(w.clustered), ml.evaluate_clv(w.model("clv"), w.clv_training)
    shares = ["accuracy", "precision", "recall", "f1_score", "roc_auc"]
    parts = [
        churn.select(F.lit("churn").alias("what"), F.forall(F.array(*shares), lambda v: v.between(0, 1)).alias("fine")),
        clusters.select(F.lit("clusters"), (F.col("davies_bouldin_index") > 0) & F.col("silhouette").between(-1, 1)),
        clv.select(F.lit("clv"), (F.col("r2_score") <= 1) & (F.col("mean_absolute_error") >= 0)),
        ml.training_curve(w.spark, w.model("churn")).agg(F.count_if(F.col("improvement") > 1e-4) == 0).select(F.lit("churn curve"), "*"),
        ml.elbow(w.rfm_scores, range(3, 9)).agg((F.count("*") == 6) & (F.min("mean_squared_distance") > 0)).select(F.lit("elbow"), "*"),
        ml.centroid_table(w.clustered).agg(F.count("*") == 5 * len(ml.SEGMENT_FEATURES)).select(F.lit("centroids"), "*"),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out




def _curve_checks(w):
    """The cost of the segments' training, step by step: it starts, falls and never rises."""
    p = w.params
    curve = ml.segment_training_curve(w.rfm_scores, p.segments, p.kmeans_iterations, p.seed)
    return curve.agg(
        (F.count("*") >= 2).alias("has_steps"),
        F.count_if(F.col("improvement") > 0).alias("rises"),
        (F.max_by("loss", "iteration") < F.min_by("loss", "iteration")).alias("falls"),
        (F.min("loss") > 0).alias("positive"),
    )


add(
    "check_model_segment_curve",
    _curve_checks,
    "select true as has_steps, 0::bigint as rises, true as falls, true as positive",
    modelled=True,
)
add(
    "check_model_metrics",
    _metric_ranges,
    "select unnest(['churn', 'clusters', 'clv', 'churn curve', 'elbow', 'centroids']) as what, true as fine",
    modelled=True,
)
