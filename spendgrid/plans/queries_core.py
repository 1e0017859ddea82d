"""Queries for the tables, views, checks, sources and models."""

import uuid
from functools import partial

from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from spendgrid.operators import ml, partials, quality, staging, views
from spendgrid.operators.reports import overview, usage
from spendgrid.plans import oracle as o
from spendgrid.plans.oracle import div, mean, n_where, percent, rnd, text, texts, total
from spendgrid.plans.registry import CHURN_MEAN, RISKY, add
from spendgrid.session import release
from spendgrid.sources import ingest, samples
from spendgrid.sources.order_tables import read_table
from spendgrid.sources.tables import delete, export_json, table_overview, write_table
from spendgrid.streaming import incremental, ledger

SOURCE_TABLES = ["lineitem", "orders", "customer", "part", "supplier", "nation", "region", "events"]
JOBS_SINCE = "2024-01-08 00:00:00"


def _table(name, table, sql):
    add(name, lambda w: w.table(table), sql)


def _scratch(w, name):
    return w.scratch(f"{name}-{uuid.uuid4().hex[:8]}")


# --- tables ---------------------------------------------------------------------

add("raw_transactions", lambda w: w.raw.transactions, "select * from raw_txn")
add("raw_snapshots", lambda w: w.raw.snapshots, "select * from raw_base")
for _name, _tbl, _rel in [
    ("stage_transactions", "transactions", "txn"),
    ("stage_customers", "customers", "cust"),
    ("rfm_features", "rfm_features", "rfm"),
    ("rfm_scores", "rfm_scores", "scores"),
    ("customer_category_spend", "customer_category_spend", "ccs"),
    ("destination_metrics", "destination_metrics", "metrics"),
    ("destination_benchmarks", "benchmarks", "bench"),
    ("segments", "segments", "seg"),
    ("churn_training_set", "churn_training", "churn_train"),
    ("clv_training_set", "clv_training", "clv_train"),
    ("churn_risk", "churn", "churn"),
    ("customer_clv", "clv", "clv"),
    ("cluster_profiles", "cluster_profiles", "profiles"),
    ("cluster_summary", "cluster_summary", "summary"),
    ("behavioral_summary", "behavioral_summary", "behav"),
    ("geo_summary", "geo_summary", "geo"),
    ("monthly_trends", "monthly_trends", "trends"),
    ("demographic_summary", "demographic_summary", "demo"),
    ("cohort_retention", "cohort_retention", "cohort"),
    ("category_affinity", "category_affinity", "affinity"),
    ("category_scorecard", "category_scorecard", "scorecard"),
    ("pitch_opportunities", "pitch_opportunities", "pitch"),
    ("churn_explained", "churn_explained", "explained"),
    ("churn_rules", "churn_rules", "rules"),
    ("spend_momentum", "momentum", "mom"),
    ("category_propensity", "category_propensity", "propensity"),
    ("store_loyalty", "store_loyalty", "loyalty"),
    ("store_time_patterns", "store_time_patterns", "timepat"),
    ("client_segment_mix", "client_segment_mix", "segmix"),
    ("audience_members", "audience_members", "members"),
    ("audience_catalog", "audience_catalog", "catalog"),
    ("audience_client_overlap", "audience_client_overlap", "overlap"),
]:
    _table(_name, _tbl, f"select * from {_rel}")
add("churn_features_current", lambda w: w.churn_features, "select * exclude (spend_trend) from act")
add(
    "date_bounds",
    lambda w: w.transactions.agg(F.max("EFF_DATE").alias("max_date")).withColumn(
        "start_date", F.add_months("max_date", -w.params.window_months)
    ),
    "select d as max_date, m12 as start_date from bounds",
)

# --- views ----------------------------------------------------------------------

add(
    "view_executive_summary",
    lambda w: views.executive_summary(w.spark, w.customers, w.transactions, w.segments, w.benchmarks, w.churn),
    f"""select (select count(*) from cust) as total_customers, (select count(*) from txn) as total_transactions,
      (select {total('val_trns')} from seg) as total_spend,
      (select count(distinct DESTINATION) from bench) as total_destinations,
      (select count(*) from seg where cluster_id = 1) as champion_customers,
      (select {rnd(total('val_trns'))} from seg where cluster_id = 1) as champion_spend,
      (select count(*) from churn where {RISKY}) as at_risk_customers,
      (select {rnd(total('total_spend'))} from churn where {RISKY}) as at_risk_spend""",
)
add(
    "view_dashboard_overview",
    lambda w: views.dashboard_overview(w.spark, w.customers, w.transactions, w.segments, w.benchmarks, w.churn),
    """select (select count(*) from txn) as total_transactions, (select count(*) from cust) as total_customers,
      (select count(*) from seg) as segmented_customers, (select count(*) from churn) as churn_scored,
      (select count(distinct DESTINATION) from bench) as destinations""",
)
add(
    "view_customer_segments",
    lambda w: views.customer_segments(w.segments),
    f"""select segment_name, count(*) as customers, {percent('count(*)', '(select count(*) from seg)')} as pct_customers,
      {rnd(total('val_trns'))} as total_spend,
      {percent(total('val_trns'), f"(select {total('val_trns')} from seg)")} as pct_revenue,
      {rnd(mean('val_trns'))} as avg_spend, {rnd(mean('nr_trns', 0))} as avg_transactions,
      {rnd(mean('lst_trns_days', 0))} as avg_recency_days, {rnd(mean('active_destinations', 0), 1)} as avg_merchants,
      {rnd(mean('active_months', 0), 1)} as avg_active_months from seg group by segment_name""",
)
add(
    "view_churn_risk_summary",
    lambda w: views.churn_risk_summary(w.churn),
    f"""select churn_risk_level, count(*) as customers,
      {percent('count(*)', '(select count(*) from churn)')} as pct_of_total, {CHURN_MEAN} as avg_churn_pct,
      {rnd(total('total_spend'))} as total_spend_at_risk, {rnd(mean('total_spend'))} as avg_spend,
      {rnd(mean('days_since_last', 0))} as avg_days_since_last, {rnd(mean('txns_last_3m', 0), 1)} as avg_recent_txns
      from churn group by churn_risk_level""",
)
add(
    "view_geo_insights",
    lambda w: views.geo_insights(w.geo_summary),
    f"""select g.*, {percent('g.total_spend', f'''(select sum(h.total_spend) from geo h
      where h.CATEGORY_TWO = g.CATEGORY_TWO)''')} as pct_of_category from geo g""",
)
_WEEKEND_SHARE = "NR_TRNS_WEEKEND * 100::double / (NR_TRNS_WEEKEND + NR_TRNS_WEEK)::double"
add(
    "view_dashboard_segments",
    lambda w: views.dashboard_segments(w.segments, w.cluster_summary),
    f"""select s.*, m.top_age_group, m.top_income_group, m.business_description, m.recommended_action from (
      select segment_name, count(*) as customers, {rnd(mean('val_trns'))} as avg_spend,
        {rnd(mean('nr_trns', 0))} as avg_txns, {rnd(mean('lst_trns_days', 0))} as avg_recency_days,
        {rnd(mean('active_destinations', 0), 1)} as avg_merchants, {rnd(mean('active_months', 0), 1)} as avg_active_months,
        {rnd(f"sum(cast({_WEEKEND_SHARE} as decimal(28,10)))::double / count(*)::double", 1)} as pct_weekend,
        {rnd(mean('age'), 1)} as avg_age, {rnd(mean('estimated_income'))} as avg_income,
        {percent(n_where("gender_label = 'Female'"), 'count(*)')} as pct_female from seg group by segment_name) s
      join summary m using (segment_name)""",
)
add(
    "view_dashboard_churn",
    lambda w: views.dashboard_churn(w.churn, w.segments, w.churn_explained, w.clv, w.momentum),
    """select c.UNIQUE_ID, c.churn_risk_level, c.churn_probability, c.total_spend, c.days_since_last, c.age,
      c.age_group, c.gender_label, c.income_group, s.segment_name, e.reason_1, e.reason_2, e.reason_3, v.clv_tier,
      v.predicted_clv, v.historical_spend, m.momentum_status, m.spend_change_pct, m.urgency_score
      from churn c left join seg s on s.UNIQUE_ID = c.UNIQUE_ID left join explained e on e.UNIQUE_ID = c.UNIQUE_ID
      left join clv v on v.UNIQUE_ID = c.UNIQUE_ID left join mom m on m.UNIQUE_ID = c.UNIQUE_ID""",
)
add(
    "view_client_pitch_flat",
    lambda w: views.client_pitch_flat(w.benchmarks, w.store_loyalty, w.store_time_patterns),
    f"""select b.* exclude (transactions), {', '.join('l.' + c for c in views._LOYALTY)},
      {', '.join('t.' + c for c in views._TIME)}
      from bench b left join loyalty l on l.CATEGORY_TWO = b.CATEGORY_TWO and l.DESTINATION = b.DESTINATION
      left join timepat t on t.CATEGORY_TWO = b.CATEGORY_TWO and t.DESTINATION = b.DESTINATION""",
)
add(
    "view_client_segment_mix",
    lambda w: views.client_segment_view(w.client_segment_mix, w.cluster_summary),
    """select m.*, s.business_description, s.recommended_action, s.cluster_id as segment_order
      from segmix m left join summary s using (segment_name)""",
)
add(
    "view_pitch_internal",
    lambda w: views.pitch_internal(w.benchmarks),
    "select *, DESTINATION as display_name, 'internal' as view_mode from bench",
)
add(
    "view_pitch_external",
    lambda w: views.pitch_external(w.benchmarks),
    """select *, case spend_rank when 1 then 'Market Leader (#1)' else printf('Competitor #%d', spend_rank) end
      as display_name, 'external' as view_mode from bench""",
)


def _view_by_name(w, name="v_monthly_trends"):
    views.register_views(w, [name])
    return w.spark.table(name)


add("view_by_name", _view_by_name, "select * from trends")
# Presentation name -> relation of the check.
_VIEW_RELATIONS = {
    "v_spend_share": "bench",
    "v_demographics": "demo",
    "v_monthly_trends": "trends",
    "v_churn_detail": "churn",
    "v_behavioral": "behav",
    "v_cluster_profiles": "profiles",
    "v_cohort_retention": "cohort",
    "v_category_affinity": "affinity",
    "v_category_scorecard": "scorecard",
    "v_pitch_opportunities": "pitch",
    "v_spend_momentum": "mom",
    "v_churn_explained": "explained",
    "v_category_propensity": "propensity",
    "v_customer_clv": "clv",
    "v_cluster_summary": "summary",
    "v_audience_catalog": "catalog",
    "v_audience_client_overlap": "overlap",
}
for _name, _rel in _VIEW_RELATIONS.items():
    add(_name, partial(_view_by_name, name=_name), f"select * from {_rel}")

# --- usage ----------------------------------------------------------------------

_JOBS = f"""(select 'job-' || event_id as job_id, cast(ts as date) as day, user_id, event_type,
      cast(floor(value * 1e9::double) as bigint) as bytes, event_id * 37 % 100000 as slot_ms,
      substr('SELECT ' || event_type || ' FROM marts.t WHERE props = ''' || props || '''', 1, 80) as query_preview
      from events where ts >= timestamp '{JOBS_SINCE}' and event_type not in ('signup', 'error')
        and event_id % 50 <> 0)"""
_GB, _TB = "1073741824::double", "1099511627776::double"


def _scan(bytes_, unit, dp, price=None):
    return rnd(f"{bytes_}::double / {unit}" + (f" * {price}::double" if price else ""), dp)


def _jobs(w):
    return usage.finished_jobs(samples.job_log(w.spark, w.folder), JOBS_SINCE)


add(
    "usage_totals",
    lambda w: usage.usage_totals(_jobs(w)),
    f"""select count(*) as total_jobs, {_scan('sum(bytes)', _GB, 2)} as total_gb_scanned,
      {_scan('sum(bytes)', _TB, 4)} as total_tb_scanned, {_scan('sum(bytes)', _TB, 2, 6.25)} as estimated_cost_usd,
      {rnd('sum(slot_ms)::double / 1000::double / 3600::double', 2)} as total_slot_hours from {_JOBS}""",
)
add(
    "usage_by_day",
    lambda w: usage.usage_by_day(_jobs(w)),
    f"""select day, count(*) as queries, {_scan('sum(bytes)', _GB, 2)} as gb_scanned,
      {_scan('sum(bytes)', _TB, 2, 6.25)} as est_cost_usd from {_JOBS} group by day""",
)
add(
    "usage_top",
    lambda w: usage.usage_top(_jobs(w)),
    f"""select job_id, day, {_scan('bytes', _GB, 2)} as gb_scanned, {_scan('bytes', _TB, 4, 6.25)} as est_cost_usd,
      {rnd('slot_ms / 1000::double', 1)} as slot_seconds, query_preview from {_JOBS}
      order by bytes desc, job_id limit 10""",
)
add(
    "usage_by_table",
    lambda w: usage.usage_by_table(_jobs(w)),
    f"""select dataset_id, table_id, count(*) as times_scanned, {_scan('sum(bytes)', _GB, 2)} as total_gb,
      {_scan('sum(bytes)', _TB, 2, 6.25)} as est_cost_usd from (
        select 'marts' as dataset_id, 'mart_' || (user_id % 7) as table_id, bytes from {_JOBS} union all
        select 'staging', event_type, bytes from {_JOBS})
      group by all order by total_gb desc, dataset_id, table_id limit 15""",
)

# --- quality --------------------------------------------------------------------

_COUNTED = {
    "transactions": "txn",
    "customers": "cust",
    "rfm_features": "rfm",
    "rfm_scores": "scores",
    "customer_category_spend": "ccs",
    "destination_metrics": "metrics",
    "segments": "seg",
    "cluster_profiles": "profiles",
    "cluster_summary": "summary",
    "behavioral_summary": "behav",
    "geo_summary": "geo",
    "churn": "churn",
    "monthly_trends": "trends",
    "demographic_summary": "demo",
    "benchmarks": "bench",
    "cohort_retention": "cohort",
    "category_affinity": "affinity",
    "category_scorecard": "scorecard",
    "pitch_opportunities": "pitch",
    "churn_explained": "explained",
    "momentum": "mom",
    "category_propensity": "propensity",
    "clv": "clv",
}
add(
    "quality_row_counts",
    lambda w: quality.row_counts({name: w.table(name) for name in _COUNTED}),
    " union all ".join(
        f"select '{name}' as table_name, count(*) as row_count from {rel}" for name, rel in _COUNTED.items()
    ),
)


def _checks(*rows):
    """SQL for check rows given as (name, scalar query, condition on v)."""
    return " union all ".join(
        f"select {text(name)} as check_name, case when {condition} then 'PASS' else 'FAIL' end as status, "
        f"v::double as detail from (select ({query}) as v)"
        for name, query, condition in rows
    )


add(
    "quality_table_checks",
    lambda w: quality.measured_checks(
        w.spark, *[w.measures(t) for t in ("cluster_profiles", "segments", "destination_metrics", "monthly_trends")]
    ),
    _checks(
        ("five segment profiles", "select count(*) from profiles", "v = 5"),
        ("no NULL segment name", f"select {n_where('segment_name is null')} from seg", "v = 0"),
        ("under 5% without age", f"select {div(n_where('age is null') + ' * 100', 'count(*)')} from seg", "v < 5"),
        (
            "every merchant has a market share",
            f"select {n_where('market_share_pct is null')} from bench",
            "v = 0",
        ),
        ("at least three months of trends", "select count(distinct month) from trends", "v >= 3"),
    ),
)
_SHARES = f"select segment_name, {percent('count(*)', '(select count(*) from seg)')} as share from seg group by all"
_BY_SPEND = "select segment_name, avg(val_trns) as a from seg group by all"
add(
    "quality_segment_checks",
    lambda w: quality.segment_checks(w.segments),
    _checks(
        ("largest segment under 40%", f"select max(share) from ({_SHARES})", "v < 40"),
        ("smallest segment over 5%", f"select min(share) from ({_SHARES})", "v > 5"),
        ("exactly five segments", "select count(distinct segment_name) from seg", "v = 5"),
        (
            "first segment spends most",
            f"select cast(segment_name = 'Champions' as int) from ({_BY_SPEND}) order by a desc limit 1",
            "v = 1",
        ),
        (
            "last segment spends least",
            f"select cast(segment_name = 'Dormant' as int) from ({_BY_SPEND}) order by a limit 1",
            "v = 1",
        ),
        (
            "all segment names known",
            f"select count(distinct segment_name) from seg where segment_name in {texts(o.SEGMENTS)}",
            "v = 5",
        ),
        ("no duplicate customers", "select count(*) - count(distinct UNIQUE_ID) from seg", "v = 0"),
    ),
)
add(
    "quality_churn_checks",
    lambda w: quality.churn_checks(w.churn),
    _checks(
        (
            "critical risk under 20%",
            f"""select {percent(n_where("churn_risk_level = 'Critical'"), 'count(*)')} from churn""",
            "v < 20",
        ),
        (
            "stable customers exist",
            "select cast(count(*) > 0 as int) from churn where churn_risk_level = 'Stable'",
            "v = 1",
        ),
    ),
)
add(
    "quality_clv_checks",
    lambda w: quality.clv_checks(w.clv),
    _checks(
        ("no negative value", f"select {n_where('predicted_clv < 0')} from clv", "v = 0"),
        ("mean value plausible", f"select {rnd(mean('predicted_clv'), 2)} from clv", "v > 100 and v < 5e6"),
        ("highest value plausible", "select max(predicted_clv) from clv", "v < 50e6"),
        ("five value tiers", "select count(distinct clv_tier) from clv", "v = 5"),
    ),
)
add(
    "quality_integrity_checks",
    lambda w: quality.integrity_checks(w.benchmarks, w.cohort_retention),
    _checks(
        (
            "market shares add up to 100",
            f"""select count(*) from (select {total('market_share_pct')} as s from bench group by CATEGORY_TWO)
              where abs(s - 100) > 2""",
            "v = 0",
        ),
        ("retention within 100%", f"select {n_where('retention_pct > 100.1')} from cohort", "v = 0"),
    ),
)


def _gap(left, key, right, value, high, low):
    return f"""select cast(avg({value}) filter (where {key} = '{high}') > avg({value}) filter (where {key} = '{low}')
      as int) from {left} a join {right} b on b.UNIQUE_ID = a.UNIQUE_ID"""


add(
    "quality_consistency_checks",
    lambda w: quality.consistency_checks(w.segments, w.churn, w.clv, w.momentum),
    _checks(
        (
            "last segment churns more than first",
            _gap("seg", "segment_name", "churn", "churn_probability", "Dormant", "Champions"),
            "v = 1",
        ),
        (
            "first segment is worth more than last",
            _gap("seg", "segment_name", "clv", "predicted_clv", "Champions", "Dormant"),
            "v = 1",
        ),
        (
            "declining customers churn more than accelerating",
            _gap("mom", "momentum_status", "churn", "churn_probability", "Declining", "Accelerating"),
            "v = 1",
        ),
    ),
)

# --- sources and sinks ----------------------------------------------------------

add(
    "source_table_overview",
    lambda w: table_overview(w.spark, {name: read_table(w.spark, w.folder, name) for name in SOURCE_TABLES}),
    " union all ".join(
        f"select '{name}' as table_name, (select count(*) from {name}) as row_count, "
        f"(select count(*) from (describe select * from {name})) as column_count"
        for name in SOURCE_TABLES
    ),
)


def _partitioned_roundtrip(w):
    """Write the trend table by month and read it back through the partitions."""
    return write_table(w.monthly_trends, _scratch(w, "trends"), ["month"], ["CATEGORY_TWO", "DESTINATION"])


add("sink_partitioned_table", _partitioned_roundtrip, "select * from trends")


def _json_roundtrip(w):
    table = w.geo_summary
    paths = export_json({"geo_summary": table}, _scratch(w, "json"))
    return w.spark.read.schema(table.schema).json(paths["geo_summary"])


add("sink_json_export", _json_roundtrip, "select * from geo")


def _monthly_drop(w):
    target = samples.write_monthly_drop(w.spark, w.folder, _scratch(w, "drop"))
    return ingest.read_monthly_csv(w.spark, target)


_DROP = f"""(select UNIQUE_ID, case when k % 53 <> 0 then cast(date '2001-07-01' + cast(k % 28 as integer) as date) end
      as EFF_DATE, sha256('id' || lower(UNIQUE_ID)) as cust_id_reg_no,
      case when k % 10 <> 0 then sha256('user' || lower(UNIQUE_ID) || '@mail.example') end as EMAIL_ADDR,
      sha256('07' || (k % 1000)) as CUST_CELL_NO, demo_1, case when k % 37 <> 0 then demo_2 end as demo_2, demo_4, demo_7
      from (select *, cast(substr(UNIQUE_ID, 2) as bigint) as k from raw_base) where month = date '2001-07-01')"""
add("ingest_monthly_csv", _monthly_drop, f"select * from {_DROP}")
add(
    "ingest_hash_check",
    lambda w: ingest.check_hashed(_monthly_drop(w)),
    " union all ".join(
        f"select '{c}' as column_name, count({c}) as checked, {n_where(f'length({c}) <> 64')} as not_hashed from {_DROP}"
        for c in ingest.PERSONAL_COLUMNS
    ),
)


def _refreshed(w, name, then=None):
    """A source folder through three runs: early days with wrong amounts, then all days put right, then unchanged.

    Days that come late, a corrected file and a file that is taken away again are among the
    changes. Returns the results of the three runs.
    """
    folder, path = _scratch(w, f"{name}-files"), f"{_scratch(w, name)}/staged"
    facts, day = w.raw.transactions, F.col("EFF_DATE")
    late = F.dayofmonth(day).isin(7, 20) & (F.month(day) % 3 == 0)
    known = (day <= F.lit("2000-12-15").cast("date")) & ~late
    wrong = known & (F.month(day) == 5)
    facts.where(known & ~wrong).write.parquet(f"{folder}/early")
    facts.where(wrong).withColumn("trns_amt", F.col("trns_amt") + 1).write.parquet(f"{folder}/may")
    facts.where(known & (F.dayofmonth(day) == 9)).withColumn("EFF_DATE", F.add_months(day, 600)).write.parquet(f"{folder}/mistake")
    run = partial(ledger.refresh, w.spark, folder, w.raw.lookups, path, then)
    first = run()
    facts.where(wrong).write.mode("overwrite").parquet(f"{folder}/may")
    facts.where(~known | day.isNull()).write.parquet(f"{folder}/late")
    delete(w.spark, f"{folder}/mistake")
    return path, [first, run(), run()]


def _incremental(w):
    """Count per month what three runs over changing files have staged."""
    return overview.monthly_volume(_refreshed(w, "incremental")[1][-1].table)


_VOLUME = f"""select txn_month as month, count(*) as transactions, count(distinct UNIQUE_ID) as customers,
      {rnd(total('trns_amt'))} as spend from txn group by all"""
add("incremental_append", _incremental, _VOLUME)


def _ledger_months(w):
    """The ledger's rows per month beside what the last run has read: nothing, as nothing had changed."""
    path, runs = _refreshed(w, "ledger")
    known = ledger.merged(ledger.Ledger(w.spark, f"{path}.ledger").entries())
    last = F.lit(len(runs[-1].scanned) + len(runs[-1].changed) + len(runs[-1].removed)).cast("bigint")
    return known.select("txn_month", F.col("rows").alias("row_count"), last.alias("read_again"))


add(
    "incremental_ledger",
    _ledger_months,
    "select txn_month, count(*) as row_count, 0::bigint as read_again from txn group by all",
)


def _incremental_spend(w):
    """Customer spend by category and merchant, merged out of monthly partials that follow the ledger."""
    kept = _scratch(w, "spend")
    _, runs = _refreshed(w, "spend-facts", partial(partials.refresh_partials, path=kept))
    p, facts = w.params, runs[-1].table
    return partials.customer_category_spend(w.spark.read.parquet(kept), facts, staging.date_bounds(facts), p.window_months)


add("incremental_customer_category_spend", _incremental_spend, "select * from ccs")


def _stored_facts(w, folder, again):
    """The raw facts with a date as files, part by part; those that are to come again lie by themselves."""
    for part in w.raw.parts():
        rows = part.where("EFF_DATE IS NOT NULL").withColumn("_again", again)
        rows.write.mode("append").partitionBy("_again").option("compression", "zstd").parquet(folder)
        del rows, part
        release(w.spark)
    return w.spark.read.schema(StructType([*w.raw.transactions.schema, StructField("_again", BooleanType())])).parquet(folder)


def _streamed(w):
    """Raw facts arriving as files, staged by two runs of the stream; some files bring known rows again.

    The joins of the facts run once and part by part; files and shuffles go as soon as nothing needs them.
    """
    incoming, path = _scratch(w, "incoming"), f"{_scratch(w, 'streamed')}/staged"
    kept, schema = _scratch(w, "stream-facts"), w.raw.transactions.schema
    run = partial(incremental.stream_stage, w.spark, incoming, w.raw.lookups, path, _scratch(w, "offsets"), schema)
    late = F.col("EFF_DATE") >= F.lit("2001-01-01").cast("date")
    again = late | (F.col("EFF_DATE") >= F.lit("2000-06-01").cast("date"))
    facts = _stored_facts(w, kept, again)
    # One file for each part: a row that a part has twice is in one file, as two purchases.
    whole = facts.where(~late).withColumn("_part", F.trunc("EFF_DATE", "year").cast("string"))
    whole.repartition("_part").select(schema.names).write.option("compression", "zstd").parquet(incoming)
    delete(w.spark, f"{kept}/_again=false")
    release(w.spark)
    run()
    facts.where("_again").select(schema.names).repartition(F.trunc("EFF_DATE", "year")).write.mode("append").option("compression", "zstd").parquet(incoming)
    delete(w.spark, kept)
    release(w.spark)
    run()
    delete(w.spark, incoming)
    return overview.monthly_volume(incremental.read_staged(w.spark, path))


add("incremental_stream", _streamed, _VOLUME)

# --- models ---------------------------------------------------------------------

add("model_segments", lambda w: w.segments, modelled=True)
add("model_segment_profiles", lambda w: w.cluster_profiles, modelled=True)
add("model_churn_risk", lambda w: w.churn, modelled=True)
add("model_customer_clv", lambda w: w.clv, modelled=True)
add("model_evaluate_clusters", lambda w: ml.evaluate_clusters(w.clustered), modelled=True)
add("model_evaluate_churn", lambda w: ml.evaluate_churn(w.model("churn"), w.churn_training), modelled=True)
add("model_evaluate_clv", lambda w: ml.evaluate_clv(w.model("clv"), w.clv_training), modelled=True)
add("model_centroids", lambda w: ml.centroid_table(w.clustered), modelled=True)
add("model_churn_training_curve", lambda w: ml.training_curve(w.spark, w.model("churn")), modelled=True)
add(
    "model_segment_training_curve",
    lambda w: ml.segment_training_curve(w.rfm_scores, w.params.segments, w.params.kmeans_iterations, w.params.seed),
    modelled=True,
)
add("model_elbow", lambda w: ml.elbow(w.rfm_scores, range(3, 9)), modelled=True)
add(
    "model_quality_checks",
    lambda w: quality.metric_checks(ml.davies_bouldin(w.clustered), quality.CLUSTER_LIMITS)
    .unionByName(
        quality.metric_checks(ml.evaluate_churn(w.model("churn"), w.churn_training), quality.CHURN_LIMITS)
    )
    .unionByName(quality.metric_checks(ml.evaluate_clv(w.model("clv"), w.clv_training), quality.CLV_LIMITS)),
    modelled=True,
)
