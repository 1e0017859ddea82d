"""Queries for the parameterised reports."""

from pyspark.sql import functions as F

from spendgrid.functions.labels import WALLET_BANDS
from spendgrid.operators.reports import audiences as audience_reports, customers as customer_reports, merchants as merchant_reports, overview
from spendgrid.params import SMALL_DATA
from spendgrid.plans import oracle as o
from spendgrid.plans.oracle import mean, n_where, percent, rnd, text, texts, total
from spendgrid.plans.registry import (
    CATEGORY,
    CHURN_MEAN,
    CLIENT,
    IN_CATEGORY,
    OF_CLIENT,
    OTHER_CLIENTS,
    RISKY,
    SECOND_CATEGORY,
    add,
)

# --- overview reports -----------------------------------------------------------

add(
    "report_data_overview",
    lambda w: overview.data_overview(w.transactions),
    f"""select count(*) as total_transactions, count(distinct UNIQUE_ID) as unique_customers,
      min(EFF_DATE) as earliest_date, max(EFF_DATE) as latest_date,
      date_diff('month', min(EFF_DATE), max(EFF_DATE)) as months_of_data, {rnd(total('trns_amt'))} as total_spend,
      {rnd(mean('trns_amt'), 2)} as avg_transaction, count(distinct CATEGORY_TWO) as distinct_categories,
      count(distinct DESTINATION) as distinct_destinations, count(distinct PROVINCE) as distinct_provinces from txn""",
)
add(
    "report_top_categories",
    lambda w: overview.top_categories(w.transactions),
    f"""select CATEGORY_TWO, count(*) as transactions, count(distinct UNIQUE_ID) as customers,
      {rnd(total('trns_amt'))} as total_spend, {rnd(mean('trns_amt'), 2)} as avg_txn from txn
      where CATEGORY_TWO is not null group by all order by total_spend desc, CATEGORY_TWO limit 20""",
)
add(
    "report_top_destinations",
    lambda w: overview.top_destinations(w.transactions),
    f"""select DESTINATION, CATEGORY_TWO, count(distinct UNIQUE_ID) as customers,
      {rnd(total('trns_amt'))} as total_spend, {rnd(mean('trns_amt'), 2)} as avg_txn from txn
      where DESTINATION is not null group by all order by total_spend desc, DESTINATION, CATEGORY_TWO limit 20""",
)
add(
    "report_customer_profile",
    lambda w: overview.customer_profile(w.customers),
    f"""select count(*) as total_customers, {rnd(mean('age'), 1)} as avg_age,
      {rnd(mean('estimated_income'))} as avg_income, {n_where('gender = 0')} as males, {n_where('gender = 1')} as females,
      {n_where('main_banked = 1')} as main_banked, {n_where('age is null')} as null_age,
      {n_where('estimated_income is null')} as null_income from cust""",
)
for _band in ("age_group", "income_group"):
    add(
        f"report_{_band}s",
        lambda w, band=_band: overview.band_distribution(w.customers, band),
        f"select {_band}, count(*) as customers from cust where {_band} <> 'Unknown' group by all",
    )
_NULLABLE = ["UNIQUE_ID", "EFF_DATE", "trns_amt", "CATEGORY_TWO", "DESTINATION", "PROVINCE", "MUNICIPALITY", "trns_hour"]
add(
    "report_null_profile",
    lambda w: overview.null_profile(w.transactions, _NULLABLE),
    " union all ".join(
        f"select count(*) as total_rows, '{c}' as column_name, {n_where(f'{c} is null')} as null_count, "
        f"{percent(n_where(f'{c} is null'), 'count(*)', 2)} as null_pct from txn"
        for c in _NULLABLE
    ),
)
add(
    "report_monthly_volume",
    lambda w: overview.monthly_volume(w.transactions),
    f"""select txn_month as month, count(*) as transactions, count(distinct UNIQUE_ID) as customers,
      {rnd(total('trns_amt'))} as spend from txn group by all""",
)
add(
    "report_analysis_window",
    lambda w: overview.analysis_window(w.transactions, w.as_of),
    """select min(EFF_DATE) as data_from, max(EFF_DATE) as data_to,
      date_diff('day', min(EFF_DATE), max(EFF_DATE)) as days_span, strftime(min(EFF_DATE), '%d %b %Y') as from_str,
      strftime(max(EFF_DATE), '%d %b %Y') as to_str,
      strftime((select m12 from bounds), '%d %b %Y') as analysis_from_str from yr""",
)

# --- feature reports ------------------------------------------------------------


def _feature_stats_sql(feature):
    value = f"({feature})::double"
    moment = (
        f"sqrt((count(*)::hugeint * sum({o.units(feature)}::hugeint * {o.units(feature)}) - "
        f"sum({o.units(feature)})::hugeint * sum({o.units(feature)}))::double / "
        f"(count(*)::double * (count(*)::double - 1))) / 100::double"
    )
    return f"""select '{feature}' as feature, {rnd(mean(value), 2)} as mean, {rnd(moment, 2)} as std,
      quantile_disc({value}, 0.5) as median, {rnd(f'min({value})', 2)} as min_val, {rnd(f'max({value})', 2)} as max_val,
      {rnd(f'quantile_disc({value}, 0.25)', 2)} as q25, {rnd(f'quantile_disc({value}, 0.75)', 2)} as q75,
      {rnd(f'quantile_disc({value}, 0.75) - quantile_disc({value}, 0.25)', 2)} as iqr from rfm"""


add(
    "report_feature_stats",
    lambda w: overview.feature_stats(w.rfm_features, accuracy=w.params.quartile_accuracy),
    " union all ".join(_feature_stats_sql(f) for f in overview.FEATURES),
)
add(
    "report_feature_correlations",
    lambda w: overview.feature_correlations(w.rfm_features),
    "select "
    + ", ".join(f"{rnd(f'corr({a}, {b})', 3)} as {name}" for name, (a, b) in overview.CORRELATIONS.items())
    + " from rfm",
)
add(
    "report_outliers",
    lambda w: overview.outlier_counts(w.rfm_features),
    "select count(*) as total_customers, "
    + ", ".join(
        f"{n_where(f'{c} > (select avg({c}) + 3 * stddev_samp({c}) from rfm)')} as {name}"
        for c, name in [("val_trns", "spend_outliers"), ("nr_trns", "freq_outliers"), ("avg_val", "avg_val_outliers")]
    )
    + " from rfm",
)
add(
    "report_quintiles",
    lambda w: overview.quintile_distribution(w.rfm_scores),
    " union all ".join(
        f"select '{name}' as dimension, {c} as score, count(*) as customers from scores group by {c}"
        for c, name in [("r_score", "Recency"), ("f_score", "Frequency"), ("m_score", "Monetary")]
    ),
)
add(
    "report_feature_sample",
    lambda w: overview.sample_rows(w.rfm_features, 50_000),
    f"select {', '.join(overview.FEATURES)} from rfm order by md5('42:' || UNIQUE_ID), UNIQUE_ID limit 50000",
)
add(
    "report_feature_small_sample",
    lambda w: overview.sample_rows(w.rfm_features, 100, columns=["UNIQUE_ID", *overview.FEATURES]),
    f"select UNIQUE_ID, {', '.join(overview.FEATURES)} from rfm order by md5('42:' || UNIQUE_ID), UNIQUE_ID limit 100",
)

# --- merchant reports -----------------------------------------------------------

_KPIS = (
    "customers, transactions, total_spend, avg_txn_value, spend_per_customer, market_share_pct, penetration_pct, spend_rank"
)


def _default_client_kpis(w):
    category, client = merchant_reports.pick_default_client(w.benchmarks)
    return merchant_reports.client_kpis(w.benchmarks, category, client).withColumn("DESTINATION", F.lit(client))


add(
    "report_default_client_kpis",
    _default_client_kpis,
    f"""select {_KPIS}, DESTINATION from bench where CATEGORY_TWO = (select CATEGORY_TWO from bench group by all
      order by sum(total_spend) desc, CATEGORY_TWO limit 1) order by total_spend desc, DESTINATION limit 1""",
)
add(
    "report_client_kpis",
    lambda w: merchant_reports.client_kpis(w.benchmarks, CATEGORY, CLIENT),
    f"select {_KPIS} from bench where {IN_CATEGORY} and {OF_CLIENT}",
)
add(
    "report_wallet_summary",
    lambda w: merchant_reports.wallet_summary(w.customer_category_spend, CATEGORY, CLIENT),
    f"""select count(distinct UNIQUE_ID) as category_customers, {n_where(OF_CLIENT)} as client_customers,
      {percent(n_where(OF_CLIENT), 'count(distinct UNIQUE_ID)')} as penetration,
      {rnd(mean(f'case when {OF_CLIENT} then share_of_wallet_pct end', 1), 1)} as avg_share,
      {rnd(total('dest_spend', where=OF_CLIENT))} as total_client_spend,
      {rnd(total('dest_spend'))} as total_category_spend from ccs where {IN_CATEGORY}""",
)
add(
    "report_wallet_bands",
    lambda w: merchant_reports.wallet_bands(w.customer_category_spend, CATEGORY, CLIENT),
    f"""select {o.ladder('share_of_wallet_pct', WALLET_BANDS, '>=')} as wallet_band, count(*) as customers,
      {rnd(total('dest_spend'))} as client_spend from ccs where {IN_CATEGORY} and {OF_CLIENT} group by all""",
)
_COMPETITORS = f"""select case when {OF_CLIENT} then DESTINATION else 'Competitor ' || pos end as display_name,
      case when {OF_CLIENT} then 'Client' else 'Competitor' end as entity_type, customers, total_spend,
      market_share_pct, penetration_pct, spend_per_customer, avg_txn_value
      from (select *, row_number() over (partition by {OF_CLIENT} order by total_spend desc, DESTINATION) as pos
        from bench where {IN_CATEGORY}) where pos <= 5"""
add(
    "report_competitors",
    lambda w: merchant_reports.benchmark_vs_competitors(w.benchmarks, CATEGORY, CLIENT, 5),
    _COMPETITORS,
)
add(
    "report_share_verdict",
    lambda w: merchant_reports.share_verdict(w.benchmarks, CATEGORY, CLIENT, 5),
    f"""select s as client_share, {rnd('m', 1)} as competitor_mean, case when s > m then 'leads' else 'trails' end
      as verdict from (select max(case when entity_type = 'Client' then market_share_pct end) as s,
        {mean("case when entity_type = 'Competitor' then market_share_pct end")} as m from ({_COMPETITORS}))""",
)
add(
    "report_client_trend",
    lambda w: merchant_reports.client_vs_category_trend(w.monthly_trends, CATEGORY, CLIENT),
    f"""select month, cast(sum(txn_count) as bigint) as category_txns,
      cast(sum(customer_count) as bigint) as category_customers, {total('total_spend', 0)} as category_spend,
      cast(coalesce(sum(txn_count) filter (where {OF_CLIENT}), 0) as bigint) as client_txns,
      cast(coalesce(sum(customer_count) filter (where {OF_CLIENT}), 0) as bigint) as client_customers,
      {o.total0('total_spend', OF_CLIENT, 0)} as client_spend,
      coalesce({percent(o.total0('total_spend', OF_CLIENT, 0), total('total_spend', 0))}, 0) as client_share_pct
      from trends where {IN_CATEGORY} group by month""",
)
add(
    "report_roi_scenarios",
    lambda w: merchant_reports.roi_scenarios(w.customer_category_spend, CATEGORY, CLIENT),
    f"""select b.*, p as percentage, cast(floor(total_customers * p / 100::double) as bigint) as new_customers,
      floor(total_customers * p / 100::double) * revenue_per_customer as new_customer_revenue,
      {rnd('total_revenue * (p / 100::double)', 2)} as extra_spend,
      {percent("floor(total_customers * p / 100::double) * revenue_per_customer + "
               + rnd('total_revenue * (p / 100::double)', 2) + " - 500000", '500000')} as roi_pct,
      case when total_revenue >= 1000000 then printf('R%.1fM', {rnd('total_revenue / 1000000::double', 1)})
        when total_revenue >= 1000 then printf('R%.1fk', {rnd('total_revenue / 1000::double', 1)})
        else printf('R%.0f', total_revenue) end as total_revenue_label
      from (select count(*) as total_customers, coalesce({rnd(total('dest_spend'))}, 0) as total_revenue,
        coalesce({rnd(mean('dest_spend'))}, 0) as revenue_per_customer
        from ccs where {IN_CATEGORY} and {OF_CLIENT}) b, (values (5), (10), (20)) v(p)""",
)
add(
    "report_provinces",
    lambda w: merchant_reports.province_rollup(w.geo_summary, CATEGORY),
    f"""select PROVINCE, cast(sum(customers) as bigint) as customers, cast(sum(transactions) as bigint) as transactions,
      {total('total_spend', 0)} as total_spend,
      {percent(total('total_spend', 0), f"(select {total('total_spend', 0)} from geo where {IN_CATEGORY})")} as pct
      from geo where {IN_CATEGORY} group by PROVINCE""",
)
add(
    "report_municipalities",
    lambda w: merchant_reports.top_municipalities(w.geo_summary, CATEGORY),
    f"""select PROVINCE, MUNICIPALITY, cast(sum(customers) as bigint) as customers,
      {total('total_spend', 0)} as total_spend from geo where {IN_CATEGORY} group by all
      order by total_spend desc, PROVINCE, MUNICIPALITY limit 15""",
)
for _name, _by in [
    ("age", ["age_group"]),
    ("gender", ["gender_label"]),
    ("income", ["income_group"]),
    ("all", ["gender_label", "age_group", "income_group"]),
]:
    add(
        f"report_demographics_{_name}",
        lambda w, by=_by: merchant_reports.demographic_rollup(w.demographic_summary, CATEGORY, by),
        f"""select {', '.join(_by)}, cast(sum(customers) as bigint) as customers, {total('total_spend', 0)} as spend
          from demo where {IN_CATEGORY} group by {', '.join(_by)}""",
    )
add(
    "report_category_list",
    lambda w: merchant_reports.category_list(w.benchmarks),
    f"""select CATEGORY_TWO, count(*) as destinations, {total('total_spend', 0)} as total_spend from bench group by all
      order by total_spend desc, CATEGORY_TWO limit 20""",
)
add(
    "report_destination_list",
    lambda w: merchant_reports.destination_list(w.benchmarks, CATEGORY),
    f"""select DESTINATION, customers, total_spend, market_share_pct, spend_rank from bench where {IN_CATEGORY}
      order by total_spend desc, DESTINATION limit 20""",
)

# --- segment, churn and value reports -------------------------------------------


def _index(column, flip=False):
    best = f"{column} / max({column}) over ()"
    return rnd(f"(1::double - {best}) * 100::double" if flip else f"{best} * 100::double")


add(
    "report_segment_radar",
    lambda w: customer_reports.segment_radar(w.cluster_profiles),
    f"""select segment_name, {_index('avg_total_spend')} as spend_index,
      {_index('avg_transactions')} as frequency_index, {_index('avg_recency_days', True)} as recency_index,
      {_index('avg_merchants')} as diversity_index, {_index('avg_active_months')} as consistency_index from profiles""",
)
add(
    "report_revenue_concentration",
    lambda w: customer_reports.revenue_concentration(w.segments),
    f"""select segment_name, count(*) as customers, {percent('count(*)', '(select count(*) from seg)')} as pct_customers,
      {rnd(total('val_trns'))} as total_spend,
      {percent(total('val_trns'), f"(select {total('val_trns')} from seg)")} as pct_revenue from seg group by all""",
)
add(
    "report_probability_bands",
    lambda w: customer_reports.probability_bands(w.churn),
    """select printf('%d-%d%%', t * 10, t * 10 + 10) as probability_band, count(*) as customers
      from (select least(9, cast(floor(churn_probability * 10000 + 0.5) as bigint) // 1000) as t from churn)
      group by t""",
)
add(
    "report_risk_by_demographics",
    lambda w: customer_reports.risk_by_demographics(w.churn),
    f"""select age_group, income_group, churn_risk_level, count(*) as customers, {CHURN_MEAN} as avg_churn_pct,
      {rnd(total('total_spend'))} as total_spend from churn where age_group is not null and income_group is not null
      group by all""",
)
add(
    "report_churn_levels",
    lambda w: customer_reports.churn_levels(w.churn),
    f"""select churn_risk_level, count(*) as customers, {CHURN_MEAN} as avg_churn_pct,
      {rnd(total('total_spend'))} as spend, {rnd(mean('days_since_last', 0))} as avg_days,
      list_position(['Critical', 'High', 'Medium', 'Low', 'Stable'], churn_risk_level) as level_order
      from churn group by churn_risk_level""",
)
add(
    "report_win_back",
    lambda w: customer_reports.win_back(w.churn),
    f"""select churn_risk_level, count(*) as customers, {rnd(mean('total_spend'))} as avg_spend,
      {rnd(total('total_spend'))} as total_spend_at_risk, {CHURN_MEAN} as avg_churn_pct from churn
      where {RISKY} and total_spend > (select {mean('total_spend')} from churn) group by all""",
)
add(
    "report_churn_reasons",
    lambda w: customer_reports.churn_reasons(w.churn_explained),
    f"""select reason_1 as reason, count(*) as customers, {CHURN_MEAN} as avg_churn_pct,
      {rnd(total('total_spend'))} as spend from explained group by all""",
)
add(
    "report_at_risk_profile",
    lambda w: customer_reports.at_risk_profile(w.churn_explained),
    f"""select count(*) as total_at_risk, {CHURN_MEAN} as avg_churn_pct, {rnd(mean('total_spend'))} as avg_spend,
      {rnd(total('total_spend'))} as total_spend_at_risk, {rnd(mean('days_since_last', 0))} as avg_days_inactive,
      {rnd(mean('txns_last_3m', 0), 1)} as avg_recent_txns, {rnd(mean('txns_prev_3m', 0), 1)} as avg_prior_txns
      from explained""",
)
add(
    "report_churn_samples",
    lambda w: customer_reports.churn_samples(w.churn_explained),
    f"""select churn_risk_level, {rnd('churn_probability * 100::double', 1)} as churn_pct,
      {rnd('spend')} as total_spend, days_since_last, reason_1, reason_2, reason_3
      from (select *, total_spend as spend from explained) where churn_risk_level = 'Critical'
      order by spend desc, UNIQUE_ID limit 10""",
)
_MOMENTUM_SQL = f"""select momentum_status, count(*) as customers, {rnd(mean('total_spend_12m'))} as avg_spend,
      {rnd(mean('spend_change_pct', 1), 1)} as avg_spend_change, {rnd(mean('urgency_score'), 2)} as avg_urgency,
      {rnd(total('total_spend_12m'))} as total_spend from mom"""
add("report_momentum_mix", lambda w: customer_reports.momentum_mix(w.momentum), _MOMENTUM_SQL + " group by all")
add(
    "report_urgent_momentum",
    lambda w: customer_reports.momentum_mix(w.momentum, ["Declining", "Slowing"]),
    _MOMENTUM_SQL + " where momentum_status in ('Declining', 'Slowing') group by all",
)
add(
    "report_accelerating",
    lambda w: customer_reports.momentum_mix(w.momentum, ["Accelerating"]),
    _MOMENTUM_SQL + " where momentum_status = 'Accelerating' group by all",
)
for _name, _tbl, _rel, _key in [
    ("momentum", "momentum", "mom", "momentum_status"),
    ("segment", "segments", "seg", "segment_name"),
]:
    add(
        f"report_churn_by_{_name}",
        lambda w, table=_tbl, key=_key: customer_reports.churn_by(w.churn, w.table(table), key),
        f"""select {_key}, {CHURN_MEAN} as avg_churn_pct, count(*) as customers
          from {_rel} x join churn k on k.UNIQUE_ID = x.UNIQUE_ID group by all""",
    )
add(
    "report_clv_by_tier",
    lambda w: customer_reports.clv_by_tier(w.clv),
    f"""select clv_tier, count(*) as customers, {rnd(mean('predicted_clv'))} as avg_clv,
      {rnd(total('predicted_clv'))} as total_projected_value, {rnd(mean('historical_spend'))} as avg_historical
      from clv group by all""",
)
add(
    "report_clv_by_segment",
    lambda w: customer_reports.clv_by_segment(w.clv, w.segments),
    f"""with j as (select s.segment_name, v.predicted_clv from seg s join clv v on v.UNIQUE_ID = s.UNIQUE_ID)
      select segment_name, count(*) as customers, {rnd(mean('predicted_clv'))} as avg_clv,
      {rnd(total('predicted_clv'))} as total_clv,
      {percent(total('predicted_clv'), f"(select {total('predicted_clv')} from j)")} as pct_of_total_value
      from j group by all""",
)
for _band in ("age_group", "income_group"):
    add(
        f"report_clv_by_{_band}",
        lambda w, band=_band: customer_reports.clv_by_band(w.clv, band),
        f"""select {_band}, count(*) as customers, {rnd(mean('predicted_clv'))} as avg_clv from clv
          where {_band} is not null group by all""",
    )
add(
    "report_value_at_risk",
    lambda w: customer_reports.value_at_risk(w.clv, w.churn),
    f"""select clv_tier, k.churn_risk_level, count(*) as customers,
      {rnd(total('predicted_clv'))} as projected_value_at_risk from clv v join churn k on k.UNIQUE_ID = v.UNIQUE_ID
      where clv_tier in ('Platinum', 'Gold') and {RISKY} group by all""",
)

# --- retention ------------------------------------------------------------------

_COHORTS = f"cohort where cohort_size >= {SMALL_DATA.min_cohort_size}"
add(
    "report_retention_pivot",
    lambda w: customer_reports.retention_pivot(w.cohort_retention, w.params.min_cohort_size),
    "select strftime(cohort_month, '%Y-%m') as cohort, "
    + ", ".join(f"max(retention_pct) filter (where months_since_first = {i}) as m{i}" for i in range(13))
    + f" from {_COHORTS} group by cohort_month",
)
add(
    "report_retention_milestones",
    lambda w: customer_reports.retention_milestones(w.cohort_retention, w.params.min_cohort_size),
    f"""select months_since_first as months, {rnd(mean('retention_pct', 1), 2)} as avg_retention_pct from {_COHORTS}
      and months_since_first in (1, 3, 6, 12) group by all""",
)
add(
    "report_retention_curve",
    lambda w: customer_reports.retention_curve(w.cohort_retention, w.params.min_cohort_size),
    f"select months_since_first, {rnd(mean('retention_pct', 1), 1)} as ret from {_COHORTS} group by all",
)
_AT_SIX = f"""select strftime(cohort_month, '%Y-%m') as cohort, cohort_size, retention_pct from {_COHORTS}
      and months_since_first = 6"""
add(
    "report_best_worst_cohorts",
    lambda w: customer_reports.best_and_worst_cohorts(w.cohort_retention, w.params.min_cohort_size),
    f"""(select *, 'best' as rank_group from ({_AT_SIX}) order by retention_pct desc, cohort limit 5) union all
      (select *, 'worst' as rank_group from ({_AT_SIX}) order by retention_pct, cohort desc limit 5)""",
)

add(
    "report_recent_cohorts",
    lambda w: customer_reports.recent_cohorts(w.cohort_retention, w.params.min_cohort_size),
    f"""select strftime(cohort_month, '%Y-%m') as cohort, months_since_first, retention_pct from {_COHORTS}
      and cohort_month in (select distinct cohort_month from {_COHORTS} order by cohort_month desc limit 6)""",
)
add(
    "report_cohort_sizes",
    lambda w: customer_reports.cohort_sizes(w.cohort_retention, w.params.min_cohort_size),
    f"select distinct strftime(cohort_month, '%Y-%m') as cohort, cohort_size from {_COHORTS}",
)

# --- pitch, affinity, scorecard, propensity -------------------------------------

_CHURN_PCT = rnd("avg_churn_probability * 100::double", 1)
add(
    "report_pitch_ranking",
    lambda w: merchant_reports.pitch_ranking(w.pitch_opportunities),
    f"""select CATEGORY_TWO, DESTINATION, customers, total_spend, market_share_pct, penetration_pct, addressable_market,
      gap_to_leader_pct, {_CHURN_PCT} as churn_risk_pct, pitch_score, recommended_action from pitch
      order by pitch_score desc, CATEGORY_TWO, DESTINATION limit 20""",
)
add(
    "report_pitch_actions",
    lambda w: merchant_reports.pitch_by_action(w.pitch_opportunities),
    f"""select recommended_action, count(*) as num_clients, {total('total_spend', 0)} as total_spend,
      {total('addressable_market', 0)} as total_addressable, {rnd(mean('pitch_score'), 2)} as avg_pitch_score
      from pitch group by all""",
)
add(
    "report_best_pitch_per_category",
    lambda w: merchant_reports.best_pitch_per_category(w.pitch_opportunities),
    """select CATEGORY_TWO, DESTINATION, total_spend, market_share_pct, gap_to_leader_pct, addressable_market,
      pitch_score, recommended_action from (select *, row_number() over (partition by CATEGORY_TWO
        order by pitch_score desc, DESTINATION) as pos from pitch where spend_rank > 1) where pos = 1
      order by addressable_market desc, CATEGORY_TWO limit 20""",
)
add(
    "report_defend_list",
    lambda w: merchant_reports.defend_list(w.pitch_opportunities),
    f"""select CATEGORY_TWO, DESTINATION, customers, total_spend, market_share_pct, {_CHURN_PCT} as churn_risk_pct,
      high_risk_customers, recommended_action from pitch where spend_rank <= 3 and avg_churn_probability > 0.2
      order by high_risk_customers desc, CATEGORY_TWO, DESTINATION limit 15""",
)
add(
    "report_strongest_affinities",
    lambda w: merchant_reports.strongest_affinities(w.category_affinity, 0.5),
    "select * from affinity where lift > 0.5 order by lift desc, category_a, category_b limit 30",
)
_MATRIX = ["Clothing & Apparel", "Electronics", "Groceries"]
add(
    "report_affinity_matrix",
    lambda w: merchant_reports.affinity_matrix(w.category_affinity, _MATRIX),
    "select category, "
    + ", ".join(f"coalesce(max(lift) filter (where other = {text(c)}), 0) as {chr(34)}{c}{chr(34)}" for c in _MATRIX)
    + f""" from (select category_a as category, category_b as other, lift from affinity union all
      select category_b, category_a, lift from affinity) where category in {texts(_MATRIX)} and other in {texts(_MATRIX)}
      group by category""",
)
add(
    "report_cross_sell",
    lambda w: merchant_reports.cross_sell(w.category_affinity, 0.9, 90.0),
    """select *, customers_in_a - shared_customers as gap_a, customers_in_b - shared_customers as gap_b from affinity
      where lift > 0.9 and jaccard_pct < 90 order by shared_customers desc, category_a, category_b limit 15""",
)
add(
    "report_largest_pairs",
    lambda w: merchant_reports.largest_pairs(w.category_affinity),
    """select category_a, category_b, shared_customers, lift, pct_a_also_shops_b, pct_b_also_shops_a from affinity
      order by shared_customers desc, category_a, category_b limit 15""",
)
add(
    "report_scorecard_mix",
    lambda w: merchant_reports.scorecard_mix(w.category_scorecard),
    """select CATEGORY_TWO, total_spend, pct_champions, pct_dormant from scorecard
      order by total_spend desc, CATEGORY_TWO limit 20""",
)
add(
    "report_propensity_pivot",
    lambda w: merchant_reports.propensity_pivot(w.category_propensity, _MATRIX),
    "select segment_name, "
    + ", ".join(
        f"max(adoption_rate_pct) filter (where CATEGORY_TWO = {text(c)}) as {chr(34)}{c}{chr(34)}" for c in _MATRIX
    )
    + f" from propensity where CATEGORY_TWO in {texts(_MATRIX)} group by segment_name",
)
add(
    "report_health_counts",
    lambda w: merchant_reports.health_counts(w.category_scorecard),
    f"""select health_status, count(*) as categories, {total('total_spend', 0)} as total_spend from scorecard
      group by all""",
)
for _by in ("growth_pct", "high_risk_pct"):
    add(
        f"report_scorecard_top_{_by}",
        lambda w, by=_by: merchant_reports.scorecard_top(w.category_scorecard, by),
        f"""select CATEGORY_TWO, {_by}, total_spend, health_status from scorecard where {_by} is not null
          order by {_by} desc, CATEGORY_TWO limit 10""",
    )
add(
    "report_top_propensity",
    lambda w: merchant_reports.top_propensity(w.category_propensity),
    """select segment_name, CATEGORY_TWO, adoption_rate_pct, unadopted_customers, potential_revenue, propensity_level
      from propensity where propensity_level in ('Very High', 'High')
      order by potential_revenue desc, segment_name, CATEGORY_TWO limit 20""",
)
add(
    "report_propensity_heatmap",
    lambda w: merchant_reports.propensity_heatmap(w.category_propensity),
    """select segment_name, CATEGORY_TWO, adoption_rate_pct from propensity where CATEGORY_TWO in (
      select CATEGORY_TWO from propensity group by all order by sum(potential_revenue) desc, CATEGORY_TWO limit 15)""",
)
add(
    "report_propensity_by_segment",
    lambda w: merchant_reports.propensity_by_segment(w.category_propensity),
    f"""select segment_name, cast(sum(unadopted_customers) as bigint) as total_unadopted,
      {total('potential_revenue', 0)} as total_potential from propensity
      where propensity_level in ('Very High', 'High', 'Medium') group by all""",
)

# --- audience reports -----------------------------------------------------------

for _name, _by in [("categories", "CATEGORY_TWO"), ("merchants", "DESTINATION")]:
    add(
        f"report_audience_{_name}",
        lambda w, by=_by: audience_reports.audience_spend_breakdown(
            w.audience_members, w.customer_category_spend, by, w.params.min_breakdown_customers
        ),
        f"""select h.audience_id, {_by}, count(distinct UNIQUE_ID) as customers, {rnd(total('dest_spend'))} as spend
          from hits h join ccs using (UNIQUE_ID) group by all
          having count(distinct UNIQUE_ID) >= {SMALL_DATA.min_breakdown_customers}""",
    )
for _band, _keep in [("age_group", True), ("income_group", False), ("gender_label", False)]:
    add(
        f"report_audience_{_band}",
        lambda w, band=_band, keep=_keep: audience_reports.audience_band_breakdown(w.audience_members, w.customers, band, keep),
        f"""select h.audience_id, {_band}, count(*) as customers from hits h join cust using (UNIQUE_ID)
          where {_band} is not null {'' if _keep else f"and {_band} <> 'Unknown'"} group by all""",
    )
add(
    "report_audience_provinces",
    lambda w: audience_reports.audience_provinces(w.audience_catalog),
    f"""select audience_id, audience_name, audience_type, top_province as PROVINCE, audience_size as customers,
      {rnd('avg_spend * audience_size')} as spend from catalog""",
)
_BRANDS = {
    "mass_makeup": "gender_label = 'Female' and age between 18 and 40 "
    "and income_group in ('R5.5k-R13.5k', 'R13.5k-R23.5k', 'R23.5k-R32.5k')",
    "premium_skincare": "gender_label = 'Female' and income_group in ('R32.5k-R56k', 'R56k+') and age between 25 and 55",
    "supplements": "income_group not in ('R0-R5.5k', 'Unknown') and age between 30 and 60",
    "textured_hair": "gender_label = 'Female' and age between 18 and 45",
}


def _brand(operator, brand, **arguments):
    def build(w):
        predicate = None if brand is None else audience_reports.brand_predicates()[brand]
        tables = [w.customer_category_spend, w.customers]
        if operator is audience_reports.brand_segments:
            tables.append(w.segments)
        return operator(*tables, CLIENT, predicate, **arguments)

    return build


for _name, _predicate in [("all", None), *_BRANDS.items()]:
    add(
        f"report_brand_profile_{_name}",
        _brand(audience_reports.brand_profile, None if _predicate is None else _name),
        f"""select count(distinct UNIQUE_ID) as audience_size, {rnd(mean('age'), 1)} as avg_age,
          {rnd(mean('estimated_income'))} as avg_income,
          {percent(n_where("gender_label = 'Female'"), 'count(*)')} as pct_female,
          {rnd(total('dest_spend'))} as total_spend, {rnd(mean('dest_spend'))} as avg_spend
          from ccs join cust using (UNIQUE_ID) where {OF_CLIENT} and {_predicate or 'true'}""",
    )
_BRAND = "textured_hair"
_AUDIENCE = f"select distinct UNIQUE_ID from ccs join cust using (UNIQUE_ID) where {OF_CLIENT} and {_BRANDS[_BRAND]}"
for _band in ("age_group", "income_group"):
    add(
        f"report_brand_{_band}",
        _brand(audience_reports.brand_bands, _BRAND, band=_band),
        f"""select {_band}, count(*) as n from ({_AUDIENCE}) join cust using (UNIQUE_ID)
          where {_band} <> 'Unknown' group by all""",
    )
add(
    "report_brand_other_categories",
    _brand(audience_reports.brand_other_categories, _BRAND),
    f"""select CATEGORY_TWO, count(distinct UNIQUE_ID) as customers, {rnd(total('dest_spend'))} as spend
      from ({_AUDIENCE}) join ccs using (UNIQUE_ID) where not {OF_CLIENT} group by all
      order by spend desc, CATEGORY_TWO limit 8""",
)
add(
    "report_brand_segments",
    _brand(audience_reports.brand_segments, _BRAND),
    f"select segment_name, count(*) as n from ({_AUDIENCE}) join seg using (UNIQUE_ID) group by all",
)

# --- category pitch -------------------------------------------------------------

_SHOPPERS = f"select distinct UNIQUE_ID from ccs where {IN_CATEGORY}"
add(
    "report_category_size",
    lambda w: audience_reports.category_size(w.customer_category_spend, CATEGORY),
    f"""select count(distinct UNIQUE_ID) as shoppers, {rnd(total('dest_spend'))} as spend,
      {rnd(mean('dest_spend'))} as avg_spend from ccs where {IN_CATEGORY}""",
)
add(
    "report_category_leaders",
    lambda w: audience_reports.category_leaders(w.benchmarks, CATEGORY),
    f"""select DESTINATION, customers, total_spend as spend, {rnd('market_share_pct', 1)} as share,
      spend_per_customer as per_cust, avg_share_of_wallet as sow, spend_rank from bench
      where {IN_CATEGORY} and spend_rank <= 8""",
)
add(
    "report_category_months",
    lambda w: audience_reports.category_months(w.transactions, w.as_of, CATEGORY),
    f"""select strftime(EFF_DATE, '%Y-%m') as month, strftime(EFF_DATE, '%b %Y') as month_label,
      count(distinct UNIQUE_ID) as customers, {rnd(total('trns_amt'))} as spend, count(*) as txns from yr
      where {IN_CATEGORY} group by 1, 2""",
)
for _band, _keep in [("age_group", False), ("income_group", False), ("gender_label", True)]:
    add(
        f"report_category_{_band}",
        lambda w, band=_band, keep=_keep: audience_reports.category_demographics(
            w.customer_category_spend, w.customers, CATEGORY, band, keep
        ),
        f"""select {_band}, count(distinct UNIQUE_ID) as customers, {rnd(total('dest_spend'))} as spend
          from ccs join cust using (UNIQUE_ID) where {IN_CATEGORY} and {_band} is not null
          {'' if _keep else f"and {_band} <> 'Unknown'"} group by all""",
    )
add(
    "report_category_cross_shop",
    lambda w: audience_reports.category_cross_shop(w.customer_category_spend, CATEGORY),
    f"""select CATEGORY_TWO, count(distinct UNIQUE_ID) as customers, {rnd(total('dest_spend'))} as spend
      from ({_SHOPPERS}) join ccs using (UNIQUE_ID) where not {IN_CATEGORY} group by all
      order by spend desc, CATEGORY_TWO limit 10""",
)
add(
    "report_category_segments",
    lambda w: audience_reports.category_segments(w.customer_category_spend, w.segments, CATEGORY),
    f"select segment_name, count(*) as n from ({_SHOPPERS}) join seg using (UNIQUE_ID) group by all",
)
add(
    "report_store_overlap",
    lambda w: audience_reports.store_overlap(w.customer_category_spend, CLIENT, OTHER_CLIENTS),
    f"""select count(*) as shared_customers from (select UNIQUE_ID from ccs where {OF_CLIENT} intersect
      select UNIQUE_ID from ccs where upper(DESTINATION) like '%00000_')""",
)
add(
    "report_season_skewed_audience",
    lambda w: audience_reports.season_skewed_audience(w.transactions, w.as_of, CATEGORY),
    f"""select count(*) as audience_size, {rnd(mean('y'))} as avg_annual_spend from (
      select UNIQUE_ID, {total('trns_amt')} as y, {total('trns_amt', where='month(EFF_DATE) in (5, 6, 7, 8)')} as s
      from yr where {IN_CATEGORY} group by UNIQUE_ID) where s > y * 0.45::double""",
)
_OTHERS = ["Clothing & Apparel", "Electronics", "Travel"]
add(
    "report_multi_category_audience",
    lambda w: audience_reports.multi_category_audience(w.customer_category_spend, CATEGORY, _OTHERS),
    f"""select count(*) as audience_size from (select UNIQUE_ID from ccs join ({_SHOPPERS}) using (UNIQUE_ID)
      where CATEGORY_TWO in {texts(_OTHERS)} group by UNIQUE_ID having count(distinct CATEGORY_TWO) >= 2)""",
)
add(
    "report_young_parents",
    lambda w: audience_reports.category_pair_overlap(
        w.customer_category_spend, [CATEGORY], [SECOND_CATEGORY], w.customers, F.col("age").between(25, 42)
    ),
    f"""select count(distinct UNIQUE_ID) as audience_size from ({_SHOPPERS}) join cust using (UNIQUE_ID)
      join ccs using (UNIQUE_ID) where age between 25 and 42 and CATEGORY_TWO = {text(SECOND_CATEGORY)}""",
)
add(
    "report_category_pair_overlap",
    lambda w: audience_reports.category_pair_overlap(w.customer_category_spend, [SECOND_CATEGORY, "Travel"], [CATEGORY]),
    f"""select count(*) as audience_size from (select UNIQUE_ID from ccs where CATEGORY_TWO in
      {texts([SECOND_CATEGORY, 'Travel'])} intersect {_SHOPPERS})""",
)
add(
    "report_name_search",
    lambda w: audience_reports.search_names(w.benchmarks, "CATEGORY_TWO", ["%GROC%", "%E%"], ["%TRAVEL%", "%FUEL%"]),
    """select DESTINATION, CATEGORY_TWO, customers, total_spend, market_share_pct, spend_rank from bench
      where upper(CATEGORY_TWO) like '%GROC%' or upper(CATEGORY_TWO) like '%E%'
        and upper(CATEGORY_TWO) not like '%TRAVEL%' and upper(CATEGORY_TWO) not like '%FUEL%'
      order by total_spend desc, DESTINATION, CATEGORY_TWO limit 15""",
)
add(
    "report_category_search",
    lambda w: audience_reports.search_categories(w.benchmarks, ["%GROC%", "%TRAV%", "%CLOTH%"]),
    "select distinct CATEGORY_TWO from bench where regexp_matches(upper(CATEGORY_TWO), 'GROC|TRAV|CLOTH')",
)
add(
    "report_destination_spellings",
    lambda w: audience_reports.destination_spellings(w.customer_category_spend, "%00000_"),
    "select DESTINATION, count(*) as n from ccs where upper(DESTINATION) like '%00000_' group by all",
)
add(
    "report_client_categories",
    lambda w: audience_reports.client_categories(w.customer_category_spend, CLIENT),
    f"select CATEGORY_TWO, count(distinct UNIQUE_ID) as customers from ccs where {OF_CLIENT} group by all",
)
add(
    "report_client_demographics",
    lambda w: audience_reports.client_demographics(w.customer_category_spend, w.customers, CLIENT),
    f"""select age_group, income_group, gender_label, count(*) as customers, {rnd(mean('age'), 1)} as avg_age,
      {rnd(mean('estimated_income'))} as avg_income from cust
      where UNIQUE_ID in (select UNIQUE_ID from ccs where {OF_CLIENT}) group by all""",
)
add(
    "report_client_cross_shop",
    lambda w: audience_reports.client_cross_shop(w.customer_category_spend, CLIENT, CATEGORY),
    f"""select CATEGORY_TWO, DESTINATION, count(*) as customers, {rnd(total('dest_spend'))} as spend from ccs
      where not {IN_CATEGORY} and UNIQUE_ID in (select UNIQUE_ID from ccs where {OF_CLIENT}) group by all
      order by spend desc, CATEGORY_TWO, DESTINATION limit 50""",
)
_LISTED = ["supplier#000000001", "Supplier#000000002", "No Such Brand"]
add(
    "report_brand_coverage",
    lambda w: audience_reports.brand_coverage(w.customer_category_spend, _LISTED),
    f"""select brand, count(distinct UNIQUE_ID) as customers from (values {', '.join(f'({text(b)})' for b in _LISTED)})
      v(brand) left join ccs on lower(DESTINATION) = lower(brand) group by all""",
)
