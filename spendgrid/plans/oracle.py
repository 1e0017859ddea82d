"""Independent ANSI SQL for the same tables, run by another engine as a check.

Each named relation below is a common table expression. `sql_for` prefixes a query
with the relations it reads, in dependency order.
"""

import re

from spendgrid.functions.labels import (
    AUDIENCES,
    CHURN_LEVELS,
    CLV_TIERS,
    HEALTH,
    LIFESTYLE,
    MOMENTUM,
    PITCH_ACTIONS,
    PREMIUM_CATEGORIES,
    PROPENSITY,
    PROVINCE_AUDIENCES,
    SEASONAL,
    SEGMENT_TEXTS,
    SEGMENTS,
)
from spendgrid.operators.marts import BASKETS, DAYS, HOUR_SHARES
from spendgrid.operators.staging import AGE_BANDS, INCOME_BANDS
from spendgrid.params import SMALL_DATA as P
from spendgrid.sources.order_tables import CATEGORY_OF_PART, PROVINCE_OF_REGION

# --- expression helpers -----------------------------------------------------


def rnd(x, dp=0):
    """Half away from zero at dp decimals."""
    k = f"{10**dp}::double"
    return f"((case when ({x}) < 0 then -1 else 1 end) * cast(floor(abs({x}) * {k} + 0.5) as bigint) / {k})"


def units(x, dp=2):
    return f"cast(floor(({x})::double * {10**dp}::double + 0.5::double) as bigint)"


def total(x, dp=2, where=None):
    condition = f" filter (where {where})" if where else ""
    return f"(sum({units(x, dp)}){condition}::double / {10**dp}::double)"


def total0(x, where, dp=2):
    return f"(coalesce(sum({units(x, dp)}) filter (where {where}), 0)::double / {10**dp}::double)"


def mean(x, dp=2):
    return f"({total(x, dp)} / nullif(count({x}), 0)::double)"


def div(a, b):
    return f"(({a})::double / nullif(({b})::double, 0))"


def percent(a, b, dp=1):
    return rnd(f"({a})::double * 100::double / nullif(({b})::double, 0)", dp)


def n_where(condition):
    return f"(count(*) filter (where {condition}))"


def text(value):
    return "'" + value.replace("'", "''") + "'"


def texts(values):
    return "(" + ", ".join(text(v) for v in values) + ")"


def case(key, mapping, default="null"):
    arms = " ".join(f"when {text(k) if isinstance(k, str) else k} then {text(v)}" for k, v in mapping.items())
    return f"(case {key} {arms} else {default} end)"


def ladder(x, table, op):
    arms = " ".join(f"when {x} {op} {limit} then {text(name)}" for limit, name in table[:-1])
    return f"(case {arms} else {text(table[-1][1])} end)"


def mode_of(relation, keys, value, name):
    """Most frequent value per key; NULL counts; ties to the smaller value."""
    k = ", ".join(keys)
    return (
        f"select {k}, {value} as {name} from (select {k}, {value}, row_number() over (partition by {k} "
        f"order by count(*) desc, {value} asc nulls last) as pos from {relation} group by {k}, {value}) where pos = 1"
    )


# --- relations --------------------------------------------------------------

_KIND = "split_part(p_type, ' ', 1)"
_HOUR_BANDS = {"morning": "trns_hour between 6 and 10", "evening": "trns_hour between 17 and 21"}
_WEEKEND = "trns_dow in (1, 7)"
_GAP = rnd("date_diff('day', min(EFF_DATE), max(EFF_DATE))::double / nullif((count(*) - 1)::double, 0)", 2)
_MONTHS = "count(distinct date_trunc('month', EFF_DATE))"


def _activity(start, end, anchor, recent, previous, early):
    until = f"and EFF_DATE < (select {end} from bounds)" if end else ""
    recent_when = f"EFF_DATE >= (select {recent} from bounds)"
    early_when = f"EFF_DATE < (select {early} from bounds)"
    previous_when = f"EFF_DATE >= (select {previous} from bounds) and EFF_DATE < (select {recent} from bounds)"
    return f"""
      select UNIQUE_ID, count(*) as nr_trns, {total('trns_amt')} as val_trns, {rnd(mean('trns_amt'), 2)} as avg_val,
        {_MONTHS} as active_months, {_GAP} as days_between,
        count(distinct DESTINATION_ID) as active_destinations,
        count(distinct NAV_CATEGORY_ID) as active_nav_categories,
        {n_where(_WEEKEND)} as NR_TRNS_WEEKEND, {n_where('not ' + _WEEKEND)} as NR_TRNS_WEEK,
        {percent(n_where(_HOUR_BANDS['morning']), 'count(*)')} as pct_morning,
        {percent(n_where(_HOUR_BANDS['evening']), 'count(*)')} as pct_evening,
        coalesce({rnd(div(n_where(recent_when), n_where(early_when)), 2)}, 0::double) as txn_trend,
        coalesce({rnd(div(total0('trns_amt', recent_when), total0('trns_amt', early_when)), 2)}, 0::double)
          as spend_trend,
        date_diff('day', max(EFF_DATE), (select {anchor} from bounds)) as days_since_last,
        {n_where(recent_when)} as txns_last_3m, {n_where(previous_when)} as txns_prev_3m
      from txn where EFF_DATE >= (select {start} from bounds) {until}
      group by UNIQUE_ID having count(*) >= {P.min_model_txns}"""


_PERSON = "coalesce(c.age, 0::double) as age, coalesce(c.estimated_income, 0::double) as estimated_income, \
coalesce(c.main_banked, 0) as main_banked"

_LIFESTYLE_PARTS = " union all ".join(
    f"select {text(a)} as audience_id, UNIQUE_ID from ccs group by UNIQUE_ID "
    f"having {div(total0('dest_spend', f'CATEGORY_TWO in {texts(cats)}'), total('dest_spend'))} >= {share} "
    f"and {total('dest_spend') if a == 'L01' else total0('dest_spend', f'CATEGORY_TWO in {texts(cats)}')} >= {least}"
    for a, (cats, share, least) in LIFESTYLE.items()
)
_SEASON_PARTS = " union all ".join(
    f"select {text(a)} as audience_id, UNIQUE_ID from txn where EFF_DATE >= (select m14 from bounds) group by UNIQUE_ID "
    f"having {total0('trns_amt', f'month(EFF_DATE) = {month}')} >= {mean('trns_amt')} * {times}::double "
    f"and {total0('trns_amt', f'month(EFF_DATE) = {month}')} >= {least}"
    for a, (month, times, least) in SEASONAL.items()
)
_PROVINCE_PARTS = " union all ".join(
    f"select {text(a)} as audience_id, UNIQUE_ID from home where province = {text(p)}"
    for a, p in PROVINCE_AUDIENCES.items()
)

RELATIONS = {
    "raw_txn": f"""
      select printf('C%08d', o_custkey) as UNIQUE_ID, cast(o_orderdate as date) as EFF_DATE,
        case when {_KIND} in ('ECONOMY', 'SMALL') then 1 else 2 end as CATEGORY_ONE_ID,
        {' '.join(['case ' + _KIND] + [f"when '{k}' then {v[0]}" for k, v in CATEGORY_OF_PART.items()] + ['end'])}
          as CATEGORY_TWO_ID,
        cast(replace(p_brand, 'Brand#', '') as bigint) as NAV_CATEGORY_ID,
        l_suppkey as DESTINATION_ID, l_suppkey::double as LOCATION_ID, s_nationkey::double as SUBURB_ID,
        case when l_orderkey % 97 = 0 then 'xx00'
          else lpad(cast((l_orderkey * 7 + l_linenumber * 5) % 24 as varchar), 2, '0') || '00' end as trns_time,
        floor(l_extendedprice * 10::double) / 100::double as trns_amt
      from lineitem join orders on o_orderkey = l_orderkey join part on p_partkey = l_partkey
        join supplier on s_suppkey = l_suppkey""",
    "raw_base": """
      select printf('C%08d', c_custkey) as UNIQUE_ID, m.month, c_custkey % 3 as demo_1,
        case when c_custkey % 41 = 0 then null
          else (18 + c_custkey % 60 - case when m.month < date '2001-07-01' then 1 else 0 end)::double end as demo_2,
        (c_custkey % 20)::double as demo_3, c_custkey % 7 as demo_4, c_mktsegment as demo_5,
        case when c_custkey % 2 = 0 then 'Salaried' else 'Self-employed' end as demo_6,
        floor(greatest(c_acctbal, 0) * 8::double) as demo_7, c_custkey % 2 as demo_8,
        substr('ABCDE', cast(c_custkey % 5 + 1 as integer), 1) as demo_9
      from customer cross join (values (date '2001-05-01'), (date '2001-06-01'), (date '2001-07-01')) m(month)""",
    "txn": f"""
      select UNIQUE_ID, EFF_DATE, trns_amt, trns_time, year(EFF_DATE) as trns_year, month(EFF_DATE) as trns_month,
        dayofweek(EFF_DATE) + 1 as trns_dow, try_cast(left(trns_time, 2) as bigint) as trns_hour,
        r.CATEGORY_ONE_ID, case CATEGORY_ONE_ID when 1 then 'Food' else 'Non-food' end as CATEGORY_ONE,
        r.CATEGORY_TWO_ID, {case('CATEGORY_TWO_ID', {v[0]: v[1] for v in CATEGORY_OF_PART.values()})} as CATEGORY_TWO,
        r.NAV_CATEGORY_ID, 'Brand#' || NAV_CATEGORY_ID as NAV_CATEGORY,
        DESTINATION_ID, s_name as DESTINATION, 'Merchant' as BUSINESS_CATEGORY_ONE,
        case when s_acctbal < 0 then 'Overdrawn' else 'In credit' end as BUSINESS_CATEGORY_TWO,
        cast(LOCATION_ID as bigint) as LOCATION_ID, 'Branch of ' || s_name as LOCATION_NAME,
        16::double + (s_suppkey % 1600) / 100::double as longitude,
        -34::double + (s_suppkey % 1200) / 100::double as latitude,
        cast(SUBURB_ID as bigint) as SUBURB_ID, n_name || ' Central' as SUBURB, n_name || ' Town' as TOWN,
        n_name as MUNICIPALITY, {case('r_name', PROVINCE_OF_REGION)} as PROVINCE,
        cast(date_trunc('month', EFF_DATE) as date) as txn_month
      from raw_txn r left join supplier on s_suppkey = DESTINATION_ID
        left join nation on n_nationkey = cast(SUBURB_ID as bigint) left join region on r_regionkey = n_regionkey
      where UNIQUE_ID is not null and EFF_DATE is not null and trns_amt is not null""",
    "cust": f"""
      select UNIQUE_ID, demo_1 as gender, demo_2 as age, demo_3 as profile_age, demo_4 as vertical_sales_index,
        demo_5 as income_segment, demo_6 as hyper_segment, demo_7 as estimated_income, demo_8 as main_banked,
        demo_9 as credit_risk_class,
        case when demo_2 is null then 'Unknown' else {ladder('demo_2', AGE_BANDS, '<=')} end as age_group,
        case when coalesce(demo_7, 0) = 0 then 'Unknown' else {ladder('demo_7', INCOME_BANDS, '<=')} end
          as income_group,
        case demo_1 when 0 then 'Male' when 1 then 'Female' else 'Unknown' end as gender_label
      from raw_base where month = (select max(b.month) from raw_base b where b.UNIQUE_ID = raw_base.UNIQUE_ID)""",
    "bounds": """
      select d, cast(d - interval 3 month as date) as m3, cast(d - interval 6 month as date) as m6,
        cast(d - interval 9 month as date) as m9, cast(d - interval 12 month as date) as m12,
        cast(d - interval 14 month as date) as m14, cast(d - interval 18 month as date) as m18,
        cast(cast(d - interval 3 month as date) - interval 3 month as date) as m3_3,
        cast(cast(d - interval 3 month as date) - interval 6 month as date) as m3_6,
        cast(cast(d - interval 6 month as date) - interval 3 month as date) as m6_3,
        cast(cast(d - interval 6 month as date) - interval 6 month as date) as m6_6,
        cast(cast(d - interval 6 month as date) - interval 9 month as date) as m6_9
      from (select max(EFF_DATE) as d from txn)""",
    "yr": "select * from txn where EFF_DATE >= (select m12 from bounds)",
    "rfm": f"""
      select UNIQUE_ID, count(*) as nr_trns, {total('trns_amt')} as val_trns, {rnd(mean('trns_amt'), 2)} as avg_val,
        {rnd('quantile_disc(trns_amt, 0.5)', 2)} as median_val,
        {rnd(f"sqrt((count(*)::hugeint * sum({units('trns_amt')}::hugeint * {units('trns_amt')}) "
             f"- sum({units('trns_amt')})::hugeint * sum({units('trns_amt')}))::double "
             f"/ nullif(count(*)::double * (count(*)::double - 1), 0)) / 100::double", 2)} as std_val,
        date_diff('day', max(EFF_DATE), (select d from bounds)) as lst_trns_days, {_MONTHS} as active_months,
        {rnd(div('count(*)', _MONTHS), 2)} as mnthly_avg_nr, {rnd(div(total('trns_amt'), _MONTHS), 2)} as mnthly_avg_val,
        {_GAP} as days_between, {rnd(mean('trns_dow', 0), 2)} as avg_dow, {rnd(mean('trns_hour', 0), 2)} as avg_hour,
        {n_where('trns_hour between 6 and 10')} as NR_TRNS_MORNING,
        {n_where('trns_hour between 11 and 16')} as NR_TRNS_MIDDAY,
        {n_where('trns_hour between 17 and 21')} as NR_TRNS_EVENING,
        {n_where('trns_hour < 6 or trns_hour > 21')} as NR_TRNS_LATE,
        {n_where(_WEEKEND)} as NR_TRNS_WEEKEND, {n_where('not ' + _WEEKEND)} as NR_TRNS_WEEK,
        count(distinct NAV_CATEGORY_ID) as active_nav_categories, count(distinct DESTINATION_ID) as active_destinations,
        count(distinct SUBURB_ID) as active_suburbs, count(distinct LOCATION_ID) as active_locations
      from yr group by UNIQUE_ID having count(*) >= {P.min_feature_txns}""",
    "scores": """
      select *, r_score || '' || f_score || '' || m_score as rfm_combined from (
        select *, 6 - ntile(5) over (order by lst_trns_days, UNIQUE_ID) as r_score,
          ntile(5) over (order by nr_trns, UNIQUE_ID) as f_score,
          ntile(5) over (order by val_trns, UNIQUE_ID) as m_score from rfm)""",
    "ccs": f"""
      select d.*, c.category_txn_count, c.category_spend,
        {rnd(div('dest_spend', 'category_spend') + ' * 100::double', 1)} as share_of_wallet_pct
      from (select UNIQUE_ID, CATEGORY_TWO, DESTINATION, count(*) as dest_txn_count, {total('trns_amt')} as dest_spend,
              max(EFF_DATE) as last_txn_date
            from yr where CATEGORY_TWO is not null and DESTINATION is not null group by all) d
      join (select UNIQUE_ID, CATEGORY_TWO, count(*) as category_txn_count, {total('trns_amt')} as category_spend
            from yr where CATEGORY_TWO is not null and DESTINATION is not null group by all) c
        using (UNIQUE_ID, CATEGORY_TWO)""",
    "metrics": f"""
      with m as (
        select CATEGORY_TWO, DESTINATION, count(distinct UNIQUE_ID) as customers,
          cast(sum(dest_txn_count) as bigint) as transactions, {rnd(total('dest_spend'))} as total_spend,
          {rnd("sum(cast(dest_spend / dest_txn_count as decimal(28,10)))::double / count(*)::double", 2)}
            as avg_txn_value,
          {rnd(div(total('dest_spend'), 'count(distinct UNIQUE_ID)'))} as spend_per_customer,
          {rnd(mean('share_of_wallet_pct', 1), 1)} as avg_share_of_wallet
        from ccs group by all),
      c as (select CATEGORY_TWO, {rnd(total('dest_spend'))} as cat_spend, count(distinct UNIQUE_ID) as cat_customers
            from ccs group by all)
      select m.*, {percent('total_spend', 'cat_spend', 2)} as market_share_pct,
        {percent('customers', 'cat_customers', 2)} as penetration_pct,
        row_number() over (partition by CATEGORY_TWO order by total_spend desc, DESTINATION) as spend_rank
      from m join c using (CATEGORY_TWO)""",
    "bench": "select * from metrics where total_spend > 0",
    "seg": f"""
      select s.*, 6 - m_score as cluster_id, {case('6 - m_score', {i + 1: n for i, n in enumerate(SEGMENTS)})}
          as segment_name, c.* exclude (UNIQUE_ID, vertical_sales_index)
      from scores s left join cust c using (UNIQUE_ID)""",
    "act": _activity("m12", None, "d", "m3", "m6", "m9"),
    "churn_train": f"""
      select a.* exclude (UNIQUE_ID, spend_trend, days_since_last, txns_last_3m, txns_prev_3m), {_PERSON},
        cast(not exists (select 1 from txn t where t.UNIQUE_ID = a.UNIQUE_ID
             and t.EFF_DATE >= (select m3 from bounds)) as bigint) as churned
      from ({_activity('m12', 'm3', 'm3', 'm3_3', 'm3_6', 'm3_6')}) a left join cust c on c.UNIQUE_ID = a.UNIQUE_ID""",
    "clv_train": f"""
      select a.* exclude (UNIQUE_ID, pct_morning, pct_evening, txn_trend, days_since_last, txns_last_3m, txns_prev_3m),
        a.days_since_last as recency_days, {_PERSON}, coalesce(f.future_spend, 0::double) as future_spend
      from ({_activity('m18', 'm6', 'm6', 'm6_3', 'm6_6', 'm6_9')}) a left join cust c on c.UNIQUE_ID = a.UNIQUE_ID
        left join (select UNIQUE_ID, {total('trns_amt')} as future_spend from txn
                   where EFF_DATE >= (select m6 from bounds) group by UNIQUE_ID) f on f.UNIQUE_ID = a.UNIQUE_ID""",
    "churn": f"""
      select UNIQUE_ID, p as churn_probability, cast(p >= 0.5 as bigint) as predicted_label,
        {ladder('p', CHURN_LEVELS, '>=')} as churn_risk_level, nr_trns as total_txns, val_trns as total_spend,
        days_since_last, txns_last_3m, txns_prev_3m, active_months, active_destinations, txn_trend, c.age,
        c.gender_label, c.income_segment, c.estimated_income, c.credit_risk_class, c.age_group, c.income_group
      from (select *, {rnd('least(days_since_last, 365) / 365::double', 4)} as p from act) left join cust c
        using (UNIQUE_ID)""",
    "clv": f"""
      with f as (select *, greatest(val_trns / 2::double - 2000::double, 0::double) as v from act),
      q as (select *, least(v, (select quantile_disc(v, {P.clv_cap_percentile}) from f)) as capped from f)
      select UNIQUE_ID, {rnd('capped', 2)} as predicted_clv, val_trns as historical_spend, nr_trns, active_months,
        days_since_last as recency_days, spend_trend,
        {case('ntile(5) over (order by capped, UNIQUE_ID)', {5 - i: t for i, t in enumerate(CLV_TIERS)})} as clv_tier,
        c.age, c.gender_label, c.income_segment, c.age_group, c.income_group
      from q left join cust c using (UNIQUE_ID)""",
    "profiles": f"""
      select g.*, {percent('customer_count', 'sum(customer_count) over ()')} as pct_of_total, a.top_age_group,
        i.top_income_group
      from (select segment_name, cluster_id, count(*) as customer_count, {rnd(mean('val_trns'), 2)} as avg_total_spend,
          min(val_trns) as min_total_spend, max(val_trns) as max_total_spend,
          {rnd(total('val_trns'))} as total_segment_spend, {rnd(mean('nr_trns', 0), 1)} as avg_transactions,
          {rnd(mean('mnthly_avg_nr'), 1)} as avg_monthly_txns, {rnd(mean('lst_trns_days', 0), 1)} as avg_recency_days,
          {rnd(mean('days_between'), 1)} as avg_days_between_txns, {rnd(mean('avg_val'), 2)} as avg_txn_value,
          {rnd(mean('active_destinations', 0), 1)} as avg_merchants,
          {rnd(mean('active_nav_categories', 0), 1)} as avg_categories,
          {rnd(mean('active_months', 0), 1)} as avg_active_months,
          {rnd(mean('NR_TRNS_WEEKEND', 0), 1)} as avg_weekend_txns, {rnd(mean('NR_TRNS_WEEK', 0), 1)} as avg_weekday_txns,
          {rnd(mean('age'), 1)} as avg_age, {rnd(mean('estimated_income'))} as avg_income,
          {n_where('age between 18 and 25')} as age_18_25, {n_where('age between 26 and 35')} as age_26_35,
          {n_where('age between 36 and 45')} as age_36_45, {n_where('age between 46 and 60')} as age_46_60,
          {n_where('age > 60')} as age_over_60, {n_where('gender = 0')} as male_count,
          {n_where('gender = 1')} as female_count
        from seg group by segment_name, cluster_id) g
      join ({mode_of('seg', ['segment_name'], 'age_group', 'top_age_group')}) a using (segment_name)
      join ({mode_of('seg', ['segment_name'], 'income_group', 'top_income_group')}) i using (segment_name)""",
    "summary": f"""
      select segment_name, cluster_id, customer_count, pct_of_total, avg_total_spend, total_segment_spend,
        avg_transactions, avg_recency_days, avg_txn_value, avg_merchants, avg_categories, avg_age, avg_income,
        top_age_group, top_income_group,
        {case('segment_name', {k: t[0] for k, t in SEGMENT_TEXTS.items()})} as business_description,
        {case('segment_name', {k: t[1] for k, t in SEGMENT_TEXTS.items()})} as recommended_action from profiles""",
    "behav": f"""
      with h as (select s.segment_name, s.UNIQUE_ID, t.trns_hour from seg s join txn t using (UNIQUE_ID)),
      t as (select segment_name, count(*) as n, {n_where('trns_hour between 6 and 10')} as mo,
              {n_where('trns_hour between 11 and 16')} as af, {n_where('trns_hour between 17 and 21')} as ev,
              {n_where('trns_hour is null or trns_hour not between 6 and 21')} as ln from h group by segment_name),
      c as (select segment_name, count(*) as customers, sum(NR_TRNS_WEEKEND) as we,
              sum(NR_TRNS_WEEKEND + NR_TRNS_WEEK) as al, {rnd(mean('active_nav_categories', 0), 1)} as avg_categories,
              {rnd(mean('active_destinations', 0), 1)} as avg_merchants, {rnd(mean('avg_val'), 2)} as avg_txn_value
            from seg group by segment_name)
      select segment_name, customers, {percent('mo', 'n')} as pct_morning, {percent('af', 'n')} as pct_afternoon,
        {percent('ev', 'n')} as pct_evening, {percent('ln', 'n')} as pct_late_night,
        {percent('we', 'al')} as pct_weekend, avg_categories, avg_merchants, avg_txn_value,
        {rnd(div('n', 'customers'), 1)} as avg_txns_per_customer from t join c using (segment_name)""",
    "geo": f"""
      select PROVINCE, MUNICIPALITY, CATEGORY_TWO, count(distinct UNIQUE_ID) as customers, count(*) as transactions,
        {rnd(total('trns_amt'))} as total_spend, {rnd(mean('trns_amt'), 2)} as avg_txn,
        count(distinct DESTINATION) as distinct_merchants
      from txn where PROVINCE is not null and CATEGORY_TWO is not null group by all""",
    "trends": f"""
      select txn_month as month, CATEGORY_TWO, DESTINATION, count(*) as txn_count,
        count(distinct UNIQUE_ID) as customer_count, {rnd(total('trns_amt'))} as total_spend,
        {rnd(mean('trns_amt'), 2)} as avg_txn
      from txn where CATEGORY_TWO is not null and DESTINATION is not null group by all""",
    "demo": f"""
      select p.CATEGORY_TWO, gender_label, age_group, income_group, income_segment, credit_risk_class,
        count(*) as customers, cast(sum(n) as bigint) as total_txns, {rnd(total('spend'))} as total_spend,
        {rnd(mean('spend'))} as avg_spend_per_customer
      from (select distinct UNIQUE_ID, CATEGORY_TWO, category_txn_count as n, category_spend as spend from ccs) p
        left join cust using (UNIQUE_ID) group by all""",
    "cohort": f"""
      with m as (select distinct UNIQUE_ID, txn_month from txn),
      f as (select *, min(txn_month) over (partition by UNIQUE_ID) as cohort_month from m),
      s as (select cohort_month, count(distinct UNIQUE_ID) as cohort_size from f group by all),
      a as (select cohort_month, date_diff('month', cohort_month, txn_month) as months_since_first,
              count(distinct UNIQUE_ID) as active_customers from f group by all)
      select cohort_month, cohort_size, months_since_first, active_customers,
        {percent('active_customers', 'cohort_size')} as retention_pct
      from a join s using (cohort_month) where months_since_first <= {P.retention_horizon}""",
    "affinity": f"""
      with c as (select distinct UNIQUE_ID, CATEGORY_TWO as k from yr where CATEGORY_TWO is not null),
      s as (select k, count(*) as n from c group by k),
      p as (select a.k as category_a, b.k as category_b, count(*) as shared_customers
            from c a join c b on a.UNIQUE_ID = b.UNIQUE_ID and a.k < b.k group by all
            having count(*) >= {P.min_shared_customers})
      select category_a, category_b, shared_customers, a.n as customers_in_a, b.n as customers_in_b,
        {percent('shared_customers', 'a.n')} as pct_a_also_shops_b, {percent('shared_customers', 'b.n')}
          as pct_b_also_shops_a,
        {rnd(div('shared_customers * (select count(distinct UNIQUE_ID) from c)', 'a.n::double * b.n'), 2)} as lift,
        {rnd(div('shared_customers', 'a.n + b.n - shared_customers') + ' * 100::double', 1)} as jaccard_pct
      from p join s a on a.k = category_a join s b on b.k = category_b""",
    "scorecard": f"""
      with g as (select CATEGORY_TWO, {total0('trns_amt', 'EFF_DATE >= (select m3 from bounds)')} as r,
                   {total0('trns_amt', 'EFF_DATE < (select m3 from bounds)')} as p
                 from txn where EFF_DATE >= (select m6 from bounds) and CATEGORY_TWO is not null group by all),
      b as (select CATEGORY_TWO, count(*) as num_destinations, {total('total_spend', 0)} as total_spend,
              {rnd(mean('avg_txn_value'), 2)} as avg_txn_value,
              {rnd(mean('spend_per_customer', 0))} as avg_spend_per_customer from bench group by all),
      u as (select distinct UNIQUE_ID, CATEGORY_TWO from ccs),
      n as (select CATEGORY_TWO, count(*) as total_customers from u group by all),
      c as (select CATEGORY_TWO, {rnd(mean('churn_probability', 4) + ' * 100::double', 1)} as avg_churn_pct,
              {n_where("churn_risk_level in ('Critical', 'High')")} as high_risk_customers,
              {percent(n_where("churn_risk_level in ('Critical', 'High')"), 'count(*)')} as high_risk_pct
            from u join churn using (UNIQUE_ID) group by all),
      s as (select CATEGORY_TWO, {percent(n_where("segment_name = 'Champions'"), 'count(*)')} as pct_champions,
              {percent(n_where("segment_name = 'Dormant'"), 'count(*)')} as pct_dormant
            from u join seg using (UNIQUE_ID) group by all)
      select CATEGORY_TWO, num_destinations, total_customers, b.total_spend, b.avg_txn_value, avg_spend_per_customer,
        {rnd('r')} as spend_recent_3m, {rnd('p')} as spend_prior_3m,
        {rnd(div('r - p', 'p') + ' * 100::double', 1)} as growth_pct, t.DESTINATION as top_destination_name,
        t.market_share_pct as top_dest_market_share, coalesce(avg_churn_pct, 0) as avg_churn_pct,
        coalesce(high_risk_customers, 0) as high_risk_customers, coalesce(high_risk_pct, 0) as high_risk_pct,
        coalesce(pct_champions, 0) as pct_champions, coalesce(pct_dormant, 0) as pct_dormant,
        {ladder(div('r - p', 'p'), HEALTH, '>')} as health_status
      from b join n using (CATEGORY_TWO) left join g using (CATEGORY_TWO) left join c using (CATEGORY_TWO)
        left join s using (CATEGORY_TWO)
        left join (select * from bench where spend_rank = 1) t using (CATEGORY_TWO)""",
    "pitch": f"""
      with c as (select CATEGORY_TWO, {total('total_spend', 0)} as category_total_spend,
                   max(market_share_pct) as ls, max(penetration_pct) as lp, {mean('market_share_pct')} as ms,
                   {mean('spend_per_customer', 0)} as sp, count(*) as total_competitors from bench group by all),
      h as (select CATEGORY_TWO, DESTINATION, {rnd(mean('churn_probability', 4), 4)} as cp,
              {n_where("churn_risk_level in ('Critical', 'High')")} as hr
            from ccs join churn using (UNIQUE_ID) group by all),
      j as (select b.*, c.* exclude (CATEGORY_TWO), coalesce(cp, 0::double) as ch, coalesce(hr, 0) as hr,
              rank() over (order by category_total_spend) - 1 as below, count(*) over () - 1 as others
            from bench b join c using (CATEGORY_TWO) left join h using (CATEGORY_TWO, DESTINATION))
      select CATEGORY_TWO, DESTINATION, customers, total_spend, market_share_pct, penetration_pct, spend_per_customer,
        spend_rank, category_total_spend, total_competitors,
        {rnd('category_total_spend * (1::double - market_share_pct / 100::double)')} as addressable_market,
        {rnd('ls - market_share_pct', 2)} as gap_to_leader_pct, {rnd('lp - penetration_pct', 2)} as penetration_gap_pct,
        {rnd(div('spend_per_customer', 'sp') + ' * 100::double - 100::double', 1)} as spend_vs_avg_pct,
        ch as avg_churn_probability, hr as high_risk_customers,
        {rnd(div('below', 'others') + ' * 30::double + ' + div('ls - market_share_pct', 'ls') + ' * 30::double'
             + ' + (1::double - ch) * 20::double + least(' + div('spend_per_customer', 'sp') + ', 1::double)'
             + ' * 20::double', 2)} as pitch_score,
        case when spend_rank = 1 then {text(PITCH_ACTIONS['leader'])}
          when market_share_pct >= ms then
            case when ch < 0.3 then {text(PITCH_ACTIONS['grow'])} else {text(PITCH_ACTIONS['protect'])} end
          when spend_per_customer > sp then {text(PITCH_ACTIONS['attack'])}
          else {text(PITCH_ACTIONS['opportunity'])} end as recommended_action
      from j""",
    "explained": f"""
      with f as (select *, days_since_last > 90 as gone, txns_last_3m < txns_prev_3m / 2::double as fell,
                   active_destinations <= 2 as narrow from churn where churn_risk_level in ('Critical', 'High'))
      select UNIQUE_ID, churn_probability, churn_risk_level, total_spend, days_since_last, txns_last_3m, txns_prev_3m,
        active_months, active_destinations, txn_trend, {rnd(div('txns_last_3m', 'txns_prev_3m'), 2)} as frequency_ratio,
        case when gone then printf('Inactive for %d days', days_since_last)
          when fell then 'Transaction frequency dropped >50%'
          when active_months <= 3 then printf('Only active %d months', active_months)
          else 'Declining overall activity pattern' end as reason_1,
        case when fell and not gone then printf('Frequency dropped from %d to %d txns', txns_prev_3m, txns_last_3m)
          when narrow then printf('Only visiting %d merchants', active_destinations)
          when days_since_last > 60 then printf('Last seen %d days ago', days_since_last)
          else 'Spending trend declining' end as reason_2,
        case when narrow and not fell then printf('Low merchant diversity (%d)', active_destinations)
          when txn_trend < 0.5 then 'Spend trend ratio: ' || regexp_replace(printf('%.6f', txn_trend), '[.]?0+$', '')
          when active_months <= 6 then printf('Low engagement: %d active months', active_months)
          else 'Multiple declining signals' end as reason_3
      from f""",
    "rules": f"""
      with a as (
        select UNIQUE_ID, count(*) as total_txns, {total('trns_amt')} as total_spend,
          date_diff('day', max(EFF_DATE), (select d from bounds)) as days_since_last,
          {n_where('EFF_DATE >= (select m3 from bounds)')} as txns_last_3m,
          {n_where('EFF_DATE >= (select m6 from bounds) and EFF_DATE < (select m3 from bounds)')} as txns_prev_3m,
          {total0('trns_amt', 'EFF_DATE >= (select m3 from bounds)')} as spend_last_3m,
          {total0('trns_amt', 'EFF_DATE >= (select m6 from bounds) and EFF_DATE < (select m3 from bounds)')} as spend_prev_3m
        from txn group by UNIQUE_ID having count(*) >= {P.min_feature_txns})
      select a.*, case when days_since_last > 180 then 'Churned'
          when days_since_last > 90 and txns_last_3m < txns_prev_3m then 'High Risk'
          when days_since_last > 60 or 2 * txns_last_3m < txns_prev_3m then 'Medium Risk'
          when txns_last_3m >= txns_prev_3m then 'Low Risk' else 'Stable' end as risk_level,
        age, gender_label, income_segment, credit_risk_class, age_group, income_group
      from a left join cust using (UNIQUE_ID)""",
    "mom": f"""
      with m as (select UNIQUE_ID, txn_month >= (select m6 from bounds) as late, {total('trns_amt')} as spend,
                   count(*) as n from yr group by UNIQUE_ID, txn_month),
      h as (select UNIQUE_ID, {total('spend')} as total_spend_12m, count(*) as active_months,
              {rnd(mean('case when late then spend end'), 2)} as avg_recent_6m,
              {rnd(mean('case when not late then spend end'), 2)} as avg_prior_6m,
              {rnd(mean('case when late then n end', 0), 1)} as avg_recent_txns,
              {rnd(mean('case when not late then n end', 0), 1)} as avg_prior_txns
            from m group by UNIQUE_ID having count(*) >= {P.min_momentum_months})
      select h.*, {rnd(div('avg_recent_6m - avg_prior_6m', 'avg_prior_6m') + ' * 100::double', 1)} as spend_change_pct,
        {rnd(div('avg_recent_txns - avg_prior_txns', 'avg_prior_txns') + ' * 100::double', 1)} as txn_change_pct,
        case when coalesce(avg_prior_6m, 0) = 0 then 'New'
          else {ladder(div('avg_recent_6m - avg_prior_6m', 'avg_prior_6m'), MOMENTUM, '>')} end as momentum_status,
        {rnd('total_spend_12m / 1000::double * greatest(coalesce(1::double - '
             + div('avg_recent_6m', 'avg_prior_6m') + ', 0), 0::double)', 2)} as urgency_score,
        age, gender_label, income_segment, age_group
      from h left join cust using (UNIQUE_ID)""",
    "propensity": f"""
      with c as (select distinct UNIQUE_ID, CATEGORY_TWO from yr where CATEGORY_TWO is not null),
      z as (select segment_name, count(*) as segment_size from seg group by all),
      a as (select segment_name, CATEGORY_TWO, count(*) as segment_cat_customers from c join seg using (UNIQUE_ID)
            group by all),
      t as (select CATEGORY_TWO, count(distinct UNIQUE_ID) as total_cat_customers, {rnd(total('dest_spend'))}
              as total_cat_spend, {rnd(mean('dest_spend'), 2)} as avg_spend_per_customer from ccs group by all),
      j as (select *, {percent('segment_cat_customers', 'segment_size', 2)} as adoption_rate_pct,
              segment_size - segment_cat_customers as unadopted_customers
            from a join z using (segment_name) join t using (CATEGORY_TWO))
      select *, {rnd('unadopted_customers * avg_spend_per_customer')} as potential_revenue,
        {ladder('adoption_rate_pct', PROPENSITY, '>=')} as propensity_level
      from j where adoption_rate_pct < {P.max_adoption_pct}""",
    "loyalty": f"""
      with s as (select UNIQUE_ID, CATEGORY_TWO, count(distinct DESTINATION) as st from ccs group by all)
      select CATEGORY_TWO, DESTINATION, count(*) as customers,
        {rnd(mean('share_of_wallet_pct', 1), 1)} as avg_loyalty_pct, {rnd(mean('st', 0), 1)} as avg_stores_visited,
        {n_where('share_of_wallet_pct >= 50')} as loyal_customers_50pct,
        {percent(n_where('share_of_wallet_pct >= 50'), 'count(*)')} as pct_loyal_50,
        {n_where('share_of_wallet_pct >= 80')} as loyal_customers_80pct,
        {percent(n_where('share_of_wallet_pct >= 80'), 'count(*)')} as pct_loyal_80,
        {n_where('st = 1')} as band_1_store, {n_where('st = 2')} as band_2_stores,
        {n_where('st in (3, 4)')} as band_3_4_stores, {n_where('st in (5, 6, 7)')} as band_5_7_stores,
        {n_where('st > 7')} as band_8_plus, {rnd(total('dest_spend'))} as total_spend,
        {rnd(mean('dest_spend'))} as avg_spend_per_customer
      from ccs join s using (UNIQUE_ID, CATEGORY_TWO) group by CATEGORY_TWO, DESTINATION
      having count(*) >= {P.min_store_customers}""",
    "timepat": f"""
      select y.*, h.peak_hour, w.peak_day_number from (
        select CATEGORY_TWO, DESTINATION, count(*) as total_transactions, count(distinct UNIQUE_ID) as unique_customers,
          {rnd(total('trns_amt'))} as total_spend,
          {', '.join(percent(n_where(f'trns_hour between {a} and {b}'), 'count(*)') + f' as {k}' for k, (a, b) in HOUR_SHARES.items())},
          {percent(n_where('trns_hour not between 6 and 21'), 'count(*)')} as pct_late_night,
          {', '.join(percent(n_where(f'trns_dow = {i + 1}'), 'count(*)') + f' as pct_{d}' for i, d in enumerate(DAYS))},
          {percent(n_where(_WEEKEND), 'count(*)')} as pct_weekend,
          {percent(n_where('trns_dow between 2 and 6'), 'count(*)')} as pct_weekday,
          {', '.join(rnd(mean(f'case when trns_hour between {a} and {b} then trns_amt end'), 2) + f' as {k}' for k, (a, b) in BASKETS.items())}
        from yr group by CATEGORY_TWO, DESTINATION having count(*) >= {P.min_store_txns}) y
      join ({mode_of('yr', ['CATEGORY_TWO', 'DESTINATION'], 'trns_hour', 'peak_hour')}) h
        using (CATEGORY_TWO, DESTINATION)
      join ({mode_of('yr', ['CATEGORY_TWO', 'DESTINATION'], 'trns_dow', 'peak_day_number')}) w
        using (CATEGORY_TWO, DESTINATION)""",
    "segmix": f"""
      with t as (select DESTINATION, CATEGORY_TWO, count(*) as client_total_customers, {total('dest_spend')}
                   as client_total_spend from ccs group by all having count(*) >= {P.min_client_customers}),
      b as (select segment_name, count(*) / (select count(*) from seg)::double as f from seg group by all),
      m as (select DESTINATION, CATEGORY_TWO, segment_name, count(*) as segment_customers,
              {rnd(total('dest_spend'))} as segment_spend from ccs join seg using (UNIQUE_ID) group by all)
      select m.*, client_total_customers, client_total_spend,
        {percent('segment_customers', 'client_total_customers', 2)} as pct_of_client_customers,
        {percent('segment_spend', 'client_total_spend', 2)} as pct_of_client_spend,
        {rnd('f * 100::double', 2)} as population_pct_of_customers,
        {rnd(div(div('segment_customers', 'client_total_customers'), 'f') + ' * 100::double')} as index_vs_population
      from m join t using (DESTINATION, CATEGORY_TWO) left join b using (segment_name)""",
    "home": """
      select UNIQUE_ID, PROVINCE as province from (select UNIQUE_ID, PROVINCE, row_number() over (
        partition by UNIQUE_ID order by count(*) desc, PROVINCE) as pos from yr where PROVINCE is not null
        group by UNIQUE_ID, PROVINCE) where pos = 1""",
    "hits": f"""
      select 'D01' as audience_id, UNIQUE_ID from cust where age >= 25 and age <= 55 and estimated_income >= 56000
      union all select 'D02', UNIQUE_ID from cust where estimated_income >= 23000 and estimated_income <= 56000
      union all select 'D03', UNIQUE_ID from cust where age >= 18 and age <= 25
      union all select 'D04', UNIQUE_ID from cust where age >= 55
      union all select case gender_label when 'Female' then 'D05' else 'D06' end, UNIQUE_ID from cust
        where estimated_income >= 56000 and gender_label <> 'Unknown'
      union all select 'D07', UNIQUE_ID from cust where age >= 26 and age <= 40 and estimated_income >= 23000
      union all {_LIFESTYLE_PARTS}
      union all select 'B0' || cluster_id, UNIQUE_ID from seg where cluster_id <= 2
      union all select 'B03', UNIQUE_ID from churn join rfm using (UNIQUE_ID)
        where val_trns >= 50000 and churn_risk_level in ('Critical', 'High')
      union all select 'B04', UNIQUE_ID from mom where momentum_status = 'Accelerating' and total_spend_12m >= 10000
      union all select 'B05', UNIQUE_ID from mom where momentum_status = 'Declining' and total_spend_12m >= 50000
      union all select 'B06', UNIQUE_ID from rfm where nr_trns >= {P.frequent_txns}
      union all select 'B07', UNIQUE_ID from rfm where active_nav_categories >= 8
      union all {_PROVINCE_PARTS} union all {_SEASON_PARTS}
      union all select 'S04', UNIQUE_ID from yr group by UNIQUE_ID having count(*) >= 12
        and 2 * {n_where('day(EFF_DATE) >= 25 or day(EFF_DATE) <= 3')} >= count(*)
      union all select 'X01', UNIQUE_ID from ccs where dest_spend >= 2000
        and CATEGORY_TWO in {texts(PREMIUM_CATEGORIES)} group by UNIQUE_ID having count(distinct CATEGORY_TWO) >= 3
      union all (select 'X02', UNIQUE_ID from ccs where CATEGORY_TWO = 'Groceries' and dest_spend >= 5000
        intersect select 'X02', UNIQUE_ID from ccs where CATEGORY_TWO = 'Clothing & Apparel' and dest_spend >= 2000)""",
    "members": f"""
      select audience_id, {case('audience_id', {k: v[0] for k, v in AUDIENCES.items()})} as audience_name,
        {case('audience_id', {k: v[1] for k, v in AUDIENCES.items()})} as audience_type, UNIQUE_ID from hits""",
    "who": """
      select h.audience_id, h.UNIQUE_ID, c.age, c.estimated_income, c.gender_label, c.age_group, c.income_group,
        r.val_trns, s.segment_name, k.churn_probability
      from hits h left join cust c using (UNIQUE_ID) left join rfm r using (UNIQUE_ID)
        left join seg s using (UNIQUE_ID) left join churn k using (UNIQUE_ID)""",
    "catalog": f"""
      select audience_id, {case('audience_id', {k: v[0] for k, v in AUDIENCES.items()})} as audience_name,
        {case('audience_id', {k: v[1] for k, v in AUDIENCES.items()})} as audience_type, w.* exclude (audience_id),
        {case('audience_id', PROVINCE_AUDIENCES, "'Mixed'")} as top_province, top_age_group, top_income_group,
        top_segment, {case('audience_id', {k: v[2] for k, v in AUDIENCES.items()}, "'Custom audience segment.'")}
          as description
      from (select audience_id, count(*) as audience_size, {rnd(mean('val_trns'))} as avg_spend,
              {rnd(mean('age'), 1)} as avg_age, {percent(n_where("gender_label = 'Female'"), 'count(*)')} as pct_female,
              {rnd(mean('estimated_income'))} as avg_income, {rnd(mean('churn_probability', 4), 3)} as avg_churn_prob
            from who group by audience_id having count(*) >= {P.min_audience_size}) w
      join ({mode_of('who', ['audience_id'], 'age_group', 'top_age_group')}) a using (audience_id)
      join ({mode_of('who', ['audience_id'], 'income_group', 'top_income_group')}) i using (audience_id)
      join ({mode_of('who', ['audience_id'], 'segment_name', 'top_segment')}) s using (audience_id)""",
    "overlap": f"""
      with t as (select DESTINATION, CATEGORY_TWO, count(distinct UNIQUE_ID) as client_total_customers from ccs
                 group by all having count(distinct UNIQUE_ID) >= {P.min_client_customers})
      select DESTINATION, CATEGORY_TWO, h.audience_id, k.audience_name, k.audience_type,
        count(distinct UNIQUE_ID) as overlap_customers, client_total_customers,
        {percent('count(distinct UNIQUE_ID)', 'client_total_customers', 2)} as pct_of_client
      from ccs join t using (DESTINATION, CATEGORY_TWO) join hits h using (UNIQUE_ID)
        left join catalog k on k.audience_id = h.audience_id
      group by DESTINATION, CATEGORY_TWO, h.audience_id, k.audience_name, k.audience_type, client_total_customers""",
}

_REFERENCES = {
    name: [r for r in RELATIONS if r != name and re.search(rf"\b{r}\b", body)] for name, body in RELATIONS.items()
}


def _ordered(names, seen):
    for name in names:
        if name not in seen:
            _ordered(_REFERENCES[name], seen)
            seen.append(name)
    return seen


def sql_for(query):
    """Query text with the relations it needs in front."""
    used = [r for r in RELATIONS if re.search(rf"\b{r}\b", query)]
    bodies = ",\n".join(f"{name} as ({RELATIONS[name].strip()})" for name in _ordered(used, []))
    return f"with {bodies}\nselect * from ({query.strip()})" if bodies else query.strip()
