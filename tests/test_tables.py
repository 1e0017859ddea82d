import datetime as dt
from itertools import combinations
from math import floor

import pytest
from pyspark.sql import functions as F
from tests.helpers import by_key, day, snapshot_rows, staged

from spendgrid.operators import audiences, features, marts, ml, staging
from spendgrid.operators.reports import audiences as audience_reports, merchants as merchant_reports
from spendgrid.params import Params

AS_OF = day("2024-03-31")


def half_up(x, dp):
    return floor(x * 10**dp + 0.5) / 10**dp


def customers(spark, ids="abc"):
    rows = [{"UNIQUE_ID": i, "month": day("2024-03-01"), "demo_1": 1, "demo_2": 30.0, "demo_7": 60000.0} for i in ids]
    return staging.stage_customers(snapshot_rows(spark, rows))


def test_features_need_two_transactions(spark):
    rows = [
        {"UNIQUE_ID": "a"},
        {"UNIQUE_ID": "a", "EFF_DATE": day("2024-03-21"), "trns_amt": 30.0, "DESTINATION_ID": 2, "trns_time": "xx"},
        {"UNIQUE_ID": "b"},
    ]
    got = by_key(features.rfm_features(staged(spark, rows), AS_OF))
    assert set(got) == {"a"}
    a = got["a"]
    assert (a["nr_trns"], a["val_trns"], a["median_val"], a["days_between"]) == (2, 40.0, 10.0, 10.0)
    assert (a["active_destinations"], a["active_months"], a["avg_hour"], a["std_val"]) == (2, 1, 12.0, 14.14)


def test_share_of_wallet(spark):
    rows = [
        {"UNIQUE_ID": "a", "trns_amt": 30.0},
        {"UNIQUE_ID": "a", "trns_amt": 10.0, "DESTINATION_ID": 2},
        {"UNIQUE_ID": "a", "trns_amt": 5.0, "CATEGORY_TWO_ID": 2},
        {"UNIQUE_ID": "b", "trns_amt": 0.0},
    ]
    got = features.customer_category_spend(staged(spark, rows), AS_OF).collect()
    shares = {(r["UNIQUE_ID"], r["CATEGORY_TWO"], r["DESTINATION"]): r["share_of_wallet_pct"] for r in got}
    assert shares == {
        ("a", "Groceries", "Store 1"): 75.0,
        ("a", "Groceries", "Store 2"): 25.0,
        ("a", "Travel", "Store 1"): 100.0,
        ("b", "Groceries", "Store 1"): None,
    }


def test_metrics_rank_and_shares(spark):
    rows = [{"UNIQUE_ID": f"c{i}", "DESTINATION_ID": 1 + i % 3, "trns_amt": 10.0 * (1 + i % 3)} for i in range(9)]
    ccs = features.customer_category_spend(staged(spark, rows), AS_OF).cache()
    totals = features.merchant_totals(ccs).cache()
    got = by_key(features.destination_metrics(totals, ccs), "DESTINATION")
    assert [got[f"Store {i}"]["spend_rank"] for i in (3, 2, 1)] == [1, 2, 3]
    assert got["Store 3"]["market_share_pct"] == 50.0
    assert got["Store 1"]["penetration_pct"] == 33.33


def test_affinity_equals_brute_force(spark):
    baskets = {"a": {1, 2}, "b": {1, 2, 3}, "c": {1}, "d": {2, 3}, "e": {1, 2}}
    rows = [{"UNIQUE_ID": k, "CATEGORY_TWO_ID": c} for k, cats in baskets.items() for c in cats for _ in range(2)]
    names = {1: "Groceries", 2: "Travel", 3: "Fuel & Energy"}
    got = {
        (r["category_a"], r["category_b"]): r
        for r in marts.category_affinity(staged(spark, rows), AS_OF, min_shared=1).collect()
    }
    for x, y in combinations(names, 2):
        a, b = sorted((names[x], names[y]))
        shared = sum({x, y} <= cats for cats in baskets.values())
        n_x, n_y = (sum(c in cats for cats in baskets.values()) for c in (x, y))
        row = got[(a, b)]
        assert row["shared_customers"] == shared
        assert row["lift"] == half_up(shared * 5 / (n_x * n_y), 2)
        assert row["jaccard_pct"] == half_up(100 * shared / (n_x + n_y - shared), 1)


def test_cohorts_count_month_zero_and_stop_at_the_horizon(spark):
    days = {"a": ["2022-01-31", "2022-03-01", "2023-06-01"], "b": ["2022-01-01"], "c": ["2022-02-10"]}
    rows = [{"UNIQUE_ID": k, "EFF_DATE": day(d)} for k, ds in days.items() for d in ds]
    got = {
        (str(r["cohort_month"]), r["months_since_first"]): (r["cohort_size"], r["retention_pct"])
        for r in marts.cohort_retention(staged(spark, rows)).collect()
    }
    assert got == {("2022-01-01", 0): (2, 100.0), ("2022-01-01", 2): (2, 50.0), ("2022-02-01", 0): (1, 100.0)}


def test_customer_without_prior_half_is_new(spark):
    rows = [{"UNIQUE_ID": "a", "EFF_DATE": day(f"2024-0{m}-10")} for m in (1, 2, 3)]
    rows += [{"UNIQUE_ID": "b", "EFF_DATE": day(f"2023-{m}-10"), "trns_amt": 100.0} for m in ("06", "07")]
    rows += [{"UNIQUE_ID": "b", "EFF_DATE": day("2024-02-10"), "trns_amt": 10.0}, {"UNIQUE_ID": "c"}]
    got = by_key(marts.spend_momentum(staged(spark, rows), customers(spark), AS_OF))
    assert set(got) == {"a", "b"}
    assert got["a"]["momentum_status"] == "New" and got["a"]["avg_prior_6m"] is None
    assert got["b"]["momentum_status"] == "Declining" and got["b"]["spend_change_pct"] == -90.0
    assert got["b"]["urgency_score"] == pytest.approx(0.19)


def test_boundary_month_counts_as_prior(spark):
    # the middle date is 2023-09-30, so all of September belongs to the prior half
    days = ["2023-09-30", "2023-10-01", "2024-01-01"]
    rows = [{"UNIQUE_ID": "a", "EFF_DATE": day(d), "trns_amt": 10.0 * i} for i, d in enumerate(days, 1)]
    row = marts.spend_momentum(staged(spark, rows), customers(spark), AS_OF).first()
    assert (row["avg_prior_6m"], row["avg_recent_6m"]) == (10.0, 25.0)


def test_unknown_hours_count_as_late_night_only_in_the_mix(spark):
    rows = [{"trns_time": "xx"}, {"trns_time": "0700"}, {"trns_time": None}, {"trns_time": None}]
    txns = staged(spark, rows)
    segments = features.rfm_features(txns, AS_OF).withColumn("segment_name", F.lit("Champions"))
    mix = marts.behavioral_summary(txns, segments).first()
    assert (mix["pct_morning"], mix["pct_late_night"]) == (25.0, 75.0)
    times = marts.store_time_patterns(txns, AS_OF, min_txns=1).first()
    assert (times["pct_late_night"], times["peak_hour"], times["peak_day_number"]) == (0.0, None, 1)


def test_store_without_category_is_kept(spark):
    rows = [{"CATEGORY_TWO_ID": 77}, {"CATEGORY_TWO_ID": 77, "UNIQUE_ID": "b"}]
    got = marts.store_time_patterns(staged(spark, rows), AS_OF, min_txns=1).collect()
    assert [(r["CATEGORY_TWO"], r["unique_customers"]) for r in got] == [(None, 2)]


def test_loyalty_bands_partition_customers(spark):
    rows = [{"UNIQUE_ID": f"c{i}", "DESTINATION_ID": j} for i in range(1, 10) for j in range(1, i + 1)]
    ccs = features.customer_category_spend(staged(spark, rows), AS_OF)
    for r in marts.store_loyalty(ccs, 1).collect():
        bands = [r[c] for c in r.asDict() if c.startswith("band_")]
        assert sum(bands) == r["customers"]


def test_churn_rules_levels(spark):
    rows = [{"UNIQUE_ID": "gone", "EFF_DATE": day("2023-01-01")}] * 2
    rows += [{"UNIQUE_ID": "high", "EFF_DATE": day("2023-12-25")}] * 2
    rows += [{"UNIQUE_ID": "low", "EFF_DATE": day("2024-03-30")}] * 2
    rows += [{"UNIQUE_ID": "once"}]
    got = by_key(ml.churn_rules(staged(spark, rows), customers(spark), AS_OF))
    assert {k: r["risk_level"] for k, r in got.items()} == {"gone": "Churned", "high": "High Risk", "low": "Low Risk"}


def test_training_label_and_missing_values(spark):
    rows = [{"UNIQUE_ID": k, "EFF_DATE": day("2023-08-01")} for k in "aaabbbz"]
    rows += [{"UNIQUE_ID": "b", "EFF_DATE": day("2024-02-01"), "trns_amt": 5.0}, {"UNIQUE_ID": "last"}]
    txns = staged(spark, rows)
    churn = by_key(ml.churn_training_set(txns, customers(spark, "a"), AS_OF, Params(), keep_id=True))
    assert {k: (r["churned"], r["age"]) for k, r in churn.items()} == {"a": (1, 30.0), "b": (0, 0.0)}
    value = by_key(ml.clv_training_set(txns, customers(spark, "a"), AS_OF, Params(), keep_id=True))
    assert {k: r["future_spend"] for k, r in value.items()} == {"a": 0.0, "b": 5.0}


def test_audience_rules(spark):
    people = [
        {"UNIQUE_ID": "rich", "month": AS_OF, "demo_1": 1, "demo_2": 30.0, "demo_7": 56000.0},
        {"UNIQUE_ID": "none", "month": AS_OF},
    ]
    got = audiences.demographic_members(staging.stage_customers(snapshot_rows(spark, people))).collect()
    assert sorted((r["UNIQUE_ID"], r["audience_id"]) for r in got) == [("rich", a) for a in ("D01", "D02", "D05", "D07")]


def test_spending_and_season_rules(spark):
    rows = [
        {"UNIQUE_ID": "food", "trns_amt": 5000.0, "CATEGORY_TWO_ID": 1, "EFF_DATE": day("2023-11-24")},
        {"UNIQUE_ID": "trip", "trns_amt": 2999.99, "CATEGORY_TWO_ID": 2, "SUBURB_ID": 2.0},
        {"UNIQUE_ID": "old", "trns_amt": 9000.0, "EFF_DATE": day("2023-02-01"), "SUBURB_ID": 1.0},
        {"UNIQUE_ID": "x"},
    ]
    txns = staged(spark, rows)
    spend = audiences.spending_members(features.customer_category_spend(txns, AS_OF)).collect()
    assert sorted((r["UNIQUE_ID"], r["audience_id"]) for r in spend) == [("food", "L01")]
    place = audiences.place_and_season_members(txns, AS_OF).collect()
    hits = sorted((r["UNIQUE_ID"], r["audience_id"]) for r in place)
    # one November purchase is its own mean, so twice the mean is not reached
    assert hits == [("food", "G01"), ("x", "G01")]


def test_wallet_bands_partition_the_client(spark):
    rows = [{"UNIQUE_ID": f"c{i}", "DESTINATION_ID": 1 + (i + j) % 4} for i in range(8) for j in range(1 + i % 4)]
    ccs = features.customer_category_spend(staged(spark, rows), AS_OF)
    bands = merchant_reports.wallet_bands(ccs, "Groceries", "Store 1").agg(F.sum("customers")).first()[0]
    summary = merchant_reports.wallet_summary(ccs, "Groceries", "Store 1").first()
    assert bands == summary["client_customers"]
    assert summary["category_customers"] == 8


def test_excluded_pattern_binds_to_the_last_one(spark):
    rows = [(f"D{i}", c, 1, 1.0, 1.0, 1) for i, c in enumerate(["Pharmacy Pets", "Health Pets", "Health"])]
    bench = spark.createDataFrame(
        rows,
        "DESTINATION string, CATEGORY_TWO string, customers int, total_spend double, market_share_pct double, spend_rank int",
    )
    got = audience_reports.search_names(bench, "CATEGORY_TWO", ["%PHARM%", "%HEALTH%"], ["%PET%"])
    assert sorted(r["CATEGORY_TWO"] for r in got.collect()) == ["Health", "Pharmacy Pets"]


def test_all_model_windows_take_one_scan(spark, tmp_path):
    from spendgrid.sources.tables import write_table

    rows = [{"UNIQUE_ID": f"u{i % 3}", "EFF_DATE": AS_OF - dt.timedelta(days=9 * i), "DESTINATION_ID": i % 4 + 1, "trns_amt": 1.5 * i} for i in range(80)]
    txns = write_table(staged(spark, rows), str(tmp_path / "t"), ["txn_month"], ["CATEGORY_TWO"])
    wide = ml.customer_activity(txns, AS_OF, Params())
    plan = wide._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange hashpartitioning") == 1 and "PartitionFilters: [isnotnull(txn_month" in plan
    for build in (ml.churn_training_set, ml.clv_training_set):
        apart = build(txns, customers(spark, ["u0", "u1"]), AS_OF, Params(), keep_id=True)
        shared = build(txns, customers(spark, ["u0", "u1"]), AS_OF, Params(), keep_id=True, wide=wide)
        assert by_key(apart) == by_key(shared) != {}
    # Each window alone gives what it gives beside the others.
    for name, window in ml._windows(Params()).items():
        alone = by_key(features.activity(txns, AS_OF, window, 3))
        assert alone == by_key(features.activity_in(wide, name, 3)) != {}
