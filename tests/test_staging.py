from pyspark.sql import functions as F
from tests.helpers import by_key, day, lookups, raw_rows, snapshot_rows, staged

from spendgrid.operators import staging


def test_invalid_facts_are_dropped(spark):
    rows = [{}, {"trns_amt": None}, {"EFF_DATE": None}, {"UNIQUE_ID": None}]
    assert staged(spark, rows).count() == 1


def test_hours_that_do_not_parse_are_null(spark):
    rows = [{"UNIQUE_ID": str(i), "trns_time": t} for i, t in enumerate([None, "ab", "2359", ""])]
    hours = {k: r["trns_hour"] for k, r in by_key(staged(spark, rows)).items()}
    assert hours == {"0": None, "1": None, "2": 23, "3": None}


def test_missing_lookup_keeps_the_row(spark):
    row = staged(spark, [{"DESTINATION_ID": 999, "SUBURB_ID": None}]).first()
    assert row["DESTINATION"] is None and row["PROVINCE"] is None and row["CATEGORY_TWO"] == "Groceries"


def test_calendar_parts(spark):
    row = staged(spark, [{"EFF_DATE": day("2024-03-31")}]).first()
    assert (row["trns_year"], row["trns_month"], row["trns_dow"]) == (2024, 3, 1)
    assert row["txn_month"] == day("2024-03-01")


def test_bands(spark):
    ages = {25.0: "18-25", 26.0: "26-35", 60.0: "46-60", 61.0: "60+", None: "Unknown"}
    incomes = {None: "Unknown", 0.0: "Unknown", 5500.0: "R0-R5.5k", 56000.0: "R32.5k-R56k", 56001.0: "R56k+"}
    rows = [
        {"UNIQUE_ID": f"{a}/{i}", "month": day("2024-01-01"), "demo_1": 2, "demo_2": a, "demo_7": i}
        for a in ages
        for i in incomes
    ]
    got = by_key(staging.stage_customers(snapshot_rows(spark, rows)))
    for age, age_band in ages.items():
        for income, income_band in incomes.items():
            row = got[f"{age}/{income}"]
            assert (row["age_group"], row["income_group"], row["gender_label"]) == (age_band, income_band, "Unknown")


def test_latest_snapshot_wins_and_ties_are_stable(spark):
    rows = [
        {"UNIQUE_ID": "a", "month": day("2024-01-01"), "demo_2": 30.0},
        {"UNIQUE_ID": "a", "month": day("2024-02-01"), "demo_2": 32.0},
        {"UNIQUE_ID": "a", "month": day("2024-02-01"), "demo_2": 31.0},
        {"UNIQUE_ID": None, "month": day("2024-02-01"), "demo_2": 99.0},
    ]
    for order in (rows, rows[::-1]):
        got = staging.stage_customers(snapshot_rows(spark, order)).collect()
        assert [(r["UNIQUE_ID"], r["age"]) for r in got] == [("a", 31.0)]


def test_window_prunes_month_partitions(spark, tmp_path):
    from spendgrid.sources.tables import write_table

    rows = [{"EFF_DATE": day(f"2024-{m:02d}-15"), "UNIQUE_ID": str(m)} for m in range(1, 13)]
    txns = write_table(staged(spark, rows), str(tmp_path / "t"), ["txn_month"], ["CATEGORY_TWO"])
    as_of = staging.date_bounds(txns)
    assert as_of == day("2024-12-15")
    recent = staging.last_months(txns, as_of, 3)
    assert recent.count() == 4
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(txn_month" in plan


def test_skewed_partition_is_kept_whole(spark, tmp_path):
    from spendgrid.sources.tables import write_table

    df = spark.range(5000).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 50).alias("m"), "id")
    assert write_table(df, str(tmp_path / "t"), ["m"], ["id"]).count() == 5000


def test_stage_uses_the_given_lookups(spark):
    got = staging.stage_transactions(raw_rows(spark, [{"SUBURB_ID": 2.0}]), lookups(spark)).first()
    assert (got["PROVINCE"], got["SUBURB_ID"], got["longitude"]) == ("LIMPOPO", 2, 18.5)
