import datetime as dt

import pytest
from pyspark.sql import functions as F

from spendgrid.functions import dialect as d
from spendgrid.operators.features import visited


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "x, dp, expected",
    [(0.125, 2, 0.13), (-0.125, 2, -0.13), (2.5, 0, 3.0), (-2.5, 0, -3.0), (-0.04, 1, 0.0), (1.005, 2, 1.0), (None, 2, None)],
)
def test_round_half(spark, x, dp, expected):
    result = value(spark, d.round_half(F.lit(x).cast("double"), dp))
    assert result == expected
    assert str(result) != "-0.0"


def test_ratio_guards_zero_and_null(spark):
    assert value(spark, d.ratio(F.lit(1), F.lit(0))) is None
    assert value(spark, d.ratio(F.lit(1), F.lit(None))) is None
    assert value(spark, d.ratio(F.lit(1), F.lit(4))) == 0.25


def test_strict_extremes_are_null_with_any_null(spark):
    null = F.lit(None).cast("double")
    assert value(spark, d.strict_least(F.lit(1.0), null)) is None
    assert value(spark, d.strict_greatest(F.lit(1.0), null)) is None
    assert value(spark, d.strict_greatest(F.lit(1.0), F.lit(3.0))) == 3.0


def test_months_before_clamps_to_month_end(spark):
    assert value(spark, d.months_before(dt.date(2024, 3, 31), 1)) == dt.date(2024, 2, 29)
    twice = d.months_before(d.months_before(dt.date(2024, 5, 31), 3), 3)
    assert value(spark, twice) == dt.date(2023, 11, 29)


def test_month_span_counts_boundaries(spark):
    span = d.month_span(F.lit(dt.date(2024, 3, 1)), F.lit(dt.date(2023, 12, 31)))
    assert value(spark, span) == 3


def test_distinct_months_and_exact_sums(spark):
    days = ["2024-01-05", "2024-01-20", "2023-12-31", "2023-03-01"]
    df = spark.createDataFrame([(dt.date.fromisoformat(x), 0.1) for x in days], "day date, amount double")
    row = df.agg(
        d.distinct_months("day", F.lit(dt.date(2024, 1, 31)), 12).alias("months"),
        d.distinct_months("day", F.lit(dt.date(2024, 1, 31)), 12, F.col("day") < "2020-01-01").alias("none"),
        d.exact_sum("amount").alias("total"),
        d.exact_avg("amount").alias("mean"),
    ).first()
    assert (row["months"], row["none"], row["total"], row["mean"]) == (3, 0, 0.4, 0.1)


def test_spread_matches_builtin_and_is_null_for_one_row(spark):
    df = spark.createDataFrame([("a", 1.25), ("a", 7.5), ("a", 3.0), ("b", 2.0)], "k string, x double")
    rows = {r["k"]: r for r in df.groupBy("k").agg(d.spread("x").alias("s"), F.stddev_samp("x").alias("e")).collect()}
    assert rows["a"]["s"] == pytest.approx(rows["a"]["e"])
    assert rows["b"]["s"] is None


def test_modes_break_ties_low_and_count_null(spark):
    data = [("k", 2), ("k", 1), ("m", None), ("m", None), ("m", 5), ("n", None), ("n", 4)]
    counts = spark.createDataFrame(data, "k string, v int").groupBy("k", "v").agg(F.count("*").alias("n"))
    expected = {"k": 1, "m": None, "n": 4}
    assert {r["k"]: r["top_v"] for r in d.top_value(counts, ["k"], "v").collect()} == expected
    picked = d.weigh_modes(counts, ["k"], ["v"]).groupBy("k").agg(d.pick_mode("v").alias("v"))
    assert {r["k"]: r["v"] for r in picked.collect()} == expected


def test_eighty_months_are_eighty(spark):
    rows = spark.range(80).select(F.add_months(F.lit(dt.date(2024, 1, 31)), -F.col("id").cast("int")).alias("day"))
    row = rows.agg(d.distinct_months("day", F.lit(dt.date(2024, 1, 31)), 80).alias("n")).first()
    assert row["n"] == 80


def test_sums_keep_small_and_large_amounts(spark):
    small = spark.range(1000).select(F.lit(0.004).alias("x"))
    assert small.agg(d.exact_sum("x").alias("s")).first()["s"] == 4.0
    mixed = spark.createDataFrame([(4e13 + 0.25,), (-0.004,), (-4e13,), (5e7,)], "x double")
    row = mixed.agg(d.exact_sum("x").alias("s"), d.spread("x").alias("sd"), d.sum_where(F.col("x") < 0, "x").alias("w")).first()
    assert row["s"] == 50000000.246 and row["sd"] > 1e13 and row["w"] == -4e13 - 0.004


def test_totals_and_distinct_counts(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 1, 5), ("a", 2, None), ("b", 3, None), ("c", None, None)], "k string, v int, w int")
    totals = d.totals_within(df.where("v > 0"), ["k"], total=F.sum("v"))
    assert sorted((r["k"], r["v"], r["total"]) for r in totals.collect()) == [("a", 1, 4), ("a", 1, 4), ("a", 2, 4), ("b", 3, 3)]
    counts = df.groupBy("k").agg(*visited({"v": "n", "w": "m"}), *visited({"v": "few"}, where=F.col("v") < 2))
    assert {r["k"]: (r["n"], r["m"], r["few"]) for r in counts.collect()} == {"a": (2, 1, 1), "b": (1, 0, 0), "c": (0, 0, 0)}


def test_plain_numbers_have_no_trailing_zeros(spark):
    numbers = [(0.3, "0.3"), (0.0, "0"), (2.0, "2"), (10.0, "10"), (0.25, "0.25"), (-1.5, "-1.5")]
    assert [value(spark, d.plain_number(F.lit(x))) for x, _ in numbers] == [t for _, t in numbers]


def test_money_label(spark):
    labels = [value(spark, d.money_label(F.lit(x))) for x in (1_250_000.0, 3_400.0, 56.0)]
    assert labels == ["R1.3M", "R3.4k", "R56"]
