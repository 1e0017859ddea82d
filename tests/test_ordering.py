import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from spendgrid.functions.ordering import (
    bucket_ends,
    exclusive_rank,
    global_ntile,
    order_statistics,
    row_number_within,
)

# so small that several passes are taken on test data
TIGHT = {"limit": 40, "sample_rows": 120}


@pytest.fixture(scope="module")
def tied(spark):
    """2003 rows; a third share one value."""
    value = F.when(F.col("id") % 3 == 0, 7).otherwise(F.pmod(F.xxhash64("id"), F.lit(500)))
    df = spark.range(2003).select(F.format_string("c%05d", (F.col("id") * 7919) % 2003).alias("key"), value.alias("v"))
    return df.cache()


def expected(df, ranks):
    rows = sorted((r["v"], r["key"]) for r in df.collect())
    return {r: rows[r - 1] for r in ranks}


@pytest.mark.parametrize("limits", [{}, TIGHT])
def test_order_statistics_are_exact(tied, limits):
    ranks = [1, 2, 400, 668, 1001, 2002, 2003]
    assert order_statistics(tied, ["v", "key"], ranks, **limits) == expected(tied, ranks)


def test_ranks_outside_the_table_are_ignored(tied):
    assert order_statistics(tied, ["v", "key"], [0, 5000]) == {}


@pytest.mark.parametrize("limits", [{}, TIGHT])
@pytest.mark.parametrize("n", [1, 4, 5])
def test_global_ntile_equals_window(tied, n, limits):
    window = F.ntile(n).over(Window.orderBy("v", "key"))
    both = tied.select(window.alias("a"), global_ntile(tied, n, ["v", "key"], **limits).alias("b"))
    assert both.where("a <> b").count() == 0


@pytest.mark.parametrize("size", [0, 1, 3, 7])
def test_global_ntile_on_short_tables(spark, size):
    df = spark.range(size).select(F.col("id").alias("v"), F.col("id").cast("string").alias("key"))
    got = [r["t"] for r in df.select("v", global_ntile(df, 5, ["v", "key"]).alias("t")).orderBy("v").collect()]
    want = df.select("v", F.ntile(5).over(Window.orderBy("v", "key")).alias("t")).orderBy("v")
    assert got == [r["t"] for r in want.collect()]


def test_bucket_ends_give_the_first_buckets_one_more():
    assert bucket_ends(7, 5) == [2, 4, 5, 6]


@pytest.mark.parametrize("limits", [{}, {"slices": 1}, {"slices": 300}])
def test_row_number_within_hot_group(spark, limits):
    group = F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("g"), (F.col("id") % 11).cast("string")))
    df = spark.range(3000).select(
        group.alias("g"), (F.col("id") % 17).alias("v"), F.format_string("%06d", "id").alias("key")
    )
    window = F.row_number().over(Window.partitionBy("g").orderBy("v", "key"))
    got = row_number_within(df, "g", ["v", "key"], "n", **limits)
    assert got.count() == 3000
    assert got.withColumn("e", window).where("n <> e").count() == 0


def test_exclusive_rank_shares_ties(spark):
    groups = spark.createDataFrame([("a", 10.0, 2), ("b", 5.0, 3), ("c", 10.0, 4), ("d", 11.0, 1)], "g string, v double, n int")
    below = {r["v"]: r["rows_below"] for r in exclusive_rank(groups, "v", "n").collect()}
    assert below == {5.0: 0, 10.0: 3, 11.0: 9}
