"""Customer tables in buckets: what joins on the customer is not shuffled by it."""

import pytest
from pyspark.sql import functions as F

from spendgrid.operators import audiences, marts
from spendgrid.plans.catalog import warehouse
from spendgrid.plans.warehouse import BUCKETED, build_all
from spendgrid.sources.tables import bucketed_name, read_bucketed, write_bucketed


@pytest.fixture
def shuffled(spark):
    """Joins by shuffle, as between tables that are too large to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "true")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "Exchange" in line and "UNIQUE_ID" in line]


def test_no_exchange_on_the_customer(spark, folder, shuffled):
    w = warehouse(spark, folder)
    ccs, segments, churn = w.customer_category_spend, w.segments, w.churn
    frames = {
        "client_segment_mix": marts.client_segment_mix(ccs, segments, 10),
        "pitch_opportunities": marts.pitch_opportunities(w.benchmarks, ccs, churn),
        "category_propensity exposure": ccs.select("UNIQUE_ID", "CATEGORY_TWO").distinct().join(churn, "UNIQUE_ID").join(segments, "UNIQUE_ID"),
        "audience_catalog": audiences.audience_catalog(w.audience_members, w.customers, w.rfm_features, segments, churn, 20),
        "demographic_summary": marts.demographic_summary(ccs, w.customers),
    }
    for name, frame in frames.items():
        assert exchanges(frame) == [], name
    scorecard = marts.category_scorecard(w.transactions, ccs, w.benchmarks, churn, segments, w.as_of)
    assert exchanges(scorecard) == []


def test_plain_tables_would_be_shuffled(spark, folder, shuffled):
    w = warehouse(spark, folder)
    plain = [spark.createDataFrame(t.limit(0).collect(), t.schema) for t in (w.customer_category_spend, w.segments)]
    assert exchanges(marts.client_segment_mix(*plain, 10))


def test_bucketed_table_from_another_session(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(1000).select(F.concat(F.lit("c"), F.col("id") % 70).alias("UNIQUE_ID"), F.col("id").alias("value `x"))
    written = write_bucketed(rows.withColumnRenamed("value `x", "value"), path, "UNIQUE_ID", 6)
    assert len([f for f in (tmp_path / "t").iterdir() if f.name.endswith(".parquet")]) <= 6
    spark.sql(f"DROP TABLE {bucketed_name(path)}")  # the files stay
    again = read_bucketed(spark, path, written.schema, "UNIQUE_ID", 6)
    assert again.count() == 1000 and exchanges(again.groupBy("UNIQUE_ID").count()) == []
    assert write_bucketed(rows.limit(10).withColumnRenamed("value `x", "value"), path, "UNIQUE_ID", 3).count() == 10


def test_build_all_writes_buckets_in_place(spark, folder, tmp_path):
    w = warehouse(spark, folder)
    paths = build_all(w, str(tmp_path / "marts"), ("customers", "rfm_features"))
    assert set(paths) <= BUCKETED
    for name, path in paths.items():
        assert spark.read.parquet(path).count() == w.table(name).count() > 0
