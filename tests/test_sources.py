import hashlib
import json

import pytest
from pyspark.sql import functions as F
from tests.helpers import day, lookups, raw_rows

from spendgrid.sources import ingest, jdbc, schemas, tables
from spendgrid.streaming import incremental


def test_monthly_csv(spark, tmp_path):
    path = tmp_path / "drop.csv"
    path.write_bytes(
        "﻿UNIQUE_ID, EFF_DATE ,demo_1,demo_2,EMAIL_ADDR,CUST_CELL_NO\n"
        "a,05JAN2026,1,30.5, Ab C ,082 1\n"
        "b,bad,x,n/a,,\n".encode()
        + b"c\xff,31FEB2026,2.0,1,Z,1\n"
    )
    df = ingest.read_monthly_csv(spark, str(path))
    assert df.columns == ["UNIQUE_ID", "EFF_DATE", "demo_1", "demo_2", "EMAIL_ADDR", "CUST_CELL_NO"]
    rows = df.collect()
    assert (rows[0]["EFF_DATE"], rows[0]["demo_1"], rows[0]["demo_2"]) == (day("2026-01-05"), 1, 30.5)
    assert rows[0]["EMAIL_ADDR"] == hashlib.sha256(b"abc").hexdigest()
    assert (rows[1]["EFF_DATE"], rows[1]["demo_1"], rows[1]["EMAIL_ADDR"]) == (None, None, None)
    assert rows[2]["UNIQUE_ID"] == "c�" and rows[2]["demo_1"] == 2 and rows[2]["EFF_DATE"] is None
    assert ingest.read_monthly_csv(spark, str(path), limit=1).count() == 1
    checks = {r["column_name"]: (r["checked"], r["not_hashed"]) for r in ingest.check_hashed(df).collect()}
    assert checks == {"EMAIL_ADDR": (2, 0), "CUST_CELL_NO": (2, 0)}


def test_unhashed_values_are_reported(spark):
    df = spark.createDataFrame([("plain",), (None,)], "EMAIL_ADDR string")
    row = ingest.check_hashed(df).first()
    assert (row["checked"], row["not_hashed"]) == (1, 1)


def test_jdbc_options_and_checks():
    options = jdbc.jdbc_options("jdbc:x", "t", "dbo", key="id", bounds=(1, 9), partitions=4)
    assert options["dbtable"] == "dbo.t" and options["numPartitions"] == "4" and options["lowerBound"] == "1"
    assert "partitionColumn" not in jdbc.jdbc_options("jdbc:x", "t")
    assert "o''x" in jdbc.existence_query("o'x", "dbo")
    assert jdbc.missing_tables(lambda name: name == "here", ["here", "gone"]) == ["gone"]


def test_catalog_check(spark):
    spark.range(1).createOrReplaceTempView("present_view")
    assert jdbc.missing_in_catalog(spark, ["present_view", "absent_view"]) == ["absent_view"]


def test_schema_diff(spark):
    actual = spark.createDataFrame([], "UNIQUE_ID string, extra int").schema
    sides = {r["column_name"]: r["side"] for r in schemas.schema_diff(spark, actual, schemas.SNAPSHOTS).collect()}
    assert sides["UNIQUE_ID"] == "both" and sides["extra"] == "actual only" and sides["month"] == "expected only"


def test_csv_and_json_targets(spark, tmp_path):
    df = spark.range(3)
    test, live = str(tmp_path / "test"), str(tmp_path / "live")
    assert tables.write_csv(df, test, live, dry_run=True) == test
    assert not (tmp_path / "test").exists()
    assert tables.write_csv(df, test, live, test=False) == live
    assert spark.read.option("header", True).csv(live).count() == 3
    paths = tables.export_json({"numbers": df}, str(tmp_path / "json"))
    lines = [json.loads(x) for f in (tmp_path / "json" / "numbers").glob("*.json") for x in f.read_text().split()]
    assert sorted(x["id"] for x in lines) == [0, 1, 2] and list(paths) == ["numbers"]


def test_load_raw_reads_the_model(spark, tmp_path):
    raw_rows(spark, [{}]).write.parquet(str(tmp_path / "transaction_data"))
    spark.createDataFrame([], schemas.SNAPSHOTS).write.parquet(str(tmp_path / "base_data"))
    for name, df in lookups(spark).items():
        df.write.parquet(str(tmp_path / name))
    raw = tables.load_raw(spark, str(tmp_path))
    assert raw.transactions.count() == 1 and raw.lookups["category_two_id"].count() == 3


def test_incremental_append_takes_only_newer_days(spark, tmp_path):
    path = str(tmp_path / "staged")
    first = raw_rows(spark, [{"EFF_DATE": day("2024-01-01")}, {"EFF_DATE": day("2024-01-02")}])
    second = first.unionByName(raw_rows(spark, [{"EFF_DATE": day("2024-01-03")}]))
    incremental.incremental_stage(first, lookups(spark), path)
    assert incremental.incremental_stage(second, lookups(spark), path).count() == 3


def test_late_rows_of_a_staged_day_are_staged(spark, tmp_path):
    path = str(tmp_path / "staged")
    first = raw_rows(spark, [{"EFF_DATE": day("2024-01-31")}, {"EFF_DATE": day("2024-02-02")}])
    late = first.unionByName(raw_rows(spark, [{"EFF_DATE": day("2024-02-02")}, {"EFF_DATE": day("2024-02-01"), "trns_amt": None}]))
    for raw, n in ((first, 2), (late, 3), (late, 3)):
        assert incremental.incremental_stage(raw, lookups(spark), path).count() == n
    assert spark.read.parquet(path).count() == 3


def test_stream_stages_each_file_once(spark, tmp_path):
    incoming, path, offsets = (str(tmp_path / n) for n in ("in", "out", "offsets"))
    raw_rows(spark, [{"UNIQUE_ID": "a"}, {"UNIQUE_ID": "b"}]).write.parquet(incoming)
    incremental.stream_stage(spark, incoming, lookups(spark), path, offsets)
    raw_rows(spark, [{"UNIQUE_ID": "c", "trns_amt": None}, {"UNIQUE_ID": "d"}]).write.mode("append").parquet(incoming)
    for _ in range(2):  # the second run finds nothing new
        incremental.stream_stage(spark, incoming, lookups(spark), path, offsets)
    staged = incremental.read_staged(spark, path)
    assert sorted(r["UNIQUE_ID"] for r in staged.select("UNIQUE_ID").collect()) == ["a", "b", "d"]
    assert staged.where(F.col("DESTINATION") == "Store 1").count() == 3
    # A new checkpoint counts batches from 0 again and leaves the staged rows alone.
    later = str(tmp_path / "later")
    raw_rows(spark, [{"UNIQUE_ID": "e"}]).write.parquet(later)
    incremental.stream_stage(spark, later, lookups(spark), path, str(tmp_path / "offsets2"))
    assert incremental.read_staged(spark, path).count() == 4


@pytest.mark.parametrize("partitioned", [True, False])
def test_metrics_are_taken_by_the_write(spark, tmp_path, partitioned):
    df = spark.range(1000).select((F.col("id") % 7).alias("m"), F.when(F.col("id") % 10 > 0, F.col("id")).alias("v"))
    watch = tables.Watch(missing=F.count_if(F.col("v").isNull()))
    path = str(tmp_path / "t")
    written = tables.write_table(df, path, ["m"] if partitioned else [], ["v"], watch=watch)
    assert watch.values() == {"row_count": 1000, "missing": 100} and written.count() == 1000
    watch = tables.Watch()
    tables.write_bucketed(df, str(tmp_path / "b"), "m", 3, watch=watch)
    assert watch.values() == {"row_count": 1000}


def test_measures_of_stored_tables_cause_no_job(spark, folder):
    from spendgrid.operators import quality
    from spendgrid.plans.catalog import warehouse

    w = warehouse(spark, folder)
    names = ("cluster_profiles", "segments", "destination_metrics", "monthly_trends")
    measured = [w.measures(t) for t in names]
    checks = quality.measured_checks(spark, *measured)
    assert "FileScan" not in checks._jdf.queryExecution().executedPlan().toString()
    scanned = quality.table_checks(w.cluster_profiles, w.segments, w.benchmarks, w.monthly_trends)
    assert sorted(map(tuple, checks.collect())) == sorted(map(tuple, scanned.collect()))
    assert [m["row_count"] for m in measured] == [w.table(t).count() for t in names]
