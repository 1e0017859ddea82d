"""Facts that are staged slice by slice: the same rows, and no shuffle files left of the slices before."""

from spendgrid.params import SMALL_DATA
from spendgrid.plans import warehouse
from spendgrid.plans.catalog import spark_queries
from spendgrid.session import release
from spendgrid.sources import order_tables
from spendgrid.streaming import incremental


def shuffles(spark):
    return spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses().size()


def rows_of(df):
    return sorted(map(repr, df.select(sorted(df.columns)).collect()))


def test_slices_make_up_the_facts(spark, folder, monkeypatch):
    raw = order_tables.raw_tables(spark, folder)
    assert len(raw.parts()) == 1
    monkeypatch.setattr(order_tables, "SLICE_BYTES", 1 << 14)
    parts = raw.parts()
    assert 4 < len(parts) <= order_tables.MOST_SLICES and all(p.count() for p in parts)
    assert sorted(sum((rows_of(p) for p in parts), [])) == rows_of(raw.transactions)
    assert order_tables.slice_count(0) == 1 and order_tables.slice_count(1 << 50) == order_tables.MOST_SLICES


def test_stored_transactions_are_the_same_and_their_shuffles_go(spark, folder, monkeypatch):
    whole = warehouse.Warehouse(spark, folder, lambda: order_tables.raw_tables(spark, folder), SMALL_DATA)
    monkeypatch.setattr(order_tables, "SLICE_BYTES", 1 << 14)
    monkeypatch.setattr(warehouse, "RELEASE_BYTES", 0)
    expected = rows_of(whole.raw.transactions.select("UNIQUE_ID", "EFF_DATE", "trns_amt"))
    sliced = warehouse.Warehouse(spark, folder, lambda: order_tables.raw_tables(spark, folder), SMALL_DATA)
    sliced._base += "-sliced"
    release(spark)
    before = shuffles(spark)
    table = sliced.transactions
    assert shuffles(spark) <= before
    assert rows_of(table.select("UNIQUE_ID", "EFF_DATE", "trns_amt")) == expected
    assert sliced.measures("transactions")["row_count"] == len(expected) and rows_of(table) == rows_of(whole.transactions)
    sliced.rfm_features
    assert shuffles(spark) <= before


def test_a_stream_in_slices_stages_the_same(spark, folder, monkeypatch):
    run = spark_queries()["incremental_stream"]
    whole = rows_of(run(spark, folder))
    monkeypatch.setattr(order_tables, "SLICE_BYTES", 1 << 15)
    monkeypatch.setattr(incremental, "SLICE_ROWS", 2500)
    left, write = [], incremental.write_table
    monkeypatch.setattr(incremental, "write_table", lambda df, path, *a, **b: left.append((path, b.get("mode"))) or write(df, path, *a, **b))
    assert rows_of(run(spark, folder)) == whole and len(whole) > 70
    staged = [mode for path, mode in left if "batch=" in path]
    assert staged[0] == "overwrite" and staged.count("overwrite") == 2 and staged.count("append") >= 2
