"""Incremental builds: what changes in the files shows in the table, and nothing else is read again."""

import datetime as dt
import shutil

import pytest
from pyspark.sql import functions as F
from tests.helpers import day, lookups, raw_rows

from spendgrid.operators import features, partials, staging
from spendgrid.streaming import incremental, ledger

JAN, FEB, MAR = (dt.date(2024, m, 1) for m in (1, 2, 3))


@pytest.fixture
def place(spark, tmp_path):
    """A folder of three source files: January and February, February, March."""
    put(spark, tmp_path, "a", [("2024-01-05", 10.0), ("2024-01-05", 10.0), ("2024-02-01", 1.25)])
    put(spark, tmp_path, "b", [("2024-02-20", 7.0), ("2024-02-21", None)])
    put(spark, tmp_path, "c", [("2024-03-31", 3.0)])
    return tmp_path


def put(spark, place, name, days):
    rows = [{"EFF_DATE": day(d), "trns_amt": amount, "UNIQUE_ID": name} for d, amount in days]
    raw_rows(spark, rows).coalesce(1).write.mode("overwrite").parquet(str(place / "part" / name))
    (place / "raw dir").mkdir(exist_ok=True)
    for file in (place / "part" / name).glob("*.parquet"):
        shutil.copy(file, place / "raw dir" / f"{name}.parquet")


def run(spark, place, look=None, **options):
    return ledger.refresh(spark, str(place / "raw dir"), look or lookups(spark), str(place / "staged"), **options)


def names(files):
    return [f.rsplit("/", 1)[1][0] for f in files]


def amounts(table):
    return sorted((r["EFF_DATE"].isoformat(), r["trns_amt"]) for r in table.select("EFF_DATE", "trns_amt").collect())


def test_unchanged_files_are_not_read_again(spark, place):
    first = run(spark, place)
    assert (first.changed, first.removed, names(first.scanned)) == ([JAN, FEB, MAR], [], ["a", "b", "c"])
    assert len(amounts(first.table)) == 5
    again = run(spark, place)
    assert (again.changed, again.removed, again.scanned, again.staged) == ([], [], [], [])
    assert amounts(again.table) == amounts(first.table)


def test_corrected_row_with_equal_counts(spark, place):
    run(spark, place)
    put(spark, place, "b", [("2024-02-20", 8.0), ("2024-02-21", None)])
    done = run(spark, place)
    assert (done.changed, done.removed, names(done.scanned), names(done.staged)) == ([FEB], [], ["b"], ["a", "b"])
    assert ("2024-02-20", 8.0) in amounts(done.table) and len(amounts(done.table)) == 5


def test_removed_file_and_month(spark, place):
    run(spark, place)
    (place / "raw dir" / "c.parquet").unlink()
    done = run(spark, place)
    assert (done.changed, done.removed, done.scanned) == ([], [MAR], [])
    assert max(d for d, _ in amounts(done.table)) == "2024-02-20"


def test_new_late_and_swapped_rows(spark, place):
    run(spark, place)
    put(spark, place, "d", [("2024-01-31", 5.0), ("2024-04-01", 6.0)])
    done = run(spark, place)
    assert (done.changed, names(done.scanned), names(done.staged)) == ([JAN, dt.date(2024, 4, 1)], ["d"], ["a", "d"])
    # Two rows of a pair that cancel in an XOR: the sums show them.
    put(spark, place, "a", [("2024-01-05", 11.0), ("2024-01-05", 11.0), ("2024-02-01", 1.25)])
    assert run(spark, place).changed == [JAN]


def test_compacted_files_change_nothing(spark, place):
    before = amounts(run(spark, place).table)
    raw = spark.read.parquet(str(place / "raw dir"))
    raw.coalesce(1).write.parquet(str(place / "one"))
    for file in (place / "raw dir").glob("*.parquet"):
        file.unlink()
    for file in (place / "one").glob("*.parquet"):
        shutil.copy(file, place / "raw dir" / "e.parquet")
    done = run(spark, place)
    assert (done.changed, done.removed, names(done.scanned)) == ([], [], ["e"])
    assert amounts(done.table) == before


def test_changed_lookup_stages_every_month(spark, place):
    run(spark, place)
    look = lookups(spark)
    look["destination_id"] = look["destination_id"].withColumn("DESTINATION", F.upper("DESTINATION"))
    done = run(spark, place, look)
    assert (done.changed, done.scanned) == ([JAN, FEB, MAR], [])
    assert {r["DESTINATION"] for r in done.table.select("DESTINATION").collect()} == {"STORE 1"}


def test_failed_step_is_repeated(spark, place):
    run(spark, place)
    put(spark, place, "c", [("2024-03-31", 4.0)])

    def fails(*_):
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        run(spark, place, then=fails)
    seen = []
    done = run(spark, place, then=lambda *what: seen.append(what[1:]))
    assert seen == [([MAR], [])] and ("2024-03-31", 4.0) in amounts(done.table)


def test_nulls_in_other_columns_count_by_place(spark):
    a = raw_rows(spark, [{"NAV_CATEGORY_ID": None, "DESTINATION_ID": 7}])
    b = raw_rows(spark, [{"NAV_CATEGORY_ID": 7, "DESTINATION_ID": None}])
    content = [ledger.month_entries(x).first() for x in (a, b)]
    assert content[0]["rows"] == content[1]["rows"] == 1 and content[0]["mixed"] != content[1]["mixed"]


def test_empty_source(spark, tmp_path):
    (tmp_path / "raw dir").mkdir()
    assert run(spark, tmp_path).table is None
    put(spark, tmp_path, "a", [("2024-01-05", None)])
    assert names(run(spark, tmp_path).scanned) == ["a"] and run(spark, tmp_path).scanned == []


# --- monthly partials -------------------------------------------------------------


def spend_of(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("as_of", ["2024-03-31", "2024-03-01", "2024-02-29", "2025-01-31"])
@pytest.mark.parametrize("months", [1, 2, 12])
def test_window_out_of_partials(spark, tmp_path, as_of, months):
    rows = [
        {"UNIQUE_ID": f"u{i % 5}", "EFF_DATE": day("2023-01-15") + dt.timedelta(days=11 * i), "trns_amt": 0.1 * i, "DESTINATION_ID": i % 3 + 1, "CATEGORY_TWO_ID": i % 4}
        for i in range(70)
    ]
    txns = staging.stage_transactions(raw_rows(spark, rows), lookups(spark))
    txns = txns.where(F.col("EFF_DATE") <= F.lit(as_of).cast("date"))
    kept = partials.monthly_spend(txns)
    day_of = day(as_of)
    assert spend_of(partials.customer_category_spend(kept, txns, day_of, months)) == spend_of(features.customer_category_spend(txns, day_of, months))


def test_partials_follow_the_ledger(spark, place):
    path, as_of = str(place / "spend"), day("2024-03-31")
    follow = lambda table, changed, removed: partials.refresh_partials(table, changed, removed, path)
    for step in range(4):
        if step == 1:
            put(spark, place, "b", [("2024-02-20", 9.5)])
        if step == 2:
            (place / "raw dir" / "c.parquet").unlink()
        done = run(spark, place, then=follow)
        kept = spark.read.parquet(path)
        assert spend_of(partials.customer_category_spend(kept, done.table, as_of)) == spend_of(features.customer_category_spend(done.table, as_of))
    assert {r["txn_month"] for r in kept.select("txn_month").distinct().collect()} == {JAN, FEB}


def test_partials_scan_one_month_of_facts(spark, place):
    table = run(spark, place).table
    kept = partials.monthly_spend(table)
    known = spark.createDataFrame(kept.collect(), kept.schema)
    frame = partials.windowed_spend(known, table, day("2024-03-15"), 1)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(txn_month" in plan and plan.count("FileScan") <= 1


# --- the stream ---------------------------------------------------------------------


def test_row_that_arrives_in_two_files_counts_once(spark, tmp_path):
    incoming, path, offsets = (str(tmp_path / n) for n in ("in", "out", "offsets"))
    a, b, c = ({"UNIQUE_ID": x, "SUBURB_ID": None if x == "b" else 1.0} for x in "abc")

    def arrive(*rows):
        raw_rows(spark, list(rows)).coalesce(1).write.mode("append").parquet(incoming)

    def staged():
        return sorted(r["UNIQUE_ID"] for r in incremental.read_staged(spark, path).select("UNIQUE_ID").collect())

    def stream(checkpoint=offsets):
        incremental.stream_stage(spark, incoming, lookups(spark), path, checkpoint)

    arrive(a, a, b)  # twice in one file: two purchases
    arrive(a, b)  # the same rows sent again, in the same batch
    stream()
    assert staged() == ["a", "a", "b"]
    arrive(b, c)  # and once more in a later batch
    arrive(a, a, a)  # a third purchase beside the two known ones
    stream()
    stream()
    assert staged() == ["a", "a", "a", "b", "c"]
    # A new checkpoint reads every file again and finds nothing new in them.
    stream(str(tmp_path / "offsets2"))
    assert staged() == ["a", "a", "a", "b", "c"]
