"""Small hand-written tables."""

import datetime as dt

from spendgrid.sources.order_tables import RawTables
from spendgrid.sources.schemas import LOOKUPS, SNAPSHOTS, TRANSACTIONS


def day(text):
    return dt.date.fromisoformat(text)


def raw_rows(spark, rows):
    """Raw transactions from dicts; unnamed columns get plain defaults."""
    defaults = {
        "UNIQUE_ID": "a",
        "EFF_DATE": day("2024-03-31"),
        "CATEGORY_ONE_ID": 1,
        "CATEGORY_TWO_ID": 1,
        "NAV_CATEGORY_ID": 1,
        "DESTINATION_ID": 1,
        "LOCATION_ID": 1.0,
        "SUBURB_ID": 1.0,
        "trns_time": "1200",
        "trns_amt": 10.0,
    }
    full = [{**defaults, **row} for row in rows]
    return spark.createDataFrame([tuple(r[f] for f in TRANSACTIONS.names) for r in full], TRANSACTIONS)


def snapshot_rows(spark, rows):
    names = SNAPSHOTS.names
    return spark.createDataFrame([tuple(r.get(f) for f in names) for r in rows], SNAPSHOTS)


def lookups(spark):
    data = {
        "category_one_id": [(1, "Food")],
        "category_two_id": [(1, "Groceries"), (2, "Travel"), (3, "Fuel & Energy")],
        "nav_category_id": [(1, "Nav 1")],
        "destination_id": [(i, f"Store {i}", "Merchant", "In credit") for i in range(1, 10)],
        "location_id": [(1, "Branch 1", 18.5, -33.9)],
        "suburb_id": [(1, "S1", "T1", "M1", "GAUTENG"), (2, "S2", "T2", "M2", "LIMPOPO")],
    }
    return {name: spark.createDataFrame(rows, LOOKUPS[name]) for name, rows in data.items()}


def staged(spark, rows):
    from spendgrid.operators.staging import stage_transactions

    return stage_transactions(raw_rows(spark, rows), lookups(spark))


def raw_tables(spark, txns, snapshots):
    return RawTables(raw_rows(spark, txns), snapshot_rows(spark, snapshots), lookups(spark))


def by_key(df, key="UNIQUE_ID"):
    return {row[key]: row for row in df.collect()}
