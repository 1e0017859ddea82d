"""One customer, merchant or month with a third of the rows gives the same results."""

from collections import Counter, defaultdict

import pytest
from tests.helpers import by_key, day, staged

from spendgrid.operators import audiences, features, marts

AS_OF = day("2024-03-31")


@pytest.fixture(scope="module")
def rows():
    """600 rows: a third belong to one customer, a third to one merchant."""
    out = []
    for i in range(600):
        out.append(
            {
                "UNIQUE_ID": "hot" if i % 3 == 0 else f"c{i % 41}",
                "DESTINATION_ID": 1 if i % 3 == 1 else 2 + i % 8,
                "CATEGORY_TWO_ID": 1 + i % 2,
                "trns_amt": float(i % 97) + 0.25,
                "EFF_DATE": day("2024-03-31") if i % 3 == 2 else day(f"2024-0{1 + i % 3}-1{i % 10}"),
            }
        )
    return out


NAMES = {1: "Groceries", 2: "Travel"}


def test_spend_and_features(spark, rows):
    txns = staged(spark, rows)
    spend = defaultdict(float)
    for r in rows:
        spend[(r["UNIQUE_ID"], NAMES[r["CATEGORY_TWO_ID"]], f"Store {r['DESTINATION_ID']}")] += r["trns_amt"]
    got = features.customer_category_spend(txns, AS_OF).collect()
    assert {(r["UNIQUE_ID"], r["CATEGORY_TWO"], r["DESTINATION"]): r["dest_spend"] for r in got} == spend
    totals = defaultdict(float)
    for (customer, category, _), value in spend.items():
        totals[(customer, category)] += value
    assert all(r["category_spend"] == totals[(r["UNIQUE_ID"], r["CATEGORY_TWO"])] for r in got)
    stores = defaultdict(set)
    for r in rows:
        stores[r["UNIQUE_ID"]].add(r["DESTINATION_ID"])
    table = by_key(features.rfm_features(txns, AS_OF))
    assert {k: r["active_destinations"] for k, r in table.items()} == {k: len(v) for k, v in stores.items()}
    assert table["hot"]["nr_trns"] == 200


def test_overlap_and_loyalty(spark, rows):
    ccs = features.customer_category_spend(staged(spark, rows), AS_OF)
    members = [(a, "n", "t", c) for c in ["hot", *[f"c{i}" for i in range(41)]] for a in ("D01", "D02", "L01")]
    members = [m for m in members if not (m[0] == "L01" and m[3] != "hot")]
    table = spark.createDataFrame(members, "audience_id string, audience_name string, audience_type string, UNIQUE_ID string")
    catalog = table.select("audience_id", "audience_name", "audience_type").distinct()
    got = audiences.audience_client_overlap(ccs, table, catalog, 1).collect()
    visits = {(f"Store {r['DESTINATION_ID']}", NAMES[r["CATEGORY_TWO_ID"]], r["UNIQUE_ID"]) for r in rows}
    want = Counter((s, c, a) for s, c, u in visits for a, _, _, m in members if m == u)
    assert {(r["DESTINATION"], r["CATEGORY_TWO"], r["audience_id"]): r["overlap_customers"] for r in got} == want
    loyal = marts.store_loyalty(ccs, 1).collect()
    clients = Counter((s, c) for s, c, _ in visits)
    assert {(r["DESTINATION"], r["CATEGORY_TWO"]): r["customers"] for r in loyal} == clients
