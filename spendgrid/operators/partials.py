"""Spend per customer, category, merchant and month, kept as sums that can be merged.

A window of months is the merge of its whole months and, where it begins within a month,
of the days of that month that are in it. New or corrected days recompute the partials of
their month only; the facts of the other months are not read again.
"""

from pyspark.sql import functions as F

from spendgrid.functions.dialect import merged_sum, partial_sum
from spendgrid.operators.features import wallet_shares
from spendgrid.operators.staging import in_window
from spendgrid.sources.tables import delete, write_table

KEYS = ["UNIQUE_ID", "CATEGORY_TWO", "DESTINATION"]


def monthly_spend(txns):
    """Mergeable totals of each month: transactions, spend in two sums, newest date."""
    return (
        txns.dropna(subset=["CATEGORY_TWO", "DESTINATION"])
        .groupBy("txn_month", *KEYS)
        .agg(F.count("*").alias("txn_count"), *partial_sum("trns_amt", "spend"), F.max("EFF_DATE").alias("last_txn_date"))
    )


def refresh_partials(txns, months, removed, path):
    """Recompute the partials of these months of the staged table; drop those of removed ones.

    A month whose rows all lack a category has no partials, so old ones go first. Repeating
    the call after a failure gives the same tables.
    """
    spark = txns.sparkSession
    for month in [*months, *removed]:
        delete(spark, f"{path}/txn_month={month.isoformat()}")
    if months:
        write_table(monthly_spend(txns.where(F.col("txn_month").isin(months))), path, ["txn_month"], KEYS[:1], mode="replace")


def windowed_spend(partials, txns, as_of, months=12):
    """Totals per customer, category and merchant from `months` months before as_of on.

    txns is read for the days of the first month only, unless the window begins with a month.
    """
    start = F.add_months(F.lit(as_of), -months)
    first = F.trunc(start, "MM")
    whole = F.when(first == start, first).otherwise(F.add_months(first, 1))
    edge = monthly_spend(in_window(txns, start, whole).where(F.col("txn_month") == first))
    return (
        partials.where(F.col("txn_month") >= whole)
        .unionByName(edge)
        .groupBy(*KEYS)
        .agg(F.sum("txn_count").alias("dest_txn_count"), merged_sum("spend").alias("dest_spend"), F.max("last_txn_date").alias("last_txn_date"))
    )


def customer_category_spend(partials, txns, as_of, months=12):
    """features.customer_category_spend() out of monthly partials."""
    return wallet_shares(windowed_spend(partials, txns, as_of, months))
