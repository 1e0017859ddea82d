"""Customer features, RFM scores, category spend and merchant metrics."""

from dataclasses import dataclass

from pyspark.sql import functions as F

from spendgrid.functions.dialect import (
    count_where,
    distinct_months,
    exact_avg,
    exact_sum,
    is_weekend,
    months_before,
    pct,
    ratio,
    ratio_avg,
    round_half,
    spread,
    sum_where,
    totals_within,
)
from spendgrid.functions.ordering import global_ntiles, row_number_within
from spendgrid.operators.staging import in_window, last_months


def _hours(first, last):
    return F.col("trns_hour").between(first, last)


def _gap_days():
    """Mean number of days between consecutive transactions."""
    return round_half(ratio(F.datediff(F.max("EFF_DATE"), F.min("EFF_DATE")), F.count("*") - 1), 2)


VISITED = {
    "NAV_CATEGORY_ID": "active_nav_categories",
    "DESTINATION_ID": "active_destinations",
    "SUBURB_ID": "active_suburbs",
    "LOCATION_ID": "active_locations",
}


def visited(columns, where=None):
    """The number of distinct ids of each column, as aggregates.

    A set per customer holds at most as many ids as the dimension has, and tasks merge their
    sets before the shuffle, so this needs no pass of its own.
    """
    chosen = lambda c: F.col(c) if where is None else F.when(where, F.col(c))
    return [F.size(F.collect_set(chosen(c))).cast("bigint").alias(name) for c, name in columns.items()]


def rfm_features(txns, as_of, months=12, min_txns=2, accuracy=10_000):
    """Behaviour of each customer over the last months.

    One pass with map-side combining: months as bits, distinct ids as sets. The median is a
    bounded sketch, exact for customers with fewer rows than `accuracy`.
    """
    n = F.count("*")
    active_months = distinct_months("EFF_DATE", F.lit(as_of), months)
    rows = last_months(txns, as_of, months)
    return (
        rows.groupBy("UNIQUE_ID")
        .agg(
            n.alias("nr_trns"),
            exact_sum("trns_amt").alias("val_trns"),
            round_half(exact_avg("trns_amt"), 2).alias("avg_val"),
            round_half(F.percentile_approx("trns_amt", 0.5, accuracy), 2).alias("median_val"),
            round_half(spread("trns_amt"), 2).alias("std_val"),
            F.datediff(F.lit(as_of), F.max("EFF_DATE")).cast("bigint").alias("lst_trns_days"),
            active_months.alias("active_months"),
            round_half(ratio(n, active_months), 2).alias("mnthly_avg_nr"),
            round_half(ratio(exact_sum("trns_amt"), active_months), 2).alias("mnthly_avg_val"),
            _gap_days().alias("days_between"),
            round_half(exact_avg("trns_dow"), 2).alias("avg_dow"),
            round_half(exact_avg("trns_hour"), 2).alias("avg_hour"),
            count_where(_hours(6, 10)).alias("NR_TRNS_MORNING"),
            count_where(_hours(11, 16)).alias("NR_TRNS_MIDDAY"),
            count_where(_hours(17, 21)).alias("NR_TRNS_EVENING"),
            count_where(~_hours(6, 21)).alias("NR_TRNS_LATE"),
            count_where(is_weekend("trns_dow")).alias("NR_TRNS_WEEKEND"),
            count_where(~is_weekend("trns_dow")).alias("NR_TRNS_WEEK"),
            *visited(VISITED),
        )
        .where(F.col("nr_trns") >= min_txns)
    )


def rfm_scores(features, n=5, **limits):
    """Quintiles of recency (reversed), frequency and spend; ties go by customer id."""
    columns = ("lst_trns_days", "nr_trns", "val_trns")
    recency, frequency, spend = global_ntiles(features, n, {c: [c, "UNIQUE_ID"] for c in columns}, **limits).values()
    return features.select(
        "*",
        (F.lit(n + 1) - recency).cast("bigint").alias("r_score"),
        frequency.cast("bigint").alias("f_score"),
        spend.cast("bigint").alias("m_score"),
    ).withColumn("rfm_combined", F.concat(*[F.col(c).cast("string") for c in ("r_score", "f_score", "m_score")]))


def customer_category_spend(txns, as_of, months=12):
    """Spend per customer, category and merchant with the share inside the category."""
    spend = (
        last_months(txns, as_of, months)
        .dropna(subset=["CATEGORY_TWO", "DESTINATION"])
        .groupBy("UNIQUE_ID", "CATEGORY_TWO", "DESTINATION")
        .agg(
            F.count("*").alias("dest_txn_count"),
            exact_sum("trns_amt").alias("dest_spend"),
            F.max("EFF_DATE").alias("last_txn_date"),
        )
    )
    return wallet_shares(spend)


def wallet_shares(spend):
    """Add category totals and the merchant's share to spend per customer, category and merchant."""
    return totals_within(
        spend,
        ["UNIQUE_ID", "CATEGORY_TWO"],
        category_txn_count=F.sum("dest_txn_count"),
        category_spend=exact_sum("dest_spend"),
    ).select(
        "UNIQUE_ID",
        "CATEGORY_TWO",
        "DESTINATION",
        "dest_txn_count",
        "dest_spend",
        "last_txn_date",
        "category_txn_count",
        "category_spend",
        round_half(ratio("dest_spend", "category_spend") * F.lit(100.0), 1).alias("share_of_wallet_pct"),
    )


def category_customers(ccs):
    """Distinct customers per category."""
    return ccs.groupBy("CATEGORY_TWO").agg(F.count_distinct("UNIQUE_ID").alias("cat_total_customers"))


def merchant_totals(ccs):
    """Customers, transactions, spend and means per category and merchant.

    ccs has one row per customer, category and merchant, so counting rows counts
    customers.
    """
    return ccs.groupBy("CATEGORY_TWO", "DESTINATION").agg(
        F.count("*").alias("customers"),
        F.sum("dest_txn_count").alias("transactions"),
        exact_sum("dest_spend").alias("spend"),
        round_half(exact_sum("dest_spend"), 0).alias("total_spend"),
        round_half(ratio_avg(ratio("dest_spend", "dest_txn_count")), 2).alias("avg_txn_value"),
        round_half(ratio(exact_sum("dest_spend"), F.count("*")), 0).alias("spend_per_customer"),
        round_half(exact_avg("share_of_wallet_pct"), 1).alias("avg_share_of_wallet"),
    )


def destination_metrics(totals, ccs):
    """Merchant totals with market share, penetration and spend rank.

    `totals` is merchant_totals as a written table, which is read more than once.
    """
    categories = totals.groupBy("CATEGORY_TWO").agg(round_half(exact_sum("spend"), 0).alias("category_spend"))
    ranked = row_number_within(
        totals.withColumn("_order", -F.col("total_spend")),
        "CATEGORY_TWO",
        ["_order", "DESTINATION"],
        "spend_rank",
    )
    return (
        ranked.join(categories, "CATEGORY_TWO")
        .join(category_customers(ccs), "CATEGORY_TWO")
        .select(
            "CATEGORY_TWO",
            "DESTINATION",
            "customers",
            "transactions",
            "total_spend",
            "avg_txn_value",
            "spend_per_customer",
            "avg_share_of_wallet",
            pct("total_spend", "category_spend", 2).alias("market_share_pct"),
            pct("customers", "cat_total_customers", 2).alias("penetration_pct"),
            "spend_rank",
        )
    )


@dataclass(frozen=True)
class ActivityWindow:
    """Months back from `as_of`: the observed span and the trend's two ends.

    Offsets after `end` count back from the end of the window, as two steps, so
    that month-end clamping happens twice.
    """

    start: int
    end: int = 0
    recent: int = 3
    early: int = 9


    def first_day(self, as_of):
        return months_before(as_of, self.start)

    def end_day(self, as_of):
        return months_before(as_of, self.end) if self.end else F.lit(as_of)

    def holds(self, as_of):
        """Whether a row lies in the window; an open one takes every row from its first day on."""
        inside = F.col("EFF_DATE") >= self.first_day(as_of)
        return inside & (F.col("EFF_DATE") < self.end_day(as_of)) if self.end else inside


def activities(txns, as_of, windows, more=()):
    """Model features per customer over several windows, by one scan and one aggregation.

    windows: name -> ActivityWindow. The features of a window are columns beginning with its
    name; activity_in() takes them out. more: further aggregates over all rows that any
    window may need. Every aggregate combines on the map side.
    """
    start = F.least(*[w.first_day(as_of) for w in windows.values()]) if len(windows) > 1 else next(iter(windows.values())).first_day(as_of)
    ends = [w.end for w in windows.values()]
    until = months_before(as_of, min(ends)) if all(ends) and not more else None
    columns = [c for name, w in windows.items() for c in _activity(name, w, as_of)]
    return in_window(txns, start, until).groupBy("UNIQUE_ID").agg(*columns, *more)


def _activity(name, window, as_of):
    inside, anchor, day = window.holds(as_of), window.end_day(as_of), F.col("EFF_DATE")
    n, amount = count_where(inside), F.col("trns_amt")
    own_day = F.when(inside, day)
    recent = inside & (day >= months_before(anchor, window.recent))
    early = inside & (day < months_before(anchor, window.early))
    previous = inside & (day >= months_before(anchor, 2 * window.recent)) & (day < months_before(anchor, window.recent))
    columns = {
        "nr_trns": n,
        "val_trns": exact_sum(amount, where=inside),
        "avg_val": round_half(exact_avg(amount, where=inside), 2),
        "active_months": distinct_months("EFF_DATE", F.lit(as_of), window.start, where=inside),
        "days_between": round_half(ratio(F.datediff(F.max(own_day), F.min(own_day)), n - 1), 2),
        "NR_TRNS_WEEKEND": count_where(inside & is_weekend("trns_dow")),
        "NR_TRNS_WEEK": count_where(inside & ~is_weekend("trns_dow")),
        "pct_morning": pct(count_where(inside & _hours(6, 10)), n),
        "pct_evening": pct(count_where(inside & _hours(17, 21)), n),
        "txn_trend": F.coalesce(round_half(ratio(count_where(recent), count_where(early)), 2), F.lit(0.0)),
        "spend_trend": F.coalesce(round_half(ratio(sum_where(recent, amount), sum_where(early, amount)), 2), F.lit(0.0)),
        "days_since_last": F.datediff(anchor, F.max(own_day)).cast("bigint"),
        "txns_last_3m": count_where(recent),
        "txns_prev_3m": count_where(previous),
    }
    sets = visited({c: f"{name}{VISITED[c]}" for c in ("DESTINATION_ID", "NAV_CATEGORY_ID")}, where=inside)
    return [*[column.alias(f"{name}{c}") for c, column in columns.items()], *sets]


def activity_in(wide, name, min_txns=3, more=()):
    """The features of one window out of activities(), of customers with enough rows in it."""
    own = [c for c in wide.columns if c.startswith(name) and c not in more and c != "UNIQUE_ID"]
    rows = wide.where(F.col(f"{name}nr_trns") >= min_txns)
    return rows.select("UNIQUE_ID", *[F.col(c).alias(c.removeprefix(name)) for c in own], *more)


def activity(txns, as_of, window, min_txns=3):
    """Model features per customer over one window."""
    return activity_in(activities(txns, as_of, {"": window}), "", min_txns)
