"""Raw transactions and snapshots to the two staged tables."""

from pyspark.sql import functions as F

# Raw snapshot column -> name.
DEMOGRAPHICS = {
    "demo_1": "gender",
    "demo_2": "age",
    "demo_3": "profile_age",
    "demo_4": "vertical_sales_index",
    "demo_5": "income_segment",
    "demo_6": "hyper_segment",
    "demo_7": "estimated_income",
    "demo_8": "main_banked",
    "demo_9": "credit_risk_class",
}
# Upper limit and label of each band; the last has no limit.
AGE_BANDS = [(25, "18-25"), (35, "26-35"), (45, "36-45"), (60, "46-60"), (None, "60+")]
INCOME_BANDS = [
    (5500, "R0-R5.5k"),
    (13500, "R5.5k-R13.5k"),
    (23500, "R13.5k-R23.5k"),
    (32500, "R23.5k-R32.5k"),
    (56000, "R32.5k-R56k"),
    (None, "R56k+"),
]
GENDERS = {0: "Male", 1: "Female"}
UNKNOWN = "Unknown"

LOOKUP_KEYS = {
    "category_one_id": "CATEGORY_ONE_ID",
    "category_two_id": "CATEGORY_TWO_ID",
    "nav_category_id": "NAV_CATEGORY_ID",
    "destination_id": "DESTINATION_ID",
    "location_id": "LOCATION_ID",
    "suburb_id": "SUBURB_ID",
}


def band(x, bands):
    """Label of the first band whose upper limit is not exceeded."""
    label = F.lit(bands[-1][1])
    for limit, name in reversed(bands[:-1]):
        label = F.when(x <= limit, name).otherwise(label)
    return label


def stage_transactions(raw, lookups):
    """Valid facts with calendar parts, names for the six ids and a month column.

    The lookups are joined without a broadcast hint: the size statistics decide, so
    a lookup that outgrows the threshold falls back to a shuffle join.
    """
    facts = raw.dropna(subset=["UNIQUE_ID", "EFF_DATE", "trns_amt"]).select(
        "UNIQUE_ID",
        "EFF_DATE",
        "trns_amt",
        "trns_time",
        F.year("EFF_DATE").cast("bigint").alias("trns_year"),
        F.month("EFF_DATE").cast("bigint").alias("trns_month"),
        F.dayofweek("EFF_DATE").cast("bigint").alias("trns_dow"),
        F.left("trns_time", F.lit(2)).try_cast("bigint").alias("trns_hour"),
        "CATEGORY_ONE_ID",
        "CATEGORY_TWO_ID",
        "NAV_CATEGORY_ID",
        "DESTINATION_ID",
        F.col("LOCATION_ID").cast("bigint").alias("LOCATION_ID"),
        F.col("SUBURB_ID").cast("bigint").alias("SUBURB_ID"),
        F.trunc("EFF_DATE", "MM").alias("txn_month"),
    )
    for name, key in LOOKUP_KEYS.items():
        facts = _looked_up(facts, lookups[name], key)
    return facts.withColumnsRenamed({"X": "longitude", "Y": "latitude"})


def _looked_up(facts, lookup, key):
    """Left join that spreads the rows without a key, which match nothing.

    A second join column is 0 for all rows with a key and random for the others, so that a
    shuffle join does not send these to one task.
    """
    spread = F.when(F.col(key).isNull(), F.pmod(F.xxhash64("UNIQUE_ID", "EFF_DATE"), F.lit(1 << 20)) + 1).otherwise(0)
    zero = F.when(F.col(key).isNull(), 1).otherwise(0).cast("bigint")
    return facts.withColumn("_spread", spread.cast("bigint")).join(lookup.withColumn("_spread", zero), [key, "_spread"], "left").drop("_spread")


def latest_snapshot(snapshots):
    """Newest row per customer; rows of the same month are ordered by content, NULLs first.

    A minimum per customer combines on the map side, where a ranking window would sort
    every snapshot.
    """
    age = F.datediff(F.lit("9999-12-31").cast("date"), "month")
    order = F.struct(F.col("month").isNull(), age, *[F.col(c) for c in DEMOGRAPHICS])
    rest = F.struct(*[c for c in snapshots.columns if c != "UNIQUE_ID"])
    newest = snapshots.where(F.col("UNIQUE_ID").isNotNull()).groupBy("UNIQUE_ID").agg(F.min_by(rest, order).alias("row"))
    return newest.select("UNIQUE_ID", "row.*").select(*snapshots.columns)


def stage_customers(snapshots):
    income = F.col("estimated_income")
    gender = F.lit(UNKNOWN)
    for code, label in GENDERS.items():
        gender = F.when(F.col("gender") == code, label).otherwise(gender)
    return (
        latest_snapshot(snapshots)
        .withColumnsRenamed(DEMOGRAPHICS)
        .select(
            "UNIQUE_ID",
            *DEMOGRAPHICS.values(),
            F.when(F.col("age").isNull(), UNKNOWN).otherwise(band(F.col("age"), AGE_BANDS)).alias("age_group"),
            F.when(income.isNull() | (income == 0), UNKNOWN)
            .otherwise(band(income, INCOME_BANDS))
            .alias("income_group"),
            gender.alias("gender_label"),
        )
    )


def date_bounds(txns):
    """Newest transaction date as a driver value, so later filters are literals.

    With a month partition column only the newest partition is scanned.
    """
    if "txn_month" in txns.columns:
        newest = txns.agg(F.max("txn_month")).first()[0]
        txns = txns.where(F.col("txn_month") == F.lit(newest))
    return txns.agg(F.max("EFF_DATE")).first()[0]


def in_window(txns, start, end=None):
    """Rows from start (inclusive) to end (exclusive), pruning month partitions."""
    keep = F.col("EFF_DATE") >= start
    if "txn_month" in txns.columns:
        keep = keep & (F.col("txn_month") >= F.trunc(start, "MM"))
    if end is not None:
        keep = keep & (F.col("EFF_DATE") < end)
        if "txn_month" in txns.columns:
            keep = keep & (F.col("txn_month") <= F.trunc(end, "MM"))
    return txns.where(keep)


def last_months(txns, as_of, months):
    start = F.add_months(F.lit(as_of), -months)
    return in_window(txns, start)
