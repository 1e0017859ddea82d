"""Raw card-transaction tables read out of an order/line/customer schema.

lineitem x orders x part x supplier become the transaction fact, customer becomes
the monthly snapshots, and the remaining tables become the six lookups.
"""

from collections.abc import Callable
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendgrid.functions.dialect import local_frame
from spendgrid.sources.schemas import TRANSACTIONS

# Part type -> (category id, category name, parent id).
CATEGORY_OF_PART = {
    "ECONOMY": (1, "Groceries", 1),
    "SMALL": (2, "Restaurants", 1),
    "MEDIUM": (3, "Clothing & Apparel", 2),
    "PROMO": (4, "Fuel & Energy", 2),
    "STANDARD": (5, "Electronics", 2),
    "LARGE": (6, "Travel", 2),
}
PARENT_CATEGORIES = [(1, "Food"), (2, "Non-food")]
PROVINCE_OF_REGION = {
    "AFRICA": "GAUTENG",
    "AMERICA": "WESTERN CAPE",
    "ASIA": "KWAZULU-NATAL",
    "EUROPE": "EASTERN CAPE",
    "MIDDLE EAST": "LIMPOPO",
}
# Facts are staged in slices of about so many bytes of lineitem, so that the shuffles of one slice
# are on disk at a time; so many slices at most, as each of them scans the lines and orders.
SLICE_BYTES = 32 << 20
MOST_SLICES = 16
SNAPSHOT_MONTHS = ["2001-05-01", "2001-06-01", "2001-07-01"]


@dataclass(frozen=True)
class RawTables:
    """slices: gives tables that make up the transactions, each with all rows of its share of the keys."""

    transactions: DataFrame
    snapshots: DataFrame
    lookups: dict
    slices: Callable | None = None

    def parts(self):
        return self.slices() if self.slices else [self.transactions]


def read_table(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet")


def customer_key(key):
    """'C' and at least eight digits; longer keys keep all their digits."""
    digits = F.col(key).cast("string")
    return F.concat(F.lit("C"), F.when(F.length(digits) >= 8, digits).otherwise(F.lpad(digits, 8, "0")))


def _part_lookup(column, position):
    value = F.lit(None)
    for kind, entry in CATEGORY_OF_PART.items():
        value = F.when(F.col(column) == kind, F.lit(entry[position])).otherwise(value)
    return value


def in_slice(column, number, of):
    return F.pmod(F.xxhash64(F.col(column).cast("bigint")), F.lit(of)) == number


def slice_count(size):
    return max(1, min(MOST_SLICES, -(-size // SLICE_BYTES)))


def transaction_slices(spark, folder):
    """The facts by a hash of the order."""
    size = read_table(spark, folder, "lineitem")._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    n = slice_count(int(str(size)))
    return [transactions(spark, folder, i, n) for i in range(n)]


def transactions(spark, folder, number=0, of=1):
    """Facts; everything that depends on one side only is computed before the join.

    Of several slices, number has the facts of its share of the orders.
    """
    kept = lambda name, key: read_table(spark, folder, name).where(in_slice(key, number, of) if of > 1 else F.lit(True))
    kind = F.split_part(F.col("p_type"), F.lit(" "), F.lit(1))
    orders = kept("orders", "o_orderkey").select(
        "o_orderkey", customer_key("o_custkey").alias("UNIQUE_ID"), F.to_date("o_orderdate").alias("EFF_DATE")
    )
    parts = (
        read_table(spark, folder, "part")
        .withColumn("kind", kind)
        .select(
            "p_partkey",
            _part_lookup("kind", 2).cast("bigint").alias("CATEGORY_ONE_ID"),
            _part_lookup("kind", 0).cast("bigint").alias("CATEGORY_TWO_ID"),
            F.replace(F.col("p_brand"), F.lit("Brand#"), F.lit("")).cast("bigint").alias("NAV_CATEGORY_ID"),
        )
    )
    suppliers = read_table(spark, folder, "supplier").select(
        "s_suppkey", F.col("s_nationkey").cast("double").alias("SUBURB_ID")
    )
    hour = F.lpad(((F.col("l_orderkey") * 7 + F.col("l_linenumber") * 5) % 24).cast("string"), 2, "0")
    lines = kept("lineitem", "l_orderkey").select(
        "l_orderkey",
        "l_partkey",
        F.col("l_suppkey").alias("DESTINATION_ID"),
        F.col("l_suppkey").cast("double").alias("LOCATION_ID"),
        # every 97th order carries an unreadable time
        F.when(F.col("l_orderkey") % 97 == 0, F.lit("xx00"))
        .otherwise(F.concat(hour, F.lit("00")))
        .alias("trns_time"),
        (F.floor(F.col("l_extendedprice") * F.lit(10.0)).cast("double") / F.lit(100.0)).alias("trns_amt"),
    )
    return (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .join(suppliers, F.col("DESTINATION_ID") == F.col("s_suppkey"))
        .select(*TRANSACTIONS.names)
    )


def snapshots(spark, folder):
    key = F.col("c_custkey")
    months = F.array(*[F.lit(m).cast("date") for m in SNAPSHOT_MONTHS])
    latest = F.lit(SNAPSHOT_MONTHS[-1]).cast("date")
    age = (F.lit(18) + key % 60 - F.when(F.col("month") < latest, 1).otherwise(0)).cast("double")
    return (
        read_table(spark, folder, "customer")
        .withColumn("month", F.explode(months))
        .select(
            customer_key("c_custkey").alias("UNIQUE_ID"),
            "month",
            (key % 3).alias("demo_1"),
            F.when(key % 41 != 0, age).alias("demo_2"),
            (key % 20).cast("double").alias("demo_3"),
            (key % 7).alias("demo_4"),
            F.col("c_mktsegment").alias("demo_5"),
            F.when(key % 2 == 0, "Salaried").otherwise("Self-employed").alias("demo_6"),
            F.floor(F.greatest(F.col("c_acctbal"), F.lit(0.0)) * F.lit(8.0)).cast("double").alias("demo_7"),
            (key % 2).alias("demo_8"),
            F.substring(F.lit("ABCDE"), (key % 5 + 1).cast("int"), F.lit(1)).alias("demo_9"),
        )
    )


def lookups(spark, folder):
    parts = read_table(spark, folder, "part")
    suppliers = read_table(spark, folder, "supplier")
    nations = read_table(spark, folder, "nation")
    regions = read_table(spark, folder, "region")
    province = F.lit(None)
    for region, name in PROVINCE_OF_REGION.items():
        province = F.when(F.col("r_name") == region, name).otherwise(province)
    category_two = [entry[:2] for entry in CATEGORY_OF_PART.values()]
    return {
        "category_one_id": local_frame(spark, PARENT_CATEGORIES, ["CATEGORY_ONE_ID", "CATEGORY_ONE"]),
        "category_two_id": local_frame(spark, category_two, ["CATEGORY_TWO_ID", "CATEGORY_TWO"]),
        "nav_category_id": parts.select("p_brand")
        .distinct()
        .select(
            F.replace(F.col("p_brand"), F.lit("Brand#"), F.lit("")).cast("bigint").alias("NAV_CATEGORY_ID"),
            F.col("p_brand").alias("NAV_CATEGORY"),
        ),
        "destination_id": suppliers.select(
            F.col("s_suppkey").alias("DESTINATION_ID"),
            F.col("s_name").alias("DESTINATION"),
            F.lit("Merchant").alias("BUSINESS_CATEGORY_ONE"),
            F.when(F.col("s_acctbal") < 0, "Overdrawn").otherwise("In credit").alias("BUSINESS_CATEGORY_TWO"),
        ),
        "location_id": suppliers.select(
            F.col("s_suppkey").alias("LOCATION_ID"),
            F.concat(F.lit("Branch of "), "s_name").alias("LOCATION_NAME"),
            (F.lit(16.0) + (F.col("s_suppkey") % 1600) / F.lit(100.0)).alias("X"),
            (F.lit(-34.0) + (F.col("s_suppkey") % 1200) / F.lit(100.0)).alias("Y"),
        ),
        "suburb_id": nations.join(regions, nations.n_regionkey == regions.r_regionkey).select(
            F.col("n_nationkey").cast("bigint").alias("SUBURB_ID"),
            F.concat("n_name", F.lit(" Central")).alias("SUBURB"),
            F.concat("n_name", F.lit(" Town")).alias("TOWN"),
            F.col("n_name").alias("MUNICIPALITY"),
            province.alias("PROVINCE"),
        ),
    }


def raw_tables(spark, folder):
    slices = partial(transaction_slices, spark, folder)
    return RawTables(transactions(spark, folder), snapshots(spark, folder), lookups(spark, folder), slices)
